"""Every registered query against its SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from jobs.queries import ORACLE_SQL as JOB_SQL
from jobs.queries import QUERIES as JOBS
from sievework import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def rows(frame):
    import pandas as pd

    frame = frame[sorted(frame.columns)]
    text = lambda v: "null" if v is None or (not isinstance(v, str) and pd.isna(v)) else repr(float(v)) if not isinstance(v, str) and hasattr(v, "__float__") else str(v)
    return sorted(tuple(map(text, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL | JOB_SQL))
def test_query_equals_sql(spark, duck, name):
    got, want = (queries.QUERIES | JOBS)[name](spark, SF).toPandas(), duck.execute((queries.ORACLE_SQL | JOB_SQL)[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_queries_without_sql_run(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_added_column_keeps_every_row(spark):
    got = queries.QUERIES["add_column"](spark, SF)
    counts = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("customer", "supplier")}
    assert counts["customer"] > 100 and got.where("stage is null").count() == counts["customer"] and got.where("stage = 'late'").count() == counts["supplier"]


def test_alphabet_of_whole_texts(spark):
    got = {r["doc_id"]: r["bad"] for r in queries.QUERIES["alphabet_check"](spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {i: "".join(sorted(set(t) - set("ACDEFGHIKLMNPQRSTVWY"))) for i, t in texts.items()}
    assert got == {i: b for i, b in want.items() if b}
