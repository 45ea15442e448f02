import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievework.llm import mixing, pipeline, queries, simhash, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"] for r in docs.collect()}
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        after = [r["doc_id"] for r in docs.collect()]
        assert set(after) <= before, name
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name in ("simhash_dedup", "pii"):
            assert max(Counter(after).values()) == 1
        if name == "pii":
            assert set(after) == before
        before = set(after)
    assert docs.columns == ["doc_id", "n_tokens", "ids"] and all(r["n_tokens"] == len(r["ids"]) for r in docs.collect())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for t in ("documents", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    text = lambda f: sorted(tuple("null" if pd.isna(v) else str(v).removesuffix(".0") for v in r) for r in f[columns].itertuples(index=False))
    assert text(got) == text(want)


def test_pipeline_equals_its_stages_row_by_row(spark, tmp_path):
    """A small table with null and empty texts, repeated and null ids, ties and extra columns, held against plain loops."""
    from tokenizers import Tokenizer

    from sievework.llm import bpe, pii

    rng = random.Random(81)
    words = "mela tor vin asto kerl undo prin salo mide ostra venn lurk".split()
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "s", "en", "ti"]) for _ in range(n))
    texts = [prose(rng.randint(40, 90)) + (" grobian" if i % 4 == 0 else "") for i in range(240)]
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(300, texts[1], "en", "s0", 1), (300, texts[1], "en", "s0", 1), (None, texts[2], "en", None, 1), (301, None, "en", "s1", 0), (302, "", None, "s1", 0), (301, prose(70) + ' password=1e738d199cb6c4db8d and a@b.example.org', "de", "s2", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("a.b", F.lit(1))
    (tmp_path / "t").mkdir()
    df.repartition(3).write.parquet(str(tmp_path / "t" / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "t" / "labels.parquet"))
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in pipeline.run(spark, str(tmp_path / "t")).collect())

    model = toxicity.train(df, spark.read.parquet(str(tmp_path / "t" / "labels.parquet")))
    scorer = toxicity.Scorer(model)
    clean = [r for r in rows if scorer.score([r[1]])[0] < model.thresholds.get(r[2], model.threshold)]
    assert sum(r[0] is not None and r[0] < 240 and r[0] % 4 == 0 for r in clean) <= 3 and sum(r[0] is not None and r[0] < 240 and r[0] % 4 > 0 for r in clean) >= 175
    prints, left, parts = {r: simhash.fingerprint_text(r[1]) & (2**64 - 1) for r in clean}, set(clean), []
    while left:
        part, edge = set(), {left.pop()}
        while edge:
            part |= edge
            edge = {r for r in left if any(bin(prints[r] ^ prints[x]).count("1") <= 2 for x in edge)}
            left -= edge
        parts.append(part)
    key = {(r["i"], r["t"]): r["k"] for r in spark.createDataFrame([(r[0], r[1]) for r in clean], "i long, t string").select("i", "t", F.xxhash64("t").alias("k")).collect()}
    kept = [min(part, key=lambda r: (r[0] is None, r[0] or 0, key[r[0], r[1]])) for part in parts]
    tagger, tokenizer = pii.Tagger(pii.train()), Tokenizer.from_file(bpe.default_path())
    masked = [(r[0], None if r[1] is None else pii.redact_text(r[1], pii.all_spans(tagger, [r[1]])[0][1]), r[3]) for r in kept]
    assert any("<SECRET>" in (t or "") and "<EMAIL>" in t for _, t, _ in masked)
    taken = {(r["doc_id"], r["size"]): r["taken"] for r in mixing.mix_report(spark.createDataFrame(masked, "doc_id long, text string, source string")).collect()}
    want = Counter()
    for doc_id, text, _ in masked:
        n = len((text or "").split())
        if n:
            want[doc_id, tuple(tokenizer.encode(text, add_special_tokens=False).ids)] += taken[doc_id, n] // n
    assert Counter({k: n for k, n in got.items() if k[1]}) == +want


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
