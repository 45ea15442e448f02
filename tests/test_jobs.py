"""The jobs over small growing inputs."""

import hashlib
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobs import intake_texts, screen_candidates

ROOT = Path(__file__).parents[1]
LONG = "abel " * 20


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


# intake of texts


def put(spark, folder, rows):
    spark.createDataFrame(rows, intake_texts.INPUT).coalesce(1).write.mode("append").parquet(str(folder))


def text(i, t, n=None):
    return (i, t, "en", f"s{i}" if i is not None else None, len(t or "") if n is None else n)


def taken(spark, place, **config):
    out = intake_texts.run(spark, str(place / "in"), str(place / "out"), str(place / "mark"), intake_texts.load_config() | config)
    return {(r["doc_id"], r["batch"], r["status"], r["first_id"], r["flags"]) for r in out.collect()}, rows_of(out)


def test_intake_takes_only_what_is_new(spark, tmp_path):
    a, b, c = LONG + "one", LONG + "two", LONG + "cs"
    put(spark, tmp_path / "in", [text(5, a), text(3, a), text(9, b), text(10, "short"), text(11, b + "x", 7), text(None, None), text(12, c)])
    first, rows = taken(spark, tmp_path)
    assert first == {
        (3, 0, "clean", None, ""), (5, 0, "duplicate", 3, ""), (9, 0, "clean", None, ""), (10, 0, "blocked", None, ""),
        (11, 0, "blocked", None, ""), (None, 0, "blocked", None, ""), (12, 0, "flagged", None, "cys_present"),
    }
    assert taken(spark, tmp_path)[1] == rows  # nothing new
    put(spark, tmp_path / "in", [text(1, a), text(20, LONG + "new"), text(21, None), text(22, LONG + "new"), text(20, LONG + "new")])
    second, rows = taken(spark, tmp_path)
    new = second - first
    assert {x for x in second if x[1] == 0} == first
    assert (1, 1, "duplicate", 3, "") in new  # the earlier batch has it, though its id is smaller
    assert (21, 1, "duplicate", None, "") in new
    assert (20, 1, "clean", None, "") in new and (20, 1, "duplicate", 20, "") in new and (22, 1, "duplicate", 20, "") in new
    assert len(rows) == 12
    assert taken(spark, tmp_path)[1] == rows


def test_intake_of_a_replayed_batch(spark, tmp_path):
    """A batch that was written but not committed is written again, once."""
    put(spark, tmp_path / "in", [text(1, LONG), text(2, LONG)])
    _, rows = taken(spark, tmp_path)
    for f in [tmp_path / "mark/commits/0", tmp_path / "mark/commits/.0.crc"]:
        f.unlink(missing_ok=True)
    assert taken(spark, tmp_path)[1] == rows


def test_intake_in_several_batches(spark, tmp_path):
    for i in range(4):
        put(spark, tmp_path / "in", [text(i, LONG), text(10 + i, LONG + str(i))])
    out, rows = taken(spark, tmp_path, files_per_batch=1)
    assert {x[1] for x in out} == {0, 1, 2, 3} and len(rows) == 8
    assert sum(x[2] == "duplicate" for x in out) == 3 and len({x[3] for x in out if x[2] == "duplicate"}) == 1


def test_intake_of_an_empty_table(spark, tmp_path):
    put(spark, tmp_path / "in", [])
    assert taken(spark, tmp_path)[1] == []


def test_intake_hashes_and_extra_columns(spark, tmp_path):
    spark.createDataFrame([(*text(1, LONG), "mine")], intake_texts.INPUT + ", status string").write.parquet(str(tmp_path / "in"))
    out = intake_texts.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"), intake_texts.load_config())
    row = out.first()
    assert (row["content"], row["status"]) == (hashlib.sha256(LONG.encode()).hexdigest(), "clean")


# shortlists


LINES = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double"


@pytest.fixture
def tables(spark, tmp_path):
    lines = [(k % 7, 2 + k % 2, k % 5, k % 3, 10.0 + k % 40, 15000.0 + 200 * k, 0.01 * (k % 9), 0.01 * (k % 8)) for k in range(400)]
    lines += [(1, 2, 1, 1, None, None, None, None), (99, 3, 99, 0, 40.0, 90000.0, 0.05, 0.0), (2, 3, 2, 2, float("nan"), 1e5, 0.08, 0.0)]
    spark.createDataFrame(lines, LINES).withColumn("target", F.lit("x")).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(k, f"{k % 3}-LEVEL") for k in range(7)], "o_orderkey long, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(k, f"B{k % 2}" if k else None) for k in range(5)], "p_partkey long, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def test_screen_writes_the_same_again_and_single_targets(spark, tables, tmp_path):
    config, out = screen_candidates.load_config(), str(tmp_path / "out")
    whole = rows_of(screen_candidates.run(spark, tables, out, config))
    assert rows_of(screen_candidates.run(spark, tables, out, config)) == whole
    assert {r["target"] for r in spark.read.parquet(out).collect()} == {"0-LEVEL", "1-LEVEL", "2-LEVEL", "none"}
    part = screen_candidates.run(spark, tables, out, config | {"targets": ["1-LEVEL"], "per_cluster": 1})
    assert part.where("target = '1-LEVEL' and place > 1").isEmpty()
    assert rows_of(part.where("target <> '1-LEVEL'")) == sorted((r for r in whole if r[-1] != "1-LEVEL"), key=str)
    assert rows_of(screen_candidates.run(spark, tables, out, config)) == whole


def test_screen_takes_the_best_of_each_cluster(spark, tables, tmp_path):
    config = screen_candidates.load_config()
    found = screen_candidates.run(spark, tables, str(tmp_path / "out"), config)
    every = [r.asDict() for r in screen_candidates.candidates(spark, tables, config).collect()]
    for target, cluster in {(r["target"], r["cluster"]) for r in every}:
        rows = [r for r in every if (r["target"], r["cluster"]) == (target, cluster)]
        best = sorted((r for r in rows if r["screen"] and r["select"]), key=lambda r: (-r["score"], *[r[c] for c in screen_candidates.ID]))
        got = found.where((F.col("target") == target) & (F.col("cluster") == cluster)).orderBy("place").collect()
        assert {(r["candidates"], r["screened"], r["passed"]) for r in got} == {(len(rows), sum(r["screen"] for r in rows), len(best))}
        assert [tuple(r[c] for c in screen_candidates.ID) for r in got if r["place"]] == [tuple(r[c] for c in screen_candidates.ID) for r in best[:3]]
        assert best or [r["place"] for r in got] == [0]


def test_screen_of_empty_tables(spark, tables, tmp_path):
    for name in ("lineitem", "orders", "part"):
        spark.read.parquet(f"{tables}/{name}.parquet").where("false").write.parquet(str(tmp_path / f"none/{name}.parquet"))
    assert screen_candidates.run(spark, str(tmp_path / "none"), str(tmp_path / "out"), screen_candidates.load_config()).isEmpty()


def test_command_lines(spark, tables, tmp_path):
    put(spark, tmp_path / "in", [text(1, LONG)])
    run = lambda *args: subprocess.run([sys.executable, "-m", *args], cwd=ROOT, capture_output=True, text=True, timeout=300)
    done = run("jobs.intake_texts", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out2"), "--checkpoint", str(tmp_path / "mark2"))
    assert done.returncode == 0 and "holds 1 rows" in done.stderr, done.stderr[-2000:]
    done = run("jobs.screen_candidates", "--input", tables, "--output", str(tmp_path / "out3"), "--target", "2-LEVEL")
    assert done.returncode == 0 and {r["target"] for r in spark.read.parquet(str(tmp_path / "out3")).collect()} == {"2-LEVEL"}, done.stderr[-2000:]
