"""The refinement loop by its invariants."""

import json
from collections import Counter

from pyspark.sql import functions as F

from sievework.functions import sequences
from sievework.operators import optimize as opt
from sievework.sources.registry import Registry

POOL = "design_id string, sequence string, given double"


def family(spark, n=12):
    """Near copies with high scores, and lone designs of a little less."""
    close = [(f"c{i:02}", "ACDEFGHIKLMN"[: 12 - i % 2] + "WYWY"[: i % 4], 1.0 + i / 1000) for i in range(n)]
    lone = [(f"l{i}", "".join(sequences.ALPHABET[(i * 3 + j * (i + 2)) % 20] for j in range(14)), 0.9) for i in range(4)]
    return spark.createDataFrame(close + lone, POOL)


def plain(s, given):
    return given


def test_rounds_are_the_same_again_and_name_their_parents(spark):
    pool, config = family(spark), opt.OptimizeConfig(rounds=3, population=20, elite_frac=0.2)
    rows = opt.optimize(pool, config).collect()
    again = opt.optimize(pool.repartition(3), config).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and {r["round"] for r in rows} == {0, 1, 2}
    elites = {t: {r["design_id"] for r in rows if r["round"] == t and r["elite"]} for t in range(3)}
    by_id = {r["design_id"]: r["sequence"] for r in rows}
    assert all(len(e) == 4 for e in elites.values())
    for r in rows:
        new = r["round"] and r["design_id"] not in {x["design_id"] for x in rows if x["round"] == r["round"] - 1}
        assert not new or r["parent_id"] in elites[r["round"] - 1] and (r["mate_id"] is None or r["mate_id"] in elites[r["round"] - 1] - {r["parent_id"]})
        assert not set(r["sequence"]) - set(sequences.ALPHABET)
        if new:
            a, b = by_id[r["parent_id"]], by_id[r["mate_id"] or r["parent_id"]]
            crossed = [a[:k] + b[k:] for k in range(1, max(2, min(len(a), len(b))))]
            assert min(sum(x != y for x, y in zip(c, r["sequence"], strict=True)) for c in crossed if len(c) == len(r["sequence"])) <= 3
    for t in (1, 2):
        assert max(Counter(r["sequence"] for r in rows if r["round"] == t).values()) == 1
    assert any(r["mate_id"] for r in rows) and any(r["parent_id"] and not r["mate_id"] for r in rows)
    assert not any(r["mate_id"] for r in opt.optimize(pool, opt.OptimizeConfig(rounds=2, population=20, crossover=0.0)).collect())


def test_sharing_lets_lone_designs_in(spark):
    best = {}
    for weight in (0.0, 0.15):
        rows = opt.optimize(family(spark), opt.OptimizeConfig(rounds=1, population=20, elite_frac=0.2, diversity_weight=weight), plain).where("elite").collect()
        best[weight] = {r["design_id"][0] for r in rows}
    assert best[0.0] == {"c"} and "l" in best[0.15]
    shared = opt.shared(family(spark), plain, 0.5).collect()
    sizes = Counter(r["niche"] for r in shared)
    assert all(r["niche_size"] == sizes[r["niche"]] and r["fitness"] <= r["score"] for r in shared) and max(sizes.values()) > 4


def test_crossover_and_short_sequences(spark):
    rows = spark.createDataFrame([("AAAA", "CCCCCC", k) for k in range(40)] + [("A", "CC", 1), ("", "CC", 2), ("AA", "CC", 3)], "a string, b string, k int")
    got = rows.select("a", "b", opt.crossover(F.col("a"), F.col("b"), F.col("k")).alias("x")).collect()
    assert {r["x"] for r in got if r["a"] == "AAAA"} == {"ACCCCC", "AACCCC", "AAACCC"}
    assert [r["x"] for r in got[-3:]] == ["A", "", "AC"]


def test_rounds_in_the_registry_and_their_statistics(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "r"))
    history = opt.optimize(family(spark), opt.OptimizeConfig(rounds=2, population=12, elite_frac=0.25), registry=registry, target_id="t")
    kept = {r["design_id"]: r for r in registry.query_target("t", "optimize").collect()}
    assert kept.keys() == {r["design_id"] for r in history.collect()} and len(registry.batches()) == 2
    assert all(json.loads(r["metrics"])["round"] in (0, 1) for r in kept.values())
    stats = {r["round"]: r for r in opt.convergence(history).collect()}
    first = [r for r in history.collect() if r["round"] == 0]
    assert stats[0]["designs"] == len(first) and stats[0]["elites"] == 3 and stats[0]["best"] == max(r["score"] for r in first) and stats[0]["niches"] == len({r["niche"] for r in first})


def test_an_empty_pool(spark):
    assert opt.optimize(family(spark).where("false"), opt.OptimizeConfig(rounds=2)).isEmpty()


def test_a_pool_is_read_once_and_dealt_over_tasks(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(text):
        read.add(1)
        return text

    pool = family(spark).coalesce(1).select("design_id", told("sequence").alias("sequence"), "given")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rows = opt.optimize(pool, opt.OptimizeConfig(rounds=1, population=20), lambda s, given: F.spark_partition_id().cast("double")).collect()
    finally:
        spark.conf.set(key, before)
    assert read.value == len(rows) == 16 and len({r["score"] for r in rows}) > 1
