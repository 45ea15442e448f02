"""Queries of the library's operators on the driver's tables, and the same in SQL.

The driver's tables are orders, documents and vectors; each query applies
one operator to the columns that play its part.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework import audit_queries
from sievework.functions import align, metrics, sequences, stats
from sievework.operators import contacts, hierarchy, leaders, novelty, optimize, rank, structures, surface
from sievework.operators.ancestry import ancestry
from sievework.plans.shared import new_path
from sievework.sources.registry import Registry
from sievework.streaming.events import window_counts

QUERIES: dict[str, object] = {}
ORACLE_SQL: dict[str, str] = {}

#: Thresholds of the queries on ``lineitem``; tax is better if lower.
PROFILE = {
    "folding_confidence": {"quantity": {"screen": 10, "select": 25}, "discount": {"screen": 0.02, "select": 0.04}, "cross_predictor": {"min_agreeing": 2}},
    "interface_physics": {"tax": {"screen": 0.06, "select": 0.03}, "price": {"screen": None, "select": 20000}, "off": {"screen": 1, "enabled": False}},
    "direction": {"tax": "lower"},
}


def query(name: str, sql: str | None = None):
    """Register a query and its SQL."""

    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return wrap


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as candidates: some metrics of some rows weren't measured."""
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    unmeasured = F.when(F.col("l_returnflag") != "A", F.col("l_quantity"))
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in (("quantity", unmeasured), ("discount", F.col("l_discount")), ("tax", F.col("l_tax")), ("price", F.col("l_extendedprice")))])
    measured = rows.withColumn("metrics", F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())))
    return measured.withColumn("low", metrics.lower_keys(F.col("metrics"))).withColumn("agreeing", F.pmod("l_linenumber", F.lit(4)).cast("int"))


_CAND = """cand AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
  CASE WHEN l_returnflag <> 'A' THEN l_quantity END AS quantity, l_linenumber % 4 AS agreeing FROM lineitem)"""
_SCREEN = "(coalesce(quantity >= 10, TRUE) AND discount >= 0.02 AND tax <= 0.06 AND agreeing >= 2)"
_SELECT = "(coalesce(quantity >= 25, TRUE) AND discount >= 0.04 AND tax <= 0.03 AND price >= 20000 AND agreeing >= 2)"


@query("scan_filter_project", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 12 AND l_shipdate >= TIMESTAMP '1996-01-01'")
def scan_filter_project(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").where(F.col("l_quantity").between(10, 12) & (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")))
    return rows.select("l_orderkey", "l_partkey", "l_quantity")


@query("point_lookup", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 42")
def point_lookup(spark, sf_dir):
    return _t(spark, sf_dir, "orders").where("o_orderkey = 42").select("o_orderkey", "o_custkey", "o_totalprice")


@query("stage_scan", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def stage_scan(spark, sf_dir):
    return _t(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderpriority")


@query(
    "upsert_latest",
    """SELECT user_id::VARCHAR AS design_id, event_type AS stage, event_id AS seed, CAST(value AS DOUBLE) AS final_score FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3 DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def upsert_latest(spark, sf_dir):
    """Users as designs that three upserts and a compaction leave, all events being rows of one of the upserts."""
    registry = Registry(spark, new_path(spark, "registry"))
    fixed = {c: F.lit("x") for c in ("modality", "pipeline", "config_hash", "sequence")} | {"length": F.lit(1), "target_id": F.col("event_type")}
    rows = _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("design_id"), "event_type", "event_id", "value").withColumns(fixed)
    rows = rows.withColumns({"stage": F.col("event_type"), "seed": F.col("event_id").cast("int"), "final_score": F.col("value").cast("double"), "_seq": F.col("event_id")})
    for turn in range(3):
        registry.upsert(rows.where(F.col("event_id") % 3 == turn))
        if turn == 1:
            registry.compact()
    return registry.read().select("design_id", "stage", F.col("seed").cast("long").alias("seed"), "final_score")


@query(
    "add_column",
    "SELECT c_custkey, c_name, NULL::VARCHAR AS stage FROM customer UNION ALL SELECT s_suppkey, s_name, 'late' FROM supplier",
)
def add_column(spark, sf_dir):
    """Rows of before and after a column was added."""
    old = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    new = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit("late").alias("stage"))
    return old.unionByName(new, allowMissingColumns=True)


@query(
    "threshold_report",
    f"""WITH {_CAND} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, key, threshold, value, pass FROM (
      SELECT *, 'quantity' AS key, 10.0::DOUBLE AS threshold, quantity::DOUBLE AS value, quantity >= 10 AS pass FROM cand
      UNION ALL SELECT *, 'discount', 0.02, discount, discount >= 0.02 FROM cand
      UNION ALL SELECT *, 'tax', 0.06, tax, tax <= 0.06 FROM cand
      UNION ALL SELECT *, 'price', NULL, price, NULL FROM cand)""",
)
def threshold_report(spark, sf_dir):
    rows = _candidates(spark, sf_dir)
    rows, values = metrics.bind(rows, F.col("low"), PROFILE)
    report = metrics.threshold_report(values, PROFILE, "screen")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.explode(report).alias("r")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "r.*")


@query(
    "threshold_pass",
    f"WITH {_CAND} SELECT l_returnflag, {_SCREEN} AS passed_screen, {_SELECT} AS passed_select, count(*) AS n FROM cand GROUP BY ALL",
)
def threshold_pass(spark, sf_dir):
    rows, values = metrics.bind(_candidates(spark, sf_dir), F.col("low"), PROFILE)
    level = lambda name: metrics.passes_level(values, F.col("agreeing"), PROFILE, name)
    rows = rows.select("l_returnflag", level("screen").alias("passed_screen"), level("select").alias("passed_select"))
    return rows.groupBy("l_returnflag", "passed_screen", "passed_select").agg(F.count("*").alias("n"))


@query(
    "threshold_replay",
    f"""WITH {_CAND} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus = 'F' AS claimed, {_SCREEN} AS recomputed,
      concat_ws(',', CASE WHEN quantity < 10 THEN 'quantity' END, CASE WHEN discount < 0.02 THEN 'discount' END, CASE WHEN tax > 0.06 THEN 'tax' END) AS failed
      FROM cand WHERE (l_linestatus = 'F') <> {_SCREEN}""",
)
def threshold_replay(spark, sf_dir):
    rows, values = metrics.bind(_candidates(spark, sf_dir).withColumn("claimed", F.col("l_linestatus") == "F"), F.col("low"), PROFILE)
    rows = rows.withColumn("recomputed", metrics.passes_level(values, F.col("agreeing"), PROFILE, "screen")).where("claimed <> recomputed")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "claimed", "recomputed", F.array_join(metrics.failed_keys(values, PROFILE, "screen"), ",").alias("failed"))


@query(
    "liability_scan",
    """SELECT doc_id, concat_ws(',', CASE WHEN contains(t, 'NG') THEN 'deamidation_NG' END, CASE WHEN contains(t, 'NS') THEN 'deamidation_NS' END,
      CASE WHEN contains(t, 'DG') THEN 'isomerization_DG' END, CASE WHEN regexp_matches(t, 'N[^P][ST]') THEN 'n_glycosylation' END, CASE WHEN contains(t, 'C') THEN 'cys_present' END) AS flags
      FROM (SELECT doc_id, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS t FROM documents)""",
)
def liability_scan(spark, sf_dir):
    rules = {"developability": {"forbid_motifs": ["NG", "NS", "DG"], "forbid_free_cys": True}}
    upper = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")  # ASCII only: upper() makes SS of one letter
    rows = _t(spark, sf_dir, "documents").select("doc_id", upper.alias("t"))
    return rows.select("doc_id", F.array_join(sequences.liability_flags(F.col("t"), rules), ",").alias("flags"))


@query("length_check", "SELECT doc_id, n_chars, length(text) AS n FROM documents WHERE n_chars <> length(text) OR length(text) NOT BETWEEN 50 AND 5000")
def length_check(spark, sf_dir):
    n = F.length("text").cast("long")
    return _t(spark, sf_dir, "documents").withColumn("n", n).where((F.col("n_chars") != n) | ~sequences.length_within(F.col("text"), 50, 5000)).select("doc_id", "n_chars", "n")


@query(
    "alphabet_check",
    """SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(string_split(text, '')), lambda c: c <> '' AND NOT contains('ACDEFGHIKLMNPQRSTVWY', c))), '') AS bad
       FROM documents WHERE len(list_filter(string_split(text, ''), lambda c: c <> '' AND NOT contains('ACDEFGHIKLMNPQRSTVWY', c))) > 0""",
)
def alphabet_check(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", sequences.illegal_characters(F.col("text")).alias("bad")).where("bad <> ''")


@query("cys_parity", "SELECT p_partkey, len(regexp_extract_all(p_type, 'C')) % 2 = 0 AS even FROM part")
def cys_parity(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", sequences.even_cysteines(F.col("p_type")).alias("even"))


@query(
    "turn_parents",
    """WITH c AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE length(text) >= 100)
       SELECT a.conv_id, a.turn FROM c a ANTI JOIN c b ON a.conv_id = b.conv_id AND a.turn - 1 = b.turn WHERE a.turn > 0""",
)
def turn_parents(spark, sf_dir):
    """Turns of some length whose turn before isn't: of these there are gaps."""
    c = _t(spark, sf_dir, "conversations").where(F.length("text") >= 100).select(F.struct("conv_id", "turn").alias("id"), F.when(F.col("turn") > 0, F.struct("conv_id", (F.col("turn") - 1).alias("turn"))).alias("parent"))
    return ancestry(c, "id", "parent").where("ends = 'orphan' and depth = 0").select("id.*")


@query(
    "agree_simple",
    "SELECT user_id, sum((m >= 50)::INT)::INT AS agreeing FROM (SELECT user_id, event_type, max(value) AS m FROM events GROUP BY ALL) GROUP BY user_id",
)
def agree_simple(spark, sf_dir):
    by = _t(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.max("value").alias("m"))
    maps = by.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", F.create_map(F.lit("i_pTM"), F.col("m"))))).alias("by"))  # a handful of event types
    return maps.select("user_id", metrics.agree_simple(F.col("by"), "i_pTM", 50.0).alias("agreeing"))


@query("json_extract", "SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_extract(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "labels").join(_t(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source"), "doc_id")


@query(
    "auc",
    """WITH b AS (SELECT n_chars AS x, quality AS y FROM labels JOIN documents USING (doc_id)), r AS (SELECT y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rk FROM b)
       SELECT round((sum(CASE WHEN y = 1 THEN rk END)::DOUBLE - sum(y)::DOUBLE * (sum(y) + 1) / 2) / (sum(y)::DOUBLE * (count(*) - sum(y))), 9) AS auc FROM r""",
)
def auc(spark, sf_dir):
    return stats.auc(_scored(spark, sf_dir), "n_chars", "quality").select(F.round("auc", 9).alias("auc"))


@query(
    "roc_curve",
    """WITH b AS (SELECT n_chars AS x, quality AS y FROM labels JOIN documents USING (doc_id)) SELECT DISTINCT x AS score,
       sum(y) OVER (ORDER BY x DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS tp, sum(1 - y) OVER (ORDER BY x DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS fp FROM b""",
)
def roc_curve(spark, sf_dir):
    return stats.roc_curve(_scored(spark, sf_dir), "n_chars", "quality")


@query(
    "enrichment",
    """WITH b AS (SELECT n_chars AS x, quality AS y FROM labels JOIN documents USING (doc_id)), base AS (SELECT avg(y) AS p FROM b)
       SELECT c AS cutoff, count(*) AS n, sum(y)::BIGINT AS hits, round(avg(y), 9) AS rate, round(avg(y) / any_value(p), 9) AS lift
       FROM b, base, (VALUES (500.0::DOUBLE), (1000.0), (2000.0), (4000.0), (1e9)) v(c) WHERE x >= c GROUP BY c""",
)
def enrichment(spark, sf_dir):
    rows = stats.enrichment(_scored(spark, sf_dir), "n_chars", "quality", [500.0, 1000.0, 2000.0, 4000.0, 1e9])
    return rows.select("cutoff", "n", "hits", F.round("rate", 9).alias("rate"), F.round("lift", 9).alias("lift"))


@query(
    "histogram",
    """WITH s AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi, count(*) AS total FROM documents)
       SELECT least(floor((n_chars - lo) / ((hi - lo) / 40))::INT, 39) + 1 AS bin, count(*) AS n, round(count(*) / (any_value(total) * any_value((hi - lo) / 40)), 12) AS density FROM documents, s GROUP BY bin""",
)
def histogram(spark, sf_dir):
    return stats.histogram(_t(spark, sf_dir, "documents"), "n_chars").select("bin", "n", F.round("density", 12).alias("density"))


@query(
    "describe_stats",
    """SELECT count(n_chars) AS n, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS std, min(n_chars) AS min, quantile_cont(n_chars, 0.25) AS q25,
       quantile_cont(n_chars, 0.5) AS q50, quantile_cont(n_chars, 0.75) AS q75, max(n_chars) AS max FROM documents""",
)
def describe_stats(spark, sf_dir):
    return stats.describe(_t(spark, sf_dir, "documents"), "n_chars").withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("medians", "SELECT quality, median(n_chars) AS median, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY quality")
def medians(spark, sf_dir):
    return stats.quantiles(_scored(spark, sf_dir), ["quality"], "n_chars", [0.5]).select("quality", F.col("quantile").alias("median"), F.col("total").alias("n"))


@query("method_leaderboard", "SELECT source, count(*) AS n, sum(quality)::BIGINT AS hits, round_even(avg(quality), 2) AS rate FROM labels JOIN documents USING (doc_id) WHERE source IS NOT NULL GROUP BY source")
def method_leaderboard(spark, sf_dir):
    return stats.leaderboard(_scored(spark, sf_dir), "source", "quality")


@query(
    "quota_round_robin",
    """SELECT o_orderkey, o_orderpriority, o_totalprice, turn::INT AS turn FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS turn FROM orders)
       ORDER BY turn, o_totalprice DESC, o_orderkey LIMIT 103""",
)
def quota_round_robin(spark, sf_dir):
    return rank.round_robin(_t(spark, sf_dir, "orders"), 103, "o_orderkey", "o_orderpriority", "o_totalprice").select("o_orderkey", "o_orderpriority", "o_totalprice", "turn")


@query(
    "elite_fraction",
    """SELECT o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rn, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) WHERE rn <= ceil(0.1 * n)""",
)
def elite_fraction(spark, sf_dir):
    return stats.top_share(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderstatus"], [-F.col("o_totalprice"), F.col("o_orderkey")], 0.1).select("o_orderkey", "o_orderstatus")


@query(
    "final_score",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(0.3 * l_discount + 0.2 * (1 / (1 + l_tax)) + 0.15 * (l_quantity / 100) + 0.15 * least(l_extendedprice / 1500, 1) + 0.1 * least((l_linenumber % 4) / 4.0, 1), 9) AS score FROM lineitem""",
)
def final_score(spark, sf_dir):
    names = {"i_ptm": "l_discount", "i_pae": "l_tax", "plddt": "l_quantity", "buried_sasa": "l_extendedprice"}
    low = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.col(v).cast("double"))])
    score = rank.final_score(F.col("low"), F.pmod("l_linenumber", F.lit(4)))
    return _t(spark, sf_dir, "lineitem").withColumn("low", metrics.lower_keys(low)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(score, 9).alias("score"))


@query("selectivity_score", "SELECT p_partkey, round(p_retailprice - greatest(p_size * 30.0, length(p_name) * 50.0), 6) AS srs FROM part")
def selectivity_score(spark, sf_dir):
    srs = metrics.selectivity(F.col("p_retailprice"), F.col("p_size") * 30.0, F.length("p_name") * 50.0)
    return _t(spark, sf_dir, "part").select("p_partkey", F.round(srs, 6).alias("srs"))


@query("local_identity")
def local_identity(spark, sf_dir):
    """Identity of every part's type with the first type by name: no SQL for it; tested against brute force."""
    parts = _t(spark, sf_dir, "part")
    first = parts.agg(F.min("p_type").alias("reference"))  # one row
    found = parts.join(F.broadcast(first)).select("p_partkey", align.identity(F.col("p_type"), F.col("reference")).alias("identity"))
    return found.select("p_partkey", "identity", (F.col("identity") < 0.30).alias("accepted"))


def _by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")


@query(
    "similar_pairs",
    """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)
       SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.2""",
)
def similar_pairs(spark, sf_dir):
    """All similar pairs of a label."""
    return rank.similar_pairs(_by_label(spark, sf_dir), ["label"], 0.2).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("leader_clusters")
def leader_clusters(spark, sf_dir):
    """Greedy leaders by the similarity of whole labels: iterative, tested against a plain loop."""
    return leaders.vector_leaders(_by_label(spark, sf_dir).withColumn("score", F.col("v")[0].cast("double")), ["label"], 0.2)


@query(
    "lineage_depth",
    """WITH RECURSIVE n AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 10 > 0 THEN (o_orderkey * o_orderkey + o_custkey) % (SELECT max(o_orderkey) + max(o_orderkey) // 5 FROM orders) END AS parent FROM orders),
       t AS (SELECT id, id AS root, 0::BIGINT AS depth, CASE WHEN parent IS NULL THEN 'root' ELSE 'orphan' END AS ends FROM n WHERE parent IS NULL OR parent NOT IN (SELECT id FROM n)
         UNION ALL SELECT n.id, t.root, t.depth + 1, t.ends FROM n JOIN t ON n.parent = t.id)
       SELECT id, root, depth, ends FROM t UNION ALL SELECT id, NULL, NULL, 'cycle' FROM n WHERE id NOT IN (SELECT id FROM t)""",
)
def lineage_depth(spark, sf_dir):
    """Orders with parents by a rule that makes chains, gaps and rings."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    span = o.agg((F.max("o_orderkey") + F.floor(F.max("o_orderkey") / 5)).alias("span"))  # one row
    parent = F.when(F.col("o_custkey") % 10 > 0, (F.col("o_orderkey") * F.col("o_orderkey") + F.col("o_custkey")) % F.col("span"))
    return ancestry(o.join(F.broadcast(span)).select(F.col("o_orderkey").alias("id"), parent.alias("parent")), "id", "parent")


@query(
    "linkage_cuts",
    """WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), c AS (SELECT unnest([0.30, 0.35, 0.45]::DOUBLE[]) AS cut),
       p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.v, b.v) AS s FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.3),
       r AS (SELECT cut, vec_id AS id, vec_id AS cluster FROM embeddings, c UNION SELECT r.cut, p.b, r.cluster FROM r JOIN p ON r.id = p.a AND p.s >= r.cut AND r.cluster < p.b)
       SELECT id, cut, min(cluster) AS cluster FROM r GROUP BY id, cut""",
)
def linkage_cuts(spark, sf_dir):
    """Single-linkage clusters of the vectors of a label at three similarities."""
    pairs = rank.similar_pairs(_by_label(spark, sf_dir), ["label"], 0.3, forest=True)
    return hierarchy.single_linkage(pairs, _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id")), [0.30, 0.35, 0.45])


@query("structure_pairs")
def structure_pairs(spark, sf_dir):
    """Vectors as traces of residues, three components a place: the similar ones of a label; tested against a plain loop."""
    whole = F.floor(F.size("embedding") / 3) * 3
    traces = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", F.slice("embedding", F.lit(1), whole.cast("int")).alias("xyz"))
    return structures.structure_pairs(traces.withColumn("xyz", F.transform("xyz", lambda v: v * 2.0)), 0.6, ("label",)).withColumn("similarity", F.round("similarity", 6))


@query(
    "novelty_mutations",
    """SELECT d.c_name AS sequence, min(levenshtein(d.c_name, k.c_name)) AS mutations FROM customer d, customer k
       WHERE d.c_acctbal >= 0 AND k.c_acctbal < 0 AND levenshtein(d.c_name, k.c_name) <= 2 GROUP BY d.c_name""",
)
def novelty_mutations(spark, sf_dir):
    """Names of customers within two edits of one whose balance is below zero."""
    c = _t(spark, sf_dir, "customer").select(F.col("c_name").alias("sequence"), "c_acctbal")
    return novelty.fewest_mutations(c.where("c_acctbal >= 0"), c.where("c_acctbal < 0"), 3)


@query(
    "novelty_identity",
    """WITH p AS (SELECT DISTINCT url, contains(url, '.com/') AS com FROM pages), i AS (SELECT d.url AS sequence, 1 - levenshtein(d.url, k.url) / greatest(length(d.url), length(k.url))::DOUBLE AS identity FROM p d, p k WHERE d.com AND NOT k.com)
       SELECT sequence, round(max(identity), 9) AS identity FROM i WHERE identity >= 0.85 GROUP BY sequence""",
)
def novelty_identity(spark, sf_dir):
    """Urls of one top domain by their likeness to those of the others."""
    p = _t(spark, sf_dir, "pages").select(F.col("url").alias("sequence"), F.col("url").contains(".com/").alias("com"))
    return novelty.greatest_identity(p.where("com"), p.where("not com"), 0.85).withColumn("identity", F.round("identity", 9))


@query("optimize_rounds")
def optimize_rounds(spark, sf_dir):
    """Three rounds of refinement from customers as peptides; seeded, tested by its invariants."""
    letters = F.translate(F.substring(F.md5("c_name"), 1, 20), "0123456789abcdef", "ACDEFGHIKLMNPQRS")
    pool = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("design_id"), letters.alias("sequence"), (F.col("c_acctbal") / 10000).alias("given"))
    return optimize.convergence(optimize.optimize(pool, optimize.OptimizeConfig(rounds=3))).withColumns({c: F.round(c, 9) for c in ("mean", "best")})


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as structures of 21 atoms, of which the first ten are side A."""
    e = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("structure"), F.col("embedding").alias("v"), F.explode(F.sequence(F.lit(0), F.lit(20))).alias("atom"))
    return e.select("structure", F.when(F.col("atom") < 10, "A").otherwise("B").alias("side"), F.col("atom").cast("long").alias("atom"), F.lit("C").alias("element"), *[(F.col("v")[F.col("atom") * 3 + i].cast("double") * 20).alias(c) for i, c in enumerate("xyz")])


@query(
    "interface_contacts",
    """WITH a AS (SELECT vec_id, i, embedding[3 * i + 1]::DOUBLE * 20 AS x, embedding[3 * i + 2]::DOUBLE * 20 AS y, embedding[3 * i + 3]::DOUBLE * 20 AS z FROM embeddings, range(21) r(i))
       SELECT p.vec_id AS structure, count(*) AS contacts FROM a p JOIN a q ON p.vec_id = q.vec_id AND p.i < 10 AND q.i >= 10 WHERE sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2 + (p.z - q.z) ** 2) <= 2.5 GROUP BY p.vec_id""",
)
def interface_contacts(spark, sf_dir):
    atoms = _places(spark, sf_dir)
    return contacts.count_contacts(contacts.contacts(atoms.where("side = 'A'"), atoms.where("side = 'B'"), 2.5))


@query("buried_surface")
def buried_surface(spark, sf_dir):
    """Exposed and buried area of every vector's atoms; tested on analytic spheres and a plain loop."""
    return surface.buried_surface(_places(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("exposed", "buried")})


@query("event_window_counts", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def event_window_counts(spark, sf_dir):
    rows = window_counts(_t(spark, sf_dir, "events"))
    return rows.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 6).alias("total"))


QUERIES |= audit_queries.QUERIES
ORACLE_SQL |= audit_queries.ORACLE_SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel's core: candidates by threshold verdict."""
    return threshold_pass(spark, sf_dir)
