"""The jobs as queries over whole tables, each run twice into one new folder, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobs import intake_texts, screen_candidates
from sievework.plans.shared import new_path


def job1_screen_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortlists of all targets after two runs."""
    output = new_path(spark, "job1")
    for _ in range(2):
        written = screen_candidates.run(spark, sf_dir, output, screen_candidates.load_config())
    return written


def job2_intake_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts taken in by two runs over one checkpoint; the second finds nothing new."""
    place, texts = new_path(spark, "job2"), f"{sf_dir}/documents.parque[t]"  # a pattern: the table may be one file, which a file stream takes by pattern only
    for _ in range(2):
        written = intake_texts.run(spark, texts, f"{place}/out", f"{place}/checkpoint", intake_texts.load_config())
    return written


QUERIES = {"job1_screen_candidates": job1_screen_candidates, "job2_intake_texts": job2_intake_texts}

ORACLE_SQL = {
    "job1_screen_candidates": """
WITH c AS (
  SELECT coalesce(o_orderpriority, 'none') AS target, coalesce(p_brand, 'none') AS cluster, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    coalesce(l_quantity >= 10, TRUE) AND coalesce(l_discount >= 0.02, TRUE) AND coalesce(l_tax <= 0.06, TRUE) AND l_linenumber % 4 >= 2 AS s1,
    coalesce(l_quantity >= 25, TRUE) AND coalesce(l_discount >= 0.04, TRUE) AND coalesce(l_tax <= 0.03, TRUE) AND coalesce(l_extendedprice >= 20000, TRUE) AND l_linenumber % 4 >= 2 AS s2,
    round(0.3 * l_discount + 0.2 * (1 / (1 + l_tax)) + 0.15 * (l_quantity / 100) + 0.15 * least(l_extendedprice / 1500, 1) + 0.1 * least((l_linenumber % 4) / 4.0, 1), 9) AS score
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
), n AS (
  SELECT target, cluster, count(*) AS candidates, count(*) FILTER (s1) AS screened, count(*) FILTER (s1 AND s2) AS passed FROM c GROUP BY ALL
), b AS (
  SELECT *, row_number() OVER (PARTITION BY target, cluster ORDER BY score DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS place FROM c WHERE s1 AND s2
)
SELECT n.cluster, candidates, screened, passed, coalesce(place, 0)::INT AS place, l_orderkey, l_linenumber, l_partkey, l_suppkey, score, n.target
FROM n LEFT JOIN (SELECT * FROM b WHERE place <= 3) b ON n.target = b.target AND n.cluster = b.cluster
""",
    "job2_intake_texts": """
WITH t AS (
  SELECT doc_id, source, n_chars, coalesce(text, '') AS t, translate(coalesce(text, ''), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS u FROM documents
), f AS (
  SELECT *, concat_ws(',', CASE WHEN contains(u, 'NG') THEN 'deamidation_NG' END, CASE WHEN contains(u, 'NS') THEN 'deamidation_NS' END, CASE WHEN contains(u, 'DG') THEN 'isomerization_DG' END,
    CASE WHEN regexp_matches(u, 'N[^P][ST]') THEN 'n_glycosylation' END, CASE WHEN contains(u, 'C') THEN 'cys_present' END) AS flags,
    row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS place, first_value(doc_id) OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS first FROM t
)
SELECT doc_id, source, sha256(t) AS content, n_chars, length(t) AS length, flags, CASE WHEN place > 1 THEN first END AS first_id, 0::BIGINT AS batch,
  CASE WHEN place > 1 THEN 'duplicate' WHEN n_chars IS DISTINCT FROM length(t) OR length(t) NOT BETWEEN 50 AND 5000 THEN 'blocked' WHEN flags <> '' THEN 'flagged' ELSE 'clean' END AS status
FROM f
""",
}
