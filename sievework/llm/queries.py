"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import ann, bpe, filter_audit, jaccard, mixing, pii, quality_model, quality_rules, simhash, toxicity, url_tree, warc
from sievework.llm import pipeline as stages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, targets and words taken of every document."""
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op5_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded text."""
    return bpe.encode_digests(_table(spark, sf_dir, "documents"))


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as normalised archives and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op6_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return url_tree.judge(_table(spark, sf_dir, "pages"), url_tree.RULES)


def op9_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose id is divisible by 20."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by a model trained on the labelled ones."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op2_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    docs = _table(spark, sf_dir, "documents")
    return quality_model.rate(docs, quality_model.train(docs, _table(spark, sf_dir, "labels")))


def op10_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of personal data in every document."""
    return pii.find(_table(spark, sf_dir, "documents"), pii.train())


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove at every step of every order, by source."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of word 4-shingles and component of every document."""
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages over all documents."""
    return stages.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op12_jaccard_components": op12_jaccard_components,
    "op11_filter_audit": op11_filter_audit,
    "op10_pii_crf": op10_pii_crf,
    "op2_ordinal_quality": op2_ordinal_quality,
    "op8_toxicity_cnn": op8_toxicity_cnn,
    "op9_ann_search": op9_ann_search,
    "op6_url_templates": op6_url_templates,
    "op1_quality_rules": op1_quality_rules,
    "op3_warc_round_trip": op3_warc_round_trip,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_simhash_components": op5_simhash_components,
    "op7_mix_sources": op7_mix_sources,
}

#: The same words, windows, sketches and thresholds in plain SQL.
_OP1_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT *, list_filter(string_split(translate(t, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: translate(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') <> '') AS l
  FROM texts
), places AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS p, w FROM split WHERE len(w) > 2
), windows AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, w[p], w[p + 1], w[p + 2]) AS n FROM places
), repeats AS (
  SELECT r, count(DISTINCT p + k) AS n FROM windows, (SELECT unnest(range(0, 3)) AS k) WHERE n > 1 GROUP BY r
), counts AS (
  SELECT doc_id, lang, source, len(w) AS n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(repeats.n, 0) AS n_repeat_words
  FROM split LEFT JOIN repeats USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [1000 * word_chars // greatest(n_words, 1), 1000 * n_symbols // greatest(word_chars, 1), 1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1)] AS x
  FROM counts
), bucketed AS (
  SELECT *, list_transform(x, lambda v: CASE WHEN v > 0 THEN floor(ln(v) / ln(1.02::DOUBLE))::INT ELSE -1 END) AS b FROM judged
), cells AS (
  SELECT lang, source, unnest([1, 2, 3, 4]) AS m, unnest(b) AS b FROM bucketed WHERE NOT base_failed
), own AS (
  SELECT lang, source, m, count(*) AS n, list_sort(list(b)) AS s FROM cells GROUP BY ALL
), of_lang AS (
  SELECT lang, m, count(*) AS n, list_sort(list(b)) AS s FROM cells GROUP BY ALL
), of_all AS (
  SELECT m, count(*) AS n, list_sort(list(b)) AS s FROM cells GROUP BY ALL
), q_all AS (
  SELECT m, s[(len(s) + 3) // 4] AS q1, s[(3 * len(s) + 3) // 4] AS q3, s[(9 * len(s) + 9) // 10] AS qu FROM of_all
), q_lang AS (
  SELECT lang, l.m, floor((l.n * s[(l.n + 3) // 4] + 200 * a.q1) / (l.n + 200))::INT AS q1, floor((l.n * s[(3 * l.n + 3) // 4] + 200 * a.q3) / (l.n + 200))::INT AS q3,
    floor((l.n * s[(9 * l.n + 9) // 10] + 200 * a.qu) / (l.n + 200))::INT AS qu
  FROM of_lang l JOIN q_all a ON l.m = a.m
), q_own AS (
  SELECT o.lang, source, o.m, floor((o.n * s[(o.n + 3) // 4] + 200 * l.q1) / (o.n + 200))::INT AS q1, floor((o.n * s[(3 * o.n + 3) // 4] + 200 * l.q3) / (o.n + 200))::INT AS q3,
    floor((o.n * s[(9 * o.n + 9) // 10] + 200 * l.qu) / (o.n + 200))::INT AS qu
  FROM own o JOIN q_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.m = l.m
), fences AS (
  SELECT lang, source, max(CASE WHEN m = 1 THEN q1 - 6 * (q3 - q1 + 1) END) AS low, max(CASE WHEN m = 1 THEN q3 + 6 * (q3 - q1 + 1) END) AS high,
    list(CASE WHEN qu < 0 THEN 0 ELSE pow(1.02::DOUBLE, qu + 1) END ORDER BY m) AS rate
  FROM q_own GROUP BY ALL
), expected AS (
  SELECT d.*, low, high, 1 + rate[2] * word_chars / 1000 AS e_symbols, 1 + rate[3] * n_lines / 1000 AS e_lines, 1 + rate[4] * n_words / 6000 AS e_windows
  FROM bucketed d LEFT JOIN fences f ON d.lang IS NOT DISTINCT FROM f.lang AND d.source IS NOT DISTINCT FROM f.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(b[1] BETWEEN low AND high AND n_symbols <= e_symbols + 6 * sqrt(e_symbols) AND n_dup_lines <= e_lines + 6 * sqrt(e_lines)
    AND n_repeat_words / 6 <= e_windows + 6 * sqrt(e_windows), TRUE) AS kept
FROM expected
"""

#: SHA-1 in base32: five hexadecimal digits make four characters.
_OP3_SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), named AS (
  SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY h) AS head,
    array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda j:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(h, 1 + 5 * i, 5))::INTEGER >> (15 - 5 * j)) % 32, 1)), '')), '') AS payload_digest
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = head THEN NULL ELSE head END AS refers_to
FROM named
"""

#: Every step of every order, from the documents' bits.
_OP11_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), firsts AS (
  SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t
), split AS (
  SELECT doc_id, part, t, first_id, list_filter(string_split(translate(t, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda x: x <> '') AS w
  FROM texts JOIN firsts USING (t)
), told AS (
  SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic FROM labels GROUP BY doc_id
), bits AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, MAP {
    'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w),
    'C': 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > first_id, FALSE)} AS f
  FROM split LEFT JOIN told USING (doc_id)
), cells AS (
  SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM bits GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, s::INT AS step, substr(filter_order, s, 1) AS filter, string_split(substr(filter_order, 1, s - 1), '') AS earlier FROM orders, range(1, 6) r(s)
), met AS (
  SELECT part, filter_order, step, filter, n, good, toxic, f[filter] AS fails, coalesce(list_bool_or(list_transform(earlier, lambda x: coalesce(f[x], FALSE))), FALSE) AS gone,
    len(list_filter(map_values(f), lambda v: v)) AS failed FROM cells, steps
), counted AS (
  SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails AND failed = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley, filter FROM counted
"""

ORACLE_SQL: dict[str, str] = {
    "op11_filter_audit": _OP11_SQL,
    "op1_quality_rules": _OP1_SQL,
    "op3_warc_round_trip": _OP3_SQL,
}
