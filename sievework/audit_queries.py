"""The audit's rules, file scans and reports as queries: designs, files and runs are made from the driver's tables by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework import schema
from sievework.functions import sequences
from sievework.operators import rules
from sievework.plans import export
from sievework.plans.provenance import verify_entries
from sievework.plans.review import Report
from sievework.plans.shared import materialize, new_path
from sievework.sources import files
from sievework.sources.registry import Registry, decode

QUERIES: dict[str, object] = {}
ORACLE_SQL: dict[str, str] = {}
TARGET = "T"
PROFILE = {
    "folding_confidence": {"i_pTM": {"screen": 0.5, "select": 0.8}, "cross_predictor": {"min_agreeing": 1}},
    "interface_physics": {"interface_energy": {"screen": 40000, "select": 20000}},
    "diversity": {"max_per_cluster": 20},
}
_DECODED = {"metrics": "map<string,double>", "liability_flags": "array<string>", "artifact_hashes": "map<string,string>", "predictor_outputs": "map<string,string>"}


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


def _designs(rows: DataFrame, **columns: Column) -> DataFrame:
    """Decoded designs of some columns; all others are empty."""
    blank = {f.name: F.lit(None).cast(_DECODED.get(f.name, f.dataType.simpleString())) for f in schema.DESIGNS}
    blank |= {c: F.from_json(F.lit("{}" if t.startswith("map") else "[]"), t) for c, t in _DECODED.items()} | {"target_id": F.lit(TARGET), "metric_names": F.array().cast("array<string>")}
    return rows.select(*[columns.get(n, c).alias(n) for n, c in blank.items()])


def _context(spark: SparkSession, designs: DataFrame, runs: DataFrame | None = None, **more) -> rules.Context:
    none = spark.createDataFrame([], schema.MANIFEST).withColumn("run_dir", F.lit(None).cast("string"))
    return rules.Context(spark, TARGET, designs, none if runs is None else runs, **more)


def _told(findings: DataFrame) -> DataFrame:
    return findings.select("rule_id", "severity", "design_id", "artifact", "expected", "actual")


#: Orders as designs; every check has some that fail it.
_ORDERS = """d AS (SELECT o_orderkey, o_custkey, o_orderkey::VARCHAR AS design_id, CASE WHEN o_custkey % 97 = 0 THEN 'U' ELSE 'T' END AS target_id,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'BindCraft-2' ELSE 'diffusion' END AS pipeline, CASE o_custkey % 3 WHEN 0 THEN 'pyrosetta-dependent' WHEN 1 THEN 'permissive' END AS licence,
  o_orderstatus AS config_hash, CASE WHEN o_custkey % 10 > 0 THEN ((o_orderkey * o_orderkey + o_custkey) % (SELECT max(o_orderkey) + max(o_orderkey) // 5 FROM orders))::VARCHAR END AS parent_id,
  o_orderpriority AS sequence, CASE WHEN o_custkey % 5 = 0 THEN 3 ELSE length(o_orderpriority) END AS length,
  CASE o_custkey % 4 WHEN 1 THEN 'part.parquet' WHEN 2 THEN 'none.pdb' END AS structure_path, CASE WHEN o_custkey % 6 < 3 THEN 'validate' ELSE 'generate' END AS stage,
  CASE WHEN o_custkey % 8 > 0 THEN o_totalprice / 200000 END AS iptm, o_totalprice % 50000 AS energy, (o_custkey % 3)::INT AS agreeing, o_custkey % 2 = 0 AS passed_screen, o_custkey % 7 = 0 AS passed_select,
  o_custkey % 11 = 0 AS selected, CASE WHEN o_custkey % 5 > 0 THEN (o_custkey % 40)::INT END AS cluster_id FROM orders)"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, n = _t(spark, sf_dir, "orders"), lambda k: F.col("o_custkey") % k
    span = o.agg((F.max("o_orderkey") + F.floor(F.max("o_orderkey") / 5)).alias("span"))  # one row
    metrics = F.map_filter(F.create_map(F.lit("iPTM"), F.when(n(8) > 0, F.col("o_totalprice") / 200000), F.lit("interface_energy"), F.col("o_totalprice") % 50000), lambda k, v: v.isNotNull())
    return _designs(
        o.join(F.broadcast(span)), design_id=F.col("o_orderkey").cast("string"), target_id=F.when(n(97) == 0, "U").otherwise("T"),
        pipeline=F.when(F.col("o_orderpriority").like("1%"), "BindCraft-2").otherwise("diffusion"), toolchain_license=F.when(n(3) == 0, rules.LICENSED).when(n(3) == 1, "permissive"),
        config_hash=F.col("o_orderstatus"), parent_id=F.when(n(10) > 0, ((F.col("o_orderkey") * F.col("o_orderkey") + F.col("o_custkey")) % F.col("span")).cast("string")),
        sequence=F.col("o_orderpriority"), length=F.when(n(5) == 0, 3).otherwise(F.length("o_orderpriority")), structure_path=F.when(n(4) == 1, "part.parquet").when(n(4) == 2, "none.pdb"),
        stage=F.when(n(6) < 3, "validate").otherwise("generate"), metrics=metrics, metric_names=F.when(n(9) == 0, F.array(F.lit("sc"), F.lit("i_pTM"))).otherwise(F.array(F.lit("i_pTM"))),
        predictors_agreeing=n(3).cast("int"), passed_screen=n(2) == 0, passed_select=n(7) == 0, selected=n(11) == 0, cluster_id=F.when(n(5) > 0, n(40).cast("int")),
    )


@query(
    "rule_lineage",
    f"""WITH RECURSIVE {_ORDERS}, up AS (SELECT design_id FROM d WHERE parent_id IS NULL OR parent_id NOT IN (SELECT design_id FROM d) UNION SELECT d.design_id FROM d JOIN up ON d.parent_id = up.design_id)
       SELECT 'R1' AS rule_id, 'BLOCK' AS severity, design_id, NULL::VARCHAR AS artifact, 'hash of a configuration' AS expected, config_hash AS actual FROM d WHERE config_hash NOT IN ('F', 'O')
       UNION ALL SELECT 'R1', 'BLOCK', design_id, NULL, 'T', target_id FROM d WHERE target_id <> 'T'
       UNION ALL SELECT 'R1', 'BLOCK', design_id, NULL, 'a registered design_id', parent_id FROM d WHERE parent_id NOT IN (SELECT design_id FROM d)
       UNION ALL SELECT 'R1', 'BLOCK', design_id, NULL, 'a first ancestor', NULL FROM d WHERE design_id NOT IN (SELECT design_id FROM up)""",
)
def rule_lineage(spark, sf_dir):
    return _told(rules.lineage(_context(spark, _orders(spark, sf_dir), hashes={"F": "f.yaml", "O": "o.yaml"})))


@query(
    "rule_sequence",
    f"""WITH {_ORDERS}, b AS (SELECT *, array_to_string(list_sort(list_filter(list_distinct(string_split(sequence, '')), lambda c: c <> '' AND NOT contains('ACDEFGHIKLMNPQRSTVWY', c))), '') AS bad FROM d)
       SELECT 'R2' AS rule_id, 'BLOCK' AS severity, design_id, NULL::VARCHAR AS artifact, length(sequence)::VARCHAR AS expected, length::VARCHAR AS actual FROM b WHERE length <> length(sequence)
       UNION ALL SELECT 'R2', 'BLOCK', design_id, NULL, '20 natural amino acids', bad FROM b WHERE bad <> ''
       UNION ALL SELECT 'R2', 'BLOCK', design_id, NULL, '6-9 aa', length(sequence)::VARCHAR || ' aa' FROM b WHERE length(sequence) NOT BETWEEN 6 AND 9""",
)
def rule_sequence(spark, sf_dir):
    return _told(rules.sequence(_context(spark, _orders(spark, sf_dir), target={"modality": {"binder_length": [6, 9]}})))


@query(
    "rule_structure",
    f"""WITH {_ORDERS} SELECT 'R3' AS rule_id, 'BLOCK' AS severity, design_id, NULL::VARCHAR AS artifact, 'path of a pdb or cif file' AS expected, 'None' AS actual FROM d WHERE structure_path IS NULL AND (stage = 'validate' OR passed_screen)
       UNION ALL SELECT 'R3', 'BLOCK', design_id, structure_path, 'a file', 'missing' FROM d WHERE structure_path = 'none.pdb'
       UNION ALL SELECT 'R3', 'BLOCK', design_id, structure_path, '.pdb/.cif', '.parquet' FROM d WHERE structure_path = 'part.parquet'""",
)
def rule_structure(spark, sf_dir):
    return _told(rules.structure(_context(spark, _orders(spark, sf_dir), bases=["/nowhere", sf_dir])))


@query(
    "rule_thresholds",
    f"""WITH {_ORDERS}, p AS (SELECT *, coalesce(iptm >= 0.5, TRUE) AS i1, coalesce(iptm >= 0.8, TRUE) AS i2, energy <= 40000 AS e1, energy <= 20000 AS e2, agreeing >= 1 AS a FROM d),
       q AS (SELECT design_id, passed_screen AS claim, i1 AND e1 AND a AS now, concat_ws(', ', CASE WHEN NOT i1 THEN 'i_pTM' END, CASE WHEN NOT e1 THEN 'interface_energy' END) AS failed FROM p
         UNION ALL SELECT design_id, passed_select, i2 AND e2 AND a, concat_ws(', ', CASE WHEN NOT i2 THEN 'i_pTM' END, CASE WHEN NOT e2 THEN 'interface_energy' END) FROM p)
       SELECT 'R6' AS rule_id, 'BLOCK' AS severity, design_id, NULL::VARCHAR AS artifact, CASE WHEN now THEN 'True' ELSE 'False' END || CASE WHEN failed <> '' THEN ', failed: ' || failed ELSE '' END AS expected,
         CASE WHEN claim THEN 'True' ELSE 'False' END AS actual FROM q WHERE claim <> now""",
)
def rule_thresholds(spark, sf_dir):
    return _told(rules.threshold_replay(_context(spark, _orders(spark, sf_dir), profile=PROFILE)))


@query(
    "rule_licence",
    f"""WITH {_ORDERS} SELECT 'R8' AS rule_id, 'WARN' AS severity, design_id, NULL::VARCHAR AS artifact, NULL::VARCHAR AS expected, NULL::VARCHAR AS actual FROM d WHERE licence IS NULL
       UNION ALL SELECT 'R8', 'BLOCK', design_id, NULL, 'pyrosetta-dependent', licence FROM d WHERE pipeline = 'BindCraft-2' AND licence <> 'pyrosetta-dependent'
       UNION ALL SELECT 'R8', 'BLOCK', design_id, NULL, 'permissive', licence FROM d WHERE pipeline <> 'BindCraft-2' AND licence = 'pyrosetta-dependent'
       UNION ALL SELECT 'R8', 'BLOCK', design_id, 'sc', NULL, NULL FROM d WHERE o_custkey % 9 = 0""",
)
def rule_licence(spark, sf_dir):
    return _told(rules.licence(_context(spark, _orders(spark, sf_dir), profile=PROFILE)))


@query(
    "rule_quota",
    f"""WITH {_ORDERS}, s AS (SELECT * FROM d WHERE selected)
       SELECT 'R11' AS rule_id, 'BLOCK' AS severity, design_id, NULL::VARCHAR AS artifact, NULL::VARCHAR AS expected, NULL::VARCHAR AS actual FROM s WHERE cluster_id IS NULL
       UNION ALL SELECT 'R11', 'BLOCK', NULL, NULL, '<= 50', count(*)::VARCHAR FROM s HAVING count(*) > 50
       UNION ALL SELECT 'R11', 'BLOCK', NULL, NULL, '<= 20', count(*)::VARCHAR FROM s GROUP BY cluster_id HAVING count(*) > 20""",
)
def rule_quota(spark, sf_dir):
    return _told(rules.quota(_context(spark, _orders(spark, sf_dir), profile=PROFILE, quota=50)))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as runs."""
    known = {"run_id": F.col("n_name"), "stage": F.when(F.col("n_nationkey") % 3 == 0, "export").otherwise("rank"), "code_rev": F.when(F.col("n_nationkey") % 4 > 0, "abc"), "code_dirty": F.col("n_nationkey") % 5 == 0}
    return _t(spark, sf_dir, "nation").select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.MANIFEST], F.lit(None).cast("string").alias("run_dir"))


@query(
    "rule_code_pin",
    """WITH r AS (SELECT *, CASE WHEN n_nationkey % 3 = 0 THEN 'BLOCK' ELSE 'WARN' END AS severity FROM nation)
       SELECT 'R10' AS rule_id, severity, NULL::VARCHAR AS design_id, 'run ' || n_name AS artifact, NULL::VARCHAR AS expected, NULL::VARCHAR AS actual FROM r WHERE n_nationkey % 4 = 0
       UNION ALL SELECT 'R10', severity, NULL, 'run ' || n_name, 'code_dirty=false', 'true' FROM r WHERE n_nationkey % 5 = 0""",
)
def rule_code_pin(spark, sf_dir):
    return _told(rules.code_pin(_context(spark, _orders(spark, sf_dir).limit(0), _runs(spark, sf_dir))))


_TEXTS = "x AS (SELECT text, min(doc_id)::VARCHAR AS first, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as selected designs; ids are kept as numbers of equal width so that the smallest is first as text."""
    return _designs(_t(spark, sf_dir, "documents"), design_id=F.lpad(F.col("doc_id").cast("string"), 20, "0"), sequence=F.col("text"), selected=F.lit(True))


@query(
    "rule_duplicates",
    f"WITH {_TEXTS} SELECT 'R13' AS rule_id, 'WARN' AS severity, lpad(first, 20, '0') AS design_id, NULL::VARCHAR AS artifact, 'once' AS expected, n::VARCHAR || ' times: ' || text AS actual FROM x",
)
def rule_duplicates(spark, sf_dir):
    return _told(rules.duplicates(_context(spark, _texts(spark, sf_dir))))


@query("duplicates", f"WITH {_TEXTS} SELECT lpad(doc_id::VARCHAR, 20, '0') AS design_id, lpad(first, 20, '0') AS first_id, n FROM documents JOIN x USING (text)")
def duplicates(spark, sf_dir):
    """Every text that occurs more than once, with its first id and how often it does."""
    return rules.repeated(_texts(spark, sf_dir)).select("design_id", "first_id", "n")


# Files: suppliers have predictor outputs, structures and artifacts of their own, written by Spark.

_SUPPLIERS = """s AS (SELECT s_suppkey, s_suppkey::VARCHAR AS design_id, s_acctbal / 10000 AS iptm, s_nationkey / 10.0 AS rmsd, translate(s_suppkey::VARCHAR, '0123456789', 'ACDEFGHIKL') || 'GGS' AS sequence FROM supplier)"""


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.concat(F.translate(F.col("s_suppkey").cast("string"), "0123456789", "ACDEFGHIKL"), F.lit("GGS"))
    return _t(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").cast("string").alias("design_id"), (F.col("s_acctbal") / 10000).alias("iptm"), (F.col("s_nationkey") / 10.0).alias("rmsd"), letters.alias("sequence"))


def _outputs(spark: SparkSession, sf_dir: str) -> rules.Context:
    """Suppliers with two predictors each: nested JSON, one of them sometimes lost or without any metric."""
    s, folder = _suppliers(spark, sf_dir), new_path(spark, "outputs")
    inner = F.struct(F.col("iptm").alias("i-pTM"), F.lit("0.1").alias("pLDDT"), F.array(F.struct(F.col("rmsd").alias("RMSD"))).alias("more"))
    text = {"one": F.to_json(F.struct(F.lit("x").alias("name"), F.struct(F.lit(9.0).alias("iptm_rank"), inner.alias("summary")).alias("deep"))), "two": F.when(F.col("s_suppkey") % 7 == 0, "[1]").otherwise(F.to_json(F.struct((F.col("iptm") / 2).alias("iPTM"))))}
    there = {"one": F.lit(True), "two": F.col("s_suppkey") % 5 > 0}
    named = {p: F.concat(F.lit(f"{p}-"), "design_id", F.lit(".json")) for p in text}
    for p in text:
        files.write_texts(s.where(there[p]).select(named[p].alias("name"), text[p].alias("text")), folder)
    some = F.col("s_suppkey") % 10 > 0
    return _context(
        spark,
        materialize(_designs(s, design_id=F.col("design_id"), stage=F.when(F.col("s_suppkey") % 20 == 0, "rank"), predictors_agreeing=F.lit(2), passed_screen=F.col("s_suppkey") % 3 == 0,
                             metrics=F.create_map(F.lit("i_pTM"), F.when(F.col("s_suppkey") % 4 == 0, F.col("iptm") + 0.01).otherwise(F.col("iptm")), F.lit("RMSD"), F.col("rmsd")),
                             predictor_outputs=F.when(some, F.create_map(F.lit("one"), named["one"], F.lit("two"), named["two"])).otherwise(F.from_json(F.lit("{}"), "map<string,string>"))), "supplier-designs"),
        profile=PROFILE, bases=["/nowhere", folder],
    )


@query(
    "rule_metrics",
    f"""WITH {_SUPPLIERS}, m AS (SELECT *, CASE WHEN s_suppkey % 4 = 0 THEN iptm + 0.01 ELSE iptm END AS recorded FROM s WHERE s_suppkey % 10 > 0)
       SELECT 'R5' AS rule_id, CASE WHEN s_suppkey % 20 = 0 THEN 'WARN' ELSE 'INFO' END AS severity, design_id, NULL::VARCHAR AS artifact, NULL::DOUBLE AS expected, NULL::DOUBLE AS actual FROM s WHERE s_suppkey % 10 = 0
       UNION ALL SELECT 'R5', 'WARN', design_id, 'two-' || design_id || '.json', NULL, NULL FROM m WHERE s_suppkey % 5 = 0
       UNION ALL SELECT 'R5', 'BLOCK', design_id, 'one-' || design_id || '.json', round(iptm, 9), round(recorded, 9) FROM m WHERE abs(recorded - iptm) > 0.001
       UNION ALL SELECT 'R5', 'BLOCK', design_id, 'two-' || design_id || '.json', round(iptm / 2, 9), round(recorded, 9) FROM m WHERE s_suppkey % 5 > 0 AND s_suppkey % 7 > 0 AND abs(recorded - iptm / 2) > 0.001""",
)
def rule_metrics(spark, sf_dir):
    found = _told(rules.recomputed_metrics(_outputs(spark, sf_dir)))
    return found.withColumns({c: F.round(F.col(c).cast("double"), 9) for c in ("expected", "actual")})


@query(
    "rule_predictors",
    f"""WITH {_SUPPLIERS}, m AS (SELECT *, (iptm >= 0.5)::INT + (s_suppkey % 5 > 0 AND s_suppkey % 7 > 0 AND iptm / 2 >= 0.5)::INT AS agreeing FROM s WHERE s_suppkey % 10 > 0)
       SELECT 'R7' AS rule_id, 'BLOCK' AS severity, design_id, NULL::VARCHAR AS artifact, agreeing::VARCHAR AS expected, '2' AS actual FROM m WHERE agreeing <> 2
       UNION ALL SELECT 'R7', 'BLOCK', design_id, NULL, '>= 1', agreeing::VARCHAR FROM m WHERE agreeing < 1 AND s_suppkey % 3 = 0""",
)
def rule_predictors(spark, sf_dir):
    return _told(rules.cross_predictor(_outputs(spark, sf_dir)))


@query("predictor_scan", f"""WITH {_SUPPLIERS} SELECT design_id, 'one' AS predictor, TRUE AS found, unnest(['iptm', 'rmsd']) AS metric, unnest([round(iptm, 9), round(rmsd, 9)]) AS value FROM s WHERE s_suppkey % 10 > 0
       UNION ALL SELECT design_id, 'two', s_suppkey % 5 > 0, CASE WHEN s_suppkey % 5 > 0 AND s_suppkey % 7 > 0 THEN 'iptm' END, CASE WHEN s_suppkey % 5 > 0 AND s_suppkey % 7 > 0 THEN round(iptm / 2, 9) END FROM s WHERE s_suppkey % 10 > 0""")  # fmt: skip
def predictor_scan(spark, sf_dir):
    """Metrics of nested predictor files, level by level."""
    rows = _outputs(spark, sf_dir).parsed()
    return rows.select("design_id", "predictor", F.col("found").isNotNull().alias("found"), F.explode_outer("values").alias("metric", "value")).withColumn("value", F.round("value", 9))


@query(
    "rule_structure_sequence",
    f"""WITH {_SUPPLIERS} SELECT 'R4' AS rule_id, 'INFO' AS severity, design_id, design_id || '.pdb' AS artifact, NULL::VARCHAR AS expected, NULL::VARCHAR AS actual FROM s WHERE s_suppkey % 6 = 0
       UNION ALL SELECT 'R4', 'BLOCK', design_id, design_id || '.pdb', sequence, reverse(sequence) FROM s WHERE s_suppkey % 6 = 1 AND sequence <> reverse(sequence)
       UNION ALL SELECT 'R4', 'BLOCK', design_id, design_id || '.pdb', NULL, NULL FROM s WHERE s_suppkey % 6 = 2""",
)
def rule_structure_sequence(spark, sf_dir):
    """Structures with the binder's chain, some reversed, some with a residue of no letter, some without atoms."""
    s, folder = _suppliers(spark, sf_dir), new_path(spark, "structures")
    names = F.create_map(*[F.lit(x) for name, letter in files.RESIDUES.items() for x in (letter, name)])
    shown = F.when(F.col("s_suppkey") % 6 == 1, F.reverse("sequence")).otherwise(F.col("sequence"))
    named = F.transform(F.split(shown, ""), lambda c: F.coalesce(F.try_element_at(names, c), F.lit("UNK")))
    named = F.when(F.col("s_suppkey") % 6 == 0, F.concat(named, F.array(F.lit("MSE")))).otherwise(named)
    line = lambda name, i: F.format_string("ATOM  %5d  CA  %s B%4d    %8.3f%8.3f%8.3f", i + 1, name, i + 1, i * 1.5, F.lit(0.0), F.lit(1.0))
    atoms = F.array_join(F.transform(named, line), "\n")
    text = F.when(F.col("s_suppkey") % 6 == 2, "REMARK nothing").otherwise(F.concat(atoms, F.lit("\nEND\n")))
    files.write_texts(s.select(F.concat("design_id", F.lit(".pdb")).alias("name"), text.alias("text")), folder)
    designs = _designs(s, design_id=F.col("design_id"), sequence=F.col("sequence"), structure_path=F.concat("design_id", F.lit(".pdb")))
    return _told(rules.sequence_of_structure(_context(spark, designs, bases=[folder])))


@query(
    "rule_hashes",
    """WITH s AS (SELECT s_suppkey, s_suppkey::VARCHAR AS design_id, s_suppkey::VARCHAR || '.txt' AS artifact, sha256(s_name) AS had, sha256(s_name || 'x') AS has FROM supplier)
       SELECT 'R9' AS rule_id, 'BLOCK' AS severity, design_id, artifact, had AS expected, 'missing' AS actual FROM s WHERE s_suppkey % 5 = 0
       UNION ALL SELECT 'R9', 'BLOCK', design_id, artifact, had, has FROM s WHERE s_suppkey % 5 > 0 AND s_suppkey % 7 = 0""",
)
def rule_hashes(spark, sf_dir):
    """Files hashed by executors; some are lost, some were changed."""
    s, folder = _t(spark, sf_dir, "supplier"), new_path(spark, "artifacts")
    name, key = F.concat(F.col("s_suppkey").cast("string"), F.lit(".txt")), F.col("s_suppkey")
    files.write_texts(s.where(key % 5 > 0).select(name.alias("name"), F.when(key % 7 == 0, F.concat("s_name", F.lit("x"))).otherwise(F.col("s_name")).alias("text")), folder)
    designs = _designs(s, design_id=key.cast("string"), artifact_hashes=F.create_map(name, F.sha2("s_name", 256)))
    return _told(rules.hashes(_context(spark, designs, bases=[folder])))


@query(
    "rule_package",
    """WITH f AS (SELECT DISTINCT p_name || p_type AS s FROM part WHERE p_size <= 30), c AS (SELECT DISTINCT p_name || p_type AS s FROM part WHERE p_size > 10)
       SELECT 'R12' AS rule_id, 'BLOCK' AS severity, NULL::VARCHAR AS design_id, 'selected ' || (SELECT count(*) FROM c) AS expected, 'FASTA ' || (SELECT count(*) FROM f) AS actual
       FROM (SELECT 1) WHERE EXISTS ((SELECT s FROM f EXCEPT SELECT s FROM c) UNION ALL (SELECT s FROM c EXCEPT SELECT s FROM f))
       UNION ALL SELECT 'R12', 'BLOCK', p_partkey::VARCHAR, NULL, NULL FROM part WHERE p_size > 10""",
)
def rule_package(spark, sf_dir):
    """FASTA files of some parts against a selection of others; no structures."""
    p, folder = _t(spark, sf_dir, "part"), new_path(spark, "package")
    designs = _designs(p, design_id=F.col("p_partkey").cast("string"), sequence=F.concat("p_name", "p_type"), selected=F.col("p_size") > 10, cluster_id=F.col("p_size").cast("int"))
    files.make_folder(folder)
    export.write_fasta(designs.where("cluster_id <= 30"), folder).write.format("noop").mode("overwrite").save()
    return _told(rules.package(_context(spark, designs, package=folder, scope="export"))).drop("artifact")


@query(
    "fasta_scan",
    "SELECT o_orderkey::VARCHAR || '|T|' || o_orderstatus || '|' || o_orderpriority || '|score=' || CASE WHEN o_custkey % 3 = 0 THEN 'NA' ELSE format('{:.3f}', o_totalprice) END AS header, o_orderpriority AS sequence FROM orders",
)
def fasta_scan(spark, sf_dir):
    """All orders written as FASTA records by the executors and read back."""
    folder, key = new_path(spark, "fasta"), F.col("o_custkey")
    designs = _designs(_t(spark, sf_dir, "orders"), design_id=F.col("o_orderkey").cast("string"), modality=F.col("o_orderstatus"), pipeline=F.col("o_orderpriority"), sequence=F.col("o_orderpriority"), final_score=F.when(key % 3 > 0, F.col("o_totalprice")))
    files.make_folder(folder)
    written = materialize(export.write_fasta(designs, folder), "fasta-files")
    return files.read_fasta(spark, [r["file"] for r in written.select("file").collect()]).select("header", "sequence")  # a file of RECORDS records each


@query("path_resolution", "SELECT p AS path, CASE WHEN t THEN 'second' WHEN n THEN 'first' END AS base FROM (SELECT s_suppkey::VARCHAR || '.txt' AS p, s_suppkey % 3 = 0 AND s_suppkey % 2 > 0 AS t, s_suppkey % 2 = 0 AS n FROM supplier)")
def path_resolution(spark, sf_dir):
    """The first of two folders that has a supplier's file."""
    s, key, folder = _t(spark, sf_dir, "supplier"), F.col("s_suppkey"), new_path(spark, "bases")
    rows = s.select("s_suppkey", F.concat(key.cast("string"), F.lit(".txt")).alias("name"), F.col("s_name").alias("text"))
    for base, held in (("first", key % 2 == 0), ("second", key % 3 == 0)):
        files.write_texts(rows.where(held).select("name", "text"), f"{folder}/{base}")
    found = files.probe(rows.select(F.col("name").alias("path")), [f"{folder}/{b}" for b in ("first", "second")])
    return rows.select(F.col("name").alias("path")).join(found, "path", "left").select("path", F.regexp_extract("found", "/(first|second)/", 1).alias("base")).withColumn("base", F.nullif("base", F.lit("")))


# The registry and reports


@query("registry_scan", "SELECT o_orderkey::VARCHAR AS design_id, o_orderpriority AS stage, round(o_totalprice, 6) AS final_score, NULL::INTEGER AS cluster_id, FALSE AS selected FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def registry_scan(spark, sf_dir):
    """A target's designs of one stage out of a registry of all orders."""
    registry = Registry(spark, new_path(spark, "registry"))
    fixed = {c: F.lit("x") for c in ("modality", "pipeline", "config_hash", "sequence")} | {"length": F.lit(1)}
    registry.upsert(_t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("design_id"), F.col("o_orderstatus").alias("target_id"), F.col("o_orderpriority").alias("stage"), F.col("o_totalprice").alias("final_score")).withColumns(fixed))
    return registry.query_target("F", "1-URGENT").select("design_id", "stage", F.round("final_score", 6).alias("final_score"), "cluster_id", "selected")


@query("registry_decode", "SELECT event_id::VARCHAR AS design_id, unnest(['k', 'flag']) AS metric, unnest([(props->>'$.k')::DOUBLE, 1.0]) AS value, 3 AS names FROM events")
def registry_decode(spark, sf_dir):
    """Numbers and booleans of a JSON column; strings are named but no metrics."""
    props = F.concat(F.rtrim(F.col("props"), F.lit("}")), F.lit(', "flag": true, "word": "0.5"}'))
    rows = _t(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("design_id"), props.alias("metrics"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.DESIGNS if f.name not in rows.columns]
    return decode(rows.select("*", *blank)).select("design_id", F.explode("metrics").alias("metric", "value"), F.size("metric_names").alias("names"))


_FINDINGS = f"""{_ORDERS}, f AS (SELECT 'R2' AS rule_id, 'BLOCK' AS severity, design_id FROM d WHERE length <> length(sequence)
  UNION ALL SELECT 'R8', 'WARN', design_id FROM d WHERE licence IS NULL UNION ALL SELECT 'R10', 'INFO', design_id FROM d WHERE stage = 'generate')"""


def _report(spark: SparkSession, sf_dir: str) -> Report:
    """Findings of three severities on the orders."""
    d = _orders(spark, sf_dir)
    made = [
        rules.finding(d.where(F.col("length") != F.length("sequence")), "R2", rules.BLOCK, "length", F.col("design_id")),
        rules.finding(d.where("toolchain_license is null"), "R8", rules.WARN, "licence", F.col("design_id")),
        rules.finding(d.where("stage = 'generate'"), "R10", rules.INFO, "stage", F.col("design_id")),
    ]
    return Report(TARGET, rules.union(made), ["R2", "R8", "R10"])


@query("findings_summary", f"WITH {_FINDINGS} SELECT s.severity, count(f.severity) AS n FROM (VALUES ('BLOCK'), ('WARN'), ('INFO')) s(severity) LEFT JOIN f ON s.severity = f.severity GROUP BY s.severity")
def findings_summary(spark, sf_dir):
    return _report(spark, sf_dir).summary()


@query("exit_code", f"WITH {_FINDINGS} SELECT max((severity = 'BLOCK')::INT) AS on_block, max((severity IN ('BLOCK', 'WARN'))::INT) AS on_warn, 0 AS on_none, 'BLOCK' AS worst FROM f")
def exit_code(spark, sf_dir):
    report = _report(spark, sf_dir)
    codes = {f"on_{w}": F.lit(report.exit_code(w)) for w in ("block", "warn", "none")}
    return report.summary().limit(1).select(*[c.alias(n) for n, c in codes.items()], F.lit(report.worst()).alias("worst"))


@query("findings_order", f"WITH {_FINDINGS} SELECT rule_id, severity, design_id, row_number() OVER (ORDER BY CASE severity WHEN 'BLOCK' THEN 0 WHEN 'WARN' THEN 1 ELSE 2 END, rule_id, design_id)::BIGINT AS place FROM f")
def findings_order(spark, sf_dir):
    """Every finding's place in the report."""
    return _report(spark, sf_dir).placed().select("rule_id", "severity", "design_id", "place")


@query("null_omitting_json", f"""WITH {_FINDINGS} SELECT '{{"rule_id":"' || rule_id || '","severity":"' || severity || '","message":"' || CASE rule_id WHEN 'R2' THEN 'length' WHEN 'R8' THEN 'licence' ELSE 'stage' END || '","design_id":"' || design_id || '"}}' AS value FROM f""")
def null_omitting_json(spark, sf_dir):
    """The findings as the report's JSON lines, without what is null."""
    folder = new_path(spark, "findings")
    _report(spark, sf_dir).write_lines(folder)
    return spark.read.text(folder)


@query("methods_composition", f"""WITH {_ORDERS}, v AS (SELECT design_id, unnest(['pipeline', 'toolchain_license', 'stage']) AS "column", unnest([pipeline, licence, stage]) AS value FROM d) SELECT "column", value, count(*) AS n, min(design_id) AS first FROM v GROUP BY ALL""")
def methods_composition(spark, sf_dir):
    return export.composition(_orders(spark, sf_dir), ("pipeline", "toolchain_license", "stage"))


@query("count_clusters", f"WITH {_ORDERS} SELECT count(*) AS designs, count(DISTINCT cluster_id) + max((cluster_id IS NULL)::INT) AS clusters FROM d")
def count_clusters(spark, sf_dir):
    return export.count_clusters(_orders(spark, sf_dir))


@query(
    "set_symmetric_difference",
    """SELECT 'package' AS only_in, k FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity >= 49 EXCEPT SELECT p_partkey FROM part WHERE p_size <= 25)
       UNION ALL SELECT 'selected', k FROM (SELECT p_partkey AS k FROM part WHERE p_size <= 25 EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)""",
)
def set_symmetric_difference(spark, sf_dir):
    a, b = _t(spark, sf_dir, "lineitem").where("l_quantity >= 49").select(F.col("l_partkey").alias("k")), _t(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("k"))
    return rules.sides(a, b, "k").where("not (in_package and in_selection)").select(F.when(F.col("in_package"), "package").otherwise("selected").alias("only_in"), "k")


@query("set_equality", "SELECT count(*) = 0 AS equal FROM ((SELECT n_regionkey FROM nation EXCEPT SELECT r_regionkey FROM region) UNION ALL (SELECT r_regionkey FROM region EXCEPT SELECT n_regionkey FROM nation))")
def set_equality(spark, sf_dir):
    a, b = _t(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("k")), _t(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"))
    return rules.sides(a, b, "k").agg((F.count_if(~(F.col("in_package") & F.col("in_selection"))) == 0).alias("equal"))


@query("illegal_letters", "SELECT p_partkey, array_to_string(list_sort(list_filter(list_distinct(string_split(p_type, '')), lambda c: c <> '' AND NOT contains('ACDEFGHIKLMNPQRSTVWY', c))), '') AS bad FROM part")
def illegal_letters(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", sequences.illegal_characters(F.col("p_type")).alias("bad"))


# Rules on other tables


@query(
    "lineage_orphans",
    """SELECT 'o' || o_orderkey AS design_id, 'c' || o_custkey AS parent_id FROM orders ANTI JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey""",
)
def lineage_orphans(spark, sf_dir):
    """Orders as children of the customers with a balance above zero."""
    label = lambda letter, key: F.concat(F.lit(letter), F.col(key).cast("string"))
    known = _t(spark, sf_dir, "customer").where("c_acctbal > 0").select(label("c", "c_custkey").alias("id"), F.lit(None).cast("string").alias("parent"))
    every = known.union(_t(spark, sf_dir, "orders").select(label("o", "o_orderkey"), label("c", "o_custkey")))
    designs = _designs(every, design_id=F.col("id"), parent_id=F.col("parent"), config_hash=F.lit("h"))
    return rules.lineage(_context(spark, designs, hashes={"h": "h.yaml"})).select("design_id", F.col("actual").alias("parent_id"))


@query(
    "hash_reconcile",
    """WITH s AS (SELECT s_suppkey, n_name AS run_id, s_suppkey::VARCHAR || '.txt' AS path, sha256(s_name) AS expected, sha256(s_name || 'x') AS other FROM supplier JOIN nation ON s_nationkey = n_nationkey)
       SELECT run_id, path, CASE WHEN s_suppkey % 5 = 0 THEN 'missing' ELSE 'hash_mismatch' END AS reason, expected, CASE WHEN s_suppkey % 5 > 0 THEN other END AS actual FROM s WHERE s_suppkey % 5 = 0 OR s_suppkey % 7 = 0""",
)
def hash_reconcile(spark, sf_dir):
    """Nations as runs whose artifacts are their suppliers' files; some are lost, some were changed."""
    s, key, folder = _t(spark, sf_dir, "supplier"), F.col("s_suppkey"), new_path(spark, "runs")
    name = F.concat(key.cast("string"), F.lit(".txt"))
    files.write_texts(s.where(key % 5 > 0).select(name.alias("name"), F.when(key % 7 == 0, F.concat("s_name", F.lit("x"))).otherwise(F.col("s_name")).alias("text")), folder)
    nations = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    told = s.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("run_id"), F.lit(folder).alias("run_dir"), name.alias("rel"), F.sha2("s_name", 256).alias("expected"), key.alias("pos"))
    return verify_entries(told)


@query("cross_agreement", "SELECT user_id::VARCHAR AS design_id, count(*) FILTER (fine) AS agreeing FROM (SELECT user_id, event_type, min(value) >= 5 AS fine FROM events GROUP BY ALL) GROUP BY user_id")
def cross_agreement(spark, sf_dir):
    """Users as designs, kinds of events as predictors: those whose least value reaches a threshold."""
    least = _t(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("design_id"), F.col("event_type").alias("predictor")).agg(F.create_map(F.lit("iptm"), F.min("value").cast("double")).alias("values"))
    ctx = _context(spark, _designs(least, design_id=F.col("design_id")), profile={"folding_confidence": {"i_pTM": {"screen": 5}}})
    ctx._parsed = least.withColumns({"path": F.lit("x"), "found": F.lit("x")})
    return rules.agreeing(ctx)


@query("metric_recompute", "SELECT event_id::VARCHAR AS design_id, (props->>'$.k')::DOUBLE AS expected, value::DOUBLE AS actual FROM events WHERE abs((props->>'$.k')::DOUBLE - value) > 0.001")
def metric_recompute(spark, sf_dir):
    """Events as designs whose recorded value is held against one that was parsed from JSON."""
    e = _t(spark, sf_dir, "events").withColumn("design_id", F.col("event_id").cast("string"))
    outputs = F.create_map(F.lit("one"), F.lit("x"))
    ctx = _context(spark, _designs(e, design_id=F.col("design_id"), metrics=F.create_map(F.lit("i_pTM"), F.col("value").cast("double")), predictor_outputs=outputs))
    ctx._parsed = e.select("design_id", F.lit("one").alias("predictor"), F.lit("x").alias("path"), F.lit("x").alias("found"), F.create_map(F.lit("iptm"), F.get_json_object("props", "$.k").cast("double")).alias("values"))
    return rules.recomputed_metrics(ctx).select("design_id", *[F.col(c).cast("double").alias(c) for c in ("expected", "actual")])


@query(
    "license_rule",
    """SELECT p_partkey::VARCHAR AS design_id, CASE WHEN p_size > 25 THEN 'pyrosetta-dependent' ELSE 'permissive' END AS expected, CASE WHEN p_brand = 'Brand#2' THEN 'pyrosetta-dependent' ELSE p_brand END AS actual
       FROM part WHERE (p_size > 25) <> (p_brand = 'Brand#2')""",
)
def license_rule(spark, sf_dir):
    """Parts of one brand are licensed, large ones need it."""
    designs = _designs(_t(spark, sf_dir, "part"), design_id=F.col("p_partkey").cast("string"), pipeline=F.when(F.col("p_size") > 25, "my-BINDCRAFT").otherwise("x"), toolchain_license=F.when(F.col("p_brand") == "Brand#2", rules.LICENSED).otherwise(F.col("p_brand")))
    return rules.licence(_context(spark, designs)).select("design_id", "expected", "actual")


@query("quota_audit", "SELECT '<= 5' AS expected, count(*)::VARCHAR AS actual FROM customer WHERE c_acctbal > 0 GROUP BY c_nationkey HAVING count(*) > 5")
def quota_audit(spark, sf_dir):
    """Customers with a balance above zero as the selection, nations as clusters."""
    designs = _designs(_t(spark, sf_dir, "customer"), design_id=F.col("c_custkey").cast("string"), selected=F.col("c_acctbal") > 0, cluster_id=F.col("c_nationkey").cast("int"))
    return rules.quota(_context(spark, designs, target={"budget": {"max_per_cluster": 5}})).select("expected", "actual")
