"""Schemas of the candidate registry, findings, run manifests and event logs."""

from __future__ import annotations

from pyspark.sql import types as T

#: Columns of the first registry version, in order.
BASE_COLUMNS = [
    ("design_id", T.StringType()), ("target_id", T.StringType()), ("modality", T.StringType()), ("pipeline", T.StringType()),
    ("config_hash", T.StringType()), ("seed", T.IntegerType()), ("parent_id", T.StringType()), ("sequence", T.StringType()),
    ("length", T.IntegerType()), ("structure_path", T.StringType()), ("metrics", T.StringType()), ("predictors_agreeing", T.IntegerType()),
    ("passed_screen", T.BooleanType()), ("passed_select", T.BooleanType()), ("liability_flags", T.StringType()), ("cluster_id", T.IntegerType()),
    ("final_score", T.DoubleType()), ("selected", T.BooleanType()), ("created_at", T.TimestampType()),
]
#: Columns added later; older rows read null.
ADDED_COLUMNS = [
    (name, T.StringType())
    for name in ("toolchain_license", "run_id", "stage", "code_rev", "inputs_hash", "artifact_hashes", "command", "predictor_outputs", "manifest_uri")
]
DESIGNS = T.StructType([T.StructField(n, t) for n, t in BASE_COLUMNS + ADDED_COLUMNS])
#: Columns a writer supplies; created_at is kept by the registry.
COLUMNS = [f.name for f in DESIGNS if f.name != "created_at"]
JSON_OBJECTS = ("metrics", "artifact_hashes", "predictor_outputs")
JSON_ARRAYS = ("liability_flags",)
NOT_NULL = ("design_id", "target_id", "modality", "pipeline", "config_hash", "sequence", "length")
#: Values of absent columns of a new row.
DEFAULTS = {"predictors_agreeing": 0, "passed_screen": False, "passed_select": False, "selected": False}

_FINDING = ("rule_id", "severity", "message", "design_id", "artifact", "expected", "actual")
FINDINGS = T.StructType([T.StructField(n, T.StringType()) for n in _FINDING])

_ENTRY = T.StructType([T.StructField(n, T.StringType()) for n in ("path", "sha256", "design_id", "kind")])
MANIFEST = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("run_id", "stage", "target_id", "config_path", "config_hash", "code_rev")]
    + [T.StructField("code_dirty", T.BooleanType())]
    + [T.StructField(n, T.StringType()) for n in ("started_at", "ended_at", "host", "scheduler_job_id", "command", "env_lock")]
    + [
        T.StructField("tool_versions", T.MapType(T.StringType(), T.StringType())),
        T.StructField("seed", T.LongType()),
        T.StructField("inputs", T.ArrayType(_ENTRY)),
        T.StructField("artifacts", T.ArrayType(_ENTRY)),
    ]
)
EVENTS = T.StructType([T.StructField(n, T.StringType()) for n in ("ts", "run_id", "stage", "action", "artifact", "sha256", "design_id", "kind")] + [T.StructField("seq", T.LongType())])
