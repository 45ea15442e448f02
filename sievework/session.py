"""A session with the settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that hold on a laptop and on a cluster alike; sizes are left to the caller.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "sievework", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` overrides ``SETTINGS`` (underscores stand for dots)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
