"""Session settings the plans are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Plans read wall-clock times only; the zone is pinned for anything a user adds.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A contract compiles to wide projections. Methods over 8000 bytes are never
    # JIT-compiled by the JVM; below this limit Spark splits them into small ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build(master: str | None = None, app: str = "tablepact", **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` overrides them. On a cluster the master
    and the shared ``spark.checkpoint.dir`` come from the submit configuration."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
