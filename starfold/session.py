"""Session settings the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call sites in error messages cost a stack trace for every column expression a plan is made of
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app_name: str = "starfold", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session. ANSI mode stays on: the engine uses ``try_*`` where input may be bad."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
