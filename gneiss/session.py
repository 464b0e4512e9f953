"""The Spark session that the command lines and the bench use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str, master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution and Arrow; anything else stays the cluster's."""
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    return builder.config(map=base | conf).getOrCreate()
