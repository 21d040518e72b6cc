"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "layerloom",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC time, adaptive execution and runtime skew handling switched on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for key, value in {**defaults, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
