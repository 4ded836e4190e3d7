"""A session as the engine expects it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "framewright", **conf: str) -> SparkSession:
    """UTC, adaptive execution and Arrow; sizes are left to the cluster. Further settings by keyword, _ for dots."""
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in {"spark_sql_execution_arrow_pyspark_enabled": "true", "spark_sql_sources_partitionOverwriteMode": "dynamic", **conf}.items():
        b = b.config(k.replace("_", "."), v)
    return b.getOrCreate()
