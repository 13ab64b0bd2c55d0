"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings that the library is tuned for; what the cluster sets wins."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
