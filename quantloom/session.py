"""Session settings for panel workloads."""

from pyspark.sql import SparkSession


def get_session(app: str = "quantloom", **settings: str) -> SparkSession:
    """A session with adaptive execution, UTC and ANSI semantics; ``settings`` override or extend."""
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **settings,
    }
    return SparkSession.builder.appName(app).config(map=conf).getOrCreate()
