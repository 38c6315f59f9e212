"""A session with the settings that the operators are planned for."""

from pyspark.sql import SparkSession


def build(name: str = "helixframe", **settings: str) -> SparkSession:
    """A session with adaptive execution and skew handling on; settings override by name, with
    underscores for dots."""
    builder = SparkSession.builder.appName(name)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (defaults | {k.replace("_", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
