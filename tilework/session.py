"""Session settings that the library's results depend on, and those that its speed does."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Results depend on the zone: months and days are cut in UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
}


def builder(name: str = "tilework", **more) -> SparkSession.Builder:
    """A builder with the library's settings; ``more`` maps setting names to values and wins."""
    made = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | more).items():
        made = made.config(key, value)
    return made


def pin(spark: SparkSession) -> SparkSession:
    """Set what results depend on in a session that was made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
