"""Folders for tables that a job writes and reads again, in storage that driver and executors share."""

from __future__ import annotations

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, else one below the warehouse."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints").rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """An empty folder of this application; a job that runs again replaces what it left there."""
    from .sources.files import delete

    path = f"{shared_root(spark)}/tilework-{spark.sparkContext.applicationId}/{name}"
    delete(spark, path)
    return path
