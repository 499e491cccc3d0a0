"""Lineage cuts that survive the loss of executors.

Intermediate tables are written as Parquet below the folder that the session
names in ``spark.checkpoint.dir`` (shared by driver and executors), never to a
machine-local temporary folder. Where the setting is absent, the warehouse
folder, which is shared too, takes its place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


class Scratch:
    """A folder of intermediate tables that belongs to one run of one operator.

    An operator sweeps what its result does not read. What the result reads stays until the
    caller has written the result, and may then sweep it (``made`` lists all folders).
    """

    made: list["Scratch"] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        self.made.append(self)

    def save(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        """Write ``df`` and return the written table; its lineage ends at the files."""
        return self.load(self.write(df, codec), df)

    @property
    def last(self) -> str:
        """The path of the table that was written last."""
        return f"{self.base}/{self.count:03d}"

    def write(self, df: DataFrame, codec: str = "zstd") -> str:
        self.count += 1
        path = self.last
        df.write.option("compression", codec).parquet(path)
        return path

    def load(self, path: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(path)

    def drop(self, path: str) -> None:
        """Delete a table that no later plan reads."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def sweep(self, *kept: str) -> None:
        """Delete all tables but those at the paths ``kept``."""
        if not kept:
            self.drop(self.base)
            return
        for k in range(1, self.count + 1):
            path = f"{self.base}/{k:03d}"
            if path not in kept:
                self.drop(path)
