"""The daily refresh as a stream: late and reprocessed items into a live table, touched years into the statistics.

The stream carries items as they are created, whatever month they belong to. Each
micro-batch keeps the latest version of each id, drops what the archive already holds,
merges into the live months that it touches and replaces only those.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import dedupe
from ..schema import q


def dedupe_stream(stream: DataFrame, key: str, at: str, late: str = "5 days") -> DataFrame:
    """Each key once within the lookback; state older than the watermark is dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def monthly_counts(stream: DataFrame, key: str, at: str, late: str = "5 days") -> DataFrame:
    """Running counts by key and calendar month of the stream."""
    return stream.withWatermark(at, late).groupBy(q(key), F.date_trunc("month", at).alias("month")).agg(F.count("*").alias("n"))


def merge_live(batch: DataFrame, live: DataFrame | None, archive: DataFrame | None, *, key: str, version: str, month: str,
               ties: tuple = ()) -> DataFrame:
    """What the live months touched by a batch hold after it."""
    fresh = dedupe.latest_by(batch, key, version, ties)
    if archive is not None:
        # Only the batch's months of the archive are read.
        fresh = dedupe.exclude_archived(fresh, archive, key, version, q(month))
    if live is None:
        return fresh
    touched = fresh.select(q(month)).distinct()
    return dedupe.consolidate(live.join(touched, month, "left_semi"), fresh, key, version, ties)


def live_writer(spark: SparkSession, path: str, archive: DataFrame | None, *, key: str, version: str, month: str,
                ties: tuple = (), after: Callable[[DataFrame, int], None] | None = None):
    """A ``foreachBatch`` function that keeps a live table partitioned by ``month``.

    A batch that runs again after a failure writes the same rows: merging is idempotent. What
    the touched months will hold is staged first, as a table cannot be overwritten while
    it is read. Then it is published in order: months that the table does not have yet, then
    the replaced ones, and only then what ``after`` derives from them.
    """
    from ..sources.files import exists

    def write(batch: DataFrame, epoch: int) -> None:
        live = spark.read.parquet(path) if exists(spark, path) else None
        merged = merge_live(batch, live, archive, key=key, version=version, month=month, ties=ties)
        staged = f"{path.rstrip('/')}.staged"
        merged.write.mode("overwrite").parquet(staged)
        ready = spark.read.parquet(staged)
        months = [r[0] for r in ready.select(q(month)).distinct().collect()]
        there = {m for m in months if exists(spark, f"{path.rstrip('/')}/{month}={m}")}
        for turn in ([m for m in months if m not in there], sorted(there)):
            if turn:
                rows = ready.where(q(month).isin(turn)).repartition(q(month))
                rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)
        if after is not None:
            after(ready, epoch)

    return write


def splice_stats(spark: SparkSession, path: str, sources: Callable[[], DataFrame], config, at: str = "datetime"):
    """An ``after`` hook: the years that a batch touches are computed again and spliced into the statistics at ``path``.

    ``sources`` gives archive and live items together. The products are written beside the
    old ones and take their place once they are whole.
    """
    from ..plans.build import build_stats
    from ..sources import files

    def after(ready: DataFrame, epoch: int) -> None:
        years = sorted(r[0] for r in ready.select(F.year(q(at))).distinct().collect())
        if not years:
            return
        table, staged = f"{path}/mgrs-monthly", f"{path.rstrip('/')}.staged"
        files.delete(spark, staged)
        if files.exists(spark, table):
            build_stats(sources(), config, staged, years, spark.read.parquet(table))
        else:
            build_stats(sources(), config, staged)
        files.move(spark, staged, path)

    return after


def run_refresh(stream: DataFrame, write, checkpoint: str):
    """Start the refresh over what is available now, and stop."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
