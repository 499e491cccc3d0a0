"""Physical layout: parts, row groups, ranges.

Every window here is partitioned by the part, file or run it describes; nothing
collapses a table into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def month_groups(df: DataFrame, part: Sequence[str], month: str, order: Sequence[str], target: int) -> DataFrame:
    """Rows with ``group_no``: row groups that never span a month and never exceed ``target`` rows.

    A null month stops the job.
    """
    checked = df.withColumn(month, F.when(F.col(month).isNull(), F.raise_error(F.lit("a row has no month")).cast(df.schema[month].dataType)).otherwise(F.col(month)))
    window = W.partitionBy(*part, month).orderBy(*order)
    return checked.withColumn("group_no", F.floor((F.row_number().over(window) - 1) / target).cast("int"))


def group_sizes(grouped: DataFrame, part: Sequence[str], month: str) -> DataFrame:
    return grouped.groupBy(*part, month, "group_no").agg(F.count("*").alias("rows"))


def row_group_ordinal(df: DataFrame, part: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """Rows with ``rg``, the row group in which a part sorted by ``order`` would hold them."""
    window = W.partitionBy(*part).orderBy(*order)
    return df.withColumn("rg", F.floor((F.row_number().over(window) - 1) / size).cast("int"))


def scatter(ordinals: DataFrame, part: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Over how many row groups the most scattered key of each part is spread."""
    spread = ordinals.groupBy(*part, *key).agg(F.count_distinct("rg").alias("groups"))
    return spread.groupBy(*part).agg(F.max("groups").alias("scatter"))


def running_offset(groups: DataFrame, part: Sequence[str], order: str, rows: str = "rows") -> DataFrame:
    """Row groups with ``row0, row1``: the first row of each and of the next one."""
    window = W.partitionBy(*part).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(rows).over(window)
    return groups.withColumn("row1", end).withColumn("row0", F.col("row1") - F.col(rows))


def merge_spans(spans: DataFrame, part: Sequence[str], start: str, end: str, gap: int) -> DataFrame:
    """Ranges whose distance is at most ``gap`` as one. ``end`` is exclusive."""
    window = W.partitionBy(*part).orderBy(start, end)
    before = F.max(end).over(window.rowsBetween(W.unboundedPreceding, -1))
    flagged = spans.withColumn("_new", F.when(before.isNull() | (F.col(start) - before > gap), 1).otherwise(0))
    run = flagged.withColumn("_run", F.sum("_new").over(window.rowsBetween(W.unboundedPreceding, 0)))
    return run.groupBy(*part, "_run").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("spans")).drop("_run")


def run_lengths(df: DataFrame, part: Sequence[str], order: Sequence[str], state: Column) -> DataFrame:
    """``part, run, state, length``: maximal runs of equal state in order."""
    window = W.partitionBy(*part).orderBy(*order)
    stated = df.select(*part, *order, state.alias("state"))
    changed = stated.withColumn("_new", F.when(F.col("state").eqNullSafe(F.lag("state").over(window)) & (F.row_number().over(window) > 1), 0).otherwise(1))
    run = changed.withColumn("run", F.sum("_new").over(window.rowsBetween(W.unboundedPreceding, 0)))
    return run.groupBy(*part, "run", "state").agg(F.count("*").alias("length"))


def request_depth(requests: DataFrame, part: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Longest chain of requests of each run in which one starts only after another has ended.

    The earliest end first makes the greedy chain the longest: one fold over the requests
    of a run in order of their end, with two numbers for its state. A run is one
    measurement, and its requests fit one array.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(end).alias("e"), F.col(start).alias("s"))))
    kind = requests.schema[end].dataType.simpleString()
    first = F.struct(F.lit(0).alias("depth"), F.lit(None).cast(kind).alias("last"))

    def step(acc, x):
        later = acc["last"].isNull() | (x["s"] >= acc["last"])
        return F.when(later, F.struct((acc["depth"] + 1).alias("depth"), x["e"].alias("last"))).otherwise(acc)

    return requests.groupBy(*part).agg(F.aggregate(ordered, first, step, lambda acc: acc["depth"]).alias("depth"))


def admitted_groups(groups: DataFrame, low: Column, high: Column, key) -> DataFrame:
    """Row groups whose range may hold the key; a group without statistics is admitted."""
    return groups.where(low.isNull() | high.isNull() | ((low <= key) & (high >= key)))
