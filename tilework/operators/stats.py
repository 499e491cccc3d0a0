"""Statistics by key and period, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalars import month_name, on_ramp, percent


def rollup(items: DataFrame, *, key: Column, at: Column, metric: Column, item: Column, nodata: Column | None = None,
           grain: str = "month", version: Column | None = None) -> DataFrame:
    """Counts, cloud and cover statistics, and the best item, of each key and period.

    The best item is one decision: the least metric, then the earliest time, then the
    least id; items without a metric never win. A period is a year and month, and with
    ``grain='day'`` a day too. One exchange of partial aggregates; only the median
    keeps more than a fixed state for a group, and that is a count of distinct values.
    """
    day = [F.dayofmonth(at).cast("tinyint").alias("day")] if grain == "day" else []
    cover = (100.0 - nodata) if nodata is not None else F.lit(None).cast("double")
    rows = items.select(
        key.alias("mgrs_tile"), F.year(at).cast("smallint").alias("year"), F.month(at).cast("tinyint").alias("month"), *day,
        metric.cast("double").alias("metric"), cover.alias("cover"), item.alias("item"), at.alias("at"),
    )
    keys = ["mgrs_tile", "year", "month", *(["day"] if day else [])]
    order = F.when(F.col("metric").isNotNull(), F.struct("metric", "at", "item"))
    grouped = rows.groupBy(*keys).agg(
        F.count("*").cast("int").alias("scene_count"),
        F.min("metric").alias("lo"),
        F.median("metric").alias("mid"),
        F.avg("cover").alias("mean"),
        F.max("cover").alias("hi"),
        F.min_by(F.struct("item", "at"), order).alias("best"),
    )
    return grouped.select(
        *keys,
        "scene_count",
        percent(F.col("lo")).alias("min_cloud_cover"),
        percent(F.col("mid")).alias("median_cloud_cover"),
        percent(F.col("mean")).alias("mean_cover"),
        percent(F.col("hi")).alias("max_cover"),
        F.col("best.item").alias("best_item_id"),
        F.to_date("best.at").alias("best_item_date"),
    )


def timeline(stats: DataFrame) -> DataFrame:
    """One row a month over all keys."""
    return stats.groupBy("year", "month").agg(
        F.count("*").cast("int").alias("tile_count"),
        F.sum("scene_count").cast("int").alias("scene_count"),
        F.min("min_cloud_cover").alias("min_cloud_cover"),
    )


def tile_history(stats: DataFrame, tile) -> DataFrame:
    """One row a month of one key; a key-sorted table is pruned to the groups that hold it."""
    return stats.where(F.col("mgrs_tile") == tile).groupBy("year", "month").agg(
        F.sum("scene_count").cast("bigint").alias("n"), F.min("min_cloud_cover").alias("clearest")
    )


def newest_month(stats: DataFrame) -> DataFrame:
    """The latest year and month; a top-1, not a sort."""
    return stats.select("year", "month").distinct().orderBy(F.col("year").desc(), F.col("month").desc()).limit(1)


def month_span(stats: DataFrame) -> DataFrame:
    """First and last month as year*100+month, the items and the rows; an empty table is an error for callers."""
    ym = F.col("year").cast("int") * 100 + F.col("month")
    return stats.agg(
        F.min(ym).alias("first"), F.max(ym).alias("last"), F.sum("scene_count").cast("bigint").alias("scenes"), F.count("*").alias("n")
    )


def distinct_periods(items: DataFrame, at: str) -> DataFrame:
    return items.select(F.year(at).alias("year"), F.month(at).alias("month")).distinct()


def window_paint(stats: DataFrame, first: str, last: str, metric: str = "min_cloud_cover") -> DataFrame:
    """Each key's value on the ramp over the months ``first``..``last`` ('YYYY-MM'), with its gate figures.

    Cloud is the least of the months', coverage the greatest, scenes the sum and the
    median metric the best month's median. Keys without the metric are left out.
    """
    grouped = (
        stats.where(month_name(F.col("year"), F.col("month")).between(first, last))
        .groupBy("mgrs_tile")
        .agg(
            F.min("min_cloud_cover").alias("cc"),
            F.max("max_cover").alias("cover"),
            F.sum("scene_count").cast("bigint").alias("sc"),
            F.min("median_cloud_cover").alias("med"),
        )
    )
    raw = {"scene_count": "sc", "max_cover": "cover", "median_cloud_cover": "med", "min_cloud_cover": "cc"}[metric]
    painted = grouped.where(F.col(raw).isNotNull())
    return painted.select("mgrs_tile", on_ramp(metric, F.col(raw)).cast("double").alias("v"), "cc", "cover", "sc")


def passes(cloud: float, cover: float, scenes: float) -> Column:
    """The gate on painted keys; a missing figure passes."""
    ok = lambda c: F.coalesce(c, F.lit(True))
    return ok(F.col("cc") <= cloud) & ok(F.col("cover") >= cover) & ok(F.col("sc") >= scenes)


def pass_count(painted: DataFrame, cloud: float, cover: float, scenes: float) -> DataFrame:
    """``n`` of ``m`` keys pass the gate."""
    return painted.agg(F.count_if(passes(cloud, cover, scenes)).alias("n"), F.count("*").alias("m"))


def p99_bound(painted: DataFrame, column: str = "sc") -> DataFrame:
    """Nearest-rank 99th percentile, rounded, at least 1: the element at ceil(0.99 n) - 1 of the sorted values."""
    at = F.expr(f"percentile_disc(0.99) within group (order by `{column}`)")
    return painted.agg(F.greatest(F.lit(1), F.coalesce(F.round(at), F.lit(0))).cast("bigint").alias("bound"))


def density_grid(df: DataFrame, x: Column, y: Column, nx: int, ny: int, west: float = -180.0, east: float = 180.0,
                 south: float = -90.0, north: float = 90.0) -> DataFrame:
    """``ix, iy, n``: a two-dimensional histogram, clamped to its edges, row 0 in the north."""
    ix = F.least(F.lit(nx - 1), F.greatest(F.lit(0), F.floor((x - west) / (east - west) * nx)))
    iy = F.least(F.lit(ny - 1), F.greatest(F.lit(0), F.floor((north - y) / (north - south) * ny)))
    return df.select(ix.cast("int").alias("ix"), iy.cast("int").alias("iy")).groupBy("ix", "iy").agg(F.count("*").alias("n"))


def part_rollup(parts: DataFrame) -> DataFrame:
    """Rows, time range and outward-rounded bounds of each year from its parts."""
    down = lambda c: F.floor(F.min(c) * 10000) / 10000
    up = lambda c: F.ceil(F.max(c) * 10000) / 10000
    return parts.groupBy("year").agg(
        F.sum("rows").cast("bigint").alias("rows"), F.min("start").alias("start"), F.max("end").alias("end"),
        down("xmin").alias("xmin"), down("ymin").alias("ymin"), up("xmax").alias("xmax"), up("ymax").alias("ymax"),
    )


def collection_rollup(years: DataFrame) -> DataFrame:
    """All years as one row."""
    return years.agg(
        F.sum("rows").cast("bigint").alias("rows"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    )


def two_level_median(runs: DataFrame, outer: list[str], inner: list[str], value: str) -> DataFrame:
    """Median, least and greatest of each inner group, and the median of those medians for each outer one."""
    first = runs.groupBy(*outer, *inner).agg(F.median(value).alias("mid"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    return first.groupBy(*outer).agg(
        F.median("mid").alias("median"), F.min("lo").alias("least"), F.max("hi").alias("greatest"), F.count("*").alias("groups")
    )


def layout_percentiles(df: DataFrame, by: list[str], value: str, share: float) -> DataFrame:
    """For each group: the sorted element at min(n - 1, int(share * n)), with median, greatest and sum.

    The element is found by counting: values are pre-aggregated to distinct values
    before they meet, and a running count in each group finds the position.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("c"))
    window = W.partitionBy(*by).orderBy(value)
    upto = counted.withColumn("upto", F.sum("c").over(window.rowsBetween(W.unboundedPreceding, 0))).withColumn(
        "n", F.sum("c").over(W.partitionBy(*by))
    )
    position = F.least(F.col("n") - 1, F.floor(F.lit(share) * F.col("n")).cast("bigint"))
    at = upto.where((F.col("upto") > position) & (F.col("upto") - F.col("c") <= position))
    whole = df.groupBy(*by).agg(F.median(value).alias("median"), F.max(value).alias("greatest"), F.sum(value).alias("total"))
    return whole.join(at.select(*by, F.col(value).alias("p")), by)
