"""Item search: routing, gates, ranked results and point lookups.

Every function only declares filters and projections; the tile equality, the time
window and the metric ceiling reach the Parquet scan, and wide columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import geo
from ..functions.scalars import scene_day, window_months
from ..schema import Collection, q


def scenes(items: DataFrame, *, tile: Column, at: Column, item: Column, cloud: Column, nodata: Column) -> DataFrame:
    """``id, tile, ts, t, day, cloud, cover`` of items with a readable time. A null nodata share is a null cover."""
    return items.where(at.isNotNull()).select(
        item.alias("id"),
        tile.alias("tile"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        at.alias("t"),
        F.to_date(at).alias("day"),
        cloud.cast("double").alias("cloud"),
        (100.0 - nodata.cast("double")).alias("cover"),
    )


def view_filter(first: str, last: str, cloud: float, least_cover: float) -> Column:
    """Gate of a result view: a scene without a cover passes."""
    cover = F.col("cover").isNull() | (F.col("cover") >= least_cover) if least_cover > 0 else F.lit(True)
    return F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")) & (F.col("cloud") <= cloud) & cover


def search_filter(first: str, last: str, cloud: float, least_cover: float) -> Column:
    """Gate of a search: a scene without a cover fails as soon as a cover is asked for."""
    gate = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")) & (F.col("cloud") <= cloud)
    return gate & (F.col("cover") >= least_cover) if least_cover > 0 else gate


def order_by(sort: str = "cloud") -> list[Column]:
    """Sort keys of a view; an unknown name sorts by cloud."""
    cloud, item = F.col("cloud").asc_nulls_last(), F.col("id").asc()
    if sort == "coverage":
        return [F.coalesce("cover", F.lit(-1.0)).desc(), cloud, item]
    if sort == "date":
        return [F.col("t").desc(), item]
    if sort == "time":
        return [F.col("t").asc(), item]
    return [cloud, item]


def view(rows: DataFrame, first: str, last: str, cloud: float = 100, least_cover: float = 0, sort: str = "cloud") -> DataFrame:
    return rows.where(view_filter(first, last, cloud, least_cover)).orderBy(*order_by(sort))


def scene_search(rows: DataFrame, tile, first: str, last: str, cloud: float, least_cover: float = 0, limit: int = 30) -> DataFrame:
    """The ``limit`` clearest scenes of a tile and window: a top-k, not a sort."""
    gate = (F.col("tile") == tile) & search_filter(first, last, cloud, least_cover)
    return rows.where(gate).orderBy(*order_by("cloud")).limit(limit)


def keyed_rows(table: DataFrame, key: str, value, columns: Sequence[str]) -> DataFrame:
    """Point lookup; a key-sorted table is pruned to the row groups whose range holds the key."""
    return table.where(q(key) == value).select(*[q(c) for c in columns])


def part_paths(config: Collection, base: str, tile: str, first: str, last: str, current_year: int) -> list[str]:
    """Candidate files for a tile and day window: one archive part a year, and its live tail.

    The zone in a tile's id names its part, which no optimiser can infer, so the routing
    is done here, before the scan is made.
    """
    digits = "".join(c for c in tile[:2] if c.isdigit())
    out = []
    for year in range(int(first[:4]), int(last[:4]) + 1):
        names = []
        parts = geo.tier(year, config.zone_split)
        if parts:
            names += [n for n, low, high in parts if digits and low <= int(digits) <= high]
        else:
            names.append("items")
        if config.monthly_live:
            names += ["live", *(geo.live_month(m) for m in window_months(year, first, last))]
        elif year == current_year:
            names.append("live")
        out += [f"{base}/{config.name}/year={year}/{n}.parquet" for n in names]
    return out


def view_index(rows: DataFrame, sort: str = "cloud", within: str = "tile") -> DataFrame:
    """Rows with their position in the view of each tile, from 0; the neighbours are position - 1 and + 1, clamped."""
    window = W.partitionBy(within).orderBy(*order_by(sort))
    return rows.withColumn("position", F.row_number().over(window) - 1)


def neighbours(indexed: DataFrame, within: str = "tile") -> DataFrame:
    """Rows of ``view_index`` with ``previous, next``: the ids one position before and after, clamped to the ends of the view."""
    window = W.partitionBy(within).orderBy("position")
    return indexed.withColumn("previous", F.coalesce(F.lag("id").over(window), F.col("id"))).withColumn(
        "next", F.coalesce(F.lead("id").over(window), F.col("id"))
    )


def at_position(indexed: DataFrame, position: int, within: str = "tile") -> DataFrame:
    """The row of each view at a position, clamped: below zero the first, beyond the end the last."""
    last = F.max("position").over(W.partitionBy(within))
    return indexed.withColumn("_last", last).where(F.col("position") == F.least(F.greatest(F.lit(position), F.lit(0)), F.col("_last"))).drop("_last")


def api_request(config: Collection, tile_query: dict, first: str, last: str, cloud: float, least_cover: float) -> str:
    """The body of the equivalent item-search request: cover >= c is nodata <= 100 - c."""
    query = {config.metric_column: {"lte": cloud}, **tile_query}
    if least_cover > 0:
        query[config.nodata_column] = {"lte": 100 - least_cover}
    return json.dumps(
        {
            "collections": [config.name],
            "datetime": f"{first}T00:00:00Z/{last}T23:59:59Z",
            "query": query,
            "sortby": [{"field": f"properties.{config.metric_column}", "direction": "asc"}],
            "limit": 30,
        }
    )


def compare_ranked(left: DataFrame, right: DataFrame, key: str, ids: str) -> DataFrame:
    """``key, mismatches``: positions at which two ranked id lists of a query differ; a missing list differs throughout."""
    flat = lambda df, name: df.select(q(key), F.posexplode_outer(q(ids)).alias("at", name))
    met = flat(left, "l").join(flat(right, "r"), [key, "at"], "full_outer")
    return met.groupBy(key).agg(F.count_if(~F.col("l").eqNullSafe(F.col("r"))).alias("mismatches"))


def day_buckets(ids: DataFrame, config: Collection, column: str = "id") -> DataFrame:
    """``day, n`` of item ids by the day in their name; ids that do not fit are skipped."""
    return ids.select(scene_day(q(column), config.id_pattern).alias("day")).where("day is not null").groupBy("day").agg(F.count("*").alias("n"))


def lookup(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a lookup table; whether it is broadcast is decided by its measured size."""
    return left.join(right, key, "left")
