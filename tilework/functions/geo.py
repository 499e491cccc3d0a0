"""Envelopes, the dateline, locality keys and part routing, without a geometry library.

A footprint is its envelope: four doubles that Parquet keeps statistics for, so that
bounding-box predicates prune row groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .scalars import zone_of

ENVELOPE = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"


def envelope(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return F.struct(
        xmin.cast("double").alias("xmin"), ymin.cast("double").alias("ymin"), xmax.cast("double").alias("xmax"),
        ymax.cast("double").alias("ymax"),
    )


def envelope_of_geojson(text: Column) -> Column:
    """Envelope of a GeoJSON geometry of any nesting: the positions are its innermost arrays."""
    number = r"-?[0-9.]+(?:[eE][-+]?[0-9]+)?"
    pairs = F.regexp_extract_all(text, F.lit(rf"\[\s*({number})\s*,\s*({number})"), F.lit(0))
    x = F.transform(pairs, lambda p: F.regexp_extract(p, rf"\[\s*({number})", 1).try_cast("double"))
    y = F.transform(pairs, lambda p: F.regexp_extract(p, rf",\s*({number})", 1).try_cast("double"))
    return F.when(F.size(pairs) > 0, envelope(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)))


def intersects(box: Column, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Whether an envelope meets a window; four comparisons that can be pushed down."""
    return (box["xmin"] <= xmax) & (box["xmax"] >= xmin) & (box["ymin"] <= ymax) & (box["ymax"] >= ymin)


def ring_intersects(xs: Column, ys: Column, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Whether a polygon (one ring, closed or not) meets a window, its border included.

    It does if a corner of the ring is in the window, a corner of the window is in the ring
    (even-odd rule), or an edge crosses the window: clipped to the window by its slabs, a part
    of the edge is left. Filter by ``intersects`` on the envelope first: that is pushed down.
    """
    n = F.size(xs)
    inside = F.exists(F.sequence(F.lit(0), n - 1), lambda i: F.get(xs, i).between(xmin, xmax) & F.get(ys, i).between(ymin, ymax))

    def edge(i):
        j = F.when(i == 0, n - 1).otherwise(i - 1)
        return F.get(xs, j), F.get(ys, j), F.get(xs, i), F.get(ys, i)

    def clipped(i):
        x0, y0, x1, y1 = edge(i)

        def slab(a, b, low, high):
            # The share of the edge, from a to b, that is between low and high.
            level = a == b
            d = F.when(level, 1.0).otherwise(b - a)
            enter, leave = F.least((low - a) / d, (high - a) / d), F.greatest((low - a) / d, (high - a) / d)
            out = F.when(level & ~a.between(low, high), 2.0)
            return F.coalesce(out, F.when(level, 0.0).otherwise(enter)), F.coalesce(out, F.when(level, 1.0).otherwise(leave))

        (ex, lx), (ey, ly) = slab(x0, x1, xmin, xmax), slab(y0, y1, ymin, ymax)
        return F.greatest(ex, ey, F.lit(0.0)) <= F.least(lx, ly, F.lit(1.0))

    def crosses(acc, i):
        x0, y0, x1, y1 = edge(i)
        spans = (y0 > ymin) != (y1 > ymin)
        left = F.lit(float(xmin)) < (x1 - x0) * (ymin - y0) / F.when(spans, y1 - y0).otherwise(1.0) + x0
        return acc + F.when(spans & left, 1).otherwise(0)

    around = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), crosses) % 2 == 1
    return F.when(n > 0, inside | F.exists(F.sequence(F.lit(0), n - 1), clipped) | around).otherwise(False)


def sane(bbox: Column, box: Column, widest: float = 20.0) -> Column:
    """Narrower than ``widest`` degrees, and not from east to west."""
    return (box["xmax"] - box["xmin"] < widest) & (F.element_at(bbox, 3) >= F.element_at(bbox, 1))


def clip_to_world(low: Column, high: Column, south: Column, north: Column) -> Column:
    """The envelopes of a longitude interval that may run past 180: what each copy of the world holds of it.

    The copies are -180..180 and 180..540; what the second holds is moved back by 360.
    """

    def piece(turn: int) -> Column:
        west, east = F.lit(-180.0 + 360 * turn), F.lit(180.0 + 360 * turn)
        left, right = F.greatest(low, west), F.least(high, east)
        point = (low == high) & (low >= west) & (low < east)
        return F.when((left < right) | point, envelope(left - 360 * turn, south, right - 360 * turn, north))

    return F.filter(F.array(piece(0), piece(1)), lambda p: p.isNotNull())


def footprints(scenes: DataFrame, tile: str = "tile") -> DataFrame:
    """``tile, pieces``: the envelope of each tile's scenes, in two pieces where it runs across the dateline.

    ``scenes`` has the tile and ``x0, x1, y0, y1``; what sticks out of the world is cut
    off. Each scene is an interval of longitudes in two frames: as it is, and turned so
    that it starts in 0..360. A tile whose scenes reach past 170 on one side and past -170
    on the other takes the turned frame, in which the dateline is inside. One
    pre-aggregated exchange of narrow rows.
    """
    left, right = F.greatest(F.col("x0"), F.lit(-180.0)), F.least(F.col("x1"), F.lit(180.0))
    turned = F.pmod(left, F.lit(360.0))
    grouped = scenes.groupBy(F.col(tile).alias("tile")).agg(
        F.struct(F.min(left).alias("low"), F.max(right).alias("high")).alias("plain"),
        F.struct(F.min(turned).alias("low"), F.max(turned + (right - left)).alias("high")).alias("round"),
        ((F.max(right) > 170) & (F.min(left) < -170)).alias("both_sides"),
        F.min("y0").alias("south"),
        F.max("y1").alias("north"),
    )
    frame = F.when(F.col("both_sides"), F.col("round")).otherwise(F.col("plain"))
    return grouped.select("tile", clip_to_world(frame["low"], frame["high"], F.col("south"), F.col("north")).alias("pieces"))


def hilbert(lon: Column, lat: Column, order: int = 16) -> Column:
    """Position on a Hilbert curve over the world, as an expression.

    Each level is one step of bit arithmetic over the pair (x, y); a constant number
    of levels unrolls into one generated expression.
    """
    side = (1 << order) - 1
    clamp = lambda v, low, span: F.least(F.lit(side), F.greatest(F.lit(0), F.floor((v - low) / span * side))).cast("bigint")
    start = F.struct(clamp(lon, -180.0, 360.0).alias("x"), clamp(lat, -90.0, 180.0).alias("y"), F.lit(0).cast("bigint").alias("d"))

    def step(acc, level):
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        rx = F.when(acc["x"].bitwiseAND(bit) > 0, 1).otherwise(0)
        ry = F.when(acc["y"].bitwiseAND(bit) > 0, 1).otherwise(0)
        quadrant = (rx * 3).bitwiseXOR(ry).cast("bigint")
        low_x, low_y = acc["x"].bitwiseAND(bit - 1), acc["y"].bitwiseAND(bit - 1)
        turn = ry == 0
        flip = turn & (rx == 1)
        fx = F.when(flip, bit - 1 - low_x).otherwise(low_x)
        fy = F.when(flip, bit - 1 - low_y).otherwise(low_y)
        return F.struct(
            F.when(turn, fy).otherwise(fx).alias("x"), F.when(turn, fx).otherwise(fy).alias("y"), (acc["d"] * 4 + quadrant).alias("d")
        )

    levels = F.array(*[F.lit(i) for i in range(order - 1, -1, -1)])
    return F.when(lon.isNotNull() & lat.isNotNull(), F.aggregate(levels, start, step, lambda acc: acc["d"]))


def mercator_to_lonlat(x: Column, y: Column) -> Column:
    """Longitude and latitude of Web Mercator coordinates in 0..1 (y down)."""
    lat = F.degrees(F.atan(F.sinh(F.lit(np.pi) * (1 - 2 * y))))
    return F.struct((x * 360.0 - 180.0).alias("lon"), lat.alias("lat"))


# The parts of a split year, first and last zone, and the years from which they hold.
QUARTERS = (("z01-20", 1, 20), ("z21-35", 21, 35), ("z36-46", 36, 46), ("z47-60", 47, 60))
EIGHTHS = (
    ("z01-15", 1, 15), ("z16-20", 16, 20), ("z21-31", 21, 31), ("z32-35", 32, 35),
    ("z36-40", 36, 40), ("z41-46", 41, 46), ("z47-52", 47, 52), ("z53-60", 53, 60),
)
QUARTERS_FROM, EIGHTHS_FROM = 2019, 2021


def tier(year: int, split: bool = True) -> tuple:
    """The zone parts in which a year is published; empty for a single file."""
    if not split or year < QUARTERS_FROM:
        return ()
    return EIGHTHS if year >= EIGHTHS_FROM else QUARTERS


def only_parts(year: int, names: list[str], split: bool = True) -> tuple:
    """The named parts of a year's tier in tier order; an unknown name is an error that lists the valid ones."""
    parts = tier(year, split)
    unknown = [n for n in names if n not in [p[0] for p in parts]]
    if unknown:
        raise ValueError(f"{', '.join(unknown)} not among the parts of {year}; valid: {', '.join(p[0] for p in parts)}")
    return tuple(p for p in parts if p[0] in names)


def archive_parts(split: bool = True) -> tuple:
    """Every name an archive part can have, in published order."""
    return ("items", *(p[0] for p in QUARTERS), *(p[0] for p in EIGHTHS)) if split else ("items",)


def live_month(month: int) -> str:
    if not 1 <= int(month) <= 12:
        raise ValueError(f"month {month} is not a month of the year (1-12)")
    return f"live-{int(month):02d}"


def live_parts(monthly: bool) -> tuple:
    return ("live", *(live_month(m) for m in range(1, 13))) if monthly else ("live",)


def part_of(zone: Column, year: Column | int, split: bool = True) -> Column:
    """Archive part that holds a zone in a year; null where no part does."""
    if not split:
        return F.lit("items")

    def within(parts):
        out = F.lit(None).cast("string")
        for name, low, high in parts:
            out = F.when(zone.between(low, high), F.lit(name)).otherwise(out)
        return out

    year = F.lit(year) if isinstance(year, int) else year
    return F.when(year >= EIGHTHS_FROM, within(EIGHTHS)).when(year >= QUARTERS_FROM, within(QUARTERS)).otherwise(F.lit("items"))


def part_of_tile(tile: Column, year: Column | int, split: bool = True) -> Column:
    return part_of(zone_of(tile), year, split)


def point_in_polygon(points: DataFrame, polygons: DataFrame, cell: float = 2.0) -> DataFrame:
    """``point_id, poly_id, rank``: for each point the topmost polygon that holds it (even-odd rule).

    ``points`` has ``point_id, x, y``; ``polygons`` has ``poly_id, rank`` (higher is on
    top) and ``xs, ys``, the ring's coordinates. Polygons are filed under the grid cells
    that their envelope touches, so both sides meet in an equi-join on the cell; the
    envelope and then the ring decide.
    """
    floor = lambda v: F.floor(v / cell).cast("int")
    boxed = polygons.select(
        "poly_id", "rank", "xs", "ys", F.array_min("xs").alias("px0"), F.array_max("xs").alias("px1"),
        F.array_min("ys").alias("py0"), F.array_max("ys").alias("py1"),
    )
    filed = boxed.withColumn("cx", F.explode(F.sequence(floor(F.col("px0")), floor(F.col("px1"))))).withColumn(
        "cy", F.explode(F.sequence(floor(F.col("py0")), floor(F.col("py1"))))
    )
    placed = points.select("point_id", "x", "y", floor(F.col("x")).alias("cx"), floor(F.col("y")).alias("cy"))
    n = F.size("xs")
    x, y = F.col("x"), F.col("y")

    def crosses(i):
        j = F.when(i == 0, n - 1).otherwise(i - 1)
        xi, yi, xj, yj = F.get("xs", i), F.get("ys", i), F.get("xs", j), F.get("ys", j)
        spans = (yi > y) != (yj > y)
        # A level edge spans nothing; its quotient must not be taken.
        left = x < (xj - xi) * (y - yi) / F.when(spans, yj - yi).otherwise(1.0) + xi
        return F.when(spans & left, 1).otherwise(0)

    inside = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + crosses(i)) % 2 == 1
    met = placed.join(filed, ["cx", "cy"]).where((x >= F.col("px0")) & (x <= F.col("px1")) & (y >= F.col("py0")) & (y <= F.col("py1")) & inside)
    top = met.groupBy("point_id").agg(F.max(F.struct("rank", "poly_id")).alias("top"))
    return top.select("point_id", "top.poly_id", "top.rank")


def rectangle_wkb(box: Column) -> Column:
    """Well-known binary of an envelope's rectangle, for the edge of the system."""

    @F.arrow_udf("binary")
    def made(boxes: pa.Array) -> pa.Array:
        import struct

        out = []
        for b in boxes.to_pylist():
            if b is None:
                out.append(None)
                continue
            ring = [(b["xmin"], b["ymin"]), (b["xmax"], b["ymin"]), (b["xmax"], b["ymax"]), (b["xmin"], b["ymax"])]
            ring.append(ring[0])
            out.append(struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in ring))
        return pa.array(out, pa.binary())

    return made(box)
