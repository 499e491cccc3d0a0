"""Raster statistics and painting.

Bands are rows ``(scene, at, value)`` or arrays; statistics are aggregations over rows,
pixel painting is an Arrow function over one scene's planes at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

BINS = 64
# Classes of the scene classification with their colours.
CLASSES = [
    (0, "No data", "#000000"),
    (1, "Saturated / defective", "#ff0000"),
    (2, "Dark area", "#2f2f2f"),
    (3, "Cloud shadow", "#643200"),
    (4, "Vegetation", "#00a000"),
    (5, "Not vegetated", "#ffe65a"),
    (6, "Water", "#0000ff"),
    (7, "Unclassified", "#808080"),
    (8, "Cloud, medium probability", "#c0c0c0"),
    (9, "Cloud, high probability", "#ffffff"),
    (10, "Thin cirrus", "#64c8ff"),
    (11, "Snow / ice", "#ff96ff"),
]
# Indices as (first band, second band, ramp).
INDICES = {
    "ndvi": ("B08", "B04", ("#8c510a", "#f5f5f5", "#01665e")),
    "ndwi": ("B03", "B08", ("#a6611a", "#f5f5f5", "#0571b0")),
}


def normalised_difference(a: Column, b: Column, offset: float = 0.0, nodata: float = 0.0) -> Column:
    """(a - b) / (a + b) after the offset, within -1..1; null where either is nodata or the sum is zero."""
    x, y = a - offset, b - offset
    value = (x - y) / F.nullif(x + y, F.lit(0.0))
    ok = (a != nodata) & (b != nodata)
    return F.when(ok, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value)) * F.when(value.isNotNull(), 1.0))


def valid(value: Column, nodata: float = 0.0) -> Column:
    return F.when((value != nodata) & ~F.isnan(value) & (F.abs(value) < float("inf")), value)


def bin_of(value: Column, low: Column, high: Column, bins: int = BINS) -> Column:
    span = F.when(high == low, 1.0).otherwise(high - low)
    return F.least(F.lit(bins - 1), F.floor((value - low) / span * bins)).cast("int")


def nearest_percentiles(samples: DataFrame, part: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """For each part and name: the sorted element at round(share * (n - 1)).

    Equal values are counted before the exchange, so a part costs its distinct values.
    """
    counted = samples.where(F.col(value).isNotNull()).groupBy(*part, value).agg(F.count("*").alias("c"))
    window = W.partitionBy(*part)
    upto = counted.select(
        *part, value, "c", F.sum("c").over(window.orderBy(value).rowsBetween(W.unboundedPreceding, 0)).alias("upto"), F.sum("c").over(window).alias("n")
    )

    def pick(share):
        at = F.floor(F.lit(share) * (F.col("n") - 1) + 0.5)  # round half up
        return F.max(F.when((F.col("upto") > at) & (F.col("upto") - F.col("c") <= at), F.col(value)))

    return upto.groupBy(*part).agg(
        F.max("n").alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), *[pick(s).alias(k) for k, s in shares.items()]
    )


def sample_stats(samples: DataFrame, part: list[str], value: str = "value", nodata: float = 0.0) -> DataFrame:
    """``n, min, max, p2, p98`` of each part's valid samples."""
    rows = samples.withColumn(value, valid(F.col(value), nodata))
    return nearest_percentiles(rows, part, value, {"p2": 0.02, "p98": 0.98})


def histogram(samples: DataFrame, part: list[str], value: str = "value", low: float | None = None, high: float | None = None,
              nodata: float | None = 0.0) -> DataFrame:
    """``bin, n`` of each part's valid samples over its own range, or a fixed one."""
    rows = samples if nodata is None else samples.withColumn(value, valid(F.col(value), nodata))
    rows = rows.where(F.col(value).isNotNull())
    if low is None:
        ranges = rows.groupBy(*part).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
        rows = rows.join(ranges, part)
    else:
        rows = rows.withColumn("_lo", F.lit(low)).withColumn("_hi", F.lit(high))
    return rows.groupBy(*part, bin_of(F.col(value), F.col("_lo"), F.col("_hi")).alias("bin")).agg(F.count("*").alias("n"))


def pick_level(levels: DataFrame, part: list[str], target: int) -> DataFrame:
    """The smallest overview whose long side reaches ``target``, else the largest. ``levels`` has ``w, h, level``."""
    long = F.greatest("w", "h")
    smallest = F.min_by("level", F.when(long >= target, long))
    return levels.groupBy(*part).agg(F.coalesce(smallest, F.max_by("level", long)).alias("level"))


def window_level(levels: DataFrame, part: list[str], want: Column) -> DataFrame:
    """The coarsest level that is not coarser than ``want`` base pixels a pixel, else the finest."""
    ok = F.when(F.col("scale") <= want, F.col("scale"))
    return levels.groupBy(*part).agg(F.coalesce(F.max_by("level", ok), F.min_by("level", F.col("scale"))).alias("level"))


# Channel levels of a flat black or white pixel, and of one that is near to it.
BLACK, NEAR_BLACK, WHITE, NEAR_WHITE = 0, 24, 250, 235


def nodata_mask(pixels: DataFrame, part: list[str], white: bool = False) -> DataFrame:
    """``part, x, y`` of masked pixels: those of exactly the flat colour, and near ones next to such a pixel.

    ``pixels`` has ``x, y, r, g, b``. Seeds are spread to their nine neighbours, and near
    pixels meet them in an equi-join.
    """
    channels = [F.col(c) for c in "rgb"]
    every = lambda f: f(channels[0]) & f(channels[1]) & f(channels[2])
    exact = every(lambda c: c >= WHITE) if white else every(lambda c: c == BLACK)
    near = every(lambda c: c >= NEAR_WHITE) if white else every(lambda c: c <= NEAR_BLACK)
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    grown = (
        pixels.where(exact)
        .select(*part, "x", "y", F.explode(around).alias("d"))
        .select(*part, (F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"))
        .distinct()
    )
    return pixels.where(exact | near).select(*part, "x", "y").join(grown, [*part, "x", "y"], "left_semi")


def colour_table(stops) -> np.ndarray:
    """256 colours through evenly spaced stops."""
    rgb = np.array([[int(s[i : i + 2], 16) for i in (1, 3, 5)] for s in stops], float)
    at = np.linspace(0, len(rgb) - 1, 256)
    return np.stack([np.interp(at, np.arange(len(rgb)), rgb[:, c]) for c in range(3)], 1).round().astype(np.uint8)


def stretch_table(curve: str = "linear", gamma: float = 1.0, size: int = 1024) -> np.ndarray:
    t = np.linspace(0, 1, size)
    t = {"linear": t, "sqrt": np.sqrt(t), "log": np.log10(1 + 9 * t)}[curve]
    return np.clip(np.floor(255 * t ** (1 / max(0.05, gamma or 1.0)) + 0.5), 0, 255).astype(np.uint8)


def _planes(arrays) -> list[np.ndarray]:
    return [np.asarray(a.as_py() or [], np.float32) for a in arrays]


def paint_bands(red: Column, green: Column, blue: Column, ranges, curve: str = "linear", gamma: float = 1.0, nodata: float | None = 0.0) -> Column:
    """RGBA bytes from three sample arrays; a pixel with a missing or nodata sample is transparent."""
    lut = stretch_table(curve, gamma)

    @F.arrow_udf("binary")
    def painted(r: pa.Array, g: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for row in zip(r, g, b, strict=True):
            planes = _planes(row)
            rgba = np.zeros((len(planes[0]), 4), np.uint8)
            seen = np.ones(len(planes[0]), bool)
            for c, (p, (low, high)) in enumerate(zip(planes, ranges, strict=True)):
                seen &= ~np.isnan(p) & ((p != nodata) if nodata is not None else True)
                t = np.clip((np.nan_to_num(p) - low) * (len(lut) - 1) / ((high - low) or 1e-9), 0, len(lut) - 1)
                rgba[:, c] = lut[t.astype(int)]
            rgba[:, 3] = 255
            rgba[~seen] = 0
            out.append(rgba.tobytes())
        return pa.array(out, pa.binary())

    return painted(red, green, blue)


def paint_index(a: Column, b: Column, index: str, low: float = -1.0, high: float = 1.0, offset: float = 0.0, nodata: float = 0.0) -> Column:
    """RGBA bytes of a normalised difference through its ramp."""
    table = colour_table(INDICES[index][2])

    @F.arrow_udf("binary")
    def painted(first: pa.Array, second: pa.Array) -> pa.Array:
        out = []
        for row in zip(first, second, strict=True):
            x, y = _planes(row)
            with np.errstate(divide="ignore", invalid="ignore"):
                v = ((x - offset) - (y - offset)) / ((x - offset) + (y - offset))
            ok = ~np.isnan(v) & (x != nodata) & (y != nodata)
            t = np.clip((np.nan_to_num(v) - low) * 255 / ((high - low) or 1e-9), 0, 255).astype(int)
            rgba = np.concatenate([table[t], np.full((len(t), 1), 255, np.uint8)], 1)
            rgba[~ok] = 0
            out.append(rgba.tobytes())
        return pa.array(out, pa.binary())

    return painted(a, b)


def paint_classes(values: Column, nodata: float | None = 0.0) -> Column:
    """RGBA bytes of a classification through its palette."""
    table = np.zeros((256, 3), np.uint8)
    for number, _, colour in CLASSES:
        table[number] = [int(colour[i : i + 2], 16) for i in (1, 3, 5)]

    @F.arrow_udf("binary")
    def painted(planes: pa.Array) -> pa.Array:
        out = []
        for (p,) in zip(map(lambda a: np.asarray(a.as_py() or [], np.float32), planes), strict=True):
            ok = ~np.isnan(p) & ((p != nodata) if nodata is not None else True)
            k = np.clip(np.nan_to_num(p), 0, 255).astype(int)
            rgba = np.concatenate([table[k], np.full((len(k), 1), 255, np.uint8)], 1)
            rgba[~ok] = 0
            out.append(rgba.tobytes())
        return pa.array(out, pa.binary())

    return painted(values)


def utm(lon: np.ndarray, lat: np.ndarray, zone: int, south: bool) -> tuple[np.ndarray, np.ndarray]:
    """WGS 84 transverse Mercator by Krueger's series to the third order (well below a millimetre in a zone)."""
    a, f = 6378137.0, 1 / 298.257223563
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    phi, lam = np.radians(lat), np.radians(np.asarray(lon) - (zone * 6 - 183))
    e = 2 * np.sqrt(n) / (1 + n)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t**2))
    east, north = eta.copy(), xi.copy()
    for j, c in enumerate(alpha, 1):
        east += c * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        north += c * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return 500000 + 0.9996 * radius * east, (10_000_000 if south else 0) + 0.9996 * radius * north


def zone_of_epsg(epsg: int) -> tuple[int, bool]:
    """UTM zone and hemisphere of EPSG 326xx and 327xx; any other code is an error."""
    if epsg // 100 not in (326, 327):
        raise ValueError(f"EPSG:{epsg} is not a UTM/WGS84 code")
    return epsg % 100, epsg // 100 == 327


def warp_plane(samples: np.ndarray, origin, resolution, epsg: int, bounds, size, cell: int = 16) -> np.ndarray:
    """A north-up UTM raster resampled to a longitude-latitude raster: nearest sample, NaN outside.

    Positions are projected on a control grid about ``cell`` pixels apart and
    interpolated between its nodes, the usual approximate transform of warping tools
    (Wolberg, Digital Image Warping, 1990, on mesh warping).
    """
    width, height = size
    west, south, east, north = bounds
    zone, below = zone_of_epsg(epsg)
    nx, ny = -(-width // cell), -(-height // cell)
    lon, lat = np.meshgrid(np.linspace(west, east, nx + 1), np.linspace(north, south, ny + 1))
    gx, gy = utm(lon, lat, zone, below)
    gx, gy = (gx - origin[0]) / resolution[0], (gy - origin[1]) / resolution[1]
    u, v = (np.arange(width) + 0.5) / (width / nx), (np.arange(height) + 0.5) / (height / ny)
    i, j = np.minimum(nx - 1, u.astype(int)), np.minimum(ny - 1, v.astype(int))
    s, t = (u - i)[None, :], (v - j)[:, None]

    def between(g):
        rows = g[j][:, i], g[j][:, i + 1], g[j + 1][:, i], g[j + 1][:, i + 1]
        return (rows[0] * (1 - s) + rows[1] * s) * (1 - t) + (rows[2] * (1 - s) + rows[3] * s) * t

    px, py = np.floor(between(gx)).astype(int), np.floor(between(gy)).astype(int)
    ok = (px >= 0) & (py >= 0) & (px < samples.shape[1]) & (py < samples.shape[0])
    out = np.full((height, width), np.nan, np.float32)
    out[ok] = samples[py[ok], px[ok]]
    return out


def warp(samples: Column, shape: Column, origin: Column, resolution: Column, epsg: Column, bounds, size, cell: int = 16) -> Column:
    """``warp_plane`` of each row: array of the pixels of a longitude-latitude raster, row by row, null outside.

    ``samples`` is an array, row by row; ``shape`` (height, width), ``origin`` and
    ``resolution`` (x, y) are arrays of two. A row without samples gives a null.
    """

    @F.arrow_udf("array<float>")
    def warped(planes: pa.Array, shapes: pa.Array, origins: pa.Array, steps: pa.Array, codes: pa.Array) -> pa.Array:
        out = []
        for plane, shape, origin, step, code in zip(*(x.to_pylist() for x in (planes, shapes, origins, steps, codes)), strict=True):
            if not plane:
                out.append(None)
                continue
            grid = np.array([np.nan if v is None else v for v in plane], np.float32).reshape(shape)
            pixels = warp_plane(grid, origin, step, code, bounds, size, cell).reshape(-1)
            out.append([None if np.isnan(v) else float(v) for v in pixels])
        return pa.array(out, pa.list_(pa.float32()))

    return warped(samples, shape, origin, resolution, epsg)
