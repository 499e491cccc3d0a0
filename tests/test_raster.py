"""Raster statistics, masks, painting, warping."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilework.functions import raster


def samples(spark, values):
    return spark.createDataFrame([(1, float(v)) for v in values], "p int, value double")


def test_sample_stats_leave_nodata_out(spark):
    got = raster.sample_stats(samples(spark, [0, 0, *range(1, 102), float("nan")]), ["p"]).first()
    assert (got.n, got.min, got.max, got.p2, got.p98) == (101, 1, 101, 3, 99)


def test_histogram(spark):
    got = {r.bin: r.n for r in raster.histogram(samples(spark, [1, 1, 2, 65]), ["p"]).collect()}
    assert got == {0: 2, 1: 1, 63: 1}
    assert raster.histogram(samples(spark, [5, 5]), ["p"]).first().bin == 0


def test_index(spark):
    df = spark.createDataFrame([(5000.0, 1000.0), (0.0, 5.0), (5.0, -5.0), (6000.0, 2000.0)], "a double, b double")
    got = [r.v for r in df.select(raster.normalised_difference(F.col("a"), F.col("b")).alias("v")).collect()]
    assert got[0] == pytest.approx(2 / 3) and got[1] is None and got[2] is None
    off = df.select(raster.normalised_difference(F.col("a"), F.col("b"), 1000).alias("v")).collect()[3].v
    assert off == pytest.approx(4 / 6)


def test_mask_grows_by_one_pixel(spark):
    data = [(1, x, 0, *((0, 0, 0) if x == 0 else (20, 20, 20))) for x in range(4)]
    pixels = spark.createDataFrame(data, "p int, x int, y int, r int, g int, b int")
    assert sorted(r.x for r in raster.nodata_mask(pixels, ["p"]).collect()) == [0, 1]


def test_levels(spark):
    levels = spark.createDataFrame([(1, i, s, s, 10980 / s) for i, s in enumerate((10980, 5490, 2745, 1372, 686))], "p int, level int, w int, h int, scale double")
    assert raster.pick_level(levels, ["p"], 1200).first().level == 3
    assert raster.pick_level(levels, ["p"], 20000).first().level == 0
    assert raster.window_level(levels, ["p"], F.lit(5.0)).first().level == 2
    assert raster.window_level(levels, ["p"], F.lit(0.1)).first().level == 0


def test_painting(spark):
    df = spark.createDataFrame([([0.0, 1.0, float("nan"), 2.0], [1.0, 1.0, 1.0, 2.0])], "a array<float>, b array<float>")
    rgba = np.frombuffer(df.select(raster.paint_bands(F.col("a"), F.col("b"), F.col("b"), [(0, 2)] * 3).alias("x")).first().x, np.uint8).reshape(-1, 4)
    assert rgba[:, 3].tolist() == [0, 255, 0, 255] and rgba[3].tolist() == [255, 255, 255, 255] and 120 <= rgba[1, 0] <= 130
    index = np.frombuffer(df.select(raster.paint_index(F.col("a"), F.col("b"), "ndvi").alias("x")).first().x, np.uint8).reshape(-1, 4)
    assert index[:, 3].tolist() == [0, 255, 0, 255] and abs(int(index[1, 0]) - 0xF5) <= 2
    classes = spark.createDataFrame([([4.0, 0.0, 11.0],)], "v array<float>").select(raster.paint_classes(F.col("v")).alias("x")).first().x
    assert np.frombuffer(classes, np.uint8).reshape(-1, 4).tolist() == [[0, 160, 0, 255], [0, 0, 0, 0], [255, 150, 255, 255]]


def test_utm_and_warp():
    east, north = raster.utm(np.array([3.0, 9.0]), np.array([0.0, 52.0]), 31, False)
    assert east[0] == pytest.approx(500000) and north[0] == pytest.approx(0, abs=1e-6)
    # 9 degrees east is three degrees east of zone 32's... in zone 32 itself it is the central meridian.
    east, north = raster.utm(np.array([9.0]), np.array([52.0]), 32, False)
    assert east[0] == pytest.approx(500000) and north[0] == pytest.approx(5761038.21, abs=0.05)
    with pytest.raises(ValueError):
        raster.zone_of_epsg(4326)
    data = np.arange(100 * 100, dtype=np.float32).reshape(100, 100)
    out = raster.warp_plane(data, (499500, 5761538), (10, -10), 32632, (8.995, 51.997, 9.005, 52.003), (40, 40))
    assert out.shape == (40, 40) and np.isfinite(out[15:25, 15:25]).all()


def test_warp_as_a_column(spark):
    """Each row against its own positions: projected pixel by pixel, without the control grid."""
    rng = np.random.default_rng(3)
    grid = rng.integers(1, 200, (40, 60)).astype(np.float32)
    east, north = raster.utm(np.array([9.0]), np.array([45.0]), 32, False)
    origin, step = (float(east[0]) - 3000, float(north[0]) + 2000), (100.0, -100.0)
    bounds, size = (8.97, 44.985, 9.03, 45.015), (24, 18)
    rows = [(1, grid.reshape(-1).tolist(), [40, 60], list(origin), list(step), 32632), (2, None, [0, 0], list(origin), list(step), 32632)]
    df = spark.createDataFrame(rows, "i int, samples array<float>, shape array<int>, origin array<double>, step array<double>, epsg int")
    c = F.col
    got = {r.i: r.p for r in df.select("i", raster.warp(c("samples"), c("shape"), c("origin"), c("step"), c("epsg"), bounds, size, 4).alias("p")).collect()}
    assert got[2] is None and len(got[1]) == 24 * 18
    lon = np.linspace(bounds[0], bounds[2], 25)[:-1] + (bounds[2] - bounds[0]) / 48
    lat = np.linspace(bounds[3], bounds[1], 19)[:-1] - (bounds[3] - bounds[1]) / 36
    x, y = raster.utm(*np.meshgrid(lon, lat), 32, False)
    px, py = (x - origin[0]) / step[0], (y - origin[1]) / step[1]
    for k, v in enumerate(got[1]):
        i, j = px.reshape(-1)[k], py.reshape(-1)[k]
        if min(i % 1, 1 - i % 1, j % 1, 1 - j % 1) < 0.01:
            continue  # on the border of two samples
        inside = 0 <= i < 60 and 0 <= j < 40
        assert v == (grid[int(j), int(i)] if inside else None)
