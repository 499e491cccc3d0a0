"""Monthly statistics, splices, slices and the timeline on the published fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tilework.operators import dedupe, stats
from tilework.plans import build
from tilework.schema import L2A, upgrade_stats

WIDE = [
    ("q1", "2021-02-03 04:05:06", "11SKA", 7.5, 90.0),
    ("q2", "2021-02-27 23:59:59", "11SKA", 64.2, 10.0),
    ("q3", "2021-02-14 00:00:00", "11SKA", 12.4, 50.0),
    ("r1", "2021-02-28 12:00:00", "52WDT", 0.49, None),
    ("r2", "2021-03-01 00:30:00", "52WDT", 30.5, 99.6),
    ("s1", "2020-12-31 23:45:00", "07VEG", 99.51, 0.4),
    ("s2", "2021-01-01 00:15:00", "07VEG", 88.0, 70.0),
]
SCHEMA = "id string, at string, `s2:mgrs_tile` string, `eo:cloud_cover` double, `s2:nodata_pixel_percentage` double"


def items(spark, rows, nodata=True):
    df = spark.createDataFrame(rows, SCHEMA if nodata else SCHEMA.rpartition(",")[0])
    return df.withColumn("datetime", F.to_timestamp("at")).drop("at")


def table(df):
    return {(r.mgrs_tile, r.year, r.month): r for r in df.collect()}


def test_rounding_and_zone(spark):
    got = table(build.items_stats(items(spark, WIDE), L2A))
    figures = {
        k: (r.min_cloud_cover, r.median_cloud_cover, r.mean_cover, r.max_cover, r.best_item_id, str(r.best_item_date)) for k, r in got.items()
    }
    # Halves go up; a month ends at midnight UTC; one scene without a cover gives none.
    assert figures == {
        ("11SKA", 2021, 2): (8, 12, 50, 90, "q1", "2021-02-03"),
        ("52WDT", 2021, 2): (0, 0, None, None, "r1", "2021-02-28"),
        ("52WDT", 2021, 3): (31, 31, 0, 0, "r2", "2021-03-01"),
        ("07VEG", 2020, 12): (100, 100, 100, 100, "s1", "2020-12-31"),
        ("07VEG", 2021, 1): (88, 88, 30, 30, "s2", "2021-01-01"),
    }


def test_counts_and_best(spark):
    rows = [("A1", "2024-05-01 10:00:00", "31UFU", 80.0), ("A2", "2024-05-11 10:00:00", "31UFU", 10.0), ("A3", "2024-05-21 10:00:00", "31UFU", 40.0)]
    got = table(build.items_stats(items(spark, rows, nodata=False), L2A))[("31UFU", 2024, 5)]
    assert (got.scene_count, got.min_cloud_cover, got.median_cloud_cover, got.best_item_id) == (3, 10, 40, "A2")
    assert got.mean_cover is None and got.max_cover is None


def test_tie_names_one_scene_and_missing_metric_never_wins(spark):
    rows = [("T1", "2024-07-01 00:00:00", "33ABC", 50.0, None), ("T2", "2024-07-15 00:00:00", "33ABC", 50.0, None), ("T0", "2024-07-02 00:00:00", "33ABC", None, None)]
    got = table(build.items_stats(items(spark, rows), L2A))[("33ABC", 2024, 7)]
    assert (got.best_item_id, got.best_item_date) == ("T1", dt.date(2024, 7, 1))
    none = table(build.items_stats(items(spark, rows[2:]), L2A))[("33ABC", 2024, 7)]
    assert (none.best_item_id, none.min_cloud_cover, none.scene_count) == (None, None, 1)


def test_clamp(spark):
    rows = [("a", "2024-05-01 00:00:00", "31UFU", -0.5, None), ("b", "2024-05-02 00:00:00", "31UFU", 100.5, None)]
    got = table(build.items_stats(items(spark, rows), L2A))[("31UFU", 2024, 5)]
    assert (got.min_cloud_cover, got.median_cloud_cover, got.mean_cover, got.max_cover) == (0, 50, None, None)


def test_timeline(spark):
    rows = {tuple(r) for r in stats.timeline(build.items_stats(items(spark, WIDE), L2A)).collect()}
    assert rows == {(2020, 12, 1, 1, 100), (2021, 1, 1, 1, 88), (2021, 2, 2, 4, 0), (2021, 3, 1, 1, 31)}


def test_year_splice_of_an_old_layout(spark):
    old = spark.createDataFrame(
        [("X1", "10ABC", 2023, 1, 5, 2.5, 3.5, "2023-01-05 00:00:00")],
        "best_item_id string, mgrs_tile string, year int, month int, scene_count int, min_cloud_cover double, median_cloud_cover double, t string",
    ).withColumn("best_item_datetime", F.to_timestamp("t")).drop("t")
    fresh = build.items_stats(items(spark, [("Q2", "2024-03-10 00:00:00", "20XYZ", 1.0, 30.0)]), L2A)
    got = table(dedupe.splice_years(upgrade_stats(old), fresh, [2024]))
    assert (got[("10ABC", 2023, 1)].mean_cover, got[("10ABC", 2023, 1)].min_cloud_cover) == (None, 3)
    assert (got[("20XYZ", 2024, 3)].mean_cover, got[("20XYZ", 2024, 3)].max_cover) == (70, 70)


def test_products_and_stale_slices(spark, tmp_path):
    from tilework.sources import sinks

    out = str(tmp_path / "stats")
    build.build_stats(items(spark, WIDE), L2A, out)
    flat = str(tmp_path / "flat")
    assert sinks.flat_slices(spark, f"{out}/months", flat) == ["2020-12", "2021-01", "2021-02", "2021-03"]
    build.build_stats(items(spark, [r for r in WIDE if not r[1].startswith("2020")]), L2A, out)
    assert sinks.flat_slices(spark, f"{out}/months", flat) == ["2021-01", "2021-02", "2021-03"]
    assert sorted(p.name for p in (tmp_path / "flat").glob("2*.parquet")) == ["2021-01.parquet", "2021-02.parquet", "2021-03.parquet"]
    assert spark.read.parquet(f"{flat}/2021-02.parquet").count() == 2


def test_merge_needs_the_existing_table(spark, tmp_path):
    with pytest.raises(ValueError):
        build.build_stats(items(spark, WIDE), L2A, str(tmp_path / "x"), merge_years=[2021])


def test_paint_gates(spark):
    painted = spark.createDataFrame([("a", 1.0, 5, None, 3), ("b", 2.0, None, 80, 1), ("c", 3.0, 50, 90, 9)], "mgrs_tile string, v double, cc int, cover int, sc long")
    assert tuple(stats.pass_count(painted, 10, 85, 2).first()) == (1, 3)
    assert stats.p99_bound(painted).first().bound == 9
    assert stats.p99_bound(painted.limit(0)).first().bound == 1


def test_p99_is_nearest_rank(spark):
    df = spark.range(100).select(F.col("id").alias("sc"))
    assert stats.p99_bound(df).first().bound == 98


def test_layout_percentile_counts(spark):
    df = spark.createDataFrame([("g", float(x)) for x in (1, 1, 2, 9)], "g string, v double")
    assert stats.layout_percentiles(df, ["g"], "v", 0.5).first().p == 2.0
    assert stats.layout_percentiles(df, ["g"], "v", 1.0).first().p == 9.0
