"""Views, searches, routing, ranked comparison."""

import json

from pyspark.sql import functions as F

from tilework.functions import geo
from tilework.operators import search
from tilework.schema import C1, L2A

ROWS = [
    ("S2A_1", "2024-01-05", 40.0, 100.0),
    ("S2A_2", "2024-03-10", 5.0, 30.0),
    ("S2A_3", "2024-07-01", 5.0, None),
    ("S2A_4", "2024-11-20", 80.0, 90.0),
]


def rows(spark):
    df = spark.createDataFrame(ROWS, "id string, d string, cloud double, cover double")
    return df.select("id", F.lit("t").alias("tile"), F.to_date("d").alias("day"), F.to_timestamp("d").alias("t"), "cloud", "cover")


def ids(df):
    return [r.id[-1] for r in df.collect()]


def test_orders(spark):
    view = lambda sort, **k: ids(search.view(rows(spark), "2024-01-01", "2024-12-31", sort=sort, **k))
    assert view("cloud") == list("2314") and view("nonsense") == list("2314")
    assert view("coverage") == list("1423")
    assert view("date") == list("4321")


def test_null_cover_passes_a_view_and_fails_a_search(spark):
    assert sorted(ids(search.view(rows(spark), "2024-01-01", "2024-12-31", least_cover=50))) == list("134")
    assert ids(search.scene_search(rows(spark), "t", "2024-01-01", "2024-12-31", 100, 50)) == list("14")
    assert ids(search.scene_search(rows(spark), "t", "2024-01-01", "2024-12-31", 100)) == list("2314")
    assert ids(search.scene_search(rows(spark), "other", "2024-01-01", "2024-12-31", 100)) == []


def test_search_is_a_top_k_and_reaches_the_scan(spark, sf):
    from tilework.queries import scene_search

    plan = scene_search(spark, sf)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "PushedFilters" in plan and "props" not in plan.partition("ReadSchema")[2]


def test_positions(spark):
    got = {r.id: r.position for r in search.view_index(rows(spark), "date").collect()}
    assert got == {"S2A_4": 0, "S2A_3": 1, "S2A_2": 2, "S2A_1": 3}


def test_part_paths():
    one = search.part_paths(L2A, "b", "31UFU", "2020-12-20", "2021-01-10", 2026)
    assert one == ["b/sentinel-2-l2a/year=2020/z21-35.parquet", "b/sentinel-2-l2a/year=2021/z21-31.parquet"]
    assert search.part_paths(L2A, "b", "1VCJ", "2018-01-01", "2018-02-01", 2018) == [
        "b/sentinel-2-l2a/year=2018/items.parquet",
        "b/sentinel-2-l2a/year=2018/live.parquet",
    ]
    months = search.part_paths(C1, "b", "31UFU", "2024-12-20", "2025-01-10", 2026)
    assert [p.rpartition("/")[2] for p in months] == ["items.parquet", "live.parquet", "live-12.parquet", "items.parquet", "live.parquet", "live-01.parquet"]


def test_request_mirror():
    body = json.loads(search.api_request(L2A, {"grid": {"eq": "31UFU"}}, "2024-01-01", "2024-02-01", 20, 60))
    assert body["query"]["s2:nodata_pixel_percentage"] == {"lte": 40} and body["limit"] == 30
    assert "s2:nodata_pixel_percentage" not in json.loads(search.api_request(L2A, {}, "2024-01-01", "2024-02-01", 20, 0))["query"]


def test_ranked_comparison_keeps_order(spark):
    left = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["x"])], "q int, ids array<string>")
    right = spark.createDataFrame([(1, ["b", "a"]), (2, ["a"])], "q int, ids array<string>")
    assert {r.q: r.mismatches for r in search.compare_ranked(left, right, "q", "ids").collect()} == {1: 2, 2: 0, 3: 1}


def test_tiers():
    import pytest

    assert geo.tier(2018) == () and len(geo.tier(2019)) == 4 and len(geo.tier(2021)) == 8 and geo.tier(2025, False) == ()
    assert [p[0] for p in geo.only_parts(2022, ["z53-60", "z01-15"])] == ["z01-15", "z53-60"]
    with pytest.raises(ValueError, match="z01-15"):
        geo.only_parts(2022, ["z01-20"])
    assert geo.live_month(3) == "live-03" and len(geo.live_parts(True)) == 13 and geo.live_parts(False) == ("live",)
    with pytest.raises(ValueError):
        geo.live_month(13)
