"""Envelopes at the dateline, polygons, the locality key."""

import pytest
from pyspark.sql import functions as F

from tilework.functions import geo


def boxes(spark, data):
    return spark.createDataFrame(data, "tile string, x0 double, x1 double, y0 double, y1 double")


def test_dateline_split(spark):
    data = [
        ("01CDK", 179.4, 180.0, -80.0, -79.0), ("01CDK", -180.0, -179.6, -80.0, -79.0),
        ("01CDL", -179.9, -179.2, -78.0, -77.0), ("01CDL", -179.5, -179.0, -78.0, -77.0),
        ("01CDM", 179.5, 180.3, -70.0, -69.0), ("01CDM", -180.6, -179.7, -70.0, -69.0),
        ("31ABC", 3.9, 4.0, 51.9, 52.0), ("31ABC", 4.0, 4.1, 52.0, 52.1),
    ]
    got = {r.tile: [tuple(round(v, 6) for v in p) for p in r.pieces] for r in geo.footprints(boxes(spark, data)).collect()}
    assert got["01CDK"] == [(179.4, -80.0, 180.0, -79.0), (-180.0, -80.0, -179.6, -79.0)]
    assert got["01CDL"] == [(-179.9, -78.0, -179.0, -77.0)]
    assert got["01CDM"] == [(179.5, -70.0, 180.0, -69.0), (-180.0, -70.0, -179.7, -69.0)]
    assert got["31ABC"] == [(3.9, 51.9, 4.1, 52.1)]


def test_wide_and_reversed_boxes_are_not_sane(spark):
    df = spark.createDataFrame(
        [(1, [-179.5, 10.0, 179.5, 11.0]), (2, [179.36, -41.61, -179.85, -40.61]), (3, [3.0, 1.0, 4.0, 2.0])], "k int, bbox array<double>"
    )
    box = geo.envelope(F.array_min(F.array(F.col("bbox")[0], F.col("bbox")[2])), F.col("bbox")[1], F.greatest(F.col("bbox")[0], F.col("bbox")[2]), F.col("bbox")[3])
    assert [r.k for r in df.where(geo.sane(F.col("bbox"), box)).collect()] == [3]


def test_envelope_of_geojson(spark):
    text = '{"type":"MultiPolygon","coordinates":[[[[1.5,2],[3,4.25],[-1e1,0],[1.5,2]]]]}'
    got = spark.createDataFrame([(text,), (None,)], "g string").select(geo.envelope_of_geojson(F.col("g")).alias("e")).collect()
    assert tuple(got[0].e) == (-10.0, 0.0, 3.0, 4.25) and got[1].e is None


def test_polygons_on_top_and_outside(spark):
    polygons = spark.createDataFrame(
        [(1, 1, [0.0, 10.0, 0.0], [0.0, 0.0, 10.0]), (2, 5, [2.0, 4.0, 4.0, 2.0], [2.0, 2.0, 4.0, 4.0])], "poly_id int, rank int, xs array<double>, ys array<double>"
    )
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 1.0, 1.0), (3, 9.0, 9.0), (4, -1.0, 0.5)], "point_id int, x double, y double")
    assert {r.point_id: r.poly_id for r in geo.point_in_polygon(points, polygons).collect()} == {1: 2, 2: 1}


def test_hilbert_keeps_neighbours_together(spark):
    # Every step along the curve moves to a cell that shares a side.
    side = 8
    cells = spark.range(side * side).select((F.col("id") % side).alias("i"), F.floor(F.col("id") / side).alias("j"))
    lon = ((F.col("i") + 0.3) / (side - 1)) * 360 - 180  # inside the cell, away from its edges
    lat = ((F.col("j") + 0.3) / (side - 1)) * 180 - 90
    got = {r.h: (r.i, r.j) for r in cells.select("i", "j", geo.hilbert(lon, lat, 3).alias("h")).collect()}
    assert sorted(got) == list(range(side * side))
    for a, b in zip(range(side * side - 1), range(1, side * side), strict=True):
        assert abs(got[a][0] - got[b][0]) + abs(got[a][1] - got[b][1]) == 1


def test_routing_and_unplaceable_tiles(spark):
    df = spark.createDataFrame([("1VCJ", 2020), ("31UFU", 2022), ("UFU", 2022), ("99XXX", 2020), ("5ABC", 2017)], "t string, y int")
    got = [r.p for r in df.select(geo.part_of_tile(F.col("t"), F.col("y")).alias("p")).collect()]
    assert got == ["z01-20", "z21-31", None, None, "items"]


def test_wkb(spark):
    import struct

    row = spark.createDataFrame([(0.0, 1.0, 2.0, 3.0)], "a double, b double, c double, d double").select(
        geo.rectangle_wkb(geo.envelope(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).alias("g")
    ).first()
    assert struct.unpack_from("<BIII", row.g) == (1, 3, 1, 5) and len(row.g) == 13 + 80
    assert struct.unpack_from("<dd", row.g, 13) == (0.0, 1.0)


def test_mercator(spark):
    got = spark.range(1).select(geo.mercator_to_lonlat(F.lit(0.5), F.lit(0.5)).alias("p")).first().p
    assert got.lon == pytest.approx(0) and got.lat == pytest.approx(0)
