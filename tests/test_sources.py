"""Listings, formats, manifests, the item API, normalising, conforming, the audit."""

import json

import pytest
from pyspark.sql import functions as F

from tilework.operators import audit
from tilework.plans import build
from tilework.schema import C1, L2A, collection, conform_items, normalise, read_by_name, unknown_properties
from tilework.sources import files, rest


def test_gather_skips_empty_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    (tmp_path / "zero.parquet").touch()
    found = files.gather(spark, [str(tmp_path)])
    assert found and not any(p.endswith("zero.parquet") for p in found)
    assert files.read_items(spark, [str(tmp_path)]).count() == 3
    with pytest.raises(ValueError):
        files.gather(spark, [str(tmp_path / "zero.parquet")])
    with pytest.raises(FileNotFoundError):
        files.gather(spark, [str(tmp_path / "none")])


def test_inventory_formats(spark, tmp_path):
    path = tmp_path / "i.csv"
    path.write_text('"b","k1","5","2024"\n"b","k2","6","2024"\n')
    assert [r.size for r in files.read_inventory(spark, [str(path)]).orderBy("key").collect()] == [5, 6]
    with pytest.raises(ValueError, match="parquet"):
        files.read_inventory(spark, ["a.csv", "b.parquet"])
    with pytest.raises(ValueError):
        files.read_inventory(spark, [])


def test_manifests():
    assert files.newest_manifest(["x/dt=2024-01/", "x/dt=2024-03/", "x/dt=2024-02/"]) == "x/dt=2024-03/symlink.txt"
    assert files.manifest_paths("s3://b/k\n\n s3://b/l \n") == ["s3a://b/k", "s3a://b/l"]
    with pytest.raises(ValueError):
        files.manifest_paths("http://x")


KEYS = [
    "root/31/U/FU/2024/3/A/A.json", "root/31/U/FU/2024/03/B/B.json", "root/31/U/FU/2024/3/A/side.json", "root/2019/x.json",
    "other/31/U/FU/2024/3/C/C.json", "root/1/C/DK/2023/12/D/D.json", "root/1/C/DK/2023/12/D/D.tif",
]


def test_expected_counts_and_audit(spark):
    inventory = spark.createDataFrame([(k,) for k in KEYS], "key string")
    assert {(r.year, r.month): r.expected for r in audit.expected_counts(inventory, "root/").collect()} == {(2024, 3): 2, (2023, 12): 1}
    assert {(r.year, r.month) for r in audit.expected_counts(inventory, "root/", ["2024-03"]).collect()} == {(2024, 3)}
    have = spark.createDataFrame([("2024-03-05", 3), ("2022-01-01", 1)], "d string, _month int").withColumn("datetime", F.to_timestamp("d"))
    got = {(r.year, r.month): (r.expected, r.have, r.delta, r.bad) for r in audit.audit(audit.expected_counts(inventory, "root/"), audit.have_counts(have), 1).collect()}
    assert got == {(2024, 3): (2, 1, -1, False), (2023, 12): (1, 0, -1, False), (2022, 1): (0, 1, 1, False)}


def item(**p):
    return json.dumps(
        {
            "id": p.pop("id", "S2A_31UFU_20240301_0_L2A"), "stac_version": "1.0.0", "bbox": [1.0, 2.0, 3.0, 4.0],
            "links": [{"rel": "next", "href": "n"}, {"rel": "canonical", "href": "c"}],
            "assets": {"thumbnail": {"href": "https://x/t.jpg"}}, "geometry": {"type": "Point", "coordinates": [1.5, 2.5]},
            "properties": {"datetime": "2024-03-01T10:00:00.123Z", **p},
        }
    )


def test_normalise_first_collection(spark):
    docs = spark.createDataFrame(
        [
            (item(**{"s2:mgrs_tile": "31UFU", "eo:cloud_cover": 12.5, "s2:product_uri": "X_R051_Y", "view:sun_elevation": 30.0, "new": 1}),),
            (item(**{"mgrs:utm_zone": 31, "mgrs:latitude_band": "U", "mgrs:grid_square": "GU", "sat:relative_orbit": 7, "view:sun_azimuth": 9.0}),),
        ],
        "value string",
    )
    a, b = normalise(docs, L2A).collect()
    assert (a["s2:mgrs_tile"], a["sat:relative_orbit"], a["s2:mean_solar_zenith"], a["eo:cloud_cover"]) == ("31UFU", 51, 60.0, 12.5)
    assert [x.rel for x in a["links"]] == ["canonical"] and a["thumbnail_url"] == "https://x/t.jpg" and tuple(a["_envelope"]) == (1.5, 2.5, 1.5, 2.5)
    assert (b["s2:mgrs_tile"], b["sat:relative_orbit"], b["s2:mean_solar_azimuth"], b["s2:granule_id"]) == ("31UGU", 7, 9.0, None)
    assert {(r.property, r.n) for r in unknown_properties(docs, L2A).collect()} >= {("new", 1), ("view:sun_azimuth", 1)}
    with pytest.raises(Exception, match="no tile"):
        normalise(spark.createDataFrame([(item(),)], "value string"), L2A).collect()


def test_normalise_second_collection(spark):
    doc = item(**{"grid:code": "MGRS-31UET", "created": "2024-04-01T00:00:00Z", "proj:centroid": {"lat": 1.0, "lon": 2.0}, "processing:software": {"a": "1"}, "storage:requester_pays": False})
    row = normalise(spark.createDataFrame([(doc,)], "value string"), C1).first()
    assert (row["_tile"], row["proj:centroid"].lat, row["processing:software"], row["storage:requester_pays"]) == ("31UET", 1.0, '{"a":"1"}', False)


def test_partial_chunks_build_a_year(spark, tmp_path):
    schema = "id string, at string, `s2:generation_time` string, `s2:mgrs_tile` string, `eo:cloud_cover` double, bbox array<double>"
    data = [
        ("A", "2024-03-01 00:00:00", "2024-03-01T12", "31UFU", 1.0, [1.0, 1.0, 2.0, 2.0]), ("A", "2024-03-01 00:00:00", "2024-03-02T09", "31UFU", 2.0, None),
        ("B", "2024-02-01 00:00:00", "2024-01-15", "1UFU", 3.0, None), ("C", "2023-12-31 00:00:00", "2023-12-31", "31UFU", 4.0, None),
    ]
    spark.createDataFrame(data, schema).withColumn("datetime", F.to_timestamp("at")).drop("at").write.parquet(str(tmp_path / "in"))
    got = build.build_year(spark, [str(tmp_path / "in")], L2A, 2024, str(tmp_path / "out"))
    assert got == {"z21-31": 1, "z01-15": 1}
    rows = files.read_partitioned(spark, str(tmp_path / "out")).collect()
    assert {(r.id, r["s2:generation_time"], r._month, r.year) for r in rows} == {("A", "2024-03-02T09", 3, 2024), ("B", "2024-01-15", 2, 2024)}
    assert build.build_year(spark, [str(tmp_path / "in")], L2A, 2020, str(tmp_path / "none")) == {"items": 0}


def test_an_unplaceable_tile_stops_the_build(spark):
    df = spark.createDataFrame([("A", "XXUFU")], "id string, `s2:mgrs_tile` string").withColumn("datetime", F.to_timestamp(F.lit("2024-01-01")))
    with pytest.raises(Exception, match="no part"):
        build.year_rows(df, L2A, 2024).collect()


def test_conform_types(spark):
    row = conform_items(spark.createDataFrame([("A",)], "id string").withColumn("datetime", F.to_timestamp(F.lit("2024-05-01"))), L2A)
    assert row.columns == [n for n, _ in L2A.columns] and row.first()._month == 5
    assert [f.dataType for f in row.schema] == [f.dataType for f in L2A.schema]
    both = read_by_name([spark.range(1), spark.range(1).withColumn("x", F.lit(1))])
    assert both.columns == ["id", "x"]
    with pytest.raises(ValueError, match="sentinel-2-l2a"):
        collection("nope")


def fake(url, body):
    page = body.get("page", 0)
    links = [{"rel": "next", "href": url, "merge": True, "body": {"page": page + 1}}] if page < 1 else []
    return {"features": [{"id": f"{body['datetime'][:10]}-{page}"}], "links": links}


def test_item_api(spark):
    rest.register(spark)
    rows = (
        spark.read.format("item_api")
        .options(url="http://x", collection="c", start="2024-01-01", end="2024-01-03", days="2", transport="tests.test_sources:fake")
        .load()
    )
    assert sorted(r.id for r in rows.collect()) == ["2024-01-01-0", "2024-01-01-1", "2024-01-03-0", "2024-01-03-1"]


def test_paging_and_waiting():
    assert rest.next_request({"links": []}, "u", {}) is None
    assert rest.next_request({"links": [{"rel": "next", "href": "v", "body": {"t": 1}}]}, "u", {"a": 1}) == ("v", {"t": 1})
    assert [rest.wait_seconds(i) for i in (0, 1, 6, 7)] == [5, 10, 300, 300]
    assert rest.missing_windows([("a", "b"), ("c", "d")], {"a"}) == [("c", "d")]


def test_three_states():
    def broken(_):
        raise OSError

    assert build.probe(lambda p: True, "x") == build.PRESENT and build.probe(lambda p: False, "x") == build.ABSENT
    assert build.probe(broken, "x") == build.UNKNOWN
    assert build.merge_record({"n": 2}, {"n": 1}, build.UNKNOWN) == {"n": 1} and build.merge_record({"n": 2}, {"n": 1}, build.ABSENT) is None
