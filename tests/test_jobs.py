"""Footers by ranges, whole-part replacement, accounting, discovery, fetching, ordered refresh."""

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tilework.functions import geo
from tilework.plans import build, fetch
from tilework.schema import C1, L2A
from tilework.sources import files, rest, sinks
from tilework.streaming import refresh


def geo_file(path, box):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = json.dumps({"columns": {"geometry": {"bbox": box}}})
    table = pa.table({"datetime": ["2024-01-05", "2024-03-01"], "pad": ["x" * 50_000] * 2})
    pq.write_table(table.replace_schema_metadata({"geo": text}), path)


def test_footers_through_both_routes(spark, tmp_path, monkeypatch):
    geo_file(tmp_path / "a.parquet", [1.0, 2.0, 3.0, 4.0])
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "b.parquet"))

    def seen():
        boxes = sorted(map(str, files.geo_boxes(spark, [str(tmp_path)]).values()))
        groups = [(r["rows"], r.low, r.high) for r in files.row_groups(spark, [str(tmp_path / "a.parquet")], "datetime").collect()]
        return boxes, groups

    want = ["None", "[1.0, 2.0, 3.0, 4.0]"], [(2, "2024-01-05", "2024-03-01")]
    assert seen() == want
    monkeypatch.setattr(files, "_arrow_reads", lambda path: False)
    assert seen() == want
    assert files.row_groups(spark, [], "x").count() == 0


def test_only_the_footer_is_read():
    tail = files._Tail(1000, b"0123456789")
    assert (tail.seek(-4, 2), tail.read(), tail.tell()) == (996, b"6789", 1000)
    tail.seek(0)
    with pytest.raises(OSError):
        tail.read(4)


def test_a_part_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "part")
    assert sinks.replace_part(spark.range(5), path, 5) == 5
    with pytest.raises(ValueError, match="not 9"):
        sinks.replace_part(spark.range(3), path, 9)
    assert spark.read.parquet(path).count() == 5 and not list(tmp_path.glob(".*part"))
    assert sinks.replace_part(spark.range(2), path) == 2 and spark.read.parquet(path).count() == 2


def test_aligned_parts(spark, tmp_path):
    rows = spark.range(1000).select("id", (F.col("id") % 3 + 1).cast("int").alias("m"), F.when(F.col("id") < 900, "a").otherwise("b").alias("part"))
    path = str(tmp_path / "p")
    assert sinks.write_aligned_parts(rows, path, "part", "m", ["id"], 120, 3) == [("a", 900, 9), ("b", 100, 3)]
    meta = pq.ParquetFile(tmp_path / "p" / "a.parquet").metadata
    assert [meta.row_group(g).num_rows for g in range(meta.num_row_groups)] == [120, 120, 60] * 3
    ids = pq.read_table(tmp_path / "p" / "a.parquet").to_pydict()
    assert sorted(ids["id"]) == list(range(900)) and ids["m"] == sorted(ids["m"])
    assert sinks.write_aligned_parts(rows.where("part = 'b'"), path, "part", "m", ["id"], 50, 3) == [("b", 100, 3)]
    assert sorted(p.name for p in (tmp_path / "p").glob("*")) == ["a.parquet", "b.parquet"] and not list((tmp_path / "p").glob(".*.part"))
    with pytest.raises(Exception, match="no month"):
        sinks.write_aligned_parts(rows.withColumn("m", F.lit(None).cast("int")), path, "part", "m", ["id"], 50, 3)


def items(spark, rows):
    df = spark.createDataFrame(rows, "id string, at string, `s2:generation_time` string, `s2:mgrs_tile` string, `eo:cloud_cover` double")
    return df.withColumn("datetime", F.to_timestamp("at")).drop("at")


ROWS = [
    ("a", "2024-03-01 00:00:00", "2", "31UFU", 5.0), ("a", "2024-03-01 00:00:00", "1", "31UFU", 6.0), ("b", "2024-04-01 00:00:00", "1", "1UFU", 7.0),
    ("c", "2024-05-01 00:00:00", "1", "40UFU", 8.0), ("d", "2023-05-01 00:00:00", "1", "40UFU", 9.0),
]


def test_every_staged_row_has_a_fate(spark, tmp_path, monkeypatch):
    source, accounts = str(tmp_path / "in"), {}
    items(spark, ROWS).write.parquet(source)
    archive = spark.createDataFrame([("b", "1", 4), ("a", "1", 3)], "id string, `s2:generation_time` string, _month int")
    got = build.build_year(spark, [source], L2A, 2024, str(tmp_path / "out"), accounts, archive=archive, names=["z21-31"])
    assert got == {"z21-31": 1} and accounts == {"staged": 3, "written": 1, "skipped": 1, "dropped": 1}
    # Rows that go missing between source and parts stop the job.
    whole = build.year_fates
    monkeypatch.setattr(build, "year_fates", lambda *a, **k: whole(*a, **k).where("id <> 'c'"))
    with pytest.raises(ValueError, match="are not 3 staged"):
        build.build_year(spark, [source], L2A, 2024, str(tmp_path / "out2"))


def test_discovery_never_shrinks_the_record(spark, tmp_path):
    geo_file(tmp_path / "year=2022" / "part=z01-15" / "x.parquet", [1.0, 2.0, 3.0, 4.0])
    geo_file(tmp_path / "year=2022" / "part=z21-31" / "x.parquet", [5.0, -2.0, 6.0, 1.0])
    found = build.discover(spark, str(tmp_path), L2A, 2022)
    assert {n for n, (state, _) in found.items() if state == build.PRESENT} == {"z01-15", "z21-31"}
    first = build.build_item(L2A, 2022, found)
    assert (first["bbox"], first["properties"]["table:row_count"], first["properties"]["start_datetime"]) == ([1.0, -2.0, 6.0, 4.0], 4, "2024-01-05")

    def flaky(path):
        if "z01-15" in path:
            raise OSError("no answer")
        return False

    again = build.build_item(L2A, 2022, build.discover(spark, str(tmp_path), L2A, 2022, check=flaky), first)
    assert list(again["assets"]) == ["z01-15"] and again["assets"]["z01-15"] == first["assets"]["z01-15"]

    def unread(path):
        raise OSError("no footer")

    assert build.build_item(L2A, 2022, build.discover(spark, str(tmp_path), L2A, 2022, measure=unread), first)["assets"] == first["assets"]
    assert build.build_item(L2A, 2022, build.discover(spark, str(tmp_path), L2A, 2022, check=lambda p: False), first) is None
    assert set(build.discover(spark, str(tmp_path), C1, 2022, check=lambda p: False)) == {"items", "live", *[f"live-{m:02d}" for m in range(1, 13)]}


def test_listings_page_by_page(monkeypatch):
    pages = {None: "<Key>p/a&amp;b</Key><NextContinuationToken>t&amp;1</NextContinuationToken>", "t&1": "<Key>p/c</Key>"}

    def answer(url):
        from urllib.parse import parse_qs, urlsplit

        query = parse_qs(urlsplit(url).query)
        assert query["prefix"] == ["p/2024/3/"]
        return pages[query.get("continuation-token", [None])[0]]

    monkeypatch.setattr(rest, "http_get", answer)
    assert rest.http_list("https://host/p/2024/3/") == ["p/a&b", "p/c"]


def test_nothing_missing_is_nothing_fetched(spark, tmp_path):
    none = spark.createDataFrame([], "key string")
    assert fetch.repair_months(spark, none, spark.createDataFrame([], "id string"), L2A, ["2024-03"], str(tmp_path / "o"), "tilework.round_trips:object_of") == 0


def test_new_months_are_published_first_and_years_spliced(spark, tmp_path):
    live, out, seen = str(tmp_path / "live"), str(tmp_path / "stats"), []
    rows = items(spark, ROWS).withColumn("m", F.month("datetime"))
    hook = refresh.splice_stats(spark, out, lambda: spark.read.parquet(live), L2A)

    def after(ready, epoch):
        seen.append(sorted(r.m for r in spark.read.parquet(live).select("m").distinct().collect()))
        hook(ready, epoch)

    write = refresh.live_writer(spark, live, None, key="id", version="s2:generation_time", month="m", after=after)
    write(rows.where("id in ('a', 'd')"), 0)
    table = lambda: {(r.mgrs_tile, r.year, r.month): r.min_cloud_cover for r in spark.read.parquet(f"{out}/mgrs-monthly").collect()}
    assert table() == {("31UFU", 2024, 3): 5, ("40UFU", 2023, 5): 9}
    write(rows.where("id in ('b', 'c')"), 1)
    assert seen == [[3, 5], [3, 4, 5]]
    assert table() == {("31UFU", 2024, 3): 5, ("1UFU", 2024, 4): 7, ("40UFU", 2024, 5): 8, ("40UFU", 2023, 5): 9}
    write(rows.where("id in ('b', 'c')"), 1)
    assert spark.read.parquet(live).count() == 4 and len(table()) == 4


def test_rings_and_windows(spark):
    cases = [
        ([0, 10, 10, 0], [0, 0, 10, 10], True),  # the window is inside
        ([2, 3, 2], [2, 2, 3], True),  # the ring is inside
        ([-5, 20, 20], [4, 4.5, 5], True),  # it crosses without a corner in the window
        ([6, 9, 9, 6], [0, 0, 9, 9], False), ([5, 9, 9], [1, 0, 2], True),  # a corner on the border
        ([0, 10, 10, 9, 9, 0], [0, 0, 10, 10, 0.5, 0.5], False),  # a hook around it
        ([3], [3], True), ([9], [9], False), ([], [], False),
    ]
    df = spark.createDataFrame([(i, list(map(float, x)), list(map(float, y))) for i, (x, y, _) in enumerate(cases)], "i int, x array<double>, y array<double>")
    got = {r.i: r.m for r in df.select("i", geo.ring_intersects(F.col("x"), F.col("y"), 1, 1, 5, 5).alias("m")).collect()}
    assert [got[i] for i in range(len(cases))] == [c for *_, c in cases]
