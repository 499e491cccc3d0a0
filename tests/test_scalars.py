"""Scalar rules, documents and small driver-side helpers."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tilework.functions import scalars
from tilework.plans import build
from tilework.schema import L2A, conform
from tilework.sources import files, sinks


def one(spark, **columns):
    return spark.range(1).select(*[v.alias(k) for k, v in columns.items()]).first()


def test_months_are_inclusive_and_empty_if_reversed(spark):
    d = lambda x: F.lit(x).cast("date")
    got = one(spark, a=scalars.months_between(d("2023-11-15"), d("2024-02-01")), b=scalars.months_between(d("2024-02-01"), d("2023-11-15")))
    assert [x.isoformat()[:7] for x in got.a] == ["2023-11", "2023-12", "2024-01", "2024-02"] and got.b == []


def test_window_months():
    assert scalars.window_months(2024, "2023-11-05", "2024-02-01") == [1, 2]
    assert scalars.window_months(2023, "2023-11-05", "2024-02-01") == [11, 12]
    assert scalars.window_months(2025, "2023-11-05", "2024-02-01") == []


def test_day_windows_and_widening(spark):
    d = lambda x: F.lit(x).cast("date")
    low, high = scalars.widen_window(d("2024-01-31"), d("2024-01-31"))
    got = one(spark, w=scalars.day_windows(d("2024-01-01"), d("2024-01-06"), 4), low=low, high=high)
    assert [(x["from"].day, x["to"].day) for x in got.w] == [(1, 4), (5, 6)]
    assert (got.low, got.high) == (dt.date(2023, 12, 31), dt.date(2024, 2, 29))


def test_times_have_the_shortest_fraction(spark):
    t = lambda x: scalars.rfc3339(F.to_timestamp(F.lit(x)))
    got = one(spark, a=t("2024-01-01 10:00:00"), b=t("2024-01-01 10:00:00.120"), c=t("2024-01-01 10:00:00.000120"))
    assert tuple(got) == ("2024-01-01T10:00:00Z", "2024-01-01T10:00:00.120Z", "2024-01-01T10:00:00.000120Z")


def test_ramp_curve_shade(spark):
    got = one(
        spark, a=scalars.on_ramp("scene_count", F.lit(20)), b=scalars.on_ramp("max_cover", F.lit(70)), c=scalars.on_ramp("min_cloud_cover", F.lit(7)),
        d=scalars.curve(F.lit(0.25), "sqrt"), e=scalars.curve(F.lit(1.0), "log", 2), f=scalars.curve(F.lit(0.0)), g=scalars.shade(F.lit(9), F.lit(9)),
    )
    assert tuple(got) == (0.0, 30.0, 7.0, 128, 255, 0, 1.0)


def test_percent_and_offset(spark):
    v = lambda x: scalars.percent(F.lit(x).cast("double"))
    got = one(spark, a=v(None), b=v(-0.5), c=v(100.5), d=v(12.5), e=scalars.boa_offset(F.lit("03.99")), f=scalars.boa_offset(F.lit("04.00")), g=scalars.boa_offset(F.lit("4.0")))
    assert tuple(got) == (None, 0, 100, 13, 0, 1000, None)


def test_scene_ids(spark):
    item = F.lit("S2C_53HNV_20260910_0_L2A")
    got = one(spark, day=scalars.scene_day(item, L2A.id_pattern), tile=scalars.scene_tile(item, L2A.id_pattern), bad=scalars.scene_day(F.lit("x"), L2A.id_pattern))
    assert tuple(got) == (dt.date(2026, 9, 10), "53HNV", None)


def test_scene_dir(spark):
    d = lambda u, *h: scalars.scene_dir(F.lit(u), *h)
    got = one(
        spark, a=d("https://b.s3.amazonaws.com/x/y/t.jpg?a=/b#c"), b=d("http://b.amazonaws.com/t.jpg"), c=d("https://evilamazonaws.com/t.jpg"),
        e=d("https://a.own.org/k/t.jpg", ("own.org",)), f=d(None),
    )
    assert tuple(got) == ("https://b.s3.amazonaws.com/x/y", None, None, "https://a.own.org/k", None)


def test_documents(spark):
    row = {"year": 2024, "xmin": 0.0, "ymin": 1.0, "xmax": 2.0, "ymax": 3.0, "start": "a", "end": "b", "rows": 5}
    doc = sinks.year_document(row, "c", [{"part": "items", "rows": 5}])
    assert doc["bbox"] == [0.0, 1.0, 2.0, 3.0] and doc["assets"]["items"]["table:row_count"] == 5
    index = json.loads(sinks.sidecar([{"group": 0, "rows": 3, "low": "a", "high": "b", "bytes": 9}], ["id"]))
    assert index == {"columns": ["id"], "groups": [{"group": 0, "rows": 3, "low": "a", "high": "b"}]}
    assert files.geo_bbox({b"geo": json.dumps({"columns": {"geometry": {"bbox": [1, 2, 3, 4]}}}).encode()}) == [1, 2, 3, 4]
    assert files.geo_bbox({}) is None
    assert {tuple(r) for r in sinks.window_manifest(spark, {"2024-01-01": 0, "2024-01-02": 7}).collect()} == {("2024-01-01", 0), ("2024-01-02", 7)}


def test_object_folders(spark):
    prefixes = files.inline(spark, [("root/31/U/FU/",), ("root/1/C/DK",)], "prefix string")
    months = files.inline(spark, [(2024, 3), (2024, 12)], "year int, month int")
    got = sorted(r.folder for r in files.object_keys(prefixes, months).collect())
    assert got == ["root/1/C/DK/2024/12", "root/1/C/DK/2024/3", "root/31/U/FU/2024/12", "root/31/U/FU/2024/3"]


def test_footer_aggregates(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.parquet.aggregatePushdown", "spark.sql.sources.useV1SourceList")}
    try:
        files.enable_footer_aggregates(spark)
        df = files.footer_stats(spark.read.parquet(path), "id")
        assert tuple(df.first()) == (100, 0, 99)
        assert "PushedAggregation: [COUNT(*)" in df._jdf.queryExecution().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_footprints_of_items(spark):
    df = spark.createDataFrame(
        [("31UFU", [3.0, 51.0, 4.0, 52.0], (3.0, 51.0, 4.0, 52.0)), ("60GYV", [179.36, -41.0, -179.85, -40.0], (-179.85, -41.0, 179.36, -40.0))],
        "`s2:mgrs_tile` string, bbox array<double>, _envelope struct<xmin:double,ymin:double,xmax:double,ymax:double>",
    )
    got = build.build_footprints(df, L2A).collect()
    assert [(r.tile, tuple(r.pieces[0])) for r in got] == [("31UFU", (3.0, 51.0, 4.0, 52.0))]


def test_conform_refuses_nothing_and_orders(spark):
    df = spark.createDataFrame([("1", 2)], "b string, a int")
    row = conform(df, [("a", "bigint"), ("c", "double"), ("b", "int")]).first()
    assert row.asDict() == {"a": 2, "c": None, "b": 1}


def test_every_month_is_listed(spark):
    months = spark.range(1300).selectExpr("cast(id as int) as year", "1 as month")
    assert files.object_keys(files.inline(spark, [("a/",)], "prefix string"), months).count() == 1300
