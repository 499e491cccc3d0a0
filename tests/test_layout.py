"""Row groups, spans, runs, footers, sinks."""

import pytest
from pyspark.sql import functions as F

from tilework.operators import layout
from tilework.sources import files, sinks


def test_month_aligned_groups(spark):
    rows = spark.range(135_000).select("id", (F.col("id") % 3 + 1).cast("int").alias("_month"), F.lit(2024).alias("year"))
    sizes = layout.group_sizes(layout.month_groups(rows, ["year"], "_month", ["id"], 20_000), ["year"], "_month").collect()
    assert sorted((r._month, r.group_no, r.rows) for r in sizes) == [(m, g, n) for m in (1, 2, 3) for g, n in enumerate((20_000, 20_000, 5_000))]


def test_a_missing_month_stops(spark):
    rows = spark.createDataFrame([(1, None)], "id int, _month int")
    with pytest.raises(Exception, match="no month"):
        layout.month_groups(rows, [], "_month", ["id"], 10).collect()


def test_month_aligned_files(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(250).select("id", (F.col("id") % 2 + 1).cast("int").alias("_month"))
    sinks.write_month_aligned(layout.month_groups(rows, [], "_month", ["id"], 100), str(tmp_path / "m"), "_month", ["id"], 100)
    sizes = sorted(pq.ParquetFile(p).metadata.num_rows for p in (tmp_path / "m").rglob("*.parquet"))
    assert sizes == [25, 25, 100, 100]


def test_sorted_parts_and_row_groups(spark, tmp_path):
    rows = spark.range(1000).select((999 - F.col("id")).alias("k"), F.lit("x").alias("v"))
    path = str(tmp_path / "s")
    sinks.write_sorted(rows, path, ["k"], 300, level=3, files=1)
    groups = files.row_groups(spark, [path], "k").orderBy("group").collect()
    assert [g.rows for g in groups] == [300, 300, 300, 100]
    assert [(g.low, g.high) for g in groups][:2] == [("0", "299"), ("300", "599")]
    assert [r.group for r in layout.admitted_groups(files.row_groups(spark, [path], "k"), F.col("low").cast("int"), F.col("high").cast("int"), 450).collect()] == [1]


def test_scatter(spark):
    rows = spark.range(100).select("id", (F.col("id") % 10).alias("key"), F.lit(1).alias("part"))
    assert layout.scatter(layout.row_group_ordinal(rows, ["part"], ["id"], 10), ["part"], ["key"]).first().scatter == 10
    assert layout.scatter(layout.row_group_ordinal(rows, ["part"], ["key", "id"], 10), ["part"], ["key"]).first().scatter == 1


def test_spans_runs_offsets_depth(spark):
    spans = spark.createDataFrame([(1, 0, 10), (1, 12, 20), (1, 2, 4), (1, 40, 50)], "p int, a int, b int")
    assert sorted((r.a, r.b, r.spans) for r in layout.merge_spans(spans, ["p"], "a", "b", 5).collect()) == [(0, 20, 3), (40, 50, 1)]
    states = spark.createDataFrame([(1, i, s) for i, s in enumerate("aabba")], "p int, i int, s string")
    assert [(r.state, r.length) for r in layout.run_lengths(states, ["p"], ["i"], F.col("s")).orderBy("run").collect()] == [("a", 2), ("b", 2), ("a", 1)]
    groups = spark.createDataFrame([(1, 0, 5), (1, 1, 7)], "p int, g int, rows long")
    assert [(r.row0, r.row1) for r in layout.running_offset(groups, ["p"], "g").orderBy("g").collect()] == [(0, 5), (5, 12)]
    requests = spark.createDataFrame([(1, 0, 5), (1, 1, 2), (1, 2, 3), (1, 4, 9)], "p int, start long, `end` long")
    assert layout.request_depth(requests, ["p"]).first().depth == 3


def test_empty_part_keeps_its_schema(spark, tmp_path):
    from tilework.schema import L2A

    path = str(tmp_path / "e")
    sinks.write_empty(spark, L2A.schema, path)
    back = spark.read.parquet(path)
    assert back.count() == 0 and back.columns == [n for n, _ in L2A.columns]


def test_png(spark):
    data = sinks.density_png([(0, 0, 1), (2, 1, 9)], 3, 2)
    assert data.startswith(b"\x89PNG") and b"IDAT" in data
