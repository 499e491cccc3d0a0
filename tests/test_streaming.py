"""The refresh stream: reprocessed and archived items, replays."""

from pyspark.sql import functions as F

from tilework.streaming import refresh

SCHEMA = "id string, gen string, t timestamp, m int"


def rows(spark, data):
    return spark.createDataFrame(data, "id string, gen string, d string, m int").select("id", "gen", F.to_timestamp("d").alias("t"), "m")


def test_refresh_keeps_the_newest_and_leaves_other_months(spark, tmp_path):
    source, live = str(tmp_path / "in"), str(tmp_path / "live")
    archive = rows(spark, [("A", "5", "2024-01-01", 1)])
    rows(spark, [("A", "4", "2024-01-01", 1), ("B", "1", "2024-01-02", 1), ("C", "1", "2024-02-01", 2)]).coalesce(1).write.parquet(source)
    write = refresh.live_writer(spark, live, archive, key="id", version="gen", month="m")

    def once():
        refresh.run_refresh(spark.readStream.schema(SCHEMA).parquet(source), write, str(tmp_path / "check")).awaitTermination()
        return {(r.id, r.gen, r.m) for r in spark.read.parquet(live).collect()}

    assert once() == {("B", "1", 1), ("C", "1", 2)}
    rows(spark, [("A", "6", "2024-01-01", 1), ("B", "0", "2024-01-02", 1)]).coalesce(1).write.mode("append").parquet(source)
    assert once() == {("A", "6", 1), ("B", "1", 1), ("C", "1", 2)}
    write(rows(spark, [("A", "6", "2024-01-01", 1)]), 9)  # a replayed batch changes nothing
    assert {(r.id, r.gen) for r in spark.read.parquet(live).collect()} == {("A", "6"), ("B", "1"), ("C", "1")}


def test_stream_dedupe_and_counts(spark, tmp_path):
    source = str(tmp_path / "in")
    rows(spark, [("A", "1", "2024-01-01", 1), ("A", "1", "2024-01-02", 1), ("B", "1", "2024-02-02", 2)]).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    q = refresh.dedupe_stream(stream, "id", "t").writeStream.format("memory").queryName("deduped").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("deduped").count() == 2
    q = refresh.monthly_counts(stream, "id", "t").writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.id, r.n) for r in spark.table("counted").collect()} == {("A", 2), ("B", 1)}
