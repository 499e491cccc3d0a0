"""Versions: dedupe, exclusion from the archive, folds, accounting."""

import pytest

from tilework.operators import dedupe


def test_latest_keeps_the_later_generation(spark):
    df = spark.createDataFrame([("A", "2024-03-01T12", 1), ("A", "2024-03-02T09", 2), ("B", None, 3), ("B", "2024-01-15", 4), ("C", None, 5)], "id string, gen string, n int")
    expected = {("A", "2024-03-02T09", 2), ("B", "2024-01-15", 4), ("C", None, 5)}
    assert {tuple(r) for r in dedupe.latest_by(df, "id", "gen").collect()} == expected
    assert {tuple(r) for r in dedupe.latest_by_rank(df, "id", "gen").collect()} == expected


def rows(spark, data):
    return spark.createDataFrame(data, "id string, gen string, m int")


def test_versions_against_the_archive(spark):
    archive = rows(spark, [("R", "10", 3), ("S", "12", 3), ("T", "14", 3), ("N", None, 3), ("M", None, 3), ("P", "1", 3)])
    live = rows(spark, [("R", "11", 3), ("S", "12", 3), ("T", "13", 3), ("N", "1", 3), ("M", None, 3), ("P", None, 3), ("new", None, 3)])
    got = {r.id for r in dedupe.exclude_archived(live, archive, "id", "gen").collect()}
    assert got == {"R", "N", "new"}


def test_only_staged_periods_are_consulted(spark):
    from pyspark.sql import functions as F

    archive = rows(spark, [("A", "9", 3), ("D", "9", 3), ("B", "9", 5)])
    live = rows(spark, [("A", "1", 3), ("B", "1", 3), ("C", "1", 3)])
    assert {r.id for r in dedupe.exclude_archived(live, archive, "id", "gen", F.col("m")).collect()} == {"B", "C"}
    assert dedupe.exclude_archived(live.limit(0), archive, "id", "gen", F.col("m")).count() == 0


def test_null_keys_survive_the_anti_join(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    assert {r.k for r in dedupe.drop_keys(df, spark.createDataFrame([("a",), (None,)], "k string"), "k").collect()} == {None, "b"}


def test_fold_keeps_duplicates_in_order(spark):
    api = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2)], "id string, t int")
    repair = spark.createDataFrame([("c", 2), ("d", 0)], "id string, t int")
    got = [r.id for r in dedupe.fold(api, repair, order="t").collect()]
    assert sorted(got) == ["a", "b", "c", "c", "d"] and got[0] == "d" and got[-1] == "a"
    assert dedupe.consolidate(api, repair, "id", "t").count() == 4


def test_accounting_stops():
    dedupe.account(5, 3, 1, 1)
    with pytest.raises(ValueError):
        dedupe.account(5, 3, 1, 0)


def test_more_periods_than_the_bound_are_all_consulted(spark):
    from pyspark.sql import functions as F

    rows = spark.range(10_050).selectExpr("cast(id as string) as id", "'1' as gen", "id as m").coalesce(1)
    assert dedupe.exclude_archived(rows, rows, "id", "gen", F.col("m")).count() == 0
