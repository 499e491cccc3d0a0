"""Completeness: published counts against an object inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: tail of an item key: year, month (one or two digits), folder, file stem.
KEY_TAIL = r"/(\d{4})/(\d{1,2})/([^/]+)/([^/]+)\.json$"


def item_key(key: Column, root: str, months: Sequence[str] | None = None) -> Column:
    """Whether an object key is an item: under the root, self-named folder, and in one of the months if given."""
    part = lambda i: F.regexp_extract(key, KEY_TAIL, i)
    ok = key.startswith(root) & key.endswith(".json") & key.rlike(KEY_TAIL) & (part(3) == part(4))
    if months:
        wanted = [f"{m[:4]}-{int(m[5:])}" for m in months]
        ok = ok & F.concat_ws("-", part(1), part(2).try_cast("int").cast("string")).isin(wanted)
    return ok


def expected_counts(inventory: DataFrame, root: str, months: Sequence[str] | None = None, key: str = "key") -> DataFrame:
    """``year, month, expected`` from the keys of an inventory."""
    col = F.col(key)
    part = lambda i: F.regexp_extract(col, KEY_TAIL, i).cast("int")
    return inventory.where(item_key(col, root, months)).groupBy(part(1).alias("year"), part(2).alias("month")).agg(F.count("*").alias("expected"))


def have_counts(published: DataFrame, at: str = "datetime", month: str | None = "_month", months: Sequence[str] | None = None) -> DataFrame:
    """``year, month, have`` of published items."""
    by_month = F.col(month).cast("int") if month else F.month(at)
    out = published.groupBy(F.year(at).alias("year"), by_month.alias("month")).agg(F.count("*").alias("have"))
    if months:
        out = out.where(F.concat_ws("-", "year", F.lpad(F.col("month").cast("string"), 2, "0")).isin(list(months)))
    return out


def audit(expected: DataFrame, have: DataFrame, tolerance: int = 0) -> DataFrame:
    """``year, month, expected, have, delta, bad`` for every month on either side."""
    met = expected.join(have, ["year", "month"], "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    rows = met.select("year", "month", zero("expected"), zero("have"))
    delta = F.col("have") - F.col("expected")
    return rows.withColumn("delta", delta).withColumn("bad", F.abs(delta) > tolerance)


def object_diff(local: DataFrame, remote: DataFrame, trust_multipart: bool = False) -> DataFrame:
    """``key, reason`` of local objects to upload: absent, of another size, or of another checksum.

    Both have ``key, size, checksum``. A remote multipart checksum (with a dash) tells
    nothing about the content, so there the size decides.
    """
    there = remote.select("key", F.col("size").alias("r_size"), F.col("checksum").alias("r_sum"))
    comparable = ~F.coalesce(F.col("r_sum").contains("-"), F.lit(True))
    reason = (
        F.when(F.col("r_size").isNull(), "absent")
        .when(F.col("r_size") != F.col("size"), "size")
        .when(comparable & (F.col("r_sum") != F.col("checksum")), "checksum")
    )
    return local.join(there, "key", "left").select("key", reason.alias("reason")).where("reason is not null")


def plan_consolidation(parts: DataFrame) -> DataFrame:
    """``year, parts`` of the years whose live tail holds rows. ``parts`` has ``year, part, rows``."""
    live = (F.col("part") == "live") | F.col("part").startswith("live-")
    return parts.where(live & (F.col("rows") > 0)).groupBy("year").agg(F.array_sort(F.collect_set("part")).alias("parts"))
