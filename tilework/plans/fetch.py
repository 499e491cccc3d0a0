"""Fetching items: windows of an item API, and objects that an audit found missing. Both go on where they stopped."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import audit
from ..schema import Collection, conform_items, normalise
from ..sources import files, rest, sinks


def _written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return files.read_present(spark, [path], schema) if files.exists(spark, path) else spark.createDataFrame([], schema)


def fetch_windows(spark: SparkSession, out: str, *, start: str, end: str, days: int = 1, **options) -> list[tuple[str, str]]:
    """Fetch the windows of ``start``..``end`` that ``out`` does not hold yet. Returns those that were fetched.

    Items are written as documents in folders ``window=<first day>``; a window that runs again
    replaces its folder. The manifest, written last, names every fetched window with its
    rows, also those without any, which are not asked for again.
    """
    manifest = f"{out.rstrip('/')}/_windows"
    known = {r.window for r in _written(spark, manifest, "window string, rows bigint").collect()}
    missing = rest.missing_windows(rest.windows(start, end, days), known)
    if not missing:
        return []
    rest.register(spark)
    items = spark.read.format("item_api").options(windows=json.dumps(missing), **options).load()
    items.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("window").parquet(f"{out}/items")
    firsts = [first for first, _ in missing]
    there = files.present(spark, [f"{out}/items/window={first}" for first in firsts])
    counts = {first: 0 for first in firsts}
    if there:
        rows = spark.read.option("basePath", f"{out}/items").parquet(*there)
        counts |= {str(r.window): r["n"] for r in rows.groupBy("window").agg(F.count("*").alias("n")).collect()}
    sinks.window_manifest(spark, counts).coalesce(1).write.mode("append").parquet(manifest)
    return missing


def missing_objects(inventory: DataFrame, published: DataFrame, config: Collection, months: list[str], done: DataFrame | None = None) -> DataFrame:
    """``key, id`` of the items of an inventory's months that are neither published nor repaired already."""
    key = F.col("key")
    named = inventory.where(audit.item_key(key, config.key_root, months)).select("key", F.regexp_extract(key, audit.KEY_TAIL, 4).alias("id"))
    for held in (published, done):
        if held is not None:
            named = named.join(held.select("id").distinct(), "id", "left_anti")
    return named.select("key", "id")


def repair_months(spark: SparkSession, inventory: DataFrame, published: DataFrame, config: Collection, months: list[str], out: str,
                  transport: str = "tilework.sources.rest:http_get") -> int:
    """Get the objects that an inventory has and the published table lacks, one request each, and append them to ``out``.

    Objects that an earlier run has written are not asked for again; an object that is gone
    since the inventory was made gives no row. Returns the rows that were added.
    """
    kinds = ", ".join(f"`{n}` {t}" for n, t in config.columns)
    done = _written(spark, out, kinds)
    wanted = missing_objects(inventory, published, config, months, done)
    staged = f"{out.rstrip('/')}.staged"
    got = rest.get_objects(wanted, transport).where("value is not null")
    # Written once: requests must not be repeated by a second pass over the plan.
    got.write.mode("overwrite").parquet(staged)
    ready = spark.read.parquet(staged)
    added = ready.count()
    if added:
        conform_items(normalise(ready, config), config).write.mode("append").parquet(out)
    files.delete(spark, staged)
    return added


def listed_folders(spark: SparkSession, prefixes: DataFrame, months: DataFrame, transport: str = "tilework.sources.rest:http_list") -> DataFrame:
    """``folder, key``: the objects of every prefix and month, as a store lists them."""
    return rest.list_objects(files.object_keys(prefixes, months), transport)
