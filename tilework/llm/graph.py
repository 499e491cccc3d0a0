"""Connected components over an edge table, by hash-to-min with pointer jumping.

Every round is two shuffles of narrow rows: labels flow over the edges (partial
minimum before the exchange, so a hub with a third of all edges sends one row per
task), then each label jumps to its own label. Rounds are written to the shared
checkpoint folder; the driver sees one count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label``: the least node of each component, for every node that has an edge."""
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(
        edges.select(F.col(b).alias("node"), F.col(a).alias("other"))
    )
    links = scratch.save(both.where("node <> other").distinct())
    path = scratch.write(links.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        labels = scratch.spark.read.parquet(path)
        heard = (
            links.join(labels.withColumnRenamed("node", "other"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("heard"))
        )
        least = labels.join(heard, "node").select("node", F.least("label", "heard").alias("near"), "label")
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        moved = least.join(jump, "near", "left").select(
            "node", F.least("near", F.coalesce("far", "near")).alias("label"), F.col("label").alias("was")
        )
        after = scratch.write(moved.select("node", "label", (F.col("label") != F.col("was")).alias("moved")))
        changed = scratch.spark.read.parquet(after).where("moved").limit(1).count()
        scratch.drop(path)
        path = after
        if not changed:
            return scratch.spark.read.parquet(path).select("node", "label")
