"""URL rules by expression expansion.

A URL is expanded into expressions: every suffix of its host that starts at a label,
combined with every prefix of its path that ends at a slash, and the empty prefix.
Rules are filed under their host and the part of their path up to its last slash.
Expressions and rules meet in an equi-join on a short prefix of a SHA-256 digest;
the full digest then confirms the hit, and the rest of the rule's path (after its
last slash) is compared directly. Among confirmed rules the longest wins: by length
of host and path together, then of the host, then block before allow.

Only distinct (host, path) pairs are expanded, so a URL that holds a third of all
rows costs one expansion. No pair is expanded deeper than the deepest rule, which
loses nothing. Rules are broadcast up to ``broadcast_rules`` rows, a counted bound;
beyond it the join shuffles both sides.

Defined results: null URLs and URLs without ``://`` have an empty host and path and
take the default verdict; repeated rows are judged each; repeated rules count once;
rules with a null host never fit, a null rule path is the empty path; extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column, most: Column | int) -> Column:
    """The host and what follows each of its dots, at most ``most`` labels long."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    take = F.least(n, F.lit(most) if isinstance(most, int) else most)
    return F.transform(F.sequence(F.lit(1), take), lambda i: F.array_join(F.slice(labels, n - i + 1, i), "."))


def path_prefixes(path: Column, most: int) -> Column:
    """The empty prefix and the prefixes that end at a slash, at most ``most`` slashes deep."""
    parts = F.split(path, "/")
    deep = F.least(F.size(parts) - 1, F.lit(most))
    slashed = F.transform(
        F.sequence(F.lit(1), deep), lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))
    )
    return F.when(deep < 1, F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), slashed))


def _expression(host: Column, prefix: Column) -> Column:
    # A space cannot be taken for part of either side: it ends the host here.
    return F.concat(host, F.lit(" "), prefix)


def judge(
    pages: DataFrame,
    rules: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    short: int = 8,
    broadcast_rules: int = 100_000,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each page; ``rules`` has ``host, path, verdict``."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    filed = (
        rules.where("host is not null")
        .select(F.col("host").alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
        .distinct()
        .withColumn("stem", F.regexp_extract("rule_path", r"(?s)^(.*/)?", 1))
        .withColumn("digest", F.sha2(_expression(F.col("rule_host"), F.col("stem")), 256))
        .withColumn("short", F.substring("digest", 1, short))
    )
    size = filed.agg(
        F.count("*").alias("n"),
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.max(F.size(F.split("stem", "/")) - 1).alias("slashes"),
    ).first()
    if size.n <= broadcast_rules:
        filed = F.broadcast(filed)
    distinct = rows.where("host <> ''").select("host", "path").distinct()
    expanded = (
        distinct.select("host", "path", F.explode(host_suffixes(F.col("host"), size.labels or 1)).alias("suffix"))
        .select("host", "path", "suffix", F.explode(path_prefixes(F.col("path"), size.slashes or 0)).alias("prefix"))
        .withColumn("own", F.sha2(_expression(F.col("suffix"), F.col("prefix")), 256))
        .select("host", "path", "own", F.substring("own", 1, short).alias("short"))
    )
    hits = expanded.join(filed, "short").where("own = digest and startswith(path, rule_path)")
    order = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("whole"),
        F.length("rule_host").alias("host_length"),
        (F.col("verdict") == "block").cast("int").alias("block"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("verdict").alias("verdict"),
    )
    judged = hits.groupBy("host", "path").agg(F.max(order).alias("best"))
    judged = judged.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    return rows.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
