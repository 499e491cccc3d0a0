"""Versions: the latest of each key, what an archive already holds, splices and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..schema import q

#: So many periods at most go into a filter of the archive's scan.
MOST_PERIODS = 10_000


def latest_by(df: DataFrame, key: Sequence[str] | str, version: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row of each key, the one with the greatest version (null last); ``ties`` make it deterministic.

    Written as a maximum over a struct and not as a row number: the maximum is taken
    before the exchange, so a key with very many versions sends one row a task. Spark
    keeps such maxima in sorted aggregates: a task sorts its own rows by key on either
    side of the exchange, and spills where they do not fit, but no task gets all rows of
    a key. Columns must be comparable (no maps).
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(
        q(version).isNotNull().alias("_v"), *[q(c).alias(f"_{i}") for i, c in enumerate([version, *ties])],
        F.struct(*[q(c) for c in rest]).alias("_row"),
    )
    best = df.groupBy(*[q(k) for k in keys]).agg(F.max(order).alias("_best"))
    return best.select(*[(q(c) if c in keys else F.col("_best._row")[c]).alias(c) for c in df.columns])


def latest_by_rank(df: DataFrame, key: Sequence[str] | str, version: str, ties: Sequence[str] = ()) -> DataFrame:
    """As ``latest_by``, through a row number; for rows that hold maps. Spark prunes each task's groups first."""
    keys = [key] if isinstance(key, str) else list(key)
    window = W.partitionBy(*[q(k) for k in keys]).orderBy(q(version).desc_nulls_last(), *[q(t).desc_nulls_last() for t in ties])
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def latest_versions(df: DataFrame, key: str, version: str) -> DataFrame:
    """``key, version``: the greatest version of each key."""
    return df.groupBy(q(key)).agg(F.max(q(version)).alias(version))


def drop_keys(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``other``; a null key never matches, so its rows stay."""
    return df.join(other.select(q(key)).distinct(), key, "left_anti")


def mark_archived(staged: DataFrame, archive: DataFrame, key: str, version: str, period: Column | None = None, name: str = "_archived") -> DataFrame:
    """Staged rows with ``name``: whether the archive holds their key in the same or a newer version.

    A staged row of an archived key is new only if its version is strictly greater;
    a null staged version never is, and any version beats a null archived one. With
    ``period`` (an expression over both tables) only the archive's rows of the periods
    that occur in the staged rows are consulted; that list is small and is pushed into
    the archive's scan.
    """
    if period is not None:
        # Months of one staging run: a handful of values. More than the bound are met by a semi-join instead.
        found = staged.select(period.alias("_period")).where("_period is not null").distinct()
        periods = [r[0] for r in found.limit(MOST_PERIODS + 1).collect()]
        if len(periods) > MOST_PERIODS:
            archive = archive.withColumn("_period", period).join(found, "_period", "left_semi").drop("_period")
        else:
            archive = archive.where(period.isin(periods)) if periods else archive.limit(0)
    held = latest_versions(archive, key, version).select(q(key).alias("_key"), q(version).alias("_held"))
    met = staged.join(held, q(key) == F.col("_key"), "left")
    newer = F.coalesce(q(version) > F.col("_held"), q(version).isNotNull() & F.col("_held").isNull())
    return met.withColumn(name, F.col("_key").isNotNull() & ~newer).drop("_key", "_held")


def exclude_archived(staged: DataFrame, archive: DataFrame, key: str, version: str, period: Column | None = None) -> DataFrame:
    """Staged rows that the archive does not hold in the same or a newer version, by the rules of ``mark_archived``."""
    return mark_archived(staged, archive, key, version, period).where("not _archived").drop("_archived")


def splice_years(existing: DataFrame, fresh: DataFrame, years: Sequence[int], year: str = "year") -> DataFrame:
    """The existing table with the rows of ``years`` replaced by the fresh ones; other years pass untouched."""
    kept = existing.where(~q(year).isin(list(years)) | q(year).isNull())
    return kept.unionByName(fresh.where(q(year).isin(list(years))))


def fold(*parts: DataFrame, order: str | None = None) -> DataFrame:
    """All rows of all parts by column name, duplicates kept, in order within partitions of the key's range."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.orderBy(q(order).asc_nulls_last()) if order else out


def consolidate(archive: DataFrame, live: DataFrame, key: str, version: str, ties: Sequence[str] = ()) -> DataFrame:
    """Archive and live tail as one, the latest version of each key."""
    return latest_by(archive.unionByName(live, allowMissingColumns=True), key, version, ties)


def account(staged: int, written: int, skipped: int, dropped: int) -> None:
    """Stop unless every staged row is accounted for."""
    if written + skipped + dropped != staged:
        raise ValueError(f"{written} written + {skipped} skipped + {dropped} dropped rows are not {staged} staged")


def union_sets(measured: Column, recorded: Column) -> Column:
    """Sorted union of two arrays without nulls."""
    empty = F.array().cast("array<string>")
    both = F.array_union(F.coalesce(measured, empty), F.coalesce(recorded, empty))
    return F.array_sort(F.filter(both, lambda x: x.isNotNull()))
