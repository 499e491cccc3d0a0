"""Whole jobs made of the operators: a year's parts, the statistics products, the audit, discovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import geo
from ..functions.scalars import zone_of
from ..operators import audit as audits, dedupe, stats
from ..schema import L2A, Collection, conform_items, q, upgrade_stats
from ..sources import files, sinks

#: Fixed value: the first year whose parts are sorted by tile within the month.
TILE_SORT_FROM = 2026


WRITTEN, SKIPPED, DROPPED = "written", "skipped", "dropped"


def year_fates(items: DataFrame, config: Collection, year: int, months: Sequence[int] | None = None, archive: DataFrame | None = None,
               names: Sequence[str] | None = None, live: bool = False) -> DataFrame:
    """The latest version of each id of a year, conformed, with ``year``, ``part`` and ``_fate``.

    The fate of a row: ``dropped`` if the archive holds it in the same or a newer version,
    ``skipped`` if its part is not among ``names``, else ``written``. A tile whose zone no
    part holds stops the job.
    """
    rows = dedupe.latest_by(conform_items(in_year(items, year, months), config), "id", config.version_column, ["datetime"])
    gone = F.lit(False)
    if archive is not None:
        rows = dedupe.mark_archived(rows, archive, "id", config.version_column, q("_month"))
        gone = F.col("_archived")
    tile = q(config.tile_column)
    if live:
        part = F.concat(F.lit("live-"), F.lpad(q("_month").cast("string"), 2, "0")) if config.monthly_live else F.lit("live")
    elif geo.tier(year, config.zone_split):
        found = geo.part_of(zone_of(tile), year)
        part = F.when(found.isNull(), F.raise_error(F.concat(F.lit("no part for tile "), F.coalesce(tile, F.lit("NULL"))))).otherwise(found)
    else:
        part = F.lit("items")
    named = F.lit(True)
    if names is not None:
        geo.only_parts(year, list(names), config.zone_split)
        named = F.col("part").isin(list(names))
    routed = rows.withColumn("year", F.lit(year)).withColumn("part", part)
    fate = F.when(gone, DROPPED).when(~named, SKIPPED).otherwise(WRITTEN)
    return routed.withColumn("_fate", fate).select(*[q(n) for n, _ in config.columns], "year", "part", "_fate")


def in_year(items: DataFrame, year: int, months: Sequence[int] | None = None) -> DataFrame:
    at = q("datetime")
    return items.where((F.year(at) == year) & (F.month(at).isin(list(months)) if months else F.lit(True)))


def year_rows(items: DataFrame, config: Collection, year: int, **options) -> DataFrame:
    """The rows of a year's parts with ``year`` and ``part``: those of ``year_fates`` that are written."""
    return year_fates(items, config, year, **options).where(F.col("_fate") == WRITTEN).drop("_fate")


def build_year(spark: SparkSession, sources: Sequence[str], config: Collection, year: int, out: str, accounts: dict | None = None, **options) -> dict:
    """Write a year's parts below ``out`` and account for every staged row.

    The rows are staged as Parquet first, with their fates: range partitioning reads its
    input twice, and the deduplication should run once. The distinct ids of the sources,
    counted on their own, must be the rows found in the written parts and those skipped and
    dropped; else the job stops. ``accounts`` receives the four counts. Returns rows by
    part; a build without rows writes an empty ``items`` part.
    """
    items = files.read_items(spark, sources)
    staged = f"{out.rstrip('/')}/_staged-{year}"
    year_fates(items, config, year, **options).write.mode("overwrite").parquet(staged)
    ready = spark.read.parquet(staged)
    counts = {(r["_fate"], r.part): r["n"] for r in ready.groupBy("_fate", "part").agg(F.count("*").alias("n")).collect()}
    by_part = {part: n for (fate, part), n in counts.items() if fate == WRITTEN}
    total = lambda fate: sum(n for (f, _), n in counts.items() if f == fate)
    written = 0
    if by_part:
        keys = config.sort_keys if config is not L2A or year >= TILE_SORT_FROM else ("_month", "_hilbert")
        sinks.write_parts(ready.where(F.col("_fate") == WRITTEN).drop("_fate"), out, keys, config.row_group_rows)
        written = files.read_partitioned(spark, out).where((F.col("year") == year) & F.col("part").isin(list(by_part))).count()
    else:
        sinks.write_empty(spark, config.schema, f"{out}/year={year}/part=items")
    ids = in_year(items, year, options.get("months")).select("id").distinct().count()
    found = {"staged": ids, WRITTEN: written, SKIPPED: total(SKIPPED), DROPPED: total(DROPPED)}
    if accounts is not None:
        accounts.update(found)
    dedupe.account(ids, written, found[SKIPPED], found[DROPPED])
    files.delete(spark, staged)
    return by_part or {"items": 0}


def items_stats(items: DataFrame, config: Collection) -> DataFrame:
    have = set(items.columns)
    nodata = q(config.nodata_column) if config.nodata_column in have else None
    return stats.rollup(
        items, key=q(config.tile_column), at=q("datetime"), metric=q(config.metric_column), item=q("id"), nodata=nodata
    )


def build_stats(items: DataFrame, config: Collection, out: str, merge_years: Sequence[int] | None = None, existing: DataFrame | None = None) -> DataFrame:
    """The monthly table, its slices and the timeline, all from one written copy of the table."""
    spark = items.sparkSession
    fresh = items_stats(items.where(F.year("datetime").isin(list(merge_years))) if merge_years else items, config)
    if merge_years:
        if existing is None:
            raise ValueError("merging years needs the existing table")
        fresh = dedupe.splice_years(upgrade_stats(existing), fresh, merge_years)
    sinks.write_sorted(fresh, f"{out}/mgrs-monthly", ["mgrs_tile", "year", "month"], 50_000, mode="overwrite")
    table = spark.read.parquet(f"{out}/mgrs-monthly")
    sinks.write_slices(table, f"{out}/months")
    stats.timeline(table).orderBy("year", "month").coalesce(1).write.mode("overwrite").parquet(f"{out}/timeline")
    return table


def build_footprints(items: DataFrame, config: Collection, box: str = "_envelope") -> DataFrame:
    """``tile, pieces`` from items with an envelope column; wide and reversed boxes are left out."""
    usable = items.where(geo.sane(q("bbox"), F.col(box)))
    return geo.footprints(
        usable.select(
            q(config.tile_column).alias("tile"), F.col(f"{box}.xmin").alias("x0"), F.col(f"{box}.xmax").alias("x1"),
            F.col(f"{box}.ymin").alias("y0"), F.col(f"{box}.ymax").alias("y1"),
        )
    )


def audit(published: DataFrame, inventory: DataFrame, config: Collection, months: Sequence[str] | None = None, tolerance: int = 0) -> DataFrame:
    expected = audits.expected_counts(inventory, config.key_root, months)
    return audits.audit(expected, audits.have_counts(published, months=months), tolerance)


PRESENT, ABSENT, UNKNOWN = "present", "absent", "unknown"


def probe(check, path: str) -> str:
    """Three states: there, not there, or no answer. ``check`` is a callable as ``files.exists``."""
    try:
        return PRESENT if check(path) else ABSENT
    except Exception:  # noqa: BLE001  whatever the store says, it is not an answer
        return UNKNOWN


def merge_record(measured: dict | None, recorded: dict | None, state: str) -> dict | None:
    """What a part's record becomes: measured if present, kept if unknown, gone only if clearly absent."""
    if state == PRESENT:
        return measured
    return recorded if state == UNKNOWN else None


def measure_part(spark: SparkSession, path: str, at: str = "datetime") -> dict:
    """Rows, time range, bytes and box of a part, from its files' footers and sizes alone."""
    listed = [(p, size) for p, size in files.listing(spark, path) if p.endswith(".parquet")]
    paths = [p for p, _ in listed]
    sums = files.row_groups(spark, paths, at).agg(F.sum("rows").alias("rows"), F.min("low").alias("start"), F.max("high").alias("end")).first()
    boxes = [b for b in files.geo_boxes(spark, paths).values() if b]
    box = [f(b[i] for b in boxes) for i, f in enumerate((min, min, max, max))] if boxes else None
    return {"rows": sums["rows"] or 0, "start": sums.start, "end": sums.end, "bytes": sum(size for _, size in listed), "bbox": box}


def discover(spark: SparkSession, base: str, config: Collection, year: int, check=None, measure=None) -> dict[str, tuple[str, dict | None]]:
    """State and measure of every part that a year can have: archive parts first, in published order, then live ones."""
    check = check or (lambda p: files.exists(spark, p))
    measure = measure or (lambda p: measure_part(spark, p))
    names = [*geo.archive_parts(config.zone_split), *geo.live_parts(config.monthly_live)]
    out = {}
    for name in names:
        path = f"{base.rstrip('/')}/year={year}/part={name}"
        state = probe(check, path)
        measured = None
        if state == PRESENT:
            try:
                measured = measure(path)
            except Exception:  # noqa: BLE001  it is there, but no answer came: as good as unknown
                state = UNKNOWN
        out[name] = state, measured
    return out


def build_item(config: Collection, year: int, found: dict[str, tuple[str, dict | None]], recorded: dict | None = None) -> dict | None:
    """Item document of a year from what was discovered and the document of the last run.

    A part that gave no answer keeps its recorded entry, and one that is there without a box
    keeps the recorded box: the record shrinks only where a part is clearly gone. None if no
    part is left.
    """
    known = (recorded or {}).get("assets", {})
    assets = {}
    for name, (state, measured) in found.items():
        before = known.get(name)
        entry = None
        if measured is not None:
            entry = {
                "href": f"./part={name}", "table:row_count": measured["rows"], "start_datetime": measured["start"], "end_datetime": measured["end"],
                "file:size": measured["bytes"], "bbox": measured["bbox"] or (before or {}).get("bbox"),
            }
        merged = merge_record(entry, before, state)
        if merged is not None:
            assets[name] = merged
    if not assets:
        return None
    every = lambda k: [a[k] for a in assets.values() if a.get(k) is not None]
    boxes = every("bbox")
    box = [f(b[i] for b in boxes) for i, f in enumerate((min, min, max, max))] if boxes else (recorded or {}).get("bbox")
    return {
        "type": "Feature", "collection": config.name, "id": f"{config.name}-{year}", "bbox": box,
        "properties": {
            "start_datetime": min(every("start_datetime"), default=None), "end_datetime": max(every("end_datetime"), default=None),
            "table:row_count": sum(every("table:row_count")),
        },
        "assets": assets,
    }
