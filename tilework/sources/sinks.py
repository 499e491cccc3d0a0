"""Writers: sorted parts, row groups, slices, documents, deltas."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import q


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], row_group_rows: int, level: int = 18, partition_by: Sequence[str] = (),
                 files: int | None = None, bloom: dict | None = None, mode: str = "error") -> None:
    """Range-partitioned, sorted Parquet with row groups of ``row_group_rows`` rows.

    Ranges are cut by the partition columns and the sort keys, so each output file holds
    one stretch of one part. ``bloom`` maps columns to their expected distinct values a group.
    """
    order = [q(c) for c in (*partition_by, *keys)]
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    writer = (
        ranged.sortWithinPartitions(*order)
        .write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", level)
        .option("parquet.block.row.count.limit", row_group_rows)
    )
    for column, distinct in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_parts(df: DataFrame, path: str, keys: Sequence[str], row_group_rows: int, level: int = 18) -> None:
    """``year`` and ``part`` folders; only the folders that have rows are replaced."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_sorted(df, path, keys, row_group_rows, level, ("year", "part"), mode="overwrite")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def replace_part(df: DataFrame, path: str, expected: int | None = None, write=None) -> int:
    """Replace the folder of a part at once: write beside it, check, then rename. Returns its rows.

    Rows are counted in what was written, from its footers. Where the count is not the
    expected one, the part stays as it was and an error is raised; readers never see half
    a part. ``write`` is called with the frame and the folder (default: plain Parquet).
    """
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    folder, _, name = path.rstrip("/").rpartition("/")
    staged = f"{folder}/.{name}.part"
    target, made = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(staged)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(made, True)
    if write is None:
        df.write.option("compression", "zstd").parquet(staged)
    else:
        write(df, staged)
    rows = spark.read.schema(df.schema).parquet(staged).count()
    if expected is not None and rows != expected:
        fs.delete(made, True)
        raise ValueError(f"{rows} rows were written for {path}, not {expected}")
    fs.delete(target, True)
    if not fs.rename(made, target):
        raise OSError(f"{staged} could not be moved to {path}")
    return rows


def write_month_aligned(grouped: DataFrame, path: str, month: str, order: Sequence[str], target: int) -> None:
    """One file a row group: the groups of ``layout.month_groups`` never span a month nor exceed ``target``."""
    (
        grouped.repartition(q(month), q("group_no"))
        .sortWithinPartitions(q(month), q("group_no"), *[q(c) for c in order])
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", target)
        .option("parquet.block.row.count.limit", target)
        .partitionBy(month, "group_no")
        .parquet(path)
    )


def write_aligned_parts(df: DataFrame, path: str, part: str, month: str, order: Sequence[str], target: int, level: int = 18) -> list[tuple[str, int, int]]:
    """One file ``<part>.parquet`` a part, whose row groups never span a month nor exceed ``target`` rows.

    Spark's own writer cuts groups by size alone, so each task writes its parts through
    Arrow, a group at a time, in a store that Arrow knows. A task writes under a name of its
    attempt and reports it; what was reported is renamed at the end, so tasks may run again,
    and readers see whole parts only. Returns (part, rows, groups); a null month stops the job.
    """
    import pyarrow as pa

    spark = df.sparkSession
    where, fs = _folder(spark, path)
    fs.mkdirs(where)
    root, columns = fs.resolvePath(where).toString(), df.columns

    def write(batches):
        import uuid

        import pyarrow.parquet as pq

        from .files import arrow_path

        store, base = arrow_path(root)
        writer = now = None
        waiting: list = []
        done: list = []

        def close_group():
            nonlocal waiting
            if waiting:
                table = pa.Table.from_batches(waiting)
                writer.write_table(table, row_group_size=table.num_rows)
                done[-1][2] += table.num_rows
                done[-1][3] += 1
                waiting = []

        for batch in batches:
            names, months = batch.column(part).to_pylist(), batch.column(month).to_pylist()
            at = 0
            while at < len(names):
                if months[at] is None:
                    raise ValueError("a row has no month")
                key = names[at], months[at]
                if key != now:
                    close_group()
                    if now is None or key[0] != now[0]:
                        if writer is not None:
                            writer.close()
                        done.append([key[0], f".{uuid.uuid4().hex}.part", 0, 0])
                        writer = pq.ParquetWriter(f"{base}/{done[-1][1]}", batch.schema, filesystem=store, compression="zstd", compression_level=level)
                    now = key
                held = sum(b.num_rows for b in waiting)
                end = at
                while end < len(names) and (names[end], months[end]) == key and held + end - at < target:
                    end += 1
                waiting.append(batch.slice(at, end - at))
                at = end
                if held + waiting[-1].num_rows == target:
                    close_group()
        close_group()
        if writer is not None:
            writer.close()
        cells = list(zip(*done, strict=True)) if done else [()] * 4
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([x if k != 0 else str(x) for x in c], t) for k, (c, t) in enumerate(zip(cells, kinds, strict=True))], names=["part", "file", "rows", "groups"])

    ordered = df.select(*[q(c) for c in columns]).repartition(q(part)).sortWithinPartitions(q(part), q(month), *[q(c) for c in order])
    made = ordered.mapInArrow(write, "part string, file string, rows bigint, groups bigint").collect()
    jvm = spark._jvm
    for r in made:
        target_file = jvm.org.apache.hadoop.fs.Path(where, f"{r.part}.parquet")
        fs.delete(target_file, False)
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(where, r.file), target_file):
            raise OSError(f"{r.file} could not be moved to {target_file}")
    for status in fs.listStatus(where):
        if status.getPath().getName().endswith(".part"):
            fs.delete(status.getPath(), False)
    return sorted((r.part, r["rows"], r.groups) for r in made)


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def write_slices(stats: DataFrame, path: str) -> None:
    """One folder a month, ``ym=YYYY-MM``; months that the table no longer has disappear."""
    named = stats.withColumn("ym", F.format_string("%04d-%02d", F.col("year").cast("int"), F.col("month").cast("int")))
    named.repartition("ym").sortWithinPartitions("ym", "mgrs_tile").write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).option("compression", "zstd").partitionBy("ym").parquet(path)


def flat_slices(spark: SparkSession, path: str, to: str) -> list[str]:
    """Copies of the slices under flat names ``YYYY-MM.parquet``; files of other months in ``to`` are removed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    here, there = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    fs = here.getFileSystem(conf)
    fs.mkdirs(there)
    written = []
    for folder in fs.listStatus(here):
        name = folder.getPath().getName()
        if not name.startswith("ym="):
            continue
        parts = [s.getPath() for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise ValueError(f"{len(parts)} files in the slice {name}")
        month = name.removeprefix("ym=")
        target, staged = jvm.org.apache.hadoop.fs.Path(there, f"{month}.parquet"), jvm.org.apache.hadoop.fs.Path(there, f".{month}.part")
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, parts[0], fs, staged, False, True, conf)
        fs.delete(target, False)
        fs.rename(staged, target)
        written.append(month)
    for status in fs.listStatus(there):
        name = status.getPath().getName()
        if name.endswith(".parquet") and name.removesuffix(".parquet") not in written:
            fs.delete(status.getPath(), False)
    return sorted(written)


def write_empty(spark: SparkSession, schema, path: str) -> None:
    """A part without rows that carries its schema."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


def window_manifest(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Fetched windows with their rows; zero rows says "fetched, nothing there"."""
    return spark.createDataFrame(sorted(counts.items()), "window string, rows bigint")


def write_delta_csv(delta: DataFrame, path: str) -> None:
    delta.coalesce(1).write.mode("overwrite").csv(path, header=True)


def year_document(row, collection: str, parts: list[dict]) -> dict:
    """Item document of one year from its rolled-up row; ``parts`` describe its files."""
    return {
        "type": "Feature",
        "collection": collection,
        "id": f"{collection}-{row['year']}",
        "bbox": [row["xmin"], row["ymin"], row["xmax"], row["ymax"]],
        "properties": {"start_datetime": str(row["start"]), "end_datetime": str(row["end"]), "table:row_count": row["rows"]},
        "assets": {p["part"]: {"href": f"./{p['part']}.parquet", "table:row_count": p["rows"]} for p in parts},
    }


def collection_document(rolled, name: str, description: str, years: Sequence[int]) -> dict:
    """Collection document from the rolled-up row of all years: extents, row count, a link for each year."""
    return {
        "type": "Collection",
        "id": name,
        "description": description,
        "extent": {
            "spatial": {"bbox": [[rolled["xmin"], rolled["ymin"], rolled["xmax"], rolled["ymax"]]]},
            "temporal": {"interval": [[str(rolled["start"]), str(rolled["end"])]]},
        },
        "links": [{"rel": "item", "href": f"./year={y}/{y}.json"} for y in sorted(years)],
        "table:row_count": rolled["rows"],
    }


def sidecar(groups: list[dict], kept: Sequence[str]) -> str:
    """JSON index of a part: its kept columns, and rows and key range of each row group."""
    return json.dumps({"columns": list(kept), "groups": [{k: g[k] for k in ("group", "rows", "low", "high")} for g in groups]}, separators=(",", ":"))


def sidecars(spark: SparkSession, paths: Sequence[str], key: str, kept: Sequence[str]) -> dict[str, str]:
    """The index of each Parquet file, from its footer."""
    from .files import row_groups

    by_path: dict[str, list] = {}
    for r in row_groups(spark, paths, key).orderBy("path", "group").collect():
        by_path.setdefault(r.path, []).append(r.asDict())
    return {p: sidecar(groups, kept) for p, groups in by_path.items()}


def density_png(cells: list[tuple[int, int, int]], width: int, height: int) -> bytes:
    """Grey PNG of a density grid ``(ix, iy, n)``, shaded logarithmically; standard library only."""
    import math
    import struct
    import zlib

    most = max((n for _, _, n in cells), default=1)
    rows = [bytearray(width) for _ in range(height)]
    for ix, iy, n in cells:
        rows[iy][ix] = round(255 * math.sqrt(math.log1p(n) / math.log1p(most)))

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    body = zlib.compress(b"".join(b"\0" + bytes(r) for r in rows), 9)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", body) + chunk(b"IEND", b"")
