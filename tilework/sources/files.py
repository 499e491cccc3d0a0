"""File sources: listings, formats, manifests, footers.

Paths are listed and probed through Hadoop's file system, so any store that Spark
reads will do.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

INVENTORY = "bucket string, key string, size bigint, last_modified string"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file is there. Only a clear answer counts: any other failure of the store propagates."""
    where, fs = _fs(spark, path)
    return bool(fs.exists(where))


def touch(spark: SparkSession, path: str) -> None:
    """A zero-byte file: "fetched, no rows"."""
    where, fs = _fs(spark, path)
    fs.create(where, True).close()


def delete(spark: SparkSession, path: str) -> None:
    where, fs = _fs(spark, path)
    fs.delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; what was at the target is replaced."""
    where, fs = _fs(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.delete(target, True)
    if not fs.rename(where, target):
        raise OSError(f"{path} could not be moved to {to}")


def listing(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Files below a folder, or the file itself, with their sizes, in order of their path."""
    where, fs = _fs(spark, path)
    if not fs.exists(where):
        raise FileNotFoundError(path)
    files, out = fs.listFiles(where, True), []
    while files.hasNext():
        status = files.next()
        out.append((status.getPath().toString(), int(status.getLen())))
    return sorted(out)


def gather(spark: SparkSession, sources: Sequence[str], suffix: str = ".parquet") -> list[str]:
    """Non-empty data files of files and folders. A zero-byte file says "fetched, no rows" and is left out."""
    found = [p for s in sources for p, size in listing(spark, s) if p.endswith(suffix) and size > 0]
    if not found:
        raise ValueError(f"no non-empty {suffix} under {list(sources)}")
    return found


def read_items(spark: SparkSession, sources: Sequence[str], schema=None) -> DataFrame:
    """Parquet files as one table by column name; with a schema, absent columns are null and nothing is inferred."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    return reader.parquet(*gather(spark, sources))


def read_partitioned(spark: SparkSession, base: str) -> DataFrame:
    """A hive-partitioned table; filters on the partition column prune folders."""
    return spark.read.option("basePath", base).parquet(f"{base.rstrip('/')}/year=*")


def read_documents(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """One JSON document a line as strings in ``value``; blank lines are left out."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths)).where(F.trim("value") != "")


def read_ndjson(spark: SparkSession, paths: Sequence[str] | str, schema) -> DataFrame:
    return spark.read.schema(schema).json(paths if isinstance(paths, str) else list(paths))


def read_inventory(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Object listing, headerless CSV (gzip too) or Parquet by suffix; a mixed or unknown set is refused."""
    if not paths:
        raise ValueError("an inventory of no files cannot be read")
    if all(p.endswith(".parquet") for p in paths):
        return spark.read.parquet(*paths)
    if all(p.endswith((".csv", ".csv.gz")) for p in paths):
        return spark.read.schema(INVENTORY).csv(list(paths), header=False)
    endings = {p.rpartition("/")[2].partition(".")[2] or "no suffix" for p in paths}
    raise ValueError(f"an inventory is all parquet or all csv, not {', '.join(sorted(endings))}")


def newest_manifest(partitions: Sequence[str]) -> str:
    """The manifest of the newest ``dt=`` folder among the listed ones."""
    if not partitions:
        raise ValueError("no inventory partitions")
    return max(p.rstrip("/") for p in partitions) + "/symlink.txt"


def manifest_paths(text: str, scheme: str = "s3://", to: str = "s3a://") -> list[str]:
    """Data files that a manifest lists, in the scheme that Spark reads; another kind of line is an error."""
    out = []
    for line in filter(None, map(str.strip, text.splitlines())):
        if not line.startswith(scheme):
            raise ValueError(f"{line!r} in a manifest of {scheme} paths")
        out.append(to + line[len(scheme) :])
    return out


def row_count(df: DataFrame) -> int:
    """Rows of a Parquet table; with the aggregate pushed down, from the footers alone."""
    return df.count()


def footer_stats(df: DataFrame, column: str) -> DataFrame:
    """``rows, low, high`` of a table, answered from footers where ``enable_footer_aggregates`` is on."""
    return df.agg(F.count("*").alias("rows"), F.min(column).alias("low"), F.max(column).alias("high"))


def enable_footer_aggregates(spark: SparkSession) -> None:
    """Counts, minima and maxima of plain Parquet scans from footers (needs the V2 reader)."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set("spark.sql.sources.useV1SourceList", "")


def geo_bbox(key_values: dict) -> list[float] | None:
    """Bounding box from the ``geo`` entry of a footer's key-value metadata."""
    raw = key_values.get(b"geo") or key_values.get("geo")
    if not raw:
        return None
    columns = json.loads(raw).get("columns", {})
    return next((c["bbox"] for c in columns.values() if c.get("bbox")), None)


#: Arrow starts with so many bytes of a file's end, however short the footer is.
FOOTER_READ = 64 * 1024


class _Tail:
    """A file of which only the end is held: what a footer reader asks for."""

    def __init__(self, size: int, tail: bytes):
        self.size, self.tail, self.at, self.closed = size, tail, 0, False

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset if whence == 0 else (self.at if whence == 1 else self.size) + offset
        return self.at

    def tell(self) -> int:
        return self.at

    def read(self, count: int = -1) -> bytes:
        start = self.at - (self.size - len(self.tail))
        if start < 0:
            raise OSError("a footer reader left the footer")
        out = self.tail[start : None if count < 0 else start + count]
        self.at += len(out)
        return out

    def close(self) -> None:
        self.closed = True

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def writable(self) -> bool:
        return False


def _footer_through_hadoop(spark: SparkSession, path: str):
    """Metadata of a Parquet file by two ranged reads through Hadoop's file system."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    where, fs = _fs(spark, path)
    size = int(fs.getFileStatus(where).getLen())
    stream = fs.open(where)

    def last(count: int) -> bytes:
        stream.seek(size - count)
        return bytes(stream.readNBytes(count))

    try:
        length = int.from_bytes(last(8)[:4], "little")
        return pq.ParquetFile(pa.PythonFile(_Tail(size, last(min(size, max(length + 8, FOOTER_READ)))), mode="r")).metadata
    finally:
        stream.close()


def arrow_path(path: str):
    """Arrow's file system for a path of Hadoop's, and the name in it; an error if Arrow does not know the store."""
    import pyarrow.fs

    return pyarrow.fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


def _footer(path: str):
    """Metadata of a Parquet file where Arrow knows the store; only the file's end is read."""
    import pyarrow.parquet as pq

    store, name = arrow_path(path)
    with store.open_input_file(name) as file:
        return pq.ParquetFile(file).metadata


def _arrow_reads(path: str) -> bool:
    import pyarrow as pa

    try:
        arrow_path(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _footer_rows(spark: SparkSession, paths: Sequence[str], rows_of, schema: str) -> DataFrame:
    """``rows_of(path, metadata)`` of each Parquet file of files and folders, with ranged reads of its footer.

    Tasks read the footers, some files each, where Arrow knows the store; else the driver
    does, through Hadoop's file system, a file at a time: footers are small, and there are
    as many as files.
    """
    paths = [p for s in paths for p, _ in listing(spark, s) if p.endswith(".parquet")]
    if not paths:
        return spark.createDataFrame([], schema)
    if not all(_arrow_reads(p) for p in {p.partition(":")[0]: p for p in paths}.values()):
        return spark.createDataFrame([r for p in paths for r in rows_of(p, _footer_through_hadoop(spark, p))], schema)

    def read(batches):
        import pandas as pd

        for batch in batches:
            rows = [r for p in batch["path"] for r in rows_of(p, _footer(p))]
            yield pd.DataFrame(rows, columns=names, dtype=object)

    names = [part.split()[0] for part in schema.split(", ")]
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 200))
    return listed.mapInPandas(read, schema)


def row_groups(spark: SparkSession, paths: Sequence[str], key: str) -> DataFrame:
    """``path, group, rows, bytes, low, high``: one row a row group with the range of ``key``; only footers are read."""

    def groups(path, meta):
        names = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stats = group.column(names[key]).statistics if key in names else None
            low, high = (str(stats.min), str(stats.max)) if stats is not None and stats.has_min_max else (None, None)
            yield path, g, group.num_rows, group.total_byte_size, low, high

    return _footer_rows(spark, paths, groups, "path string, group int, rows bigint, bytes bigint, low string, high string")


def key_values(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, key, value``: the text entries of each footer's key-value metadata."""

    def entries(path, meta):
        for key, value in (meta.metadata or {}).items():
            yield path, key.decode("utf-8", "replace"), value.decode("utf-8", "replace")

    return _footer_rows(spark, paths, entries, "path string, key string, value string")


def geo_boxes(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[float] | None]:
    """Bounding box of each file from the ``geo`` entry of its footer; None where it has none."""
    listed = [p for s in paths for p, _ in listing(spark, s) if p.endswith(".parquet")]
    found = {r.path: geo_bbox({"geo": r.value}) for r in key_values(spark, listed).where("key = 'geo'").collect()}
    return {p: found.get(p) for p in listed}


def present(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the paths that are there. An absent part is an empty part; any other answer of the store propagates."""
    return [p for p in paths if exists(spark, p)]


def read_present(spark: SparkSession, paths: Sequence[str], schema) -> DataFrame:
    """The rows of the parts that are there; no part gives an empty table of the schema."""
    found = present(spark, paths)
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def inline(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def object_keys(prefixes: DataFrame, months: DataFrame) -> DataFrame:
    """Every prefix with every month: the folders that a discovery lists."""
    return prefixes.crossJoin(months).select(
        F.concat_ws("/", F.regexp_replace("prefix", "/+$", ""), F.col("year").cast("string"), F.col("month").cast("string")).alias("folder")
    )
