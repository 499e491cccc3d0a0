"""WARC records in seekable Zstandard bundles.

Records are grouped into frames of about ``frame_bytes``; every frame is an
independent Zstandard frame, and a bundle (frames up to ``bundle_bytes`` compressed)
ends in a seek table: a skippable frame with the compressed and decompressed size of
each frame and the footer of the seekable format. An index names, for each record,
its frame and its offset and length inside the decompressed frame, so that one
record costs one frame.

Bundles are rows of a Parquet table (``bundle_id, content, entries``), since only Spark
reaches every store; ``content`` is a complete ``.warc.zst`` file, and
``export_bundles`` writes them out where a folder is mounted.

Payloads of at least ``least_bytes`` that occur more than once are stored once: the
record with the greatest id is the response, the others are revisits that name it.
Only ids and digests are grouped for that; a hot payload is pre-aggregated, and its
rows are met by a join that can be split. Smaller payloads take no part in it.

A target URI is written as RFC 3986 allows it: characters that are not legal are
percent-encoded, what is already encoded stays; where that changes a URL, a field of its
own keeps the original. A record is named by a UUID made of its page, its payload and,
unless others refer to it, its place in the run, so that names do not repeat where page
ids do.

Defined results: null html is an empty payload, null urls have no target; a null id
is never referred to as long as another one exists; rows that repeat the greatest id
are responses each, and their revisits name the page but no record; an empty table gives
no bundle; extra columns are not read. Very long pages are one record each, in a frame of
their own length; as Spark's cells hold less than 2 GiB, so do records, and every frame's
size fits the seek table's 32 bits.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import col

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
BUNDLE = (
    "bundle_id string, content binary,"
    " entries array<struct<record:bigint,page_id:bigint,frame:int,frame_start:bigint,frame_size:bigint,start:bigint,size:bigint>>"
)
RECORD = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint,"
    " payload binary"
)


@dataclass(frozen=True)
class BundleParams:
    least_bytes: int = 1000
    frame_bytes: int = 256 * 1024
    bundle_bytes: int = 4 * 1024 * 1024
    level: int = 3


_PAGES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:page")
_STRAY = re.compile(r"%(?![0-9A-Fa-f]{2})")


def target_uri(url: str) -> str:
    """The URL with everything encoded that a URI may not hold, and nothing else."""
    return quote(_STRAY.sub("%25", url), safe="!#$%&'()*+,/:;=?@[]~-._", errors="replace")


def record_name(page_id, digest: str, place: str = "") -> str:
    """``place`` is empty for the one record of a page and payload that revisits refer to."""
    return f"<urn:uuid:{uuid.uuid5(_PAGES, f'{page_id} {digest} {place}')}>"


def record_bytes(page_id, url, digest: str, size: int, refers_to, payload: bytes, name: str, refers_name: str | None = None) -> bytes:
    """One record. A revisit has no body, but the digest and length of the payload it stands for."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        shown = target_uri(url)
        lines.append("WARC-Target-URI: " + shown)
        if shown != url:
            lines.append("X-Original-URL: " + quote(url, safe="", errors="replace"))
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"X-Refers-To-Page: {refers_to}",
        ]
        if refers_name is not None:
            lines.append(f"WARC-Refers-To: {refers_name}")
        payload = b""
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record that starts at ``at``, and where the next one does."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(fields["Content-Length"])
    payload = data[end + 4 : end + 4 + size]
    number = lambda name: int(fields[name]) if name in fields else None
    response = fields["WARC-Type"] == "response"
    digest = hashlib.sha1(payload).hexdigest() if response else fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if response and fields["WARC-Payload-Digest"] != f"sha1:{digest}":
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    original = fields.get("X-Original-URL")
    return {
        "page_id": number("X-Page-ID"),
        "url": fields.get("WARC-Target-URI") if original is None else unquote(original),
        "payload_bytes": size if response else int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page"),
        "payload": payload,
    }, end + 4 + size + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Footer for frames of the given (compressed, decompressed) sizes."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(content: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed, decompressed) of each frame, from the footer alone."""
    count, _, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    out, at, table = [], 0, len(content) - 9 - 8 * count
    for i in range(count):
        packed, full = struct.unpack_from("<II", content, table + 8 * i)
        out.append((at, packed, full))
        at += packed
    return out


def read_frame(content: bytes, start: int, packed: int, full: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=max(full, 1))


def read_record(content: bytes, entry) -> dict:
    """One record through its index entry: one frame is read, nothing else."""
    full = {s: n for s, _, n in frames_of(content)}[entry["frame_start"]]
    frame = read_frame(content, entry["frame_start"], entry["frame_size"], full)
    return parse_record(frame[entry["start"] : entry["start"] + entry["size"]])[0]


class _Bundle:
    def __init__(self, params: BundleParams):
        self.params = params
        self.pack = zstandard.ZstdCompressor(level=params.level).compress
        self.clear()

    def clear(self):
        self.frames, self.sizes, self.entries, self.waiting = [], [], [], []
        self.start = self.offset = 0

    def add(self, page_id, record: bytes):
        self.waiting.append(record)
        self.entries.append([page_id, len(self.frames), self.offset, len(record)])
        self.offset += len(record)
        if self.offset >= self.params.frame_bytes:
            self.close_frame()

    def close_frame(self):
        if self.waiting:
            packed = self.pack(b"".join(self.waiting))
            self.frames.append(packed)
            self.sizes.append((len(packed), self.offset))
            self.start += len(packed)
            self.waiting, self.offset = [], 0

    def row(self) -> tuple:
        self.close_frame()
        starts = [0]
        for packed, _ in self.sizes:
            starts.append(starts[-1] + packed)
        index = [
            {"record": i, "page_id": p, "frame": f, "frame_start": starts[f], "frame_size": self.sizes[f][0], "start": s, "size": n}
            for i, (p, f, s, n) in enumerate(self.entries)
        ]
        content = b"".join(self.frames) + seek_table(self.sizes)
        self.clear()
        # Named by its bytes: a task that runs again makes the same bundle under the same name.
        return hashlib.sha1(content).hexdigest(), content, index


def _write(params: BundleParams):
    index = pa.list_(
        pa.struct(
            [("record", pa.int64()), ("page_id", pa.int64()), ("frame", pa.int32()), ("frame_start", pa.int64()),
             ("frame_size", pa.int64()), ("start", pa.int64()), ("size", pa.int64())]
        )
    )

    def made(row):
        return pa.RecordBatch.from_arrays(
            [pa.array([row[0]]), pa.array([row[1]], pa.binary()), pa.array([row[2]], index)],
            names=["bundle_id", "content", "entries"],
        )

    def run(batches):
        bundle, part, count = _Bundle(params), TaskContext.get().partitionId(), 0
        for batch in batches:
            for cells in zip(*batch.columns, strict=True):
                page_id, url, payload, size, digest, refers_to, firsts = (c.as_py() for c in cells)
                # A payload's only record of the greatest id is the one that revisits name.
                known = firsts == 1
                name = record_name(page_id, digest, "" if known and refers_to is None else f"{part} {count}")
                refers_name = record_name(refers_to, digest) if known and refers_to is not None else None
                bundle.add(page_id, record_bytes(page_id, url, digest, size, refers_to, payload, name, refers_name))
                count += 1
                if bundle.start >= params.bundle_bytes:
                    yield made(bundle.row())
        if bundle.entries:
            yield made(bundle.row())

    return run


def plan_records(pages: DataFrame, params: BundleParams, *, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """``page_id, url, payload, size, digest, refers_to, firsts`` of every record to be written.

    ``firsts`` counts the responses of a payload that has revisits, null where it has none.
    """
    rows = pages.select(
        col(id_col).cast("bigint").alias("page_id"),
        col(url_col).alias("url"),
        F.coalesce(F.encode(html_col, "UTF-8"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumn("size", F.octet_length("payload").cast("bigint")).withColumn("digest", F.sha1("payload"))
    large, small = rows.where(col("size") >= params.least_bytes), rows.where(col("size") < params.least_bytes)
    copies = (
        large.groupBy("digest", "page_id")
        .agg(F.count("*").alias("n"))
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "n")).alias("top"), F.sum("n").alias("n"))
        .where("n > 1")
        .select("digest", col("top.page_id").alias("first"), col("top.n").alias("firsts"))
    )
    names = ["page_id", "url", "payload", "size", "digest"]
    met = large.join(copies, "digest", "left").select(
        *names, F.when(~col("page_id").eqNullSafe(col("first")), col("first")).alias("refers_to"), "firsts"
    )
    alone = F.lit(None).cast("bigint")
    return met.unionByName(small.select(*names, alone.alias("refers_to"), alone.alias("firsts")))


def write_bundles(records: DataFrame, params: BundleParams = BundleParams()) -> DataFrame:
    """``bundle_id, content, entries``; each task packs its own rows and holds one bundle at a time."""
    lean = records.select(
        "page_id", "url", F.when(col("refers_to").isNull(), col("payload")).otherwise(F.lit(b"")).alias("payload"),
        "size", "digest", "refers_to", "firsts",
    )
    return lean.mapInArrow(_write(params), BUNDLE)


def _read(payload: bool):
    """Records at the places that the index names; a frame is unpacked once for all of its records."""
    names = [x.split()[0] for x in RECORD.split(", ")][: 7 if payload else 6]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches):
        for batch in batches:
            for cell, entries in zip(batch.column(0), batch.column(1), strict=True):
                content, wanted = cell.as_py(), {}
                for entry in entries.as_py():
                    wanted.setdefault(entry["frame_start"], []).append(entry)
                for start, packed, full in frames_of(content):
                    if start not in wanted:
                        continue
                    frame, rows = read_frame(content, start, packed, full), []
                    for entry in wanted[start]:
                        record, end = parse_record(frame, entry["start"])
                        if end != entry["start"] + entry["size"] or record["page_id"] != entry["page_id"]:
                            raise ValueError(f"the index does not name the record at {entry['start']}")
                        rows.append(record)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=False)], names=names
                    )

    return run, RECORD if payload else RECORD.rpartition(",")[0]


def read_bundles(bundles: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of every bundle, through the index; responses are checked against their digest."""
    return bundles.select("content", "entries").mapInArrow(*_read(payload))


def fetch_records(bundles: DataFrame, wanted: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the pages whose ids ``wanted`` (``page_id``) lists; only their frames are unpacked."""
    index = bundles.select("bundle_id", F.explode("entries").alias("entry"))
    ids = wanted.select(col("page_id").cast("bigint").alias("page_id")).distinct()
    hits = index.join(ids, col("entry.page_id") == col("page_id"), "left_semi").groupBy("bundle_id").agg(F.collect_list("entry").alias("entries"))
    return bundles.select("bundle_id", "content").join(hits, "bundle_id").select("content", "entries").mapInArrow(*_read(payload))


def export_bundles(bundles: DataFrame, folder: str) -> None:
    """Write each bundle as ``<bundle_id>.warc.zst`` into a folder that all executors mount."""

    def save(rows):
        import os

        for row in rows:
            with open(os.path.join(folder, f".{row.bundle_id}.part"), "wb") as out:
                out.write(row.content)
            os.replace(out.name, os.path.join(folder, f"{row.bundle_id}.warc.zst"))

    bundles.select("bundle_id", "content").foreachPartition(save)
