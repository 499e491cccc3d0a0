"""Document fingerprints: invertible Bloom lookup sketches over paragraphs.

A text is a multiset of paragraphs (lines, cut further at sentence ends, and at
content-defined words where neither occurs for long). Each paragraph's digest,
salted with its running number among equal ones, is put into one cell of each of
three sub-tables; a cell keeps a count, the exclusive-or of its digests and the
exclusive-or of their checks. Subtracting two sketches cell by cell leaves only
the paragraphs in which the versions differ, and peeling single-digest cells
recovers them. A sketch too small for the difference fails to peel; then both
versions are sketched again, four times as large, until it succeeds. Sketches of
``most_cells`` cells for each paragraph peel unless two digests of one text collide;
those few pairs are compared digest by digest.

The likeness of two versions is the Jaccard similarity of their paragraph
multisets, computed from the recovered difference d and the two sizes:
(a + b - d) / (a + b + d); two empty versions have likeness 1.

Defined results: null text counts as empty; repeated rows are separate documents
that follow each other; ids that are null come last in descending order; an empty
table gives an empty result; a single document is followed by itself; very long texts
are sketched whole. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

HASHES = 3
_PARAGRAPH = regex.compile(r"[^\n.!?]*[\n.!?]+|[^\n.!?]+")


@dataclass(frozen=True)
class SketchParams:
    cells: int = 18  # of the fingerprint; a multiple of 3
    grow: int = 4
    most_cells: int = 64  # for each paragraph of the two versions
    long_paragraph: int = 200
    chunk: int = 96  # documents that are sketched together


def paragraphs(text: str, longest: int) -> list[str]:
    out = []
    for part in _PARAGRAPH.findall(text):
        part = part.strip()
        if len(part) <= longest:
            if part:
                out.append(part)
            continue
        piece: list[str] = []
        for word in part.split(" "):
            piece.append(word)
            if not zlib.crc32(word.encode("utf-8", "replace")) & 7 or len(piece) >= 32:
                out.append(" ".join(piece))
                piece = []
        if piece:
            out.append(" ".join(piece))
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def digests(texts: list[str], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and salted digest of every paragraph, sorted by owner."""
    hashes, owners = [], []
    for i, text in enumerate(texts):
        own = [xxhash.xxh3_64_intdigest(p) for p in paragraphs(text, longest)]
        hashes += own
        owners += [i] * len(own)
    owner, h = np.array(owners, np.int64), np.array(hashes, np.uint64)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    if not len(h):
        return owner, h
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    at = np.arange(len(h))
    running = at - np.maximum.accumulate(np.where(new, at, 0))
    return owner, _mix(h + running.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _check(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def _cells(keys: np.ndarray, m: int) -> list[np.ndarray]:
    third = m // HASHES
    return [
        j * third + (_mix(keys + np.uint64((j + 1) * 0xA24BAED4963EE407 + m & 0xFFFFFFFFFFFFFFFF)) % np.uint64(third)).astype(np.int64)
        for j in range(HASHES)
    ]


class Sketches:
    """``count`` sketches of ``m`` cells each, side by side."""

    def __init__(self, count: int, m: int):
        self.count, self.m = count, m
        self.number = np.zeros(count * m, np.int32)
        self.keys = np.zeros(count * m, np.uint64)
        self.checks = np.zeros(count * m, np.uint32)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> "Sketches":
        for cell in _cells(keys, self.m):
            at = owner * self.m + cell
            np.add.at(self.number, at, sign)
            np.bitwise_xor.at(self.keys, at, keys)
            np.bitwise_xor.at(self.checks, at, _check(keys))
        return self

    def minus(self, other: "Sketches") -> "Sketches":
        out = Sketches(self.count, self.m)
        out.number = self.number - other.number
        out.keys = self.keys ^ other.keys
        out.checks = self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether each sketch could be emptied, and owner, digest and sign (+1 first, -1 second) of what came out."""
        found: list[tuple] = []
        while True:
            at = np.flatnonzero((np.abs(self.number) == 1) & (self.checks == _check(self.keys)))
            if not len(at):
                break
            owner, keys, sign = at // self.m, self.keys[at], self.number[at]
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            first = np.ones(len(keys), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
            owner, keys, sign = owner[first], keys[first], sign[first]
            found.append((owner, keys, sign))
            self.add(owner, keys, -sign)
            if len(found) > 4 * self.m + 64:  # checks that agree by accident can go round in circles
                break
        shape = (self.count, self.m)
        done = ~((self.number.reshape(shape) != 0) | (self.keys.reshape(shape) != 0)).any(axis=1)
        if not found:
            return done, np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int32)
        return done, *(np.concatenate(x) for x in zip(*found, strict=True))

    def text(self, i: int, size: int) -> str:
        """One sketch as text: size in hexadecimal, then counts, digests and checks in base 64."""
        cut = slice(i * self.m, (i + 1) * self.m)
        data = (
            (self.number[cut] & 0xFFFF).astype("<u2").tobytes()
            + self.keys[cut].astype("<u8").tobytes()
            + self.checks[cut].astype("<u4").tobytes()
        )
        return f"{size:x}." + base64.b64encode(data).decode()


def _direct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digests in which two multisets differ, and on which side they are."""
    keys, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    surplus = np.bincount(which, np.concatenate([np.ones(len(a)), -np.ones(len(b))]), len(keys)).astype(np.int64)
    return np.repeat(keys, np.abs(surplus)), np.repeat(np.sign(surplus), np.abs(surplus)).astype(np.int32)


def differences(
    owner_a: np.ndarray, a: np.ndarray, owner_b: np.ndarray, b: np.ndarray, count: int, params: SketchParams,
    first: tuple[Sketches, Sketches] | None = None,
) -> tuple[np.ndarray, list[tuple]]:
    """How many paragraphs differ between version a and b of each of ``count`` pairs, and the recovered digests."""
    out = np.full(count, -1, np.int64)
    recovered: list[tuple] = []
    todo, m = np.arange(count), params.cells
    sizes = np.bincount(owner_a, minlength=count) + np.bincount(owner_b, minlength=count)
    while len(todo):
        stuck = todo[(m > params.cells) & (m > params.most_cells * sizes[todo])]
        for i in stuck:
            keys, signs = _direct(a[owner_a == i], b[owner_b == i])
            out[i] = len(keys)
            recovered.append((np.full(len(keys), i), keys, signs))
        todo = np.setdiff1d(todo, stuck)
        if not len(todo):
            break
        if m == params.cells and first is not None:
            delta = first[0].minus(first[1])
        else:
            place = np.full(count, -1, np.int64)
            place[todo] = np.arange(len(todo))
            in_a, in_b = place[owner_a] >= 0, place[owner_b] >= 0
            delta = Sketches(len(todo), m).add(place[owner_a[in_a]], a[in_a])
            delta = delta.minus(Sketches(len(todo), m).add(place[owner_b[in_b]], b[in_b]))
        done, owner, keys, sign = delta.peel()
        good = done[owner] if len(owner) else np.empty(0, bool)
        many = np.bincount(owner[good], minlength=len(todo))
        out[todo[done]] = many[done]
        recovered.append((todo[owner[good]], keys[good], sign[good]))
        todo, m = todo[~done], m * params.grow
    return out, recovered


def likeness(size_a: np.ndarray, size_b: np.ndarray, differ: np.ndarray) -> np.ndarray:
    total = size_a + size_b
    return np.where(total + differ == 0, 1.0, (total - differ) / np.maximum(total + differ, 1))


def _sketch_chunk(texts: list[str], edited: list[str], following: list[str], params: SketchParams) -> dict:
    n = len(texts)
    sides = [digests(x, params.long_paragraph) for x in (texts, edited, following)]
    sizes = [np.bincount(o, minlength=n) for o, _ in sides]
    tables = [Sketches(n, params.cells).add(o, k) for o, k in sides]
    near = []
    for j in (1, 2):
        differ, _ = differences(*sides[0], *sides[j], n, params, (tables[0], tables[j]))
        near.append(likeness(sizes[0], sizes[j], differ))
    return {
        "fingerprint": [tables[0].text(i, int(sizes[0][i])) for i in range(n)],
        "edited_fingerprint": [tables[1].text(i, int(sizes[1][i])) for i in range(n)],
        "near_edited": near[0],
        "near_next": near[1],
    }


def _stream(params: SketchParams):
    def emit(ids, texts, following, kind):
        edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following, strict=True)]
        made = _sketch_chunk(texts, edited, following, params)
        columns = [
            pa.array(ids, kind),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in edited]),
            pa.array(made["fingerprint"]),
            pa.array(made["edited_fingerprint"]),
            pa.array(made["near_edited"], pa.float64()),
            pa.array(made["near_next"], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(
            columns,
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches):
        ids, texts, following, kind, chars = [], [], [], pa.int64(), 0
        pending = None  # bucket, id, text of the row that still waits for the next one
        for batch in batches:
            kind = batch.column(2).type
            for bucket, copy, i, t in zip(*(c for c in batch.columns), strict=True):
                bucket, copy, i, t = bucket.as_py(), copy.as_py(), i.as_py(), t.as_py() or ""
                if pending and pending[0] == bucket:
                    ids.append(pending[1])
                    texts.append(pending[2])
                    following.append(t)
                    chars += len(pending[2])
                    pending = None
                    if len(ids) >= params.chunk or chars > 4_000_000:
                        yield emit(ids, texts, following, kind)
                        ids, texts, following, chars = [], [], [], 0
                if not copy:
                    pending = (bucket, i, t)
        if ids:
            yield emit(ids, texts, following, kind)

    return run


def successor_fingerprints(
    docs: DataFrame, params: SketchParams = SketchParams(), *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of each text and of its edited version, with their likenesses.

    The edited version ends in the start of the next document in descending id
    (the last document is followed by the first). The order is made without a global
    sort in one task: ids are cut into as many buckets as there are shuffle
    partitions, the texts move once, and each bucket also receives a copy of the
    one document that heads the next bucket.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    wanted = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    quantiles = [i / wanted for i in range(1, wanted)]
    cuts = rows.agg(F.percentile_approx("id", quantiles, 20 * wanted).alias("c")).first().c if quantiles else None
    cuts = np.unique(np.array(cuts or [], np.int64))

    def buckets_of(ids: pa.Array) -> np.ndarray:
        # A null id comes after all others in descending order: bucket 0.
        found = np.searchsorted(cuts, ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), "right")
        return found

    @F.arrow_udf("int")
    def bucket(ids: pa.Array) -> pa.Array:
        return pa.array(buckets_of(ids), pa.int32())

    heads = rows.groupBy(bucket("id").alias("bucket")).agg(F.max("id").alias("head")).collect()
    order = sorted(((r.bucket, r.head) for r in heads), key=lambda x: -x[0])
    needs: dict = {}  # id of a head -> the bucket before it in descending order
    for (here, _), (_, head) in zip(order, order[1:] + order[:1], strict=True):
        needs.setdefault(head, []).append(here)

    @F.arrow_udf("array<struct<bucket int, copy boolean>>")
    def places(ids: pa.Array) -> pa.Array:
        out = []
        for i, own in zip(ids.to_pylist(), buckets_of(ids).tolist(), strict=True):
            out.append([(own, False)] + [(b, True) for b in needs.get(i, ())])
        kind = pa.struct([("bucket", pa.int32()), ("copy", pa.bool_())])
        return pa.array([[{"bucket": b, "copy": c} for b, c in x] for x in out], pa.list_(kind))

    # The texts do not go through Python here, only the ids.
    dealt = rows.withColumn("place", places("id")).select(F.explode("place").alias("p"), "id", "text")
    kept = dealt.select(F.col("p.bucket").alias("bucket"), F.col("p.copy").alias("copy"), "id", "text")
    sorted_ = kept.repartitionById(wanted, F.col("bucket")).sortWithinPartitions(
        "bucket", "copy", F.col("id").desc_nulls_last(), F.col("text")
    )
    return sorted_.mapInArrow(
        _stream(params),
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
