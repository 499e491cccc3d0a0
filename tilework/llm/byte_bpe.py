"""Byte-level BPE through a SentencePiece model made from a rank file.

The rank file (base64 token, rank) is serialised straight into SentencePiece's
protocol-buffer form: each token's bytes are mapped to printable characters, its
score is its negative rank, its id its rank, and normalisation is the identity.
Texts are split by a pattern; each match is encoded on its own. A match that is a
token itself is that token, as in rank-based encoders; everything else goes
through SentencePiece's merges, which pick the highest score (lowest rank) first.
Decoding is the inverse table. Ids travel as packed little-endian unsigned 32-bit
integers, the form in which training shards store them.

Defined results: null and empty text give no ids and decode to no bytes; very long
texts are encoded whole, match by match; repeated rows are encoded each; an empty table
gives an empty result. Only the text is read, so the names of other columns do not matter.
"""

from __future__ import annotations

import base64
import struct
from array import array
from functools import lru_cache

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, functions as F

#: Distinct matches that a worker remembers; memory is bounded by this.
REMEMBERED = 150_000
REMEMBERED_CHARS = 32


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in rank order; ranks must be 0, 1, 2, ..."""
    pairs = []
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                pairs.append((int(rank), base64.b64decode(token)))
    pairs.sort()
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"ranks of {path} are not consecutive from 0")
    return [t for _, t in pairs]


@lru_cache(1)
def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is visible Latin-1, else one from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(visible)]
    return [chr(b) if b in set(visible) else chr(256 + hidden.index(b)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value) -> bytes:
    """One protocol-buffer field: bytes and str length-delimited, float fixed 32, int and bool varint."""
    if isinstance(value, str):
        value = value.encode()
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value) & (1 << 64) - 1)


def model_proto(tokens: list[bytes]) -> bytes:
    """SentencePiece ModelProto: pieces (1), trainer spec (2), normaliser spec (3)."""
    shown = byte_characters()
    pieces = b"".join(
        _field(1, _field(1, "".join(shown[b] for b in t)) + _field(2, float(-rank)) + _field(3, 1))
        for rank, t in enumerate(tokens)
    )
    unknown = _field(1, _field(1, "< unk >") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(40, len(tokens)) + b"".join(_field(n, -1) for n in (41, 42, 43)) + _field(45, "< unk >")
    normaliser = _field(1, "identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return pieces + unknown + _field(2, trainer) + _field(3, normaliser)


class Tokenizer:
    """Encoder and decoder of one vocabulary; one per Python worker."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.split = regex.compile(pattern).findall
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(tokens))
        self.shown = {b: c for b, c in enumerate(byte_characters())}
        self.known: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        data = text.encode("utf-8", "replace")
        rank = self.whole.get(data)
        ids = [rank] if rank is not None else self.model.encode(data.decode("latin-1").translate(self.shown))
        return array("I", ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        known, out = self.known, []
        for part in self.split(text) if text else ():
            ids = known.get(part)
            if ids is None:
                ids = self.piece(part)
                if len(part) <= REMEMBERED_CHARS and len(known) < REMEMBERED:
                    known[part] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, packed: bytes | None) -> bytes:
        ids = array("I")
        ids.frombytes(packed or b"")
        return b"".join(map(self.tokens.__getitem__, ids))


_loaded: dict = {}


def tokenizer(path: str, pattern: str) -> Tokenizer:
    """The worker's tokenizer for ``path``; the vocabulary is read where the worker runs."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Tokenizer(read_ranks(path), pattern)
    return _loaded[path, pattern]


def encode(path: str, pattern: str, text: Column) -> Column:
    """Packed ids of each whole text."""

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        run = tokenizer(path, pattern).encode
        return pa.array([run(x.as_py()) for x in texts], type=pa.binary())

    return encoded(text)


def decode(path: str, pattern: str, packed: Column) -> Column:
    """The bytes that packed ids stand for."""

    @F.arrow_udf("binary")
    def decoded(ids: pa.Array) -> pa.Array:
        run = tokenizer(path, pattern).decode
        return pa.array([run(x.as_py()) for x in ids], type=pa.binary())

    return decoded(packed)


def encode_and_decode(path: str, pattern: str, text: Column) -> Column:
    """Struct of packed ids and the bytes decoded from them, in one pass over the text."""
    kind = pa.struct([("ids", pa.binary()), ("decoded", pa.binary())])

    @F.arrow_udf("struct<ids binary, decoded binary>")
    def both(texts: pa.Array) -> pa.Array:
        run = tokenizer(path, pattern)
        ids = [run.encode(x.as_py()) for x in texts]
        back = [run.decode(x) for x in ids]
        return pa.StructArray.from_arrays([pa.array(ids, type=pa.binary()), pa.array(back, type=pa.binary())], fields=list(kind))

    return both(text)


def token_ids(packed: Column) -> Column:
    """Packed ids as array<int>; for shards that want plain integers."""

    @F.arrow_udf("array<int>")
    def unpacked(ids: pa.Array) -> pa.Array:
        return pa.array([array("i", x.as_py() or b"").tolist() for x in ids], type=pa.list_(pa.int32()))

    return unpacked(packed)
