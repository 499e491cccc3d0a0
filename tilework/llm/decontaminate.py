"""Benchmark decontamination by pigeonhole edit matching.

A test item of m normalised characters may occur with k = floor(rate * m) edits
(insertions, deletions, substitutions). Cut into k + 1 pieces, at least one piece
of every such occurrence is untouched, so exact piece hits (one Aho-Corasick pass
over the text) find every place worth looking at. Around each hit a window of the
text is verified with Myers' bit-parallel edit distance.

The items are the query set: they are read in blocks of ``block_chars`` characters,
each block goes with the tasks of one pass over the documents, and nothing of the
documents is gathered anywhere.

A document pass costs one scan for each block, so ``block_chars`` trades a worker's
memory for scans.

Normalisation: lower case, runs of non-word characters become one space. Items of any
length are searched for. Those too short for an edit (budget 0) must stand between word
ends, since as parts of longer words they occur by chance; an item of fewer than
``min_words`` words, a vocabulary entry, is no passage. Defined results: null and empty
texts hold nothing; very long texts are searched whole, in time proportional to their
length and the windows found; items with equal normalised texts are each reported; extra
columns are not read; an empty table on either side gives an empty result. Repeated
document rows are reported once each; of equally near occurrences the first found stands.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

_WORD = regex.compile(r"\w+")


@dataclass(frozen=True)
class EditParams:
    rate: float = 0.08
    min_words: int = 2
    block_chars: int = 1_000_000


def normalise(text: str | None) -> str:
    return " ".join(_WORD.findall(text.lower())) if text else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` consecutive pieces of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Myers:
    """Bit-parallel approximate search of one pattern; one machine word of any length."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.mask = (1 << self.size) - 1
        self.high = 1 << (self.size - 1)
        self.rows: dict[str, int] = defaultdict(int)
        for i, c in enumerate(pattern):
            self.rows[c] |= 1 << i
        self.rows = dict(self.rows)

    def best(self, text: str) -> tuple[int, int]:
        """Least distance of the pattern to a substring of ``text``, and the first end where it is met."""
        plus, minus, score = self.mask, 0, self.size
        least, end, mask, high, rows = self.size, 0, self.mask, self.high, self.rows
        for i, c in enumerate(text, 1):
            eq = rows.get(c, 0)
            x = eq | minus
            d0 = (((x & plus) + plus) ^ plus) | x
            hp = minus | (mask & ~(d0 | plus))
            hn = plus & d0
            if hp & high:
                score += 1
            elif hn & high:
                score -= 1
            hp = hp << 1 & mask
            minus = hp & d0
            plus = (hn << 1 & mask) | (mask & ~(d0 | hp))
            if score < least:
                least, end = score, i
        return least, end


class Searcher:
    """All items of one block, ready to be searched in texts."""

    def __init__(self, items: list[tuple], rate: float):
        self.items = []
        places = defaultdict(list)
        for text, ids in items:
            budget = int(rate * len(text))
            self.items.append((text, budget, ids))
            for offset, piece in pieces(text, budget):
                places[piece].append((len(self.items) - 1, offset))
        self.matcher = ahocorasick.Automaton()
        for piece, where in places.items():
            self.matcher.add_word(piece, (len(piece), where))
        self.matcher.make_automaton()
        self.exact: dict[int, Myers] = {}
        self.back: dict[int, Myers] = {}

    def _myers(self, k: int, back: bool) -> Myers:
        kept = self.back if back else self.exact
        if k not in kept:
            text = self.items[k][0]
            kept[k] = Myers(text[::-1] if back else text)
        return kept[k]

    @staticmethod
    def _whole(item: str, text: str) -> int:
        """Where the item first stands between word ends of a normalised text, or -1."""
        return f" {text} ".find(f" {item} ")

    def find(self, text: str) -> list[tuple]:
        """``(item ids, distance, start, end)`` of the best occurrence of each item in a normalised text."""
        windows: dict[int, list] = {}
        for last, (size, where) in self.matcher.iter(text):
            first = last + 1 - size
            for k, offset in where:
                item, budget, _ = self.items[k]
                a, b = max(0, first - offset - budget), first - offset + len(item) + budget
                own = windows.setdefault(k, [])
                if own and a <= own[-1][1] and a >= own[-1][0]:
                    own[-1][1] = max(own[-1][1], b)
                else:
                    own.append([a, b])
        out = []
        for k, own in windows.items():
            item, budget, ids = self.items[k]
            best = None
            at = self._whole(item, text) if budget == 0 else text.find(item)
            if at >= 0:
                best = (0, at, at + len(item))
            elif budget:
                for a, b in own:
                    distance, end = self._myers(k, False).best(text[a:b])
                    if distance <= budget and (best is None or distance < best[0]):
                        _, back = self._myers(k, True).best(text[a : a + end][::-1])
                        best = (distance, a + end - back, a + end)
            if best:
                out += [(i, len(item), *best) for i in ids]
        return out


def _blocks(items: DataFrame, params: EditParams):
    """Blocks of ``(normalised text, ids)``; equal texts of a block are one entry."""
    block: dict[str, list] = {}
    size = 0
    for row in items.toLocalIterator():
        text = normalise(row[1])
        if not text or text.count(" ") + 1 < params.min_words:
            continue
        if size + len(text) > params.block_chars and block:
            yield list(block.items())
            block, size = {}, 0
        if text not in block:
            size += len(text)
        block.setdefault(text, []).append(row[0])
    if block:
        yield list(block.items())


def contaminations(
    docs: DataFrame,
    items: DataFrame,
    params: EditParams = EditParams(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, item_chars, distance, start, end``: every item that occurs in a document.

    ``start`` and ``end`` are offsets in the normalised text, of the occurrence with
    the least distance (an exact one: the first).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    wanted = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
    doc_kind, item_kind = rows.schema["doc_id"].dataType, wanted.schema["item_id"].dataType
    schema = (
        f"doc_id {doc_kind.simpleString()}, item_id {item_kind.simpleString()}, item_chars int, distance int,"
        " start int, `end` int"
    )
    found = None
    for block in _blocks(wanted, params):

        def search(batches, block=block):
            run = Searcher(block, params.rate)
            names = ["doc_id", "item_id", "item_chars", "distance", "start", "end"]
            for batch in batches:
                hits = [
                    (i.as_py(), *hit)
                    for i, t in zip(batch.column(0), batch.column(1), strict=True)
                    for hit in run.find(normalise(t.as_py()))
                ]
                columns = list(zip(*hits, strict=True)) if hits else [()] * 6
                kinds = [batch.schema.field(0).type, None, pa.int32(), pa.int32(), pa.int32(), pa.int32()]
                kinds[1] = pa.int64() if item_kind.simpleString() == "bigint" else (
                    pa.int32() if item_kind.simpleString() == "int" else pa.string()
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), type=k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

        part = rows.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def _free_of(block: list, rate: float):
    searcher: list = []

    @F.arrow_udf("boolean")
    def free(texts: pa.Array) -> pa.Array:
        if not searcher:
            searcher.append(Searcher(block, rate))
        return pa.array([not searcher[0].find(normalise(x.as_py())) for x in texts], pa.bool_())

    return free


def clean(docs: DataFrame, items: DataFrame, params: EditParams = EditParams(), *, text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no item occurs; a row-wise filter without an exchange."""
    wanted = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
    for block in _blocks(wanted, params):
        docs = docs.where(_free_of(block, params.rate)(F.col(f"`{text_col}`")))
    return docs
