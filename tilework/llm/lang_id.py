"""Language identification by compression.

Each language gets a raw-content Zstandard dictionary made of labelled text, whose last
``leads`` x ``lead_bytes`` bytes are set aside as lead-ins. A text is lower-cased and cut
into independent blocks; every block is compressed behind each lead-in of a language,
against the language's dictionary, and costs what it adds to the compressed lead-in. The
language with the smallest total wins. Behind a lead-in the entropy tables are settled,
so that short texts, which alone would not be compressed at all, are told apart by the
same measure as long ones; several lead-ins even out which one it is. The relative
margin to the runner-up is the score, and a narrow margin is a rejection.

Defined results: null text, empty text and text without a letter give language
``und``, score 0 and a rejection; equal sizes are decided by language name and rejected;
very long texts are read whole, block by block; repeated rows are judged each. Extra
columns of the input are never read. An empty training table gives a model without
languages, for which every text is ``und``; with one language every text is in it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

UNKNOWN = "und"
RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LanguageModel:
    """``dictionaries``: language to dictionary bytes, lead-ins last; ``margin``: below it a text is rejected."""

    dictionaries: dict = field(default_factory=dict)
    level: int = 5
    block_bytes: int = 4096
    leads: int = 2
    lead_bytes: int = 1024
    margin: float = 0.005


def train(
    labelled: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = 400,
    bytes_per_doc: int = 160,
    max_languages: int = 8192,
    **model,
) -> LanguageModel:
    """Dictionaries from a bounded sample of the labelled rows.

    The sample holds the middle ``bytes_per_doc`` bytes of up to ``docs_per_language``
    documents of each language, those with the lowest hash of their id whose piece has a
    letter and is no copy of another's. The driver receives no more than that, at any input
    size. ``max_languages`` is above the number of languages that have a code (ISO 639-3);
    more distinct labels are no languages, and an error.
    """
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("lang is not null and text is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()}
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages among the labels")
    if not counts:
        return LanguageModel(**model)
    # A hash of the id below a language's own threshold keeps few rows before anything is sorted.
    unit = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4.0 * docs_per_language / n))])
    start = F.greatest(F.lit(1), F.floor((F.length("text") - bytes_per_doc) / 2) + 1).cast("int")
    piece = F.lower(F.substring(F.col("text"), start, F.lit(bytes_per_doc)))
    picked = rows.where(unit < share[F.col("lang")]).select("lang", unit.alias("u"), piece.alias("piece")).where(F.col("piece").rlike(r"\p{L}"))
    first = picked.groupBy("lang", "piece").agg(F.min("u").alias("u"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("u", "piece"))
    parts: dict = {}
    for row in first.withColumn("k", rank).where(F.col("k") <= docs_per_language).orderBy("lang", "k").collect():
        # Pieces are cut by characters; what is over in bytes goes, and half a character with it.
        parts.setdefault(row.lang, []).append(row.piece.encode()[:bytes_per_doc].decode("utf-8", "ignore").encode())
    return LanguageModel({k: b"\n".join(v) for k, v in sorted(parts.items())}, **model)


class _Scorer:
    """The compressors of one Python worker."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.languages = sorted(model.dictionaries)
        self.measures = [self._measure(model.dictionaries[x]) for x in self.languages]

    def _measure(self, data: bytes) -> tuple:
        """A compressor of one language, and its lead-ins with their compressed sizes."""
        model = self.model
        size = min(model.lead_bytes, len(data) // (model.leads + 1))
        cut = len(data) - size * model.leads
        made = zstandard.ZstdCompressionDict(data[:cut], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.precompute_compress(level=model.level)
        squeeze = zstandard.ZstdCompressor(level=model.level, dict_data=made, write_content_size=False).compress
        leads = [data[cut + i * size : cut + (i + 1) * size] + b"\n" for i in range(model.leads)]
        return squeeze, [(x, len(squeeze(x))) for x in leads]

    def __call__(self, text: str | None) -> tuple:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        data, step = text.lower().encode("utf-8", "replace"), self.model.block_bytes
        blocks = [data[i : i + step] for i in range(0, len(data), step)]
        sizes = [max(1, sum(len(f(x + b)) - alone for x, alone in leads for b in blocks)) for f, leads in self.measures]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.languages[i]))
        if len(order) == 1:
            return self.languages[0], 1.0, False
        best, second = sizes[order[0]], sizes[order[1]]
        score = (second - best) / second
        return self.languages[order[0]], score, score < self.model.margin


def predict(model: LanguageModel, text: Column) -> Column:
    """A struct of ``lang_pred``, ``score`` and ``rejected`` for every whole text."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
    cell: list = []

    @F.arrow_udf(RESULT)
    def scored(texts: pa.Array) -> pa.Array:
        if not cell:
            cell.append(_Scorer(model))
        found = [cell[0](x.as_py()) for x in texts]
        columns = [pa.array(list(c), type=f.type) for c, f in zip(zip(*found), kind, strict=True)] if found else [
            pa.array([], type=f.type) for f in kind
        ]
        return pa.StructArray.from_arrays(columns, fields=list(kind))

    return scored(text)
