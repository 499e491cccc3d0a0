"""The corpus pipeline: raw documents to token ids, in five written stages.

``STAGES`` lists them in order. Each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame; all but the last return the columns of ``documents``. Between
stages the result is written as Parquet and read again, so no stage depends on the
lineage of the one before it; what a stage wrote for itself goes once its result is written.

Defined results, for every stage: an empty table gives an empty one with the same columns;
extra columns of the input are dropped, whatever their names; texts are handled whole.
Rows that repeat are handled each, but for near-dedup, which keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilework.llm import byte_bpe, decontaminate, lang_id, near_dedup, pii
from tilework.llm.queries import language_model, table, token_columns, vocabulary
from tilework.llm.scratch import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go: no text, no letters, or a margin too narrow to tell (ties are)."""
    rows = docs.select(*COLUMNS)
    return rows.where(~lang_id.predict(language_model(rows), F.col("text"))["rejected"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the least id; null ids last.

    Null texts count as empty; texts without a word are copies of the same text only.
    """
    return near_dedup.keep_representatives(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edits included, go; null and empty texts hold none."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by the name of their kind; null texts stay null."""
    found = pii.find(docs.select(*COLUMNS), keep=list(COLUMNS))
    text = F.when(F.col("row.text").isNotNull(), pii.redact("text", "spans"))
    clean = found.select("row", text.alias("text"))
    return clean.select(
        "row.doc_id", "text", "row.lang", "row.source", F.length("text").cast("bigint").alias("n_chars")
    )


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their digest, and the digest of what they decode to; null texts count as empty."""
    both = byte_bpe.encode_and_decode(*vocabulary(), F.col("text")).alias("b")
    made = docs.select("doc_id", "lang", "source", "n_chars", both)
    return made.select("doc_id", "lang", "source", "n_chars", *token_columns(F.col("b")))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pii", redact_personal_data),
    ("byte_bpe", tokenise),
]

#: Compression, sketches and merges have no SQL form: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs, source = table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        mark = len(Scratch.made)
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.save(docs)
            # Nothing reads the stage's own tables any more, nor what it read.
            for own in Scratch.made[mark:]:
                own.sweep()
            del Scratch.made[mark:]
            if source is not None:
                scratch.drop(source)
            source = scratch.last
    return docs
