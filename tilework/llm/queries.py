"""The registered queries of the training-data operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import byte_bpe, chat, decontaminate, fingerprint, lang_id, near_dedup, pii, quality, url_rules, warc
from .scratch import Scratch

#: The rules that op6 judges by: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def vocabulary() -> tuple[str, str]:
    """Rank file and splitting pattern of op2 and of the pipeline."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def language_model(docs: DataFrame) -> lang_id.LanguageModel:
    return lang_id.train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_model(docs)
    found = docs.select("doc_id", lang_id.predict(model, F.col("text")).alias("p"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score", "p.rejected")


def token_columns(both) -> list:
    return [
        (F.octet_length(both["ids"]) / 4).cast("bigint").alias("n_tokens"),
        F.sha2(both["ids"], 256).alias("ids_sha256"),
        F.sha2(both["decoded"], 256).alias("decoded_sha256"),
    ]


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = docs.select("doc_id", byte_bpe.encode_and_decode(*vocabulary(), F.col("text")).alias("b"))
    return made.select("doc_id", *token_columns(F.col("b")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = CONTROL_TEXT.replace("\\", "\\\\")
    control = spark.sql(f"select * from values (-7L, 0L, 'user', '{text}'), (-7L, 1L, 'assistant', '{text}') as t(conv_id, turn, role, text)")
    # Each turn replies to the one before it; rows that share a turn follow each other by role and text.
    made = chat.format_trees(chat.chains(rows.unionByName(control)))
    read = made.select(
        F.col("tree").alias("conv_id"),
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text("formatted", "loss_spans").alias("loss"),
    )
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    # class_id: the least id of the near-duplicate group; exact_id: that of the equal texts.
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("group_id").alias("class_id"),
        F.col("class_id").alias("exact_id"),
        "copies",
        "verified_links",
        F.col("id").eqNullSafe(F.col("group_id")).alias("kept"),
    )


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"select * from values {listed} as t(host, path, verdict)")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = warc.BundleParams()
    records = warc.plan_records(table(spark, sf_dir, "pages"), params)
    # The archives: bundles in the shared folder, already compressed.
    bundles = Scratch(spark, "warc").save(warc.write_bundles(records, params), "uncompressed")
    return warc.read_bundles(bundles, payload=False).drop("url")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    spans = F.col("spans")
    count = [F.size(pii.of_kind(spans, k)).cast("bigint").alias(f"n_{k}") for k in pii.BASE_KINDS]
    base = pii.listed(pii.of_kind(spans, *pii.BASE_KINDS))
    score = F.coalesce(F.array_max(F.transform(spans, lambda s: s["score"])), F.lit(0.0)).alias("score")
    added = (F.size(spans) - sum(F.size(pii.of_kind(spans, k)) for k in pii.BASE_KINDS)).cast("bigint").alias("n_added")
    shown = F.array_join(F.transform(spans, lambda s: F.format_number(s["score"], 2)), ",").alias("scores")
    return found.select("row.doc_id", *count, F.sha2(base, 256).alias("base_sha256"), pii.listed(spans).alias("spans"), added, score, shown)


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.successor_fingerprints(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_byte_bpe,
        op3_quality,
        op4_chat,
        op5_near_dedup,
        op6_url_rules,
        op7_warc,
        op8_pii,
        op9_fingerprint,
        op10_decontaminate,
    )
}

ORACLE_SQL = {
    "op4_chat": r"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized as (
  select *, 14 + length(role) + length(text)
    + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '#', ''))
    + length(role) - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '#', ''), ':', '')) as shown
  from rows_)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(shown)::bigint as formatted_chars
from sized group by conv_id""",
    "op6_url_rules": r"""
with rules(host_, path_, verdict_) as (values
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut as (
  select row_number() over () as k, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
met as (
  select k, arg_max(host_ || path_, length(host_ || path_)) as rule, arg_max(verdict_, length(host_ || path_)) as verdict
  from cut join rules on (host = host_ or ends_with(host, '.' || host_)) and starts_with(path, path_) group by k)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from cut left join met using (k)""",
    "op7_warc": """
with p as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n,
    max(page_id) over (partition by coalesce(html, '')) as first from pages)
select page_id, n::bigint as payload_bytes, sha1(html) as payload_digest,
  case when n >= 1000 and page_id is distinct from first and first is not null then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id is distinct from first then first end as refers_to
from p""",
}
