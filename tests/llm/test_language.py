"""Language identification: held-out accuracy, defined results, rejection."""

import pytest
from pyspark.sql import functions as F

from tilework.llm import lang_id, queries


@pytest.fixture(scope="module")
def model(spark):
    return queries.language_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_documents_are_not_learned_from(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en") for i in range(50)], "doc_id long, text string, lang string")
    import zlib

    out = {r.doc_id for r in docs.where(queries.held_out(F.col("doc_id"))).collect()}
    assert out == {i for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2}
    learned = queries.language_model(docs).dictionaries["en"].decode().split("\n")
    assert not {f"text {i}" for i in out} & set(learned)


def test_defined_results(spark, model):
    rows = [(None,), ("",), ("123 !! ...",), ("a" * 300_000,), ("の日本",)]
    got = spark.createDataFrame(rows, "text string").select(lang_id.predict(model, F.col("text")).alias("p")).collect()
    assert [r.p.lang_pred for r in got[:3]] == ["und"] * 3 and [r.p.score for r in got[:3]] == [0.0] * 3 and all(r.p.rejected for r in got[:3])
    assert all(r.p.lang_pred in model.dictionaries for r in got[3:])


def test_sample_is_bounded_and_deterministic(spark, model):
    again = queries.language_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert again == model
    assert all(len(d) <= 65536 for d in model.dictionaries.values())


def test_empty_training(spark):
    none = lang_id.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    got = spark.createDataFrame([("hello",)], "text string").select(lang_id.predict(none, F.col("text")).alias("p")).first().p
    assert (got.lang_pred, got.rejected) == ("und", True)


def test_too_many_languages_is_an_error(spark):
    docs = spark.createDataFrame([(i, "x", f"l{i}") for i in range(5)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        lang_id.train(docs, max_languages=3)


def test_training_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(~queries.held_out(F.col("doc_id")))
    rows = docs.select("text", "lang", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)).alias("u")).collect()
    learned = lang_id.train(docs, docs_per_language=30, bytes_per_doc=100).dictionaries
    for lang in {r.lang for r in rows if r.lang}:
        kept = []
        for r in sorted((r for r in rows if r.lang == lang and r.text), key=lambda r: r.u):
            piece = r.text[max(0, (len(r.text) - 100) // 2) :][:100].lower()
            if piece not in kept and any(c.isalpha() for c in piece):
                kept.append(piece)
        want = b"\n".join(p.encode()[:100].decode(errors="ignore").encode() for p in kept[:30])
        assert learned[lang] == want


def plain_language(dictionaries: dict, text: str | None) -> tuple:
    """Language, score and rejection of a text by code of its own; ``dictionaries`` end in two lead-ins of 1024 bytes."""
    import zstandard

    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0, True
    data, sizes = text.lower().encode(), {}
    for lang, known in dictionaries.items():
        content = zstandard.ZstdCompressionDict(known[:-2048], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        pack = lambda b: len(zstandard.ZstdCompressor(level=5, dict_data=content, write_content_size=False).compress(b))  # noqa: B023, E731
        total = 0
        for lead in (known[-2048:-1024] + b"\n", known[-1024:] + b"\n"):
            total += sum(pack(lead + data[i : i + 4096]) - pack(lead) for i in range(0, len(data), 4096))
        sizes[lang] = max(1, total)
    (best, lang), (second, _) = sorted((n, x) for x, n in sizes.items())[:2]
    return lang, (second - best) / second, (second - best) / second < 0.005


def test_prediction_against_brute_force(spark):
    small = queries.language_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    texts |= {-1: "the und", -2: "é" * 9000, -3: "x", -4: None, -5: "12"}
    got = spark.createDataFrame(list(texts.items()), "doc_id long, text string").select("doc_id", lang_id.predict(small, F.col("text")).alias("p")).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r.p) == plain_language(small.dictionaries, texts[r.doc_id])


def test_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(i % 3, "same words in each language here", x, "p", 1.0) for i in range(6) for x in ("b", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    made = lang_id.train(docs)
    assert made.dictionaries["a"] == made.dictionaries["b"] == b"same words in each language here"
    got = docs.withColumn("p", lang_id.predict(made, F.col("text"))).collect()
    assert len(got) == 12 and all((r.p.lang_pred, r.p.score, r.p.rejected) == ("a", 0.0, True) for r in got)


def test_a_repeated_id_does_not_flood_the_sample(spark):
    docs = spark.range(5000).select(F.lit(7).alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    learned = lang_id.train(docs, docs_per_language=10).dictionaries
    assert len(learned.get("en", b"").split(b"\n")) <= 10


def test_a_hundred_languages(spark):
    docs = spark.range(600).select("id", F.concat_ws(" ", F.lit("w"), F.sha2((F.col("id") % 600).cast("string"), 256)).alias("text"), F.concat(F.lit("l"), F.col("id") % 600).alias("lang"))
    assert len(lang_id.train(docs, id_col="id").dictionaries) == 600
