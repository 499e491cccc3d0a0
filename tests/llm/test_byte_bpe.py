"""Byte-level BPE against the rank-based library, and round trips."""

import hashlib
from array import array

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from tilework.llm import byte_bpe, queries

PATH, PATTERN = queries.vocabulary()


@pytest.fixture(scope="module")
def both():
    own = byte_bpe.tokenizer(PATH, PATTERN)
    ranks = {t: i for i, t in enumerate(own.tokens)}
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    out = array("I")
    out.frombytes(packed)
    return out.tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0xFFFF, exclude_categories=["Cs", "Cn"]), max_size=60))
def test_any_text(both, text):
    own, known = both
    packed = own.encode(text)
    assert ids(packed) == known.encode_ordinary(text)
    assert own.decode(packed).decode() == text


@pytest.mark.parametrize("text", ["", "<unk>< unk >", "a" * 5000, " " * 3000 + "x", "\x00\x1c\r\n\t", "ĠĀ▁", "don't we'll I'm", "👩‍👩‍👧 日本語 ñandú"])
def test_special_texts(both, text):
    own, known = both
    assert ids(own.encode(text)) == known.encode_ordinary(text) and own.decode(own.encode(text)).decode() == text


def test_query(spark, both):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = queries.op2_byte_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        expected = both[1].encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(expected)
        assert r.ids_sha256 == hashlib.sha256(array("I", expected).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_columns(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a b",), (None,)], "text string")
    packed = df.select(byte_bpe.encode(PATH, PATTERN, F.col("text")).alias("ids"))
    got = packed.select("ids", byte_bpe.decode(PATH, PATTERN, F.col("ids")).alias("back"), byte_bpe.token_ids(F.col("ids")).alias("n")).collect()
    assert bytes(got[0].back) == b"a b" and len(got[0].n) == 2 and bytes(got[1].back) == b"" and got[1].n == []


def test_ranks_must_be_consecutive(tmp_path):
    (tmp_path / "r").write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(tmp_path / "r"))


def test_every_code_point(both):
    """Splitting and ids of all of Unicode, assigned or not, in front of, behind and between letters, digits and signs."""
    own, known = both
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 64):
        text = " ".join(f"a{c}1{c}, {c}b{c}{c}" for c in points[i : i + 64])
        assert ids(own.encode(text)) == known.encode_ordinary(text), hex(ord(points[i]))


def test_empty_table_repeated_rows_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = [(1, "two words", b"x", "n"), (1, "two words", b"x", "n"), (None, None, None, None), (2, "é" * 300_000, b"", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids binary, decoded string")
    got = docs.select("doc_id", byte_bpe.encode_and_decode(PATH, PATTERN, F.col("text")).alias("b")).collect()
    back = sorted((str(r.doc_id), bytes(r.b.decoded).decode()) for r in got)
    assert back == [("1", "two words")] * 2 + [("2", "é" * 300_000), ("None", "")]
    assert docs.limit(0).select(byte_bpe.encode_and_decode(PATH, PATTERN, F.col("text"))).count() == 0
