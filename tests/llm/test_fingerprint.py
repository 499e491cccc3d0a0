"""Fingerprints: peeling against set difference, the edited texts, the order of documents."""

import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tilework.llm import fingerprint as fp


def multiset(text):
    return Counter(fp.paragraphs(text, 200))


def jaccard(a, b):
    x, y = multiset(a), multiset(b)
    both, all_ = sum((x & y).values()), sum((x | y).values())
    return 1.0 if not all_ else both / all_


def texts(seed=1, n=60):
    rng = random.Random(seed)
    lines = ["line %d of many." % i for i in range(40)] + ["again!"] * 3
    out = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return out + ["", "no end", "word " * 3000, "\n\n...", "é\n" * 50]


def test_likeness_is_the_jaccard_similarity_of_paragraphs():
    a = texts(1)
    b = texts(2)[: len(a)]
    made = fp._sketch_chunk(a, b, a, fp.SketchParams())
    for x, y, got, same in zip(a, b, made["near_edited"], made["near_next"], strict=True):
        assert abs(got - jaccard(x, y)) < 1e-9 and same == 1.0


def test_peeling_recovers_the_differing_digests():
    a, b = ["one.\ntwo.\nthree."], ["one.\ntwo.\nfour.\nfive."]
    oa, da = fp.digests(a, 200)
    ob, db = fp.digests(b, 200)
    count, found = fp.differences(oa, da, ob, db, 1, fp.SketchParams())
    assert count.tolist() == [3]
    keys = {(int(k), int(s)) for _, ks, ss in found for k, s in zip(ks, ss, strict=True)}
    assert keys == {(int(k), 1) for k in np.setdiff1d(da, db)} | {(int(k), -1) for k in np.setdiff1d(db, da)}


def test_a_small_sketch_fails_and_a_larger_one_succeeds():
    a, b = ["\n".join(f"a{i}." for i in range(200))], ["\n".join(f"b{i}." for i in range(200))]
    oa, da = fp.digests(a, 200)
    ob, db = fp.digests(b, 200)
    small = fp.Sketches(1, 18).add(oa, da).minus(fp.Sketches(1, 18).add(ob, db))
    assert not small.peel()[0][0]
    assert fp.differences(oa, da, ob, db, 1, fp.SketchParams())[0].tolist() == [400]


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = {}
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[i] = (len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest(), jaccard(t, after))
    return out


def test_every_document_and_its_next_one(spark):
    rows = list(enumerate(texts(3, 40), start=-5)) + [(10**12, None), (None, "null id")]
    got = fp.successor_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = expected(rows)
    for r in got:
        n, digest, near = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, digest) and abs(r.near_next - near) < 1e-9


def test_equal_texts_have_equal_fingerprints(spark):
    got = fp.successor_fingerprints(spark.createDataFrame([(1, "a.\nb."), (2, "a.\nb."), (3, "c.")], "doc_id long, text string"))
    f = {r.doc_id: r.fingerprint for r in got.collect()}
    assert f[1] == f[2] != f[3]


def test_repeated_rows_single_rows_and_none(spark):
    one = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    row = fp.successor_fingerprints(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"aba").hexdigest() and row.near_next == 1.0
    assert fp.successor_fingerprints(one.unionByName(one)).count() == 2
    assert fp.successor_fingerprints(one.limit(0)).count() == 0


def test_colliding_digests_end_the_growth():
    """Two equal digests in one version cancel out in any sketch; the pair is then compared directly."""
    params = fp.SketchParams()
    a, b = np.array([5, 5, 9, 11], np.uint64), np.array([9, 12], np.uint64)
    owners = np.zeros(4, np.int64), np.zeros(2, np.int64)
    differ, found = fp.differences(owners[0], a, owners[1], b, 1, params)
    assert differ.tolist() == [4]
    keys, signs = (np.concatenate([f[k] for f in found]) for k in (1, 2))
    assert sorted(zip(keys.tolist(), signs.tolist())) == [(5, 1), (5, 1), (11, 1), (12, -1)]


def test_clashing_columns_and_a_very_long_text(spark):
    rows = [(2, "One. " * 200_000, 1, "b"), (1, "Two. Three.", 2, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket int, copy string").withColumn("place", F.lit(3))
    got = {r.doc_id: r for r in fp.successor_fingerprints(docs).collect()}
    assert {i: r.n_chars for i, r in got.items()} == {2: 1_000_000, 1: 11} and got[2].near_next < 0.01
