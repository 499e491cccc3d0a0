"""Near-duplicates against brute force: groups, classes, families of copies, the difference filter."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilework.llm import near_dedup as nd

WORDS = [a + b for a in "ba de fi go lu ma ne po ri su ta vo".split() for b in "ba de fi go lu ma ne po ri su ta vo".split()]


def brute(texts: dict) -> dict:
    """Group of each id by comparing all pairs of distinct word sequences."""
    sets, seqs = {}, {}
    for i, t in texts.items():
        words = nd.words_of(t)
        seqs.setdefault(tuple(words) if words else ("\0", t or ""), []).append(i)
    reps = {min(v): k for k, v in seqs.items()}
    parent = {i: i for i in reps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, k in reps.items():
        sets[i] = nd.shingles([] if k[0] == "\0" else list(k), 5)
    for a, b in itertools.combinations(reps, 2):
        if len(sets[a][0]) and len(sets[b][0]) and nd.similarity(sets[a], sets[b]) >= 0.8:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(min(v)) for v in seqs.values() for i in v}


def family(rng, base, count, edits):
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(*edits)):
            words[rng.randrange(len(words))] = rng.choice(WORDS) + "x"
        out.append(" ".join(words))
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    base = [rng.choice(WORDS) for _ in range(120)]
    texts = family(rng, base, 60, (0, 7))  # one family with members on either side of the threshold
    texts += [" ".join(base[:90])] * 3 + [" ".join(base[30:])]
    twisted = base[:60] + [rng.choice(WORDS) for _ in range(60)]
    texts += family(rng, twisted, 20, (0, 4))
    texts += [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 200))) for _ in range(60)]
    texts += ["", None, "!!!", "!!!", "???", "one", "ONE!", "one two", "x " * 500, "x " * 300]
    return dict(enumerate(texts))


def test_groups_are_those_of_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.id: r.group_id for r in nd.near_duplicates(docs, nd.NearParams(small=3)).collect()}
    assert got == brute(texts)


def test_the_planted_tables(spark):
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert {r.id: r.group_id for r in nd.near_duplicates(docs).collect()} == brute(texts)


def test_one_row_of_each_group_stays_with_all_columns(spark):
    rows = [(1, "a b c d e f g", "u"), (1, "a b c d e f g", "u"), (2, "A b c, d e f g", "v"), (3, "z", "w"), (3, "y", "w"), (None, "q", "n"), (None, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, raw string")
    got = sorted((str(r.doc_id), str(r.text), r.raw) for r in nd.keep_representatives(docs).collect())
    assert got == sorted([("1", "a b c d e f g", "u"), ("3", "z", "w"), ("3", "y", "w"), ("None", "q", "n"), ("None", "None", "n")])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(docs).count() == 0 and nd.keep_representatives(docs).count() == 0


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 300).astype(np.uint64)
    a = (np.sort(keys[:200]), rng.integers(1, 5, 200).astype(float))
    b = (np.sort(keys[60:260]), rng.integers(1, 5, 200).astype(float))
    sig = nd.signatures([a, b, a, (np.empty(0, np.uint64), np.empty(0))], 4096, 5)
    assert (sig[0] == sig[2]).all()
    assert abs((sig[0] == sig[1]).mean() - nd.probability_jaccard(a, b)) < 0.04


def test_probability_jaccard_is_scale_free_and_plain_for_equal_weights():
    keys = np.arange(10, dtype=np.uint64)
    a, b = (keys[:8], np.ones(8)), (keys[2:], np.ones(8))
    assert nd.probability_jaccard(a, b) == pytest.approx(6 / 10)
    assert nd.probability_jaccard((keys, np.full(10, 3.0)), (keys, np.ones(10))) == pytest.approx(1)
    w = np.arange(1.0, 11.0)
    direct = sum(1 / sum(max(w[e] / w[d], 1.0) for e in range(10)) for d in range(10))
    assert nd.probability_jaccard((keys, w), (keys, np.ones(10))) == pytest.approx(direct)


def test_the_difference_filter_loses_no_pair():
    rng = random.Random(5)
    p = np.array(rng.sample(range(10_000), 100), np.uint64)
    p.sort()
    found = 0
    members = []
    for _ in range(300):
        drop, add = rng.randint(0, 30), rng.randint(0, 30)
        keep = rng.sample(list(p), len(p) - drop)
        pool = range(20_000, 20_040)  # few shingles, so that members share them
        x = np.unique(np.array(keep + rng.sample(pool, add), np.uint64))
        size, filed = nd.difference_prefixes(p, x, 0.8)
        members.append((x, size, dict(filed)))
    jaccard = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y))

    def meet(x, sx, fx, y, sy, fy):
        """Whether the pair is found: one shared shingle at places that allow for enough more."""
        c = 0.2 / 1.8
        return any(
            2 * min(sx - i, sy - int(np.flatnonzero(fy == t)[0])) >= sx + sy - c * (len(x) + len(y)) - 1e-9
            for i, t in enumerate(fx)
            if t in fy
        )

    for (x, sx, fx), (y, sy, fy) in itertools.combinations(members, 2):
        if jaccard(x, y) < 0.8 or (nd.LINKED in fx and nd.LINKED in fy):
            continue
        found += 1
        if nd.LINKED in fy:
            (x, sx, fx), (y, sy, fy) = (y, sy, fy), (x, sx, fx)
        if nd.LINKED in fx:
            assert meet(x, sx, fx[nd.LINKED], y, sy, fy[nd.OTHER])
        else:
            assert meet(x, sx, fx[nd.OTHERS], y, sy, fy[nd.OTHERS])
    assert found > 20


def test_linked_means_the_threshold():
    p = np.arange(90, dtype=np.uint64)
    assert dict(nd.difference_prefixes(p, np.arange(72, dtype=np.uint64), 0.8)[1]).keys() == {nd.LINKED}
    assert dict(nd.difference_prefixes(p, np.arange(71, dtype=np.uint64), 0.8)[1]).keys() == {nd.OTHER, nd.OTHERS}


def uneven_family(seed=11):
    """Texts that repeat a line, in clusters alike by probability Jaccard only; all in the bucket of one register."""
    rng = random.Random(seed)
    line = [f"line{i}" for i in range(12)]
    texts = []
    for k in range(60):
        own = [f"c{k % 8}w{i}" for i in range(14)] + [f"t{k}w{i}" for i in range(rng.randint(2, 20))]
        texts.append(" ".join(line * rng.randint(9, 13) + own))
    sets = [nd.shingles(nd.words_of(t), 5) for t in texts]
    first = nd.signatures(sets, 1, nd.NearParams().seed)[:, 0].tolist()
    most = max(first, key=first.count)
    return {i: t for i, t in enumerate(texts) if first[i] == most}


def test_large_buckets_find_links_of_uneven_counts(spark):
    texts = uneven_family()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    one_bucket = nd.NearParams(registers=1, band=1, small=3)
    want = brute(texts)
    assert 1 < len(set(want.values())) < len(texts) / 2
    assert {r.id: r.group_id for r in nd.near_duplicates(docs, one_bucket).collect()} == want


def test_the_filter_beside_the_anchor_loses_no_pair():
    rng = random.Random(9)
    sets = []
    for k in range(160):
        tokens = sorted({3, *rng.sample(range(60), 40), *([101] if k else []), *rng.sample(range(100, 130), rng.randint(0, 8))})
        heavy = {3: rng.choice([150, 300]), 101: rng.choice([20, 100, 300])}
        sets.append((np.array(tokens, np.uint64), np.array([heavy.get(t, 1) for t in tokens], float)))
    p, found, beside = sets[0], 0, 0
    filed = [nd.beside_anchor(p, x) for x in sets]
    filed = [(d, b, t, np.cumsum(w[::-1])[::-1]) for d, b, t, w in filed]
    for (x, (dx, bx, tx, rx)), (y, (dy, by, ty, ry)) in itertools.combinations(zip(sets, filed, strict=True), 2):
        if nd.probability_jaccard(x, y) < 0.8:
            continue
        found += 1
        assert abs(dx - dy) <= 0.2 + 1e-9
        if max(bx, by) > 0.2 + 1e-9:
            beside += 1
            rest = dict(zip(ty.tolist(), ry, strict=True))
            assert any(t in rest and min(r, rest[t]) >= max(bx, by) - 0.2 - 1e-9 for t, r in zip(tx.tolist(), rx, strict=True))
    assert found > 20 and beside > 5


def test_a_passage_repeated_many_times_still_meets_its_text(spark):
    rng = random.Random(2)
    texts = {}
    for k in range(12):
        words = [f"w{k}x{rng.randrange(10**6)}" for _ in range(300)]
        texts[2 * k], texts[2 * k + 1] = " ".join(words), " ".join(words + words[-10:] * 60)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.id: r.group_id for r in nd.near_duplicates(docs).collect()} == {i: i // 2 * 2 for i in texts}


def plain_groups(texts: dict) -> dict:
    """Groups by code of its own: shingles are tuples of words, all pairs of different texts are compared."""
    import collections
    import re

    words = {i: re.findall(r"\w+", (t or "").lower()) for i, t in texts.items()}
    key = {i: tuple(w) if w else ("\0", texts[i] or "") for i, w in words.items()}
    first = {}
    for i in sorted(texts):
        first.setdefault(key[i], i)
    bags = {i: collections.Counter(tuple(words[i][k : k + 5]) for k in range(max(1, len(words[i]) - 4))) for i in first.values() if words[i]}
    parent = {i: i for i in first.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in itertools.combinations(sorted(bags), 2):
        a, b = bags[x], bags[y]
        both = a.keys() & b.keys()
        if not both:
            continue
        alike = len(both) / len(a.keys() | b.keys()) >= 0.8 - 1e-12
        if not alike and (len(set(a.values())) > 1 or len(set(b.values())) > 1):
            pairs = collections.Counter((a.get(e, 0), b.get(e, 0)) for e in a.keys() | b.keys())
            total = sum(n / sum(m * max(p / u, q / v) for (p, q), m in pairs.items()) for (u, v), n in pairs.items() if u and v)
            alike = total >= 0.8 - 1e-12
        if alike:
            parent[max(root(x), root(y))] = min(root(x), root(y))
    return {i: root(first[key[i]]) for i in texts}


def test_against_code_that_shares_nothing(spark):
    texts = corpus(8)
    # Pairs alike by probability Jaccard alone, in one large bucket: a line 21 times, then words of a pair and of a text.
    for k in range(40):
        for j in range(2):
            own = [f"s{k}x{i}" for i in range(3)] + [f"o{k}y{j}z{i}" for i in range(11)]
            texts[1000 + 2 * k + j] = " ".join("ma mb mc md me".split() * 21 + own)
    want = plain_groups(texts)
    assert all(want[1000 + 2 * k] == want[1001 + 2 * k] == 1000 + 2 * k for k in range(40))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.id: r.group_id for r in nd.near_duplicates(docs).collect()} == want


def test_a_common_passage_does_not_pair_all_who_hold_it(spark):
    """Members that share a template and a passage that their anchor lacks, but nothing else: no square of them meets."""
    from tilework.llm.scratch import Scratch

    rng = random.Random(6)
    template = [f"t{i}" for i in range(60)]
    passage = [f"p{i}" for i in range(30)]
    texts = [" ".join(template + [f"a{i}" for i in range(40)])]
    texts += [" ".join(template + passage + [f"m{k}w{rng.randrange(10**6)}" for _ in range(40)]) for k in range(300)]
    texts += [texts[k] + f" more{k}" for k in range(1, 11)]  # ten links
    sets = [nd.shingles(nd.words_of(t), 5) for t in texts]
    pairs = [(b"%04d" % 0, b"%04d" % k, texts[0], texts[k], b"%04d" % k) for k in range(1, len(texts))]
    rows = spark.createDataFrame(pairs, "a binary, b binary, ta string, tb string, label binary")
    params = nd.NearParams()
    filed = rows.mapInArrow(nd._differences(params), nd.DIFFERENCES).cache()
    met = {(int(bytes(r.a)), int(bytes(r.b))) for r in nd.meetings(filed, params, Scratch(spark, "test")).collect()}
    met = {tuple(sorted(p)) for p in met}
    links = {(x, y) for x, y in itertools.combinations(range(1, len(texts)), 2) if nd.similarity(sets[x], sets[y]) >= 0.8}
    assert len(links) == 10 and links <= met and len(met) < 3 * len(texts)


def test_clashing_columns_long_texts_and_ties(spark):
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(1, long, 0, "k", 1), (2, long + " end", 0, "k", 1), (3, "a b c d e f", 0, "k", 1), (3, "a b c d e f", 0, "k", 1), (4, "A, b C d e f!", 0, "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, key string, copies int").withColumn("group", F.lit("digest"))
    # No bucket is hot here.
    got = {r.id: (r.group_id, r.class_id, r.copies) for r in nd.near_duplicates(docs, nd.NearParams(small=1, hot_share=1)).collect()}
    assert got == {1: (1, 1, 1), 2: (1, 2, 1), 3: (3, 3, 3), 4: (3, 3, 3)}
    kept = nd.keep_representatives(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_both_shares_bound_probability_jaccard():
    rng = random.Random(12)
    for _ in range(400):
        draw = lambda: {t: rng.choice([1, 1, 2, 7, 40]) for t in rng.sample(range(30), rng.randint(1, 25))}
        x, y = draw(), draw()
        u, v = (sum(n for t, n in a.items() if t not in b) / sum(a.values()) for a, b in ((x, y), (y, x)))
        arrays = [(np.array(sorted(a), np.uint64), np.array([a[t] for t in sorted(a)], float)) for a in (x, y)]
        if max(u, v) < 1:
            assert nd.probability_jaccard(*arrays) <= 1 / (1 + u / (1 - u) + v / (1 - v)) + 1e-12


def test_members_of_uneven_counts_do_not_all_meet_by_their_anchor(spark):
    """Members with words of their own beside a common line, linked to their anchor or not: only those alike are paired."""
    from tilework.llm.scratch import Scratch

    line = [f"l{i}" for i in range(5)] * 40
    texts = [" ".join(line + [f"a{i}" for i in range(20)])]
    texts += [" ".join(line + [f"m{k}w{i}" for i in range((22, 34, 26, 42)[k % 4])]) for k in range(200)]
    texts += [texts[k] + f" more{k}" for k in range(2, 42, 4)]  # ten links
    sets = [nd.shingles(nd.words_of(t), 5) for t in texts]
    linked = [nd.similarity(sets[0], s) >= 0.8 for s in sets]
    assert 90 < sum(linked) < 120
    rows = [(b"%04d" % 0, b"%04d" % k, texts[0], texts[k], b"%04d" % (0 if linked[k] else k)) for k in range(1, len(texts))]
    params = nd.NearParams()
    filed = spark.createDataFrame(rows, "a binary, b binary, ta string, tb string, label binary").mapInArrow(nd._differences(params), nd.DIFFERENCES)
    met = nd.meetings(filed.cache(), params, Scratch(spark, "test")).collect()
    pairs = {tuple(sorted((int(bytes(r.a)), int(bytes(r.b))))) for r in met}
    open_ = [p for p in itertools.combinations(range(1, len(texts)), 2) if not (linked[p[0]] and linked[p[1]])]
    links = {(x, y) for x, y in open_ if nd.similarity(sets[x], sets[y]) >= 0.8}
    assert len(links) == 10 and links <= pairs and len(pairs) < len(texts)
