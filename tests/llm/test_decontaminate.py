"""Decontamination against a plain edit-distance search."""

import random

import pytest

from tilework.llm import decontaminate as dc


def distance_in(pattern: str, text: str) -> int:
    """Least edit distance of the pattern to any substring, by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row = row, [i] + [0] * len(text)
        for j, t in enumerate(text, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (p != t))
    return min(row)


def test_myers():
    rng = random.Random(2)
    for _ in range(200):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        b = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        least, end = dc.Myers(a).best(b)
        assert least == distance_in(a, b) == (distance_in(a, b[:end]) if b else len(a))


def corpus():
    rng = random.Random(4)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed", "magna", "quis", "nulla", "fugiat", "culpa"]
    items = [(i, " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(rng.randint(8, 30)))) for i in range(8)]
    docs = []
    for i in range(80):
        filler = lambda: " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(rng.randint(0, 40)))
        text = list(rng.choice(items)[1]) if i % 3 else list(filler())
        for _ in range(rng.randint(0, 24)):
            at = rng.randrange(len(text) + 1) if text else 0
            kind = rng.randint(0, 2)
            if kind == 0:
                text.insert(at, rng.choice("abc 1"))
            elif text and at < len(text):
                text[at : at + 1] = [] if kind == 1 else [rng.choice("xyz")]
        docs.append((i, filler() + " " + "".join(text) + ". " + filler()))
    return docs, items


def test_finds_all_and_only_what_is_within_the_budget(spark):
    docs, items = corpus()
    params = dc.EditParams(rate=0.08)
    got = dc.contaminations(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), params)
    found = {(r.doc_id, r.item_id): r for r in got.collect()}
    expected = {}
    for i, t in docs:
        for j, u in items:
            n = dc.normalise(u)
            d = distance_in(n, dc.normalise(t))
            if d <= int(params.rate * len(n)):
                expected[i, j] = d
    assert {k: r.distance for k, r in found.items()} == expected and 10 < len(expected) < 80
    texts = dict(docs)
    for (i, j), r in found.items():
        n = dc.normalise(dict(items)[j])
        assert distance_in(n, dc.normalise(texts[i])[r.start : r.end]) == r.distance


def test_clean_keeps_columns_and_only_clean_rows(spark):
    docs, items = corpus()
    rows = spark.createDataFrame([(i, t, "x") for i, t in docs] + [(-1, None, "y"), (-2, "", "z")], "doc_id long, text string, item_id string")
    wanted = spark.createDataFrame(items, "item_id long, text string")
    bad = {r.doc_id for r in dc.contaminations(rows, wanted).collect()}
    kept = dc.clean(rows, wanted)
    assert kept.columns == rows.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - bad | {-1, -2}


def test_defined_results(spark):
    docs = spark.createDataFrame([(1, "A" * 3 + " long enough passage that must be forty characters!"), (1, "same"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame(
        [(1, "long enough, passage THAT must be forty characters"), (2, "long enough passage that must be forty characters"), (3, "same"), (4, None)], "item_id int, text string"
    )
    got = dc.contaminations(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [(1, 1, 0), (1, 2, 0)]
    assert dc.contaminations(docs, items.limit(0)).count() == 0 and dc.contaminations(docs.limit(0), items).count() == 0
    split = dc.contaminations(docs, items, dc.EditParams(block_chars=10))
    assert split.count() == 2


def test_short_items(spark):
    """Items of any length, against plain search: whole words where no edit is allowed, edits beyond."""
    items = {1: "Is it cold?", 2: "one two three", 3: "a b", 4: "red fox runs on", 5: "word"}
    texts = ["is it cold", "his it colder", "Is it colder", "so: IS IT, COLD!", "one two thre", "one two three", "a  b", "ba b", "a bb", "x a b x", "red fox runs up", "the red fox run on", "word"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    wanted = spark.createDataFrame(list(items.items()), "item_id int, text string")
    expected = set()
    for i, t in enumerate(texts):
        for j, u in items.items():
            n, m = dc.normalise(u), dc.normalise(t)
            budget = int(0.08 * len(n))
            hit = f" {n} " in f" {m} " if budget == 0 else distance_in(n, m) <= budget
            if hit and " " in n:
                expected.add((i, j))
    got = dc.contaminations(docs, wanted)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == expected and len(expected) == 7
    assert {r.doc_id for r in dc.clean(docs, wanted).collect()} == set(range(len(texts))) - {i for i, _ in expected}
    found = {(r.doc_id, r.item_id): (r.start, r.end) for r in got.collect()}
    assert dc.normalise(texts[9])[slice(*found[9, 3])] == "a b"


def test_a_very_long_text_and_repeated_rows(spark):
    item = "this passage of the test is long enough to hold edits"
    text = "filler words " * 40_000 + item.replace("long", "lang") + " filler" * 40_000
    docs = spark.createDataFrame([(1, text, 0), (1, text, 0), (2, "filler " * 80_000, 0)], "doc_id int, text string, distance int")
    got = dc.contaminations(docs, spark.createDataFrame([(7, item)], "item_id int, text string")).collect()
    assert [(r.doc_id, r.item_id, r.distance) for r in got] == [(1, 7, 1)] * 2


@pytest.mark.parametrize("length, budget", [(40, 3), (41, 0), (100, 9)])
def test_pieces_cover_the_item(length, budget):
    item = "".join(chr(97 + i % 26) for i in range(length))
    cut = dc.pieces(item, budget)
    assert len(cut) == budget + 1 and "".join(p for _, p in cut) == item and all(item[o : o + len(p)] == p for o, p in cut)
