"""Chat formatting, URL rules, WARC bundles, the quality model, the pipeline."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tilework.llm import chat, pii, quality, queries, url_rules, warc

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    expected = con.sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(expected.columns)
    at = [expected.columns.index(c) for c in df.columns]
    assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(map(repr, (tuple(r[i] for i in at) for r in expected.fetchall())))


# ---- chat ----

MESSAGES = "conv_id string, node long, parent long, role string, text string, score double"
TREE = [
    ("t", 1, None, "user", "root <#\\> : ", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 5.0),
    ("t", 4, 3, "user", "c </turn>\n### user: x", 0.0), ("t", 5, 4, "assistant", None, 1.0), ("t", 6, 4, "assistant", "</turn>\n", 9.0),
    ("u", 1, 9, "user", "orphan", 0.0), ("v", 1, 2, "user", "cycle", 0.0), ("v", 2, 1, "user", "cycle", 0.0), ("v", 3, 2, "user", "below", 0.0),
    (None, 1, None, None, "no tree", None), ("t", 6, 4, "assistant", "</turn>\n", 9.0),
]


def read(df):
    return df.select(
        "tree", "leaf", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text("formatted", "loss_spans").alias("loss")
    ).collect()


def test_paths_of_a_tree(spark):
    made = chat.format_trees(spark.createDataFrame(TREE, MESSAGES), chat.ChatParams(top=None), score="score")
    got = {(r.tree, r.leaf): [(t.role, t.text) for t in r.turns] for r in read(made)}
    root, b, c = ("user", "root <#\\> : "), ("assistant", "b"), ("user", "c </turn>\n### user: x")
    assert got == {
        ("t", 2): [root, ("assistant", "a")],
        ("t", 5): [root, b, c, ("assistant", "")],
        ("t", 6): [root, b, c, ("assistant", "</turn>\n")],
        ("u", 1): [("user", "orphan")],
        (None, 1): [("", "no tree")],
    }


def test_the_best_branch(spark):
    made = chat.format_trees(spark.createDataFrame(TREE, MESSAGES), score="score")
    got = {r.tree: (r.leaf, r.loss) for r in read(made)}
    assert got == {"t": (6, "b</turn>\n"), "u": (1, ""), None: (1, "")}


def test_a_deep_chain(spark):
    rows = [("d", i, i - 1 if i else None, "assistant" if i % 2 else "user", f"m{i} \\b \\c", 0.0) for i in range(300)]
    got = read(chat.format_trees(spark.createDataFrame(rows, MESSAGES)))
    assert len(got) == 1 and [t.text for t in got[0].turns] == [f"m{i} \\b \\c" for i in range(300)]


def test_no_messages(spark):
    assert chat.format_trees(spark.createDataFrame([], MESSAGES)).count() == 0


def test_chat_is_native(spark):
    df = queries.op4_chat(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)
    assert "Python" not in df._jdf.queryExecution().toRdd().toDebugString()


def test_chains_number_rows_as_one_sort_would(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice([1, 2, None]), rng.choice([None, -3, 0, 5, 9, 10, 11, 40, 41, 2**40]), rng.choice("ab"), rng.choice(["x", "y", None, "x" * 20_000]), 7, 7) for _ in range(400)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node int, tree int")
    for block in (1, 10, 4096):
        got = {}
        for r in chat.chains(docs, block=block).collect():
            got.setdefault(r.conv_id, []).append((r.node, r.parent, r.turn, r.role, r.text))
        assert sorted(map(str, got)) == ["1", "2", "None"]
        for conv, have in got.items():
            have.sort(key=lambda x: x[0])
            first = lambda v: (v is not None, v if v is not None else 0)  # noqa: E731  nulls first
            want = sorted((r[1:4] for r in rows if r[0] == conv), key=lambda r: (first(r[0]), r[1], r[2] is not None, r[2] or ""))
            assert [x[2:] for x in have] == want and [x[0] for x in have] == list(range(1, len(want) + 1))
            assert [x[1] for x in have] == [None, *range(1, len(want))]


def test_long_texts_and_clashing_columns_in_chat(spark):
    long = "\\<#" * 50_000 + "😀"
    rows = [("t", 1, None, "user", long, 0.0, 1), ("t", 2, 1, "assistant", long, 0.0, 1), ("t", 3, 2, "user", "x", 0.0, 1), ("t", 4, 3, "assistant", long, 0.0, 1)]
    docs = spark.createDataFrame(rows, MESSAGES + ", leaf int").withColumn("at", F.lit(1)).withColumn("up", F.lit(2)).withColumn("start", F.lit(3))
    got = read(chat.format_trees(docs))
    assert len(got) == 1 and [t.text for t in got[0].turns] == [long, long, "x", long] and got[0].loss == long + long


# ---- URL rules ----

def test_url_rules(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en", "block"), ("example.com", "/en/x/", "allow"), ("b.net", "", "block"), (None, "/", "block"), ("b.net", None, "block")]
    urls = [
        None, "", "nope", "http://WWW.Example.COM/english?q", "http://example.com/en/x/y#z", "http://example.com", "http://notexample.com/en", "x://a.b.net",
        "http://b.net?x=/", "http://İ.com/", "http://" + "a." * 300 + "com/" + "p/" * 400, "a://b://example.com/en", "http://b.net:80/",
    ]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(0, None, "x")], "page_id long, url string, verdict string")
    got = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert got.count() == len(urls) + 1
    for broadcast in (0, 100):
        made = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), broadcast_rules=broadcast)
        for r in made.collect():
            url = urls[r.page_id] or ""
            host = path = ""
            if "://" in url:
                rest = url.split("://", 1)[1]
                host = re.match(r"[^/?#]*", rest).group()
                path = re.match(r"[^?#]*", rest[len(host) :]).group()
                host = "".join(c.lower() if c.isascii() else c for c in host)
            fit = [(h, p or "", v) for h, p, v in rules if h is not None and host and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
            best = max(fit, key=lambda x: (len(x[0] + x[1]), len(x[0]), x[2] == "block"), default=None)
            assert (r.host, r.path) == (host, path)
            assert (r.rule, r.verdict) == ((best[0] + best[1], best[2]) if best else (None, "allow")), url


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert tuple(url_rules.judge(pages, none).first()) == (1, "a.b", "/c", None, "allow")
    assert url_rules.judge(pages.limit(0), none).count() == 0


# ---- WARC ----

PAGES = [
    (1, None, None), (2, "http://x/\r\né%20 a", ""), (3, "u", "z" * 2000), (4, "u", "z" * 2000), (None, "u", "z" * 2000), (5, "v", "z" * 999), (6, "v", "z" * 999),
    (7, "w", "é" * 500), (8, "w", "é" * 500), (9, "k: v\r\n\r\n", "WARC/1.1\r\n\r\n"),
]


def test_bundles_round_trip(spark):
    params = warc.BundleParams(frame_bytes=1500, bundle_bytes=300)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    bundles = warc.write_bundles(warc.plan_records(pages, params), params).cache()
    got = {r.page_id: r for r in warc.read_bundles(bundles).collect()}
    assert len(got) == len(PAGES)
    first = {3: 4, None: 4, 7: 8}
    for i, url, html in PAGES:
        data, r = (html or "").encode(), got[i]
        assert (r.url, r.payload_bytes, r.payload_digest) == (url, len(data), hashlib.sha1(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first[i]) if i in first else ("response", None))
        assert bytes(r.payload) == (b"" if i in first else data)
    for b in bundles.collect():
        for entry in b.entries:
            assert warc.read_record(bytes(b.content), entry)["page_id"] == entry.page_id


def plain_records(data):
    """Records of unpacked archives by code of its own: (header fields, body)."""
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode("ascii").split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
        size = int(fields["content-length"])
        assert rest[size : size + 4] == b"\r\n\r\n"
        out.append((fields, rest[:size]))
        data = rest[size + 4 :]
    return out


def test_records_as_others_read_them(spark):
    import zstandard
    from urllib.parse import urlsplit

    urls = {
        "http://x/a%20b": "http://x/a%20b", "http://x/a b": "http://x/a%20b", "http://x/100%": "http://x/100%25", "http://x/é?q={1}#<f>": "http://x/%C3%A9?q=%7B1%7D#%3Cf%3E",
        "http://x/%zz%41": "http://x/%25zz%41", "http://[::1]:80/a;b=c,d": "http://[::1]:80/a;b=c,d", "a\r\nWARC-Type: evil": "a%0D%0AWARC-Type:%20evil",
    }
    body = "p" * 1500
    # Page 3 repeats with its payload, page 9 twice as the greatest id; extra columns bear names of the plan.
    rows = [(i, u, body if i == 3 else f"<{i}>", "x", 1) for i, u in enumerate(urls)]
    rows += [(3, "http://x/3", body, "x", 1), (9, "http://x/9", body, "x", 1), (9, "http://x/9", body, "x", 1), (5, "v", "q" * 1200, "x", 1), (6, "v", "q" * 1200, "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, size int").repartition(3)
    bundles = warc.write_bundles(warc.plan_records(pages, warc.BundleParams())).collect()
    found = []
    for b in bundles:
        frames = warc.frames_of(bytes(b.content))
        found += plain_records(b"".join(zstandard.ZstdDecompressor().decompress(bytes(b.content)[a : a + n], max_output_size=m) for a, n, m in frames))
    assert len(found) == len(rows)
    names = [f["warc-record-id"] for f, _ in found]
    assert len(set(names)) == len(names) and all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", n) for n in names)
    shown = {f["x-page-id"]: f["warc-target-uri"] for f, _ in found if int(f["x-page-id"]) in (0, 1, 2, 4)}
    assert shown == {str(i): list(urls.values())[i] for i in (0, 1, 2, 4)}
    assert {f["warc-target-uri"] for f, _ in found} >= set(urls.values())
    assert all(re.fullmatch(r"(?:[!-~])+", f["warc-target-uri"]) and urlsplit(f["warc-target-uri"]) for f, _ in found)
    by_name = {f["warc-record-id"]: (f, body) for f, body in found}
    revisits = [f for f, _ in found if f["warc-type"] == "revisit"]
    assert sorted(f["x-page-id"] for f in revisits) == ["3", "3", "5"]
    one = next(f for f in revisits if f["x-page-id"] == "5")
    told, payload = by_name[one["warc-refers-to"]]
    assert told["x-page-id"] == "6" and payload == b"q" * 1200
    # Two responses of page 9 hold the payload: its revisits name the page, not one of them.
    assert all("warc-refers-to" not in f and f["x-refers-to-page"] == "9" for f in revisits if f["x-page-id"] == "3")


def test_fetching_records_by_their_ids(spark):
    params = warc.BundleParams(frame_bytes=1500, bundle_bytes=300)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    bundles = warc.write_bundles(warc.plan_records(pages, params), params)
    wanted = spark.createDataFrame([(4,), (9,), (9,), (77,), (None,)], "page_id int")
    got = {r.page_id: (r.url, bytes(r.payload)) for r in warc.fetch_records(bundles, wanted).collect()}
    assert got == {4: ("u", b"z" * 2000), 9: ("k: v\r\n\r\n", b"WARC/1.1\r\n\r\n")}
    broken = bundles.withColumn("entries", F.transform("entries", lambda e: e.withField("page_id", e["page_id"] + 1)))
    with pytest.raises(Exception, match="index does not name"):
        warc.read_bundles(broken).collect()


def test_any_zstandard_reader_reads_a_bundle(spark, tmp_path):
    import io

    import zstandard

    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    bundles = warc.write_bundles(warc.plan_records(pages, warc.BundleParams()))
    warc.export_bundles(bundles, str(tmp_path))
    for path in tmp_path.glob("*.warc.zst"):
        data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(path.read_bytes()), read_across_frames=True).read()
        assert data.startswith(b"WARC/1.1\r\n")
    assert warc.write_bundles(warc.plan_records(pages.limit(0), warc.BundleParams())).count() == 0
    with pytest.raises(ValueError):
        warc.frames_of(b"x" * 40)


# ---- quality ----

def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op3_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r for r in got if r.quality == 1]
    bad = [r for r in got if r.quality == 0]
    assert sum(r.keep for r in good) / len(good) > 0.98
    assert sum(not r.keep for r in bad) / len(bad) > 0.7


def test_expectation_maximisation_finds_the_accuracies():
    import random

    rng = random.Random(1)
    size = len(quality.LABELLERS)
    right = [0.95, 0.9, 0.85, 0.9, 0.8, 0.9, 0.85, 0.95, 0.9][:size]
    counts = {}
    for _ in range(20_000):
        good = rng.random() < 0.8
        vote = tuple(quality.NONE if rng.random() < 0.2 else int(good == (rng.random() < a)) for a in right)
        p = quality.pattern_of(vote)
        counts[p] = counts.get(p, 0) + 1
    model = quality.fit_labels(counts)
    assert abs(model.prior - 0.8) < 0.03
    assert all(abs(g - a) < 0.04 for g, a in zip(model.on_good, right, strict=True))
    assert all(abs(1 - b - a) < 0.06 for b, a in zip(model.on_bad, right, strict=True))


def test_quality_defined_results(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "word"), (4, "word"), (5, "$ " * 100_000)], "doc_id long, text string")
    got = {r.id: r for r in quality.classify(docs).collect()}
    assert [got[i].score for i in (1, 2, 3)] == [0.0] * 3 and not any(got[i].keep for i in (1, 2, 3))
    assert quality.classify(docs).count() == 6 and quality.classify(docs.limit(0)).count() == 0


def plain_votes(text):
    """The labellers, one by one, over strings."""
    import unicodedata

    words = text.split()
    n = len(words)
    if not n:
        return (2,) * 9
    near = lambda v, good, bad: 1 if v <= good else 0 if v >= bad else 2
    kind = [unicodedata.category(c) for c in text]
    odd = sum(k[0] not in "LNMZC" and not c.isspace() and c not in ".,;:'\"()?!’-" for k, c in zip(kind, text, strict=True))
    letters = sum(k[0] == "L" for k in kind)
    lower = ["".join(x if len(x := c.lower()) == 1 else c for c in w) for w in words]
    same = [a == b for a, b in zip(lower, lower[1:])]
    longest = run = 0
    for s in same:
        run = run + 1 if s else 0
        longest = max(longest, run)
    bare = lambda w: "".join(c for c in w if c not in ".,;:!?")
    most = max(lower.count(w) for w in set(lower))
    ended = sum(w[-1] in ".!?" for w in lower) / n
    return (
        near(odd / len(text), 0.02, 0.08), near(sum(k == "Lu" for k in kind) / letters, 0.2, 0.5) if letters else 2,
        near(most / n, 0.12, 0.25) if n >= 20 else 2, near(sum(same) / n, 0.05, 0.2) if n >= 20 else 2,
        near(-sum(bare(w) in quality.FUNCTION_WORDS for w in lower) / n, -0.08, -0.02) if n >= 20 else 2,
        (1 if 0.01 <= ended <= 0.5 else 0) if n >= 20 else 2,
        1 if 2.5 <= sum(map(len, words)) / n <= 9 else 0,
        near(sum(not any(unicodedata.category(c)[0] in "LN" for c in w) for w in words) / n, 0.02, 0.1),
        near(longest, 2, 6) if n >= 20 else 2,
    )


def test_quality_against_brute_force(spark):
    """Votes over strings, expectation-maximisation over documents, and the posterior of every one."""
    import math

    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows |= {-1: "𝐀𝐁𝐂 𝔞𝔟 word 😀 𐐀𐐁 " * 9, -2: "x" * 9000 + " " + "x" * 8999 + "y", -3: ""}
    votes = {i: plain_votes(t) for i, t in rows.items()}
    assert votes == {i: quality.votes(quality.Words(t)) for i, t in rows.items()}
    p = {i: min(0.95, max(0.05, 1 - v.count(0) / 2)) for i, v in votes.items()}
    for _ in range(200):
        good, bad = sum(p.values()), len(p) - sum(p.values())
        clip = lambda x: min(1 - 1e-3, max(1e-3, x))
        rates = []
        for k in range(9):
            heard = [i for i, v in votes.items() if v[k] != 2]
            yes = [i for i in heard if votes[i][k] == 1]
            rates.append((
                clip((sum(p[i] for i in yes) + 0.9) / (sum(p[i] for i in heard) + 1)), clip((sum(1 - p[i] for i in yes) + 0.5) / (sum(1 - p[i] for i in heard) + 1)),
            ))
        prior, before = clip(good / (good + bad)), p
        p = {}
        for i, v in votes.items():
            a = math.log(prior) + sum(math.log(g if x == 1 else 1 - g) for x, (g, _) in zip(v, rates, strict=True) if x != 2)
            b = math.log(1 - prior) + sum(math.log(h if x == 1 else 1 - h) for x, (_, h) in zip(v, rates, strict=True) if x != 2)
            p[i] = 1 / (1 + math.exp(min(700, max(-700, b - a))))
        if max(abs(p[i] - before[i]) for i in p) < 1e-9:
            break
    got = quality.classify(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    assert len(got) == len(rows) and all(abs(r.posterior - p[r.id]) < 1e-6 for r in got)


def test_long_words_are_hashed_whole():
    a, b = quality.Words("x" * 9000 + "yx"), quality.Words("x" * 9000 + "xy")
    assert a.hashes[0] != b.hashes[0]
    # The hash of a word does not depend on the others.
    assert quality.Words("k " + "x" * 9000).hashes[1] == quality.Words("x" * 9000).hashes[0]


def test_quality_clashing_columns_and_ties(spark):
    rows = [(1, "The same text of plain words.", 9, 0.5, "k")] * 3 + [(2, "The same text of plain words.", 8, 0.1, "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pattern int, score double, number string")
    got = quality.classify(docs).collect()
    assert len(got) == 4 and len({(r.posterior, r.score, r.keep) for r in got}) == 1


# ---- pipeline ----

def least_distance(pattern, text):
    """Least edit distance of the pattern to any part of a text: the plain recurrence, a row at a time."""
    import numpy as np

    codes = np.array([ord(c) for c in text], np.int64)
    row, at = np.zeros(len(codes) + 1, np.int64), np.arange(len(codes) + 1)
    for i, p in enumerate(pattern, 1):
        best = np.minimum(row + 1, i)
        best[1:] = np.minimum(best[1:], row[:-1] + (codes != ord(p)))
        best[0] = i
        row = np.minimum.accumulate(best - at) + at
    return int(row.min())


def test_pipeline_against_brute_force(spark):
    """Every stage by code that shares nothing with it but the learned dictionaries, on its own input."""
    import corpus_pipeline as pipeline
    import public_tokenizers
    import tiktoken
    from array import array

    from tests.llm.test_decontaminate import distance_in
    from tests.llm.test_language import plain_language
    from tests.llm.test_near_dedup import plain_groups
    from tests.llm.test_pii import plain, secrets
    from tiktoken.load import load_tiktoken_bpe

    assert least_distance("kitten", "a sitting cat") == distance_in("kitten", "a sitting cat") == 2
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    assert len(rows) == docs.count()
    known = queries.language_model(docs).dictionaries
    kept = {i: r.text for i, r in rows.items() if not plain_language(known, r.text)[2]}
    groups = plain_groups(kept)
    kept = {i: t for i, t in kept.items() if groups[i] == i}
    normal = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = {normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    assert all(" " in x and int(0.08 * len(x)) > 0 for x in items)
    got = {r.doc_id: r for r in pipeline.run(spark, SF).collect()}
    kept = {i: t for i, t in kept.items() if not any(least_distance(x, normal(t)) <= int(0.08 * len(x)) for x in items)}
    assert got.keys() == kept.keys()
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text in kept.items():
        out, at = "", 0
        spans = [(a, b, kind) for a, _, b, kind in plain(text)] + [(a, b, "secret") for a, b in secrets(text)]
        for start, end, kind in sorted(spans, key=lambda s: s[0]):
            if start >= at:
                out += text[at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        out += text[at:]
        assert got[i].n_chars == len(out)
        assert got[i].decoded_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert got[i].ids_sha256 == hashlib.sha256(array("I", own.encode_ordinary(out)).tobytes()).hexdigest()


def test_stages_return_the_columns_of_documents(spark):
    import corpus_pipeline as pipeline

    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "Hello there, dear friends of mine.", "en", "s", 1), (3, "Hello there, dear friends of mine.", "en", "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).withColumn("rejected", F.lit("extra"))
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == list(pipeline.COLUMNS)
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert pipeline.STAGES[3][1](spark, docs, SF).count() == 4
    assert pipeline.STAGES[4][1](spark, docs, SF).count() == 4
    assert pii.KINDS[:4] == pii.BASE_KINDS
