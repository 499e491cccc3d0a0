"""Personal data against the plain patterns in Python."""

import datetime
import hashlib
import re
import time

import pytest

from tilework.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for rank, kind in enumerate(PLAIN):
        for m in re.finditer(PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


KEY = r"[A-Za-z0-9_+/-]{20,}={0,2}"


def secrets(text):
    """Keys beside a word that says so, in plain Python: (start, end)."""
    found = list(re.finditer(KEY, text))
    out = []
    for k, m in enumerate(found):
        low = found[k - 2].end() if k > 1 else 0
        high = found[k + 2].start() if k + 2 < len(found) else len(text)
        beside = (text[max(low, m.start() - 40) : m.start()] + "\n" + text[m.end() : min(high, m.end() + 40)]).lower()
        mixed = re.search(r"[0-9][_+/-]*[A-Za-z][A-Za-z_+/-]*[0-9]", m.group()) and len(re.sub("[^0-9]", "", m.group())) >= 4
        if mixed and re.search("token|secret|passw|api.?key|credential|bearer|private.?key|access.?key", beside):
            out.append((m.start(), m.end()))
    return out


HARD = [
    "", "a@b.c_d@e.f", "x.y@z@q.r é@x.y", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.1 1.2.3", "4111 1111-1111 1111", "4111  1111 1111 1111",
    "😀 4111111111111111 😀 a@b.co", "+49 (0) 123 456 7890 +1+22 333 444 5555", "+1 (974) 555-3436", "+1.2.3.4.5.6.7.8.9.0",
    "a@b.c" * 50, "1" * 30, "+" * 20 + "1" * 12, "4242424242424242@x.y 1.1.1.1@x.y", "a@b.c\nd@e.f\r\n", "%@-.-", "12 34 56 78 90 12 34 56 78",
]


@pytest.mark.parametrize("source", ["hard", "table"])
def test_base_spans(spark, source):
    if source == "hard":
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)] + [(-1, None)], "doc_id long, text string")
    else:
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for r in pii.find(docs, keep=["doc_id"]).collect():
        assert [(s.start, s.rank, s.end, s.kind) for s in r.spans if s.kind in PLAIN] == plain(r.text), r.text[:100]


def test_long_runs_take_neither_stack_nor_square_time(spark):
    text = "a" * 200_000 + " " + "1" * 200_000 + " " + "1 " * 100_000 + "1.1." * 50_000 + "a@" * 50_000 + "A1" * 50_000
    got = pii.find(spark.createDataFrame([(text,)], "text string")).first()
    assert sum(s.kind == "ip" for s in got.spans) == 25_000


def test_spans_and_redaction_take_linear_time(spark):
    def seconds(n):
        docs = spark.createDataFrame([("a@b.co " * n,)], "text string")
        start = time.perf_counter()
        row = pii.find(docs).select("spans", pii.redact("text", "spans").alias("r")).first()
        assert len(row.spans) == n and row.r == "[EMAIL] " * n
        return time.perf_counter() - start

    seconds(10)
    # A quadratic form took 40 s for 16,000 and four times as long for twice as many.
    assert seconds(64_000) < 2.5 * seconds(32_000) + 2


def test_an_iban_beside_capitals(spark):
    texts = [
        "DE89 3704 0044 0532 0130 00 BIC COBADEFF", "DE89 3704 0044 0532 0130 00 IS MINE", "DE89370400440532013000GB82WEST12345698765432",
        "DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32", "XX89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 0",
    ]
    got = pii.find(spark.createDataFrame(list(enumerate(texts)), "k int, text string")).collect()
    assert [[(s.start, s.end) for s in r.spans if s.kind == "iban"] for r in sorted(got, key=lambda r: r.row.k)] == [
        [(0, 27)], [(0, 27)], [], [(0, 27), (28, 55)], [], [],
    ]


def test_context_decides(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    cases = {
        "call (974) 555-3436": ["local_phone"], "room (974) 555-3436": [], "(974) 555-3436 is my mobile": ["local_phone"],
        "born 28.02.1999": ["birth_date"], "due 28.02.1999": [], "born 31.02.1999": [], "born 1996-02-29": ["birth_date"], "born 1900-02-29": [],
        f'token = "{key}"': ["secret"], f"commit {key}": [], "token some-very-long-dashed-word-here": [],
        "token " + "x" * 41 + " q " * 14 + key: [],
    }
    got = pii.find(spark.createDataFrame([(t,) for t in cases], "text string")).collect()
    assert {r.text: [s.kind for s in r.spans] for r in got} == cases
    assert all(s.score >= 0.5 for r in got for s in r.spans)
    strict = pii.find(spark.createDataFrame([(t,) for t in cases], "text string"), pii.PiiParams(context_gain=0.0)).collect()
    assert not any(r.spans for r in strict)


def test_context_reaches_past_a_span_of_the_same_kind(spark):
    got = pii.find(spark.createDataFrame([("phone +1 (974) 555-3436, +1 (974) 555-3437",)], "text string")).first()
    assert [round(s.score, 2) for s in got.spans if s.kind == "phone"] == [0.75, 0.75]


def test_dates_of_any_day(spark):
    days = [datetime.date(1999, 12, 25) + datetime.timedelta(17 * k) for k in range(300)]
    texts = [f"born {d.day}/{d.month}/{d.year}" for d in days] + [f"born {d.isoformat()}" for d in days]
    assert all(len(r.spans) == 1 for r in pii.find(spark.createDataFrame([(t,) for t in texts], "text string")).collect())


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(none).select(pii.redact("text", "spans").alias("r")).count() == 0


def test_pieces_of_long_texts(spark):
    from pyspark.sql import functions as F
    from tilework.llm import cuts

    text = "".join(chr(97 + i % 26) if i % 7 else "😀" for i in range(5000))
    places = [(0, 0), (0, 5000), (1023, 1024), (1024, 2048), (1000, 3100), (4999, 5000), (2047, 2049)]
    docs = spark.createDataFrame([(text, a, b) for a, b in places], "text string, a int, b int")
    got = docs.select("a", "b", F.expr(cuts.let("c", cuts.chunks("text"), cuts.between("c", "a", "b"))).alias("x")).collect()
    assert all(r.x == text[r.a : r.b] for r in got)
    for n in (0, 1, 2, 3, 15, 16, 17, 100):
        row = spark.range(1).select(F.expr(f"transform(slice(sequence(1, {n} + 1), 1, {n}), x -> cast(x as int))").alias("v"))
        assert row.select(F.expr(cuts.running("v", "a + b", "0")).alias("r")).first().r == [k * (k + 1) // 2 for k in range(n + 1)]
        assert row.select(F.expr(cuts.running("v", "greatest(a, b)", "0")).alias("r")).first().r == list(range(n + 1))


def test_iban_and_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 bank", "DE88 3704 0044 0532 0130 00", "my phone +49 123 456 7890", "xx +49 123 456 7890", "GB82WEST12345698765432"]
    got = pii.find(spark.createDataFrame(list(enumerate(texts)), "k int, text string")).collect()
    kinds = [[s.kind for s in r.spans if s.kind == "iban"] for r in got]
    assert kinds == [["iban"], [], [], [], ["iban"]]
    score = {r.row.k: r.spans[0].score for r in got if r.spans}
    assert score[2] > score[3] and score[0] > score[4]


def test_redaction(spark):
    texts = ["mail a@b.co now", "+1 (974) 555-3436", "none", "1.2.3.4 5.6.7.8", "+4111111111111111 x"]
    rows = pii.find(spark.createDataFrame([(t,) for t in texts], "text string")).select(pii.redact("text", "spans").alias("r")).collect()
    assert [r.r for r in rows][:4] == ["mail [EMAIL] now", "[PHONE]", "none", "[IP] [IP]"]
    assert "4111" not in rows[4].r


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_query_columns(spark, size):
    got = queries.op8_pii(spark, f"/root/testdata/sf{size}").collect()
    texts = dict(spark.read.parquet(f"/root/testdata/sf{size}/documents.parquet").select("doc_id", "text").collect())
    for r in got:
        spans = plain(texts[r.doc_id] or "")
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in PLAIN]
        # What the method adds: keys beside a word that names them. Everything else is as listed.
        assert ",".join(x for x in r.spans.split(",") if not x.startswith("secret:")) == listed
        assert [x for x in r.spans.split(",") if x.startswith("secret:")] == [f"secret:{a}:{b}" for a, b in secrets(texts[r.doc_id] or "")]
        assert r.n_added == len(secrets(texts[r.doc_id] or "")) and (r.score > 0) == bool(r.spans)


def test_it_is_native(spark, sf):
    plan = queries.op8_pii(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a@b.co", 7)], "spans int, text string, row int")
    got = pii.find(docs).first()
    assert (got.row.spans, got.row.row, len(got.spans)) == (1, 7, 1)
