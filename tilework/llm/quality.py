"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every whole text. The
votes of all documents are counted by pattern (at most 3 ** 9 rows, whatever the
input), and expectation-maximisation over the counts estimates the share of good
documents and each labeller's accuracy on good and on bad ones, without any label.
The posterior of a document's pattern is its soft label. A logistic scorer over
hashed words and word shapes is trained on the posteriors of a bounded sample and
scores every document.

Defined results: null, empty and blank texts get no vote, the prior as posterior,
score 0 and are not kept; repeated rows are scored each; very long texts and words are
read whole; equal votes give equal posteriors, and scores at ``keep_at`` are kept; extra
columns are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch

# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = frozenset(
    "the of and to in is that for it with as was on be by this are from at or an not have"
    " der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an"
    " le la les de et à un une du en que qui dans par pour sur au avec il se ne pas"
    " el los las y que del en una por con para como más su al lo no sus".split()
)
GOOD, BAD, NONE = 1, 0, 2
LABELLERS = (
    "odd_symbols", "capitals", "frequent_word", "runs", "function_words", "sentences", "word_length", "bare_symbols",
    "longest_run",
)


@dataclass(frozen=True)
class QualityParams:
    buckets: int = 8192
    sample_docs: int = 2000  # expected size of the training sample; never over twice as many
    em_rounds: int = 200
    steps: int = 150
    keep_at: float = 0.5


def _vote(value: float, good: float, bad: float) -> int:
    """Good up to ``good``, bad from ``bad``, nothing between."""
    return GOOD if value <= good else BAD if value >= bad else NONE


#: Character classes: white space, neither, lower-case or uncased letter, capital, digit, odd symbol.
SPACE, PLAIN, LETTER, CAPITAL, DIGIT, ODD = range(6)


def _class_of(c: str) -> int:
    kind = unicodedata.category(c)
    if c.isspace():
        return SPACE
    if kind == "Lu":
        return CAPITAL
    if kind[0] == "L":
        return LETTER
    if kind[0] == "N":
        return DIGIT
    return PLAIN if kind[0] in "MZC" or c in ".,;:'\"()?!’-" else ODD


def _lower_of(c: str) -> int:
    return ord(x) if len(x := c.lower()) == 1 else ord(c)


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of each character of the basic plane."""
    plane = [chr(i) for i in range(0x10000)]
    return np.array([_class_of(c) for c in plane], np.uint8), np.array([_lower_of(c) for c in plane], np.uint32)


def _looked_up(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of each character; the few beyond the basic plane one by one."""
    classes, lower = _tables()
    at = np.minimum(codes, 0xFFFF)
    kind, low = classes[at], lower[at]
    beyond = codes > 0xFFFF
    if beyond.any():
        found, which = np.unique(codes[beyond], return_inverse=True)
        kind[beyond] = np.array([_class_of(chr(c)) for c in found], np.uint8)[which]
        low[beyond] = np.array([_lower_of(chr(c)) for c in found], np.uint32)[which]
    return kind, low


_STOPS = np.array([ord(c) for c in ".,;:!?"], np.uint32)


@lru_cache(1)
def _powers() -> np.ndarray:
    """Multipliers of the first 4096 places of a word."""
    return np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))


def _multipliers(place: np.ndarray) -> np.ndarray:
    """The multiplier of each place: a power of one odd number."""
    near = _powers()[place & 4095]
    if place.max() < 4096:
        return near
    steps = np.full(int(place.max() >> 12) + 1, _powers()[-1], np.uint64)
    steps[0] = 1
    return near * np.cumprod(steps)[place >> 12]


def _hashes(codes: np.ndarray, word: np.ndarray, count: int) -> np.ndarray:
    """A 64-bit hash of each word's characters; ``word`` names, in order, the word of each character."""
    out = np.zeros(count, np.uint64)
    if not len(codes):
        return out
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
    terms = (codes.astype(np.uint64) + np.uint64(1)) * _multipliers(place)
    h = np.add.reduceat(terms, starts)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    out[word[starts]] = h ^ (h >> np.uint64(33))
    return out


@lru_cache(1)
def _function_hashes() -> np.ndarray:
    one = lambda w: _hashes(np.array([ord(c) for c in w], np.uint32), np.zeros(len(w), np.int64), 1)
    return np.sort(np.concatenate([one(w) for w in FUNCTION_WORDS]))


class Words:
    """The words of a text (runs without white space) as arrays; no object is made for a word."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
        kind, low = _looked_up(codes)
        self.kinds = np.bincount(kind, minlength=6)
        self.chars = len(codes)
        inside = kind != SPACE
        first = inside & np.concatenate([[True], ~inside[:-1]]) if len(codes) else inside
        self.count = int(first.sum())
        if not self.count:
            return
        word = (np.cumsum(first) - 1)[inside]
        kind, low = kind[inside], low[inside]
        self.length = np.bincount(word, minlength=self.count)
        self.hashes = _hashes(low, word, self.count)
        letter = (kind == LETTER) | (kind == CAPITAL)
        plain = ~np.isin(low, _STOPS)  # "the," is a function word, "the###" is not
        self.functional = np.isin(_hashes(low[plain], word[plain], self.count), _function_hashes())
        self.ended = np.isin(low[np.cumsum(self.length) - 1], (0x2E, 0x21, 0x3F))
        self.bare = np.bincount(word, letter | (kind == DIGIT), self.count) == 0
        # The shape of a word: its characters' classes, symbols as they are, runs cut after two.
        shape = np.where(letter | (kind == DIGIT), kind, low + np.uint32(16))
        new = np.concatenate([[True], (shape[1:] != shape[:-1]) | (word[1:] != word[:-1])])
        place = np.arange(len(shape))
        short = place - np.maximum.accumulate(np.where(new, place, 0)) < 2
        self.shapes = _hashes(shape[short], word[short], self.count)
        self.same = self.hashes[1:] == self.hashes[:-1]


def votes(w: Words) -> tuple:
    """One vote of each labeller, in the order of LABELLERS."""
    n = w.count
    if not n:
        return (NONE,) * len(LABELLERS)
    letters = int(w.kinds[LETTER] + w.kinds[CAPITAL])
    longest = int(np.diff(np.concatenate([[-1], np.flatnonzero(~w.same), [n - 1]])).max()) - 1
    frequent = int(np.unique(w.hashes, return_counts=True)[1].max())
    enough = n >= 20
    return (
        _vote(w.kinds[ODD] / w.chars, 0.02, 0.08),
        _vote(w.kinds[CAPITAL] / letters, 0.2, 0.5) if letters else NONE,
        _vote(frequent / n, 0.12, 0.25) if enough else NONE,
        _vote(w.same.sum() / n, 0.05, 0.2) if enough else NONE,
        _vote(-w.functional.mean(), -0.08, -0.02) if enough else NONE,
        (GOOD if 0.01 <= w.ended.mean() <= 0.5 else BAD) if enough else NONE,
        GOOD if 2.5 <= w.length.mean() <= 9 else BAD,
        _vote(w.bare.mean(), 0.02, 0.1),
        _vote(longest, 2, 6) if enough else NONE,
    )


def features(w: Words, buckets: int) -> np.ndarray:
    """Counts of word and shape buckets; bucket 0 also counts words that repeat the one before."""
    salted = np.concatenate([w.hashes, w.shapes * np.uint64(0xC4CEB9FE1A85EC53)]) >> np.uint64(20)
    counts = np.bincount((salted % np.uint64(buckets)).astype(np.int64), minlength=buckets)
    counts[0] += int(w.same.sum())
    return counts


def pattern_of(vote: tuple) -> int:
    return sum(v * 3**i for i, v in enumerate(vote))


def votes_of(pattern: int) -> list[int]:
    return [pattern // 3**i % 3 for i in range(len(LABELLERS))]


@dataclass(frozen=True)
class LabelModel:
    prior: float  # share of good documents
    on_good: np.ndarray  # P(votes good | good) of each labeller
    on_bad: np.ndarray  # P(votes good | bad)

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        """P(good | votes); labellers are independent given the class, abstentions say nothing."""
        v = np.asarray(pattern)[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
        good = np.log(self.prior) + (np.where(v == GOOD, np.log(self.on_good), np.where(v == BAD, np.log1p(-self.on_good), 0))).sum(1)
        bad = np.log1p(-self.prior) + (np.where(v == GOOD, np.log(self.on_bad), np.where(v == BAD, np.log1p(-self.on_bad), 0))).sum(1)
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def fit_labels(counts: dict[int, int], rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over vote patterns and how often they occur."""
    size = len(LABELLERS)
    if not counts:
        return LabelModel(0.5, np.full(size, 0.7), np.full(size, 0.3))
    v = np.array([votes_of(p) for p in counts])
    n = np.array(list(counts.values()), float)
    says, heard = v == GOOD, v != NONE
    # Start: a document is bad as far as more than one labeller says so.
    p = np.clip(1 - (v == BAD).sum(1) / 2.0, 0.05, 0.95)
    model = None
    for _ in range(rounds):
        w, u = n * p, n * (1 - p)
        # One pseudo-document on each side keeps every estimate inside (0, 1).
        on_good = ((w[:, None] * says).sum(0) + 0.9) / ((w[:, None] * heard).sum(0) + 1)
        on_bad = ((u[:, None] * says).sum(0) + 0.5) / ((u[:, None] * heard).sum(0) + 1)
        model = LabelModel(float(np.clip(w.sum() / n.sum(), 1e-3, 1 - 1e-3)), np.clip(on_good, 1e-3, 1 - 1e-3), np.clip(on_bad, 1e-3, 1 - 1e-3))
        after = model.posterior(np.array(list(counts)))
        if np.abs(after - p).max() < 1e-9:
            break
        p = after
    return model


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, buckets: int, steps: int) -> np.ndarray:
    """Logistic regression on soft labels by full-batch Adagrad; the last weight is the bias."""
    weights = np.zeros(buckets + 1)
    if not rows:
        return weights
    number = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    past = np.full(buckets + 1, 1e-8)
    for _ in range(steps):
        z = np.bincount(owner, weights[number] * value, len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / len(rows)
        slope = np.bincount(number, error[owner] * value, buckets + 1)
        slope[-1] = error.sum()
        slope[:-1] += 1e-5 * weights[:-1]
        past += slope**2
        weights -= 0.5 * slope / np.sqrt(past)
    return weights


def _read(buckets: int):
    """One pass over the texts: the pattern of votes, and the numbers and values of the features (none without words)."""

    def run(batches):
        for batch in batches:
            patterns, numbers, values = [], [], []
            for x in batch.column(1):
                w = Words(x.as_py() or "")
                patterns.append(pattern_of(votes(w)))
                counts = features(w, buckets) if w.count else np.zeros(1, np.int64)
                at = np.flatnonzero(counts)
                numbers.append(at.astype("<u2").tobytes())
                values.append(np.sqrt(counts[at] / max(1, counts.sum())).astype("<f2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(patterns, pa.int32()), pa.array(numbers, pa.binary()), pa.array(values, pa.binary())],
                names=["id", "pattern", "number", "value"],
            )

    return run


def _unpack(number: bytes, value: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(number, "<u2").astype(np.int64), np.frombuffer(value, "<f2").astype(float)


def _score(weights: np.ndarray, labels: LabelModel, params: QualityParams):
    def run(batches):
        posterior = labels.posterior(np.arange(3 ** len(LABELLERS)))
        for batch in batches:
            s = []
            for number, value in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                at, x = _unpack(number, value)
                s.append(float(1 / (1 + np.exp(-np.clip(x @ weights[at] + weights[-1], -50, 50)))) if len(at) else 0.0)
            p = posterior[batch.column(1).to_numpy()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p, pa.float64()), pa.array(s, pa.float64()), pa.array([v >= params.keep_at for v in s], pa.bool_())],
                names=["id", "posterior", "score", "keep"],
            )

    return run


def classify(docs: DataFrame, params: QualityParams = QualityParams(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, posterior, score, keep`` for every row.

    The texts are read once; patterns and packed features (about a third of the input)
    are written to the shared folder, counted, sampled from and scored.
    """
    if params.buckets > 1 << 16:
        raise ValueError("feature numbers are packed into 16 bits")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(_read(params.buckets), f"id {kind}, pattern int, number binary, value binary")
    read = Scratch(docs.sparkSession, "quality").save(made)
    counts = {r.pattern: r["n"] for r in read.groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    labels = fit_labels(counts, params.em_rounds)
    total = max(1, sum(counts.values()))
    unit = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("quality")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = read.where((unit < params.sample_docs / total) & (F.octet_length("number") > 0))
    if picked.select("id").count() > 2 * params.sample_docs:  # an id that fills the sample with its repetitions
        picked = picked.limit(2 * params.sample_docs)
    sample = picked.select("pattern", "number", "value").collect()
    target = labels.posterior(np.array([r.pattern for r in sample])) if sample else np.empty(0)
    weights = fit_scorer([_unpack(r.number, r.value) for r in sample], target, params.buckets, params.steps)
    return read.mapInArrow(_score(weights, labels, params), f"id {kind}, posterior double, score double, keep boolean")
