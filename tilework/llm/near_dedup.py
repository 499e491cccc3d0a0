"""Near-duplicate detection with ProbMinHash signatures.

A text becomes the multiset of its word shingles; a shingle's weight is its count.
Two texts are alike to the degree of their probability Jaccard similarity

    J_P(a, b) = sum over d of 1 / sum over e of max(a_e / a_d, b_e / b_d),

which is the ordinary Jaccard similarity where all weights are equal, and does not
change when a text is repeated as a whole. Signatures come from Poisson arrivals:
each shingle emits points at a rate equal to its weight, each point falls into a
random register, a register keeps its earliest point, and a shingle stops as soon
as its next point is later than the latest register. Registers agree with
probability J_P.

A pair is a link if its J_P, or the ordinary Jaccard similarity of its shingle sets,
reaches the threshold. Each has signatures of its own: a text of uneven counts gets a
second one, with all weights 1, and the bands of both (with even counts the two are equal).

Plan, in order of size:

1. one pass over the texts: a 128-bit digest of the normalised words, and band keys;
2. exact classes: rows with equal digests collapse before anything is compared
   (partial aggregation, so thousands of copies send one row a task);
3. bands of the class representatives meet in buckets. A bucket is never expanded
   into all its pairs. Its members are verified against one anchor, first the member
   that shares most buckets with others (in a family of copies that is one close to
   the original), then another one; connected components are formed after each
   round, and only buckets that still hold several components go on. Buckets of more
   than a 10,000th of all band keys (there are at most 10,000 of those) meet what belongs
   to them by broadcast, so no task reads a whole family; the others are shuffled;
4. buckets of at most ``small`` members are finished by their remaining pairs, which
   is linear in the members;
5. larger ones are finished without enumerating them, through the differences of
   their members from the anchor (see ``_differences``): members that are alike but
   not both linked to the anchor must share many of the shingles in which they differ
   from it, so they meet in an equi-join on a short prefix of those, the shingles that
   few members have coming first: what many have in common (a passage, a template)
   brings two members together only if they may share enough beside it;
6. verification computes the similarity from both whole texts. The pairs of a text that
   many others are verified against are dealt out in ``chunks``, each with a copy of it.

Families of near-copies thus cost their members times the bands, not their square.
Steps 4 and 5 lose no link of a bucket. Step 5 tests every pair of different components
that its bounds leave; a family whose members are all just short of a link still has the
square of them. Among members of uneven counts those are pairs that together hold no more
beside the anchor than a link allows, and whose distances to it differ by no more.

Defined results: null text counts as empty. Texts without a word have one class for
each distinct text. Texts with fewer words than a shingle are one shingle. A class
is named by its least id, nulls last; rows that repeat an id and a text are one
member each; ties between anchors go to the greater digest; very long texts are read
whole; an empty table gives an empty result. Extra columns are not read, whatever their
names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from .graph import components
from .scratch import Scratch

_WORD = regex.compile(r"\w+")
_ONE = np.uint64(1)


@dataclass(frozen=True)
class NearParams:
    words: int = 5
    similarity: float = 0.8
    registers: int = 160
    band: int = 5  # registers a band; at 0.8 a pair shares no band with probability (1 - 0.8 ** 5) ** 32 = 3e-6
    anchor_rounds: int = 2
    small: int = 8
    hot_share: int = 10_000  # a key with more than one in so many of all band rows is hot; at most so many keys are
    chunks: int = 8  # so many copies of a text at most go to the pairs it is the first of
    seed: int = 7

    @property
    def bands(self) -> int:
        return self.registers // self.band


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def shingles(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes and their counts."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.float64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(n, len(h))
    acc = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    found, counts = np.unique(acc, return_counts=True)
    return found, counts.astype(np.float64)


def _mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int, seed: int) -> np.ndarray:
    """ProbMinHash signatures, one row a set; all sets advance together, one arrival of each element a round."""
    count = len(sets)
    out = np.zeros((count, m), np.uint64)
    owner = np.repeat(np.arange(count), [len(s[0]) for s in sets])
    if not len(owner):
        return out
    element = np.concatenate([s[0] for s in sets])
    rate = np.concatenate([s[1] for s in sets])
    earliest = np.full(count * m, np.inf)
    flat = out.reshape(-1)
    at = np.zeros(len(element))
    state = _mix(element ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    latest = np.full(count, np.inf)
    round_ = 0
    while len(element):
        state = _mix(state + np.uint64(0x9E3779B97F4A7C15))
        uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        at = at - np.log(uniform) / rate
        go = at < latest[owner]
        if not go.all():
            element, rate, at, owner, state = element[go], rate[go], at[go], owner[go], state[go]
            if not len(element):
                break
        register = (_mix(state ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(m)).astype(np.int64) + owner * m
        before = earliest[register]
        better = at < before
        if better.any():
            slot, when, what = register[better], at[better], element[better]
            np.minimum.at(earliest, slot, when)
            won = earliest[slot] == when
            flat[slot[won]] = what[won]
        round_ += 1
        if round_ < 4 or round_ % 8 == 0:
            latest = earliest.reshape(count, m).max(axis=1)
    return out


def band_keys(sig: np.ndarray, band: int) -> np.ndarray:
    count, m = sig.shape
    bands = m // band
    cut = sig[:, : bands * band].reshape(count, bands, band)
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (count, bands)).copy()
    for i in range(band):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, i])
    return acc.view(np.int64)


def probability_jaccard(a: tuple, b: tuple) -> float:
    """Exact J_P of two (hashes, weights) multisets; equal weight pairs are handled together."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    keys = np.union1d(a[0], b[0])
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a[0])] = a[1]
    y[np.searchsorted(keys, b[0])] = b[1]
    pairs, many = np.unique(np.stack([x, y]), axis=1, return_counts=True)
    total = 0.0
    for (p, q), n in zip(pairs.T, many, strict=True):
        if p and q:
            total += n / float((np.maximum(pairs[0] / p, pairs[1] / q) * many).sum())
    return float(total)


def _digest(text: str, words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words) if words else "\0" + text)


def _sketch(params: NearParams):
    def run(batches):
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column(1)]
            digests, keys, short = [], [], []
            for i in range(0, len(texts), 256):
                sets = []
                for t in texts[i : i + 256]:
                    words = words_of(t)
                    digests.append(_digest(t, words))
                    sets.append(shingles(words, params.words))
                bands = band_keys(signatures(sets, params.registers, params.seed), params.band)
                own = [row.tolist() if len(s[0]) else [] for row, s in zip(bands, sets, strict=True)]
                odd = [j for j, s in enumerate(sets) if uneven(s)]
                even = [(sets[j][0], np.ones(len(sets[j][0]))) for j in odd]
                for j, row in zip(odd, band_keys(signatures(even, params.registers, params.seed), params.band), strict=True):
                    own[j] = list(dict.fromkeys(own[j] + row.tolist()))
                keys += own
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "raw", "digest", "bands"],
            )

    return run


def uneven(a: tuple) -> bool:
    """Whether the shingles of a text have different counts; J_P of two texts without is their Jaccard similarity."""
    return len(a[1]) > 0 and a[1].min() != a[1].max()


def similarity(a: tuple, b: tuple) -> float:
    """The larger of J_P and the Jaccard similarity of the shingle sets."""
    both = len(np.intersect1d(a[0], b[0], assume_unique=True))
    plain = both / max(1, len(a[0]) + len(b[0]) - both)
    if a[1].max(initial=1) == 1 and b[1].max(initial=1) == 1 and len(a[0]) and len(b[0]):
        return plain  # equal weights: the two are the same
    return max(plain, probability_jaccard(a, b))


def _pairs(params: NearParams, row, names, kinds):
    """Run ``row(a, b, shingles of a, shingles of b)`` on pairs with texts; the anchor's shingles are kept between rows."""

    def run(batches):
        last, anchor = None, None
        for batch in batches:
            a, b, ta, tb, *more = (column.to_pylist() for column in batch.columns)
            out = []
            for i in range(len(a)):
                if a[i] != last:
                    last, anchor = a[i], shingles(words_of(ta[i]), params.words)
                out += row(a[i], b[i], anchor, shingles(words_of(tb[i]), params.words), *(m[i] for m in more))
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _verify(params: NearParams):
    def row(a, b, x, y):
        s = similarity(x, y)
        return [(a, b, s)] if s >= params.similarity else []

    return _pairs(params, row, ["a", "b", "similarity"], [pa.binary(), pa.binary(), pa.float64()])


DIFFERENCES = (
    "a binary, b binary, label binary, kind tinyint, token bigint, size int, words int, need int, like int,"
    " uneven boolean, distance double, beside double, weight double"
)
#: Roles of a difference shingle: of a member linked to the anchor, of one that is not, and of one against its like.
LINKED, OTHER, OTHERS = 0, 1, 2
#: Kinds of row: a shingle in which a member differs from the anchor (LINKED or OTHER; with a weight where it is beside
#: the anchor), and, for pairs with uneven counts, a member with little beside the anchor.
NEAR = 3


def difference_prefixes(p: np.ndarray, x: np.ndarray, threshold: float) -> tuple[int, list[tuple[int, np.ndarray]]]:
    """How many shingles differ, and (role, shingles) under which a member x of the anchor p's buckets is filed.

    Let t be the threshold, c = (1 - t) / (1 + t), and Dx the shingles in exactly one of
    p and x. Jaccard(x, y) >= t means |Dx ^ Dy| <= c (|x| + |y|), so x and y share

        s >= (|Dx| + |Dy| - c (|x| + |y|)) / 2

    of their differences. If y is not linked to p, |Dy| > c (|y| + |p|), hence
    s > (|Dx| + c (|p| - |x|)) / 2; and if neither is, s > c |p|. From y's side, as
    s <= |Dx| and |x| <= |y| / t, s >= |Dy| - c |y| (1 + 1 / t). Two sets that share s
    elements share one among the first (size - s + 1) of each in any common order; here
    shingles that p lacks come first, since few members have them.
    """
    c = (1 - threshold) / (1 + threshold)
    extra, missing = np.setdiff1d(x, p, assume_unique=True), np.setdiff1d(p, x, assume_unique=True)
    order = np.concatenate([extra, _mix(missing)])  # mixed: a missing shingle is not the same as an extra one
    size = len(order)
    if size <= c * (len(x) + len(p)) + 1e-9:
        least = int(np.floor((size + c * (len(p) - len(x))) / 2 - 1e-9)) + 1
        return size, [(LINKED, order[: max(0, size - max(1, least) + 1)])]
    own = int(np.ceil(size - c * len(x) * (1 + 1 / threshold) - 1e-9))
    like = max(own, int(np.floor(c * len(p) - 1e-9)) + 1)
    return size, [(OTHER, order[: max(0, size - max(1, own) + 1)]), (OTHERS, order[: max(0, size - max(1, like) + 1)])]


def beside_anchor(p: tuple, x: tuple) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Distance 1 - J_P of x and the anchor p, x's share of weight beside p, and its shingles there with their weights.

    Let weights sum to one. As sum over e of max(x_e / x_d, y_e / y_d) is at least
    max(1 / x_d, 1 / y_d), J_P(x, y) <= sum over d of min(x_d, y_d). Let bx be the weight
    of x on shingles that p lacks. If J_P(x, y) >= t, then, as x and y share at most
    min(1 - bx, 1 - by) on p's shingles, they share beside p

        s >= max(bx, by) - (1 - t).

    Both shares count at once: a sample of x is the shingle d with the earliest of arrivals
    E_d / x_d. Let u and v be the weights of x and y on shingles that the other lacks. The
    samples can agree only if the common shingles arrive first in both, at Cx ~ Exp(1 - u)
    and Cy ~ Exp(1 - v). The rest are independent of those and of each other, so that has
    the probability E exp(-u Cx - v Cy), which is largest where Cx and Cy rise together:

        J_P(x, y) <= 1 / (1 + odds(u) + odds(v)),  odds(u) = u / (1 - u).

    So odds(bx) + odds(by) <= 1 / t - 1, or they meet in their first common shingle beside
    p, in any common order. With it and behind it x has a weight of ``rest``, so u is at
    least bx - rest, which must satisfy the same. Rare shingles come first (see
    ``rare_first``). In the first case the pair meets by the anchor itself. Since J_P is the
    probability that two samples agree, 1 - J_P is a metric, and the distances of x and y to
    p differ by at most 1 - t; and one of them is not linked to p.
    """
    extra = ~np.isin(x[0], p[0], assume_unique=True)
    weight = x[1][extra] / x[1].sum()
    return 1 - probability_jaccard(p, x), float(weight.sum()), x[0][extra], weight


def _differences(params: NearParams):
    def row(a, b, x, y, label):
        size, found = difference_prefixes(x[0], y[0], params.similarity)
        # A prefix of n of size shingles stands for size - n + 1 that must be shared.
        (kind, prefix), *other = found
        need = size - len(prefix) + 1
        like = size - len(other[0][1]) + 1 if other else None
        odd = uneven(y)
        distance, beside, extra, weights = beside_anchor(x, y)
        tokens = list(zip(extra.view(np.int64).tolist(), weights.tolist(), strict=True))
        if min(need, like or need) <= size:
            # Mixed: a missing shingle is not the same as an extra one.
            tokens += [(t, None) for t in _mix(np.setdiff1d(x[0], y[0], assume_unique=True)).view(np.int64).tolist()]
        else:  # it shares too little with any that it is not in one component with
            need = like = None
        rows = [(a, b, label, kind, t, size, len(y[0]), need, like, odd, distance, beside, w) for t, w in tokens]
        if beside <= 1 - params.similarity + 1e-9:
            rows.append((a, b, label, NEAR, 0, None, None, None, None, odd, distance, beside, None))
        return rows

    names = ["a", "b", "label", "kind", "token", "size", "words", "need", "like", "uneven", "distance", "beside", "weight"]
    kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int8(), pa.int64(), *[pa.int32()] * 4]
    return _pairs(params, row, names, [*kinds, pa.bool_(), pa.float64(), pa.float64(), pa.float64()])


def shared_shingles(filed: DataFrame, wanted: str) -> DataFrame:
    """The rows whose shingle several members of the anchor have, one of them ``wanted``, with ``n``: how many have it."""
    own = W.partitionBy("a", "token")
    counted = filed.withColumn("n", F.count("*").over(own)).withColumn("any", F.max(F.expr(wanted)).over(own))
    return counted.where("n > 1 and any").drop("any")


def rare_differences(filed: DataFrame) -> DataFrame:
    """Difference rows under which members must be filed, with ``left``: how many of a member's are left from this one on.

    Shingles come in the order of how many members of the anchor have them, rare ones
    first. Those of one member alone, or of linked members only, make no pair, so they are
    left out before the rest are counted: what a pair shares is among those that stay.
    """
    kept = shared_shingles(filed, f"kind = {OTHER}")
    behind = W.partitionBy("a", "b").orderBy(F.desc("n"), F.desc("token")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return kept.withColumn("left", F.count("*").over(behind)).where("left >= least(need, coalesce(like, need))")


def _may_share_enough(threshold: float) -> str:
    """Whether a meeting with ``left`` and ``yleft`` to go can be the first of as many as the pair must share.

    Of two members one at least is not linked to the anchor, or they are in one component.
    The differences of x and y share no more than what is left on either side; they must
    share (size + ysize - c (words + ywords)) / 2.
    """
    c = (1 - threshold) / (1 + threshold)
    one_linked = "left >= need and yleft >= yneed"
    none_linked = "left >= like and yleft >= ylike"
    kinds = f"(kind <> ykind and {one_linked} or kind = {OTHER} and ykind = {OTHER} and b < yb and {none_linked})"
    return f"{kinds} and 2 * least(left, yleft) >= size + ysize - {c!r}D * (words + ywords) - 1e-9D"


def rare_first(beside: DataFrame, threshold: float) -> DataFrame:
    """The rows beside the anchor under which members must be filed, with ``rest``: the weight from the shingle on, rare ones first.

    Shingles of one member, or of even ones only, make no pair; they come first or do
    not count, so they may go before the rests are summed.
    """
    kept = shared_shingles(beside, "uneven")
    behind = W.partitionBy("a", "b").orderBy(F.desc("n"), F.desc("token")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return kept.withColumn("rest", F.sum("weight").over(behind)).where(f"rest >= beside - {1 - threshold!r}D - 1e-9D")


def near_anchor(near: DataFrame, threshold: float) -> DataFrame:
    """The NEAR rows that may make a pair by the anchor: with a member of uneven counts, and with one not linked to it."""
    odds = "beside / (1 - beside)"
    far = F.min(F.expr(f"case when distance > {1 - threshold!r}D - 1e-9D then {odds} end")).alias("far")
    anchors = near.groupBy("a").agg(far, F.max("uneven").alias("any")).where("any and far is not null").drop("any")
    least = f"distance > {1 - threshold!r}D - 1e-9D or {odds} + far <= {1 / threshold - 1!r}D + 1e-9D"
    return near.join(anchors, "a").where(least).drop("far")


def _may_be_alike(threshold: float, near: bool) -> str:
    """The conditions of ``beside_anchor`` on a meeting by the anchor, or in a shingle beside it."""
    most = f"{1 / threshold - 1!r}D"
    far = f"abs(distance - ydistance) <= {1 - threshold!r}D + 1e-9D and greatest(distance, ydistance) > {1 - threshold!r}D - 1e-9D"
    if near:
        return f"{far} and beside / (1 - beside) + ybeside / (1 - ybeside) <= {most} + 1e-9D"
    # Multiplied out: a member may share nothing with the anchor. Its rows have beside - rest <= 1 - threshold.
    by_token = f"beside * (1 - ybeside) + ybeside * (1 - beside) >= {most} * (1 - beside) * (1 - ybeside) - 1e-9D"
    u, v = "greatest(0D, beside - rest)", "greatest(0D, ybeside - yrest)"
    return f"{far} and {by_token} and {u} / (1 - {u}) + {v} / (1 - {v}) <= {most} + 1e-9D"


def meetings(filed: DataFrame, params: NearParams, scratch: Scratch) -> DataFrame:
    """``a, b``: pairs of members of different components that may be alike, from the rows of ``_differences``."""

    def paired(own: DataFrame, left: str, condition: str) -> DataFrame:
        other = own.select("a", "token", *[F.col(x).alias(f"y{x}") for x in own.columns[2:]])
        met = own.where(left).join(other, ["a", "token"]).where(f"label <> ylabel and {condition}")
        return met.select(F.col("b").alias("a"), F.col("yb").alias("b"))

    own = rare_differences(filed.where(f"kind <> {NEAR} and need is not null"))
    own = scratch.save(own.select("a", "token", "b", "label", "kind", "size", "words", "need", "like", "left"))
    out = paired(own, f"kind = {OTHER}", _may_share_enough(params.similarity))
    # A member of uneven counts with any other: by a shingle beside the anchor, or by the anchor itself.
    beside = scratch.save(rare_first(filed.where("weight is not null"), params.similarity))
    for near, own in ((False, beside), (True, near_anchor(filed.where(F.col("kind") == NEAR), params.similarity).withColumn("rest", F.lit(1.0)))):
        own = own.select("a", "token", "b", "label", "uneven", "distance", "beside", "rest")
        out = out.unionByName(paired(own, "uneven", f"(b < yb or not yuneven) and {_may_be_alike(params.similarity, near)}"))
    return out


def near_duplicates(
    docs: DataFrame, params: NearParams = NearParams(), *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, raw, digest, class_id, group_id, group, copies, verified_links`` for every row.

    ``class_id`` is the least id among rows with the same normalised words,
    ``group_id`` the least id of the connected group of near-duplicate classes,
    ``group`` the group's own digest (ids may repeat), ``copies`` the rows of the class,
    ``verified_links`` the links of the class that were verified to form the groups (not
    all it has: pairs inside a settled group are not tested), ``raw`` a hash of the row's text.
    """
    scratch = Scratch(docs.sparkSession, "near")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("raw"))
    kind = rows.schema["id"].dataType.simpleString()
    sketched = scratch.save(rows.mapInArrow(_sketch(params), f"id {kind}, raw bigint, digest binary, bands array<bigint>"))
    sketches = scratch.last
    # Equal digests have equal bands, so any row's will do; copies collapse before the exchange.
    # Null ids come last, so that a class is named by an id if it has one.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "raw")).alias("first")
    classes = scratch.save(
        sketched.groupBy("digest")
        .agg(first, F.count("*").alias("copies"), F.first("bands").alias("bands"))
        .select("digest", F.col("first.id").alias("class_id"), F.col("first.raw").alias("raw"), "copies", "bands")
    )
    keys = classes.select("digest", F.explode("bands").alias("key"))
    shared = scratch.save(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    # All band rows are at least the shared ones; so there are at most hot_share keys above the bound.
    bound = (shared.agg(F.sum("n")).first()[0] or 0) / params.hot_share
    shared = shared.withColumn("hot", F.col("n") > max(bound, params.small))
    hot = shared.where("hot").select("key", "n", "hot")
    marked = keys.join(F.broadcast(hot), "key", "left")
    cold = marked.where("hot is null").select("key", "digest").join(shared.where("not hot"), "key")
    buckets = scratch.save(cold.select("key", "digest", "n", "hot").unionByName(marked.where("hot").select("key", "digest", "n", "hot")))

    def by_key(members: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
        """Members with one row for their key: hot keys, which are few, by broadcast, so that no task gets a whole family."""
        own, few = members.where("not hot"), found.where("hot").drop("hot")
        return own.join(found.where("not hot").drop("hot"), "key", how).unionByName(members.where("hot").join(F.broadcast(few), "key", how))

    # How many meetings a class has: in a family of copies most for those close to the original.
    central = scratch.save(buckets.groupBy("digest").agg(F.sum("n").alias("met")))
    wanted = classes.join(central, "digest", "left_semi").select(F.col("class_id").alias("id_"), F.col("raw").alias("raw_"), "digest")
    texts = scratch.save(
        rows.join(wanted, F.col("id").eqNullSafe(F.col("id_")) & (F.col("raw") == F.col("raw_")))
        .select("digest", "text")
        .dropDuplicates(["digest"])
    )

    def with_texts(pairs: DataFrame, *more: str) -> DataFrame:
        """Pairs with both texts; the pairs of one ``a`` are dealt out in ``chunks``, each with a copy of its text."""
        dealt = pairs.withColumn("chunk", F.pmod(F.xxhash64("b"), F.lit(params.chunks)))
        left = dealt.select("a", "chunk").distinct().join(texts.select(F.col("digest").alias("a"), F.col("text").alias("ta")), "a")
        right = texts.select(F.col("digest").alias("b"), F.col("text").alias("tb"))
        return dealt.join(right, "b").join(left, ["a", "chunk"]).select("a", "b", "ta", "tb", *more)

    tested, links, labels = None, None, None

    def settle(pairs: DataFrame) -> int:
        """Verify pairs that are new, and form the components again. Returns how many were verified."""
        nonlocal tested, links, labels
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.save(pairs)
        count = pairs.count()
        tested = pairs if tested is None else tested.unionByName(pairs)
        if not count and links is not None:
            return 0
        found = scratch.save(with_texts(pairs).mapInArrow(_verify(params), "a binary, b binary, similarity double"))
        links = found if links is None else links.unionByName(found)
        labels = components(links, scratch)
        return count

    def still_open() -> DataFrame:
        """Members, with their component, of the buckets that hold more than one component."""
        if labels is None:
            return scratch.save(buckets.join(central, "digest").withColumn("label", F.col("digest")))
        named = buckets.join(central, "digest").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
        named = named.withColumn("label", F.coalesce("label", "digest"))
        mixed = named.groupBy("key", "hot").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key", "hot")
        return scratch.save(by_key(named, mixed, "left_semi"))

    def anchored(members: DataFrame, order) -> DataFrame:
        """Each member with its bucket's anchor ``p``, the one that ``order`` puts first."""
        anchor = members.groupBy("key", "hot").agg(F.max_by("digest", order).alias("p"))
        return by_key(members, anchor).where("digest <> p")

    by_meetings = F.struct(F.col("met"), F.col("digest"))
    for turn in range(params.anchor_rounds):
        members = still_open()
        order = by_meetings if turn == 0 else F.struct(F.xxhash64(F.lit(turn), F.col("digest")), F.col("digest"))
        if turn == 0:
            settle(anchored(members, order).select(F.col("p").alias("a"), F.col("digest").alias("b")))
            continue
        anchor = members.groupBy("key", "hot").agg(F.max_by(F.struct(F.col("digest").alias("p"), F.col("label").alias("lp")), order).alias("x"))
        settle(by_key(members, anchor).where("label <> x.lp").select(F.col("x.p").alias("a"), F.col("digest").alias("b")))

    members = still_open()
    few = members.where(F.col("n") <= params.small)
    other = few.select("key", F.col("digest").alias("b"), F.col("label").alias("lb"))
    settle(few.join(other, "key").where("digest < b and label <> lb").select(F.col("digest").alias("a"), "b"))

    members = still_open().where(F.col("n") > params.small)
    against = anchored(members, by_meetings).select(F.col("p").alias("a"), F.col("digest").alias("b"), "label").distinct()
    filed = scratch.save(
        with_texts(against, "label").mapInArrow(_differences(params), DIFFERENCES)
    )
    settle(meetings(filed, params, scratch))

    degree = (
        links.select(F.explode(F.array("a", "b")).alias("digest")).groupBy("digest").agg(F.count("*").alias("verified_links"))
    )
    named = (
        classes.join(labels.withColumnRenamed("node", "digest"), "digest", "left")
        .withColumn("label", F.coalesce("label", "digest"))
        .join(degree, "digest", "left")
        .withColumn("verified_links", F.coalesce("verified_links", F.lit(0)).cast("bigint"))
    )
    groups = named.groupBy("label").agg(F.min(F.struct(F.col("class_id").isNull().alias("none"), "class_id")).alias("g"))
    classed = scratch.save(
        named.join(groups, "label").select(
            "digest", "class_id", F.col("g.class_id").alias("group_id"), F.col("label").alias("group"), "copies", "verified_links"
        )
    )
    scratch.sweep(sketches, scratch.last)
    return sketched.select("id", "raw", "digest").join(classed, "digest").select(
        "id", "raw", "digest", "class_id", "group_id", "group", "copies", "verified_links"
    )


def keep_representatives(
    docs: DataFrame, params: NearParams = NearParams(), *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group: one row a group.

    The named representatives and the documents are dealt out once and merged in
    order; a row is recognised by its id and the hash of its text.
    """
    found = near_duplicates(docs, params, id_col=id_col, text_col=text_col)
    named = found.where(F.col("id").eqNullSafe(F.col("group_id")))
    # Classes of one group may share its least id; one row of one of them stays.
    named = named.groupBy("group").agg(F.min(F.struct("id", "raw")).alias("m")).select("m.id", "m.raw")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("raw"), whole.alias("row")
    )
    wanted = named.select("id", "raw", F.lit(None).cast(rows.schema["row"].dataType).alias("row"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # By id and text: rows without an id do not all meet in one task.
    dealt = wanted.unionByName(rows).repartition(parts, "id", "raw").sortWithinPartitions("id", "raw", F.col("row").isNotNull())

    def merge(batches):
        due, held = None, False  # the representative that waits for its row
        for batch in batches:
            ids, raws, structs = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            take = []
            for i, key in enumerate(zip(ids, raws, strict=True)):
                if not structs[i].is_valid:
                    due, held = key, True
                elif held and key == due:
                    take.append(i)
                    held = False
            if take:
                picked = structs.take(pa.array(take))
                yield pa.RecordBatch.from_arrays(picked.flatten(), names=[f.name for f in picked.type])

    return dealt.mapInArrow(merge, docs.schema)
