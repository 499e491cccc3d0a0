"""Running sums and pieces of long texts as SQL expressions, in nearly linear time.

Spark's ``aggregate`` copies what it has gathered at every step, and ``substring`` walks
from the start of the text at every call; both are quadratic where a text has many
spans. Here running values are taken in blocks of the square root of the array, and
pieces are cut from chunks that one regular expression makes.
"""

from __future__ import annotations

CHUNK = 1024


def let(name: str, value: str, use: str) -> str:
    """SQL of ``use``, in which ``name`` stands for ``value``, computed once."""
    return f"transform(array({value}), {name} -> {use})[0]"


def running(values: str, merge: str, start: str) -> str:
    """SQL: for each element, ``merge`` (over a and b) of ``start`` and all elements before it; one more entry for all of them.

    ``values`` is read at several places, so it should name a column or what ``let`` binds.
    """
    step = f"cast(ceil(sqrt(size({values}))) as int)"
    fold = lambda part, first: f"aggregate({part}, {first}, (a, b) -> {merge})"
    blocks = f"transform(sequence(1, size({values}), {step}), k -> {fold(f'slice({values}, k, {step})', start)})"
    heads = f"aggregate({blocks}, array({start}), (acc, x) -> concat(acc, array({let('a', 'element_at(acc, -1)', let('b', 'x', merge))})))"
    inside = fold(f"slice({values}, i - i % {step} + 1, i % {step})", f"heads[i div {step}]")
    rows = f"concat(transform(sequence(0, size({values}) - 1), i -> {inside}), array(element_at(heads, -1)))"
    return f"if(size({values}) = 0, array({start}), {let('heads', heads, rows)})"


def chunks(text: str) -> str:
    """SQL: the text in pieces of CHUNK code points."""
    return f"regexp_extract_all({text}, '(?s).{{1,{CHUNK}}}', 0)"


def between(pieces: str, start: str, end: str) -> str:
    """SQL: code points ``start`` (from 0) to ``end`` (exclusive) of a text that ``chunks`` has cut."""
    first = f"cast(({start}) div {CHUNK} as int)"
    taken = f"array_join(slice({pieces}, {first} + 1, cast((({end}) - 1) div {CHUNK} as int) - {first} + 1), '')"
    return f"if(({end}) > ({start}), substring({taken}, cast(({start}) % {CHUNK} + 1 as int), cast(({end}) - ({start}) as int)), '')"
