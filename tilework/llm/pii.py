"""Personal data: patterns propose, checksums confirm, context scores.

All of it is DataFrame expressions. A kind's pattern splits the text; the lengths
of the pieces and matches give every match its code-point offsets. A proposal is
kept if its validator accepts it: octets for addresses, the Luhn sum for cards,
the number of digits for phones, the country's length and mod 97 for bank accounts
(IBAN), a calendar day for dates, letters and digits for keys. The score starts at
the kind's prior and rises if one of its context words stands near: within
``context_chars`` characters before the span or after it, but not beyond the next but
one span of its kind.

The base kinds are kept at any score. The others need ``least_score``: an account
has it by its checksum alone; a phone number without a country code, a date of birth
and a secret key have it only beside a context word.

Patterns are possessive and anchored at the start of a run, so that they take
linear time and no stack on long runs; both leave the leftmost matches unchanged
(an email's local part starts at a run's start or where the last match ended).
Offsets and redaction take nearly linear time in the spans of a text (see ``cuts``).

Defined results: null text counts as empty and has no spans; very long texts are
searched whole, a text's spans must fit one array; spans of different kinds may
overlap, within a kind they cannot; redaction merges overlapping spans under the kind
that begins first; repeated rows are searched each; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from . import cuts

# The length of an account number by country, as registered for IBAN.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC", 33: "RU",
}
_ACCOUNTS = "|".join(f"(?:{'|'.join(names.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{size - 4}}}" for size, names in IBAN_LENGTHS.items())
_DAY, _MONTH, _YEAR = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])", "(?:19|20)[0-9]{2}"

# Patterns, in the order in which kinds are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "local_phone", "birth_date", "secret")
BASE_KINDS = KINDS[:4]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?:{_ACCOUNTS})(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9A-Za-z+./-])(?<![0-9][ .-])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ ./-])[0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9A-Za-z]|[ .-][0-9])",
    "birth_date": rf"(?<![0-9./-])(?:{_YEAR}-{_MONTH}-{_DAY}|{_DAY}[./]{_MONTH}[./]{_YEAR})(?![0-9]|[./-][0-9])",
    "secret": r"[A-Za-z0-9_+/-]{20,}+={0,2}",
}
#: What a text must hold for the pattern to be tried at all.
NEEDS = {
    "email": r"@[A-Za-z0-9-]+\.",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[ -]?[0-9]){13}",
    "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]",
    "local_phone": r"[0-9][) ./-] ?[0-9]{3}",
    "birth_date": r"[0-9][./-][0-9]{1,2}[./-][0-9]",
    "secret": r"[0-9][_+/-]*+[A-Za-z][A-Za-z_+/-]*+[0-9]",
}
#: Words that make a kind more likely; searched beside a span, from the start of a word on.
CONTEXT = {
    "email": "mail|contact|write|schreib|correo|courriel",
    "ip": "address|host|server|adresse|dirección|login",
    "card": "card|visa|credit|karte|carte|tarjeta|payment",
    "phone": "phone|tel|call|mobile|fax|telefon|appel|llame",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "local_phone": r"\b(?:phone|tel|call|mobile|fax|appel|llam)",
    "birth_date": r"\b(?:born|birth|dob|geboren|geburt|née?\b|naissance|nacid|nacimiento)",
    "secret": r"(?:token|secret|passw|api.?key|credential|bearer|private.?key|access.?key)",
}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "local_phone": 0.4, "birth_date": 0.4, "secret": 0.4}


@dataclass(frozen=True)
class PiiParams:
    context_chars: int = 40
    context_gain: float = 0.15
    prior: dict = field(default_factory=lambda: dict(PRIOR))
    #: Spans of kinds beyond the base ones need at least this score.
    least_score: float = 0.5


def _luhn(digits: str) -> str:
    """SQL: whether a string of digits has a Luhn sum divisible by ten."""
    digit = f"cast(substring({digits}, i, 1) as int)"
    twice = f"{digit} * 2 - if({digit} > 4, 9, 0)"
    return f"aggregate(sequence(1, length({digits})), 0, (acc, i) -> acc + if((length({digits}) - i) % 2 = 1, {twice}, {digit})) % 10 = 0"


def _mod_97(account: str) -> str:
    """SQL: whether an IBAN (spaces allowed) leaves 1 when divided by 97."""
    number = "if(ascii(x) <= 57, (acc * 10 + ascii(x) - 48) % 97, (acc * 100 + ascii(x) - 55) % 97)"
    turned = f"split(concat(substring({account}, 5), substring({account}, 1, 4)), '')"
    return f"aggregate(filter({turned}, x -> x <> '' and x <> ' '), 0, (acc, x) -> {number}) = 1"


def _is_day(match: str) -> str:
    """SQL: whether a date of the pattern is in the calendar."""
    parts = f"split(replace(replace({match}, '/', '-'), '.', '-'), '-')"
    ordered = "if(length(p[0]) = 4, p, reverse(p))"
    return cuts.let("p", parts, f"try_to_timestamp(array_join({ordered}, '-'), 'yyyy-M-d') is not null")


_DIGITS = "regexp_replace(m, '[^0-9]', '')"
#: SQL of each kind's validator over a match ``m``.
VALID = {
    "ip": r"forall(split(m, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)",
    "card": cuts.let("d", _DIGITS, f"if(length(d) between 14 and 19, {_luhn('d')}, false)"),
    "phone": f"length({_DIGITS}) between 10 and 15",
    "iban": _mod_97("m"),
    "local_phone": f"length({_DIGITS}) between 9 and 13",
    "birth_date": _is_day("m"),
    # Words joined by dashes, long numbers and dates are no keys.
    "secret": f"m rlike '{NEEDS['secret']}' and length({_DIGITS}) >= 4",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(kind: str, params: PiiParams) -> str:
    """SQL: array of (start, rank, end, kind, score), in order, of the accepted matches of one kind.

    Columns of the kind: ``_m`` its matches, ``_p`` the pieces between them, ``_e`` how far
    pieces and matches reach in the text before each match.
    """
    reach = params.context_chars
    before = f"right(concat_ws('', get({kind}_p, i - 1), get({kind}_m, i - 1), {kind}_p[i]), {reach})"
    after = f"left(concat_ws('', {kind}_p[i + 1], get({kind}_m, i + 1), get({kind}_p, i + 2)), {reach})"
    near = f"lower(concat({before}, '\n', {after})) rlike {_quoted(CONTEXT[kind])}"
    score = f"least(1D, {params.prior[kind]!r}D + if({near}, {params.context_gain!r}D, 0D))"
    span = (
        f"named_struct('start', {kind}_e[i + 1] - length(m), 'rank', {KINDS.index(kind)}, 'end', {kind}_e[i + 1], 'kind', '{kind}',"
        f" 'score', if({VALID.get(kind, 'true')}, {score}, null))"
    )
    least = 0.0 if kind in BASE_KINDS else params.least_score
    return f"filter(transform({kind}_m, (m, i) -> {span}), s -> s.score >= {least!r}D)"


def find(docs: DataFrame, params: PiiParams = PiiParams(), *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns as a struct ``row``, the text, and ``spans``: all accepted spans by start, then kind."""
    keep = docs.columns if keep is None else keep
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    # A project of its own for each step: expressions used twice are not computed twice.
    found = base.select(
        "row",
        "text",
        *[
            F.when(F.col("text").rlike(NEEDS[k]), F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0)))
            .otherwise(none)
            .alias(f"{k}_m")
            for k in KINDS
        ],
    )
    cut = found.select(
        "*",
        *[
            F.when(F.size(f"{k}_m") > 0, F.split("text", PATTERNS[k], -1)).otherwise(none).alias(f"{k}_p")
            for k in KINDS
        ],
    )
    lengths = [F.expr(f"transform({k}_m, (m, i) -> length({k}_p[i]) + length(m)) as {k}_n") for k in KINDS]
    ends = [F.expr(cuts.running(f"{k}_n", "a + b", "0")).alias(f"{k}_e") for k in KINDS]
    spans = F.expr(f"concat({', '.join(_spans(k, params) for k in KINDS)})").alias("all")
    placed = cut.select("*", *lengths).select("*", *ends).select("row", "text", spans)
    return placed.select("row", "text", F.when(F.size("all") > 1, F.array_sort("all")).otherwise(F.col("all")).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(text: str, spans: str) -> Column:
    """The column ``text`` with each of ``spans``, or run of overlapping ones, replaced by ``[KIND]``."""
    # ``reach`` is how far the spans before one extend; only the first span of a run is past it.
    mark = f"concat({cuts.between('pieces', 'reach[i]', 's.start')}, '[', upper(s.kind), ']')"
    shown = f"array_join(transform({spans}, (s, i) -> if(s.start >= reach[i], {mark}, '')), '')"
    tail = cuts.between("pieces", "element_at(reach, -1)", f"length({text})")
    reach = cuts.let("ends", f"transform({spans}, s -> s.end)", cuts.running("ends", "greatest(a, b)", "0"))
    done = cuts.let("reach", reach, cuts.let("pieces", cuts.chunks(text), f"concat({shown}, {tail})"))
    return F.expr(f"if(size({spans}) = 0, {text}, {done})")
