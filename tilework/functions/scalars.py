"""Scalar rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def percent(value: Column) -> Column:
    """A percentage as a small integer: null stays null, else rounded and clamped to 0..100."""
    return F.when(value.isNotNull(), F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.round(value)))).cast("smallint")


def cover(nodata: Column) -> Column:
    """How much of its tile a scene fills."""
    return F.lit(100.0) - nodata


def zone_of(tile: Column) -> Column:
    """UTM zone from the leading one or two digits of a tile id; null without a digit."""
    return F.regexp_extract(tile, r"^(\d{1,2})", 1).try_cast("int")


def zone_prefix(tile: Column) -> Column:
    """Zone and latitude band of a tile id, or an empty string."""
    return F.regexp_extract(tile, r"^(\d{1,2}[A-Z])", 1)


def valid_tile(tile: Column) -> Column:
    return tile.rlike(r"^\d{1,2}[C-X][A-Z]{2}$")


def valid_zone(segment: Column) -> Column:
    return F.coalesce(segment.try_cast("int").between(1, 60), F.lit(False))


def pad_tile(tile: Column) -> Column:
    """Both spellings of a one-digit zone as the padded one. Matching is exact unless a caller asks for this."""
    return F.regexp_replace(tile, r"^(\d[A-Z])", "0$1")


def relative_orbit(product: Column) -> Column:
    return F.regexp_extract(product, r"_R(\d{3})_", 1).try_cast("int")


def boa_offset(baseline: Column) -> Column:
    """The offset that an index must subtract: 1000 from baseline 04.00 on, 0 before, null if malformed."""
    return F.when(baseline.rlike(r"^\d\d\.\d\d$"), F.when(baseline >= "04.00", 1000).otherwise(0))


def scene_dir(thumbnail: Column, hosts: tuple = ("amazonaws.com",)) -> Column:
    """Folder of a scene's files: https and one of the hosts or a host below it, or null."""
    allowed = "|".join(h.replace(".", r"\.") for h in hosts)
    host = F.regexp_extract(thumbnail, r"^https://([^/:?#]+)", 1)
    ok = host.rlike(rf"(^|\.)({allowed})$")
    bare = F.regexp_replace(thumbnail, r"[?#].*$", "")
    return F.when(ok, F.regexp_replace(bare, r"/[^/]*$", ""))


def on_ramp(metric: str, value: Column) -> Column:
    """A metric on the 0..100 colour ramp, 0 being best."""
    if metric == "scene_count":
        return F.greatest(F.lit(0.0), 100.0 - value * 8.0)
    if metric == "max_cover":
        return F.greatest(F.lit(0.0), 100.0 - value)
    return value.cast("double")


def months_between(start: Column, end: Column) -> Column:
    """First days of the months from ``start`` to ``end``, both included; empty if reversed."""
    a, b = F.trunc(start, "month"), F.trunc(end, "month")
    return F.when(a <= b, F.sequence(a, b, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def month_name(year: Column, month: Column) -> Column:
    return F.format_string("%04d-%02d", year.cast("int"), month.cast("int"))


def window_months(year: int, first: str, last: str) -> list[int]:
    """The months of ``year`` that the day window touches."""
    y0, m0, y1, m1 = int(first[:4]), int(first[5:7]), int(last[:4]), int(last[5:7])
    return [m for m in range(1, 13) if (y0, m0) <= (year, m) <= (y1, m1)]


def widen_window(start: Column, end: Column) -> tuple[Column, Column]:
    """A window one month wider on either side."""
    return F.add_months(start, -1), F.add_months(end, 1)


def day_windows(start: Column, end: Column, days: int) -> Column:
    """Array of (from, to) that covers ``start``..``end`` in steps of ``days``."""
    starts = F.when(start <= end, F.sequence(start, end, F.expr(f"interval {days} day"))).otherwise(F.array().cast("array<date>"))
    return F.transform(starts, lambda s: F.struct(s.alias("from"), F.least(F.date_add(s, days - 1), end).alias("to")))


def rfc3339(at: Column) -> Column:
    """UTC time with the shortest exact fraction: none, milliseconds or microseconds."""
    micros = F.date_format(at, "SSSSSS")
    base = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    shown = (
        F.when(micros == "000000", F.lit(""))
        .when(micros.endswith("000"), F.concat(F.lit("."), F.substring(micros, 1, 3)))
        .otherwise(F.concat(F.lit("."), micros))
    )
    return F.concat(base, shown, F.lit("Z"))


def scene_day(item_id: Column, pattern: str) -> Column:
    """Acquisition day from an item id by its collection's pattern; null where it does not fit."""
    return F.try_to_date(F.regexp_extract(item_id, pattern, 2), "yyyyMMdd")


def scene_tile(item_id: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(item_id, pattern, 1), F.lit(""))


def multihash(data: Column) -> Column:
    """SHA-256 as a multihash in hexadecimal."""
    return F.concat(F.lit("1220"), F.sha2(data, 256))


def curve(t: Column, kind: str = "linear", gamma: float = 1.0) -> Column:
    """Stretch of t in 0..1 to a byte: curve first, then gamma."""
    shaped = {"linear": t, "sqrt": F.sqrt(t), "log": F.log10(1 + 9 * t)}[kind]
    return F.least(F.lit(255), F.round(255 * F.pow(shaped, F.lit(1 / max(0.05, gamma or 1.0))))).cast("int")


def shade(count: Column, most: Column) -> Column:
    """Logarithmic density shade in 0..1 with gamma one half."""
    return F.sqrt(F.log1p(count.cast("double")) / F.log1p(most.cast("double")))
