"""Scalar Column functions.

All of them are built from native Spark expressions, so they stay inside
whole-stage code generation and give the same answer under any partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from etafeat import config

__all__ = [
    "col_", "round_half_even", "clip", "positive_or_null", "to_double", "price_band",
    "canonical", "token_array", "title_case", "display_tokens", "display_text",
    "composite_key", "parse_route", "route_key_problems", "hash_mod", "unit_hash",
    "epoch_micros", "floor_hour", "is_weekend", "hour_in", "hour_between",
    "cyclical", "format_id", "safe_div", "token_count", "normal_from_units",
]



def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- maths

def round_half_even(c: Column | str, digits: int = 2) -> Column:
    """Round half to even on the scaled value (NumPy ``round`` semantics).

    ``rint(x * 10^d) / 10^d``: 0.125 -> 0.12, 1.005 -> 1.0, 2.675 -> 2.68.
    """
    scale = float(10 ** digits)
    return F.rint(col_(c) * F.lit(scale)) / F.lit(scale)


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    x = col_(c)
    y = x
    if lo is not None:
        y = F.greatest(y, F.lit(float(lo)))
    if hi is not None:
        y = F.least(y, F.lit(float(hi)))
    return F.when(x.isNotNull(), y)


def positive_or_null(c: Column | str) -> Column:
    x = col_(c)
    return F.when(x > 0, x)


def to_double(c: Column | str) -> Column:
    """Lenient numeric coercion: unparsable text and NaN become NULL."""
    x = col_(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def price_band(c: Column | str) -> Column:
    """Right-closed bands with the lowest edge included; negative or NULL -> NULL."""
    x = col_(c)
    e0, e1, e2, e3 = config.PRICE_BAND_EDGES
    b0, b1, b2, b3 = config.PRICE_BAND_LABELS
    return (F.when(x.isNull() | (x < e0), F.lit(None).cast("string"))
            .when(x <= e1, b0).when(x <= e2, b1).when(x <= e3, b2).otherwise(b3))


def safe_div(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(col_(a), col_(b))


def normal_from_units(u1: Column, u2: Column, std: float = 1.0) -> Column:
    """Box-Muller transform of two independent (0,1) units into N(0, std)."""
    return F.sqrt(-2.0 * F.ln(u1)) * F.cos(2.0 * math.pi * u2) * F.lit(float(std))


# ------------------------------------------------------------------- strings

def canonical(c: Column | str, aliases: Mapping[str, str] = config.CITY_ALIASES) -> Column:
    """Trim + lower, then map known spellings; unknown values pass through."""
    k = F.lower(F.trim(col_(c)))
    m = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.coalesce(F.try_element_at(m, k), k)


def token_array(c: Column | str, sep: str = ",") -> Column:
    """CSV cell -> array of trimmed lower-case tokens without empties; NULL -> []."""
    parts = F.transform(F.split(col_(c), sep), lambda t: F.lower(F.trim(t)))
    return F.coalesce(F.filter(parts, lambda t: t != ""), F.array().cast("array<string>"))


def title_case(c: Column | str) -> Column:
    """Python ``str.title``: upper-case every letter that follows a non-letter.

    ``initcap`` only splits on spaces (``north-indian`` -> ``North-indian``), so
    the text is cut after every non-letter and each piece is capitalised.
    """
    pieces = F.split(F.lower(col_(c)), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(pieces, lambda p: F.initcap(p)), "")


def display_tokens(arr: Column | str) -> Column:
    """Token array -> ``"North Indian, Chinese"``."""
    kept = F.filter(F.transform(col_(arr), lambda t: F.trim(t)), lambda t: t != "")
    return F.array_join(F.transform(kept, title_case), ", ")


def display_text(c: Column | str) -> Column:
    """Free text or a list literal (``"['a', 'b']"``) -> display string; NULL -> ''."""
    s = F.trim(col_(c))
    bracketed = s.startswith("[") & s.endswith("]")
    body = F.when(bracketed, F.regexp_replace(s, r"^\[|\]$", "")).otherwise(s)
    items = F.transform(F.split(body, ","),
                        lambda t: F.when(bracketed, F.regexp_replace(F.trim(t), r"^['\"]|['\"]$", ""))
                        .otherwise(t))
    return F.coalesce(display_tokens(items), F.lit(""))


def token_count(c: Column | str, sep: str = ",") -> Column:
    """Number of delimited tokens; the empty string counts 0."""
    x = col_(c)
    return F.when(x == "", F.lit(0)).otherwise(F.size(F.split(x, sep)))


def composite_key(*parts: Column | str, sep: str = "_") -> Column:
    """Lower-cased ``a_b_c``; NULL if any part is NULL (``concat_ws`` would skip it)."""
    cols = [col_(p) for p in parts]
    out = cols[0]
    for p in cols[1:]:
        out = F.concat(out, F.lit(sep), p)
    return F.lower(out)


def parse_route(key: Column | str) -> Column:
    """``city_origin_to_dest`` -> struct(city, origin_area, dest_area).

    Split once on ``_to_``, then the left part once on ``_``; a missing part is
    ``UNKNOWN``. ``delhi_a_to_b_to_c`` -> (delhi, a, b_to_c).
    """
    k = col_(key)
    halves = F.split(k, "_to_", 2)
    left = F.try_element_at(halves, F.lit(1))
    origin = F.split(left, "_", 2)
    return F.struct(
        F.try_element_at(origin, F.lit(1)).alias("city"),
        F.coalesce(F.try_element_at(origin, F.lit(2)), F.lit("UNKNOWN")).alias("origin_area"),
        F.coalesce(F.try_element_at(halves, F.lit(2)), F.lit("UNKNOWN")).alias("dest_area"),
    )


def route_key_problems(key: Column | str) -> Column:
    """Array of structural problems of a route key (empty when well formed)."""
    k = col_(key)
    checks = [
        (~k.contains("_to_"), "missing _to_"),
        (F.regexp_count(k, F.lit("_")) < 2, "fewer than two _"),
        (k.contains("__"), "double _"),
    ]
    arr = F.array(*[F.when(cond, F.lit(msg)) for cond, msg in checks])
    return F.filter(arr, lambda x: x.isNotNull())


# -------------------------------------------------------------------- hashing

def hash_mod(c: Column | str, modulus: int = 10 ** 6) -> Column:
    """SHA-256 of the UTF-8 text read as one 256-bit integer, modulo ``modulus``.

    Folds eight 32-bit words left to right, reducing after each step, so every
    intermediate stays below 2^63 for moduli up to 2^31.
    """
    if not 0 < modulus < 2 ** 31:
        raise ValueError("modulus must be in (0, 2^31)")
    h = F.sha2(col_(c), 256)
    acc = F.lit(0).cast("bigint")
    for i in range(8):
        word = F.conv(F.substring(h, i * 8 + 1, 8), 16, 10).cast("bigint")
        acc = (acc * F.lit(2 ** 32) + word) % F.lit(modulus)
    return acc


def unit_hash(c: Column | str, seed: int | str = 42, salt: str = "") -> Column:
    """Reproducible uniform draw in (0, 1) from ``sha2(seed|salt|key)``.

    Uses the first 52 bits: ``(n + 1) / (2^52 + 1)`` so ``ln(u)`` stays finite.
    Independent of partitioning and row order.
    """
    text = F.concat(F.lit(f"{seed}|{salt}|"), col_(c).cast("string"))
    n = F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("bigint")
    return (n.cast("double") + F.lit(1.0)) / F.lit(float(2 ** 52 + 1))


# ---------------------------------------------------------------------- dates

def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (NTZ) timestamp; zone independent."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, col_(ts).cast("timestamp_ntz"))


def floor_hour(ts: Column | str) -> Column:
    """Truncate a timestamp_ntz to the hour, staying timestamp_ntz."""
    t = col_(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def is_weekend(ts: Column | str) -> Column:
    return F.weekday(col_(ts)) >= 5


def hour_in(ts: Column | str, hours: Sequence[int]) -> Column:
    return F.hour(col_(ts)).isin(list(hours))


def hour_between(ts: Column | str, ranges: Sequence[tuple[int, int]]) -> Column:
    h = F.hour(col_(ts))
    cond = F.lit(False)
    for lo, hi in ranges:
        cond = cond | h.between(lo, hi)
    return cond


def cyclical(x: Column | str, period: float) -> tuple[Column, Column]:
    ang = F.lit(2.0 * math.pi) * col_(x) / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


def format_id(prefix: str, n: Column | str, width: int) -> Column:
    """``U00001``; wider numbers keep all digits (``lpad`` would cut them)."""
    return F.format_string(f"{prefix}%0{width}d", col_(n).cast("bigint"))
