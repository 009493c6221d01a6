"""Tolerant coercion expressions.

Spark 4 runs with ANSI on: a plain ``cast`` raises on bad text, so every
coercion here goes through ``try_cast`` and returns null on failure, which is
what "errors=coerce" means in the data-preparation world.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The only text accepted as a finite decimal number
# (optional sign, digits with optional fraction, optional exponent).
# 'nan', 'inf', '12f', '12d' are rejected, unlike a bare Spark cast.
NUMERIC_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Boolean text sets (lower-cased, trimmed) of the cleaning rules.
TRUE_SET = ("true", "1", "1.0", "yes")
FALSE_SET = ("false", "0", "0.0", "no")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c, strict: bool = True) -> Column:
    """Text (or number) to double; bad text, blanks and non-finite values -> null."""
    col = _c(c)
    txt = F.trim(col.cast("string"))
    if not strict:
        return txt.try_cast("double")
    return F.when(txt.rlike(NUMERIC_TEXT), txt.try_cast("double"))


def as_int(c, strict: bool = True) -> Column:
    """Text to int through double, truncating toward zero ('34.0' -> 34, '578.74' -> 578)."""
    return as_double(c, strict).try_cast("int")


def as_long(c, truncate: bool = False) -> Column:
    """Text (or number) to bigint without a detour through double, so every long keeps its digits.

    A value with a fraction is null, or loses it with ``truncate``.
    """
    txt = F.trim(_c(c).cast("string"))
    dec = txt.try_cast("decimal(38,10)")
    whole = dec if truncate else F.when(dec == F.floor(dec), dec)
    return F.when(txt.rlike(NUMERIC_TEXT), F.coalesce(txt.try_cast("bigint"), whole.try_cast("bigint")))


def as_bool_set(c, true_set: Iterable[str] = TRUE_SET,
                false_set: Iterable[str] = FALSE_SET) -> Column:
    """Boolean from a set of accepted spellings; anything else -> null."""
    v = F.lower(F.trim(_c(c).cast("string")))
    return (F.when(v.isin(list(true_set)), F.lit(True))
            .when(v.isin(list(false_set)), F.lit(False)))


def as_bool_cast(c) -> Column:
    """Strict Spark boolean cast ('1.0' -> null, 'yes' -> true)."""
    return _c(c).cast("string").try_cast("boolean")


def as_timestamp(c) -> Column:
    """Text to a wall-clock timestamp (``timestamp_ntz``, read in the session time zone);
    bad text -> null."""
    return F.try_to_timestamp(_c(c).cast("string")).cast("timestamp_ntz")


def bool_threshold(c, threshold: float = 0.5) -> Column:
    """Numeric score to boolean: ``x >= threshold``; null stays null."""
    return _c(c) >= F.lit(threshold)


def clamp(c, lo=None, hi=None) -> Column:
    """Clamp into ``[lo, hi]``; null stays null (``greatest`` alone would skip it)."""
    col = _c(c)
    out = col
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(col.isNotNull(), out)


def blank_to_null(c) -> Column:
    """Trim text; empty -> null."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def null_if_in(c, sentinels: Iterable[str], case_insensitive: bool = True) -> Column:
    """Sentinel text (e.g. 'NAN', 'null') -> null; other values pass unchanged."""
    col = _c(c)
    key = F.upper(F.trim(col)) if case_insensitive else col
    vals = [s.upper() for s in sentinels] if case_insensitive else list(sentinels)
    return F.when(key.isin(vals), F.lit(None)).otherwise(col)


def is_integral(c) -> Column:
    """True for non-null values without a fractional part."""
    col = _c(c)
    return col.isNotNull() & (col == F.floor(col))
