"""Column-level functions (all built-in Spark expressions, so they stay inside codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- mixed / dirty text columns -------------------------------------------------------------

def number_or_null(x) -> Column:
    """``to_numeric(errors='coerce')``: the number, or null when the text is not one."""
    return _c(x).try_cast("double")


def non_numeric_part(x) -> Column:
    """The text itself where it is not a number, else null."""
    return F.when(_c(x).try_cast("double").isNull(), _c(x))


def first_digits(x) -> Column:
    """First run of digits (``str.extract('(\\d+)')``), null when there is none."""
    return F.nullif(F.regexp_extract(_c(x), r"(\d+)", 1), F.lit(""))


def first_char(x) -> Column:
    return F.nullif(F.substring(_c(x), 1, 1), F.lit(""))


def last_char(x) -> Column:
    return F.nullif(F.right(_c(x), F.lit(1)), F.lit(""))


def first_token(x) -> Column:
    return F.element_at(F.split(F.trim(_c(x)), r"\s+"), 1)


def last_token(x) -> Column:
    return F.element_at(F.split(F.trim(_c(x)), r"\s+"), -1)


def all_digits(x) -> Column:
    return _c(x).rlike(r"^[0-9]+$")


def split_first(x, sep: str = "|") -> Column:
    """Split on the first separator only: array of at most two parts."""
    import re

    return F.split(_c(x), re.escape(sep), 2)


def human_number(x) -> Column:
    """``'12.5M'`` -> 12500000.0, ``'3K'`` -> 3000.0, ``'870'`` -> 870.0.

    The digits are all number-like runs joined together (as the reference's ``findall`` + join);
    the multiplier comes from a suffix anchored at the end of the text only.
    """
    t = F.upper(F.trim(_c(x)))
    digits = F.array_join(F.regexp_extract_all(t, F.lit(r"\d+\.?\d*"), 0), "")
    num = F.nullif(digits, F.lit("")).try_cast("double")
    mult = F.when(t.endswith("M"), F.lit(1e6)).when(t.endswith("K"), F.lit(1e3)).otherwise(F.lit(1.0))
    return num * mult


# ---- dates ---------------------------------------------------------------------------------

def weekday_monday0(d) -> Column:
    """Day of week with Monday = 0 (pandas ``dayofweek``); Spark ``dayofweek`` is Sunday = 1."""
    return F.weekday(_c(d))


def month_start_quirk(d) -> Column:
    """The reference's month-start expression ``last_day(d - 1 day - 1 month) + 1 day``.

    Equals ``trunc(d, 'MM')`` except on the first of a month, where it returns the *previous*
    month's first day (2023-03-01 -> 2023-02-01).
    """
    return F.date_add(F.last_day(F.add_months(F.date_sub(_c(d), 1), -1)), 1)


def overlap_days(s1, e1, s2, e2) -> Column:
    """Days two closed date ranges share (may be <= 0 when they do not overlap)."""
    return F.datediff(F.least(_c(e1), _c(e2)), F.greatest(_c(s1), _c(s2))) + 1


def whole_days_between(later, earlier) -> Column:
    """Floor of the day difference of two timestamps (pandas ``Timedelta.days``).

    ``datediff`` counts midnights and ``timestampdiff(DAY)`` truncates toward zero; this floors
    (9 hours before ``as_of`` -> 0 days, 15 hours after -> -1). Works on TIMESTAMP_NTZ without
    any session time-zone shift.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(earlier), _c(later))
    return F.floor(micros / F.lit(86_400_000_000.0)).cast("bigint")


def metrics_start(as_of) -> Column:
    """First day of the month three months before ``as_of``."""
    return F.trunc(F.add_months(_c(as_of), -3), "MM")


def semester(d) -> Column:
    return F.when(F.quarter(_c(d)) <= 2, F.lit(1)).otherwise(F.lit(2))


def utc_to_local(ts, zone: str = "Asia/Kolkata") -> Column:
    return F.from_utc_timestamp(_c(ts), zone)


# ---- numbers -------------------------------------------------------------------------------

def safe_ratio(num, den, zero=0.0) -> Column:
    """``num / den`` with ``zero`` when the denominator is 0 (ANSI ``/`` would raise)."""
    return F.when(_c(den) == 0, F.lit(zero)).otherwise(F.try_divide(_c(num), _c(den)))


def money(x, scale: int = 2) -> Column:
    return _c(x).cast(f"decimal(18,{scale})")


def row_sum(cols: Sequence) -> Column:
    out = None
    for c in cols:
        out = _c(c) if out is None else out + _c(c)
    return out


def exclude_names(x, patterns: Sequence[str]) -> Column:
    """True when lower(x) matches none of the LIKE-style patterns (case-insensitive)."""
    cond = None
    for p in patterns:
        m = F.lower(_c(x)).like(p.lower())
        cond = m if cond is None else (cond | m)
    return ~F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(True)


# ---- text by position (X9, X10) ---------------------------------------------------------------

def before_nth(x, sep: str, n: int) -> Column:
    """``SUBSTRING_INDEX(x, sep, n)``: the text before the n-th separator from the left, or after the n-th from the
    right for a negative n; the whole text where there are fewer."""
    return F.substring_index(_c(x), sep, n)


def trimmed(x, chars: str | None = None) -> Column:
    """``TRIM``: spaces (or the given characters) off both ends."""
    return F.trim(_c(x)) if chars is None else F.trim(_c(x), F.lit(chars))


def joined(*parts) -> Column:
    """MySQL's ``CONCAT``: null as soon as one part is null."""
    return F.concat(*[_c(p).cast("string") for p in parts])


def slice_text(x, start: int | None = None, stop: int | None = None) -> Column:
    """``str[start:stop]`` by characters, negative positions from the end."""
    t = _c(x)
    n = F.char_length(t)

    def at(i: int | None, default: Column) -> Column:
        if i is None:
            return default
        return F.least(F.lit(i), n) if i >= 0 else F.greatest(n + i, F.lit(0))

    a, b = at(start, F.lit(0)), at(stop, n)
    return t.substr(a + 1, F.greatest(b - a, F.lit(0)))


def slice_array(x, start: int, stop: int) -> Column:
    """Elements ``start`` to ``stop`` (excluded) of an array, from 0; null for a null array."""
    return F.slice(_c(x), F.lit(start + 1), F.lit(max(0, stop - start)))
