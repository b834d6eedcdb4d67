"""

All are built-in Spark expressions (no Python UDFs), so they run inside
whole-stage code generation.  Each one fixes a semantic trap noted in the
survey: missing regex matches, whole-second differences, half-away rounding,
division by zero under ANSI mode, seconds-of-day parsing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from ordertide.fixed import CLOSED_SHIFT

ColLike = str | Column


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def regexp_group(s: ColLike, pattern: str, group: int = 1) -> Column:
    """First match of ``group`` or NULL when the pattern does not match.

    ``regexp_extract`` returns '' on no match; the warehouse dialect returns
    NULL, hence the ``nullif``.
    """
    return F.nullif(F.regexp_extract(_c(s), pattern, group), F.lit(""))


def seconds_between(start: ColLike, end: ColLike) -> Column:
    """Whole seconds from ``start`` to ``end`` (``TIMESTAMP_DIFF(end, start, SECOND)``).

    ``timestamp_diff`` truncates the microsecond difference; subtracting two
    ``unix_timestamp`` values would count second boundaries instead.
    """
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def epoch_seconds(ts: ColLike) -> Column:
    """Whole seconds since the epoch (UNIX_SECONDS); zone-free for timestamp_ntz."""
    return F.unix_timestamp(_c(ts))


def minutes_between(start: ColLike, end: ColLike) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def hours_between(start: ColLike, end: ColLike) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def days_between(start: ColLike, end: ColLike) -> Column:
    return seconds_between(start, end) / F.lit(86400.0)


def parse_time_secs(s: ColLike) -> Column:
    """Seconds of day of an ``HH:mm:ss`` text, NULL when it does not parse."""
    t = F.try_to_timestamp(_c(s), F.lit("HH:mm:ss"))
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def normalise_shift(text: ColLike) -> Column:
    """``HH:MM-HH:MM`` -> ``HH:MM:00-HH:MM:00``; NULL (closed day) -> all zeros."""
    t = _c(text)
    short = F.concat(F.substring(t, 1, 5), F.lit(":00-"), F.substring(t, 7, 5), F.lit(":00"))
    return F.coalesce(F.when(F.length(t) == 11, short).otherwise(t), F.lit(CLOSED_SHIFT))


def shift_bounds(text: ColLike) -> tuple[Column, Column]:
    """(start, end) seconds of day of a normalised ``start-end`` shift text."""
    parts = F.split(_c(text), "-")
    return parse_time_secs(parts.getItem(0)), parse_time_secs(parts.getItem(1))


def to_utc(local_ts: ColLike, zone: str) -> Column:
    """Wall-clock time in ``zone`` -> UTC instant (``TIMESTAMP(dt, zone)``)."""
    return F.to_utc_timestamp(_c(local_ts), zone)


def round_half_away(x: ColLike, places: int = 0) -> Column:
    """Round half away from zero (the warehouse FLOAT64 -> INT64 rule).

    Spark's ``round`` on doubles is already HALF_UP on the decimal value, i.e.
    away from zero for both signs; a cast alone would truncate.
    """
    return F.round(_c(x), places)


def safe_ratio(a: ColLike, b: ColLike, scale: float = 1.0) -> Column:
    """``scale * a / b``; NULL when ``b`` is 0 or NULL (ANSI-safe)."""
    r = F.try_divide(_c(a), _c(b))
    return r if scale == 1.0 else r * F.lit(scale)


def share_or_zero(a: ColLike, b: ColLike) -> Column:
    """``a / b`` with 0 when ``b`` is 0 (the 0 -> NaN -> 0 guard)."""
    return F.coalesce(F.try_divide(_c(a), F.nullif(_c(b), F.lit(0))), F.lit(0.0))


def composite_id(*cols: ColLike, sep: str = "_") -> Column:
    """Concatenated id; the separator keeps ('1','23') and ('12','3') apart."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def level_indicator(c: ColLike, level) -> Column:
    """1 when ``c`` equals ``level`` (NULL-safe, so a NULL level works), else 0."""
    return _c(c).eqNullSafe(F.lit(level)).cast("int")
