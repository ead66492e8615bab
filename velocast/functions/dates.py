"""Date and time column functions (all JVM-side built-ins)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trip-time pattern and its replacement, as the reference
# writes them (M/D/YYYY H:MM[:SS] -> YYYY-M-D H:MM[:SS]).
DATETIME_MDY_PATTERN = (
    r"^([0-9]?[0-9])/([0-9]?[0-9])/([0-9][0-9][0-9][0-9]) ([0-9]?[0-9]):([0-9][0-9])(:[0-9][0-9])?.*$"
)
DATETIME_MDY_REPLACEMENT = "$3-$1-$2 $4:$5$6"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_datetime(c) -> Column:
    """G1: rewrite ``M/D/YYYY H:MM[:SS]`` as ``YYYY-M-D H:MM[:SS]``; other text unchanged."""
    return F.regexp_replace(_c(c), DATETIME_MDY_PATTERN, DATETIME_MDY_REPLACEMENT)


def parse_timestamp(c) -> Column:
    """Text -> timestamp; unparsable text gives NULL (ANSI-safe).

    Accepts one- or two-digit month/day/hour, optional seconds and fraction,
    which is what G1 produces for both schema versions.  The pattern is
    chosen by a cheap shape test first, so each value is parsed once.
    """
    c = _c(c)
    with_seconds = c.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{2}:[0-9]{2}")
    with_minutes = c.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{2}$")
    return (F.when(with_seconds, F.try_to_timestamp(c, F.lit("y-M-d H:m:s[.SSSSSS]")))
            .when(with_minutes, F.try_to_timestamp(c, F.lit("y-M-d H:m")))
            .otherwise(F.try_to_timestamp(c, F.lit("y-M-d"))))


def to_day(c) -> Column:
    """Timestamp or text -> date."""
    return F.to_date(_c(c))


def trunc_day(c) -> Column:
    """DATE_TRUNC('DAY', c) through the generic built-in call."""
    return F.call_function("date_trunc", F.lit("DAY"), _c(c))


def date_text(c) -> Column:
    """Date -> 'yyyy-MM-dd' text."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def add_days(c, n) -> Column:
    """Date + n days."""
    return F.date_add(_c(c), n)


def next_month_start(c) -> Column:
    """First day of the month after ``c``."""
    return F.trunc(F.add_months(_c(c), 1), "MM")


def run_date_text(c) -> Column:
    """G7: 'yyyy_MM_dd' text of a date."""
    return F.date_format(_c(c), "yyyy_MM_dd")


def parse_run_date(c) -> Column:
    """G8: 'yyyy_MM_dd' text -> date."""
    return F.to_date(_c(c), "yyyy_MM_dd")


def utc_to_local_date(c, tz: str = "America/New_York") -> Column:
    """UTC timestamp -> calendar date in ``tz``."""
    return F.to_date(F.from_utc_timestamp(_c(c).cast("timestamp"), tz))


def fourier_terms(c, orders=(1, 2), period: float = 365.25) -> dict[str, Column]:
    """{SIN_k, COS_k}: sin/cos of 2*pi*k*day-of-year/period per harmonic k."""
    out = {}
    doy = F.dayofyear(_c(c))
    for k in orders:
        arg = F.lit(2.0 * math.pi * k) * doy / F.lit(period)
        out[f"SIN_{k}"], out[f"COS_{k}"] = F.sin(arg), F.cos(arg)
    return out
