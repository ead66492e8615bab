"""H1: US federal holidays (observed dates) as a Spark relation.

Each year of the requested range is one row; the rule list is exploded per
year and every rule is a date expression, so no Python runs per date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import HOLIDAY_DAYS, HOLIDAY_START

# The US federal holiday rules of the pandas federal calendar.
# (name, kind, month, day, ISO weekday 1=Mon, n-th occurrence, first date)
#   kind "fixed": month/day, Saturday observed Friday, Sunday observed Monday
#   kind "nth":   n-th ISO weekday of the month
#   kind "last":  last ISO weekday on or before month/day
FEDERAL_HOLIDAY_RULES = [
    ("New Year's Day", "fixed", 1, 1, 0, 0, None),
    ("Birthday of Martin Luther King, Jr.", "nth", 1, 1, 1, 3, "1986-01-01"),
    ("Washington's Birthday", "nth", 2, 1, 1, 3, None),
    ("Memorial Day", "last", 5, 31, 1, 0, None),
    ("Juneteenth National Independence Day", "fixed", 6, 19, 0, 0, "2021-06-18"),
    ("Independence Day", "fixed", 7, 4, 0, 0, None),
    ("Labor Day", "nth", 9, 1, 1, 1, None),
    ("Columbus Day", "nth", 10, 1, 1, 2, None),
    ("Veterans Day", "fixed", 11, 11, 0, 0, None),
    ("Thanksgiving Day", "nth", 11, 1, 4, 4, None),
    ("Christmas Day", "fixed", 12, 25, 0, 0, None),
]


def _rules_column() -> Column:
    return F.array(*[
        F.struct(F.lit(name).alias("NAME"), F.lit(kind).alias("KIND"), F.lit(m).alias("M"),
                 F.lit(d).alias("D"), F.lit(wd).alias("WD"), F.lit(n).alias("N"),
                 F.lit(first).cast("date").alias("FIRST"))
        for name, kind, m, d, wd, n, first in FEDERAL_HOLIDAY_RULES
    ])


def _iso_dow(d: Column) -> Column:
    return F.weekday(d) + 1  # weekday(): 0 = Monday


def _rule_date(y: Column, r: Column) -> Column:
    anchor = F.make_date(y, r["M"], r["D"])
    fixed = F.date_add(anchor, F.when(_iso_dow(anchor) == 6, -1)
                       .when(_iso_dow(anchor) == 7, 1).otherwise(0))
    nth = F.date_add(anchor, ((r["WD"] - _iso_dow(anchor) + 7) % 7) + 7 * (r["N"] - 1))
    last = F.date_sub(anchor, (_iso_dow(anchor) - r["WD"] + 7) % 7)
    return (F.when(r["KIND"] == "fixed", fixed)
            .when(r["KIND"] == "nth", nth)
            .otherwise(last))


def holidays_for_range(bounds: DataFrame, start_col: str = "START", end_col: str = "END",
                       with_names: bool = False) -> DataFrame:
    """Observed federal holidays in [start, end] for each row of ``bounds``.

    ``bounds`` is normally a one-row relation derived from the data (e.g. the
    min/max trip date), so the calendar follows the data without a collect.
    Output: DATE (date), HOLIDAY (int = 1)[, NAME].
    """
    s, e = F.col(start_col).cast("date"), F.col(end_col).cast("date")
    years = bounds.select(
        s.alias("_S"), e.alias("_E"),
        # the year after the range can observe New Year's Day on Dec 31
        F.explode(F.sequence(F.year(s), F.year(e) + 1)).alias("_Y"))
    rules = years.select("*", F.explode(_rules_column()).alias("_R"))
    dated = rules.select("_S", "_E", F.col("_R.NAME").alias("NAME"),
                         F.col("_R.FIRST").alias("_F"),
                         _rule_date(F.col("_Y"), F.col("_R")).alias("DATE"))
    out = (dated.filter((F.col("DATE") >= F.col("_S")) & (F.col("DATE") <= F.col("_E"))
                        & (F.col("_F").isNull() | (F.col("DATE") >= F.col("_F"))))
           .select("DATE", F.lit(1).alias("HOLIDAY"), "NAME"))
    return out if with_names else out.drop("NAME")


def generate_holidays(spark: SparkSession, start: str = HOLIDAY_START,
                      days: int = HOLIDAY_DAYS) -> DataFrame:
    """The reference's default: ``days`` days from ``start`` (20 years from 2013)."""
    end = (dt.date.fromisoformat(start) + dt.timedelta(days=days)).isoformat()
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("START"),
                                   F.lit(end).cast("date").alias("END"))
    return holidays_for_range(bounds)
