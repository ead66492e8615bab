"""Registered queries for the domain operators (H: calendar, features, models)."""

from __future__ import annotations


from .. import fixtures as fx
from ..operators import features as H
from . import BASE, features_ctes, register, with_ctes

ENTRY_LAGS = (1, 7)
ENTRY_MIN_DAYS = 60


@register("holiday_calendar", with_ctes(*BASE) + "SELECT DATE, HOLIDAY FROM holidays")
def holiday_calendar(spark, sf_dir):
    """H1 over the years the trips cover."""
    return fx.holidays(spark, sf_dir)


@register("weather_daily", with_ctes(*BASE) + "SELECT DATE, PRECIP, TEMP FROM weather")
def weather_daily(spark, sf_dir):
    return fx.weather(spark, sf_dir)


@register("feature_table", with_ctes(*BASE, *features_ctes()) + "SELECT * FROM features")
def feature_table(spark, sf_dir):
    return H.feature_table(fx.trips(spark, sf_dir), fx.holidays(spark, sf_dir), fx.weather(spark, sf_dir))


@register("feature_table_short",
          with_ctes(*BASE, *features_ctes(ENTRY_LAGS, ENTRY_MIN_DAYS)) + "SELECT * FROM features")
def feature_table_short(spark, sf_dir):
    """H3 with lags 1, 7 and 60 days' coverage (the flagship at sf0.001)."""
    return H.feature_table(fx.trips(spark, sf_dir), fx.holidays(spark, sf_dir), fx.weather(spark, sf_dir),
                           lags=ENTRY_LAGS, min_days=ENTRY_MIN_DAYS)


@register("forecast_calendar", with_ctes(*BASE) + """
, b AS (SELECT CAST(max(STARTTIME) AS DATE) + 1 AS S FROM trips)
SELECT w.DATE, coalesce(h.HOLIDAY, 0) AS HOLIDAY, w.PRECIP, w.TEMP
FROM holidays h RIGHT JOIN weather w ON h.DATE = w.DATE
WHERE w.DATE >= (SELECT S FROM b) AND w.DATE <= (SELECT S + 30 FROM b)""")
def forecast_calendar(spark, sf_dir):
    """H5: the 31 forecast days after the last trip date."""
    return H.forecast_calendar(fx.trips(spark, sf_dir), fx.holidays(spark, sf_dir), fx.weather(spark, sf_dir))


@register("feature_table_single", with_ctes(*BASE) + """
, cleaned AS (SELECT STARTTIME, nullif(START_STATION_ID, 'NULL') AS STATION_ID FROM trips),
daily AS (SELECT STATION_ID, CAST(STARTTIME AS DATE) AS DATE, count(*) AS "COUNT" FROM cleaned GROUP BY 1, 2),
rn AS (SELECT *, row_number() OVER (PARTITION BY STATION_ID ORDER BY DATE) AS RN FROM daily),
lagged AS (SELECT STATION_ID, DATE, "COUNT",""" + ",".join(
    f"""
  coalesce(lag("COUNT", {k}) OVER (PARTITION BY STATION_ID ORDER BY DATE),
           CAST(round_even(avg(CASE WHEN RN <= {k} THEN "COUNT" END) OVER (PARTITION BY STATION_ID), 0) AS BIGINT))
    AS LAG_{k}""" for k in (1, 7, 90, 365)) + """ FROM rn)
SELECT l.*, coalesce(h.HOLIDAY, 0) AS HOLIDAY, w.PRECIP, w.TEMP
FROM lagged l LEFT JOIN holidays h ON l.DATE = h.DATE JOIN weather w ON l.DATE = w.DATE
WHERE l.STATION_ID IS NOT NULL AND w.PRECIP IS NOT NULL AND w.TEMP IS NOT NULL""")
def feature_table_single(spark, sf_dir):
    """H4: default-filled lags, no coverage filters."""
    return H.feature_table_single(fx.trips(spark, sf_dir), fx.holidays(spark, sf_dir), fx.weather(spark, sf_dir))
