"""H2-H6, H9: weather, feature tables, forecast calendar, ACF, time split."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..config import CUTPOINT, FORECAST_STEPS, LAGS, MIN_DAYS, WEATHER_POSTCODE
from . import relational as R
from .clean import null_token_to_null

DATE, STATION, COUNT = R.DATE, R.STATION, R.COUNT


def weather_daily(source: DataFrame, postcode: str = WEATHER_POSTCODE) -> DataFrame:
    """H2: one location's daily precipitation and temperature (2 places).

    The postcode filter is pushed to the scan (or below the source's
    aggregate); PRECIP and TEMP are decimal(10,2), as the model tables use.
    """
    return (source.filter(F.col("POSTAL_CODE") == postcode)
            .select(F.col("DATE_VALID_STD").cast("date").alias(DATE),
                    F.round(F.col("TOT_PRECIPITATION_MM"), 2).cast("decimal(10,2)").alias("PRECIP"),
                    F.round(F.col("AVG_TEMPERATURE_FEELSLIKE_2M_C"), 2).cast("decimal(10,2)").alias("TEMP")))


def feature_table(trips: DataFrame, holidays: DataFrame, weather: DataFrame,
                  lags=LAGS, min_days: int = MIN_DAYS,
                  station_col: str = "START_STATION_ID", time_col: str = "STARTTIME") -> DataFrame:
    """H3: D1 -> E1 -> B8 -> C1 -> C2 -> E3 -> E4 -> B4.

    Plan: one partial+final aggregate shuffled on (station, day); one shuffle
    on station shared by the lag, day-count and max-date windows (the DATE
    joins are broadcast and keep that partitioning).  The latest date is a
    scalar subquery, not a driver collect: max(DATE) of the daily relation
    (Catalyst reduces it to a max over the one scanned time column).
    """
    return feature_table_daily(R.daily_counts(trips, station_col, time_col), holidays, weather,
                               lags, min_days)


def feature_table_daily(daily: DataFrame, holidays: DataFrame, weather: DataFrame,
                        lags=LAGS, min_days: int = MIN_DAYS) -> DataFrame:
    """H3 from a (STATION_ID, DATE, COUNT) relation, e.g. the per-load daily
    counts kept next to TRIPS, so a run need not scan the trips again."""
    latest = daily.select(F.max(DATE)).scalar()
    feats = R.lag_features(daily, lags).na.drop(how="any")
    feats = R.join_left_holiday(feats, holidays)
    feats = R.join_inner_weather(feats, weather)
    feats = R.keep_min_days(feats, min_days)
    feats = R.keep_recent(feats, latest)
    return feats.select(STATION, DATE, COUNT, *[f"LAG_{k}" for k in lags], "HOLIDAY", "PRECIP", "TEMP")


def feature_table_single(trips: DataFrame, holidays: DataFrame, weather: DataFrame,
                         lags=LAGS, station_col: str = "START_STATION_ID",
                         time_col: str = "STARTTIME") -> DataFrame:
    """H4: B10 -> D1 -> D6 -> E2 -> C1 -> C2 -> B8 with default-filled lags.

    The reference ran this on one pre-filtered station with an unpartitioned
    window; here the window is per station, so it runs on any number of them.
    """
    cleaned = null_token_to_null(trips, station_col)
    daily = R.daily_counts(cleaned, station_col, time_col)
    feats = R.lag_with_default(daily, lags)
    feats = R.join_left_holiday(feats, holidays)
    feats = R.join_inner_weather(feats, weather)
    return (feats.na.drop(how="any")
            .select(STATION, DATE, COUNT, *[f"LAG_{k}" for k in lags], "HOLIDAY", "PRECIP", "TEMP"))


def forecast_calendar(trips: DataFrame, holidays: DataFrame, weather: DataFrame,
                      steps: int = FORECAST_STEPS, time_col: str = "STARTTIME") -> DataFrame:
    """H5: future days last-trip-date+1 ... +1+steps (inclusive) with holiday and weather.

    The date range comes from a one-row aggregate (no collect); holidays are
    right-joined onto the weather days that fall into that range.
    """
    return forecast_calendar_from(trips.select(F.to_date(F.max(time_col))), holidays, weather, steps)


def forecast_calendar_from(latest: DataFrame, holidays: DataFrame, weather: DataFrame,
                           steps: int = FORECAST_STEPS) -> DataFrame:
    """H5 from a one-row relation holding the last trip date."""
    start = F.date_add(latest.scalar(), 1)
    w = weather.select(DATE, "PRECIP", "TEMP").filter(
        (F.col(DATE) >= start) & (F.col(DATE) <= F.date_add(start, steps)))
    return R.join_right_calendar(holidays, w).orderBy(DATE)


def autocorrelation(daily: DataFrame, lags=(1, 7, 30, 60, 90, 365), key: str = STATION,
                    value: str = COUNT) -> DataFrame:
    """H6: sample ACF per station at the given lags (statsmodels' definition).

    acf(k) = sum_t (y_t - m)(y_{t+k} - m) / sum_t (y_t - m)^2 over each
    station's series in date order; a null station is a station, negative
    lags are refused.  All lags are one numpy pass per station: a station's
    group holds one row per day, so it is bounded by the calendar, not by
    the number of trips.
    """
    lags = [int(k) for k in lags]
    if any(k < 0 for k in lags):
        raise ValueError("lags must not be negative")
    schema = T.StructType([T.StructField(key, daily.schema[key].dataType),
                           T.StructField("LAG", T.IntegerType()), T.StructField("ACF", T.DoubleType())])

    def acf(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(DATE)[value].astype(float).to_numpy()
        d = y - y.mean()
        den = float(d @ d)
        vals = []
        for k in lags:
            num = float(d[:-k] @ d[k:]) if 0 < k < len(d) else (den if k == 0 else 0.0)
            vals.append(num / den if den > 0 else None)
        return pd.DataFrame({key: pdf[key].iloc[0], "LAG": lags, "ACF": vals})

    return daily.select(key, DATE, value).groupBy(key).applyInPandas(acf, schema)


def time_split(df: DataFrame, cutpoint: int = CUTPOINT, key: str = STATION,
               order: str = DATE) -> DataFrame:
    """H9: IS_VALID = the station's last ``cutpoint`` rows; training is the rest."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return (df.withColumn("_RN", F.row_number().over(w))
              .withColumn("IS_VALID", F.col("_RN") <= cutpoint).drop("_RN"))
