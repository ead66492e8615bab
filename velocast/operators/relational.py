"""C-F: joins, aggregations, windows, sort/limit and reshape.

Scale notes
* Every per-station window runs on the *daily* relation (one row per station
  and day, produced by a partially aggregated group-by), so a window
  partition holds at most one row per calendar day no matter how many trips a
  hot station has.
* Calendar-sized dimensions (holidays, weather, forecast days) are joined on
  DATE without a hint: Spark broadcasts them if they are small by bytes, and
  joins by shuffle if not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STATION = "STATION_ID"
DATE = "DATE"
COUNT = "COUNT"


def _station_window(key: str = STATION, order: str | None = DATE) -> Window:
    w = Window.partitionBy(key)
    return w.orderBy(F.col(order).asc()) if order else w


# ---------------------------------------------------------------- C: joins

def join_left_holiday(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """Left join on DATE, missing HOLIDAY -> 0."""
    return df.join(holidays.select(DATE, "HOLIDAY"), DATE, "left").na.fill({"HOLIDAY": 0})


def join_inner_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Inner join on DATE; days without weather are dropped."""
    return df.join(weather.select(DATE, "PRECIP", "TEMP"), DATE, "inner")


def join_right_calendar(holidays: DataFrame, weather: DataFrame) -> DataFrame:
    """Every weather day, with the holiday flag where there is one."""
    return (holidays.select(DATE, "HOLIDAY")
            .join(weather.select(DATE, "PRECIP", "TEMP"), DATE, "right")
            .na.fill({"HOLIDAY": 0})
            .select(DATE, "HOLIDAY", "PRECIP", "TEMP"))


def attach_one_row(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """C4: attach the single value of a one-row relation to every row.

    Expressed as a scalar subquery (evaluated once, inlined as a value), so
    there is no join and no cross product.  ``one_row`` must be an aggregate
    that yields exactly one row and one column.
    """
    return df.withColumn(name, one_row.scalar())


# ------------------------------------------------------- D: aggregations

def daily_counts(trips: DataFrame, station_col: str = "START_STATION_ID",
                 time_col: str = "STARTTIME") -> DataFrame:
    """Trips per (station, day).  Partial aggregation runs before the shuffle."""
    return (trips.select(F.to_date(time_col).alias(DATE), F.col(station_col).alias(STATION))
            .groupBy(STATION, DATE).agg(F.count(F.lit(1)).alias(COUNT)))


def trips_per_day(trips: DataFrame, time_col: str = "STARTTIME") -> DataFrame:
    """Trips per day over all stations, sorted by day."""
    return (trips.select(F.to_date(time_col).alias(DATE)).groupBy(DATE)
            .agg(F.count(F.lit(1)).alias(COUNT)).orderBy(DATE))


def row_count(df: DataFrame, name: str = "N") -> DataFrame:
    """D3: global count as a one-row relation."""
    return df.agg(F.count(F.lit(1)).alias(name))


def min_max(df: DataFrame, col: str) -> DataFrame:
    """Global min and max of ``col``."""
    return df.agg(F.min(col).alias(f"MIN_{col}"), F.max(col).alias(f"MAX_{col}"))


def latest_date(trips: DataFrame, time_col: str = "STARTTIME") -> DataFrame:
    """Date of the latest timestamp, as date and as text (one-row relation)."""
    d = F.to_date(F.max(time_col))
    return trips.agg(d.alias("LATEST_DATE"), F.date_format(d, "yyyy-MM-dd").alias("LATEST_DATE_TEXT"))


def mean_of_first_n(daily: DataFrame, ns=(1, 7, 90, 365), key: str = STATION) -> DataFrame:
    """Per station, mean COUNT over its first n days, rounded half-even.

    One row_number pass, then every n in one conditional aggregate.
    """
    rn = daily.withColumn("_RN", F.row_number().over(_station_window(key)))
    return rn.groupBy(key).agg(*[
        F.bround(F.avg(F.when(F.col("_RN") <= n, F.col(COUNT))), 0).cast("bigint").alias(f"MEAN_{n}")
        for n in ns])


def min_of_group_max(df: DataFrame, key: str = STATION, col: str = DATE) -> DataFrame:
    """Freshness check: the earliest of the per-station latest dates."""
    return (df.groupBy(key).agg(F.max(col).alias("_M"))
            .agg(F.min("_M").alias(f"MIN_MAX_{col}")))


def min_day_count(df: DataFrame, key: str = STATION) -> DataFrame:
    """Coverage check: the smallest per-station day count."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("DAY_COUNT"))
            .agg(F.min("DAY_COUNT").alias("MIN_DAY_COUNT")))


def count_distinct(df: DataFrame, col: str = STATION, name: str = "N_STATIONS") -> DataFrame:
    """Number of distinct values (two-phase distinct aggregate)."""
    return df.agg(F.count_distinct(col).alias(name))


def collect_rows(df: DataFrame, cols: list[str], order_by: str, key: str | None = None,
                 name: str = "ROWS") -> DataFrame:
    """Pack rows into one sorted array of structs (per ``key`` if given).

    Only for bounded groups: one station's daily rows, or a calendar.
    """
    rec = F.struct(F.col(order_by).alias("_K"), F.struct(*cols).alias("_V"))
    packed = F.transform(F.sort_array(F.collect_list(rec)), lambda x: x["_V"]).alias(name)
    return df.groupBy(key).agg(packed) if key else df.agg(packed)


def daily_weather(hourly: DataFrame, time_col: str = "TS", rain_col: str = "RAIN",
                  kelvin_col: str = "TEMP_K", tz: str = "America/New_York") -> DataFrame:
    """D11 (+G11): local-day mean rain and Celsius temperature, rounded 2, NULL -> 0."""
    from ..functions.dates import utc_to_local_date
    return (hourly.select(utc_to_local_date(time_col, tz).alias(DATE), rain_col, kelvin_col)
            .groupBy(DATE)
            .agg(F.round(F.avg(rain_col), 2).alias("PRECIP"),
                 F.round(F.avg(kelvin_col) - F.lit(273.15), 2).alias("TEMP"))
            .na.fill({"PRECIP": 0.0, "TEMP": 0.0}))


# ----------------------------------------------------------- E: windows

def lag_features(daily: DataFrame, lags=(1, 7, 90, 365), key: str = STATION,
                 value: str = COUNT) -> DataFrame:
    """LAG_k of COUNT per station by date; lags count rows present."""
    w = _station_window(key)
    return daily.withColumns({f"LAG_{k}": F.lag(value, k).over(w) for k in lags})


def lag_with_default(daily: DataFrame, lags=(1, 7, 90, 365), key: str = STATION,
                     value: str = COUNT) -> DataFrame:
    """E2 (+D6): LAG_k with the station's rounded mean of its first k rows as default.

    Means and lags share one window partitioning (no extra shuffle).
    """
    w = _station_window(key)
    wall = Window.partitionBy(key)
    rn = daily.withColumn("_RN", F.row_number().over(w))
    cols = {}
    for k in lags:
        mean_k = F.bround(F.avg(F.when(F.col("_RN") <= k, F.col(value))).over(wall), 0).cast("bigint")
        cols[f"LAG_{k}"] = F.coalesce(F.lag(value, k).over(w).cast("bigint"), mean_k)
    return rn.withColumns(cols).drop("_RN")


def keep_min_days(df: DataFrame, min_days: int, key: str = STATION) -> DataFrame:
    """Keep stations with at least ``min_days`` rows."""
    return (df.withColumn("DAY_COUNT", F.count(DATE).over(Window.partitionBy(key)))
              .filter(F.col("DAY_COUNT") >= min_days).drop("DAY_COUNT"))


def keep_recent(df: DataFrame, latest: Column, key: str = STATION) -> DataFrame:
    """Keep stations whose last date equals ``latest`` (a scalar Column)."""
    return (df.withColumn("MAX_DATE", F.max(DATE).over(Window.partitionBy(key)))
              .filter(F.col("MAX_DATE") == latest).drop("MAX_DATE"))


def rolling_mean(df: DataFrame, n: int = 7, key: str = STATION, value: str = COUNT,
                 name: str | None = None) -> DataFrame:
    """E5: n-row rolling mean, NULL until n rows exist."""
    w = _station_window(key).rowsBetween(-(n - 1), 0)
    name = name or f"ROLL_{n}"
    return df.withColumn(name, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))


def difference(df: DataFrame, col: str, key: str = STATION, name: str | None = None) -> DataFrame:
    """Value minus its previous value in date order."""
    w = _station_window(key)
    return df.withColumn(name or f"DIFF_{col}", F.col(col) - F.lag(col, 1).over(w))


# ------------------------------------------- F: sort, limit, set, reshape

def sort_by_date(df: DataFrame, col: str = DATE) -> DataFrame:
    """ascending date order."""
    return df.orderBy(F.col(col).asc())


def top_stations(trips: DataFrame, n: int = 10, station_col: str = "START_STATION_ID") -> DataFrame:
    """busiest stations by trips, ties broken by station id (TakeOrdered)."""
    return (trips.filter(F.col(station_col).isNotNull())
            .groupBy(F.col(station_col).alias(STATION)).agg(F.count(F.lit(1)).alias(COUNT))
            .orderBy(F.col(COUNT).desc(), F.col(STATION).asc()).limit(n))


def head_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """first n rows in an order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def tail_n(df: DataFrame, n: int, key: str = STATION, order: str = DATE) -> DataFrame:
    """last n rows of each station's series."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_RN", F.row_number().over(w)).filter(F.col("_RN") <= n).drop("_RN")


def union_by_name(a: DataFrame, b: DataFrame, allow_missing: bool = False) -> DataFrame:
    """stack two frames by column name, keeping duplicates."""
    return a.unionByName(b, allowMissingColumns=allow_missing)


def distinct_values(df: DataFrame, col: str = STATION) -> DataFrame:
    """distinct value list."""
    return df.select(col).distinct()


def unpivot_series(df: DataFrame, ids: list[str], values: list[str],
                   var: str = "SERIES", val: str = "VALUE") -> DataFrame:
    """wide -> long."""
    return df.unpivot(ids, values, var, val)


def pivot_metric(df: DataFrame, index: str, columns: str, values: str,
                 keys: list[str]) -> DataFrame:
    """F8: wide by ``columns`` (explicit ``keys``, no driver round trip)."""
    return df.groupBy(index).pivot(columns, list(keys)).agg(F.first(values))


def pivot_to_long(df: DataFrame, index: str, columns: str, values: str,
                  keys: list[str]) -> DataFrame:
    """F8: pivot then melt back; missing (index, key) pairs become NULL rows."""
    wide = pivot_metric(df, index, columns, values, keys)
    return wide.unpivot([index], [F.col(f"`{k}`").alias(str(k)) for k in keys], columns, values)
