"""Registered queries for projections, joins, aggregates, windows, reshape and scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import columns as G
from ..functions import dates as GD
from ..operators import clean as B
from ..operators import features as H
from ..operators import relational as R
from ..plans.ingest import CONFORMED_COLUMNS
from . import BASE, TRIPS, register, with_ctes

CONF = ", ".join(CONFORMED_COLUMNS)

RAW1 = """raw1 AS (
  SELECT CAST(o_totalprice AS VARCHAR) AS TRIPDURATION,
         strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS STARTTIME,
         strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS STOPTIME,
         o_orderpriority AS START_STATION_ID, o_orderpriority AS START_STATION_NAME,
         CAST(NULL AS VARCHAR) AS START_STATION_LATITUDE, CAST(NULL AS VARCHAR) AS START_STATION_LONGITUDE,
         CAST(o_custkey AS VARCHAR) AS END_STATION_ID, CAST(o_custkey AS VARCHAR) AS END_STATION_NAME,
         CAST(NULL AS VARCHAR) AS END_STATION_LATITUDE, CAST(NULL AS VARCHAR) AS END_STATION_LONGITUDE,
         CAST(o_orderkey AS VARCHAR) AS BIKEID, o_orderstatus AS USERTYPE,
         CAST(NULL AS VARCHAR) AS BIRTH_YEAR, CAST(NULL AS VARCHAR) AS GENDER,
         o_orderdate AS _ORIG
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')"""

RAW2 = """raw2 AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ride_id, 'classic_bike' AS rideable_type,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS STARTTIME,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS STOPTIME,
         o_orderpriority AS START_STATION_NAME, o_orderpriority AS START_STATION_ID,
         CAST(o_custkey AS VARCHAR) AS END_STATION_NAME, CAST(o_custkey AS VARCHAR) AS END_STATION_ID,
         CAST(NULL AS VARCHAR) AS START_STATION_LATITUDE, CAST(NULL AS VARCHAR) AS START_STATION_LONGITUDE,
         CAST(NULL AS VARCHAR) AS END_STATION_LATITUDE, CAST(NULL AS VARCHAR) AS END_STATION_LONGITUDE,
         o_orderstatus AS USERTYPE
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""

DAILY = """daily AS (
  SELECT START_STATION_ID AS STATION_ID, CAST(STARTTIME AS DATE) AS DATE, count(*) AS "COUNT"
  FROM trips GROUP BY 1, 2)"""

PREDS = """preds AS (
  SELECT l_returnflag AS STATION_ID, CAST(l_shipdate AS DATE) AS DATE, l_quantity AS y_true,
         l_quantity * (1.0 + l_discount - 0.05) AS y_score
  FROM lineitem)"""

EXPLAINED = """explained AS (
  SELECT l_returnflag AS STATION_ID, CAST(l_shipdate AS DATE) AS DATE,
         CAST(l_quantity AS INTEGER) AS PRED, 0 AS HOLIDAY,
         CAST(round(l_quantity / 50, 2) AS DECIMAL(10,2)) AS EXPL_LAG_1,
         CAST(round(l_discount * 10, 2) AS DECIMAL(10,2)) AS EXPL_LAG_7,
         CAST(round(l_tax * 10, 2) AS DECIMAL(10,2)) AS EXPL_LAG_90,
         CAST(0 AS DECIMAL(10,2)) AS EXPL_LAG_365, CAST(0 AS DECIMAL(10,2)) AS EXPL_HOLIDAY,
         CAST(0 AS DECIMAL(10,2)) AS EXPL_PRECIP, CAST(0 AS DECIMAL(10,2)) AS EXPL_TEMP
  FROM lineitem)"""

EXPL = ["EXPL_LAG_1", "EXPL_LAG_7", "EXPL_LAG_90", "EXPL_LAG_365", "EXPL_HOLIDAY", "EXPL_PRECIP", "EXPL_TEMP"]
REASON_SQL = "CASE " + " ".join(f"WHEN {c} = EXPLAIN THEN '{c}'" for c in EXPL) + " END"
GREATEST_SQL = f"greatest({', '.join(EXPL)})"


def _daily(spark, sf_dir):
    return R.daily_counts(fx.trips(spark, sf_dir))


# ------------------------------------------------------------------ B

@register("project_conformed", with_ctes(RAW2) + f"SELECT {CONF} FROM raw2")
def project_conformed(spark, sf_dir):
    return B.project(fx.raw_schema2(spark, sf_dir), CONFORMED_COLUMNS)


@register("select_alias", with_ctes(TRIPS) +
          "SELECT CAST(STARTTIME AS DATE) AS DATE, START_STATION_ID AS STATION_ID FROM trips")
def select_alias(spark, sf_dir):
    return B.select_alias(fx.trips(spark, sf_dir), {"DATE": F.to_date("STARTTIME"),
                                                    "STATION_ID": "START_STATION_ID"})


@register("with_column", with_ctes(TRIPS) +
          "SELECT *, CAST(STARTTIME AS DATE) AS DATE, CAST(year(STARTTIME) AS INTEGER) AS YEAR FROM trips")
def with_column(spark, sf_dir):
    return B.with_columns(fx.trips(spark, sf_dir), {"DATE": F.to_date("STARTTIME"),
                                                    "YEAR": F.year("STARTTIME")})


@register("drop_columns", with_ctes(TRIPS) + "SELECT STARTTIME, START_STATION_ID, USERTYPE FROM trips")
def drop_columns(spark, sf_dir):
    return B.drop_columns(fx.trips(spark, sf_dir), "STOPTIME", "START_STATION_NAME")


@register("filter_eq", with_ctes(TRIPS) + "SELECT * FROM trips WHERE START_STATION_ID = '1-URGENT'")
def filter_eq(spark, sf_dir):
    return B.filter_eq(fx.trips(spark, sf_dir), "START_STATION_ID", "1-URGENT")


@register("filter_not_null", with_ctes(TRIPS) + "SELECT * FROM trips WHERE START_STATION_ID IS NOT NULL")
def filter_not_null(spark, sf_dir):
    return B.filter_not_null(fx.trips(spark, sf_dir), "START_STATION_ID")


@register("filter_in_date_range", with_ctes(TRIPS, DAILY) +
          "SELECT * FROM daily WHERE STATION_ID IN ('1-URGENT', '5-LOW') "
          "AND DATE >= DATE '1996-01-01' AND DATE <= DATE '1999-12-31'")
def filter_in_date_range(spark, sf_dir):
    return B.filter_in_date_range(_daily(spark, sf_dir), "STATION_ID", ["1-URGENT", "5-LOW"],
                                  "DATE", "1996-01-01", "1999-12-31")


@register("drop_null_rows", with_ctes(TRIPS, DAILY) + """
SELECT * FROM (SELECT *, lag("COUNT", 7) OVER (PARTITION BY STATION_ID ORDER BY DATE) AS LAG_7 FROM daily)
WHERE LAG_7 IS NOT NULL""")
def drop_null_rows(spark, sf_dir):
    return B.drop_null_rows(R.lag_features(_daily(spark, sf_dir), (7,)))


@register("fill_null", with_ctes(*BASE, DAILY) + """
SELECT d.STATION_ID, d.DATE, coalesce(h.HOLIDAY, 0) AS HOLIDAY
FROM daily d LEFT JOIN holidays h ON d.DATE = h.DATE""")
def fill_null(spark, sf_dir):
    d = _daily(spark, sf_dir).join(fx.holidays(spark, sf_dir), "DATE", "left")
    return B.fill_null(d, {"HOLIDAY": 0}).select("STATION_ID", "DATE", "HOLIDAY")


@register("replace_value", with_ctes(TRIPS) +
          "SELECT STARTTIME, START_STATION_ID, nullif(USERTYPE, 'F') AS USERTYPE FROM trips")
def replace_value(spark, sf_dir):
    t = fx.trips(spark, sf_dir).select("STARTTIME", "START_STATION_ID", "USERTYPE")
    return B.null_token_to_null(t, "USERTYPE", "F")


@register("case_reason", with_ctes(EXPLAINED) + f"""
SELECT STATION_ID, DATE, EXPLAIN, {REASON_SQL} AS REASON
FROM (SELECT *, {GREATEST_SQL} AS EXPLAIN FROM explained)""")
def case_reason(spark, sf_dir):
    return B.explain_reason(fx.explained(spark, sf_dir), EXPL).select("STATION_ID", "DATE", "EXPLAIN", "REASON")


@register("literal_column", with_ctes(TRIPS, DAILY) +
          "SELECT *, DATE '2001-09-01' AS RUN_DATE, 1 AS FLAG FROM daily")
def literal_column(spark, sf_dir):
    d = B.literal_column(_daily(spark, sf_dir), "RUN_DATE", "2001-09-01", "date")
    return B.literal_column(d, "FLAG", 1)


@register("rename_columns", with_ctes(PREDS) +
          "SELECT STATION_ID, DATE, y_true AS \"COUNT\", y_score AS PRED FROM preds")
def rename_columns(spark, sf_dir):
    return B.rename_columns(fx.preds(spark, sf_dir), {"y_true": "COUNT", "y_score": "PRED"})


# ------------------------------------------------------------------ C

@register("join_left_holiday", with_ctes(*BASE, DAILY) + """
SELECT d.*, coalesce(h.HOLIDAY, 0) AS HOLIDAY FROM daily d LEFT JOIN holidays h ON d.DATE = h.DATE""")
def join_left_holiday(spark, sf_dir):
    return R.join_left_holiday(_daily(spark, sf_dir), fx.holidays(spark, sf_dir))


@register("join_inner_weather", with_ctes(*BASE, DAILY) + """
SELECT d.*, w.PRECIP, w.TEMP FROM daily d JOIN weather w ON d.DATE = w.DATE""")
def join_inner_weather(spark, sf_dir):
    return R.join_inner_weather(_daily(spark, sf_dir), fx.weather(spark, sf_dir))


@register("join_right_calendar", with_ctes(*BASE) + """
SELECT w.DATE, coalesce(h.HOLIDAY, 0) AS HOLIDAY, w.PRECIP, w.TEMP
FROM holidays h RIGHT JOIN weather w ON h.DATE = w.DATE""")
def join_right_calendar(spark, sf_dir):
    return R.join_right_calendar(fx.holidays(spark, sf_dir), fx.weather(spark, sf_dir))


@register("cross_one_row", with_ctes(*BASE, DAILY) + """
, fc AS (SELECT w.DATE FROM weather w
         WHERE w.DATE >= (SELECT CAST(max(STARTTIME) AS DATE) + 1 FROM trips)
           AND w.DATE <= (SELECT CAST(max(STARTTIME) AS DATE) + 31 FROM trips))
SELECT d.*, (SELECT count(*) FROM fc) AS N_FORECAST, (SELECT min(DATE) FROM fc) AS FIRST_FORECAST_DATE
FROM daily d""")
def cross_one_row(spark, sf_dir):
    t = fx.trips(spark, sf_dir)
    fc = H.forecast_calendar(t, fx.holidays(spark, sf_dir), fx.weather(spark, sf_dir))
    packed = R.collect_rows(fc, ["DATE", "HOLIDAY", "PRECIP", "TEMP"], "DATE", name="FORECAST_DATA")
    out = R.attach_one_row(R.daily_counts(t), packed, "FORECAST_DATA")
    return out.select("STATION_ID", "DATE", "COUNT", F.size("FORECAST_DATA").cast("bigint").alias("N_FORECAST"),
                      F.col("FORECAST_DATA")[0]["DATE"].alias("FIRST_FORECAST_DATE"))


# ------------------------------------------------------------------ D

@register("daily_counts", with_ctes(TRIPS, DAILY) + "SELECT * FROM daily")
def daily_counts(spark, sf_dir):
    return _daily(spark, sf_dir)


@register("trips_per_day", with_ctes(TRIPS) +
          'SELECT CAST(STARTTIME AS DATE) AS DATE, count(*) AS "COUNT" FROM trips GROUP BY 1 ORDER BY 1')
def trips_per_day(spark, sf_dir):
    return R.trips_per_day(fx.trips(spark, sf_dir))


@register("row_count", with_ctes(TRIPS) + "SELECT count(*) AS N FROM trips")
def row_count(spark, sf_dir):
    return R.row_count(fx.trips(spark, sf_dir))


@register("min_max_time", with_ctes(TRIPS) +
          "SELECT min(STARTTIME) AS MIN_STARTTIME, max(STARTTIME) AS MAX_STARTTIME FROM trips")
def min_max_time(spark, sf_dir):
    return R.min_max(fx.trips(spark, sf_dir), "STARTTIME")


@register("latest_date", with_ctes(TRIPS) + """
SELECT CAST(max(STARTTIME) AS DATE) AS LATEST_DATE,
       strftime(CAST(max(STARTTIME) AS DATE), '%Y-%m-%d') AS LATEST_DATE_TEXT FROM trips""")
def latest_date(spark, sf_dir):
    return R.latest_date(fx.trips(spark, sf_dir))


@register("mean_of_first_n", with_ctes(TRIPS, DAILY) + """
SELECT STATION_ID,
  CAST(round_even(avg(CASE WHEN RN <= 1 THEN "COUNT" END), 0) AS BIGINT) AS MEAN_1,
  CAST(round_even(avg(CASE WHEN RN <= 7 THEN "COUNT" END), 0) AS BIGINT) AS MEAN_7,
  CAST(round_even(avg(CASE WHEN RN <= 90 THEN "COUNT" END), 0) AS BIGINT) AS MEAN_90,
  CAST(round_even(avg(CASE WHEN RN <= 365 THEN "COUNT" END), 0) AS BIGINT) AS MEAN_365
FROM (SELECT *, row_number() OVER (PARTITION BY STATION_ID ORDER BY DATE) AS RN FROM daily)
GROUP BY STATION_ID""")
def mean_of_first_n(spark, sf_dir):
    return R.mean_of_first_n(_daily(spark, sf_dir))


@register("min_of_group_max", with_ctes(TRIPS, DAILY) +
          "SELECT min(M) AS MIN_MAX_DATE FROM (SELECT STATION_ID, max(DATE) AS M FROM daily GROUP BY 1)")
def min_of_group_max(spark, sf_dir):
    return R.min_of_group_max(_daily(spark, sf_dir))


@register("min_day_count", with_ctes(TRIPS, DAILY) +
          "SELECT min(C) AS MIN_DAY_COUNT FROM (SELECT STATION_ID, count(*) AS C FROM daily GROUP BY 1)")
def min_day_count(spark, sf_dir):
    return R.min_day_count(_daily(spark, sf_dir))


@register("count_distinct_stations", with_ctes(TRIPS) +
          "SELECT count(DISTINCT START_STATION_ID) AS N_STATIONS FROM trips")
def count_distinct_stations(spark, sf_dir):
    return R.count_distinct(fx.trips(spark, sf_dir), "START_STATION_ID")


@register("collect_rows", with_ctes(TRIPS, DAILY) + """
SELECT STATION_ID, count(*) AS N_ROWS, min(DATE) AS FIRST_DATE, arg_max("COUNT", DATE) AS LAST_COUNT
FROM daily GROUP BY STATION_ID""")
def collect_rows(spark, sf_dir):
    packed = R.collect_rows(_daily(spark, sf_dir), ["DATE", "COUNT"], "DATE", key="STATION_ID")
    return packed.select("STATION_ID", F.size("ROWS").cast("bigint").alias("N_ROWS"),
                         F.col("ROWS")[0]["DATE"].alias("FIRST_DATE"),
                         F.element_at("ROWS", -1)["COUNT"].alias("LAST_COUNT"))


HOURLY_SQL = """hourly AS (
  SELECT CAST((l_shipdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS DATE,
         l_discount AS RAIN, l_quantity + 250.0 AS TEMP_K FROM lineitem)"""


@register("daily_weather", with_ctes(HOURLY_SQL) + """
SELECT DATE, coalesce(round(avg(RAIN), 2), 0.0) AS PRECIP,
       coalesce(round(avg(TEMP_K) - 273.15, 2), 0.0) AS TEMP
FROM hourly GROUP BY DATE""")
def daily_weather(spark, sf_dir):
    li = fx.load(spark, sf_dir, "lineitem")
    hourly = li.select(F.col("l_shipdate").alias("TS"), F.col("l_discount").alias("RAIN"),
                       (F.col("l_quantity") + F.lit(250.0)).alias("TEMP_K"))
    return R.daily_weather(hourly)


# ------------------------------------------------------------------ E

def _lag_sql(lags):
    return ", ".join(f'lag("COUNT", {k}) OVER (PARTITION BY STATION_ID ORDER BY DATE) AS LAG_{k}'
                     for k in lags)


@register("lag_features", with_ctes(TRIPS, DAILY) + f"SELECT *, {_lag_sql((1, 7, 90, 365))} FROM daily")
def lag_features(spark, sf_dir):
    return R.lag_features(_daily(spark, sf_dir))


def _lag_default_sql(lags):
    parts = []
    for k in lags:
        parts.append(
            f'coalesce(lag("COUNT", {k}) OVER (PARTITION BY STATION_ID ORDER BY DATE), '
            f'CAST(round_even(avg(CASE WHEN RN <= {k} THEN "COUNT" END) OVER (PARTITION BY STATION_ID), 0) AS BIGINT))'
            f" AS LAG_{k}")
    return ", ".join(parts)


@register("lag_with_default", with_ctes(TRIPS, DAILY) + f"""
SELECT STATION_ID, DATE, "COUNT", {_lag_default_sql((1, 7, 90, 365))}
FROM (SELECT *, row_number() OVER (PARTITION BY STATION_ID ORDER BY DATE) AS RN FROM daily)""")
def lag_with_default(spark, sf_dir):
    return R.lag_with_default(_daily(spark, sf_dir))


@register("days_per_station", with_ctes(TRIPS, DAILY) + """
SELECT STATION_ID, DATE, "COUNT" FROM (
  SELECT *, count(DATE) OVER (PARTITION BY STATION_ID) AS DC FROM daily) WHERE DC >= 1720""")
def days_per_station(spark, sf_dir):
    return R.keep_min_days(_daily(spark, sf_dir), 1720)


@register("recent_stations", with_ctes(TRIPS, DAILY) + """
SELECT STATION_ID, DATE, "COUNT" FROM (
  SELECT *, max(DATE) OVER (PARTITION BY STATION_ID) AS MD FROM daily)
WHERE MD = (SELECT CAST(max(STARTTIME) AS DATE) FROM trips)""")
def recent_stations(spark, sf_dir):
    t = fx.trips(spark, sf_dir)
    return R.keep_recent(R.daily_counts(t), t.select(F.to_date(F.max("STARTTIME"))).scalar())


ROLL_SQL = """rolled AS (
  SELECT *, CASE WHEN count("COUNT") OVER w7 = 7 THEN avg("COUNT") OVER w7 END AS ROLL_7
  FROM daily WINDOW w7 AS (PARTITION BY STATION_ID ORDER BY DATE ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


@register("rolling_mean_7", with_ctes(TRIPS, DAILY, ROLL_SQL) +
          'SELECT STATION_ID, DATE, "COUNT", round(ROLL_7, 6) AS ROLL_7 FROM rolled')
def rolling_mean_7(spark, sf_dir):
    d = R.rolling_mean(_daily(spark, sf_dir), 7)
    return d.withColumn("ROLL_7", F.round("ROLL_7", 6))


@register("difference_series", with_ctes(TRIPS, DAILY, ROLL_SQL) + """
SELECT STATION_ID, DATE, round(ROLL_7 - lag(ROLL_7, 1) OVER (PARTITION BY STATION_ID ORDER BY DATE), 6) AS DIFF_ROLL_7
FROM rolled""")
def difference_series(spark, sf_dir):
    d = R.difference(R.rolling_mean(_daily(spark, sf_dir), 7), "ROLL_7")
    return d.select("STATION_ID", "DATE", F.round("DIFF_ROLL_7", 6).alias("DIFF_ROLL_7"))


# ------------------------------------------------------------------ F

@register("sort_by_date", with_ctes(*BASE) + "SELECT * FROM weather ORDER BY DATE")
def sort_by_date(spark, sf_dir):
    return R.sort_by_date(fx.weather(spark, sf_dir))


@register("top_stations", with_ctes(TRIPS) + """
SELECT START_STATION_ID AS STATION_ID, count(*) AS "COUNT" FROM trips WHERE START_STATION_ID IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 3""")
def top_stations(spark, sf_dir):
    return R.top_stations(fx.trips(spark, sf_dir), 3)


@register("head_n", with_ctes(TRIPS) +
          'SELECT CAST(STARTTIME AS DATE) AS DATE, count(*) AS "COUNT" FROM trips GROUP BY 1 ORDER BY 1 LIMIT 10')
def head_n(spark, sf_dir):
    return R.head_n(R.trips_per_day(fx.trips(spark, sf_dir)), [F.col("DATE")], 10)


@register("tail_n", with_ctes(TRIPS, DAILY) + """
SELECT STATION_ID, DATE, "COUNT" FROM (
  SELECT *, row_number() OVER (PARTITION BY STATION_ID ORDER BY DATE DESC) AS RN FROM daily) WHERE RN <= 30""")
def tail_n(spark, sf_dir):
    return R.tail_n(_daily(spark, sf_dir), 30)


@register("union_by_name", with_ctes(RAW1, RAW2) +
          f"SELECT {CONF} FROM raw1 UNION ALL SELECT {CONF} FROM raw2")
def union_by_name(spark, sf_dir):
    a = B.project(fx.raw_schema1(spark, sf_dir), CONFORMED_COLUMNS)
    b = B.project(fx.raw_schema2(spark, sf_dir), list(reversed(CONFORMED_COLUMNS)))
    return R.union_by_name(a, b)


@register("distinct_stations", with_ctes(TRIPS) + "SELECT DISTINCT START_STATION_ID AS STATION_ID FROM trips")
def distinct_stations(spark, sf_dir):
    return R.distinct_values(fx.trips(spark, sf_dir).withColumnRenamed("START_STATION_ID", "STATION_ID"))


@register("unpivot_series", with_ctes(PREDS) + """
SELECT STATION_ID, DATE, 'y_true' AS SERIES, y_true AS VALUE FROM preds
UNION ALL SELECT STATION_ID, DATE, 'y_score' AS SERIES, y_score AS VALUE FROM preds""")
def unpivot_series(spark, sf_dir):
    return R.unpivot_series(fx.preds(spark, sf_dir), ["STATION_ID", "DATE"], ["y_true", "y_score"])


RMSE_SQL = """yearly AS (
  SELECT CAST(date_trunc('year', DATE) AS DATE) AS RUN_DATE, STATION_ID,
         round(sqrt(avg((y_true - y_score) * (y_true - y_score))), 4) AS RMSE
  FROM preds GROUP BY 1, 2)"""
PIVOT_KEYS = ["A", "N", "R", "X"]


@register("pivot_metric", with_ctes(PREDS, RMSE_SQL) + """
SELECT r.RUN_DATE, k.STATION_ID, y.RMSE
FROM (SELECT DISTINCT RUN_DATE FROM yearly) r
CROSS JOIN (VALUES ('A'), ('N'), ('R'), ('X')) k(STATION_ID)
LEFT JOIN yearly y ON y.RUN_DATE = r.RUN_DATE AND y.STATION_ID = k.STATION_ID""")
def pivot_metric(spark, sf_dir):
    p = fx.preds(spark, sf_dir)
    yearly = (p.groupBy(F.trunc("DATE", "year").alias("RUN_DATE"), "STATION_ID")
              .agg(F.round(F.sqrt(F.avg((F.col("y_true") - F.col("y_score")) ** 2)), 4).alias("RMSE")))
    return R.pivot_to_long(yearly, "RUN_DATE", "STATION_ID", "RMSE", PIVOT_KEYS)


# ------------------------------------------------------------------ G

@register("normalize_datetime", with_ctes(RAW1) + r"""
SELECT BIKEID, regexp_replace(STARTTIME,
  '^([0-9]?[0-9])/([0-9]?[0-9])/([0-9][0-9][0-9][0-9]) ([0-9]?[0-9]):([0-9][0-9])(:[0-9][0-9])?.*$',
  '\3-\1-\2 \4:\5\6') AS STARTTIME FROM raw1""")
def normalize_datetime(spark, sf_dir):
    r = fx.raw_schema1(spark, sf_dir)
    return r.select("BIKEID", GD.normalize_datetime("STARTTIME").alias("STARTTIME"))


@register("to_timestamp", with_ctes(RAW1) + "SELECT BIKEID, _ORIG AS STARTTIME FROM raw1")
def to_timestamp(spark, sf_dir):
    r = fx.raw_schema1(spark, sf_dir)
    return r.select("BIKEID", GD.parse_timestamp(GD.normalize_datetime("STARTTIME")).alias("STARTTIME"))


@register("to_date", with_ctes(TRIPS) + "SELECT STARTTIME, CAST(STARTTIME AS DATE) AS DATE FROM trips")
def to_date(spark, sf_dir):
    t = fx.trips(spark, sf_dir)
    return t.select("STARTTIME", GD.to_day("STARTTIME").alias("DATE"))


@register("date_trunc_day", with_ctes(TRIPS) +
          "SELECT START_STATION_ID, date_trunc('day', STARTTIME) AS DAY FROM trips")
def date_trunc_day(spark, sf_dir):
    t = fx.trips(spark, sf_dir)
    return t.select("START_STATION_ID", GD.trunc_day("STARTTIME").cast("timestamp_ntz").alias("DAY"))


@register("date_to_char", with_ctes(TRIPS, DAILY) +
          "SELECT DISTINCT strftime(DATE, '%Y-%m-%d') AS DATE_TEXT FROM daily")
def date_to_char(spark, sf_dir):
    return _daily(spark, sf_dir).select(GD.date_text("DATE").alias("DATE_TEXT")).distinct()


@register("date_add_days", with_ctes(TRIPS) + """
SELECT CAST(max(STARTTIME) AS DATE) + 1 AS START_DATE, CAST(max(STARTTIME) AS DATE) + 31 AS END_DATE FROM trips""")
def date_add_days(spark, sf_dir):
    d = F.to_date(F.max("STARTTIME"))
    return fx.trips(spark, sf_dir).agg(GD.add_days(d, 1).alias("START_DATE"), GD.add_days(d, 31).alias("END_DATE"))


@register("month_arith", with_ctes(TRIPS) + """
SELECT CAST(date_trunc('month', CAST(max(STARTTIME) AS DATE) + INTERVAL 1 MONTH) AS DATE) AS NEXT_INGEST,
       strftime(CAST(date_trunc('month', CAST(max(STARTTIME) AS DATE) + INTERVAL 1 MONTH) AS DATE) + INTERVAL 1 MONTH,
                '%Y_%m_%d') AS RUN_DATE FROM trips""")
def month_arith(spark, sf_dir):
    d = F.to_date(F.max("STARTTIME"))
    nxt = GD.next_month_start(d)
    return fx.trips(spark, sf_dir).agg(nxt.alias("NEXT_INGEST"),
                                       GD.run_date_text(F.add_months(nxt, 1)).alias("RUN_DATE"))


@register("parse_run_date", with_ctes(TRIPS, DAILY) + """
SELECT DISTINCT strftime(DATE, '%Y_%m_%d') AS RUN_DATE_TEXT, DATE AS RUN_DATE FROM daily""")
def parse_run_date(spark, sf_dir):
    txt = _daily(spark, sf_dir).select(GD.run_date_text("DATE").alias("RUN_DATE_TEXT")).distinct()
    return txt.withColumn("RUN_DATE", GD.parse_run_date("RUN_DATE_TEXT"))


@register("round2", with_ctes(PREDS) + "SELECT STATION_ID, DATE, y_true, round(y_score, 2) AS Y_SCORE_2 FROM preds")
def round2(spark, sf_dir):
    p = fx.preds(spark, sf_dir)
    return p.select("STATION_ID", "DATE", "y_true", G.round2("y_score").alias("Y_SCORE_2"))


@register("greatest_of", with_ctes(EXPLAINED) + f"SELECT STATION_ID, DATE, {GREATEST_SQL} AS EXPLAIN FROM explained")
def greatest_of(spark, sf_dir):
    e = fx.explained(spark, sf_dir)
    return e.select("STATION_ID", "DATE", G.greatest_of(*EXPL).alias("EXPLAIN"))


@register("utc_to_local_date", """
SELECT l_orderkey, l_linenumber,
       CAST((l_shipdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS LOCAL_DATE
FROM lineitem""")
def utc_to_local_date(spark, sf_dir):
    li = fx.load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", GD.utc_to_local_date("l_shipdate").alias("LOCAL_DATE"))


@register("fourier_terms", with_ctes(TRIPS, DAILY) + """
SELECT DISTINCT DATE,
  round(sin(2 * pi() * 1 * dayofyear(DATE) / 365.25), 6) AS SIN_1,
  round(cos(2 * pi() * 1 * dayofyear(DATE) / 365.25), 6) AS COS_1,
  round(sin(2 * pi() * 2 * dayofyear(DATE) / 365.25), 6) AS SIN_2,
  round(cos(2 * pi() * 2 * dayofyear(DATE) / 365.25), 6) AS COS_2
FROM daily""")
def fourier_terms(spark, sf_dir):
    d = _daily(spark, sf_dir).select("DATE").distinct()
    return d.select("DATE", *[F.round(c, 6).alias(n) for n, c in GD.fourier_terms("DATE").items()])


@register("category_codes", with_ctes(EXPLAINED) + f"""
, r AS (SELECT STATION_ID, DATE, PRED, {REASON_SQL} AS REASON
        FROM (SELECT *, {GREATEST_SQL} AS EXPLAIN FROM explained)),
codes AS (SELECT REASON, CAST(dense_rank() OVER (ORDER BY REASON) - 1 AS INTEGER) AS CODE
          FROM (SELECT DISTINCT REASON FROM r WHERE REASON IS NOT NULL))
SELECT r.STATION_ID, r.DATE, r.PRED, r.REASON, coalesce(c.CODE, -1) AS CODE
FROM r LEFT JOIN codes c ON r.REASON = c.REASON""")
def category_codes(spark, sf_dir):
    e = B.explain_reason(fx.explained(spark, sf_dir), EXPL).select("STATION_ID", "DATE", "PRED", "REASON")
    return G.category_codes(e, "REASON")


@register("array_construct", with_ctes(TRIPS, DAILY) + f"""
SELECT STATION_ID, DATE, [LAG_1, LAG_7] AS LAGS FROM (SELECT *, {_lag_sql((1, 7))} FROM daily)""")
def array_construct(spark, sf_dir):
    d = R.lag_features(_daily(spark, sf_dir), (1, 7))
    return d.select("STATION_ID", "DATE", G.array_of("LAG_1", "LAG_7").alias("LAGS"))


@register("array_item", with_ctes(TRIPS, DAILY) + f"""
SELECT STATION_ID, DATE, [LAG_1, LAG_7][2] AS SECOND FROM (SELECT *, {_lag_sql((1, 7))} FROM daily)""")
def array_item(spark, sf_dir):
    d = R.lag_features(_daily(spark, sf_dir), (1, 7))
    return d.select("STATION_ID", "DATE", G.item(G.array_of("LAG_1", "LAG_7"), 1).alias("SECOND"))


JSON_SQL = """js AS (
  SELECT STATION_ID,
         CAST(to_json(list(struct_pack(DATE := strftime(DATE, '%Y-%m-%d'), "COUNT" := "COUNT") ORDER BY DATE))
              AS VARCHAR) AS DOC
  FROM daily GROUP BY STATION_ID)"""


def _station_json(spark, sf_dir):
    d = _daily(spark, sf_dir).select("STATION_ID", "DATE", GD.date_text("DATE").alias("DATE_TEXT"), "COUNT")
    return d.groupBy("STATION_ID").agg(
        G.records_json(F.col("DATE_TEXT").alias("DATE"), "COUNT", order_by="DATE").alias("DOC"))


@register("to_json_records", with_ctes(TRIPS, DAILY, JSON_SQL) + "SELECT STATION_ID, DOC FROM js")
def to_json_records(spark, sf_dir):
    return _station_json(spark, sf_dir)


REC_SCHEMA = "array<struct<DATE:string,COUNT:bigint>>"


@register("parse_json", with_ctes(TRIPS, DAILY) + """
SELECT STATION_ID, count(*) AS N_RECORDS, strftime(min(DATE), '%Y-%m-%d') AS FIRST_DATE FROM daily GROUP BY 1""")
def parse_json(spark, sf_dir):
    doc = G.parse_records("DOC", REC_SCHEMA)
    return _station_json(spark, sf_dir).select(
        "STATION_ID", F.size(doc).cast("bigint").alias("N_RECORDS"), doc[0]["DATE"].alias("FIRST_DATE"))


@register("json_field", with_ctes(TRIPS, DAILY) + """
SELECT STATION_ID, CAST(arg_min("COUNT", DATE) AS INTEGER) AS FIRST_COUNT,
       CAST(arg_min("COUNT", DATE) AS DECIMAL(10,2)) AS FIRST_COUNT_DEC FROM daily GROUP BY 1""")
def json_field(spark, sf_dir):
    first = G.parse_records("DOC", REC_SCHEMA)[0]
    return _station_json(spark, sf_dir).select(
        "STATION_ID", G.json_field(first, "COUNT", "int").alias("FIRST_COUNT"),
        G.json_field(first, "COUNT", "decimal(10,2)").alias("FIRST_COUNT_DEC"))


@register("flatten_array", with_ctes(TRIPS, DAILY) + """
SELECT STATION_ID, strftime(DATE, '%Y-%m-%d') AS DATE, "COUNT" FROM daily""")
def flatten_array(spark, sf_dir):
    return (_station_json(spark, sf_dir)
            .select("STATION_ID", F.inline(G.parse_records("DOC", REC_SCHEMA))))


@register("concat_key", with_ctes(TRIPS) + r"""
SELECT concat_ws('|', coalesce(START_STATION_ID, '\N'), coalesce(CAST(CAST(STARTTIME AS DATE) AS VARCHAR), '\N'),
                 coalesce(USERTYPE, '\N')) AS ROW_KEY FROM trips""")
def concat_key(spark, sf_dir):
    t = fx.trips(spark, sf_dir)
    return t.select(G.concat_key("START_STATION_ID", F.to_date("STARTTIME"), "USERTYPE").alias("ROW_KEY"))


@register("cast_int", with_ctes(PREDS) +
          "SELECT STATION_ID, DATE, CAST(trunc(y_score) AS INTEGER) AS PRED_INT, "
          "CAST(y_true AS DOUBLE) AS Y_TRUE_F FROM preds")
def cast_int(spark, sf_dir):
    p = fx.preds(spark, sf_dir)
    return p.select("STATION_ID", "DATE", G.to_int("y_score").alias("PRED_INT"),
                    G.to_double("y_true").alias("Y_TRUE_F"))
