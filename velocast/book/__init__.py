"""Registered queries: one Spark builder per operator, plus its DuckDB oracle.

``register(name, sql)`` records a callable ``(spark, sf_dir) -> DataFrame``
and, when the operator is SQL-expressible, the equivalent DuckDB text over
the driver's tables.  Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def with_ctes(*ctes: str) -> str:
    """'WITH a AS (...), b AS (...)' from named fragments (dependencies first)."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# ----------------------------------------------------- DuckDB fixture CTEs

TRIPS = """trips AS (
  SELECT o_orderdate AS STARTTIME, o_orderdate AS STOPTIME,
         o_orderpriority AS START_STATION_NAME, o_orderpriority AS START_STATION_ID,
         o_orderstatus AS USERTYPE
  FROM orders)"""

WEATHER_SOURCE = """weather_source AS (
  SELECT l_linestatus AS POSTAL_CODE, CAST(l_shipdate AS DATE) AS DATE_VALID_STD,
         round(sum(l_discount), 2) AS TOT_PRECIPITATION_MM,
         CAST(avg(l_quantity) AS DECIMAL(20,10)) AS AVG_TEMPERATURE_FEELSLIKE_2M_C
  FROM lineitem GROUP BY 1, 2)"""

WEATHER = """weather AS (
  SELECT DATE_VALID_STD AS DATE,
         CAST(round(TOT_PRECIPITATION_MM, 2) AS DECIMAL(10,2)) AS PRECIP,
         CAST(round(AVG_TEMPERATURE_FEELSLIKE_2M_C, 2) AS DECIMAL(10,2)) AS TEMP
  FROM weather_source WHERE POSTAL_CODE = 'O')"""

HOLIDAY_RULES = """hol_rules AS (
  SELECT * FROM (VALUES
    ('fixed', 1, 1, 0, 0, CAST(NULL AS DATE)),
    ('nth', 1, 1, 1, 3, DATE '1986-01-01'),
    ('nth', 2, 1, 1, 3, CAST(NULL AS DATE)),
    ('last', 5, 31, 1, 0, CAST(NULL AS DATE)),
    ('fixed', 6, 19, 0, 0, DATE '2021-06-18'),
    ('fixed', 7, 4, 0, 0, CAST(NULL AS DATE)),
    ('nth', 9, 1, 1, 1, CAST(NULL AS DATE)),
    ('nth', 10, 1, 1, 2, CAST(NULL AS DATE)),
    ('fixed', 11, 11, 0, 0, CAST(NULL AS DATE)),
    ('nth', 11, 1, 4, 4, CAST(NULL AS DATE)),
    ('fixed', 12, 25, 0, 0, CAST(NULL AS DATE))
  ) r(KIND, M, D, WD, N, FIRST_DATE))"""


def holidays_cte(bounds_sql: str) -> list[str]:
    """Holiday CTEs over a one-row bounds query with columns S, E."""
    return [
        HOLIDAY_RULES,
        f"hol_bounds AS ({bounds_sql})",
        """hol_years AS (SELECT S, E, unnest(generate_series(year(S), year(E) + 1)) AS Y FROM hol_bounds)""",
        """hol_dated AS (
  SELECT S, E, FIRST_DATE, KIND, WD, N, make_date(CAST(Y AS BIGINT), M, D) AS A
  FROM hol_years, hol_rules)""",
        """hol_all AS (
  SELECT S, E, FIRST_DATE, CAST(CASE KIND
      WHEN 'fixed' THEN A + CASE isodow(A) WHEN 6 THEN -1 WHEN 7 THEN 1 ELSE 0 END
      WHEN 'nth' THEN A + CAST(((WD - isodow(A) + 7) % 7) + 7 * (N - 1) AS INTEGER)
      ELSE A - CAST((isodow(A) - WD + 7) % 7 AS INTEGER) END AS DATE) AS DATE
  FROM hol_dated)""",
        """holidays AS (
  SELECT DATE, 1 AS HOLIDAY FROM hol_all
  WHERE DATE BETWEEN S AND E AND (FIRST_DATE IS NULL OR DATE >= FIRST_DATE))""",
    ]


HOLIDAYS = holidays_cte(
    "SELECT make_date(year(min(STARTTIME)), 1, 1) AS S, make_date(year(CAST(max(STARTTIME) AS DATE) + 31), 12, 31) AS E FROM trips")

BASE = [TRIPS, WEATHER_SOURCE, WEATHER, *HOLIDAYS]


def lag_cols(lags) -> str:
    return ", ".join(f"LAG_{k}" for k in lags)


def features_ctes(lags=(1, 7, 90, 365), min_days: int = 730) -> list[str]:
    """H3 in SQL: daily -> lags -> drop nulls -> holiday/weather -> coverage filters."""
    lag_sel = ", ".join(f'lag("COUNT", {k}) OVER w AS LAG_{k}' for k in lags)
    not_null = " AND ".join(f"LAG_{k} IS NOT NULL" for k in lags)
    return [
        """daily AS (
  SELECT START_STATION_ID AS STATION_ID, CAST(STARTTIME AS DATE) AS DATE, count(*) AS "COUNT"
  FROM trips GROUP BY 1, 2)""",
        f"""lagged AS (
  SELECT *, {lag_sel} FROM daily WINDOW w AS (PARTITION BY STATION_ID ORDER BY DATE))""",
        f"""kept AS (
  SELECT * FROM lagged WHERE STATION_ID IS NOT NULL AND DATE IS NOT NULL AND {not_null})""",
        """joined AS (
  SELECT k.*, coalesce(h.HOLIDAY, 0) AS HOLIDAY, w.PRECIP, w.TEMP
  FROM kept k LEFT JOIN holidays h ON k.DATE = h.DATE JOIN weather w ON k.DATE = w.DATE)""",
        f"""features AS (
  SELECT STATION_ID, DATE, "COUNT", {lag_cols(lags)}, HOLIDAY, PRECIP, TEMP FROM (
    SELECT *, count(DATE) OVER (PARTITION BY STATION_ID) AS DAY_COUNT,
              max(DATE) OVER (PARTITION BY STATION_ID) AS MAX_DATE FROM joined)
  WHERE DAY_COUNT >= {min_days}
    AND MAX_DATE = (SELECT CAST(max(STARTTIME) AS DATE) FROM trips))""",
    ]
