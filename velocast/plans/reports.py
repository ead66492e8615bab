"""K6-K8: the numbers behind the two reports and the next-ingest hint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import category_codes
from ..operators.clean import explain_reason, filter_in_date_range
from ..operators.relational import pivot_to_long

# Explainer columns and the report's business names for them.
EXPLAINERS = ["EXPL_LAG_1", "EXPL_LAG_7", "EXPL_LAG_90", "EXPL_LAG_365",
              "EXPL_HOLIDAY", "EXPL_PRECIP", "EXPL_TEMP"]
BUSINESS_NAMES = ["DAY", "DAY_OF_WEEK", "QUARTER", "DAY_OF_YEAR",
                  "US_HOLIDAY", "PRECIPITATION", "TEMPERATURE"]


def forecast_report(forecast: DataFrame, stations: list[str], start, end,
                    with_codes: bool = True) -> DataFrame:
    """K6: chosen stations and days; EXPLAIN = largest explainer, REASON = its name."""
    df = filter_in_date_range(forecast, "STATION_ID", stations, "DATE", start, end)
    df = df.select("STATION_ID", F.date_format("DATE", "yyyy-MM-dd").alias("DATE"), "PRED", "HOLIDAY",
                   *EXPLAINERS)
    df = explain_reason(df, EXPLAINERS)
    out = df.select("STATION_ID", "DATE", "PRED", "REASON", "EXPLAIN",
                    *[F.col(e).alias(b) for e, b in zip(EXPLAINERS, BUSINESS_NAMES)])
    return category_codes(out, "REASON", "REASON_CODE", known=EXPLAINERS) if with_codes else out


def model_monitor(evals: DataFrame, stations: list[str], metric: str = "rmse") -> DataFrame:
    """K7: metric by run date for the chosen stations; missing pairs are NULL rows."""
    df = (evals.filter(F.col("STATION_ID").isin(list(stations)))
          .select(F.date_format("RUN_DATE", "yyyy-MM-dd").alias("RUN_DATE"), "STATION_ID",
                  F.col(metric).alias(metric.upper())))
    return pivot_to_long(df, "RUN_DATE", "STATION_ID", metric.upper(), list(stations))


def next_ingest(trips: DataFrame, time_col: str = "STARTTIME") -> DataFrame:
    """K8: month to load next, its archive name and the run date (one row)."""
    last = F.to_date(F.max(time_col))
    nxt = F.trunc(F.add_months(last, 1), "MM")
    suffix = F.when(nxt <= F.lit("2016-12-01").cast("date"), F.lit("-citibike-tripdata.zip")) \
              .otherwise(F.lit("-citibike-tripdata.csv.zip"))
    return trips.agg(last.alias("LAST_TRIP_DATE"), nxt.alias("NEXT_INGEST"),
                     F.concat(F.date_format(nxt, "yyyyMM"), suffix).alias("FILE_NAME"),
                     F.date_format(F.add_months(nxt, 1), "yyyy_MM_dd").alias("RUN_DATE"))
