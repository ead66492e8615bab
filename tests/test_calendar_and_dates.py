import datetime as dt

import pandas as pd
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from velocast.functions import dates as GD
from velocast.functions.calendar import generate_holidays, holidays_for_range
from velocast.plans.reports import next_ingest
from velocast.sources.files import month_files, route_files


def _pandas_days(start, end):
    return {d.date() for d in USFederalHolidayCalendar().holidays(start=start, end=end)}


def _ours(spark, start, end):
    b = spark.range(1).select(F.lit(start).cast("date").alias("START"), F.lit(end).cast("date").alias("END"))
    return {r["DATE"] for r in holidays_for_range(b).collect()}


def test_holidays_match_pandas_1995_2032(spark):
    assert _ours(spark, "1995-01-01", "2032-12-27") == _pandas_days("1995-01-01", "2032-12-27")


def test_holidays_reference_default_range(spark):
    ours = {r["DATE"] for r in generate_holidays(spark).collect()}
    start = dt.date(2013, 1, 1)
    assert ours == _pandas_days(start, start + dt.timedelta(days=7300))
    assert len(ours) == 212


def test_holidays_observed_new_year_on_dec_31(spark):
    # 2000-01-01 is a Saturday: observed Friday 1999-12-31
    assert dt.date(1999, 12, 31) in _ours(spark, "1999-01-01", "1999-12-31")


def test_normalize_and_parse_all_time_formats(spark):
    rows = [("2014-08-10 15:21:22",), ("1/1/2015 1:30",), ("12/1/2014 02:04:53",),
            ("2014-08-10 15:21:22.1234",), ("not a time",), (None,)]
    df = spark.createDataFrame(rows, "T string")
    out = df.select(GD.normalize_datetime("T").alias("N"),
                    GD.parse_timestamp(GD.normalize_datetime("T")).alias("TS")).collect()
    assert [r["N"] for r in out[:3]] == ["2014-08-10 15:21:22", "2015-1-1 1:30", "2014-12-1 02:04:53"]
    ts = [r["TS"] for r in out]
    assert ts[0] == dt.datetime(2014, 8, 10, 15, 21, 22)
    assert ts[1] == dt.datetime(2015, 1, 1, 1, 30)
    assert ts[2] == dt.datetime(2014, 12, 1, 2, 4, 53)
    assert ts[3] == dt.datetime(2014, 8, 10, 15, 21, 22, 123400)
    assert ts[4] is None and ts[5] is None


def test_route_and_month_names(spark):
    files = spark.createDataFrame([("202101-citibike-tripdata.csv.zip",), ("202102-citibike-tripdata.csv.zip",),
                                   ("/landing/201306-citibike-tripdata.zip",)], "NAME string")
    got = {r["NAME"]: r["VERSION"] for r in route_files(files).collect()}
    assert got == {"202101-citibike-tripdata.csv.zip": "schema1", "202102-citibike-tripdata.csv.zip": "schema2",
                   "/landing/201306-citibike-tripdata.zip": "schema1"}
    b = spark.range(1).select(F.lit("2016-11-15").cast("date").alias("START"),
                              F.lit("2017-02-01").cast("date").alias("END"))
    names = [r["NAME"] for r in month_files(b).orderBy("MONTH").collect()]
    assert names == ["201611-citibike-tripdata.zip", "201612-citibike-tripdata.zip",
                     "201701-citibike-tripdata.csv.zip", "201702-citibike-tripdata.csv.zip"]


def test_next_ingest_rule(spark):
    t = spark.createDataFrame([(dt.datetime(2016, 11, 30, 23, 0),)], "STARTTIME timestamp")
    r = next_ingest(t).collect()[0]
    assert r["NEXT_INGEST"] == dt.date(2016, 12, 1)
    assert r["FILE_NAME"] == "201612-citibike-tripdata.zip"
    assert r["RUN_DATE"] == "2017_01_01"
    t2 = spark.createDataFrame([(dt.datetime(2019, 12, 31, 1, 0),)], "STARTTIME timestamp")
    assert next_ingest(t2).collect()[0]["FILE_NAME"] == "202001-citibike-tripdata.csv.zip"


def test_utc_to_local_and_fourier(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 7, 1, 2, 0),)], "TS timestamp")
    assert df.select(GD.utc_to_local_date("TS")).collect()[0][0] == dt.date(2020, 6, 30)
    f = df.select(*[c.alias(n) for n, c in GD.fourier_terms(F.lit("2020-01-01").cast("date")).items()]).collect()[0]
    assert abs(f["SIN_1"] ** 2 + f["COS_1"] ** 2 - 1) < 1e-12
    assert pd.notna(f["COS_2"])


def test_category_codes_distributed_rank_matches_local(spark):
    from velocast.functions.columns import category_codes
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    df = part.select(F.when(F.col("p_partkey") % 13 == 0, None)
                     .otherwise(F.concat("p_name", (F.col("p_partkey") % 997).cast("string"))).alias("C"))
    local = category_codes(df, "C").select("C", "CODE").distinct()
    spread = category_codes(df, "C").select("C", "CODE").distinct()
    assert sorted(local.collect(), key=str) == sorted(spread.collect(), key=str)
    labels = sorted(r["C"] for r in df.where(F.col("C").isNotNull()).distinct().collect())
    codes = {r["C"]: r["CODE"] for r in spread.collect()}
    assert [codes[c] for c in labels] == list(range(len(labels)))
    assert codes[None] == -1


def test_year_end_trips_have_the_forecast_days_holidays(spark):
    from velocast.fixtures import trip_year_bounds
    from velocast.functions.calendar import holidays_for_range
    t = spark.createDataFrame([(dt.datetime(2019, 12, 31, 5, 0),)], "STARTTIME timestamp")
    found = {r["DATE"] for r in holidays_for_range(trip_year_bounds(t)).collect()}
    assert {dt.date(2020, 1, 1), dt.date(2020, 1, 20)} <= found
