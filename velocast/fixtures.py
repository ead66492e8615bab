"""Domain tables as projections of the driver's test tables (see FIXTURES.md).

Every fixture is a lazy DataFrame over the given parquet files, so the
queries built on them grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import FORECAST_STEPS
from .functions.calendar import holidays_for_range
from .operators.features import weather_daily

# Fixed values for the stand-ins.
FIXTURE_POSTCODE = "O"            # lineitem.l_linestatus plays the postcode
SCHEMA_SPLIT_DATE = "1998-01-01"  # orders before it arrive in schema1


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trips: one order = one trip; station = order priority."""
    o = load(spark, sf_dir, "orders")
    return o.select(F.col("o_orderdate").alias("STARTTIME"),
                    F.col("o_orderdate").alias("STOPTIME"),
                    F.col("o_orderpriority").alias("START_STATION_NAME"),
                    F.col("o_orderpriority").alias("START_STATION_ID"),
                    F.col("o_orderstatus").alias("USERTYPE"))


def ship_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trips of a dense fleet: one line item = one trip; station = line number."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_shipdate").alias("STARTTIME"), F.col("l_shipdate").alias("STOPTIME"),
                     *[F.concat(F.lit("L"), F.col("l_linenumber")).alias(c) for c in ("START_STATION_NAME", "START_STATION_ID")],
                     F.col("l_linestatus").alias("USERTYPE"))


def weather_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather source: per (line status, ship day) rain = sum(discount), temp = avg(quantity)."""
    li = load(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_linestatus").alias("POSTAL_CODE"),
                       F.to_date("l_shipdate").alias("DATE_VALID_STD"))
            .agg(F.round(F.sum("l_discount"), 2).alias("TOT_PRECIPITATION_MM"),
                 F.avg("l_quantity").cast("decimal(20,10)").alias("AVG_TEMPERATURE_FEELSLIKE_2M_C")))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_daily(weather_source(spark, sf_dir), FIXTURE_POSTCODE)


def trip_year_bounds(t: DataFrame, time_col: str = "STARTTIME") -> DataFrame:
    """One-row relation: Jan 1 of the first trip year .. Dec 31 of the last forecast day's year."""
    return t.agg(F.make_date(F.year(F.min(time_col)), F.lit(1), F.lit(1)).alias("START"),
                 F.make_date(F.year(F.date_add(F.to_date(F.max(time_col)), FORECAST_STEPS + 1)), F.lit(12), F.lit(31)).alias("END"))


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holidays_for_range(trip_year_bounds(trips(spark, sf_dir)))


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """preds: y_true = quantity, y_score = quantity * (1 + discount - 0.05)."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("STATION_ID"),
                     F.to_date("l_shipdate").alias("DATE"),
                     F.col("l_quantity").alias("y_true"),
                     (F.col("l_quantity") * (F.lit(1.0) + F.col("l_discount") - F.lit(0.05))).alias("y_score"))


def explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """explain: lineitem rows as forecast rows with seven EXPL_ columns (three non-zero)."""
    li = load(spark, sf_dir, "lineitem")
    dec = "decimal(10,2)"
    zero = F.lit(0).cast(dec)
    return li.select(
        F.col("l_returnflag").alias("STATION_ID"), F.to_date("l_shipdate").alias("DATE"),
        F.col("l_quantity").cast("int").alias("PRED"), F.lit(0).alias("HOLIDAY"),
        F.round(F.col("l_quantity") / 50, 2).cast(dec).alias("EXPL_LAG_1"),
        F.round(F.col("l_discount") * 10, 2).cast(dec).alias("EXPL_LAG_7"),
        F.round(F.col("l_tax") * 10, 2).cast(dec).alias("EXPL_LAG_90"),
        zero.alias("EXPL_LAG_365"), zero.alias("EXPL_HOLIDAY"),
        zero.alias("EXPL_PRECIP"), zero.alias("EXPL_TEMP"))


def raw_schema1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before the split as schema1 text rows (times as M/d/yyyy H:mm)."""
    o = load(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit(SCHEMA_SPLIT_DATE).cast("timestamp_ntz"))
    t = F.date_format("o_orderdate", "M/d/yyyy H:mm")
    s = lambda c: F.col(c).cast("string")
    return o.select(
        s("o_totalprice").alias("TRIPDURATION"), t.alias("STARTTIME"), t.alias("STOPTIME"),
        s("o_orderpriority").alias("START_STATION_ID"), s("o_orderpriority").alias("START_STATION_NAME"),
        F.lit(None).cast("string").alias("START_STATION_LATITUDE"),
        F.lit(None).cast("string").alias("START_STATION_LONGITUDE"),
        s("o_custkey").alias("END_STATION_ID"), s("o_custkey").alias("END_STATION_NAME"),
        F.lit(None).cast("string").alias("END_STATION_LATITUDE"),
        F.lit(None).cast("string").alias("END_STATION_LONGITUDE"),
        s("o_orderkey").alias("BIKEID"), s("o_orderstatus").alias("USERTYPE"),
        F.lit(None).cast("string").alias("BIRTH_YEAR"), F.lit(None).cast("string").alias("GENDER"))


def raw_schema2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from the split on as schema2 text rows (times as yyyy-MM-dd HH:mm:ss)."""
    o = load(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit(SCHEMA_SPLIT_DATE).cast("timestamp_ntz"))
    t = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    s = lambda c: F.col(c).cast("string")
    return o.select(
        s("o_orderkey").alias("ride_id"), F.lit("classic_bike").alias("rideable_type"),
        t.alias("STARTTIME"), t.alias("STOPTIME"),
        s("o_orderpriority").alias("START_STATION_NAME"), s("o_orderpriority").alias("START_STATION_ID"),
        s("o_custkey").alias("END_STATION_NAME"), s("o_custkey").alias("END_STATION_ID"),
        F.lit(None).cast("string").alias("START_STATION_LATITUDE"),
        F.lit(None).cast("string").alias("START_STATION_LONGITUDE"),
        F.lit(None).cast("string").alias("END_STATION_LATITUDE"),
        F.lit(None).cast("string").alias("END_STATION_LONGITUDE"),
        s("o_orderstatus").alias("USERTYPE"))


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target rows for change capture: orders as text rows keyed by ORDERKEY."""
    o = load(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("ORDERKEY"), F.col("o_custkey").alias("CUSTKEY"),
                    F.col("o_orderstatus").alias("STATUS"), F.col("o_totalprice").alias("PRICE"),
                    F.col("o_orderpriority").alias("PRIORITY"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """changes: key mod 10 = 0 -> DELETE, = 1 -> update (DELETE+INSERT pair), = 2 -> new key.

    Columns: target columns + ACTION, ISUPDATE, SEQ.
    """
    o = order_rows(spark, sf_dir)
    m = F.col("ORDERKEY") % 10
    base = [F.col(c) for c in ("ORDERKEY", "CUSTKEY", "STATUS", "PRICE", "PRIORITY")]
    dele = o.filter(m == 0).select(*base, F.lit("DELETE").alias("ACTION"), F.lit(False).alias("ISUPDATE"))
    upd_del = o.filter(m == 1).select(*base, F.lit("DELETE").alias("ACTION"), F.lit(True).alias("ISUPDATE"))
    upd_ins = o.filter(m == 1).select(
        "ORDERKEY", "CUSTKEY", F.lit("U").alias("STATUS"), (F.col("PRICE") + F.lit(1.0)).alias("PRICE"),
        "PRIORITY", F.lit("INSERT").alias("ACTION"), F.lit(True).alias("ISUPDATE"))
    new = o.filter(m == 2).select(
        (-F.col("ORDERKEY")).alias("ORDERKEY"), "CUSTKEY", "STATUS", "PRICE", "PRIORITY",
        F.lit("INSERT").alias("ACTION"), F.lit(False).alias("ISUPDATE"))
    out = dele.unionByName(upd_del).unionByName(upd_ins).unionByName(new)
    return out.withColumn("SEQ", F.when(F.col("ACTION") == "INSERT", F.lit(2)).otherwise(F.lit(1)).cast("bigint"))


def later_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later state of ``order_rows``: key mod 7 = 0 removed, = 1 re-priced, = 2 added (negated)."""
    o = order_rows(spark, sf_dir)
    m = F.col("ORDERKEY") % 7
    kept = o.filter(m != 0).withColumn("PRICE", F.when(m == 1, F.col("PRICE") + F.lit(1.0))
                                       .otherwise(F.col("PRICE")))
    added = o.filter(m == 2).withColumn("ORDERKEY", -F.col("ORDERKEY"))
    return kept.unionByName(added)
