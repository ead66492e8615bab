"""Registered queries for sources/sinks/catalog (A), change capture and
streaming (J), whole runs and reports (K).

Queries that write do so under the shared folder named by
``spark.checkpoint.dir`` (a fresh sub-folder per call) and return what they
read back.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..config import RunConfig
from ..operators import evaluate as EV
from ..operators import features as H
from ..operators import relational as R
from ..plans import ingest as K
from ..plans import reports as RP
from ..plans import runs as KR
from ..session import scratch_path
from ..sources import catalog as A
from ..sources import files as AF
from ..sources import ledger as L
from ..streaming import changes as J
from . import BASE, ORACLE, TRIPS, features_ctes, register, with_ctes
from .basic import DAILY, EXPLAINED, PREDS, RAW1, RAW2
from .model import _eval_sql, run_eval_sql

CONF = ", ".join(K.CONFORMED_COLUMNS)
RAW1_COLS = ", ".join(K.SCHEMA1.fieldNames())
RAW1_SHIFT, RAW2_SHIFT = 221, 288   # landed month = order month + shift (1995-01 -> 2013-06, 1998-01 -> 2022-01)

CONFORMED_ORDERS = """conformed AS (
  SELECT o_orderdate AS STARTTIME, o_orderdate AS STOPTIME,
         o_orderpriority AS START_STATION_NAME, o_orderpriority AS START_STATION_ID,
         CAST(o_custkey AS VARCHAR) AS END_STATION_NAME, CAST(o_custkey AS VARCHAR) AS END_STATION_ID,
         CAST(NULL AS VARCHAR) AS START_STATION_LATITUDE, CAST(NULL AS VARCHAR) AS START_STATION_LONGITUDE,
         CAST(NULL AS VARCHAR) AS END_STATION_LATITUDE, CAST(NULL AS VARCHAR) AS END_STATION_LONGITUDE,
         o_orderstatus AS USERTYPE, o_orderkey AS _KEY
  FROM orders)"""

TGT = """tgt AS (
  SELECT o_orderkey AS ORDERKEY, o_custkey AS CUSTKEY, o_orderstatus AS STATUS,
         o_totalprice AS PRICE, o_orderpriority AS PRIORITY FROM orders)"""

CHANGES = """ch AS (
  SELECT ORDERKEY, CUSTKEY, STATUS, PRICE, PRIORITY, 'DELETE' AS ACTION, false AS ISUPDATE, 1 AS SEQ
  FROM tgt WHERE ORDERKEY % 10 = 0
  UNION ALL SELECT ORDERKEY, CUSTKEY, STATUS, PRICE, PRIORITY, 'DELETE', true, 1 FROM tgt WHERE ORDERKEY % 10 = 1
  UNION ALL SELECT ORDERKEY, CUSTKEY, 'U', PRICE + 1.0, PRIORITY, 'INSERT', true, 2 FROM tgt WHERE ORDERKEY % 10 = 1
  UNION ALL SELECT -ORDERKEY, CUSTKEY, STATUS, PRICE, PRIORITY, 'INSERT', false, 2 FROM tgt WHERE ORDERKEY % 10 = 2)"""

MERGED_SQL = with_ctes(TGT, CHANGES, """red AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ORDERKEY
                   ORDER BY SEQ DESC, CASE WHEN ACTION = 'INSERT' THEN 1 ELSE 0 END DESC) AS RN FROM ch)
  WHERE RN = 1)""", """j AS (
  SELECT t.ORDERKEY AS TK, t.CUSTKEY AS TC, t.STATUS AS TS, t.PRICE AS TP, t.PRIORITY AS TPR, r.*
  FROM tgt t FULL OUTER JOIN red r ON t.ORDERKEY = r.ORDERKEY)""", """m AS (
  SELECT *, TK IS NOT NULL AS MATCHED,
         (TK IS NULL AND ACTION = 'INSERT') OR (TK IS NOT NULL AND ACTION = 'INSERT' AND coalesce(ISUPDATE, false)) AS TAKE,
         TK IS NOT NULL AND (ACTION IS NULL OR (ACTION = 'INSERT' AND NOT coalesce(ISUPDATE, false))) AS KEEP
  FROM j)""") + """
SELECT CASE WHEN MATCHED THEN TK ELSE ORDERKEY END AS ORDERKEY,
       CASE WHEN TAKE THEN CUSTKEY ELSE TC END AS CUSTKEY,
       CASE WHEN TAKE THEN STATUS ELSE TS END AS STATUS,
       CASE WHEN TAKE THEN PRICE ELSE TP END AS PRICE,
       CASE WHEN TAKE THEN PRIORITY ELSE TPR END AS PRIORITY
FROM m WHERE TAKE OR KEEP"""

KEYS = ["ORDERKEY"]


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _landed(spark, sf_dir, which=("schema1", "schema2"), null_value="NULL"):
    """Stage the raw fixtures as monthly gzip CSV files; return (landing dir, listing)."""
    landing = scratch_path(spark, "landing")
    if "schema1" in which:
        r1 = fx.raw_schema1(spark, sf_dir)
        m1 = F.date_format(F.add_months(F.to_date(F.to_timestamp("STARTTIME", "M/d/yyyy H:mm")), RAW1_SHIFT),
                           "yyyyMM")
        AF.stage_monthly_files(r1.withColumn("_MONTH", m1), "_MONTH", landing, null_value=null_value)
    if "schema2" in which:
        r2 = fx.raw_schema2(spark, sf_dir)
        m2 = F.date_format(F.add_months(F.to_date("STARTTIME"), RAW2_SHIFT), "yyyyMM")
        AF.stage_monthly_files(r2.withColumn("_MONTH", m2), "_MONTH", landing, null_value=null_value)
    return landing, AF.list_files(spark, landing, "*.csv.gz")


# ------------------------------------------------------------ A: sources

@register("read_trips_csv", with_ctes(RAW1) +
          "SELECT BIKEID, _ORIG AS STARTTIME, START_STATION_ID, START_STATION_LATITUDE, END_STATION_NAME FROM raw1")
def read_trips_csv(spark, sf_dir):
    landing, _ = _landed(spark, sf_dir, ("schema1",), null_value="\\N")
    raw = AF.read_trips_csv(spark, landing + "/*.csv.gz", K.SCHEMA1)
    return raw.select("BIKEID", K.parse_timestamp(K.normalize_datetime("STARTTIME")).alias("STARTTIME"),
                      "START_STATION_ID", "START_STATION_LATITUDE", "END_STATION_NAME")


@register("route_files", """
SELECT DISTINCT strftime(o_orderdate + INTERVAL 240 MONTH, '%Y%m') || '-citibike-tripdata.csv.zip' AS NAME,
       CASE WHEN CAST(date_trunc('month', o_orderdate + INTERVAL 240 MONTH) AS DATE) < DATE '2021-02-01'
            THEN 'schema1' ELSE 'schema2' END AS VERSION
FROM orders""")
def route_files(spark, sf_dir):
    o = fx.load(spark, sf_dir, "orders")
    names = o.select(F.concat(F.date_format(F.add_months(F.to_date("o_orderdate"), 240), "yyyyMM"),
                              F.lit("-citibike-tripdata.csv.zip")).alias("NAME")).distinct()
    return AF.route_files(names)


@register("month_files", """
WITH b AS (SELECT CAST(date_trunc('month', min(o_orderdate) + INTERVAL 216 MONTH) AS DATE) AS S,
                  CAST(date_trunc('month', max(o_orderdate) + INTERVAL 216 MONTH) AS DATE) AS E FROM orders),
m AS (SELECT CAST(unnest(generate_series(S, E, INTERVAL 1 MONTH)) AS DATE) AS MONTH FROM b)
SELECT MONTH, strftime(MONTH, '%Y%m') ||
       CASE WHEN MONTH <= DATE '2016-12-01' THEN '-citibike-tripdata.zip' ELSE '-citibike-tripdata.csv.zip' END AS NAME
FROM m""")
def month_files(spark, sf_dir):
    o = fx.load(spark, sf_dir, "orders")
    b = o.agg(F.add_months(F.to_date(F.min("o_orderdate")), 216).alias("START"),
              F.add_months(F.to_date(F.max("o_orderdate")), 216).alias("END"))
    return AF.month_files(b)


@register("unpack_zip_csv", with_ctes(RAW1) +
          "SELECT BIKEID, _ORIG AS STARTTIME, START_STATION_ID, START_STATION_LATITUDE, END_STATION_NAME FROM raw1")
def unpack_zip_csv(spark, sf_dir):
    """A4: schema1 rows landed as monthly zip archives, read back through the zip reader."""
    landing = scratch_path(spark, "zips")
    r1 = fx.raw_schema1(spark, sf_dir)
    m1 = F.date_format(F.add_months(F.to_date(F.to_timestamp("STARTTIME", "M/d/yyyy H:mm")), RAW1_SHIFT), "yyyyMM")
    AF.stage_monthly_zips(r1.withColumn("_MONTH", m1), "_MONTH", landing).write.format("noop").mode(
        "overwrite").save()
    raw = AF.unpack_zip_csv(spark, landing, K.SCHEMA1)
    return raw.select("BIKEID", K.parse_timestamp(K.normalize_datetime("STARTTIME")).alias("STARTTIME"),
                      "START_STATION_ID", "START_STATION_LATITUDE", "END_STATION_NAME")


@register("list_files", f"""
SELECT strftime(o_orderdate + INTERVAL {RAW2_SHIFT} MONTH, '%Y%m') || '-citibike-tripdata.csv.gz' AS NAME, true AS HAS_BYTES
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1""")
def list_files(spark, sf_dir):
    """A5 over the schema2 files landed from the orders."""
    _, listed = _landed(spark, sf_dir, ("schema2",))
    return listed.select("NAME", (F.col("LENGTH") > 0).alias("HAS_BYTES"))


@register("append_files_to_raw", with_ctes(RAW2) + f"SELECT {CONF} FROM raw2")
def append_files_to_raw(spark, sf_dir):
    _, landed = _landed(spark, sf_dir, ("schema2",))
    files = [r["PATH"] for r in landed.select("PATH").collect()]
    name = _name("raw_schema2")
    AF.empty_table(spark, name, K.SCHEMA2, scratch_path(spark, "tables", name))
    AF.append_files_to_raw(spark, files, K.SCHEMA2, name)
    return spark.table(name).select(*K.CONFORMED_COLUMNS)


@register("empty_table", with_ctes(RAW1) + f"SELECT {RAW1_COLS} FROM raw1")
def empty_table(spark, sf_dir):
    """The schema1 raw table created empty, then the schema1 rows appended to it."""
    name = _name("raw_schema1")
    AF.empty_table(spark, name, K.SCHEMA1, scratch_path(spark, "tables", name))
    A.write_append(fx.raw_schema1(spark, sf_dir).select(*K.SCHEMA1.fieldNames()), name)
    return spark.table(name)


@register("table_like", with_ctes(TRIPS) + "SELECT * FROM trips")
def table_like(spark, sf_dir):
    """An empty table shaped like TRIPS, then filled from it."""
    src = _name("trips_src")
    A.write_overwrite(fx.trips(spark, sf_dir), src, scratch_path(spark, "tables", src))
    name = _name("trips_like")
    AF.table_like(spark, src, name, scratch_path(spark, "tables", name))
    A.write_append(spark.table(src), name)
    return spark.table(name)


# ------------------------------------------------------------ A: catalog

@register("write_overwrite", with_ctes(*BASE, *features_ctes()) + "SELECT * FROM features")
def write_overwrite(spark, sf_dir):
    name = _name("features")
    f = H.feature_table(fx.trips(spark, sf_dir), fx.holidays(spark, sf_dir), fx.weather(spark, sf_dir))
    A.write_overwrite(f, name, scratch_path(spark, "tables", name))
    A.write_overwrite(f, name, scratch_path(spark, "tables", name))
    return spark.table(name)


_EVAL_FLAT = """
SELECT {d} AS RUN_DATE, STATION_ID, CAST(mae AS DECIMAL(10,2)) AS mae, CAST(mape AS DECIMAL(10,2)) AS mape,
       CAST(mse AS DECIMAL(10,2)) AS mse, CAST(r_squared AS DECIMAL(10,2)) AS r_squared,
       CAST(rmse AS DECIMAL(10,2)) AS rmse, CAST(smape AS DECIMAL(10,2)) AS smape FROM ev"""


@register("write_append", with_ctes(PREDS, f"ev AS ({_eval_sql('preds', 'y_true', 'y_score')})")
          + _EVAL_FLAT.format(d="DATE '2001-09-01'") + " UNION ALL " + _EVAL_FLAT.format(d="DATE '2001-10-01'"))
def write_append(spark, sf_dir):
    name = _name("flat_eval")
    scores = EV.evaluate_models(fx.preds(spark, sf_dir), "y_true", "y_score")
    path = scratch_path(spark, "tables", name)
    for run_date in ("2001_09_01", "2001_10_01"):
        A.write_append(EV.flatten_eval(EV.pack_eval(scores, run_date)), name, path)
    return spark.table(name)


@register("temp_table", with_ctes(*BASE) + "SELECT * FROM holidays")
def temp_table(spark, sf_dir):
    name = _name("holidays")
    A.temp_table(fx.holidays(spark, sf_dir), name)
    return spark.table(name)


@register("create_view", with_ctes(*BASE) + "SELECT * FROM weather")
def create_view(spark, sf_dir):
    return spark.table(A.create_view(fx.weather(spark, sf_dir), _name("weather")))


@register("ensure_table", with_ctes(*BASE) + "SELECT * FROM holidays")
def ensure_table(spark, sf_dir):
    return A.ensure_table(spark, _name("holidays"), lambda: fx.holidays(spark, sf_dir))


@register("snapshot_table", with_ctes(TRIPS) + "SELECT * FROM trips")
def snapshot_table(spark, sf_dir):
    src, snap = _name("trips"), _name("trips_snapshot")
    A.write_immutable(fx.trips(spark, sf_dir), src, scratch_path(spark, "tables", src))
    A.snapshot_table(spark, src, snap, scratch_path(spark, "tables", snap))
    return spark.table(snap)


@register("tag_lineage", "SELECT 'model_id' AS key, 'model_2001_09_01' AS value")
def tag_lineage(spark, sf_dir):
    name = _name("features")
    A.write_overwrite(R.daily_counts(fx.trips(spark, sf_dir)), name, scratch_path(spark, "tables", name))
    A.tag_lineage(spark, name, {"model_id": "model_2001_09_01"})
    return A.read_tags(spark, name).filter(F.col("key") == "model_id")


@register("reset_database", """
SELECT 'raw_schema1' AS TABLE_NAME, count(*) AS N_ROWS FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT 'raw_schema2', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def reset_database(spark, sf_dir):
    """Drop and recreate the database with its empty raw tables, load them,
    and report the rows of every table the database holds."""
    db = _name("velocast")
    A.reset_database(spark, db, {"RAW_schema1": K.SCHEMA1, "RAW_schema2": K.SCHEMA2},
                     scratch_path(spark, "db", db))
    A.write_append(fx.raw_schema1(spark, sf_dir).select(*K.SCHEMA1.fieldNames()), f"{db}.RAW_schema1")
    A.write_append(fx.raw_schema2(spark, sf_dir).select(*K.SCHEMA2.fieldNames()), f"{db}.RAW_schema2")
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db}").filter(~F.col("isTemporary")).collect()]
    counts = [spark.table(f"{db}.{t}").agg(F.count(F.lit(1)).alias("N_ROWS"))
              .select(F.lit(t).alias("TABLE_NAME"), "N_ROWS") for t in sorted(names)]
    return reduce(lambda a, b: a.unionByName(b), counts)


@register("local_to_table", with_ctes(TRIPS) + """
SELECT START_STATION_ID AS STATION_ID, count(*) AS "COUNT" FROM trips WHERE START_STATION_ID IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 3""")
def local_to_table(spark, sf_dir):
    top = R.top_stations(fx.trips(spark, sf_dir), 3)
    return A.local_to_table(spark, A.fetch_bounded(top, 3), top.schema)


_TRIP_TYPES = {"STARTTIME": "timestamp_ntz", "STOPTIME": "timestamp_ntz", "START_STATION_NAME": "string", "START_STATION_ID": "string", "USERTYPE": "string"}


@register("table_schema", with_ctes(TRIPS) + " UNION ALL ".join(
    f"SELECT {i} AS POSITION, '{c}' AS NAME, '{t}' AS TYPE, count(*) AS N_ROWS, count(*) - count({c}) AS N_NULL FROM trips"
    for i, (c, t) in enumerate(_TRIP_TYPES.items())))
def table_schema(spark, sf_dir):
    return A.column_profile(fx.trips(spark, sf_dir))


@register("run_sql", with_ctes(TRIPS, DAILY) +
          "SELECT DATE, \"COUNT\" FROM daily WHERE STATION_ID = '3-MEDIUM' AND \"COUNT\" >= 3")
def run_sql(spark, sf_dir):
    view = _name("daily")
    return A.run_sql(spark, f"SELECT DATE, COUNT FROM {view} WHERE STATION_ID = :station AND COUNT >= :n",
                     {view: R.daily_counts(fx.trips(spark, sf_dir))}, {"station": "3-MEDIUM", "n": 3})


@register("fetch_bounded", with_ctes(TRIPS) +
          'SELECT CAST(STARTTIME AS DATE) AS DATE, count(*) AS "COUNT" FROM trips GROUP BY 1 ORDER BY 1 LIMIT 10')
def fetch_bounded(spark, sf_dir):
    per_day = R.trips_per_day(fx.trips(spark, sf_dir))
    return spark.createDataFrame(A.fetch_bounded(per_day, 10), per_day.schema)


# ------------------------------------------------------------ J

@register("merge_changes", MERGED_SQL)
def merge_changes(spark, sf_dir):
    return J.merge_changes(fx.order_rows(spark, sf_dir), fx.changes(spark, sf_dir), KEYS)


@register("snapshot_diff", with_ctes(TGT, """aft AS (
  SELECT ORDERKEY, CUSTKEY, STATUS, CASE WHEN ORDERKEY % 7 = 1 THEN PRICE + 1.0 ELSE PRICE END AS PRICE, PRIORITY
  FROM tgt WHERE ORDERKEY % 7 <> 0
  UNION ALL SELECT -ORDERKEY, CUSTKEY, STATUS, PRICE, PRIORITY FROM tgt WHERE ORDERKEY % 7 = 2)""",
                                       """chg AS (
  SELECT b.ORDERKEY FROM tgt b JOIN aft a ON a.ORDERKEY = b.ORDERKEY
  WHERE b.CUSTKEY IS DISTINCT FROM a.CUSTKEY OR b.STATUS IS DISTINCT FROM a.STATUS
     OR b.PRICE IS DISTINCT FROM a.PRICE OR b.PRIORITY IS DISTINCT FROM a.PRIORITY)""") + """
SELECT a.*, 'INSERT' AS ACTION, false AS ISUPDATE FROM aft a WHERE a.ORDERKEY NOT IN (SELECT ORDERKEY FROM tgt)
UNION ALL SELECT b.*, 'DELETE', false FROM tgt b WHERE b.ORDERKEY NOT IN (SELECT ORDERKEY FROM aft)
UNION ALL SELECT b.*, 'DELETE', true FROM tgt b WHERE b.ORDERKEY IN (SELECT ORDERKEY FROM chg)
UNION ALL SELECT a.*, 'INSERT', true FROM aft a WHERE a.ORDERKEY IN (SELECT ORDERKEY FROM chg)""")
def snapshot_diff(spark, sf_dir):
    return J.snapshot_diff(fx.order_rows(spark, sf_dir), fx.later_orders(spark, sf_dir), KEYS)


@register("stream_merge", MERGED_SQL)
def stream_merge(spark, sf_dir):
    """The change records as several files, drained by a micro-batch stream."""
    base = scratch_path(spark, "cdc")
    changes_dir, target = f"{base}/changes", _name("merged")
    ch = fx.changes(spark, sf_dir)
    ch.repartition(4, F.pmod(F.col("ORDERKEY"), F.lit(4))).write.mode("overwrite").parquet(changes_dir)
    J.init_target(fx.order_rows(spark, sf_dir), target, KEYS, buckets=8, path=f"{base}/target")
    q = J.stream_merge(spark, changes_dir, ch.schema, target, checkpoint=f"{base}/_checkpoint", max_files_per_trigger=2)
    q.awaitTermination()
    return J.current_state(spark, target)


@register("cdc_elt", with_ctes(CONFORMED_ORDERS) + f"""
SELECT {CONF} FROM conformed WHERE NOT (STARTTIME >= TIMESTAMP '1998-01-01' AND _KEY % 10 = 0)""")
def cdc_elt(spark, sf_dir):
    """Landed files -> raw -> schema2 change stream (deletes) -> interim -> TRIPS."""
    base = scratch_path(spark, "cdc_elt")
    _, landed = _landed(spark, sf_dir)
    r2 = fx.raw_schema2(spark, sf_dir)
    deletes = (r2.filter(F.col("ride_id").cast("bigint") % 10 == 0)
               .withColumn("ACTION", F.lit("DELETE")).withColumn("ISUPDATE", F.lit(False))
               .withColumn("SEQ", F.lit(1).cast("bigint")))
    deletes.write.mode("overwrite").parquet(f"{base}/changes_schema2")
    cfg = RunConfig(database=_name("velocast_cdc"))
    KR.cdc_elt(spark, cfg, landed, {"schema2": f"{base}/changes_schema2"}, base)
    return spark.table(f"{cfg.database}.{cfg.trips}")


# ------------------------------------------------------------ K

@register("transform_trips", with_ctes(CONFORMED_ORDERS) + f"SELECT {CONF} FROM conformed")
def transform_trips(spark, sf_dir):
    return K.transform_trips(fx.raw_schema1(spark, sf_dir), fx.raw_schema2(spark, sf_dir))


@register("incremental_elt", with_ctes(CONFORMED_ORDERS) + f"SELECT {CONF} FROM conformed")
def incremental_elt(spark, sf_dir):
    _, landed = _landed(spark, sf_dir)
    cfg = RunConfig(database=_name("velocast_inc"))
    A.reset_database(spark, cfg.database, {cfg.raw("schema1"): K.SCHEMA1, cfg.raw("schema2"): K.SCHEMA2},
                     scratch_path(spark, "db", cfg.database))
    spark.catalog.setCurrentDatabase(cfg.database)
    try:
        K.incremental_elt(spark, cfg, landed)
    finally:
        spark.catalog.setCurrentDatabase("default")
    return spark.table(f"{cfg.database}.{cfg.trips}")


@register("bulk_elt", with_ctes(CONFORMED_ORDERS) +
          f"SELECT {CONF} FROM conformed WHERE STARTTIME < TIMESTAMP '1998-01-01'")
def bulk_elt(spark, sf_dir):
    _, landed = _landed(spark, sf_dir)
    cfg = RunConfig(database=_name("velocast_bulk"))
    A.reset_database(spark, cfg.database, {cfg.raw("schema1"): K.SCHEMA1, cfg.raw("schema2"): K.SCHEMA2},
                     scratch_path(spark, "db", cfg.database))
    spark.catalog.setCurrentDatabase(cfg.database)
    try:
        K.bulk_elt(spark, cfg, landed)
    finally:
        spark.catalog.setCurrentDatabase("default")
    return spark.table(f"{cfg.database}.{cfg.trips}")


def _run_config(spark, tag):
    return RunConfig(database=_name(f"velocast_{tag}"), postcode=fx.FIXTURE_POSTCODE)


@register("setup_run", ORACLE["flat_forecast"])
def setup_run(spark, sf_dir):
    """K4 end to end on the landed fixture files; returns flat_FORECAST."""
    _, landed = _landed(spark, sf_dir)
    cfg = _run_config(spark, "setup")
    try:
        out = KR.setup_run(spark, cfg, landed, fx.weather_source(spark, sf_dir), "2001_09_01",
                           scratch_path(spark, "db", cfg.database), bulk=False)
    finally:
        spark.catalog.setCurrentDatabase("default")
    return spark.table(f"{cfg.database}.{out['flat_forecast']}")


@register("monthly_run", run_eval_sql("1998-02-01", "o_orderdate < TIMESTAMP '1998-01-01'", 365) + "\nUNION ALL "
          + run_eval_sql("2001-09-01", "true", 365))
def monthly_run(spark, sf_dir):
    """K4 on schema1 files, then K5 with the schema2 files; returns flat_EVAL (two run dates)."""
    landing, landed = _landed(spark, sf_dir)
    first = landed.filter(F.col("NAME") < F.lit("2022"))
    later = landed.filter(F.col("NAME") >= F.lit("2022"))
    cfg = _run_config(spark, "monthly")
    cfg = RunConfig(**{**cfg.__dict__, "min_days": 365})
    ws = fx.weather_source(spark, sf_dir)
    try:
        KR.setup_run(spark, cfg, first, ws, "1998_02_01", scratch_path(spark, "db", cfg.database), bulk=False)
        out = KR.monthly_run(spark, cfg, later, ws, "2001_09_01")
    finally:
        spark.catalog.setCurrentDatabase("default")
    return spark.table(f"{cfg.database}.{out['flat_eval']}")


REPORT_STATIONS = ["A", "R"]
REASONS = "CASE " + " ".join(f"WHEN {c} = EXPLAIN THEN '{c}'" for c in RP.EXPLAINERS) + " END"


@register("forecast_report", with_ctes(EXPLAINED) + f"""
, f AS (SELECT * FROM explained WHERE STATION_ID IN ('A', 'R')
        AND DATE >= DATE '1996-01-01' AND DATE <= DATE '1996-12-31'),
g AS (SELECT *, greatest({', '.join(RP.EXPLAINERS)}) AS EXPLAIN FROM f),
r AS (SELECT STATION_ID, strftime(DATE, '%Y-%m-%d') AS DATE, PRED, {REASONS} AS REASON, EXPLAIN,
             {', '.join(f'{e} AS {b}' for e, b in zip(RP.EXPLAINERS, RP.BUSINESS_NAMES))} FROM g),
codes AS (SELECT REASON, CAST(dense_rank() OVER (ORDER BY REASON) - 1 AS INTEGER) AS REASON_CODE
          FROM (SELECT DISTINCT REASON FROM r WHERE REASON IS NOT NULL))
SELECT r.*, coalesce(c.REASON_CODE, -1) AS REASON_CODE FROM r LEFT JOIN codes c ON r.REASON = c.REASON""")
def forecast_report(spark, sf_dir):
    return RP.forecast_report(fx.explained(spark, sf_dir), REPORT_STATIONS, "1996-01-01", "1996-12-31")


@register("model_monitor", with_ctes(PREDS, """yearly AS (
  SELECT CAST(date_trunc('year', DATE) AS DATE) AS RUN_DATE, STATION_ID,
         round(sqrt(avg((y_true - y_score) * (y_true - y_score))), 4) AS rmse
  FROM preds GROUP BY 1, 2)""") + """
SELECT strftime(r.RUN_DATE, '%Y-%m-%d') AS RUN_DATE, k.STATION_ID, y.rmse AS RMSE
FROM (SELECT DISTINCT RUN_DATE FROM yearly WHERE STATION_ID IN ('A', 'N', 'X')) r
CROSS JOIN (VALUES ('A'), ('N'), ('X')) k(STATION_ID)
LEFT JOIN yearly y ON y.RUN_DATE = r.RUN_DATE AND y.STATION_ID = k.STATION_ID""")
def model_monitor(spark, sf_dir):
    p = fx.preds(spark, sf_dir)
    evals = (p.groupBy(F.trunc("DATE", "year").alias("RUN_DATE"), "STATION_ID")
             .agg(F.round(F.sqrt(F.avg((F.col("y_true") - F.col("y_score")) ** 2)), 4).alias("rmse")))
    return RP.model_monitor(evals, ["A", "N", "X"])


@register("next_ingest", with_ctes(TRIPS) + """
, l AS (SELECT CAST(max(STARTTIME) AS DATE) AS LAST_TRIP_DATE FROM trips),
n AS (SELECT LAST_TRIP_DATE, CAST(date_trunc('month', LAST_TRIP_DATE + INTERVAL 1 MONTH) AS DATE) AS NEXT_INGEST FROM l)
SELECT LAST_TRIP_DATE, NEXT_INGEST,
       strftime(NEXT_INGEST, '%Y%m') || CASE WHEN NEXT_INGEST <= DATE '2016-12-01'
            THEN '-citibike-tripdata.zip' ELSE '-citibike-tripdata.csv.zip' END AS FILE_NAME,
       strftime(NEXT_INGEST + INTERVAL 1 MONTH, '%Y_%m_%d') AS RUN_DATE FROM n""")
def next_ingest(spark, sf_dir):
    return RP.next_ingest(fx.trips(spark, sf_dir))


# ------------------------------------------------------------ A: loads that remember, records that don't fit

def _load_key(spark, sf_dir):
    """(landing folder, table): schema2 files landed, the table not made yet."""
    landing, _ = _landed(spark, sf_dir, ("schema2",))
    name = _name("raw_loaded")
    return landing, name, scratch_path(spark, "tables", name)


@register("load_files_once", with_ctes(RAW2) + f"SELECT {CONF} FROM raw2")
def load_files_once(spark, sf_dir):
    """A6 with the ledger: half of the files, then all of them, then all again."""
    landing, name, path = _load_key(spark, sf_dir)
    files = L.listing(spark, landing, "*.csv.gz")
    L.load_files(spark, files.where(F.col("NAME") < "2025"), K.SCHEMA2, name, path)
    for _ in range(2):
        L.load_files(spark, files, K.SCHEMA2, name, path)
    return spark.table(name).select(*K.CONFORMED_COLUMNS)


_MONTH2 = f"strftime(o_orderdate + INTERVAL {RAW2_SHIFT} MONTH, '%Y%m')"


@register("load_report", f"""
SELECT {_MONTH2} || '-citibike-tripdata.csv.gz' AS NAME, CASE WHEN {_MONTH2} < '2025' THEN 'LOADED' ELSE 'NEW' END AS STATUS,
       CASE WHEN {_MONTH2} >= '2025' THEN count(*) END AS N_ROWS, CASE WHEN {_MONTH2} >= '2025' THEN CAST(0 AS BIGINT) END AS N_REJECTED
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY {_MONTH2}""")
def load_report(spark, sf_dir):
    """What the second of two overlapping loads finds and does, by file."""
    landing, name, path = _load_key(spark, sf_dir)
    files = L.listing(spark, landing, "*.csv.gz")
    L.load_files(spark, files.where(F.col("NAME") < "2025"), K.SCHEMA2, name, path)
    return L.load_files(spark, files, K.SCHEMA2, name, path).select("NAME", "STATUS", "N_ROWS", "N_REJECTED")


def _odd_records(spark, sf_dir):
    """Every order as a schema2 record, some of them odd: two fields missing (key mod 7 = 0), one
    too many (1), a quoted field with a line break, a comma and quotes (2)."""
    key, cols = F.col("o_orderkey"), []
    for c in K.SCHEMA2_COLUMNS:
        cols.append({"ride_id": key.cast("string"), "USERTYPE": F.col("o_orderstatus"),
                     "END_STATION_NAME": F.when(key % 7 == 2, F.concat(F.lit('"a ""b"",\n'), key.cast("string"), F.lit('"'))).otherwise("\\N")
                     }.get(c, F.lit("NULL")))
    line = F.when(key % 7 == 0, F.concat_ws(",", *cols[:-2])).when(key % 7 == 1, F.concat_ws(",", *cols, F.lit("more"))).otherwise(F.concat_ws(",", *cols))
    landing = scratch_path(spark, "odd")
    orders = fx.load(spark, sf_dir, "orders").select(line.alias("value"))
    # the header is a file's first line, so the first row of each partition, which is a file, brings it along
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.when(first, F.lit(",".join(K.SCHEMA2_COLUMNS) + "\n")).otherwise("")
    orders.select(F.concat(header, "value").alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", 0).text(landing)
    return landing


@register("rejected_records", """
SELECT CAST(o_orderkey AS VARCHAR) AS ride_id, o_orderstatus AS USERTYPE,
       CASE WHEN o_orderkey % 7 = 2 THEN 'a "b",' || chr(10) || o_orderkey END AS END_STATION_NAME, CAST(NULL AS VARCHAR) AS REASON
FROM orders WHERE o_orderkey % 7 > 1
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL, CASE o_orderkey % 7 WHEN 0 THEN 'too few fields' ELSE 'too many fields' END
FROM orders WHERE o_orderkey % 7 < 2""")
def rejected_records(spark, sf_dir):
    """A1: records that fit as rows, the others with the reason; every record is one or the other."""
    landing = _odd_records(spark, sf_dir)
    rows = L.read_checked(spark, [landing], K.SCHEMA2)
    bad = L.rejects(rows, len(K.SCHEMA2_COLUMNS)).select(
        F.substring_index("RECORD", ",", 1).alias("ride_id"), F.lit(None).cast("string").alias("USERTYPE"),
        F.lit(None).cast("string").alias("END_STATION_NAME"), "REASON")
    good = rows.where(F.col(L.REJECTED).isNull()).select("ride_id", "USERTYPE", "END_STATION_NAME", F.lit(None).cast("string").alias("REASON"))
    return good.unionByName(bad)
