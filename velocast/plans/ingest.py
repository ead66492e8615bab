"""K1-K3: trip schemas, conforming transform and incremental / bulk loads."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RunConfig
from ..functions.dates import normalize_datetime, parse_timestamp
from ..operators.relational import COUNT, DATE, STATION, daily_counts
from ..session import cut_lineage
from ..sources import catalog as C
from ..sources import files as A
from ..sources import ledger as L

# The column lists of the two raw schema versions and the
# conformed trips table, in the order the files and the table declare them.
SCHEMA1_COLUMNS = [
    "TRIPDURATION", "STARTTIME", "STOPTIME", "START_STATION_ID", "START_STATION_NAME",
    "START_STATION_LATITUDE", "START_STATION_LONGITUDE", "END_STATION_ID", "END_STATION_NAME",
    "END_STATION_LATITUDE", "END_STATION_LONGITUDE", "BIKEID", "USERTYPE", "BIRTH_YEAR", "GENDER",
]
SCHEMA2_COLUMNS = [
    "ride_id", "rideable_type", "STARTTIME", "STOPTIME", "START_STATION_NAME", "START_STATION_ID",
    "END_STATION_NAME", "END_STATION_ID", "START_STATION_LATITUDE", "START_STATION_LONGITUDE",
    "END_STATION_LATITUDE", "END_STATION_LONGITUDE", "USERTYPE",
]
CONFORMED_COLUMNS = [
    "STARTTIME", "STOPTIME", "START_STATION_NAME", "START_STATION_ID", "END_STATION_NAME",
    "END_STATION_ID", "START_STATION_LATITUDE", "START_STATION_LONGITUDE", "END_STATION_LATITUDE",
    "END_STATION_LONGITUDE", "USERTYPE",
]


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


SCHEMA1 = _strings(SCHEMA1_COLUMNS)
SCHEMA2 = _strings(SCHEMA2_COLUMNS)
SCHEMAS = {"schema1": SCHEMA1, "schema2": SCHEMA2}


def transform_trips(raw1: DataFrame, raw2: DataFrame) -> DataFrame:
    """K1: F5 + G1 + G2: union both versions by name, normalise and parse both times.

    Output: conformed columns, STARTTIME/STOPTIME as timestamps.
    """
    u = raw1.select(*CONFORMED_COLUMNS).unionByName(raw2.select(*CONFORMED_COLUMNS))
    return u.withColumns({
        "STARTTIME": parse_timestamp(normalize_datetime("STARTTIME")),
        "STOPTIME": parse_timestamp(normalize_datetime("STOPTIME")),
    })


# TRIPS is a view over an append-only table partitioned by load number; a
# second table holds each load's (station, day) counts.
LOAD = "LOAD_ID"
LOADS_TABLE, LAST_LOAD, DAILY_TABLE = "velocast.loads_table", "velocast.last_load", "velocast.daily_table"


def _db_location(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def publish_loads(spark: SparkSession, view: str, storage: str, last: int) -> str:
    """(Re)define ``view`` as the conformed columns of loads 1..``last`` of ``storage``.

    Replacing the view is the commit point of a load: readers never see a
    load that is still being written.  A copy of this definition is a
    zero-copy snapshot, because loads are never rewritten.
    """
    spark.sql(f"""CREATE OR REPLACE VIEW {view}
        TBLPROPERTIES ('{LOADS_TABLE}' = '{storage}', '{DAILY_TABLE}' = '{storage}_daily',
                       '{LAST_LOAD}' = '{int(last)}', '{C.IMMUTABLE}' = 'true')
        AS SELECT {", ".join(CONFORMED_COLUMNS)} FROM {storage} WHERE {LOAD} <= {int(last)}""")
    return view


def loads_of(spark: SparkSession, view: str) -> tuple[str, int] | None:
    """(storage table, last load) of a TRIPS load view; None for anything else."""
    if not spark.catalog.tableExists(view):
        return None
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
    if LOADS_TABLE not in props:
        return None
    return props[LOADS_TABLE], int(props[LAST_LOAD])


def _insert_load(spark: SparkSession, rows: DataFrame, table: str, load: int) -> None:
    """Write ``rows`` as partition ``load`` of ``table``, replacing only that partition.

    A load is uncommitted until the view names it, so a retried load simply
    rewrites its own partition (no duplicates); other loads are untouched.
    """
    cols = [c for c in spark.table(table).columns if c != LOAD]
    view = f"_velocast_load_{uuid.uuid4().hex[:10]}"
    rows.select(*cols).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD} = {int(load)}) "
                  f"SELECT {', '.join(f'`{c}`' for c in cols)} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def _write_daily(spark: SparkSession, storage: str, load: int, root: str | None = None) -> None:
    """The (station, day) counts of one load, read from that load's partition only."""
    rows = spark.table(storage).where(F.col(LOAD) == load)
    daily = daily_counts(rows)
    if root:
        (daily.withColumn(LOAD, F.lit(load)).write.partitionBy(LOAD)
         .mode("overwrite").option("path", root).saveAsTable(f"{storage}_daily"))
    else:
        _insert_load(spark, daily, f"{storage}_daily", load)


def daily_of(spark: SparkSession, view: str) -> DataFrame | None:
    """D1 for a TRIPS load view (or its snapshot): per (station, day) the sum of
    the counts of loads 1..last, without reading the trips; None otherwise.

    A day whose trips arrived in two loads is summed, so this equals D1 over
    the view's rows.
    """
    if not spark.catalog.tableExists(view):
        return None
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
    if DAILY_TABLE not in props:
        return None
    per_load = spark.table(props[DAILY_TABLE]).where(F.col(LOAD) <= int(props[LAST_LOAD]))
    return per_load.groupBy(STATION, DATE).agg(F.sum(COUNT).alias(COUNT))


def write_trips(spark: SparkSession, cfg: RunConfig, path: str | None = None,
                rows: DataFrame | None = None) -> str:
    """K1 as a full rebuild: TRIPS := transform(raw schema1, raw schema2), or the
    given conformed ``rows`` (the change-capture run's interim states).

    The rows become load 1 of a fresh load table (a new folder, so snapshots
    of an earlier TRIPS keep their files), and TRIPS is published over it.
    """
    t = rows if rows is not None else transform_trips(
        spark.table(f"{cfg.database}.{cfg.raw('schema1')}"), spark.table(f"{cfg.database}.{cfg.raw('schema2')}"))
    storage = f"{cfg.database}.{cfg.trips}_loads_{uuid.uuid4().hex[:8]}".lower()
    root = path or f"{_db_location(spark, cfg.database)}/{storage.split('.', 1)[1]}"
    (t.withColumn(LOAD, F.lit(1)).write.mode("overwrite").partitionBy(LOAD)
       .option("path", root).saveAsTable(storage))
    _write_daily(spark, storage, 1, root + "_daily")
    if rows is None:
        _log_files(spark, cfg, storage, 1, _files_of(spark, cfg), root + "_files")
    return publish_loads(spark, f"{cfg.database}.{cfg.trips}", storage, 1)


def append_trips(spark: SparkSession, cfg: RunConfig, rows: DataFrame, files: DataFrame | None = None) -> str:
    """K1 for new rows only: the conformed rows of newly landed files become the
    next load partition; nothing already loaded is read or rewritten.  ``files``
    (FILE_ID) names the raw files that the rows come from.

    The transform is row by row, so this equals a full rebuild from raw.
    """
    view = f"{cfg.database}.{cfg.trips}"
    storage, last = loads_of(spark, view)
    _insert_load(spark, rows, storage, last + 1)
    _write_daily(spark, storage, last + 1)
    if files is not None:
        _log_files(spark, cfg, storage, last + 1, files)
    return publish_loads(spark, view, storage, last + 1)


def _files_of(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """FILE_ID of the raw files that count, of both versions."""
    ledgers = [L.ledger_of(f"{cfg.database}.{cfg.raw(v)}") for v in SCHEMAS]
    parts = [L.latest(spark.table(t)).select(L.FILE_ID) for t in ledgers if spark.catalog.tableExists(t)]
    none = spark.createDataFrame([], f"{L.FILE_ID} string")
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else none


def _log_files(spark: SparkSession, cfg: RunConfig, storage: str, load: int, files: DataFrame, root: str | None = None) -> None:
    """The raw files of one load; they count once the view names the load."""
    if root:
        files.withColumn(LOAD, F.lit(load)).write.partitionBy(LOAD).mode("overwrite").option("path", root).saveAsTable(f"{storage}_files")
    else:
        _insert_load(spark, files, f"{storage}_files", load)


def _not_in_trips(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """FILE_ID of the raw files that no published load of TRIPS holds."""
    storage, last = loads_of(spark, f"{cfg.database}.{cfg.trips}")
    held = spark.table(f"{storage}_files").where(F.col(LOAD) <= last)
    return _files_of(spark, cfg).join(held, L.FILE_ID, "left_anti")


def incremental_elt(spark: SparkSession, cfg: RunConfig, landed: DataFrame,
                    paths: dict[str, str] | None = None) -> str:
    """K2: route landed files (A2), load each version's new files (A6), then load TRIPS (K1).

    ``landed`` is a file listing (A5) with PATH and NAME; the routing is a
    Spark expression, the per-version file lists are bounded by the number
    of monthly files.  A file is loaded once, however often it is listed; one
    that has changed since is reported by a warning and left as it was.  When
    TRIPS already exists as a load view only the raw files that it lacks are
    conformed and appended; otherwise TRIPS is built from raw.  So a run that is
    repeated, or retried after any step, adds no row twice and misses none.
    """
    paths = paths or {}
    routed = A.route_files(landed, "NAME").select("PATH", "VERSION")
    for version, schema in SCHEMAS.items():
        files = [r["PATH"] for r in routed.filter(F.col("VERSION") == version).select("PATH").collect()]
        table = f"{cfg.database}.{cfg.raw(version)}"
        if not files:
            continue
        done = L.load_files(spark, L.listing(spark, files), schema, table, paths.get(version))
        if changed := done.where("STATUS = 'CHANGED'").count():
            warnings.warn(f"{changed} files of {table} have changed since they were loaded", stacklevel=2)
    held = loads_of(spark, f"{cfg.database}.{cfg.trips}")
    if held is None or not spark.catalog.tableExists(f"{held[0]}_files"):
        return write_trips(spark, cfg, paths.get("trips"))
    new = cut_lineage(_not_in_trips(spark, cfg))
    if not new.limit(1).count():
        return f"{cfg.database}.{cfg.trips}"
    rows = [_rows_of(spark, f"{cfg.database}.{cfg.raw(v)}", new) for v in SCHEMAS]
    return append_trips(spark, cfg, transform_trips(*rows), new)


def _rows_of(spark: SparkSession, table: str, files: DataFrame) -> DataFrame:
    """The rows of ``table`` that come from ``files``; a version without a ledger has none of them."""
    store = L.store_of(table)
    if not spark.catalog.tableExists(store):
        return spark.table(table).limit(0)
    return spark.table(store).where(F.col(L.REJECTED).isNull()).join(files, L.FILE_ID, "left_semi")


def bulk_months(spark: SparkSession, first: str = "2013-06-01", last: str = "2019-12-01") -> DataFrame:
    """K3: the archive names for the reference's bulk range (201306-201912)."""
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("START"),
                                   F.lit(last).cast("date").alias("END"))
    return A.month_files(bounds)


def bulk_elt(spark: SparkSession, cfg: RunConfig, landed: DataFrame,
             paths: dict[str, str] | None = None,
             first: str = "2013-06-01", last: str = "2019-12-01") -> str:
    """K3: K2 over every landed file whose month lies in the bulk range (201306-201912)."""
    month = A.file_month(F.col("NAME"))
    chosen = landed.filter((month >= F.lit(first).cast("date")) & (month <= F.lit(last).cast("date")))
    return incremental_elt(spark, cfg, chosen, paths)
