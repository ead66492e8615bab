"""A6 and A1 with a memory: every landed file is loaded once, every record is accounted for.

A loaded table is a view over a store of rows partitioned by file, and a ledger of the files that
count.  A load writes the partitions of its files, then appends their ledger rows, which is the
commit: readers see a file's rows from then on.  A load that is run again, or cut off and retried,
finds its files in the ledger, or writes the same partitions again; no row comes twice.  A file
whose length or time of modification has changed since it was loaded is reported, and loaded in
place of its old rows only when asked to.

Records that do not fit the schema are not rows: they stay in the store as text, with a reason.
One load at a time may write to a table.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files as A
from .catalog import overwrite_partitions

REJECTED, FILE, FILE_ID = "REJECTED", "FILE", "FILE_ID"
LEDGER = "PATH STRING, NAME STRING, LENGTH BIGINT, MODIFIED TIMESTAMP, FILE_ID STRING, N_ROWS BIGINT, N_REJECTED BIGINT, LOADED_AT TIMESTAMP"


def store_of(table: str) -> str:
    return f"{table}_store"


def ledger_of(table: str) -> str:
    return f"{table}_files"


def rejects_of(table: str) -> str:
    return f"{table}_rejects"


def listing(spark: SparkSession, paths: list[str] | str, glob: str = "*") -> DataFrame:
    """PATH, NAME, LENGTH, MODIFIED of the files under ``paths``, as the readers name them."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(paths)
    return df.select(F.col("_metadata.file_path").alias("PATH"), F.element_at(F.split("path", "/"), -1).alias("NAME"),
                     F.col("_metadata.file_size").alias("LENGTH"), F.col("_metadata.file_modification_time").alias("MODIFIED"))


def latest(ledger: DataFrame) -> DataFrame:
    """The ledger row that counts for each path: the last one loaded."""
    cols = [c for c in ledger.columns if c != "PATH"]
    return ledger.groupBy("PATH").agg(F.max_by(F.struct(*cols), "LOADED_AT").alias("r")).select("PATH", "r.*")


def status(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """``listed`` with STATUS: NEW, LOADED, or CHANGED where length or time differ from the ledger's."""
    old = latest(ledger).select("PATH", F.col("LENGTH").alias("_L"), F.col("MODIFIED").alias("_M"))
    same = F.col("LENGTH").eqNullSafe(F.col("_L")) & F.col("MODIFIED").eqNullSafe(F.col("_M"))
    return listed.join(old, "PATH", "left").withColumn(
        "STATUS", F.when(F.col("_L").isNull(), "NEW").when(same, "LOADED").otherwise("CHANGED")).drop("_L", "_M")


def read_checked(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """A1: the columns of ``schema``, FILE, and REJECTED: the record's text where its number of
    fields is not the schema's (its columns are null then).

    Header skipped, quoted fields may hold line breaks, both null tokens are null.  A file is one
    task; the landing writer bounds the size of files.
    """
    csv, zips = [p for p in paths if not p.endswith(".zip")], [p for p in paths if p.endswith(".zip")]
    parts = []
    if csv:
        full = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
        parts.append(spark.read.schema(full).option("header", True).option("quote", '"').option("escape", '"')
                     .option("nullValue", "NULL").option("multiLine", True).option("mode", "PERMISSIVE")
                     .option("columnNameOfCorruptRecord", REJECTED).option("columnPruning", False).csv(csv)
                     .select(*schema.fieldNames(), REJECTED, F.col("_metadata.file_path").alias(FILE)))
    if zips:
        parts.append(A.zip_records(spark, zips, schema, REJECTED, FILE))
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType()), T.StructField(FILE, T.StringType())]))
    df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    clean = lambda c: F.when(F.col(REJECTED).isNull() & ~F.col(c).isin(*A.NULL_TOKENS), F.col(c)).alias(c)
    # Spark reads no bad records alone, so their text is tied to a column of the schema
    text = F.concat(F.substring(F.coalesce(F.col(schema.fieldNames()[0]), F.lit("")), 1, 0), F.col(REJECTED))
    return df.select(*[clean(c) for c in schema.fieldNames()], text.alias(REJECTED), FILE)


def reason(record: Column, fields: int) -> Column:
    """Why a record was rejected."""
    wide = F.from_csv(record, ", ".join(f"c{i} STRING" for i in range(fields + 2)), {"quote": '"', "escape": '"'})
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    return F.when(quotes % 2 == 1, "unterminated quote").when(wide[f"c{fields}"].isNotNull(), "too many fields").otherwise("too few fields")


def rejects(rows: DataFrame, fields: int) -> DataFrame:
    """(FILE, RECORD, REASON) of the records of :func:`read_checked` that are not rows."""
    bad = rows.where(F.col(REJECTED).isNotNull())
    return bad.select(FILE, F.col(REJECTED).alias("RECORD"), reason(F.col(REJECTED), fields).alias("REASON"))


def create(spark: SparkSession, table: str, schema: T.StructType, path: str | None = None) -> str:
    """The store, the ledger and the views of ``table``, empty.  Rows that a plain table of that
    name holds are taken over, as a file of that table's name."""
    store, ledger, root = store_of(table), ledger_of(table), (path or "").rstrip("/")
    at = lambda name: f" LOCATION '{root}/{name}'" if root else ""
    cols = ", ".join(f"`{f.name}`" for f in schema.fields)
    spark.sql(f"CREATE TABLE {store} ({schema.toDDL()}, {REJECTED} STRING, {FILE} STRING, {FILE_ID} STRING) USING parquet "
              f"PARTITIONED BY ({FILE_ID}){at('store')}")
    spark.sql(f"CREATE TABLE {ledger} ({LEDGER}) USING parquet{at('files')}")
    if spark.catalog.tableExists(table):
        before = spark.table(table).select(*schema.fieldNames())
        if n := before.count():
            overwrite_partitions(before.withColumns({REJECTED: F.lit(None).cast("string"), FILE: F.lit(table), FILE_ID: F.lit("before")}), store, FILE_ID)
            _log(spark, ledger, spark.range(1).select(F.lit(table).alias("PATH"), F.lit(table).alias("NAME"), F.lit(0).alias("LENGTH"), F.lit(None).alias("MODIFIED"),
                                                      F.lit("before").alias(FILE_ID), F.lit(n).alias("N_ROWS"), F.lit(0).alias("N_REJECTED")))
        spark.sql(f"DROP TABLE {table}")
    counts = f"(SELECT max_by({FILE_ID}, LOADED_AT) AS {FILE_ID} FROM {ledger} GROUP BY PATH)"
    spark.sql(f"CREATE VIEW {table} AS SELECT {cols} FROM {store} WHERE {REJECTED} IS NULL AND {FILE_ID} IN {counts}")
    spark.sql(f"CREATE VIEW {rejects_of(table)} AS SELECT {FILE}, {REJECTED} AS RECORD FROM {store} "
              f"WHERE {REJECTED} IS NOT NULL AND {FILE_ID} IN {counts}")
    return table


def _log(spark: SparkSession, ledger: str, entries: DataFrame) -> None:
    entries.withColumn("LOADED_AT", F.current_timestamp()).select(
        *[F.col(f.name).cast(f.dataType) for f in spark.table(ledger).schema.fields]).coalesce(1).write.insertInto(ledger)


def load_files(spark: SparkSession, listed: DataFrame, schema: T.StructType, table: str, path: str | None = None,
               on_change: str = "report") -> DataFrame:
    """Load the files of ``listed`` (see :func:`listing`) that ``table`` does not hold yet.

    Returns the listing with STATUS as it was before the load, N_ROWS and N_REJECTED of the files
    loaded now (null for the others).  ``on_change="reload"`` puts a changed file's rows in place
    of its old ones; ``"report"`` leaves them.  The table is made on first use; a file without
    rows is recorded too.
    """
    if on_change not in ("report", "reload"):
        raise ValueError("on_change must be report or reload")
    if not spark.catalog.tableExists(ledger_of(table)):
        create(spark, table, schema, path)
    known = status(listed.select("PATH", "NAME", "LENGTH", "MODIFIED").distinct(), spark.table(ledger_of(table)))
    version = F.substring(F.sha2(F.concat_ws("|", "PATH", "LENGTH", F.unix_micros("MODIFIED")), 256), 1, 32)
    found = known.withColumn(FILE_ID, version).collect()  # a row per landed file
    load = [r for r in found if r["STATUS"] == "NEW" or (r["STATUS"] == "CHANGED" and on_change == "reload")]
    fields = "PATH string, NAME string, LENGTH long, MODIFIED timestamp, STATUS string, FILE_ID string"
    now = spark.createDataFrame(load, fields)
    counts = None
    if load:
        rows = read_checked(spark, [unquote(r["PATH"]) for r in load], schema)  # the listing's names are encoded
        overwrite_partitions(rows.join(now.select(F.col("PATH").alias(FILE), FILE_ID), FILE), store_of(table), FILE_ID)
        spark.catalog.refreshTable(store_of(table))
        written = spark.table(store_of(table)).where(F.col(FILE_ID).isin([r[FILE_ID] for r in load]))
        counts = written.groupBy(FILE_ID).agg(F.count_if(F.col(REJECTED).isNull()).alias("N_ROWS"), F.count(REJECTED).alias("N_REJECTED"))
        _log(spark, ledger_of(table), now.join(counts, FILE_ID, "left").na.fill(0, ["N_ROWS", "N_REJECTED"]))
        for name in (ledger_of(table), table, rejects_of(table)):
            spark.catalog.refreshTable(name)
    out = spark.createDataFrame(found, fields)
    logged = spark.table(ledger_of(table)).where(F.col(FILE_ID).isin([r[FILE_ID] for r in load])).select(FILE_ID, "N_ROWS", "N_REJECTED")
    return out.join(logged, FILE_ID, "left").drop(FILE_ID)
