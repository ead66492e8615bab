"""Tables, views, snapshots, tags and bounded fetches on Spark's catalog."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _writer(df: DataFrame, mode: str, path: str | None):
    w = df.write.mode(mode)
    return w.option("path", path) if path else w


def write_overwrite(df: DataFrame, table: str, path: str | None = None) -> str:
    """Replace ``table`` with the result of ``df`` (never a query over itself)."""
    _writer(df, "overwrite", path).saveAsTable(table)
    return table


def write_append(df: DataFrame, table: str, path: str | None = None) -> str:
    """A10: append a run's rows to a history table."""
    _writer(df, "append", path).saveAsTable(table)
    return table


def overwrite_partitions(rows: DataFrame, table: str, by: str) -> None:
    """Put ``rows`` in place of the partitions of ``table`` that they belong to; others stay."""
    spark, key = rows.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    view, before = f"_velocast_rows_{uuid.uuid4().hex[:10]}", spark.conf.get(key)
    rows.select(*spark.table(table).columns).createOrReplaceTempView(view)
    spark.conf.set(key, "dynamic")
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({by}) SELECT * FROM {view}")
    finally:
        spark.conf.set(key, before)
        spark.catalog.dropTempView(view)


def temp_table(df: DataFrame, name: str, cache: bool = True) -> DataFrame:
    """Session-scoped table (cached temp view)."""
    if cache:
        df = df.cache()
    df.createOrReplaceTempView(name)
    return df


def create_view(df: DataFrame, name: str) -> str:
    """Named view over a lazy query."""
    df.createOrReplaceTempView(name)
    return name


def ensure_table(spark: SparkSession, name: str, generate: Callable[[], DataFrame]) -> DataFrame:
    """Use the table if it exists, otherwise the generated frame."""
    return spark.table(name) if spark.catalog.tableExists(name) else generate()


# Table property marking a table whose files are never rewritten in place.
IMMUTABLE = "velocast.immutable"


def write_immutable(df: DataFrame, table: str, root: str) -> str:
    """A9 for tables that runs snapshot: each write goes to a fresh folder under
    ``root`` and the table is re-pointed to it (an external table, so the
    folder of the previous state is kept).  Snapshots of it are metadata only.
    """
    location = f"{root.rstrip('/')}/v={uuid.uuid4().hex}"
    _writer(df, "overwrite", location).saveAsTable(table)
    tag_lineage(df.sparkSession, table, {IMMUTABLE: "true"})
    return table


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def snapshot_table(spark: SparkSession, source: str, name: str, path: str | None = None) -> str:
    """Point-in-time copy of ``source`` for a run.

    When ``source`` was written by ``write_immutable`` its folder never
    changes, so the snapshot is a second external table over the same files
    (zero-copy, like a clone).  A view marked immutable (TRIPS over its
    committed loads) is snapshotted as a second view with the same text.
    Any other table is copied.
    """
    props = {r["key"]: r["value"] for r in read_tags(spark, source).collect()}
    if props.get(IMMUTABLE) != "true":
        return write_overwrite(spark.table(source), name, path)
    if is_view(spark, source):
        text = (spark.sql(f"DESCRIBE TABLE EXTENDED {source}")
                .filter("col_name = 'View Text'").collect()[0]["data_type"])
        keep = ", ".join(f"'{k}' = '{v}'" for k, v in props.items() if k.startswith("velocast."))
        spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({keep}) AS {text}")
        return name
    location = table_location(spark, source)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    tag_lineage(spark, name, {IMMUTABLE: "true"})
    return name


def is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "VIEW"


def tag_lineage(spark: SparkSession, table: str, tags: dict[str, str]) -> str:
    """Attach properties such as model_id to a table (or view)."""
    props = ", ".join(f"'{k}' = '{v}'" for k, v in tags.items())
    kind = "VIEW" if is_view(spark, table) else "TABLE"
    spark.sql(f"ALTER {kind} {table} SET TBLPROPERTIES ({props})")
    return table


def read_tags(spark: SparkSession, table: str) -> DataFrame:
    """The table's properties as (key, value) rows."""
    return spark.sql(f"SHOW TBLPROPERTIES {table}")


def reset_database(spark: SparkSession, database: str, empty_tables: dict[str, T.StructType],
                   location: str | None = None) -> str:
    """Drop and recreate the working database with empty raw tables."""
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE {database}{loc}")
    for name, schema in empty_tables.items():
        spark.createDataFrame([], schema).write.mode("overwrite").saveAsTable(f"{database}.{name}")
    return database


def local_to_table(spark: SparkSession, pdf: pd.DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """A small local (pandas) frame as a Spark DataFrame (Arrow path)."""
    return spark.createDataFrame(pdf, schema=schema)


def table_schema(df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    rows = [Row(POSITION=i, NAME=f.name, TYPE=f.dataType.simpleString(), NULLABLE=f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "POSITION int, NAME string, TYPE string, NULLABLE boolean")


def column_profile(df: DataFrame) -> DataFrame:
    """A18 with the data: position, name and type of each column, its rows and nulls, in one aggregate."""
    fields = list(enumerate(df.schema.fields))
    sums = df.agg(F.count(F.lit(1)).alias("N"), *[F.count(f"`{f.name}`").alias(f"C{i}") for i, f in fields])
    row = lambda i, f: F.struct(F.lit(i).alias("POSITION"), F.lit(f.name).alias("NAME"), F.lit(f.dataType.simpleString()).alias("TYPE"),
                                F.col("N").alias("N_ROWS"), (F.col("N") - F.col(f"C{i}")).alias("N_NULL"))
    return sums.select(F.inline(F.array(*[row(i, f) for i, f in fields])))


def run_sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None,
            args: dict | None = None) -> DataFrame:
    """SQL text over named frames, with named parameters (``:name``)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args or {})


def fetch_bounded(df: DataFrame, n: int) -> pd.DataFrame:
    """At most ``n`` rows to the client (the limit runs in Spark)."""
    return df.limit(n).toPandas()


def iterate_rows(df: DataFrame) -> Iterator[Row]:
    """A row iterator that holds one partition at a time on the client."""
    return df.toLocalIterator(prefetchPartitions=False)
