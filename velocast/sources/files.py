"""Landed trip files -> raw tables.

CSV is read by Spark's own reader (splittable when uncompressed, one task
per gzip file otherwise).  Zip archives are not splittable and Spark has no
zip codec, so the archives' members are listed as a table and a small
``mapInPandas`` helper turns each member into CSV lines; parsing stays in ``from_csv``.
"""

from __future__ import annotations

import io
import zipfile
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SCHEMA2_FIRST_MONTH
from ..session import cut_lineage


# The two null tokens of the trip files.
NULL_TOKENS = ("\\N", "NULL")


def _null_tokens(df: DataFrame) -> DataFrame:
    """Both null tokens become NULL (Spark's reader takes only one nullValue)."""
    return df.select(*[
        F.when(F.col(f.name).isin(*NULL_TOKENS), F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields])


def read_trips_csv(spark: SparkSession, paths: list[str] | str, schema: T.StructType) -> DataFrame:
    """A1: header row skipped, '"'-quoted fields, NULL and \\N tokens -> NULL.

    gzip is detected from the file extension.
    """
    df = (spark.read.schema(schema)
          .option("header", True).option("quote", '"').option("escape", '"')
          .option("nullValue", "NULL").option("mode", "PERMISSIVE")
          .csv(paths))
    return _null_tokens(df)


def file_month(name: Column) -> Column:
    """Month date of a landed file from its 'YYYYMM-...' base name."""
    base = F.element_at(F.split(name, "/"), -1)
    return F.to_date(F.substring_index(base, "-", 1), "yyyyMM")


def route_files(files: DataFrame, name_col: str = "NAME",
                first_month: str = SCHEMA2_FIRST_MONTH) -> DataFrame:
    """A2: VERSION = schema1 for months before ``first_month``, else schema2."""
    cut = F.to_date(F.lit(first_month), "yyyyMM")
    return files.withColumn("VERSION", F.when(file_month(F.col(name_col)) < cut, F.lit("schema1"))
                            .otherwise(F.lit("schema2")))


def month_files(bounds: DataFrame, start_col: str = "START", end_col: str = "END") -> DataFrame:
    """A3: one archive name per month in [start, end].

    '-citibike-tripdata.zip' through 2016-12, '-citibike-tripdata.csv.zip' after.
    """
    m = F.explode(F.sequence(F.trunc(F.col(start_col), "MM"), F.trunc(F.col(end_col), "MM"),
                             F.expr("INTERVAL 1 MONTH"))).alias("MONTH")
    months = bounds.select(m)
    suffix = F.when(F.col("MONTH") <= F.lit("2016-12-01").cast("date"), F.lit("-citibike-tripdata.zip")) \
              .otherwise(F.lit("-citibike-tripdata.csv.zip"))
    return months.select("MONTH", F.concat(F.date_format("MONTH", "yyyyMM"), suffix).alias("NAME"))


def _open_uri(uri: str):
    """Seekable input stream for a file URI (local, HDFS or object store) via pyarrow."""
    from urllib.parse import unquote

    from pyarrow import fs as pafs
    if uri.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + unquote(uri[5:]).lstrip("/"))
    filesystem, path = pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return filesystem.open_input_file(unquote(path))


def _archive_members(batches):
    """mapInPandas helper: the central directory of each archive, a row per CSV member.

    Only the end of the archive is read.  An archive that is cut off has no
    directory and is refused.
    """
    for pdf in batches:
        out = []
        for path in pdf["path"]:
            with _open_uri(path) as raw:
                try:
                    with zipfile.ZipFile(raw) as zf:
                        out += [(path, n, m.filename, m.header_offset, m.compress_size, m.file_size)
                                for n, m in enumerate(zf.infolist()) if not m.is_dir() and not m.filename.startswith("__MACOSX/")]
                except zipfile.BadZipFile as e:
                    raise ValueError(f"{path}: {e}") from e
        yield pd.DataFrame(out, columns=["PATH", "N", "MEMBER", "OFFSET", "COMPRESSED", "LENGTH"])


def _member_lines(batches):
    """mapInPandas helper: (PATH, MEMBER, LINE_NO, LINE) of one member a row.

    A member is read through a seekable stream from its own offset on, so only
    the zip directory and the current block are in memory; lines leave in
    batches of 50,000.  A damaged member fails its checksum; bytes that are not
    UTF-8 are reported with their line.
    """
    cols = ["PATH", "MEMBER", "LINE_NO", "LINE"]
    for pdf in batches:
        for path, member in zip(pdf["PATH"], pdf["MEMBER"]):
            out, i = [], -1
            try:
                with _open_uri(path) as raw, zipfile.ZipFile(raw) as zf, zf.open(member) as fh:
                    for i, line in enumerate(io.TextIOWrapper(fh, encoding="utf-8", newline="")):
                        line = line.rstrip("\r\n")
                        if not line:        # as the CSV reader does
                            continue
                        out.append((path, member, i, line))
                        if len(out) >= 50_000:
                            yield pd.DataFrame(out, columns=cols)
                            out = []
            except (zipfile.BadZipFile, EOFError, zlib.error, UnicodeDecodeError) as e:
                raise ValueError(f"{path}, member {member}, after line {i + 1}: {e}") from e
            if out:
                yield pd.DataFrame(out, columns=cols)


def archive_members(spark: SparkSession, paths: list[str] | str, glob: str = "*.zip") -> DataFrame:
    """A4's index: PATH, N, MEMBER, OFFSET, COMPRESSED and LENGTH of every CSV member of the archives."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths).select("path")
    return listing.repartition(max(1, listing.count()), "path").mapInPandas(
        _archive_members, "PATH string, N int, MEMBER string, OFFSET long, COMPRESSED long, LENGTH long")


def archive_lines(spark: SparkSession, paths: list[str] | str, glob: str = "*.zip", first_only: bool = False) -> DataFrame:
    """A4: (PATH, MEMBER, LINE_NO, LINE) of the members, each member a task of its own."""
    members = cut_lineage(archive_members(spark, paths, glob))
    if first_only:
        members = members.where("N = 0")
    n = max(1, members.count())            # a row per member
    return members.repartition(n, "PATH", "N").mapInPandas(_member_lines, "PATH string, MEMBER string, LINE_NO long, LINE string")


def unpack_zip_csv(spark: SparkSession, paths: list[str] | str, schema: T.StructType,
                   glob: str = "*.zip", first_only: bool = False) -> DataFrame:
    """A4: read every CSV member of each zip archive (or its first) with ``schema``.

    The archives' directories are read as a table of members, and each member
    is a task (an explicit partition count, which AQE keeps), so one archive of
    many members is not one task.  The header line of each member is dropped,
    empty lines are skipped; fields are parsed JVM-side by ``from_csv``.
    """
    lines = archive_lines(spark, paths, glob, first_only)
    ddl = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    parsed = (lines.filter(F.col("LINE_NO") > 0)
              .select(F.from_csv("LINE", ddl, {"quote": '"', "escape": '"', "nullValue": "NULL"}).alias("R"))
              .select("R.*"))
    return _null_tokens(parsed)


def zip_records(spark: SparkSession, paths: list[str], schema: T.StructType, rejected: str, file: str) -> DataFrame:
    """A4 with every record accounted for: the columns of ``schema``, ``rejected`` (the line, where
    its number of fields is not the schema's) and ``file``, the archive."""
    listing = spark.read.format("binaryFile").load(paths).select("path", F.col("_metadata.file_path").alias(file))
    lines = archive_lines(spark, paths, "*")
    ddl = ", ".join(f"`{f.name}` STRING" for f in schema.fields) + f", `{rejected}` STRING"
    options = {"quote": '"', "escape": '"', "nullValue": "NULL", "columnNameOfCorruptRecord": rejected}
    parsed = lines.filter(F.col("LINE_NO") > 0).select("PATH", F.from_csv("LINE", ddl, options).alias("R"))
    return parsed.join(listing, parsed["PATH"] == listing["path"]).select("R.*", file)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """A5: landed files matching ``glob``: PATH, NAME, LENGTH, MODIFIED (content never read)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(path))
    return df.select(F.col("path").alias("PATH"), F.element_at(F.split("path", "/"), -1).alias("NAME"),
                     F.col("length").alias("LENGTH"), F.col("modificationTime").alias("MODIFIED"))


def read_files(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """Rows of the listed landed files (gzip/plain CSV and zip archives); none -> empty."""
    csv = [f for f in files if not f.endswith(".zip")]
    zips = [f for f in files if f.endswith(".zip")]
    parts = []
    if csv:
        parts.append(read_trips_csv(spark, csv, schema))
    if zips:
        parts.append(unpack_zip_csv(spark, zips, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df


def append_files_to_raw(spark: SparkSession, files: list[str], schema: T.StructType,
                        table: str, path: str | None = None) -> int:
    """Append the listed files to ``table``; no files -> nothing happens.

    Returns the number of files appended.
    """
    if not files:
        return 0
    w = read_files(spark, files, schema).write.mode("append")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return len(files)


def empty_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> str:
    """Create an empty table with ``schema`` (replacing any old one)."""
    w = spark.createDataFrame([], schema).write.mode("overwrite")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def table_like(spark: SparkSession, source: str, name: str, path: str | None = None) -> str:
    """Empty table with another table's schema."""
    return empty_table(spark, name, spark.table(source).schema, path)


def stage_monthly_files(df: DataFrame, month_col: str, landing: str, suffix: str = "-citibike-tripdata.csv.gz",
                        null_value: str = "NULL", rows_per_file: int = 5_000_000,
                        compression: str = "gzip") -> list[str]:
    """Land ``df`` as gzip CSV files named ``YYYYMM[-i]<suffix>`` (the extract step's output).

    Each month gets ceil(rows / ``rows_per_file``) writers (a per-month count,
    one small broadcast row per month), and rows are spread over them by a
    hash salt, so a month holding a third of all trips is not one task.  The
    driver only renames the finished files (file-system metadata).
    """
    spark = df.sparkSession
    tmp = landing.rstrip("/") + "/_write"
    per_month = (df.groupBy(month_col).agg(F.count(F.lit(1)).alias("_ROWS"))
                 .select(month_col, F.greatest(F.lit(1), F.ceil(F.col("_ROWS") / F.lit(rows_per_file)))
                         .cast("long").alias("_FILES")))
    months = per_month.withColumnRenamed(month_col, "_LANDING_MONTH")
    salted = df.join(months, df[month_col].eqNullSafe(months["_LANDING_MONTH"])).drop("_LANDING_MONTH").withColumn(
        "_SALT", F.pmod(F.xxhash64(*df.columns), F.col("_FILES"))).drop("_FILES")
    (salted.repartition(F.col(month_col), F.col("_SALT")).drop("_SALT").write.mode("overwrite")
       .partitionBy(month_col)
       .option("header", True).option("compression", compression).option("nullValue", null_value)
       .option("quote", '"').option("escape", '"').csv(tmp))
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(tmp)
    fs = root.getFileSystem(conf)
    out = []
    for d in fs.listStatus(root):
        name = d.getPath().getName()
        if not d.isDirectory() or "=" not in name:
            continue
        month = name.split("=", 1)[1]
        parts = [s.getPath() for s in fs.listStatus(d.getPath()) if s.getPath().getName().startswith("part-")]
        for i, p in enumerate(sorted(parts, key=lambda x: x.getName())):
            tag = "" if len(parts) == 1 else f"-{i}"
            dest = jvm.org.apache.hadoop.fs.Path(landing.rstrip("/") + f"/{month}{suffix.replace('.csv', tag + '.csv')}")
            if fs.exists(dest):     # landed before: replaced
                fs.delete(dest, False)
            if not fs.rename(p, dest):
                raise OSError(f"cannot move {p.toString()} to {dest.toString()}")
            out.append(dest.toString())
    fs.delete(root, True)
    return sorted(out)


def _zip_and_write(batches):
    """mapInPandas helper: each CSV file -> a one-member zip archive written next to
    its target name through pyarrow's file systems (local, HDFS, object stores)."""
    from pyarrow import fs as pafs
    for pdf in batches:
        out = []
        for src, dest, content in zip(pdf["path"], pdf["DEST"], pdf["content"]):
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as zf:
                member = dest.rsplit("/", 1)[-1].replace(".zip", "")
                zf.writestr(member if member.endswith(".csv") else member + ".csv", content)
            filesystem, path = pafs.FileSystem.from_uri(dest if "://" in dest else "file://" + dest)
            with filesystem.open_output_stream(path) as fh:
                fh.write(buf.getvalue())
            out.append((dest, len(buf.getvalue())))
        yield pd.DataFrame(out, columns=["PATH", "LENGTH"])


def stage_monthly_zips(df: DataFrame, month_col: str, landing: str,
                       null_value: str = "NULL", rows_per_file: int = 5_000_000) -> DataFrame:
    """Land ``df`` as one zip archive per month with the download naming rule
    ('-citibike-tripdata.zip' through 2016-12, '.csv.zip' after).

    Spark writes plain CSV per month; executors then wrap each file in a zip
    archive (one file per task row, nothing passes through the driver).
    """
    spark = df.sparkSession
    plain = landing.rstrip("/") + "/_csv"
    stage_monthly_files(df, month_col, plain, suffix="-citibike-tripdata.csv", null_value=null_value,
                        rows_per_file=rows_per_file, compression="none")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(plain)
    base = F.element_at(F.split("path", "/"), -1)          # YYYYMM-citibike-tripdata[-i].csv
    month = F.to_date(F.substring_index(base, "-", 1), "yyyyMM")
    name = F.when(month <= F.lit("2016-12-01").cast("date"), F.regexp_replace(base, r"\.csv$", ".zip")) \
            .otherwise(F.concat(base, F.lit(".zip")))
    dest = F.concat(F.lit(landing.rstrip("/") + "/"), name)
    return files.select("path", "content", dest.alias("DEST")).mapInPandas(
        _zip_and_write, "PATH string, LENGTH long")
