"""Change capture as batch merges and as a Structured Streaming job.

Change records carry the target's columns plus ACTION ('INSERT'/'DELETE'),
ISUPDATE and a sequence number.  An update arrives as a DELETE + INSERT pair
with ISUPDATE = true (the change-stream convention).

A merge applied twice gives the same table as once (the last change of a key
decides), so a micro-batch that is replayed, or was cut off half-way, is simply
applied again.  The streaming target is a plain Spark table partitioned by a hash
of the key: a batch reads and overwrites only the partitions that its keys fall
into, and Spark's own commit of a partition overwrite is the only commit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.catalog import overwrite_partitions, read_tags

ACTION, ISUPDATE, SEQ = "ACTION", "ISUPDATE", "SEQ"
META = (ACTION, ISUPDATE, SEQ)


def reduce_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """One change per key: the highest SEQ; on equal SEQ the INSERT side wins
    (then the larger row hash, for determinism).

    An aggregate (max_by) rather than a window, so a key with very many
    changes is combined map-side instead of landing in one task.
    """
    cols = [c for c in changes.columns if c not in keys]
    # the row hash breaks remaining ties deterministically, so a recomputed
    # task (after a lost executor) picks the same change
    order = F.struct(F.col(SEQ), F.when(F.col(ACTION) == "INSERT", 1).otherwise(0), F.xxhash64(*cols))
    best = F.max_by(F.struct(*cols), order).alias("_C")
    return changes.groupBy(*keys).agg(best).select(*keys, "_C.*")


def _key_match(t: DataFrame, c: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [t[k].eqNullSafe(c[k]) for k in keys])


def merge_changes(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Apply change records to ``target`` (returns the new table state).

    matched + INSERT + ISUPDATE -> row replaced; matched + DELETE -> removed;
    not matched + INSERT -> inserted; anything else leaves the target as is.
    Columns are matched by name; keys compare null-safely.

    Kept, replaced and removed rows come from one left join of the target with
    the changes reduced to one per key, which Spark broadcasts if they are
    small by bytes; inserted rows are those changes that an anti-join against
    the target's key columns leaves.
    """
    red = reduce_changes(changes.select(*target.columns, *META), keys)
    t, c = target.alias("t"), red.alias("c")
    is_insert = F.col(f"c.{ACTION}") == "INSERT"
    replaced = is_insert & F.coalesce(F.col(f"c.{ISUPDATE}"), F.lit(False))
    kept = (t.join(c, _key_match(t, c, keys), "left")
            .filter(F.col(f"c.{ACTION}").isNull() | is_insert)
            .select(*[F.col(f"t.{x}") if x in keys else
                      F.when(replaced, F.col(f"c.{x}")).otherwise(F.col(f"t.{x}")).alias(x)
                      for x in target.columns]))
    known = target.select(*keys).alias("k")
    new = c.filter(is_insert).join(known, reduce(lambda a, b: a & b, [
        F.col(f"c.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys]), "left_anti")
    return kept.unionByName(new.select(*[F.col(f"c.{x}") for x in target.columns]))


def snapshot_diff(before: DataFrame | None, after: DataFrame, keys: list[str]) -> DataFrame:
    """Change set between two states; with no ``before`` every row is an INSERT.

    Rows whose non-key columns differ (null-safe) yield a DELETE of the old
    and an INSERT of the new row, both with ISUPDATE = true.  States are
    multisets: a row that repeats counts as often as it is there, and the rows of
    a repeated key are updates where both sides have some that the other lacks.
    """
    cols = after.columns
    if before is None:
        return after.select(*cols, F.lit("INSERT").alias(ACTION), F.lit(False).alias(ISUPDATE))
    side = lambda df, n: df.select(*cols, F.lit(n).cast("long").alias("_N"))
    # equal rows of both states cancel out in one aggregate, which combines map-side
    net = side(after, 1).unionByName(side(before, -1)).groupBy(*cols).agg(F.sum("_N").alias("_N")).where("_N <> 0")
    # of what is left, keys with rows on both sides are updates
    both = net.groupBy(*keys).agg((F.max("_N") > 0).alias("_I"), (F.min("_N") < 0).alias("_D")).where("_I AND _D")
    n, k = net.alias("n"), both.select(*keys, F.lit(True).alias("_U")).alias("k")
    out = n.join(k, _key_match_by(keys), "left").select(
        *[F.col(f"n.{c}").alias(c) for c in cols], F.when(F.col("_N") > 0, "INSERT").otherwise("DELETE").alias(ACTION),
        F.coalesce("_U", F.lit(False)).alias(ISUPDATE), F.abs("_N").alias("_N"))
    return out.withColumn("_C", F.explode(F.sequence(F.lit(1), F.col("_N")))).select(*cols, ACTION, ISUPDATE)


def _key_match_by(keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"n.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys])


# ------------------------------------------------------- streaming target

BUCKET = "VBUCKET"
#: Key partitions of a target; unless given, their number follows its initial size.
ROWS_PER_BUCKET = 2_000_000
BUCKETS_TAG, KEYS_TAG = "velocast.buckets", "velocast.keys"


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Partition of a row: a function of the key columns only (null-safe hash)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def init_target(df: DataFrame, table: str, keys: list[str], buckets: int | None = None, path: str | None = None) -> str:
    """Initial state, e.g. the raw table's current rows, as a table partitioned by key."""
    if buckets is None:
        buckets = max(1, -(-df.count() // ROWS_PER_BUCKET))
    # rows clustered by partition; AQE splits a skewed one over several files
    w = df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
    (w.option("path", path) if path else w).saveAsTable(table)
    df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BUCKETS_TAG}' = '{int(buckets)}', '{KEYS_TAG}' = '{','.join(keys)}')")
    return table


def current_state(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(BUCKET)


def apply_changes(batch: DataFrame, table: str) -> list[int]:
    """J1 on a target table: merge a batch into the partitions that its keys fall into.

    Returns those partitions.  The merged rows are computed before anything is
    overwritten; a partition that is left without rows is dropped.  Applying a
    batch again changes nothing.
    """
    spark = batch.sparkSession
    tags = {r["key"]: r["value"] for r in read_tags(spark, table).collect()}
    keys, n = tags[KEYS_TAG].split(","), int(tags[BUCKETS_TAG])
    # at most n small values
    touched = sorted(r[0] for r in batch.select(bucket_of(keys, n).alias("b")).distinct().collect())
    if not touched:
        return []
    now = spark.table(table).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = cut_lineage(merge_changes(now, batch, keys).withColumn(BUCKET, bucket_of(keys, n)))
    overwrite_partitions(merged.hint("rebalance", BUCKET), table, BUCKET)
    full = {r[0] for r in merged.select(BUCKET).distinct().collect()}
    for b in touched:
        if b not in full:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET} = {b})")
    spark.catalog.refreshTable(table)
    return touched


def merge_sink(table: str):
    """J1 as a ``foreachBatch`` function: empty batch -> no-op; replay-safe."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()      # read once: partitions and the merge reuse it
        try:
            apply_changes(batch, table)
        finally:
            batch.unpersist()
    return apply


def stream_merge(spark: SparkSession, changes_dir: str, schema, table: str,
                 checkpoint: str, available_now: bool = True, interval: str = "1 minute",
                 max_files_per_trigger: int | None = None):
    """Change files -> micro-batches -> J1 merge into the target table.

    Production runs every ``interval``; tests drain what is there with
    ``availableNow``.  Returns the started StreamingQuery.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    w = reader.parquet(changes_dir).writeStream.foreachBatch(merge_sink(table)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
