"""Scalar and document column helpers (G9, G10, G13-G21), all built-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c) -> Column:
    """Round half-up to 2 places."""
    return F.round(_c(c), 2)


def greatest_of(*cols) -> Column:
    """Row-wise maximum; NULLs are skipped."""
    return F.greatest(*[_c(c) for c in cols])


def first_match_label(value, candidates: list[str]) -> Column:
    """Name of the first candidate column equal to ``value`` (ties -> first)."""
    v = _c(value)
    expr = None
    for c in candidates:
        expr = (F.when(F.col(c) == v, F.lit(c)) if expr is None
                else expr.when(F.col(c) == v, F.lit(c)))
    return expr


def category_codes(df: DataFrame, col: str, out: str = "CODE", known: list[str] | None = None) -> DataFrame:
    """code = rank of the label among the sorted distinct labels; NULL -> -1.

    Where the labels can only be some of ``known`` (not checked), those that occur are
    one small array, found by one aggregate, and a label's code is its place in it.  Else
    the distinct labels are ranked over range partitions
    (``ordinal_of_distinct``), so no task sees all labels and nothing goes
    through the driver; Spark broadcasts the ranked labels if they are small.
    """
    if known is not None:
        labels = df.agg(F.sort_array(F.collect_set(col))).scalar()
        return df.withColumn(out, F.coalesce(F.array_position(labels, F.col(col)) - 1, F.lit(-1)).cast("int"))
    ranked = ordinal_of_distinct(df.select(col).where(F.col(col).isNotNull()).distinct(), col, out)
    return (df.join(ranked, on=col, how="left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(-1)).cast("int")))


def ordinal_of_distinct(distinct: DataFrame, col: str, out: str) -> DataFrame:
    """0-based position of each value of a distinct column in sorted order.

    Range-partitions the values, numbers them inside each partition and adds
    the sizes of all earlier partitions (one row per partition, a table the
    size of the shuffle partition count).
    """
    parts = distinct.repartitionByRange(col).withColumn("_P", F.spark_partition_id())
    local = parts.withColumn("_I", F.row_number().over(Window.partitionBy("_P").orderBy(col)))
    sizes = local.groupBy("_P").agg(F.count(F.lit(1)).alias("_N"))
    before = Window.orderBy("_P").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_P", F.coalesce(F.sum("_N").over(before), F.lit(0)).alias("_OFF"))
    return (local.join(F.broadcast(offsets), "_P")
            .select(col, (F.col("_OFF") + F.col("_I") - 1).cast("int").alias(out)))


def array_of(*cols) -> Column:
    """Array from columns or literals."""
    return F.array(*[_c(c) if not isinstance(c, (int, float)) else F.lit(c) for c in cols])


def item(c, i: int) -> Column:
    """Element ``i`` (0-based) of an array."""
    return _c(c)[i]


def parse_records(c, schema: T.DataType | str) -> Column:
    """JSON text -> typed value (array of records by default)."""
    return F.from_json(_c(c), schema)


def json_field(doc, name: str, dtype: str) -> Column:
    """Field ``name`` of a parsed document, cast to ``dtype``."""
    return _c(doc)[name].cast(dtype)


def variant_field(doc, name: str, dtype: str) -> Column:
    """G17 on an open-schema VARIANT document."""
    return F.variant_get(_c(doc), f"$.{name}", dtype)


def records_json(*cols, order_by: str | None = None) -> Column:
    """G18 (aggregate): rows of a group -> JSON array text, ordered by ``order_by``.

    Use only where the group is bounded (e.g. one station's daily rows).
    """
    rec = F.struct(*[_c(c) for c in cols]) if cols else F.struct("*")
    if order_by:
        rec = F.struct(_c(order_by).alias("_k"), rec.alias("_v"))
        return F.to_json(F.transform(F.sort_array(F.collect_list(rec)), lambda x: x["_v"]))
    return F.to_json(F.collect_list(rec))


def concat_key(*cols, sep: str = "|") -> Column:
    """Row key from several text columns (separator avoids collisions)."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("\\N")) for c in cols])


def to_int(c) -> Column:
    """Cast to int, truncating toward zero."""
    return _c(c).cast("int")


def to_double(c) -> Column:
    """Cast to double."""
    return _c(c).cast("double")
