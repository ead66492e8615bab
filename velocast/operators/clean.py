"""B: projections, filters and cleaning on trip-shaped DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import first_match_label, greatest_of


def project(df: DataFrame, names: list[str]) -> DataFrame:
    """B1: keep the named columns, in the given order."""
    return df.select(*names)


def select_alias(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """B2: project and rename: {new_name: column or source name}."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def with_columns(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add or replace columns."""
    return df.withColumns(cols)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Remove helper columns."""
    return df.drop(*names)


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """Equality filter (pushed to the scan when ``col`` is a stored column)."""
    return df.filter(F.col(col) == F.lit(value))


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows whose key columns are NULL."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def filter_in_date_range(df: DataFrame, key: str, values: list, date_col: str,
                         start: dt.date | str, end: dt.date | str) -> DataFrame:
    """``key IN values AND start <= date <= end`` (both ends inclusive)."""
    return df.filter(F.col(key).isin(list(values))
                     & (F.col(date_col) >= F.lit(start).cast("date"))
                     & (F.col(date_col) <= F.lit(end).cast("date")))


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or any of ``subset``) column."""
    return df.na.drop(how="any", subset=subset)


def fill_null(df: DataFrame, values: dict) -> DataFrame:
    """NULL -> value per column (e.g. HOLIDAY -> 0)."""
    return df.na.fill(values)


def null_token_to_null(df: DataFrame, col: str, token: str = "NULL") -> DataFrame:
    """A literal token (``'NULL'``) in ``col`` becomes a real NULL."""
    return df.withColumn(col, F.nullif(F.col(col), F.lit(token)))


def explain_reason(df: DataFrame, explainers: list[str], value_col: str = "EXPLAIN",
                   out: str = "REASON") -> DataFrame:
    """G10 + B11: EXPLAIN = greatest explainer, REASON = first explainer equal to it."""
    return (df.withColumn(value_col, greatest_of(*explainers))
              .withColumn(out, first_match_label(value_col, explainers)))


def literal_column(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    """Constant column (flag, run date)."""
    c = F.lit(value)
    return df.withColumn(name, c.cast(dtype) if dtype else c)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename to standard names (e.g. COUNT -> y_true, PRED -> y_score)."""
    return df.withColumnsRenamed(mapping)
