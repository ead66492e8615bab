"""The Python function surface (table function, scalar JSON function,
evaluate-to-table).  The default paths elsewhere are built-in aggregates;
these exist for users of the reference's function-registration API.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql import types as T

from .evaluate import EPS, METRICS, evaluate_models
from .relational import COUNT, STATION


SUMMARY_SCHEMA = T.StructType([
    T.StructField(STATION, T.StringType()), T.StructField("N_DAYS", T.LongType()),
    T.StructField("FIRST_DATE", T.DateType()), T.StructField("LAST_DATE", T.DateType()),
    T.StructField("TOTAL", T.LongType()), T.StructField("PEAK", T.LongType())])


class StationSeriesSummary:
    """Partitioned table function: init / per-row eval / terminate.

    Called as ``TABLE(t) PARTITION BY STATION_ID ORDER BY DATE``; keeps only
    running values (bounded state) and emits one row per partition.
    """

    def __init__(self):
        self.key = None
        self.n = 0
        self.first = None
        self.last = None
        self.total = 0
        self.peak = None

    def eval(self, row):
        self.key = row[STATION]
        self.n += 1
        if self.first is None:
            self.first = row["DATE"]
        self.last = row["DATE"]
        c = int(row["COUNT"])
        self.total += c
        self.peak = c if self.peak is None else max(self.peak, c)

    def terminate(self):
        if self.n:
            yield self.key, self.n, self.first, self.last, self.total, self.peak


def register_series_summary(spark: SparkSession, name: str = "station_series_summary") -> str:
    spark.udtf.register(name, udtf(StationSeriesSummary, returnType=SUMMARY_SCHEMA))
    return name


def series_summary(spark: SparkSession, daily: DataFrame, view: str = "_daily_series",
                   name: str = "station_series_summary") -> DataFrame:
    """I1 applied to a daily relation: one summary row per station."""
    register_series_summary(spark, name)
    daily.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT s.* FROM {name}(TABLE({view}) PARTITION BY STATION_ID ORDER BY DATE) s""")


def score_json(doc: str, y_true: str, y_score: str) -> str:
    """Scores of one JSON records document (pandas; one bounded document)."""
    pdf = pd.read_json(io_string(doc), orient="records")
    y = pdf[y_true].astype(float).to_numpy()
    p = pdf[y_score].astype(float).to_numpy()
    e = y - p
    mse = float(np.mean(e * e))
    var = float(np.var(y))
    denom = np.abs(y) + np.abs(p)
    smape = 100.0 * float(np.mean(np.where(denom > 0, 2 * np.abs(e) / np.where(denom > 0, denom, 1), 0.0)))
    out = {
        "mae": float(np.mean(np.abs(e))),
        "mape": float(np.mean(np.abs(e) / np.maximum(np.abs(y), EPS))),
        "mse": mse,
        "r_squared": 1.0 - mse / var if var > 0 else None,
        "rmse": float(np.sqrt(mse)),
        "smape": smape,
        "pearson_correlation": float(np.corrcoef(y, p)[0, 1]) if len(y) > 1 else None,
    }
    return json.dumps([out])


def io_string(doc: str):
    import io
    return io.StringIO(doc)


def eval_model_json(docs: pd.Series, y_true: pd.Series, y_score: pd.Series) -> pd.Series:
    """JSON records in, JSON scores out, Arrow-batched."""
    return pd.Series([score_json(d, t, s) for d, t, s in zip(docs, y_true, y_score)])


def register_eval_udf(spark: SparkSession, name: str = "eval_model_json") -> str:
    spark.udf.register(name, pandas_udf(eval_model_json, T.StringType()))
    return name


def score_documents(spark: SparkSession, docs: DataFrame, doc_col: str, y_true: str, y_score: str,
                    name: str = "eval_model_json") -> DataFrame:
    """I2 called by name: STATION_ID, EVAL_DATA (JSON text)."""
    register_eval_udf(spark, name)
    return docs.select(STATION, F.call_udf(name, F.col(doc_col), F.lit(y_true), F.lit(y_score))
                       .alias("EVAL_DATA"))


def evaluate_to_table(pred: DataFrame, y_true: str, y_score: str, table: str,
                      path: str | None = None) -> str:
    """The stored-procedure variant as one set-based job: H15 + overwrite."""
    w = evaluate_models(pred, y_true, y_score).drop("pearson_correlation").write.mode("overwrite")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return table


__all__ = ["StationSeriesSummary", "series_summary", "eval_model_json", "score_documents",
           "evaluate_to_table", "METRICS", "COUNT"]
