"""Model scores as plain aggregates, and JSON result packing/flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LAGS, feature_names
from ..functions.columns import records_json
from .relational import COUNT, DATE, STATION

# sklearn's epsilon for the percentage error denominator (float64 machine eps).
EPS = 2.220446049250313e-16

METRICS = ("mae", "mape", "mse", "r_squared", "rmse", "smape", "pearson_correlation")


def evaluate_models(df: DataFrame, y_true: str = COUNT, y_score: str = "PRED",
                    key: str = STATION, digits: int | None = 6) -> DataFrame:
    """Per-station regression scores in one aggregate (no UDF).

    mae, mape (fraction), mse, rmse, r_squared = 1 - SSE/SST,
    smape (percent, 0 where |y| + |p| = 0) and the Pearson correlation.
    """
    y = F.col(y_true).cast("double")
    p = F.col(y_score).cast("double")
    e = y - p
    agg = df.groupBy(key).agg(
        F.avg(F.abs(e)).alias("mae"),
        F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPS))).alias("mape"),
        F.avg(e * e).alias("mse"),
        F.var_pop(y).alias("_var"),
        (F.lit(100.0) * F.avg(F.when(F.abs(y) + F.abs(p) > 0, 2 * F.abs(e) / (F.abs(y) + F.abs(p)))
                              .otherwise(F.lit(0.0)))).alias("smape"),
        F.var_pop(p).alias("_pvar"), F.covar_pop(y, p).alias("_cov"))
    out = agg.select(
        key, "mae", "mape", "mse",
        F.when(F.col("_var") > 0, F.lit(1.0) - F.col("mse") / F.col("_var")).alias("r_squared"),
        F.sqrt("mse").alias("rmse"), "smape",
        # null where one side is constant (corr itself divides by zero there)
        F.when((F.col("_var") > 0) & (F.col("_pvar") > 0), F.col("_cov") / F.sqrt("_var") / F.sqrt("_pvar")).alias("pearson_correlation"))
    if digits is not None:
        out = out.select(key, *[F.round(m, digits).alias(m) for m in METRICS])
    return out


def regression_mse(df: DataFrame, y_true: str = COUNT, y_score: str = "PRED") -> DataFrame:
    """One-number mean squared error."""
    e = F.col(y_true).cast("double") - F.col(y_score).cast("double")
    return df.agg(F.round(F.avg(e * e), 6).alias("mse"))


def pred_columns(lags=LAGS) -> list[str]:
    feats = feature_names(lags)
    return [DATE, COUNT, *[f"LAG_{k}" for k in lags], "HOLIDAY", "PRECIP", "TEMP", "PRED",
            *[f"EXPL_{f}" for f in feats]]


def pack_predictions(history: DataFrame, forecast: DataFrame, lags=LAGS) -> DataFrame:
    """PRED table: STATION_ID, PRED_DATA = [history JSON, forecast JSON].

    Each JSON array holds one station's daily rows (bounded by the calendar).
    """
    cols = pred_columns(lags)

    def packed(df, name):
        d = df.withColumn(DATE, F.date_format(DATE, "yyyy-MM-dd"))
        return d.groupBy(STATION).agg(records_json(*cols, order_by=DATE).alias(name))

    h, f = packed(history, "_H"), packed(forecast, "_F")
    return h.join(f, STATION, "full").select(STATION, F.array("_H", "_F").alias("PRED_DATA"))


def _record_schema(lags=LAGS) -> str:
    feats = feature_names(lags)
    parts = [f"{DATE}: STRING", f"{COUNT}: DOUBLE", *[f"LAG_{k}: DOUBLE" for k in lags],
             "HOLIDAY: DOUBLE", "PRECIP: DOUBLE", "TEMP: DOUBLE", "PRED: DOUBLE",
             *[f"EXPL_{f}: DOUBLE" for f in feats]]
    return "ARRAY<STRUCT<" + ", ".join(parts) + ">>"


def flatten_predictions(pred: DataFrame, index: int, lags=LAGS) -> DataFrame:
    """PRED_DATA[index] -> typed flat rows (flat_PRED for 0, flat_FORECAST for 1).

    Integers for counts, lags and the holiday flag; decimal(10,2) for weather,
    prediction and explanations (see SURVEY section 8.10).
    """
    return flat_rows(pred.select(STATION, F.inline(F.from_json(F.col("PRED_DATA")[index], _record_schema(lags)))), lags)


def flat_rows(recs: DataFrame, lags=LAGS) -> DataFrame:
    """H17's typed columns of prediction rows, packed before or not."""
    feats = feature_names(lags)
    dec = "decimal(10,2)"
    return recs.select(
        STATION, F.to_date(DATE).alias(DATE), F.col(COUNT).cast("bigint").alias(COUNT),
        *[F.col(f"LAG_{k}").cast("bigint").alias(f"LAG_{k}") for k in lags],
        F.col("HOLIDAY").cast("int").alias("HOLIDAY"),
        F.col("PRECIP").cast(dec).alias("PRECIP"), F.col("TEMP").cast(dec).alias("TEMP"),
        F.col("PRED").cast(dec).alias("PRED"),
        *[F.col(f"EXPL_{f}").cast(dec).alias(f"EXPL_{f}") for f in feats])


def pack_eval(scores: DataFrame, run_date: str) -> DataFrame:
    """EVAL table: STATION_ID, EVAL_DATA (JSON records), RUN_DATE."""
    return scores.select(STATION, F.to_json(F.array(F.struct(*METRICS))).alias("EVAL_DATA"),
                         F.to_date(F.lit(run_date), "yyyy_MM_dd").alias("RUN_DATE"))


def flatten_eval(ev: DataFrame) -> DataFrame:
    """EVAL_DATA -> flat_EVAL(RUN_DATE, STATION_ID, metrics as decimal(10,2))."""
    schema = "ARRAY<STRUCT<" + ", ".join(f"{m}: DOUBLE" for m in METRICS) + ">>"
    recs = ev.select("RUN_DATE", STATION, F.inline(F.from_json("EVAL_DATA", schema)))
    return recs.select("RUN_DATE", STATION, *[F.col(m).cast("decimal(10,2)").alias(m)
                                              for m in ("mae", "mape", "mse", "r_squared", "rmse", "smape")])
