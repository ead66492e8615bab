"""One regression per station, in-sample predictions, recursive
forecast, per-row explanations and per-station importances.

The learner is ridge regression on standardised features (the reference's
neural learner is not available; see README).  Training is a Spark
aggregate: per station the Gram sums  sum(x_i x_j), sum(x_i y), sum(y), ...
are computed with map-side partial aggregation, so a hot station costs no
more than any other; only the tiny (p x p) solve per station runs in
pandas, one row per station.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CUTPOINT, FORECAST_STEPS, LAGS, feature_names
from .features import time_split
from .relational import COUNT, DATE, STATION, tail_n



def _dec(c: str) -> Column:
    return F.col(c).cast("decimal(20,2)")


def gram_columns(feats: list[str]) -> list[tuple[str, Column]]:
    """(name, aggregate) pairs of the Gram sums; exact decimal arithmetic."""
    y = F.col(COUNT).cast("decimal(20,0)")
    out = [("N", F.count(F.lit(1))), ("S_Y", F.sum(y)), ("S_Y_Y", F.sum(y * y))]
    for i, a in enumerate(feats):
        out.append((f"S_{a}", F.sum(_dec(a))))
        out.append((f"S_{a}_Y", F.sum(_dec(a) * y)))
        for b in feats[i:]:
            out.append((f"S_{a}_{b}", F.sum(_dec(a) * _dec(b))))
    return out


def train_gram(features: DataFrame, lags=LAGS, cutpoint: int = CUTPOINT) -> DataFrame:
    """H10 (aggregate part): per-station Gram sums over the training rows (H9)."""
    feats = feature_names(lags)
    train = time_split(features, cutpoint).filter(~F.col("IS_VALID"))
    cols = gram_columns(feats)
    return train.groupBy(STATION).agg(*[
        (c if n == "N" else c.cast("double")).alias(n) for n, c in cols])


def _coef_schema(feats: list[str]) -> T.StructType:
    fields = [T.StructField(STATION, T.StringType()), T.StructField("N_TRAIN", T.LongType()),
              T.StructField("INTERCEPT", T.DoubleType())]
    for f in feats:
        fields += [T.StructField(f"B_{f}", T.DoubleType()), T.StructField(f"MEAN_{f}", T.DoubleType()),
                   T.StructField(f"SD_{f}", T.DoubleType())]
    return T.StructType(fields)


def solve_ridge(row: dict, feats: list[str], alpha: float) -> dict:
    """Ridge on standardised features from Gram sums (one station)."""
    n = float(row["N"])
    p = len(feats)
    s = np.array([row[f"S_{f}"] for f in feats], dtype=float)
    sy = np.array([row[f"S_{f}_Y"] for f in feats], dtype=float)
    g = np.empty((p, p))
    for i, a in enumerate(feats):
        for j, b in enumerate(feats):
            g[i, j] = row[f"S_{a}_{b}"] if i <= j else row[f"S_{b}_{a}"]
    mean = s / n
    my = row["S_Y"] / n
    cov = g / n - np.outer(mean, mean)
    cxy = sy / n - mean * my
    var = np.clip(np.diag(cov), 0.0, None)
    sd = np.sqrt(var)
    const = sd <= 1e-12
    sd_safe = np.where(const, 1.0, sd)
    c = cov / np.outer(sd_safe, sd_safe)
    c[const, :] = 0.0
    c[:, const] = 0.0
    rhs = np.where(const, 0.0, cxy / sd_safe)
    gamma = np.linalg.solve(c + (alpha / n) * np.eye(p), rhs)
    beta = np.where(const, 0.0, gamma / sd_safe)
    out = {STATION: row[STATION], "N_TRAIN": int(n), "INTERCEPT": float(my - beta @ mean)}
    for k, f in enumerate(feats):
        out[f"B_{f}"], out[f"MEAN_{f}"], out[f"SD_{f}"] = float(beta[k]), float(mean[k]), float(sd[k])
    return out


def fit_from_gram(gram: DataFrame, lags=LAGS, alpha: float = 1.0) -> DataFrame:
    """H10 (solve part): one coefficient row per station, solved in mapInPandas.

    Input is one row per station, so this touches (stations x p^2) numbers.
    """
    feats = feature_names(lags)
    schema = _coef_schema(feats)

    def solve(batches):
        for pdf in batches:
            rows = [solve_ridge(r, feats, alpha) for r in pdf.to_dict("records")]
            yield pd.DataFrame(rows, columns=schema.fieldNames())

    return gram.mapInPandas(solve, schema)


def train_per_station(features: DataFrame, lags=LAGS, cutpoint: int = CUTPOINT,
                      alpha: float = 1.0) -> DataFrame:
    """Gram aggregate + per-station solve."""
    return fit_from_gram(train_gram(features, lags, cutpoint), lags, alpha)


def linear_prediction(feats: list[str]) -> Column:
    expr = F.col("INTERCEPT")
    for f in feats:
        expr = expr + F.col(f"B_{f}") * F.col(f).cast("double")
    return expr


def predict_history(features: DataFrame, coefs: DataFrame, lags=LAGS) -> DataFrame:
    """In-sample PRED for every feature row (a Column expression)."""
    feats = feature_names(lags)
    joined = features.join(coefs, STATION, "inner")
    return joined.withColumn("PRED", linear_prediction(feats)).select(*features.columns, "PRED")


def explain_columns(feats: list[str]) -> dict[str, Column]:
    """EXPL_f = share of |B_f * (x_f - mean_f)| in the row's total, rounded 2."""
    contrib = {f: F.abs(F.col(f"B_{f}") * (F.col(f).cast("double") - F.col(f"MEAN_{f}"))) for f in feats}
    total = None
    for c in contrib.values():
        total = c if total is None else total + c
    return {f"EXPL_{f}": F.round(F.when(total > 0, c / total).otherwise(F.lit(0.0)), 2).cast("decimal(10,2)")
            for f, c in contrib.items()}


def explain_rows(rows: DataFrame, coefs: DataFrame, lags=LAGS) -> DataFrame:
    """Per-row contributions for history or forecast rows."""
    feats = feature_names(lags)
    joined = rows.join(coefs, STATION, "inner")
    return joined.withColumns(explain_columns(feats)).select(
        *rows.columns, *[f"EXPL_{f}" for f in feats])


def feature_importance(explained: DataFrame, lags=LAGS) -> DataFrame:
    """Mean explanation per feature per station."""
    feats = feature_names(lags)
    return explained.groupBy(STATION).agg(*[
        F.round(F.avg(F.col(f"EXPL_{f}").cast("double")), 4).alias(f"IMP_{f}") for f in feats])


def forecast_rows(features: DataFrame, calendar: DataFrame, lags=LAGS,
                  steps: int = FORECAST_STEPS) -> tuple[DataFrame, T.StructType]:
    """H12's input by station, its last max(lags) actual rows (KIND H) and the forecast days (F),
    and the schema of the forecast.  The future days are the calendar's dates from the station's
    last date + 1, joined on DATE, so no cross join."""
    hist = (tail_n(features.select(STATION, DATE, COUNT), max(lags))
            .select(STATION, DATE, F.col(COUNT).cast("double").alias(COUNT),
                    F.lit(None).cast("int").alias("HOLIDAY"),
                    F.lit(None).cast("double").alias("PRECIP"), F.lit(None).cast("double").alias("TEMP"),
                    F.lit("H").alias("KIND")))
    last = features.groupBy(STATION).agg(F.max(DATE).alias("_LAST"))
    days = last.select(STATION, F.explode(F.sequence(F.date_add("_LAST", 1),
                                                     F.date_add("_LAST", steps + 1))).alias(DATE))
    # a day that the calendar lacks stays, with a null prediction, so later lags do not shift
    fut = (days.join(calendar.select(DATE, "HOLIDAY", "PRECIP", "TEMP"), DATE, "left")
           .select(STATION, DATE, F.lit(None).cast("double").alias(COUNT), F.col("HOLIDAY").cast("int"),
                   F.col("PRECIP").cast("double"), F.col("TEMP").cast("double"), F.lit("F").alias("KIND")))
    schema = T.StructType(
        [T.StructField(STATION, T.StringType()), T.StructField(DATE, T.DateType()),
         T.StructField(COUNT, T.LongType())]
        + [T.StructField(f"LAG_{k}", T.LongType()) for k in lags]
        + [T.StructField("HOLIDAY", T.IntegerType()), T.StructField("PRECIP", T.DoubleType()),
           T.StructField("TEMP", T.DoubleType()), T.StructField("PRED", T.DoubleType())])
    return hist.unionByName(fut), schema


def forecast_recursive(features: DataFrame, coefs: DataFrame, calendar: DataFrame,
                       lags=LAGS, steps: int = FORECAST_STEPS) -> DataFrame:
    """Day-by-day forecast; lags come from actuals, then from own predictions.

    Each station's group holds only its last max(lags) actual rows plus the
    forecast days (bounded state).  Predictions are rounded half-even to whole trips.
    """
    feats = feature_names(lags)
    lags = tuple(int(k) for k in lags)
    c = coefs.select(STATION, "INTERCEPT", *[f"B_{f}" for f in feats])
    rows, out_schema = forecast_rows(features, calendar, lags, steps)
    rows = rows.join(c, STATION, "inner")

    def recurse(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(DATE)
        counts = [float(v) for v in pdf.loc[pdf["KIND"] == "H", COUNT]]
        future = pdf[pdf["KIND"] == "F"]
        first = pdf.iloc[0]
        b0 = float(first["INTERCEPT"])
        beta = np.array([float(first[f"B_{f}"]) for f in feats])
        out = []
        for r in future.itertuples(index=False):
            lag_vals = [counts[-k] if len(counts) >= k else math.nan for k in lags]
            x = np.array([*lag_vals, r.HOLIDAY, r.PRECIP, r.TEMP], dtype=float)
            raw = b0 + float(beta @ x)
            pred = float(round(raw)) if math.isfinite(raw) else math.nan
            counts.append(pred)
            out.append([first[STATION], getattr(r, DATE), pred, *lag_vals, r.HOLIDAY, r.PRECIP, r.TEMP, pred])
        res = pd.DataFrame(out, columns=out_schema.fieldNames())
        for k in [COUNT, "HOLIDAY", *[f"LAG_{k}" for k in lags]]:
            res[k] = res[k].astype("Int64")
        return res

    return rows.groupBy(STATION).applyInPandas(recurse, out_schema)
