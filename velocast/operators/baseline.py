"""H7, H8: stationarity statistic and a closed-form AR baseline, per station.

Both are re-aimed from per-series maximum-likelihood solvers to least
squares that Spark computes with its regression aggregates
(regr_slope / regr_intercept / regr_sxx / regr_sxy / regr_syy), so every
station is fitted in one distributed aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import CUTPOINT
from .relational import COUNT, DATE, STATION


def _df_t(y: str, x: str) -> list[Column]:
    """Dickey-Fuller t statistic of the slope of y on x (with constant)."""
    sxx, sxy, syy = F.regr_sxx(y, x), F.regr_sxy(y, x), F.regr_syy(y, x)
    n = F.regr_count(y, x)
    slope = sxy / sxx
    ssr = syy - sxy * sxy / sxx
    se = F.sqrt(ssr / (n - 2) / sxx)
    return [slope, se, n]


def stationarity_stat(daily: DataFrame, key: str = STATION, value: str = COUNT,
                      digits: int = 6) -> DataFrame:
    """H7: Dickey-Fuller t statistic (constant, no lag terms) of the level and
    of the first difference of each station's series.

    t = b / se(b) for  dy_t = a + b * y_{t-1} + e_t.
    """
    w = Window.partitionBy(key).orderBy(DATE)
    y = F.col(value).cast("double")
    s = (daily.withColumn("_Y", y).withColumn("_YL", F.lag("_Y", 1).over(w))
         .withColumn("_DY", F.col("_Y") - F.col("_YL"))
         .withColumn("_DYL", F.lag("_DY", 1).over(w))
         .withColumn("_DDY", F.col("_DY") - F.col("_DYL")))
    b1, se1, n1 = _df_t("_DY", "_YL")
    b2, se2, _ = _df_t("_DDY", "_DYL")
    return s.groupBy(key).agg(
        n1.cast("bigint").alias("N"),
        F.round(b1 / se1, digits).alias("DF_T_LEVEL"),
        F.round(b2 / se2, digits).alias("DF_T_DIFF"))


def ar_baseline(daily: DataFrame, holdout: int = CUTPOINT, key: str = STATION,
                value: str = COUNT, digits: int = 4) -> DataFrame:
    """H8: AR(1) on first differences, fitted on all but the last ``holdout``
    rows, forecast over the held-out rows in closed form, scored by MSE.

    With mu = c / (1 - phi):
      y_hat(T+h) = y_T + h*mu + (dy_T - mu) * phi * (1 - phi^h) / (1 - phi)
    """
    w = Window.partitionBy(key).orderBy(DATE)
    y = F.col(value).cast("double")
    s = (daily.withColumn("_Y", y)
         .withColumn("_RN", F.row_number().over(w))
         .withColumn("_N", F.count(F.lit(1)).over(Window.partitionBy(key)))
         .withColumn("_DY", F.col("_Y") - F.lag("_Y", 1).over(w))
         .withColumn("_DYL", F.lag("_DY", 1).over(w))
         .withColumn("_T", F.col("_N") - holdout))
    train = s.filter(F.col("_RN") <= F.col("_T"))
    params = train.groupBy(key).agg(
        F.regr_slope("_DY", "_DYL").alias("PHI"),
        F.regr_intercept("_DY", "_DYL").alias("C"),
        F.max_by("_Y", "_RN").alias("_YT"),
        F.max_by("_DY", "_RN").alias("_DYT"))
    test = s.filter(F.col("_RN") > F.col("_T")).select(key, "_Y", (F.col("_RN") - F.col("_T")).alias("_H"))
    phi, c = F.col("PHI"), F.col("C")
    mu = c / (F.lit(1.0) - phi)
    h = F.col("_H").cast("double")
    yhat = F.col("_YT") + h * mu + (F.col("_DYT") - mu) * phi * (F.lit(1.0) - F.pow(phi, h)) / (F.lit(1.0) - phi)
    scored = test.join(params, key, "inner").withColumn("_E", F.col("_Y") - yhat)
    return scored.groupBy(key).agg(
        F.round(F.first("PHI"), 6).alias("PHI"), F.round(F.first("C"), 6).alias("C"),
        F.count(F.lit(1)).alias("N_HOLDOUT"),
        F.round(F.avg(F.col("_E") * F.col("_E")), digits).alias("MSE"))


def trend_ar_baseline(daily: DataFrame, holdout: int = CUTPOINT, key: str = STATION,
                      value: str = COUNT, digits: int = 4) -> DataFrame:
    """H8 (second model): linear trend + AR(1) errors, two-stage least squares.

    Stage 1: y_t = a + b t on the training rows; stage 2: e_t = c + phi e_{t-1}
    on the training residuals; forecast over the held-out rows
      y_hat(T+h) = a + b (T+h) + mu + phi^h (e_T - mu),  mu = c / (1 - phi).
    All fits are window aggregates over the station partitioning, so the
    series is shuffled once.
    """
    w = Window.partitionBy(key).orderBy(DATE)
    wall = Window.partitionBy(key)
    y = F.col(value).cast("double")
    s = (daily.withColumn("_Y", y)
         .withColumn("_RN", F.row_number().over(w).cast("double"))
         .withColumn("_T", (F.count(F.lit(1)).over(wall) - holdout).cast("double")))
    train = F.col("_RN") <= F.col("_T")
    s = (s.withColumn("B", F.regr_slope(F.when(train, F.col("_Y")), F.when(train, F.col("_RN"))).over(wall))
          .withColumn("A", F.regr_intercept(F.when(train, F.col("_Y")), F.when(train, F.col("_RN"))).over(wall))
          .withColumn("_E", F.col("_Y") - F.col("A") - F.col("B") * F.col("_RN"))
          .withColumn("_EL", F.lag("_E", 1).over(w)))
    s = (s.withColumn("PHI", F.regr_slope(F.when(train, F.col("_E")), F.when(train, F.col("_EL"))).over(wall))
          .withColumn("C", F.regr_intercept(F.when(train, F.col("_E")), F.when(train, F.col("_EL"))).over(wall))
          .withColumn("_ET", F.max(F.when(F.col("_RN") == F.col("_T"), F.col("_E"))).over(wall)))
    mu = F.col("C") / (F.lit(1.0) - F.col("PHI"))
    h = F.col("_RN") - F.col("_T")
    yhat = F.col("A") + F.col("B") * F.col("_RN") + mu + F.pow(F.col("PHI"), h) * (F.col("_ET") - mu)
    test = s.filter(~train).withColumn("_ERR", F.col("_Y") - yhat)
    return test.groupBy(key).agg(
        F.round(F.first("B"), 6).alias("TREND"), F.round(F.first("PHI"), 6).alias("PHI"),
        F.count(F.lit(1)).alias("N_HOLDOUT"),
        F.round(F.avg(F.col("_ERR") * F.col("_ERR")), digits).alias("MSE"))
