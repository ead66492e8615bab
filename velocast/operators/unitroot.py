"""H7, augmented: unit-root test with lag terms chosen by AIC, per station.

The test regresses the change of a series on a constant, its last level and its last p changes.
Spark adds up one Gram matrix of all these columns for each station; the first rows, which only
some orders may use, are kept apart from the sum.  One Cholesky factor of the station's Gram
matrix then gives the residual sum of every order at once: the squares in its last row are the
drops that each further column brings.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .relational import COUNT, DATE, STATION

# The published response surface of the test with a constant (MacKinnon 1994):
# coefficients of the normal quantile of p by the statistic, below and above STAR; beyond LOW
# and HIGH p is 0 and 1.
LOW, STAR, HIGH = -18.83, -1.61, 2.74
BELOW = (2.1659, 1.4412, 0.038269)
ABOVE = (1.7339, 0.93202, -0.12745, -0.010368)


def p_value(t: float) -> float:
    if t > HIGH:
        return 1.0
    if t < LOW:
        return 0.0
    q = sum(c * t ** i for i, c in enumerate(BELOW if t <= STAR else ABOVE))
    return 0.5 * math.erfc(-q / math.sqrt(2))


#: The largest order; series of up to 62,500 days try fewer anyway.
MOST = 60


def most_lags(n: str = "N") -> str:
    """The largest order tried for ``n`` rows, as SQL."""
    return f"least(cast(ceil(12 * pow({n} / 100.0, 0.25)) as int), cast(floor({n} / 2) as int) - 2, {MOST})"


def lag_gram(daily: DataFrame, key: str = STATION, value: str = COUNT) -> DataFrame:
    """(station, P, ROW, I, J, G): sums of products of columns I <= J, by station.

    Columns: 0 constant, 1 last level, 2 .. P + 1 last changes, P + 2 the change.  ``ROW`` is
    the row's number in the series up to P + 2, from which on all columns are there and rows are
    added up; before it, columns that reach back before the series are missing.  ``P`` is the
    largest order that the length of the series allows; series that allow none are left out.
    """
    w = Window.partitionBy(key).orderBy(DATE)
    s = daily.select(key, DATE, F.col(value).cast("double").alias("Y")).withColumns({
        "N": F.count(F.lit(1)).over(Window.partitionBy(key)), "RN": F.row_number().over(w), "L": F.lag("Y").over(w)})
    s = s.withColumns({"D": F.col("Y") - F.col("L"), "P": F.expr(most_lags())}).where("P >= 0")
    # the changes before this one, the nearest first
    past = F.collect_list("D").over(w.rowsBetween(-MOST, -1))
    s = s.withColumn("B", F.reverse(past)).where("RN >= 2")
    cols = F.concat(F.array(F.lit(1.0), F.col("L")), F.slice("B", F.lit(1), F.least(F.col("P"), F.size("B"))))
    s = s.select(key, "P", F.least(F.col("RN"), F.col("P") + 2).alias("ROW"), "D", cols.alias("X"))
    cells = s.select(key, "P", "ROW", "D", "X", F.posexplode("X").alias("I", "A"))
    # the change itself is the last column, after all lags that the row has
    right = F.concat(F.slice(F.transform("X", lambda x, j: F.struct(j.alias("J"), x.alias("V"))), F.col("I") + 1, F.size("X") - F.col("I")),
                     F.array(F.struct((F.col("P") + 2).alias("J"), F.col("D").alias("V"))))
    pairs = cells.select(key, "P", "ROW", "I", "A", F.explode(right).alias("R")).select(
        key, "P", "ROW", "I", F.col("R.J").alias("J"), (F.col("A") * F.col("R.V")).alias("V"))
    own = s.select(key, "P", "ROW", (F.col("P") + 2).alias("I"), (F.col("P") + 2).alias("J"), (F.col("D") * F.col("D")).alias("V"))
    return pairs.unionByName(own).groupBy(key, "P", "ROW", "I", "J").agg(F.sum("V").alias("G"))


def _factor(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(drops, used): by column, the drop of the last column's square sum that it brings after the
    columns before it, and whether it is independent of them."""
    a, k = g.astype(float).copy(), len(g) - 1
    scale = np.maximum(np.diag(g), 1e-300)
    drop, used = np.zeros(k), np.zeros(k, bool)
    for i in range(k):
        if a[i, i] > 1e-10 * scale[i]:
            drop[i], used[i] = a[i, k] ** 2 / a[i, i], True
            a -= np.outer(a[:, i], a[i]) / a[i, i]
    return drop, used


def _test(matrix: dict[int, np.ndarray], most: int) -> tuple[int, int, float] | None:
    """(order, rows, statistic) from the Gram matrices by ROW, the order by AIC."""
    g = matrix[most + 2]
    n = g[0, 0]
    drop, used = _factor(g)
    rss = g[-1, -1] - np.cumsum(drop)
    aic = []
    for p in range(most + 1):
        if rss[p + 1] <= 1e-9 * max(g[-1, -1], 1e-300):
            return None
        aic.append(n * (math.log(2 * math.pi * rss[p + 1] / n) + 1) + 2 * (2 + p))
    order = int(np.argmin(np.round(aic, 9)))
    # the order's own sample begins earlier
    keep = [0, *range(2, order + 2), 1, most + 2]
    full = sum((matrix[r][np.ix_(keep, keep)] for r in range(order + 2, most + 3) if r in matrix), np.zeros((len(keep), len(keep))))
    drop, used = _factor(full)
    n, rss = full[0, 0], full[-1, -1] - drop.sum()
    free = n - len(drop)
    if free <= 0 or rss <= 0 or not used[-1]:
        return None
    # the level comes last, so its drop over the error variance is the square of its t statistic
    a = full.astype(float).copy()
    for i in range(len(drop) - 1):
        if used[i]:
            a -= np.outer(a[:, i], a[i]) / a[i, i]
    sign = 1.0 if a[-2, -1] >= 0 else -1.0
    return order, int(n), sign * math.sqrt(drop[-1] / (rss / free))


def unit_root(daily: DataFrame, key: str = STATION, value: str = COUNT, digits: int = 6) -> DataFrame:
    """H7: (station, USED_LAG, N_OBS, ADF_T, P_VALUE), one row per station with enough rows.

    Orders up to ceil(12 (n / 100)^(1/4)) are compared by AIC over the rows that all of them can
    use, the least order of equal ones; the chosen one is tested over all rows that it can use.
    A series that the lags explain fully (a constant one) has null in place of the results.
    """
    schema = T.StructType([T.StructField(key, daily.schema[key].dataType), T.StructField("USED_LAG", T.IntegerType()),
                           T.StructField("N_OBS", T.LongType()), T.StructField("ADF_T", T.DoubleType()), T.StructField("P_VALUE", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        most = int(pdf["P"].iloc[0])
        matrix = {}
        for row, i, j, g in zip(pdf["ROW"], pdf["I"], pdf["J"], pdf["G"]):
            m = matrix.setdefault(int(row), np.zeros((most + 3, most + 3)))
            m[i, j] = m[j, i] = g
        got = _test(matrix, most) if most + 2 in matrix else None
        return pd.DataFrame({key: [pdf[key].iloc[0]], "USED_LAG": pd.array([got and got[0]], "Int64"), "N_OBS": pd.array([got and got[1]], "Int64"),
                             "ADF_T": [got and round(got[2], digits)], "P_VALUE": [got and round(p_value(got[2]), digits)]})

    return lag_gram(daily, key, value).groupBy(key).applyInPandas(run, schema)


def rolling_change(daily: DataFrame, days: int = 7, key: str = STATION, value: str = COUNT) -> DataFrame:
    """The differenced series: the change of the ``days``-row rolling mean, whole windows only."""
    w = Window.partitionBy(key).orderBy(DATE)
    y = F.col(value).cast("double")
    ago = F.lag(y, days).over(w)
    return daily.select(key, DATE, ((y - ago) / days).alias(value)).where(F.col(value).isNotNull())
