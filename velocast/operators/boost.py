"""H10-H14 with a non-linear learner: gradient-boosted regression trees for all stations at once.

Every feature is binned by its rank among the station's training rows.  A tree grows level by
level: one aggregate sums the residuals of all stations by (station, node, feature, bin), one
window over the bins scores every split, and the best one of each node sends the rows on.
Residuals are whole millionths, so sums do not depend on the order of rows.  After each tree the
held-out rows (H9) score the station; it stops after ``patience`` trees without a better score
and keeps the trees up to its best.  The driver sees one number a tree: how many stations go on.

Explanations are exact Shapley values of each tree's expectation given some features, where the
others follow the training rows' shares along the path.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..config import CUTPOINT, FORECAST_STEPS, LAGS, feature_names
from ..session import cut_lineage, stored
from .features import time_split
from .model import forecast_rows
from .relational import COUNT, DATE, STATION

UNIT = 1_000_000


@dataclass(frozen=True)
class Boost:
    """Parameters of the learner; ``depth`` is 1 to 3."""
    trees: int = 24
    depth: int = 3
    bins: int = 32
    rate: float = 0.3
    min_rows: int = 20
    patience: int = 4

    def __post_init__(self):
        if not 1 <= self.depth <= 3:
            raise ValueError("depth must be 1, 2 or 3")


def binned(features: DataFrame, lags=LAGS, cutpoint: int = CUTPOINT, bins: int = 32) -> DataFrame:
    """(station, date, IS_VALID, Y, X, B): features as an array and, among the training rows of
    the station, the bin of each: ``bins`` times the share of rows with a smaller value."""
    feats = feature_names(lags)
    s = time_split(features, cutpoint)
    part = [STATION, "IS_VALID"]
    n = F.count(F.lit(1)).over(Window.partitionBy(*part))
    bin_ = [F.floor(F.lit(bins) * (F.rank().over(Window.partitionBy(*part).orderBy(F.col(f).cast("double"))) - 1) / n).cast("int")
            for f in feats]
    return s.select(STATION, DATE, "IS_VALID", F.col(COUNT).cast("double").alias("Y"),
                    F.array(*[F.col(f).cast("double") for f in feats]).alias("X"), F.array(*bin_).alias("B"))


def start(rows: DataFrame) -> DataFrame:
    """``rows`` with the station's training mean as the first prediction, all in the root."""
    base = rows.where("NOT IS_VALID").groupBy(STATION).agg(F.avg("Y").alias("BASE"))
    return rows.join(base, STATION).withColumns({"PRED": F.col("BASE"), "NODE": F.lit(1)})


def histogram(rows: DataFrame) -> DataFrame:
    """(station, node, K, B): training rows, their residuals in millionths, the largest value."""
    r = F.round((F.col("Y") - F.col("PRED")) * UNIT).cast("long").alias("R")
    cells = rows.where("NOT IS_VALID").select(STATION, "NODE", r, F.posexplode(F.arrays_zip("B", "X")).alias("K", "C"))
    return cells.groupBy(STATION, "NODE", "K", F.col("C.B").alias("B")).agg(
        F.count(F.lit(1)).alias("N"), F.sum("R").alias("S"), F.max("C.X").alias("CUT"))


def best_splits(hist: DataFrame, min_rows: int = 20) -> DataFrame:
    """(station, node, K, CUT, GAIN): the split X[K] <= CUT with the largest drop of squared error,
    ties to the first feature and the first bin; nodes without a useful split are left out."""
    upto = Window.partitionBy(STATION, "NODE", "K").orderBy("B").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(STATION, "NODE", "K")
    h = hist.withColumns({"NL": F.sum("N").over(upto), "SL": (F.sum("S").over(upto) / UNIT),
                          "NT": F.sum("N").over(whole), "ST": (F.sum("S").over(whole) / UNIT)})
    nr, sr = F.col("NT") - F.col("NL"), F.col("ST") - F.col("SL")
    h = h.where((F.col("NL") >= min_rows) & (nr >= min_rows)).withColumn(
        "GAIN", F.col("SL") * F.col("SL") / F.col("NL") + sr * sr / nr - F.col("ST") * F.col("ST") / F.col("NT"))
    best = F.max_by(F.struct("K", "CUT", "GAIN"), F.struct(F.round("GAIN", 6), -F.col("K"), -F.col("B")))
    return h.where("GAIN > 1e-6").groupBy(STATION, "NODE").agg(best.alias("b")).select(STATION, "NODE", "b.*")


def grow(rows: DataFrame, p: Boost) -> DataFrame:
    """``rows`` in the leaves of one tree for every station: NODE, PATH (the splits from the root,
    null where there is none), the leaf's value V, and PRED with V added."""
    # the one shuffle: every aggregate, window and join below is by station, or by more than that.
    # The rows are few and their trees are work, so partitions are not merged by size.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, STATION).withColumns({"NODE": F.lit(1), "PATH": F.array().cast("array<struct<K:int,CUT:double>>")})
    for _ in range(p.depth):
        best = best_splits(histogram(rows), p.min_rows).groupBy(STATION).agg(
            F.map_from_entries(F.collect_list(F.struct("NODE", F.struct("K", "CUT")))).alias("SPLITS"))
        rows = rows.join(best, STATION, "left").withColumn("s", F.try_element_at("SPLITS", "NODE"))
        right = F.coalesce(F.get("X", F.col("s.K")) > F.col("s.CUT"), F.lit(False)).cast("int")
        rows = rows.withColumns({"PATH": F.concat("PATH", F.array(F.struct(F.col("s.K"), F.col("s.CUT")))),
                                 "NODE": F.col("NODE") * 2 + right}).drop("SPLITS", "s")
    r = F.when(~F.col("IS_VALID"), F.round((F.col("Y") - F.col("PRED")) * UNIT).cast("long"))
    leaf = Window.partitionBy(STATION, "NODE")
    rows = rows.withColumn("V", F.coalesce(F.sum(r).over(leaf) / UNIT / F.count(r).over(leaf) * p.rate, F.lit(0.0)))
    return stored(rows.withColumn("PRED", F.col("PRED") + F.col("V")))


def _leaves(rows: DataFrame, step: int) -> DataFrame:
    """A row per leaf of step ``step``: its path, value, training rows, and held-out squared error."""
    error = F.when(F.col("IS_VALID"), F.pow(F.col("Y") - F.col("PRED"), 2))
    return stored(rows.groupBy(STATION, "NODE").agg(
        F.first("PATH").alias("PATH"), F.first("V").alias("V"), F.count_if(~F.col("IS_VALID")).alias("N"),
        F.sum(error).alias("SE"), F.count(error).alias("NV")).withColumn("STEP", F.lit(step)))


def _trees(leaves: DataFrame, depth: int) -> DataFrame:
    """(station, STEP, TREE): the leaves of a tree as arrays in heap order."""
    first = 1 << depth
    nodes = F.transform("PATH", lambda s, i: F.struct(F.floor(F.col("NODE") / F.pow(F.lit(2), depth - i)).cast("int").alias("n"), s.alias("s")))
    t = leaves.groupBy(STATION, "STEP").agg(
        F.map_from_entries(F.array_distinct(F.flatten(F.collect_list(nodes)))).alias("I"),
        F.map_from_entries(F.collect_list(F.struct("NODE", F.struct("V", "N")))).alias("L"))
    at = lambda m, i, f: F.try_element_at(F.col(m), F.lit(i))[f]
    return t.select(STATION, "STEP", F.struct(
        F.array(*[at("I", i, "K") for i in range(1, first)]).alias("K"), F.array(*[at("I", i, "CUT") for i in range(1, first)]).alias("CUT"),
        F.array(*[F.coalesce(at("L", i, "V"), F.lit(0.0)) for i in range(first, 2 * first)]).alias("V"),
        F.array(*[F.coalesce(at("L", i, "N"), F.lit(0)) for i in range(first, 2 * first)]).alias("N")).alias("TREE"))


def train_trees(features: DataFrame, lags=LAGS, cutpoint: int = CUTPOINT, p: Boost = Boost()) -> DataFrame:
    """(station, N_TRAIN, BASE, BEST, VALID_MSE, TREES), one row per station.

    ``TREES`` holds the ``BEST`` trees kept (split features ``K`` and cuts in heap order, null
    where a node does not split, leaf values ``V`` and training rows ``N``).  ``VALID_MSE`` has
    the held-out error before the first tree and after each one grown.  A station without
    held-out rows keeps every tree; one without training rows has no model.
    """
    if p.trees < 1:
        raise ValueError("trees must be at least 1")
    rows = cut_lineage(start(binned(features, lags, cutpoint, p.bins)))
    stations = rows.groupBy(STATION).agg(F.first("BASE").alias("BASE"), F.count_if(~F.col("IS_VALID")).alias("N_TRAIN"))
    root = rows.withColumns({"PATH": F.array().cast("array<struct<K:int,CUT:double>>"), "V": F.col("BASE")})
    leaves = _leaves(root, 0)
    for step in range(1, p.trees + 1):
        rows = grow(rows, p)
        leaves = leaves.unionByName(_leaves(rows, step))
        best = _best(leaves)
        going = best.where(f"LAST = {step} AND LAST - BEST < {p.patience}").select(STATION)
        if not going.limit(1).count():
            break
        rows = rows.join(going, STATION, "left_semi")
    best = _best(leaves)
    kept = _trees(leaves.where("STEP > 0"), p.depth).join(best, STATION).where("STEP <= BEST").groupBy(STATION).agg(
        F.sort_array(F.collect_list(F.struct("STEP", "TREE")))["TREE"].alias("TREES"))
    return stations.join(best, STATION).join(kept, STATION, "left").select(
        STATION, "N_TRAIN", "BASE", "BEST", "VALID_MSE", F.coalesce("TREES", F.array()).alias("TREES"))


def _best(leaves: DataFrame) -> DataFrame:
    """(station, BEST, LAST, VALID_MSE): the first step of the least held-out error, the last step."""
    e = leaves.groupBy(STATION, "STEP").agg((F.sum("SE") / F.nullif(F.sum("NV"), F.lit(0))).alias("E"))
    return e.groupBy(STATION).agg(
        F.when(F.max("E").isNull(), F.max("STEP")).otherwise(F.min_by("STEP", F.struct("E", "STEP"))).alias("BEST"),
        F.max("STEP").alias("LAST"), F.sort_array(F.collect_list(F.struct("STEP", "E")))["E"].alias("VALID_MSE"))


def _leaf(x: Column, tree: Column, depth: int) -> Column:
    """Heap index of the leaf of ``x``, from 0 within the leaves."""
    node = F.lit(0)
    for _ in range(depth):
        right = F.coalesce(F.get(x, F.get(tree["K"], node)) > F.get(tree["CUT"], node), F.lit(False)).cast("int")
        node = node * 2 + 1 + right
    return node - ((1 << depth) - 1)


def predict_trees(rows: DataFrame, model: DataFrame, lags=LAGS, p: Boost = Boost()) -> DataFrame:
    """PRED for every row, a Column expression; null where a feature is null."""
    feats = feature_names(lags)
    x = F.array(*[F.col(f).cast("double") for f in feats])
    value = F.col("BASE") + F.aggregate("TREES", F.lit(0.0), lambda s, t: s + F.get(t["V"], _leaf(F.col("_X"), t, p.depth)))
    out = rows.drop("PRED").withColumn("_X", x).join(model.select(STATION, "BASE", "TREES"), STATION)
    full = ~F.exists("_X", lambda v: v.isNull() | F.isnan(v))
    return out.withColumn("PRED", F.when(full, value)).drop("_X", "BASE", "TREES")


def _paths(model: DataFrame, depth: int) -> DataFrame:
    """(station, V, SHARE, steps): a row per leaf; a step is the feature, its cut, the side, and
    the share of the node's training rows that goes on to that side (null feature: no split)."""
    trees = model.select(STATION, F.explode("TREES").alias("t"))
    first, leaves = 1 << depth, []

    def count(node: int) -> Column:
        """Training rows below a node of the heap."""
        low = node
        high = node
        while low < first:
            low, high = 2 * low, 2 * high + 1
        return sum((F.col("t.N")[i - first] for i in range(low + 1, high + 1)), F.col("t.N")[low - first])

    for leaf in range(first, 2 * first):
        steps, node = [], 1
        for d in range(depth - 1, -1, -1):
            right = leaf >> d & 1
            child = 2 * node + right
            steps.append(F.struct(F.col("t.K")[node - 1].alias("K"), F.col("t.CUT")[node - 1].alias("CUT"), F.lit(bool(right)).alias("RIGHT"),
                                  (count(child) / F.greatest(count(node), F.lit(1))).alias("Z")))
            node = child
        n = F.col("t.N")[leaf - first]
        leaves.append(F.struct(F.col("t.V")[leaf - first].alias("V"), n.alias("N"), (n / count(1)).alias("SHARE"), *[s.alias(f"S{i}") for i, s in enumerate(steps)]))
    return trees.select(STATION, F.explode(F.array(*leaves)).alias("l")).select(STATION, "l.*").where("N > 0")


def shapley(rows: DataFrame, model: DataFrame, lags=LAGS, p: Boost = Boost()) -> DataFrame:
    """(station, date, EXPECTED, SHAP_f ...): ``EXPECTED`` is the mean prediction of the
    training rows; it and the SHAP values of a row add up to its prediction.  Null where a feature
    of the row is null.  One row per (station, date) of ``rows``.

    A leaf that tests at most three distinct features is a game of three players: a player that
    is in says whether the row passes its tests, one that is out passes by its share.
    """
    feats, depth = feature_names(lags), p.depth
    x = rows.select(STATION, DATE, F.array(*[F.col(f).cast("double") for f in feats]).alias("X"))
    m = x.join(_paths(model, depth), STATION)
    one, cols = F.lit(1.0), {}
    for i in range(3):
        if i < depth:
            s = F.col(f"S{i}")
            passed = (F.coalesce(F.get("X", s["K"]) > s["CUT"], F.lit(False)) == s["RIGHT"]).cast("double")
            cols |= {f"K{i}": s["K"], f"O{i}": F.when(s["K"].isNull(), one).otherwise(passed), f"Z{i}": F.when(s["K"].isNull(), one).otherwise(s["Z"])}
        else:
            cols |= {f"K{i}": F.lit(None).cast("int"), f"O{i}": one, f"Z{i}": one}
    m = m.withColumns(cols)
    # tests of one feature are one player: the first takes the later ones over
    for a, b in ((0, 1), (0, 2), (1, 2)):
        same = F.coalesce(F.col(f"K{a}") == F.col(f"K{b}"), F.lit(False))
        m = m.withColumn("same", same).withColumns({
            f"O{a}": F.when(F.col("same"), F.col(f"O{a}") * F.col(f"O{b}")).otherwise(F.col(f"O{a}")),
            f"Z{a}": F.when(F.col("same"), F.col(f"Z{a}") * F.col(f"Z{b}")).otherwise(F.col(f"Z{a}"))}).withColumns({
                f"K{b}": F.when(F.col("same"), None).otherwise(F.col(f"K{b}")),
                f"O{b}": F.when(F.col("same"), one).otherwise(F.col(f"O{b}")), f"Z{b}": F.when(F.col("same"), one).otherwise(F.col(f"Z{b}"))})
    o, z = [F.col(f"O{i}") for i in range(3)], [F.col(f"Z{i}") for i in range(3)]

    def worth(i: int) -> Column:
        """The player's mean gain over all orders of the three."""
        j, k = [q for q in range(3) if q != i]
        return F.col("V") * (o[i] - z[i]) * ((z[j] * z[k] + o[j] * o[k]) / 3 + (o[j] * z[k] + z[j] * o[k]) / 6)

    m = m.withColumns({f"G{i}": worth(i) for i in range(3)})
    share = lambda f: sum((F.when(F.col(f"K{i}") == f, F.col(f"G{i}")).otherwise(0.0) for i in range(1, 3)),
                          F.when(F.col("K0") == f, F.col("G0")).otherwise(0.0))
    sums = m.groupBy(STATION, DATE).agg(F.sum(F.col("V") * F.col("SHARE")).alias("E"), *[F.sum(share(i)).alias(f"SHAP_{f}") for i, f in enumerate(feats)])
    full = x.select(STATION, DATE, (~F.exists("X", lambda v: v.isNull() | F.isnan(v))).alias("ok")).join(model.select(STATION, "BASE"), STATION)
    out = full.join(sums, [STATION, DATE], "left")
    value = lambda c: F.when(F.col("ok"), F.coalesce(F.col(c), F.lit(0.0)))
    return out.select(STATION, DATE, (F.col("BASE") + F.coalesce("E", F.lit(0.0))).alias("EXPECTED"), *[value(f"SHAP_{f}").alias(f"SHAP_{f}") for f in feats])


def explain_trees(rows: DataFrame, model: DataFrame, lags=LAGS, p: Boost = Boost()) -> DataFrame:
    """``rows`` with EXPL_f, each feature's share of the row's absolute SHAP values (2 places)."""
    feats = feature_names(lags)
    total = sum((F.abs(F.col(f"SHAP_{f}")) for f in feats[1:]), F.abs(F.col(f"SHAP_{feats[0]}")))
    part = lambda f: F.when(total > 0, F.abs(F.col(f"SHAP_{f}")) / total).otherwise(0.0)
    s = shapley(rows, model, lags, p).select(STATION, DATE, *[F.round(part(f), 2).cast("decimal(10,2)").alias(f"EXPL_{f}") for f in feats])
    return rows.join(s, [STATION, DATE]).select(*rows.columns, *[f"EXPL_{f}" for f in feats])


def tree_importance(rows: DataFrame, model: DataFrame, lags=LAGS, p: Boost = Boost()) -> DataFrame:
    """By station, each feature's share of the sum of absolute SHAP values over ``rows``."""
    feats = feature_names(lags)
    s = shapley(rows, model, lags, p).groupBy(STATION).agg(*[F.sum(F.abs(f"SHAP_{f}")).alias(f) for f in feats])
    total = sum((F.col(f) for f in feats[1:]), F.col(feats[0]))
    return s.select(STATION, *[F.round(F.when(total > 0, F.col(f) / total).otherwise(0.0), 4).alias(f"IMP_{f}") for f in feats])


def forecast_trees(features: DataFrame, model: DataFrame, calendar: DataFrame, lags=LAGS,
                   steps: int = FORECAST_STEPS, p: Boost = Boost()) -> DataFrame:
    """Day by day, lags from actuals and then from the own predictions (whole trips).

    A station's group is its last max(lags) actual rows, the forecast days and one model row.
    """
    lags = tuple(int(k) for k in lags)
    rows, schema = forecast_rows(features, calendar, lags, steps)
    depth = p.depth

    def value(x: list, base: float, trees: list) -> float:
        total = base
        for t in trees:
            node = 0
            for _ in range(depth):
                k = t["K"][node]  # null, or NaN from a column of numbers, where the node does not split
                node = 2 * node + 1 + int(k is not None and k == k and x[int(k)] > t["CUT"][node])
            total += t["V"][node + 1 - (1 << depth)]
        return total

    def recurse(pdf: pd.DataFrame, mdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(mdf) and len(pdf):
            pdf = pdf.sort_values(DATE)
            counts = [float(v) for v in pdf.loc[pdf["KIND"] == "H", COUNT]]
            base, trees = float(mdf["BASE"].iloc[0]), list(mdf["TREES"].iloc[0])
            for r in pdf[pdf["KIND"] == "F"].itertuples(index=False):
                lag = [counts[-k] if len(counts) >= k else math.nan for k in lags]
                x = [float("nan") if v is None else float(v) for v in [*lag, r.HOLIDAY, r.PRECIP, r.TEMP]]
                pred = math.nan if any(math.isnan(v) for v in x) else float(round(value(x, base, trees)))
                counts.append(pred)
                out.append([getattr(r, STATION), getattr(r, DATE), pred, *lag, r.HOLIDAY, r.PRECIP, r.TEMP, pred])
        res = pd.DataFrame(out, columns=schema.fieldNames())
        for c in [COUNT, "HOLIDAY", *[f"LAG_{k}" for k in lags]]:
            res[c] = res[c].astype("Int64")
        return res

    kept = model.select(F.col(STATION).alias("_STATION"), "BASE", "TREES")  # another name: both come from ``features``
    return rows.groupBy(STATION).cogroup(kept.groupBy("_STATION")).applyInPandas(recurse, schema)
