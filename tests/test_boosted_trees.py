"""H10-H14 with boosted trees: growth, early stopping, Shapley values, the recursive forecast."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from velocast.config import feature_names
from velocast.operators import boost as B
from velocast.operators import features as H

D0 = dt.date(2020, 1, 1)
LAGS = (1, 7)
FEATS = feature_names(LAGS)


def _rows(n, seed, signal=True):
    """Feature rows with a step in PRECIP and an interaction of LAG_7 and HOLIDAY."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        lag1, lag7, hol = int(rng.integers(0, 20)), int(rng.integers(0, 20)), int(rng.integers(0, 2))
        rain, temp = round(float(rng.uniform(0, 3)), 2), round(float(rng.normal(15, 5)), 2)
        y = 40 + (10 if rain > 1 else 0) * signal + (8 if lag7 > 10 and hol else 0) * signal + int(rng.integers(-3, 4))
        out.append((D0 + dt.timedelta(days=i), y, lag1, lag7, hol, rain, temp))
    return out


@pytest.fixture(scope="module")
def feats(spark):
    data = {"A": _rows(400, 1), "B": _rows(260, 2), "noise": _rows(300, 3, False), "early": _rows(30, 4)}
    rows = [(s, *r) for s, rs in data.items() for r in rs]
    return spark.createDataFrame(rows, f"STATION_ID string, DATE date, COUNT long, LAG_1 long, LAG_7 long, HOLIDAY int, PRECIP double, TEMP double").repartition(4).cache()


P = B.Boost(trees=6, patience=2, rate=0.6, min_rows=5)


@pytest.fixture(scope="module")
def model(feats):
    return B.train_trees(feats, LAGS, 60, P).cache()


def test_held_out_error_falls_and_growth_stops(model):
    got = {r.STATION_ID: r for r in model.collect()}
    assert set(got) == {"A", "B", "noise"}                  # the early station has no training rows
    for s in "AB":
        e = got[s].VALID_MSE
        assert e[got[s].BEST] == min(e) < 0.3 * e[0] and len(got[s].TREES) == got[s].BEST
    for r in got.values():
        assert len(r.VALID_MSE) - 1 <= P.trees and len(r.VALID_MSE) - 1 - r.BEST <= P.patience
    noise = got["noise"].VALID_MSE                           # stopped by patience, long before the last tree
    assert min(noise) > 0.7 * noise[0]


def _value(x, tree, known, depth):
    """Expectation of one tree where only the features in ``known`` are given."""
    def rows(node):
        first = 1 << depth
        while node < first:
            return rows(2 * node) + rows(2 * node + 1)
        return tree.N[node - first]

    def at(node):
        first = 1 << depth
        if node >= first:
            return tree.V[node - first]
        k = tree.K[node - 1]
        if k is None:
            return at(2 * node)
        if k in known:
            return at(2 * node + int(x[k] > tree.CUT[node - 1]))
        left, right = rows(2 * node), rows(2 * node + 1)
        return (left * at(2 * node) + right * at(2 * node + 1)) / (left + right)

    return at(1)


def test_first_tree_is_the_greedy_one(feats, model):
    """The root's split and the leaves of the first tree against a search over all bins in Python."""
    r = [x for x in model.collect() if x.STATION_ID == "A"][0]
    d = feats.where("STATION_ID = 'A'").orderBy("DATE").toPandas()[:-60]
    assert len(d) == r.N_TRAIN
    res = np.round((d.COUNT - d.COUNT.mean()) * 1e6) / 1e6
    best = (-1,)
    for k, f in enumerate(FEATS):
        x = d[f].astype(float)
        b = np.floor(P.bins * np.array([(x < v).sum() for v in x]) / len(x))
        for cut in sorted(set(b)):
            left = b <= cut
            if min(left.sum(), (~left).sum()) >= P.min_rows:
                gain = res[left].sum() ** 2 / left.sum() + res[~left].sum() ** 2 / (~left).sum() - res.sum() ** 2 / len(res)
                best = max(best, (round(gain, 6), -k, -cut, x[left].max()))
    t = r.TREES[0]
    assert (t.K[0], t.CUT[0]) == (-best[1], best[3])
    x = d[FEATS].astype(float).to_numpy()
    for leaf in range(8):
        path, rows = [leaf >> 2 & 1, leaf >> 1 & 1, leaf & 1], np.ones(len(x), bool)
        node = 1
        for side in path:
            k = t.K[node - 1]
            rows &= (np.zeros(len(x), bool) if k is None else x[:, k] > t.CUT[node - 1]) == bool(side)
            node = 2 * node + side
        assert t.N[leaf] == rows.sum() and (not rows.any() or abs(t.V[leaf] - P.rate * res[rows].mean()) < 1e-5)


def test_shapley_values_by_all_subsets(feats, model):
    m = {r.STATION_ID: r for r in model.collect()}
    pred = {(r.STATION_ID, r.DATE): r for r in B.predict_trees(feats, model, LAGS, P).collect()}
    shap = B.shapley(feats, model, LAGS, P).collect()
    assert len(shap) == 960
    for s in shap:
        values = [s[f"SHAP_{f}"] for f in FEATS]
        assert abs(pred[s.STATION_ID, s.DATE].PRED - s.EXPECTED - sum(values)) < 1e-9
    n = len(FEATS)
    for s in shap[::97]:
        r = pred[s.STATION_ID, s.DATE]
        x = [float(r[f]) for f in FEATS]
        worth = {q: sum(_value(x, t, q, P.depth) for t in m[s.STATION_ID].TREES) for k in range(n + 1) for q in itertools.combinations(range(n), k)}
        for i, f in enumerate(FEATS):
            want = sum(math.factorial(len(q)) * math.factorial(n - len(q) - 1) / math.factorial(n) * (worth[tuple(sorted((*q, i)))] - worth[q])
                       for q in worth if i not in q)
            assert abs(s[f"SHAP_{f}"] - want) < 1e-9
        assert abs(s.EXPECTED - m[s.STATION_ID].BASE - worth[()]) < 1e-9


def test_expected_is_the_mean_prediction_of_the_training_rows(feats, model):
    train = H.time_split(feats, 60).where("NOT IS_VALID")
    mean = {r.STATION_ID: r.m for r in B.predict_trees(train, model, LAGS, P).groupBy("STATION_ID").agg(F.avg("PRED").alias("m")).collect()}
    for r in B.shapley(train, model, LAGS, P).select("STATION_ID", "EXPECTED").distinct().collect():
        assert abs(mean[r.STATION_ID] - r.EXPECTED) < 1e-9


def test_explanations_and_importance(feats, model):
    e = B.explain_trees(feats, model, LAGS, P).toPandas()
    part = e[[f"EXPL_{f}" for f in FEATS]].astype(float)
    assert ((part.sum(axis=1) - 1).abs() < 0.04).sum() >= 660 and (part >= 0).all().all()
    imp = {r.STATION_ID: r for r in B.tree_importance(feats, model, LAGS, P).collect()}
    assert imp["A"].IMP_PRECIP > 0.4 and abs(sum(imp["A"][f"IMP_{f}"] for f in FEATS) - 1) < 1e-3


def test_forecast_feeds_itself(spark, feats, model):
    days = [(D0 + dt.timedelta(days=399 + i), int(i % 2), 0.5 * (i % 5), 15.0) for i in range(1, 8) if i != 6]
    cal = spark.createDataFrame(days, "DATE date, HOLIDAY int, PRECIP double, TEMP double")
    out = B.forecast_trees(feats.where("STATION_ID = 'A'"), model, cal, LAGS, 6, P).orderBy("DATE").collect()
    assert len(out) == 7 and out[5].PRED is None and out[6].PRED is None     # no weather on day 6, so no lag on day 7
    assert all(b.LAG_1 == a.PRED for a, b in zip(out[:4], out[1:5])) and all(r.PRED == round(r.PRED) for r in out[:5])
    again = B.predict_trees(spark.createDataFrame(out[:5], B.forecast_rows(feats, cal, LAGS, 6)[1]), model, LAGS, P).orderBy("DATE").collect()
    assert [round(r.PRED) for r in again] == [r.PRED for r in out[:5]]


def test_forecast_of_trees_with_nodes_that_do_not_split(spark, feats):
    p = B.Boost(trees=1, patience=1, min_rows=90)
    a = feats.where("STATION_ID = 'A'")
    model = B.train_trees(a, LAGS, 60, p).cache()
    tree = model.collect()[0].TREES[0]
    assert None in tree.K and tree.K[0] is not None
    cal = spark.createDataFrame([(D0 + dt.timedelta(days=399 + i), 0, 0.7 * i, 15.0) for i in range(1, 4)], "DATE date, HOLIDAY int, PRECIP double, TEMP double")
    out = B.forecast_trees(a, model, cal, LAGS, 2, p).orderBy("DATE").collect()
    again = B.predict_trees(spark.createDataFrame(out, B.forecast_rows(a, cal, LAGS, 2)[1]), model, LAGS, p).orderBy("DATE").collect()
    assert len(out) == 3 and [round(r.PRED) for r in again] == [r.PRED for r in out]


def test_odd_input(feats):
    with pytest.raises(ValueError):
        B.Boost(depth=4)
    assert B.train_trees(feats.limit(0), LAGS, 60, P).count() == 0
    alone = B.train_trees(feats.where("STATION_ID = 'B'"), LAGS, 0, B.Boost(trees=2, patience=1)).collect()[0]
    assert alone.BEST == 2 and alone.VALID_MSE == [None] * 3 and alone.N_TRAIN == 260    # nothing held out: every tree stays


def test_a_run_with_trees(spark):
    """The model steps of a run with either learner write the same tables."""
    import uuid

    from velocast import fixtures as fx
    from velocast.config import RunConfig
    from velocast.plans import runs as KR
    from velocast.sources import catalog as A

    from conftest import SF01

    db = "trees_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db}")
    spark.catalog.setCurrentDatabase(db)
    try:
        cfg = RunConfig(database=db, postcode=fx.FIXTURE_POSTCODE, learner="trees", extra={"trees": B.Boost(trees=2, patience=2, rate=0.5)})
        A.write_overwrite(fx.trips(spark, SF01), cfg.trips)
        out = KR.model_steps(spark, cfg, fx.weather_source(spark, SF01), "2001_09_01")
        model = spark.table(cfg.coefficients).collect()
        flat = spark.table(out["flat_forecast"]).collect()
        assert len(flat) == 62 and all(r.PRED is not None for r in flat) and {r.STATION_ID for r in flat} == {r.STATION_ID for r in model}
        assert all(len(r.TREES) == r.BEST and len(r.VALID_MSE) >= 2 for r in model)
        assert spark.table(out["flat_eval"]).count() == 2 and spark.table(out["flat_pred"]).count() == 2739
        with pytest.raises(ValueError):
            KR.fit_and_explain(spark, RunConfig(learner="net"), None, None)
    finally:
        spark.catalog.setCurrentDatabase("default")
