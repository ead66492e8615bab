import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from velocast import fixtures as fx
from velocast.config import feature_names
from velocast.operators import evaluate as EV
from velocast.operators import features as H
from velocast.operators import model as M
from velocast.operators import relational as R
from velocast.operators.clean import explain_reason

from conftest import SF01

D0 = dt.date(2020, 1, 1)


def _daily(spark, series):
    rows = [(s, D0 + dt.timedelta(days=d), c) for s, pts in series.items() for d, c in pts]
    return spark.createDataFrame(rows, "STATION_ID string, DATE date, COUNT long")


def test_lags_count_rows_present_not_days(spark):
    # station with a gap: day 3 is missing, so LAG_1 of day 4 is day 2's count
    d = _daily(spark, {"S": [(0, 10), (1, 11), (2, 12), (4, 14)]})
    lag = {r["DATE"]: r["LAG_1"] for r in R.lag_features(d, (1,)).collect()}
    assert lag[D0 + dt.timedelta(days=4)] == 12


def test_lag_default_is_rounded_mean_of_first_rows(spark):
    d = _daily(spark, {"S": [(0, 1), (1, 2), (2, 4), (3, 5)]})
    rows = sorted(R.lag_with_default(d, (2, 3)).collect(), key=lambda r: r["DATE"])
    assert rows[0]["LAG_2"] == 2          # mean(1, 2) = 1.5 -> half-even 2
    assert rows[0]["LAG_3"] == 2          # mean(1, 2, 4) = 2.33 -> 2
    assert rows[3]["LAG_3"] == 1


def test_feature_table_filters(spark):
    long = [(d, 5 + d % 3) for d in range(40)]
    hol = spark.createDataFrame([(D0 + dt.timedelta(days=10), 1)], "DATE date, HOLIDAY int")
    weather = spark.createDataFrame([(D0 + dt.timedelta(days=d), 0.1, 20.0) for d in range(39)],
                                    "DATE date, PRECIP double, TEMP double")
    trips = spark.createDataFrame(
        [(dt.datetime.combine(D0 + dt.timedelta(days=d), dt.time(8)), s)
         for s, pts in {"full": long, "short": long[30:], "stopped": long[:35]}.items()
         for d, c in pts for _ in range(c)] + [(dt.datetime(2020, 1, 5, 9), None)],
        "STARTTIME timestamp, START_STATION_ID string")
    out = H.feature_table(trips, hol, weather, lags=(1, 7), min_days=20)
    # weather misses the last day, so day 39 drops; the latest trip date is day 39 -> nothing survives
    assert out.count() == 0
    weather2 = spark.createDataFrame([(D0 + dt.timedelta(days=d), 0.1, 20.0) for d in range(40)],
                                     "DATE date, PRECIP double, TEMP double")
    out2 = H.feature_table(trips, hol, weather2, lags=(1, 7), min_days=20)
    assert {r["STATION_ID"] for r in out2.collect()} == {"full"}     # short: < 20 rows; stopped: ended early
    assert out2.count() == 40 - 7
    assert out2.filter(F.col("HOLIDAY") == 1).count() == 1


def test_acf_lag_zero_is_one_and_matches_numpy(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 20, 200)
    d = _daily(spark, {"S": list(enumerate(y.tolist()))})
    acf = {r["LAG"]: r["ACF"] for r in H.autocorrelation(d, (0, 1, 7)).collect()}
    yc = y - y.mean()
    for k in (0, 1, 7):
        assert abs(acf[k] - (yc[: len(y) - k] @ yc[k:]) / (yc @ yc)) < 1e-12
    assert abs(acf[0] - 1.0) < 1e-12


def test_acf_of_null_station_and_refused_lags(spark):
    import pytest
    d = _daily(spark, {"S": list(enumerate([1, 4, 2, 8, 5])), None: list(enumerate([1, 4, 2, 8, 5])),
                       "C": [(i, 3) for i in range(10)]})          # constant: ACF undefined
    for lags in ([0, 1, 4, 5, 130], list(range(400))):             # lags past a series' end give 0
        acf = {(r["STATION_ID"], r["LAG"]): r["ACF"] for r in H.autocorrelation(d, lags).collect()}
        assert len(acf) == 3 * len(lags) and acf["C", 1] is None and acf["S", 130] == 0
        assert all(acf[None, k] == acf["S", k] for k in lags) and abs(acf["S", 1] + 4 / 30) < 1e-12
    with pytest.raises(ValueError):
        H.autocorrelation(d, [-1])


def test_time_split_sizes(spark):
    d = _daily(spark, {"A": [(i, 1) for i in range(500)], "B": [(i, 1) for i in range(100)]})
    s = H.time_split(d, 365).groupBy("STATION_ID").agg(F.sum(F.col("IS_VALID").cast("int")).alias("V"))
    assert {r["STATION_ID"]: r["V"] for r in s.collect()} == {"A": 365, "B": 100}


def _features(spark):
    return H.feature_table(fx.trips(spark, SF01), fx.holidays(spark, SF01), fx.weather(spark, SF01)).cache()


def test_ridge_solves_normal_equations(spark):
    f = _features(spark)
    feats = feature_names()
    coefs = {r["STATION_ID"]: r for r in M.train_per_station(f, alpha=0.0).collect()}
    train = H.time_split(f).filter(~F.col("IS_VALID")).toPandas()
    for sid, g in train.groupby("STATION_ID"):
        X = np.column_stack([np.ones(len(g))] + [g[c].astype(float) for c in feats])
        y = g["COUNT"].astype(float).to_numpy()
        c = coefs[sid]
        beta = np.array([c["INTERCEPT"]] + [c[f"B_{k}"] for k in feats])
        grad = X.T @ (y - X @ beta)
        assert np.max(np.abs(grad)) < 1e-6 * max(1.0, np.abs(X.T @ y).max())


def test_forecast_has_steps_plus_one_rows_and_whole_trips(spark):
    f = _features(spark)
    coefs = M.train_per_station(f)
    cal = H.forecast_calendar(fx.trips(spark, SF01), fx.holidays(spark, SF01), fx.weather(spark, SF01))
    fc = M.forecast_recursive(f, coefs, cal).toPandas()
    assert fc.groupby("STATION_ID").size().tolist() == [31, 31]
    assert (fc["PRED"] == fc["PRED"].round()).all()
    # recursion: LAG_1 of the second forecast day is the first day's prediction
    for _, g in fc.sort_values("DATE").groupby("STATION_ID"):
        assert g["LAG_1"].iloc[1] == g["PRED"].iloc[0]
    exp = M.explain_rows(f, coefs).select(*[f"EXPL_{k}" for k in feature_names()]).toPandas().astype(float)
    assert (np.abs(exp.sum(axis=1) - 1.0) < 0.05).all()


def test_evaluate_matches_numpy(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(1, 30, 300).astype(float)
    p = y + rng.normal(0, 2, 300)
    df = spark.createDataFrame([("S", float(a), float(b)) for a, b in zip(y, p)],
                               "STATION_ID string, COUNT double, PRED double")
    r = EV.evaluate_models(df, digits=None).collect()[0]
    e = y - p
    assert abs(r["mae"] - np.abs(e).mean()) < 1e-9
    assert abs(r["rmse"] - np.sqrt((e ** 2).mean())) < 1e-9
    assert abs(r["r_squared"] - (1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-9
    assert abs(r["smape"] - 100 * np.mean(2 * np.abs(e) / (np.abs(y) + np.abs(p)))) < 1e-9
    assert abs(r["pearson_correlation"] - np.corrcoef(y, p)[0, 1]) < 1e-9


def test_constant_predictions_are_scored(spark):
    df = spark.createDataFrame([("S", 1.0, 2.0), ("S", 3.0, 2.0), ("T", 2.0, 1.0), ("T", 2.0, 3.0)], "STATION_ID string, COUNT double, PRED double")
    r = {x["STATION_ID"]: x for x in EV.evaluate_models(df).collect()}
    assert r["S"]["mse"] == 1 and r["S"]["r_squared"] == 0 and r["S"]["pearson_correlation"] is None
    assert r["T"]["r_squared"] is None and r["T"]["pearson_correlation"] is None


def test_tied_explainers_first_wins(spark):
    df = spark.createDataFrame([(0.3, 0.3, 0.1)], "A double, B double, C double")
    r = explain_reason(df, ["A", "B", "C"]).collect()[0]
    assert r["EXPLAIN"] == 0.3 and r["REASON"] == "A"


def test_pack_and_flatten_roundtrip(spark):
    f = _features(spark)
    coefs = M.train_per_station(f)
    hist = M.explain_rows(M.predict_history(f, coefs), coefs)
    cal = H.forecast_calendar(fx.trips(spark, SF01), fx.holidays(spark, SF01), fx.weather(spark, SF01))
    fut = M.explain_rows(M.forecast_recursive(f, coefs, cal), coefs)
    packed = EV.pack_predictions(hist, fut)
    assert EV.flatten_predictions(packed, 0).count() == f.count()
    assert EV.flatten_predictions(packed, 1).count() == 62
