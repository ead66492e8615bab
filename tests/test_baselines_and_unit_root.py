"""H7 and H8: the maximum-likelihood baselines and the augmented unit-root test."""

import datetime as dt
import math

import numpy as np
import pytest

from velocast.book.model import dense_daily
from velocast.operators import arima as AR
from velocast.operators import baseline as HB
from velocast.operators import unitroot as U

from conftest import SF01

D0 = dt.date(2020, 1, 1)


def daily(spark, series):
    rows = [(s, D0 + dt.timedelta(days=i), float(v)) for s, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "STATION_ID string, DATE date, COUNT double").repartition(3)


def dense(phi, theta, y, regs):
    """Log likelihood by the full covariance matrix, mean and variance at their best."""
    n = len(y)
    gamma = [(1 + 2 * phi * theta + theta ** 2) / (1 - phi ** 2)]
    gamma += [((1 + phi * theta) * (phi + theta) / (1 - phi ** 2)) * phi ** k for k in range(n - 1)]
    c = np.array([[gamma[abs(i - j)] for j in range(n)] for i in range(n)])
    inv = np.linalg.inv(c)
    beta = np.linalg.solve(regs.T @ inv @ regs, regs.T @ inv @ y) if regs.shape[1] else np.zeros(0)
    e = y - regs @ beta
    var = e @ inv @ e / n
    return -0.5 * (n * math.log(2 * math.pi * var) + np.linalg.slogdet(c)[1] + n), beta, var


@pytest.mark.parametrize("model", AR.MODELS)
@pytest.mark.parametrize("phi,theta", [(0.5, 0.3), (-0.7, 0.2), (0.9, -0.8), (0.0, 0.0), (0.3, 0.99)])
def test_filter_gives_the_dense_likelihood(model, phi, theta):
    rng = np.random.default_rng(3)
    y = rng.normal(size=30).cumsum() + 5
    regs = AR.regress_on(model, np.arange(1, 31, dtype=float))
    ll, beta, var, _, _ = AR.likelihood(np.array([phi]), np.array([theta]), y, regs)
    want = dense(phi, theta, y, regs)
    assert abs(ll[0] - want[0]) < 1e-8 and np.allclose(beta[0], want[1]) and abs(var[0] - want[2]) < 1e-9


@pytest.mark.parametrize("phi,theta", [(0.6, 0.3), (0.4, 0.5), (0.85, -0.4)])
def test_the_search_ends_where_the_gradient_is_zero(phi, theta):
    rng = np.random.default_rng(11)
    e, x = rng.normal(size=801), [0.0]
    for t in range(1, 801):
        x.append(phi * x[-1] + e[t] + theta * e[t - 1])
    x = np.array(x)
    f = lambda p, t: AR.likelihood(np.atleast_1d(p), np.atleast_1d(t), x, np.empty((len(x), 0)))[0]
    p, t = AR.search(f)
    assert abs(p - phi) < 0.12 and abs(t - theta) < 0.12
    step = 1e-4
    assert abs((f(p + step, t) - f(p - step, t))[0] / (2 * step)) < 0.05 and abs((f(p, t + step) - f(p, t - step))[0] / (2 * step)) < 0.05
    grid = np.linspace(-0.99, 0.99, 45)
    a, b = np.meshgrid(grid, grid)
    assert f(p, t)[0] >= f(a.ravel(), b.ravel()).max() - 1e-9


def test_forecast_is_the_conditional_mean():
    """The forecast by recursion equals the Gaussian conditional mean given the whole series."""
    rng = np.random.default_rng(5)
    y = rng.normal(size=40).cumsum() + 0.2 * np.arange(40)
    f = AR.fit(y, "ct101")
    n, h = len(y), 6
    phi, theta = f["phi"], f["theta"]
    gamma = [(1 + 2 * phi * theta + theta ** 2) / (1 - phi ** 2)]
    gamma += [((1 + phi * theta) * (phi + theta) / (1 - phi ** 2)) * phi ** k for k in range(n + h)]
    c = np.array([[gamma[abs(i - j)] for j in range(n + h)] for i in range(n + h)])
    mean = f["const"] + f["slope"] * np.arange(1, n + h + 1)
    want = mean[n:] + c[n:, :n] @ np.linalg.solve(c[:n, :n], y - mean[:n])
    assert np.allclose(AR.forecast(y, f, "ct101", h), want, atol=1e-6)


def test_fits_of_all_stations(spark):
    d = dense_daily(spark, SF01).cache()
    rows = AR.arima_fit(d).collect()
    assert {(r.STATION_ID, r.MODEL) for r in rows} == {(s, m) for s in "ANR" for m in AR.MODELS}
    old = {r.STATION_ID: r.MSE for r in HB.ar_baseline(d).collect()}, {r.STATION_ID: r.MSE for r in HB.trend_ar_baseline(d).collect()}
    for r in rows:
        assert r.N_HOLDOUT == 365 and abs(r.PHI) < 1 and abs(r.THETA) < 1 and math.isfinite(r.AIC)
        assert r.MSE <= old[r.MODEL == "ct101"][r.STATION_ID] * 1.02
    s = AR.arima_series(d).toPandas()
    one = s[s.STATION_ID == "A"].sort_values("DATE")
    assert one.FORECAST.notna().sum() == 365 and one.HISTORY.notna().sum() == len(one) - 365
    mse = {(r.STATION_ID, r.MODEL): r.MSE for r in rows}
    tail = one[one.FORECAST.notna()]
    assert abs(((tail.COUNT - tail.FORECAST.astype(float)) ** 2).mean() - mse["A", "ct101"]) < 1e-6


def test_short_and_flat_series(spark):
    d = daily(spark, {"short": [1, 2, 3], "flat": [4] * 60, None: list(np.random.default_rng(1).normal(size=80))})
    rows = AR.arima_fit(d, holdout=10).collect()
    assert {(r.STATION_ID, r.MODEL) for r in rows} == {(None, m) for m in AR.MODELS}
    s = AR.arima_series(d, holdout=10).toPandas()
    assert len(s) == 143 and s[s.STATION_ID == "flat"].FORECAST.isna().all()
    assert AR.arima_fit(d.limit(0)).count() == 0 and U.unit_root(d.limit(0)).count() == 0


# ------------------------------------------------------------ unit root

def ols(y, x):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    e = y - x @ beta
    rss = float(e @ e)
    cov = np.linalg.inv(x.T @ x) * rss / (len(y) - x.shape[1])
    return rss, beta, np.sqrt(np.diag(cov))


def adf(x):
    """The test by a regression for each order."""
    x = np.asarray(x, float)
    n = len(x)
    most = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    d = np.diff(x)

    def design(p, first):
        t = np.arange(first, n - 1)  # d[t] is the change from x[t] to x[t + 1]
        return d[t], np.column_stack([np.ones(len(t)), x[t], *[d[t - k] for k in range(1, p + 1)]])

    best = []
    for p in range(most + 1):
        y, z = design(p, most)
        rss = ols(y, z)[0]
        best.append((len(y) * (math.log(2 * math.pi * rss / len(y)) + 1) + 2 * z.shape[1], p))
    p = min(best)[1]
    y, z = design(p, p)
    _, beta, se = ols(y, z)
    return p, len(y), beta[1] / se[1]


def test_every_order_from_one_gram_matrix(spark):
    rng = np.random.default_rng(7)
    ar = [0.0, 0.0, 0.0, 0.0]
    for e in rng.normal(size=300):
        ar.append(0.5 * ar[-1] - 0.3 * ar[-3] + 0.2 * ar[-4] + e)
    series = {"walk": rng.normal(size=250).cumsum(), "noise": rng.normal(size=120), "ar": ar, "week": [i % 7 + v for i, v in enumerate(rng.normal(size=200))],
              "short": rng.normal(size=9), "counts": rng.integers(0, 9, 400)}
    got = {r.STATION_ID: r for r in U.unit_root(daily(spark, series)).collect()}
    for name, y in series.items():
        p, n, t = adf(y)
        assert (got[name].USED_LAG, got[name].N_OBS) == (p, n) and abs(got[name].ADF_T - t) < 1e-5, name
    assert got["walk"].P_VALUE > 0.05 > got["noise"].P_VALUE


def test_flat_series_have_no_statistic(spark):
    got = {r.STATION_ID: r for r in U.unit_root(daily(spark, {"flat": [3] * 50, "two": [1, 2], "ok": [1, 3, 2, 5, 1, 4, 2, 6, 1, 3]})).collect()}
    assert got["flat"].ADF_T is None and got["flat"].USED_LAG is None and "two" not in got and got["ok"].ADF_T is not None


def test_p_values_at_the_published_critical_points():
    for t, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert abs(U.p_value(t) - p) < 0.002
    assert U.p_value(-30) == 0 and U.p_value(3) == 1
    at = [U.p_value(t) for t in np.linspace(-18, 2.7, 200)]
    assert all(a <= b + 1e-9 for a, b in zip(at, at[1:]))


def test_rolling_change(spark):
    y = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]
    mean = [sum(y[i - 6:i + 1]) / 7 for i in range(6, len(y))]
    got = [r.COUNT for r in U.rolling_change(daily(spark, {"s": y})).orderBy("DATE").collect()]
    assert np.allclose(got, np.diff(mean))
