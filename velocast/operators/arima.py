"""H8 by maximum likelihood: ARIMA(1,1,1), and trend with ARMA(1,1) errors, one per station.

Both are an ARMA(1,1) in state-space form.  Its Kalman filter, started in the stationary
distribution, is a recursion of two numbers: the one-step prediction and the ratio ``r`` of its
variance to the noise variance.  The noise variance and the regression coefficients maximise the
likelihood in closed form (least squares of the filter's scaled innovations), which leaves two
parameters; a search over shrinking grids finds them, all points of a grid in one pass.

A station's group is its daily series, bounded by the calendar, not by the number of trips.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CUTPOINT
from .relational import COUNT, DATE, STATION

#: name -> (order of differencing, constant and linear trend or none)
MODELS = {"111": (1, False), "ct101": (0, True)}
EDGE = 0.999  # |phi| and |theta| stay within: stationary and invertible


def innovations(phi: np.ndarray, theta: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(e, r): for each parameter pair and column (rows of ``cols`` are times), innovations
    e[time, pair, column] and variance ratios r[time, pair]."""
    r = (1 + 2 * phi * theta + theta ** 2) / (1 - phi ** 2)
    pred = np.zeros((len(phi), cols.shape[1]))
    e, rs = np.empty((len(cols), *pred.shape)), np.empty((len(cols), len(phi)))
    for t, x in enumerate(cols):
        e[t], rs[t] = x - pred, r
        pred = phi[:, None] * x + (theta / r)[:, None] * e[t]
        r = 1 + theta ** 2 - theta ** 2 / r
    return e, rs


def likelihood(phi: np.ndarray, theta: np.ndarray, y: np.ndarray, regressors: np.ndarray):
    """(log likelihood, coefficients, noise variance, e, r) with the last three maximised."""
    e, r = innovations(phi, theta, np.column_stack([y, regressors]))
    w = e / np.sqrt(r)[:, :, None]
    k = regressors.shape[1]
    beta = np.zeros((len(phi), k))
    if k:
        xx = np.einsum("tpi,tpj->pij", w[:, :, 1:], w[:, :, 1:])
        xy = np.einsum("tpi,tp->pi", w[:, :, 1:], w[:, :, 0])
        beta = np.linalg.solve(xx, xy[:, :, None])[:, :, 0]
    rest = w[:, :, 0] - np.einsum("tpi,pi->tp", w[:, :, 1:], beta)
    n = len(y)
    var = (rest ** 2).sum(axis=0) / n
    ll = -0.5 * (n * np.log(2 * math.pi * np.maximum(var, 1e-300)) + np.log(r).sum(axis=0) + n)
    return ll, beta, var, e, r


def search(f, points: int = 13, shrink: float = 0.3, least: float = 1e-7) -> tuple[float, float]:
    """The (phi, theta) with the largest ``f``: a grid over the square, then smaller ones around the best."""
    centre, half = np.zeros(2), EDGE
    best = (-math.inf, 0.0, 0.0)
    while half > least:
        side = np.linspace(-half, half, points)
        phi, theta = (np.clip(c + g.ravel(), -EDGE, EDGE) for c, g in zip(centre, np.meshgrid(side, side)))
        value = f(phi, theta)
        at = int(np.argmax(value))
        if value[at] > best[0]:
            best = (float(value[at]), float(phi[at]), float(theta[at]))
        centre, half = np.array(best[1:]), half * shrink
    return best[1:]


def regress_on(model: str, times: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(times)), times]) if MODELS[model][1] else np.empty((len(times), 0))


def fit(y: np.ndarray, model: str) -> dict | None:
    """Maximum-likelihood fit of one series; None where it is too short or has no variance."""
    d, trend = MODELS[model]
    x = np.diff(y, d)
    n, regs = len(x), regress_on(model, np.arange(1, len(x) + 1, dtype=float))
    if n < 5 + regs.shape[1] or np.ptp(x) == 0:
        return None
    scale = float(np.std(x)) or 1.0  # parameters do not depend on the unit
    phi, theta = search(lambda p, t: likelihood(p, t, x / scale, regs)[0])
    ll, beta, var, e, r = likelihood(np.array([phi]), np.array([theta]), x, regs)
    const, slope = (beta[0].tolist() if trend else [0.0, 0.0])
    last = float(x[-1] - const - slope * n), float(e[-1, 0, 0] - e[-1, 0, 1:] @ beta[0]), float(r[-1, 0])
    hat = x - (e[:, 0, 0] - e[:, 0, 1:] @ beta[0])  # one-step predictions
    return dict(phi=phi, theta=theta, const=const, slope=slope, var=float(var[0]), ll=float(ll[0]), n=n, last=last,
                k=2 + regs.shape[1] + 1, history=hat if d == 0 else np.concatenate([[0.0], y[:-1] + hat]))


def forecast(y: np.ndarray, f: dict, model: str, steps: int) -> np.ndarray:
    """The next ``steps`` values after ``y``."""
    x, e, r = f["last"]
    h = np.arange(1, steps + 1)
    out = (f["phi"] * x + f["theta"] / r * e) * f["phi"] ** (h - 1.0)
    out = out + f["const"] + f["slope"] * (f["n"] + h)
    return y[-1] + np.cumsum(out) if MODELS[model][0] else out


FIT = [("MODEL", T.StringType()), ("N_TRAIN", T.LongType()), ("PHI", T.DoubleType()), ("THETA", T.DoubleType()),
       ("CONST", T.DoubleType()), ("TREND", T.DoubleType()), ("SIGMA2", T.DoubleType()), ("LOGLIK", T.DoubleType()),
       ("AIC", T.DoubleType()), ("N_HOLDOUT", T.LongType()), ("MSE", T.DoubleType())]


def _series(pdf: pd.DataFrame, value: str) -> tuple[pd.DataFrame, np.ndarray]:
    pdf = pdf.sort_values(DATE)
    return pdf, pdf[value].astype(float).to_numpy()


def arima_fit(daily: DataFrame, models=tuple(MODELS), holdout: int = CUTPOINT, key: str = STATION, value: str = COUNT) -> DataFrame:
    """H8: parameters, likelihood and held-out MSE, a row per station and model.

    All but a station's last ``holdout`` rows are fitted; the forecast of those rows is scored.
    A series too short to fit, or without variance, has no row; a null station is a station.
    """
    schema = T.StructType([T.StructField(key, daily.schema[key].dataType), *[T.StructField(*x) for x in FIT]])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, y = _series(pdf, value)
        train, test, out = y[:max(0, len(y) - holdout)], y[max(0, len(y) - holdout):], []
        for m in models:
            if (f := fit(train, m)) is None:
                continue
            mse = float(np.mean((test - forecast(train, f, m, len(test))) ** 2)) if len(test) else None
            out.append([pdf[key].iloc[0], m, len(train), f["phi"], f["theta"], f["const"], f["slope"], f["var"], f["ll"],
                        2 * f["k"] - 2 * f["ll"], len(test), mse])
        return pd.DataFrame(out, columns=schema.fieldNames())

    return daily.select(key, DATE, value).groupBy(key).applyInPandas(run, schema)


def arima_series(daily: DataFrame, model: str = "ct101", holdout: int = CUTPOINT, key: str = STATION,
                 value: str = COUNT) -> DataFrame:
    """H8: (station, date, value, HISTORY, FORECAST): one-step predictions of the fitted rows, the
    forecast of the last ``holdout`` ones.  Series without a fit keep their rows with nulls."""
    schema = T.StructType([T.StructField(key, daily.schema[key].dataType), T.StructField(DATE, daily.schema[DATE].dataType),
                           T.StructField(value, T.DoubleType()), T.StructField("HISTORY", T.DoubleType()), T.StructField("FORECAST", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, y = _series(pdf, value)
        cut = max(0, len(y) - holdout)
        f = fit(y[:cut], model)
        out = pd.DataFrame({key: pdf[key], DATE: pdf[DATE], value: y, "HISTORY": None, "FORECAST": None})
        if f:
            out["HISTORY"] = np.concatenate([f["history"], np.full(len(y) - cut, np.nan)])
            out["FORECAST"] = np.concatenate([np.full(cut, np.nan), forecast(y[:cut], f, model, len(y) - cut)])
        for c in ("HISTORY", "FORECAST"):
            out[c] = pd.array([None if v is None or math.isnan(v) else v for v in out[c]], "Float64")
        return out

    return daily.select(key, DATE, value).groupBy(key).applyInPandas(run, schema)
