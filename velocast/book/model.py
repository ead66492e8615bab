"""Registered queries for ACF, baselines, the per-station models, scoring,
result packing/flattening and the function surface (H6-H17, I1-I3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..config import feature_names
from ..operators import baseline as HB
from ..operators import evaluate as EV
from ..operators import features as H
from ..operators import model as M
from ..operators import udfs as U
from ..session import cut_lineage, scratch_path
from . import BASE, features_ctes, register, with_ctes

FEATS = feature_names()

LDAILY = """ldaily AS (
  SELECT l_returnflag AS STATION_ID, CAST(l_shipdate AS DATE) AS DATE, count(*) AS "COUNT"
  FROM lineitem GROUP BY 1, 2)"""

PREDS_DAILY = """pdaily AS (
  SELECT l_returnflag AS STATION_ID, CAST(l_shipdate AS DATE) AS DATE,
         sum(l_quantity) AS y_true, sum(l_quantity * (1.0 + l_discount - 0.05)) AS y_score
  FROM lineitem GROUP BY 1, 2)"""

PREDS = """preds AS (
  SELECT l_returnflag AS STATION_ID, l_quantity AS y_true,
         l_quantity * (1.0 + l_discount - 0.05) AS y_score FROM lineitem)"""


def dense_daily(spark, sf_dir):
    """Per (return flag, ship day) line counts: the dense series for ACF and baselines."""
    li = fx.load(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_returnflag").alias("STATION_ID"), F.to_date("l_shipdate").alias("DATE")) \
             .agg(F.count(F.lit(1)).alias("COUNT"))


def _features(spark, sf_dir):
    return H.feature_table(fx.trips(spark, sf_dir), fx.holidays(spark, sf_dir), fx.weather(spark, sf_dir))


def _calendar(spark, sf_dir):
    return H.forecast_calendar(fx.trips(spark, sf_dir), fx.holidays(spark, sf_dir), fx.weather(spark, sf_dir))


# ------------------------------------------------------------ H6 - H8

ACF_LAGS = (1, 7, 30, 60, 90, 365)


def _acf_sql(lags) -> str:
    return with_ctes(LDAILY) + f"""
, c AS (SELECT STATION_ID, row_number() OVER (PARTITION BY STATION_ID ORDER BY DATE) AS RN,
               "COUNT" - avg("COUNT") OVER (PARTITION BY STATION_ID) AS D FROM ldaily),
den AS (SELECT STATION_ID, sum(D * D) AS DEN FROM c GROUP BY 1),
lags AS (SELECT unnest({list(lags)}) AS LAG),
num AS (SELECT a.STATION_ID, l.LAG, sum(a.D * b.D) AS NUM
        FROM c a CROSS JOIN lags l JOIN c b ON b.STATION_ID = a.STATION_ID AND b.RN = a.RN + l.LAG
        GROUP BY 1, 2)
SELECT d.STATION_ID, CAST(l.LAG AS INTEGER) AS LAG,
       round(CASE WHEN d.DEN > 0 THEN coalesce(n.NUM, 0) / d.DEN END, 6) AS ACF
FROM den d CROSS JOIN lags l LEFT JOIN num n ON n.STATION_ID = d.STATION_ID AND n.LAG = l.LAG"""


@register("autocorrelation", _acf_sql(ACF_LAGS))
def autocorrelation(spark, sf_dir):
    a = H.autocorrelation(dense_daily(spark, sf_dir), ACF_LAGS)
    return a.withColumn("ACF", F.round("ACF", 6))


ACF_MAX_LAG = 400


@register("autocorrelation_400", _acf_sql(range(1, ACF_MAX_LAG + 1)))
def autocorrelation_400(spark, sf_dir):
    """H6 at every lag 1..400 (the reference's ACF plot): one vectorised pass per station."""
    a = H.autocorrelation(dense_daily(spark, sf_dir), range(1, ACF_MAX_LAG + 1))
    return a.withColumn("ACF", F.round("ACF", 6))


def _df_sql(y, x):
    return (f"(regr_sxy({y}, {x}) / regr_sxx({y}, {x})) / sqrt((regr_syy({y}, {x}) - "
            f"regr_sxy({y}, {x}) * regr_sxy({y}, {x}) / regr_sxx({y}, {x})) / (regr_count({y}, {x}) - 2) "
            f"/ regr_sxx({y}, {x}))")


@register("stationarity_stat", with_ctes(LDAILY) + f"""
, s1 AS (SELECT *, CAST("COUNT" AS DOUBLE) AS Y,
                lag(CAST("COUNT" AS DOUBLE), 1) OVER (PARTITION BY STATION_ID ORDER BY DATE) AS YL FROM ldaily),
s2 AS (SELECT *, Y - YL AS DY FROM s1),
s3 AS (SELECT *, lag(DY, 1) OVER (PARTITION BY STATION_ID ORDER BY DATE) AS DYL FROM s2),
s4 AS (SELECT *, DY - DYL AS DDY FROM s3)
SELECT STATION_ID, CAST(regr_count(DY, YL) AS BIGINT) AS N,
       round({_df_sql('DY', 'YL')}, 6) AS DF_T_LEVEL,
       round({_df_sql('DDY', 'DYL')}, 6) AS DF_T_DIFF
FROM s4 GROUP BY STATION_ID""")
def stationarity_stat(spark, sf_dir):
    return HB.stationarity_stat(dense_daily(spark, sf_dir))


@register("ar_baseline", with_ctes(LDAILY) + """
, s AS (SELECT STATION_ID, DATE, CAST("COUNT" AS DOUBLE) AS Y,
               row_number() OVER (PARTITION BY STATION_ID ORDER BY DATE) AS RN,
               count(*) OVER (PARTITION BY STATION_ID) AS N FROM ldaily),
d AS (SELECT *, Y - lag(Y, 1) OVER (PARTITION BY STATION_ID ORDER BY DATE) AS DY, N - 365 AS T FROM s),
e AS (SELECT *, lag(DY, 1) OVER (PARTITION BY STATION_ID ORDER BY DATE) AS DYL FROM d),
p AS (SELECT STATION_ID, regr_slope(DY, DYL) AS PHI, regr_intercept(DY, DYL) AS C,
             arg_max(Y, RN) AS YT, arg_max(DY, RN) AS DYT
      FROM e WHERE RN <= T GROUP BY 1),
t AS (SELECT e.STATION_ID, e.Y, CAST(e.RN - e.T AS DOUBLE) AS H FROM e WHERE e.RN > e.T),
f AS (SELECT t.STATION_ID, p.PHI, p.C,
             t.Y - (p.YT + t.H * (p.C / (1 - p.PHI))
                    + (p.DYT - p.C / (1 - p.PHI)) * p.PHI * (1 - pow(p.PHI, t.H)) / (1 - p.PHI)) AS ERR
      FROM t JOIN p ON t.STATION_ID = p.STATION_ID)
SELECT STATION_ID, round(first(PHI), 6) AS PHI, round(first(C), 6) AS C, count(*) AS N_HOLDOUT,
       round(avg(ERR * ERR), 4) AS MSE
FROM f GROUP BY STATION_ID""")
def ar_baseline(spark, sf_dir):
    return HB.ar_baseline(dense_daily(spark, sf_dir))


@register("ar_baseline_trend", with_ctes(LDAILY) + """
, s AS (SELECT STATION_ID, DATE, CAST("COUNT" AS DOUBLE) AS Y,
               CAST(row_number() OVER (PARTITION BY STATION_ID ORDER BY DATE) AS DOUBLE) AS RN,
               CAST(count(*) OVER (PARTITION BY STATION_ID) - 365 AS DOUBLE) AS T FROM ldaily),
s1 AS (SELECT *, regr_slope(CASE WHEN RN <= T THEN Y END, CASE WHEN RN <= T THEN RN END)
                   OVER (PARTITION BY STATION_ID) AS B,
                 regr_intercept(CASE WHEN RN <= T THEN Y END, CASE WHEN RN <= T THEN RN END)
                   OVER (PARTITION BY STATION_ID) AS A FROM s),
s2 AS (SELECT *, Y - A - B * RN AS E FROM s1),
s3 AS (SELECT *, lag(E, 1) OVER (PARTITION BY STATION_ID ORDER BY DATE) AS EL FROM s2),
s4 AS (SELECT *, regr_slope(CASE WHEN RN <= T THEN E END, CASE WHEN RN <= T THEN EL END)
                   OVER (PARTITION BY STATION_ID) AS PHI,
                 regr_intercept(CASE WHEN RN <= T THEN E END, CASE WHEN RN <= T THEN EL END)
                   OVER (PARTITION BY STATION_ID) AS C,
                 max(CASE WHEN RN = T THEN E END) OVER (PARTITION BY STATION_ID) AS ET FROM s3),
f AS (SELECT STATION_ID, B, PHI,
             Y - (A + B * RN + C / (1 - PHI) + pow(PHI, RN - T) * (ET - C / (1 - PHI))) AS ERR
      FROM s4 WHERE RN > T)
SELECT STATION_ID, round(first(B), 6) AS TREND, round(first(PHI), 6) AS PHI, count(*) AS N_HOLDOUT,
       round(avg(ERR * ERR), 4) AS MSE
FROM f GROUP BY STATION_ID""")
def ar_baseline_trend(spark, sf_dir):
    """H8, second model: trend + AR(1) errors, last 365 rows held out."""
    return HB.trend_ar_baseline(dense_daily(spark, sf_dir))


# ------------------------------------------------------------ H9 - H14

SPLIT_SQL = """split AS (
  SELECT *, row_number() OVER (PARTITION BY STATION_ID ORDER BY DATE DESC) <= 365 AS IS_VALID FROM features)"""


@register("time_split", with_ctes(*BASE, *features_ctes(), SPLIT_SQL) + "SELECT * FROM split")
def time_split(spark, sf_dir):
    return H.time_split(_features(spark, sf_dir))


def _gram_sql():
    y = 'CAST("COUNT" AS DECIMAL(20,0))'
    d = lambda c: f"CAST({c} AS DECIMAL(20,2))"
    parts = ["count(*) AS N", f"CAST(sum({y}) AS DOUBLE) AS S_Y", f"CAST(sum({y} * {y}) AS DOUBLE) AS S_Y_Y"]
    for i, a in enumerate(FEATS):
        parts.append(f"CAST(sum({d(a)}) AS DOUBLE) AS S_{a}")
        parts.append(f"CAST(sum({d(a)} * {y}) AS DOUBLE) AS S_{a}_Y")
        for b in FEATS[i:]:
            parts.append(f"CAST(sum({d(a)} * {d(b)}) AS DOUBLE) AS S_{a}_{b}")
    return "SELECT STATION_ID, " + ",\n  ".join(parts) + "\nFROM split WHERE NOT IS_VALID GROUP BY STATION_ID"


@register("train_gram", with_ctes(*BASE, *features_ctes(), SPLIT_SQL) + _gram_sql())
def train_gram(spark, sf_dir):
    return M.train_gram(_features(spark, sf_dir))


def _coefs_ctes(alpha: float = 1.0) -> list[str]:
    """The ridge of every station in SQL: standardised moments from the Gram sums, Gauss-Jordan
    elimination of one pivot a step, coefficients in the features' units."""
    p = len(FEATS)
    pair = lambda i, j: f"S_{FEATS[min(i, j)]}_{FEATS[max(i, j)]}"
    cells = [f"SELECT STATION_ID AS T, {i} AS I, {j} AS J, N, {pair(i, j)} / N - (S_{a} / N) * (S_{b} / N) AS V FROM gram"
             for i, a in enumerate(FEATS) for j, b in enumerate(FEATS)]
    cells += [f"SELECT STATION_ID, {i}, {p}, N, S_{a}_Y / N - (S_{a} / N) * (S_Y / N) FROM gram" for i, a in enumerate(FEATS)]
    get = lambda f: [f"{f(i, c)}" for i, c in enumerate(FEATS)]
    beta = get(lambda i, c: f"max(G / SD) FILTER (I = {i} AND SD > 1e-12)")
    return [f"gram AS ({_gram_sql()})", f"cells AS ({' UNION ALL '.join(cells)})",
            "sds AS (SELECT T, I, sqrt(greatest(V, 0)) AS SD FROM cells WHERE I = J)",
            f"""std AS (SELECT c.T, c.I, c.J, CASE WHEN a.SD <= 1e-12 OR b.SD <= 1e-12 THEN 0 ELSE V / a.SD / coalesce(b.SD, 1) END
         + CASE WHEN c.I = c.J THEN {alpha} / N ELSE 0 END AS G
       FROM cells c JOIN sds a ON c.T = a.T AND c.I = a.I LEFT JOIN sds b ON c.T = b.T AND c.J = b.I)""",
            f"""gj AS (SELECT T, 0 AS P, I, J, G FROM std
  UNION ALL
  SELECT T, P + 1, I, J, CASE WHEN I = P THEN G / D ELSE G - A * C / D END FROM (
    SELECT *, max(G) FILTER (J = P) OVER (PARTITION BY T, I) AS A, max(G) FILTER (I = P) OVER (PARTITION BY T, J) AS C,
           max(G) FILTER (I = P AND J = P) OVER (PARTITION BY T) AS D FROM gj) WHERE P < {p} AND J > P)""",
            f"""betas AS (SELECT j.T, {', '.join(f'coalesce({b}, 0) AS B_{c}' for b, c in zip(beta, FEATS))},
         {', '.join(get(lambda i, c: f'max(SD) FILTER (I = {i}) AS SD_{c}'))}
       FROM gj j JOIN sds USING (T, I) WHERE P = {p} AND J = {p} GROUP BY j.T)""",
            f"""coefs AS (SELECT STATION_ID, N AS N_TRAIN, S_Y / N - ({' + '.join(f'B_{c} * (S_{c} / N)' for c in FEATS)}) AS INTERCEPT,
         {', '.join(f'B_{c}, S_{c} / N AS MEAN_{c}, SD_{c}' for c in FEATS)} FROM gram g JOIN betas b ON g.STATION_ID = b.T)""",
            f"""hist AS (SELECT f.*, INTERCEPT + {' + '.join(f'B_{c} * CAST({c} AS DOUBLE)' for c in FEATS)} AS PRED,
         {', '.join(f'abs(B_{c} * (CAST({c} AS DOUBLE) - MEAN_{c})) AS A_{c}' for c in FEATS)}
       FROM features f JOIN coefs USING (STATION_ID))""",
            f"""expl AS (SELECT STATION_ID, DATE, {', '.join(
                f"CAST(round(CASE WHEN {' + '.join(f'A_{c}' for c in FEATS)} > 0 THEN A_{x} / ({' + '.join(f'A_{c}' for c in FEATS)}) ELSE 0 END, 2) AS DECIMAL(10,2)) AS EXPL_{x}" for x in FEATS)}
       FROM hist)"""]


def _with_coefs(sql: str) -> str:
    return "WITH RECURSIVE" + with_ctes(*BASE, *features_ctes(), SPLIT_SQL, *_coefs_ctes())[4:] + sql


_FEATURE_COLS = f"STATION_ID, DATE, \"COUNT\", {', '.join(FEATS)}"
_COEF_COLS = ["INTERCEPT", *[f"{x}_{c}" for c in FEATS for x in ("B", "MEAN", "SD")]]


LAGS = [int(c[4:]) for c in FEATS if c.startswith("LAG_")]


def _forecast_ctes(steps: int = 30) -> list[str]:
    """Day by day from the last feature row: lags from the counts so far, the prediction appended."""
    lag = {f"LAG_{k}": f"ARR[-{k}]" for k in LAGS}
    total = " + ".join(f"B_{c} * {lag.get(c, f'CAST(w.{c} AS DOUBLE)' if c != 'HOLIDAY' else 'HOLIDAY_')}" for c in FEATS)
    parts = [f"abs(B_{c} * (CAST({c} AS DOUBLE) - MEAN_{c}))" for c in FEATS]
    share = lambda p: f"CAST(round(CASE WHEN {' + '.join(parts)} > 0 THEN {p} / ({' + '.join(parts)}) ELSE 0 END, 2) AS DECIMAL(10,2))"
    return [f"""fc AS (
  SELECT STATION_ID, 0 AS H, max(DATE) AS DATE, list(CAST("COUNT" AS DOUBLE) ORDER BY DATE) AS ARR,
         {', '.join(f'CAST(NULL AS DOUBLE) AS {c}' for c in [*FEATS, 'PRED'])} FROM features GROUP BY STATION_ID
  UNION ALL
  SELECT STATION_ID, H + 1, D, list_append(ARR, P), {', '.join(lag.values())}, HOLIDAY_, PRECIP_, TEMP_, P FROM (
    SELECT f.STATION_ID, f.H, f.ARR, f.D, HOLIDAY_, CAST(w.PRECIP AS DOUBLE) AS PRECIP_, CAST(w.TEMP AS DOUBLE) AS TEMP_,
           round_even(INTERCEPT + {total}, 0) AS P
    FROM (SELECT x.*, x.DATE + 1 AS D FROM fc x WHERE H < {steps + 1}) f JOIN coefs c ON f.STATION_ID = c.STATION_ID
    LEFT JOIN (SELECT w.*, CAST(coalesce(h.HOLIDAY, 0) AS DOUBLE) AS HOLIDAY_ FROM weather w LEFT JOIN holidays h ON w.DATE = h.DATE) w ON w.DATE = f.D))""",
            f"""flat AS (SELECT f.STATION_ID, DATE, CAST(PRED AS BIGINT) AS "COUNT", {', '.join(f'CAST(LAG_{k} AS BIGINT) AS LAG_{k}' for k in LAGS)},
  CAST(HOLIDAY AS INTEGER) AS HOLIDAY, CAST(PRECIP AS DECIMAL(10,2)) AS PRECIP, CAST(TEMP AS DECIMAL(10,2)) AS TEMP, CAST(PRED AS DECIMAL(10,2)) AS PRED,
  {', '.join(f'{share(p)} AS EXPL_{c}' for c, p in zip(FEATS, parts))}
  FROM fc f JOIN coefs c ON f.STATION_ID = c.STATION_ID WHERE H > 0)"""]


def _with_forecast(sql: str) -> str:
    return "WITH RECURSIVE" + with_ctes(*BASE, *features_ctes(), SPLIT_SQL, *_coefs_ctes(), *_forecast_ctes())[4:] + sql


def run_eval_sql(run_date: str, where: str, min_days: int) -> str:
    """flat_EVAL of one run over the orders ``where``: fit, predict, score."""
    trips = BASE[0][:-1] + f" WHERE {where})"
    flat = 'flat AS (SELECT STATION_ID, CAST("COUNT" AS DOUBLE) AS Y, CAST(CAST(PRED AS DECIMAL(10,2)) AS DOUBLE) AS P FROM hist)'
    ctes = with_ctes(trips, *BASE[1:], *features_ctes(min_days=min_days), SPLIT_SQL, *_coefs_ctes(), flat)[4:]
    return f"""SELECT DATE '{run_date}' AS RUN_DATE, STATION_ID, {', '.join(f'CAST({m} AS DECIMAL(10,2)) AS {m}' for m in EV.METRICS[:-1])}
FROM (WITH RECURSIVE{ctes}{_eval_sql("flat", "Y", "P")})"""


@register("train_per_station", _with_coefs(f"SELECT STATION_ID, N_TRAIN, {', '.join(f'round({c}, 6) AS {c}' for c in _COEF_COLS)} FROM coefs"))
def train_per_station(spark, sf_dir):
    t = M.train_per_station(_features(spark, sf_dir))
    return t.withColumns({c: F.round(c, 6) for c in _COEF_COLS})


@register("predict_history", _with_coefs(f"SELECT {_FEATURE_COLS}, round(PRED, 6) AS PRED FROM hist"))
def predict_history(spark, sf_dir):
    f = _features(spark, sf_dir)
    return M.predict_history(f, M.train_per_station(f)).withColumn("PRED", F.round("PRED", 6))


@register("forecast_recursive", _with_forecast(f"""SELECT STATION_ID, DATE, CAST(PRED AS BIGINT) AS "COUNT",
  {', '.join(f'CAST(LAG_{k} AS BIGINT) AS LAG_{k}' for k in LAGS)}, CAST(HOLIDAY AS INTEGER) AS HOLIDAY, PRECIP, TEMP, PRED FROM fc WHERE H > 0"""))
def forecast_recursive(spark, sf_dir):
    f = _features(spark, sf_dir)
    return M.forecast_recursive(f, M.train_per_station(f), _calendar(spark, sf_dir))


@register("explain_rows", _with_coefs(f"SELECT {_FEATURE_COLS}, round(PRED, 6) AS PRED, expl.* EXCLUDE (STATION_ID, DATE) FROM hist JOIN expl USING (STATION_ID, DATE)"))
def explain_rows(spark, sf_dir):
    f = _features(spark, sf_dir)
    coefs = M.train_per_station(f)
    return M.explain_rows(M.predict_history(f, coefs), coefs).withColumn("PRED", F.round("PRED", 6))


@register("feature_importance", _with_coefs("SELECT STATION_ID, " + ", ".join(
    f"round(avg(CAST(EXPL_{c} AS DOUBLE)), 4) AS IMP_{c}" for c in FEATS) + " FROM expl GROUP BY STATION_ID"))
def feature_importance(spark, sf_dir):
    f = _features(spark, sf_dir)
    coefs = M.train_per_station(f)
    return M.feature_importance(M.explain_rows(f, coefs))


# ------------------------------------------------------------ H15 - H17

def _eval_sql(src, y, p, digits=6, with_pearson=True):
    e = f"({y} - {p})"
    cols = [
        f"round(avg(abs({e})), {digits}) AS mae",
        f"round(avg(abs({e}) / greatest(abs({y}), 2.220446049250313e-16)), {digits}) AS mape",
        f"round(avg({e} * {e}), {digits}) AS mse",
        f"round(CASE WHEN var_pop({y}) > 0 THEN 1 - avg({e} * {e}) / var_pop({y}) END, {digits}) AS r_squared",
        f"round(sqrt(avg({e} * {e})), {digits}) AS rmse",
        f"round(100.0 * avg(CASE WHEN abs({y}) + abs({p}) > 0 THEN 2 * abs({e}) / (abs({y}) + abs({p})) "
        f"ELSE 0.0 END), {digits}) AS smape",
    ]
    if with_pearson:
        cols.append(f"round(corr({y}, {p}), {digits}) AS pearson_correlation")
    return f"SELECT STATION_ID, {', '.join(cols)} FROM {src} GROUP BY STATION_ID"


@register("evaluate_models", with_ctes(PREDS) + _eval_sql("preds", "y_true", "y_score"))
def evaluate_models(spark, sf_dir):
    return EV.evaluate_models(fx.preds(spark, sf_dir), "y_true", "y_score")


@register("regression_mse", with_ctes(PREDS) +
          "SELECT round(avg((y_true - y_score) * (y_true - y_score)), 6) AS mse FROM preds")
def regression_mse(spark, sf_dir):
    return EV.regression_mse(fx.preds(spark, sf_dir), "y_true", "y_score")


def _naive_pred_rows(spark, sf_dir):
    """Feature rows scored by a seasonal-naive PRED = LAG_7 with 0/1 explanations."""
    f = _features(spark, sf_dir)
    dec = "decimal(10,2)"
    one = F.when(F.col("LAG_1") >= F.col("LAG_7"), 1).otherwise(0)
    cols = {"PRED": F.col("LAG_7").cast("double"),
            "EXPL_LAG_1": one.cast(dec), "EXPL_LAG_7": (F.lit(1) - one).cast(dec)}
    for feat in FEATS:
        cols.setdefault(f"EXPL_{feat}", F.lit(0).cast(dec))
    return f.withColumns(cols)


FLAT_COLS = ["DATE", '"COUNT"', "LAG_1", "LAG_7", "LAG_90", "LAG_365"]


@register("flatten_predictions", with_ctes(*BASE, *features_ctes()) + """
SELECT STATION_ID, DATE, CAST("COUNT" AS BIGINT) AS "COUNT",
       CAST(LAG_1 AS BIGINT) AS LAG_1, CAST(LAG_7 AS BIGINT) AS LAG_7,
       CAST(LAG_90 AS BIGINT) AS LAG_90, CAST(LAG_365 AS BIGINT) AS LAG_365,
       CAST(HOLIDAY AS INTEGER) AS HOLIDAY, PRECIP, TEMP, CAST(LAG_7 AS DECIMAL(10,2)) AS PRED,
       CAST(CASE WHEN LAG_1 >= LAG_7 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS EXPL_LAG_1,
       CAST(CASE WHEN LAG_1 >= LAG_7 THEN 0 ELSE 1 END AS DECIMAL(10,2)) AS EXPL_LAG_7,
       CAST(0 AS DECIMAL(10,2)) AS EXPL_LAG_90, CAST(0 AS DECIMAL(10,2)) AS EXPL_LAG_365,
       CAST(0 AS DECIMAL(10,2)) AS EXPL_HOLIDAY, CAST(0 AS DECIMAL(10,2)) AS EXPL_PRECIP,
       CAST(0 AS DECIMAL(10,2)) AS EXPL_TEMP
FROM features""")
def flatten_predictions(spark, sf_dir):
    rows = _naive_pred_rows(spark, sf_dir)
    hist = H.time_split(rows).filter(~F.col("IS_VALID")).drop("IS_VALID")
    last = H.time_split(rows).filter(F.col("IS_VALID")).drop("IS_VALID")
    packed = EV.pack_predictions(hist, last)
    return EV.flatten_predictions(packed, 0).unionByName(EV.flatten_predictions(packed, 1))


@register("flatten_eval", with_ctes(PREDS) + """
SELECT DATE '2001-09-01' AS RUN_DATE, STATION_ID,
       CAST(mae AS DECIMAL(10,2)) AS mae, CAST(mape AS DECIMAL(10,2)) AS mape,
       CAST(mse AS DECIMAL(10,2)) AS mse, CAST(r_squared AS DECIMAL(10,2)) AS r_squared,
       CAST(rmse AS DECIMAL(10,2)) AS rmse, CAST(smape AS DECIMAL(10,2)) AS smape
FROM (""" + _eval_sql("preds", "y_true", "y_score") + ")")
def flatten_eval(spark, sf_dir):
    scores = EV.evaluate_models(fx.preds(spark, sf_dir), "y_true", "y_score")
    return EV.flatten_eval(EV.pack_eval(scores, "2001_09_01"))


@register("flat_forecast", _with_forecast("SELECT * FROM flat"))
def flat_forecast(spark, sf_dir):
    """The model path to flat_FORECAST: train, forecast, explain, flatten.  Only where PRED is
    written are the rows packed."""
    f = cut_lineage(_features(spark, sf_dir))
    coefs = cut_lineage(M.train_per_station(f))
    # the kept stations all end on the last trip date (E4), so the calendar
    # starts from the checkpointed features instead of another trips scan
    cal = H.forecast_calendar_from(f.select(F.max("DATE")), fx.holidays(spark, sf_dir), fx.weather(spark, sf_dir))
    fut = M.explain_rows(M.forecast_recursive(f, coefs, cal), coefs)
    return EV.flat_rows(fut)


# ------------------------------------------------------------ I1 - I3

@register("udtf_partitioned", with_ctes(LDAILY) + """
SELECT STATION_ID, count(*) AS N_DAYS, min(DATE) AS FIRST_DATE, max(DATE) AS LAST_DATE,
       CAST(sum("COUNT") AS BIGINT) AS TOTAL, max("COUNT") AS PEAK FROM ldaily GROUP BY STATION_ID""")
def udtf_partitioned(spark, sf_dir):
    return U.series_summary(spark, dense_daily(spark, sf_dir))


@register("udf_scalar_json", with_ctes(PREDS_DAILY) + _eval_sql("pdaily", "y_true", "y_score"))
def udf_scalar_json(spark, sf_dir):
    li = fx.load(spark, sf_dir, "lineitem")
    daily = li.groupBy(F.col("l_returnflag").alias("STATION_ID"), F.to_date("l_shipdate").alias("DATE")).agg(
        F.sum("l_quantity").alias("y_true"),
        F.sum(F.col("l_quantity") * (F.lit(1.0) + F.col("l_discount") - F.lit(0.05))).alias("y_score"))
    from ..functions.columns import records_json
    docs = daily.groupBy("STATION_ID").agg(records_json("y_true", "y_score", order_by="DATE").alias("DOC"))
    scored = U.score_documents(spark, docs, "DOC", "y_true", "y_score")
    schema = "ARRAY<STRUCT<" + ", ".join(f"{m}: DOUBLE" for m in EV.METRICS) + ">>"
    flat = scored.select("STATION_ID", F.inline(F.from_json("EVAL_DATA", schema)))
    return flat.select("STATION_ID", *[F.round(m, 6).alias(m) for m in EV.METRICS])


@register("eval_driver_loop", with_ctes(PREDS) + _eval_sql("preds", "y_true", "y_score", with_pearson=False))
def eval_driver_loop(spark, sf_dir):
    """Scores written to a table in one set-based job, read back (pearson dropped)."""
    path = scratch_path(spark, "eval_table")
    name = "velocast_eval_" + path.rsplit("/", 1)[-1]
    U.evaluate_to_table(fx.preds(spark, sf_dir), "y_true", "y_score", name, path)
    return spark.table(name)
