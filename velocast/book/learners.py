"""Registered queries for the boosted trees (H10-H14), the maximum-likelihood baselines (H8),
the augmented unit-root test (H7), the polymorphic table function (I1) and VARIANT documents (G16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..config import feature_names
from ..functions.calendar import holidays_for_range
from ..operators import arima as AR
from ..operators import boost as B
from ..operators import documents as D
from ..operators import evaluate as EV
from ..operators import features as H
from ..operators import polymorphic as PM
from ..operators import unitroot as U
from ..session import cut_lineage, scratch_path
from . import BASE, ORACLE, WEATHER_SOURCE, features_ctes, register, with_ctes
from .model import LDAILY, SPLIT_SQL, _naive_pred_rows, dense_daily

FEATS = feature_names()

# ------------------------------------------------------------ H10 - H14: trees

SHIP_TRIPS = """trips AS (
  SELECT l_shipdate AS STARTTIME, l_shipdate AS STOPTIME, 'L' || l_linenumber AS START_STATION_NAME,
         'L' || l_linenumber AS START_STATION_ID, l_linestatus AS USERTYPE FROM lineitem)"""

SHIP_BASE = [SHIP_TRIPS, *BASE[1:]]


def _ship(spark, sf_dir):
    """(features, holidays, forecast weather) of the fleet whose stations are line numbers.  Its
    trips end with the weather, so the forecast weather is that of 52 weeks before."""
    trips, weather = fx.ship_trips(spark, sf_dir), fx.weather(spark, sf_dir)
    holidays = holidays_for_range(fx.trip_year_bounds(trips))
    return cut_lineage(H.feature_table(trips, holidays, weather)), holidays, weather.withColumn("DATE", F.date_add("DATE", 364))


def _level_sql(bins: int = B.Boost.bins, least: int = B.Boost.min_rows) -> str:
    cells = "\n  UNION ALL ".join(
        f'SELECT STATION_ID, {k} AS K, CAST({f} AS DOUBLE) AS X, CAST("COUNT" AS DOUBLE) AS Y FROM split WHERE NOT IS_VALID'
        for k, f in enumerate(FEATS))
    return with_ctes(*SHIP_BASE, *features_ctes(), SPLIT_SQL, f"cells AS ({cells})", f"""
binned AS (SELECT *, floor({bins} * (rank() OVER (PARTITION BY STATION_ID, K ORDER BY X) - 1) / count(*) OVER (PARTITION BY STATION_ID, K)) AS B,
             CAST(round((Y - avg(Y) OVER (PARTITION BY STATION_ID, K)) * 1000000) AS BIGINT) AS R FROM cells)""", """
hist AS (SELECT STATION_ID, K, B, count(*) AS N, sum(R) / 1000000.0 AS S, max(X) AS CUT, sum(sum(R)) OVER w / 1000000.0 AS SL,
           sum(count(*)) OVER w AS NL, sum(sum(R)) OVER (PARTITION BY STATION_ID, K) / 1000000.0 AS ST,
           sum(count(*)) OVER (PARTITION BY STATION_ID, K) AS NT
         FROM binned GROUP BY STATION_ID, K, B WINDOW w AS (PARTITION BY STATION_ID, K ORDER BY B ROWS UNBOUNDED PRECEDING))""", f"""
gains AS (SELECT *, SL * SL / NL + (ST - SL) * (ST - SL) / (NT - NL) - ST * ST / NT AS GAIN FROM hist
          WHERE NL >= {least} AND NT - NL >= {least})""") + """
SELECT STATION_ID, CAST(1 AS INTEGER) AS NODE, CAST(K AS INTEGER) AS K, CUT, round(GAIN, 4) AS GAIN FROM gains WHERE GAIN > 1e-6
QUALIFY row_number() OVER (PARTITION BY STATION_ID ORDER BY round(GAIN, 6) DESC, K, B) = 1"""


@register("tree_level", _level_sql())
def tree_level(spark, sf_dir):
    """The first level of the first tree, every station's best split."""
    f, _, _ = _ship(spark, sf_dir)
    best = B.best_splits(B.histogram(B.start(B.binned(f))), B.Boost().min_rows)
    return best.withColumn("GAIN", F.round("GAIN", 4))


#: Few, strong trees: the fleet's signal is one feature and a season.
FLEET = B.Boost(trees=4, rate=0.5, patience=2)


@register("train_trees")
def train_trees(spark, sf_dir):
    return B.train_trees(_ship(spark, sf_dir)[0], p=FLEET)


@register("explain_trees")
def explain_trees(spark, sf_dir):
    """In-sample predictions with their Shapley values, which add up to them."""
    f, _, _ = _ship(spark, sf_dir)
    model = cut_lineage(B.train_trees(f, p=FLEET))
    return B.predict_trees(f, model).join(B.shapley(f, model), ["STATION_ID", "DATE"])


@register("forecast_trees")
def forecast_trees(spark, sf_dir):
    """H10-H17 with trees: train, forecast, explain, pack, flatten."""
    f, holidays, weather = _ship(spark, sf_dir)
    model = cut_lineage(B.train_trees(f, p=FLEET))
    calendar = H.forecast_calendar_from(f.select(F.max("DATE")), holidays, weather)
    hist = B.explain_trees(B.predict_trees(f, model), model)
    fut = B.explain_trees(cut_lineage(B.forecast_trees(f, model, calendar)), model)
    return EV.flatten_predictions(EV.pack_predictions(hist, fut), 1)


# ------------------------------------------------------------ H8: maximum likelihood

@register("arima_fit")
def arima_fit(spark, sf_dir):
    return AR.arima_fit(dense_daily(spark, sf_dir))


@register("arima_series")
def arima_series(spark, sf_dir):
    return AR.arima_series(dense_daily(spark, sf_dir))


# ------------------------------------------------------------ H7: augmented test

def _eliminate(name: str, gram: str) -> str:
    """Recursive elimination of ``gram`` (T, I, J, G; K the last column): a row of pivots each step."""
    return f"""{name} AS (
  SELECT T, K, 0 AS P, I, J, G FROM {gram}
  UNION ALL
  SELECT T, K, P + 1, I, J, G - A * C / D FROM (
    SELECT *, max(G) FILTER (J = P) OVER (PARTITION BY T, I) AS A, max(G) FILTER (I = P) OVER (PARTITION BY T, J) AS C,
           max(G) FILTER (I = P AND J = P) OVER (PARTITION BY T) AS D FROM {name}) WHERE P < K AND I > P AND J > P)"""


def _unit_root_sql() -> str:
    normal = ("0.5 + 0.3989422804014327 * Q * list_sum([CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END * "
              "exp(k * ln(greatest(Q * Q / 2, 1e-300)) - lgamma(k + 1)) / (2 * k + 1) for k in range(90)])")
    low = " + ".join(f"({c}) * pow(ADF_T, {i})" for i, c in enumerate(U.BELOW))
    high = " + ".join(f"({c}) * pow(ADF_T, {i})" for i, c in enumerate(U.ABOVE))
    return "WITH RECURSIVE " + ",\n".join([LDAILY, """
s0 AS (SELECT 'LEVEL' AS SERIES, STATION_ID, DATE, CAST("COUNT" AS DOUBLE) AS Y FROM ldaily
  UNION ALL SELECT * FROM (SELECT 'CHANGE', STATION_ID, DATE, ("COUNT" - lag("COUNT", 7) OVER (PARTITION BY STATION_ID ORDER BY DATE)) / 7 AS Y
                           FROM ldaily) WHERE Y IS NOT NULL)""", f"""
s AS (SELECT *, SERIES || ' ' || STATION_ID AS T, row_number() OVER w AS RN, lag(Y) OVER w AS L, Y - lag(Y) OVER w AS D,
        {U.most_lags("count(*) OVER (PARTITION BY SERIES, STATION_ID)")} AS P FROM s0 WINDOW w AS (PARTITION BY SERIES, STATION_ID ORDER BY DATE))""", """
x AS MATERIALIZED (SELECT T, RN, P, 0 AS I, 1.0 AS V FROM s WHERE RN >= 2
  UNION ALL SELECT T, RN, P, 1, L FROM s WHERE RN >= 2
  UNION ALL SELECT a.T, a.RN, a.P, CAST(a.RN - b.RN + 1 AS INTEGER), b.D FROM s a JOIN s b ON a.T = b.T AND b.RN BETWEEN a.RN - a.P AND a.RN - 1 WHERE b.RN >= 2
  UNION ALL SELECT T, RN, P, P + 2, D FROM s WHERE RN >= 2)""", """
g1 AS MATERIALIZED (SELECT a.T, a.P + 2 AS K, a.I, b.I AS J, sum(a.V * b.V) AS G FROM x a JOIN x b ON a.T = b.T AND a.RN = b.RN
  WHERE a.RN >= a.P + 2 GROUP BY ALL)""", _eliminate("e1", "g1"), """
r1 AS (SELECT T, K, P, max(G) FILTER (I = K AND J = K) AS RSS FROM e1 GROUP BY ALL)""", """
o AS (SELECT r.T, arg_min(r.P - 2, (round(g.G * (ln(2 * pi() * r.RSS / g.G) + 1) + 2 * r.P, 9), r.P)) AS U
  FROM r1 r JOIN g1 g ON r.T = g.T AND g.I = 0 AND g.J = 0 WHERE r.P >= 2 GROUP BY r.T)""", """
y AS MATERIALIZED (SELECT x.T, x.RN, o.U, CASE WHEN I = 0 THEN 0 WHEN I = 1 THEN U + 1 WHEN I = P + 2 THEN U + 2 ELSE I - 1 END AS I, V
  FROM x JOIN o ON x.T = o.T WHERE RN >= U + 2 AND (I <= U + 1 OR I = P + 2))""", """
g2 AS MATERIALIZED (SELECT a.T, a.U + 2 AS K, a.I, b.I AS J, sum(a.V * b.V) AS G FROM y a JOIN y b ON a.T = b.T AND a.RN = b.RN GROUP BY ALL)""",
        _eliminate("e2", "g2"), """
f AS (SELECT e.T, e.K - 2 AS U, n.G AS N, max(e.G) FILTER (P = e.K - 1 AND e.I = e.K - 1 AND e.J = e.K) AS C, max(e.G) FILTER (P = e.K - 1 AND e.I = e.K - 1 AND e.J = e.K - 1) AS D,
        max(e.G) FILTER (P = e.K) AS RSS FROM e2 e JOIN g2 n ON e.T = n.T AND n.I = 0 AND n.J = 0 GROUP BY ALL)""", """
t AS (SELECT *, C / D / sqrt(RSS / (N - U - 2) / D) AS ADF_T FROM f)""", f"""
q AS (SELECT *, CASE WHEN ADF_T <= {U.STAR} THEN {low} ELSE {high} END AS Q FROM t)"""]) + f"""
SELECT split_part(T, ' ', 1) AS SERIES, split_part(T, ' ', 2) AS STATION_ID, CAST(U AS INTEGER) AS USED_LAG, CAST(N AS BIGINT) AS N_OBS,
       round(ADF_T, 6) AS ADF_T, round(CASE WHEN ADF_T > {U.HIGH} THEN 1.0 WHEN ADF_T < {U.LOW} OR Q < -4.9 THEN 0.0 ELSE {normal} END, 6) AS P_VALUE FROM q"""


@register("unit_root", _unit_root_sql())
def unit_root(spark, sf_dir):
    """H7 over the series and over the change of its 7-day mean."""
    d = dense_daily(spark, sf_dir)
    level, change = U.unit_root(d), U.unit_root(U.rolling_change(d))
    return level.select(F.lit("LEVEL").alias("SERIES"), "*").unionByName(change.select(F.lit("CHANGE").alias("SERIES"), "*"))


# ------------------------------------------------------------ I1: one table function, two schemas

def _profile_sql(table: str, key: str, order: str, values: list[str]) -> str:
    cols = ", ".join(f"arg_min({c}, {order}) AS FIRST_{c}, arg_max({c}, {order}) AS LAST_{c}, max(abs({c} - P_{c})) AS STEP_{c}" for c in values)
    lags = ", ".join(f"lag({c}) OVER (PARTITION BY {key} ORDER BY {order}) AS P_{c}" for c in values)
    return f"SELECT {key}, count(*) AS N, min({order}) AS FIRST_{order}, max({order}) AS LAST_{order}, {cols} FROM (SELECT *, {lags} FROM {table}) GROUP BY {key}"


@register("profile_daily", with_ctes(LDAILY, 'd AS (SELECT STATION_ID, DATE, CAST("COUNT" AS DOUBLE) AS "COUNT" FROM ldaily)')
          + _profile_sql("d", "STATION_ID", "DATE", ["COUNT"]))
def profile_daily(spark, sf_dir):
    return PM.series_profile(dense_daily(spark, sf_dir), "STATION_ID", "DATE")


@register("profile_weather", with_ctes(WEATHER_SOURCE, """w AS (SELECT POSTAL_CODE, DATE_VALID_STD,
    CAST(TOT_PRECIPITATION_MM AS DOUBLE) AS TOT_PRECIPITATION_MM, CAST(AVG_TEMPERATURE_FEELSLIKE_2M_C AS DOUBLE) AS AVG_TEMPERATURE_FEELSLIKE_2M_C
  FROM weather_source)""") + "SELECT * REPLACE (round(STEP_TOT_PRECIPITATION_MM, 6) AS STEP_TOT_PRECIPITATION_MM, "
          "round(STEP_AVG_TEMPERATURE_FEELSLIKE_2M_C, 6) AS STEP_AVG_TEMPERATURE_FEELSLIKE_2M_C) FROM ("
          + _profile_sql("w", "POSTAL_CODE", "DATE_VALID_STD", ["TOT_PRECIPITATION_MM", "AVG_TEMPERATURE_FEELSLIKE_2M_C"]) + ")")
def profile_weather(spark, sf_dir):
    out = PM.series_profile(fx.weather_source(spark, sf_dir), "POSTAL_CODE", "DATE_VALID_STD")
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.startswith("STEP_")})


# ------------------------------------------------------------ G16, G17, H17: documents as VARIANT

def _variant_table(spark, sf_dir):
    """The PRED documents of the seasonal-naive rows, stored as VARIANT."""
    rows = _naive_pred_rows(spark, sf_dir)
    split = H.time_split(rows)
    packed = D.pack_variant(split.where("NOT IS_VALID").drop("IS_VALID"), split.where("IS_VALID").drop("IS_VALID"))
    path = scratch_path(spark, "variant")
    packed.write.parquet(path)
    return spark.read.parquet(path)


@register("flatten_variant", ORACLE["flatten_predictions"])
def flatten_variant(spark, sf_dir):
    """H17 by VARIANT: the rows of ``flatten_predictions``."""
    pred = _variant_table(spark, sf_dir)
    return D.flatten_variant(pred, 0).unionByName(D.flatten_variant(pred, 1))


@register("document_fields", with_ctes(BASE[0], """kinds AS (
  SELECT o_orderstatus AS STATION_ID, 'key' AS FIELD, 'BIGINT' AS KIND, count(*) AS N_DOCS FROM orders GROUP BY 1
  UNION ALL SELECT o_orderstatus, 'clerk', 'STRING', count(*) FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1
  UNION ALL SELECT o_orderstatus, 'clerk', 'OBJECT<no: BIGINT>', count(*) FROM orders WHERE o_orderkey % 3 = 1 GROUP BY 1)""")
          + "SELECT * FROM kinds")
def document_fields(spark, sf_dir):
    """Documents of an open schema; what fields they have, and of which kind."""
    o = fx.load(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    extra = F.when(key % 3 == 0, F.concat(F.lit(', "clerk": "'), key, F.lit('"'))).when(
        key % 3 == 1, F.concat(F.lit(', "clerk": {"no": '), key, F.lit("}"))).otherwise("")
    docs = o.select(F.col("o_orderstatus").alias("STATION_ID"), F.parse_json(F.concat(F.lit('{"key": '), key, extra, F.lit("}"))).alias("DOC"))
    return D.fields_of(docs)
