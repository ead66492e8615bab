"""Whole runs on one SparkSession.

Every step reads tables written by the step before (the reference's task
boundaries), so a lost executor only re-runs the current step, and lineage
never grows across steps.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig
from ..functions.calendar import holidays_for_range
from ..operators import boost as B
from ..operators import evaluate as EV
from ..operators import features as H
from ..operators import model as M
from ..operators import relational as R
from ..session import cut_lineage
from ..sources import catalog as A
from ..streaming import changes as J
from . import ingest as K


def fit_and_explain(spark: SparkSession, cfg: RunConfig, features: DataFrame, calendar: DataFrame) -> tuple[DataFrame, DataFrame]:
    """H10-H13 with the run's learner: the models become a table; explained history and forecast."""
    if cfg.learner == "ridge":
        A.write_overwrite(M.train_per_station(features, cfg.lags, cfg.cutpoint, cfg.alpha), cfg.coefficients)
        model = spark.table(cfg.coefficients)
        past, future = M.predict_history(features, model, cfg.lags), M.forecast_recursive(features, model, calendar, cfg.lags, cfg.steps)
        return M.explain_rows(past, model, cfg.lags), M.explain_rows(future, model, cfg.lags)
    if cfg.learner != "trees":
        raise ValueError("learner must be ridge or trees")
    p = cfg.extra.get("trees", B.Boost())
    A.write_overwrite(B.train_trees(features, cfg.lags, cfg.cutpoint, p), cfg.coefficients)
    model = spark.table(cfg.coefficients)
    past = B.predict_trees(features, model, cfg.lags, p)
    future = cut_lineage(B.forecast_trees(features, model, calendar, cfg.lags, cfg.steps, p))
    return B.explain_trees(past, model, cfg.lags, p), B.explain_trees(future, model, cfg.lags, p)


def model_steps(spark: SparkSession, cfg: RunConfig, weather_source: DataFrame, run_date: str) -> dict:
    """Holidays -> weather -> features -> forecast -> train -> predict/explain ->
    evaluate -> flatten, every table tagged with the run's model_id."""
    model_id = cfg.model_id or f"model_{run_date}"
    tag = {"model_id": model_id}
    snap = f"{cfg.trips}_{model_id}"
    A.snapshot_table(spark, cfg.trips, snap)                                   # A14
    A.tag_lineage(spark, snap, tag)                                            # A15
    # D1 for the snapshot: summed per-load daily counts when TRIPS is a load
    # view (no trip is read again), else aggregated from the trips
    daily = K.daily_of(spark, snap)
    if daily is None:
        daily = R.daily_counts(spark.table(snap))
    bounds = daily.agg(F.make_date(F.year(F.min("DATE")), F.lit(1), F.lit(1)).alias("START"),
                       # through the forecast's last day, which may lie in the next year
                       F.make_date(F.year(F.date_add(F.max("DATE"), cfg.steps + 1)), F.lit(12), F.lit(31)).alias("END"))

    A.write_overwrite(holidays_for_range(bounds), cfg.holidays)                 # H1
    A.create_view(H.weather_daily(weather_source, cfg.postcode), cfg.weather)  # H2 + A12
    holidays, weather = spark.table(cfg.holidays), spark.table(cfg.weather)

    A.write_overwrite(H.feature_table_daily(daily, holidays, weather, cfg.lags, cfg.min_days), cfg.features)
    A.write_overwrite(H.forecast_calendar_from(daily.select(F.max("DATE")), holidays, weather, cfg.steps),
                      cfg.forecast)
    features, calendar = spark.table(cfg.features), spark.table(cfg.forecast)

    hist, fut = fit_and_explain(spark, cfg, features, calendar)
    A.write_overwrite(EV.pack_predictions(hist, fut, cfg.lags), cfg.pred)
    pred = spark.table(cfg.pred)

    A.write_overwrite(EV.flatten_predictions(pred, 0, cfg.lags), cfg.flat_pred)     # H17
    A.write_overwrite(EV.flatten_predictions(pred, 1, cfg.lags), cfg.flat_forecast)
    scored = EV.evaluate_models(spark.table(cfg.flat_pred), "COUNT", "PRED")         # H15
    A.write_overwrite(EV.pack_eval(scored, run_date), cfg.eval)
    new_eval = EV.flatten_eval(spark.table(cfg.eval))
    if spark.catalog.tableExists(cfg.flat_eval):
        # one row per (RUN_DATE, STATION_ID): re-running a run date replaces it
        old = spark.table(cfg.flat_eval).join(new_eval.select("RUN_DATE", "STATION_ID"),
                                              ["RUN_DATE", "STATION_ID"], "left_anti")
        A.write_overwrite(old.unionByName(new_eval).checkpoint(eager=True), cfg.flat_eval)
    else:
        A.write_append(new_eval, cfg.flat_eval)                                      # A10
    for t in (cfg.features, cfg.forecast, cfg.coefficients, cfg.pred, cfg.eval,
              cfg.flat_pred, cfg.flat_forecast):
        A.tag_lineage(spark, t, tag)
    return {"model_id": model_id, "flat_pred": cfg.flat_pred, "flat_forecast": cfg.flat_forecast,
            "flat_eval": cfg.flat_eval}


def setup_run(spark: SparkSession, cfg: RunConfig, landed: DataFrame, weather_source: DataFrame,
              run_date: str, location: str | None = None, bulk: bool = True) -> dict:
    """K4: reset -> bulk load -> holidays -> weather -> features -> forecast ->
    train -> evaluate -> flatten, under one model_id."""
    A.reset_database(spark, cfg.database, {cfg.raw("schema1"): K.SCHEMA1, cfg.raw("schema2"): K.SCHEMA2},
                     location)                                                         # A16
    spark.catalog.setCurrentDatabase(cfg.database)
    if bulk:
        K.bulk_elt(spark, cfg, landed)                                                 # K3
    else:
        K.incremental_elt(spark, cfg, landed)                                          # K2
    return model_steps(spark, replace(cfg, model_id=cfg.model_id or f"setup_{run_date}"), weather_source,
                       run_date)


def monthly_run(spark: SparkSession, cfg: RunConfig, landed: DataFrame, weather_source: DataFrame,
                run_date: str) -> dict:
    """K5: incremental load of new files, then the model steps under a new model_id."""
    spark.catalog.setCurrentDatabase(cfg.database)
    K.incremental_elt(spark, cfg, landed)
    return model_steps(spark, replace(cfg, model_id=cfg.model_id or f"monthly_{run_date}"), weather_source, run_date)


def cdc_elt(spark: SparkSession, cfg: RunConfig, landed: DataFrame, changes_dirs: dict[str, str],
            root: str, keys: dict[str, list[str]] | None = None) -> str:
    """Files -> raw tables -> change streams merged into interim tables -> TRIPS.

    The interim tables start from the raw rows (the stream's initial rows),
    each version's change files are merged by J3, and TRIPS is rebuilt from
    the interim states.
    """
    keys = keys or {"schema1": ["BIKEID", "STARTTIME", "STOPTIME"], "schema2": ["ride_id"]}
    A.reset_database(spark, cfg.database, {cfg.raw("schema1"): K.SCHEMA1, cfg.raw("schema2"): K.SCHEMA2})
    spark.catalog.setCurrentDatabase(cfg.database)
    routed = K.A.route_files(landed, "NAME")
    for version, schema in K.SCHEMAS.items():
        files = [r["PATH"] for r in routed.filter(F.col("VERSION") == version).select("PATH").collect()]
        K.A.append_files_to_raw(spark, files, schema, cfg.raw(version))
    interim = {}
    for version in K.SCHEMAS:
        target = f"{cfg.database}.interim_{version}"
        J.init_target(spark.table(cfg.raw(version)), target, keys[version], path=f"{root}/interim_{version}")
        if version in changes_dirs:
            schema = spark.read.parquet(changes_dirs[version]).schema
            q = J.stream_merge(spark, changes_dirs[version], schema, target, checkpoint=f"{root}/_checkpoints/{version}")
            q.awaitTermination()
        interim[version] = J.current_state(spark, target)
    trips = K.transform_trips(interim["schema1"], interim["schema2"])
    K.write_trips(spark, cfg, rows=trips)
    return cfg.trips
