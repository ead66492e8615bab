"""Run configuration: table names and model parameters in one place."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed values the results depend on (they equal the reference's choices).
LAGS = (1, 7, 90, 365)
MIN_DAYS = 365 * 2
FORECAST_STEPS = 30
CUTPOINT = 365
WEATHER_POSTCODE = "10007"
SCHEMA2_FIRST_MONTH = "202102"
TARGET = "COUNT"
EXOGENOUS = ("HOLIDAY", "PRECIP", "TEMP")
HOLIDAY_START = "2013-01-01"
HOLIDAY_DAYS = 365 * 20


def feature_names(lags=LAGS) -> list[str]:
    return [f"LAG_{k}" for k in lags] + list(EXOGENOUS)


@dataclass(frozen=True)
class RunConfig:
    database: str = "velocast"
    raw_prefix: str = "RAW_"
    trips: str = "TRIPS"
    holidays: str = "HOLIDAYS"
    weather: str = "WEATHER"
    features: str = "FEATURES"
    forecast: str = "FORECAST"
    coefficients: str = "COEFFICIENTS"
    pred: str = "PRED"
    eval: str = "EVAL"
    flat_pred: str = "flat_PRED"
    flat_forecast: str = "flat_FORECAST"
    flat_eval: str = "flat_EVAL"
    lags: tuple = LAGS
    min_days: int = MIN_DAYS
    steps: int = FORECAST_STEPS
    cutpoint: int = CUTPOINT
    alpha: float = 1.0
    learner: str = "ridge"      # or "trees"
    postcode: str = WEATHER_POSTCODE
    model_id: str | None = None
    extra: dict = field(default_factory=dict)

    def raw(self, version: str) -> str:
        return f"{self.raw_prefix}{version}"

    def with_model(self, model_id: str) -> "RunConfig":
        return replace(self, model_id=model_id)
