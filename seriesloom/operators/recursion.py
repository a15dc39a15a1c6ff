"""Forecasts that feed each prediction back into the features of the next step.

The state of a series is one row: its last few values, newest first, and the
lines of its drivers. A step is a projection over that row, so six steps run in
one pass over the states without a shuffle, a window or a table in between, and
a lost task is redone from the states alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.functions.arithmetic import mean_of
from seriesloom.operators.features import (
    Feature,
    depth_of,
    render,
    render_filled,
    with_numeric_values,
)
from seriesloom.operators.history import last_rows
from seriesloom.operators.model import TrainedModel
from seriesloom.operators.report import finish_forecast
from seriesloom.operators.trend import HORIZON, fit_lines, fitted
from seriesloom.session import written
from seriesloom.spec import PanelSpec

# Plans grow with each step; longer horizons write the states in between.
STEPS_PER_PLAN = 12

# Why a series has no forecast.
TOO_SHORT = "fewer than two periods"
NO_LAGS = "missing values among the last rows"

Predict = Callable[[DataFrame], DataFrame]


def _held(column: str, back: int) -> str:
    return f"{column}_held_{back}"


def series_state(panel: DataFrame, spec: PanelSpec, depth: int) -> DataFrame:
    """One row per series: last period, last values and the drivers' lines.

    A driver without a line is missing ahead, as it may be in training. Series
    with a single row have no state.
    """
    depth = max(depth, 2)
    numeric = with_numeric_values(panel, spec).select(*spec.columns)
    rank = F.col("__rank")
    held = [
        F.max(F.when(rank == back + 1, F.col(v))).alias(_held(v, back))
        for v in spec.variables
        for back in range(depth)
    ]
    ends = last_rows(numeric, spec, depth, "__rank").groupBy(spec.series_key).agg(
        F.max(spec.order_col).alias("last_period"), F.count("*").alias("__rows"), *held
    )
    lines = fit_lines(numeric, spec, spec.drivers)
    several = ends.filter(F.col("__rows") > 1).drop("__rows")
    return several.join(lines, spec.series_key).withColumn(
        "last_actual", F.col(_held(spec.target, 0))
    )


def _value_in_state(spec: PanelSpec) -> Callable[[str, int], Column]:
    def value(column: str, back: int) -> Column:
        if back:
            return F.col(_held(column, back - 1))
        if column == spec.target:
            return F.lit(None).cast("double")
        return F.col(column)

    return value


def recursive_steps(
    panel: DataFrame,
    spec: PanelSpec,
    features: Sequence[Feature],
    predict: Predict,
    horizon: int = HORIZON,
    filled: bool = True,
    steps_per_plan: int = STEPS_PER_PLAN,
) -> DataFrame:
    """Forecast rows with target, drivers and the last actual value of their series.

    ``predict`` adds the column ``prediction`` to rows holding the features. The
    target of a step is unknown when its features are made, so features that
    read it are missing, and 0 when ``filled``. After every ``steps_per_plan``
    steps the states are written to the shared folder.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    depth = max(depth_of(features), 2)
    state = series_state(panel, spec, depth)
    if not filled:
        needed = [_held(f.column, f.rows - 1) for f in features if f.rows]
        state = state.na.drop("any", subset=needed)
    state = state.select("*", F.array().cast(_steps_type(panel, spec)).alias("__steps"))
    step = _Step(spec, features, depth, filled, panel.schema[spec.order_col].dataType)
    for number in range(1, horizon + 1):
        state = step.advance(state, predict)
        if number % steps_per_plan == 0 and number < horizon:
            state = written(state, "states")
    return state.select(spec.series_key, "last_actual", F.inline("__steps")).select(
        *spec.columns, "last_actual"
    )


def _steps_type(panel: DataFrame, spec: PanelSpec) -> str:
    period = panel.schema[spec.order_col].dataType.simpleString()
    values = ", ".join(f"`{v}`: double" for v in spec.variables)
    return f"array<struct<`{spec.order_col}`: {period}, {values}>>"


class _Step:
    """One step of all series; every step uses the same expressions."""

    def __init__(
        self,
        spec: PanelSpec,
        features: Sequence[Feature],
        depth: int,
        filled: bool,
        period_type: T.DataType,
    ):
        period = (F.col("last_period") + 1).cast(period_type)
        make = render_filled if filled else render
        value = cache(_value_in_state(spec))
        self.target = spec.target
        self.opened = {spec.order_col: period}
        self.opened.update({d: fitted(spec, d, period) for d in spec.drivers})
        self.made = {f.name: make(f, spec, value) for f in features if f.kind != "value"}
        shifted = [
            F.col(_held(v, back - 1) if back else v).alias(_held(v, back))
            for v in spec.variables
            for back in range(depth)
        ]
        lines = [f"{d}_{part}" for d in spec.drivers for part in ("slope", "intercept")]
        point = F.struct(spec.order_col, *spec.variables)
        self.closed = [
            F.col(spec.series_key),
            F.col(spec.order_col).alias("last_period"),
            *shifted,
            *[F.col(name) for name in lines],
            F.col("last_actual"),
            F.array_append("__steps", point).alias("__steps"),
        ]

    def advance(self, state: DataFrame, predict: Predict) -> DataFrame:
        predicted = predict(state.withColumns(self.opened).withColumns(self.made))
        return predicted.withColumn(self.target, F.col("prediction")).select(*self.closed)


def recursive_forecast(
    panel: DataFrame, model: TrainedModel | None, horizon: int = HORIZON
) -> DataFrame:
    """The model rolled forward, with band, change and millions."""
    if model is None:
        raise ValueError("the model has not been trained yet")
    spec, choice = model.spec, model.choice
    steps = recursive_steps(
        panel, spec, choice.features(spec), model.predictor(), horizon, choice.filled
    )
    return finish_forecast(steps, spec, model.series_metrics)


def coverage(panel: DataFrame, forecast: DataFrame, spec: PanelSpec) -> DataFrame:
    """Every series of the panel: whether it has a forecast, and if not, why."""
    key = spec.series_key
    rows = panel.groupBy(key).agg(F.count("*").alias("rows"))
    made = forecast.select(key).distinct().withColumn("has_forecast", F.lit(True))
    has = F.coalesce("has_forecast", F.lit(False))
    reason = F.when(F.col("rows") < 2, TOO_SHORT).otherwise(NO_LAGS)
    return rows.join(made, key, "left").select(
        key, "rows", has.alias("has_forecast"), F.when(~has, reason).alias("reason")
    )


def mean_of_lags(spec: PanelSpec, features: Sequence[Feature]) -> Predict:
    """A rule in place of a model: the mean of the target's lags among the features."""
    lags = [F.col(f.name) for f in features if f.kind == "lag" and f.column == spec.target]
    prediction = mean_of(lags)
    return lambda df: df.withColumn("prediction", prediction)
