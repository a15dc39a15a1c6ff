"""Least-squares lines per series, and forecasts along them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.functions.arithmetic import line_at
from seriesloom.operators.history import join_series
from seriesloom.operators.report import with_change, with_millions
from seriesloom.spec import PanelSpec

HORIZON = 6


def _line_aggregates(
    spec: PanelSpec, columns: Sequence[str], where: Column | None = None
) -> dict[str, Column]:
    x = (F.col(spec.order_col) - F.lit(spec.origin)).cast("double")
    if where is not None:
        x = F.when(where, x)
    aggregates = {}
    for c in columns:
        aggregates[f"{c}_slope"] = F.regr_slope(F.col(c), x)
        aggregates[f"{c}_intercept"] = F.regr_intercept(F.col(c), x)
    return aggregates


def _aliased(aggregates: dict[str, Column]) -> list[Column]:
    return [aggregate.alias(name) for name, aggregate in aggregates.items()]


def fit_lines(
    df: DataFrame,
    spec: PanelSpec,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """``{column}_slope`` and ``{column}_intercept`` per series, one grouped aggregate.

    The intercept belongs to ``spec.origin``. Rows with a missing value do not
    count; with fewer than two different periods left, both are null.
    """
    columns = spec.variables if columns is None else columns
    return df.groupBy(spec.series_key).agg(*_aliased(_line_aggregates(spec, columns, where)))


def with_lines(
    df: DataFrame,
    spec: PanelSpec,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Every row with the lines of its series.

    Series in one piece are already together for a window, so the lines cost no
    join; series cut into pieces get them from :func:`fit_lines`.
    """
    columns = spec.variables if columns is None else columns
    if spec.pieces is not None:
        return join_series(df, fit_lines(df, spec, columns, where), spec)
    series = W.partitionBy(spec.series_key)
    lines = _line_aggregates(spec, columns, where)
    return df.select("*", *[line.over(series).alias(name) for name, line in lines.items()])


def last_values(spec: PanelSpec) -> list[Column]:
    """Aggregates for the last period of a series and its target there."""
    return [
        F.max(spec.order_col).alias("last_period"),
        F.max_by(spec.target, spec.order_col).alias("last_actual"),
    ]


def fitted(spec: PanelSpec, column: str, period: Column) -> Column:
    """Value of the line fitted to ``column``."""
    return line_at(F.col(f"{column}_slope"), F.col(f"{column}_intercept"), period, spec.origin)


def future_frame(
    per_series: DataFrame, spec: PanelSpec, horizon: int = HORIZON, last: str = "last_period"
) -> DataFrame:
    """The next ``horizon`` periods of each series, one row each."""
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    last_type = per_series.schema[last].dataType
    steps = per_series.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn(spec.order_col, (F.col(last) + F.col("step")).cast(last_type))


def line_forecast(
    df: DataFrame,
    spec: PanelSpec,
    horizon: int = HORIZON,
    columns: Sequence[str] | None = None,
    needed: Sequence[str] | None = None,
) -> DataFrame:
    """Each column's line, fitted to all rows, at the next ``horizon`` periods.

    Lines, last period and last actual come out of the same aggregate, so no
    join is needed. Series without a line for any of ``needed``, by default all
    columns, give no rows; a column without one is missing.
    """
    columns = spec.variables if columns is None else columns
    lines = df.groupBy(spec.series_key).agg(
        *_aliased(_line_aggregates(spec, columns)), *last_values(spec)
    )
    slopes = [F.col(f"{c}_slope") for c in needed or columns]
    has_line = F.coalesce(*slopes).isNotNull()
    future = future_frame(lines.filter(has_line), spec, horizon)
    values = [fitted(spec, c, F.col(spec.order_col)).alias(c) for c in columns]
    return future.select(spec.series_key, spec.order_col, *values, "last_actual")


def driver_forecast(df: DataFrame, spec: PanelSpec, horizon: int = HORIZON) -> DataFrame:
    """The drivers along their lines, for every series in which one has a line."""
    return line_forecast(df, spec, horizon, spec.drivers).drop("last_actual")


def trend_forecast(df: DataFrame, spec: PanelSpec, horizon: int = HORIZON) -> DataFrame:
    """Target and drivers along their lines, with change and millions."""
    forecast = line_forecast(df, spec, horizon, needed=[spec.target])
    return with_millions(with_change(forecast, spec), spec).drop("last_actual")
