"""The data behind the charts, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.text import millions_label
from seriesloom.operators.history import last_rows
from seriesloom.operators.report import FORECAST, HISTORICAL, LOWER, UPPER
from seriesloom.spec import PanelSpec

LABELLED_ACTUALS = 3


def target_with_band(
    history: DataFrame, forecast: DataFrame, spec: PanelSpec, labelled: int = LABELLED_ACTUALS
) -> DataFrame:
    """Points of actuals and forecast; the last actuals and all forecasts carry a label.

    A forecast without bounds gives points without a band.
    """
    key, period, target = spec.series_key, spec.order_col, spec.target
    none = F.lit(None).cast("double")
    # only the last few rows of a series are looked for, not the place of every row
    near_end = last_rows(history.select(key, period), spec, labelled)
    marked = history.select(key, period, target).join(
        near_end.withColumn("__labelled", F.lit(True)), [key, period], "left"
    )
    actual = marked.select(
        key,
        period,
        F.lit(HISTORICAL).alias("kind"),
        F.col(target).alias("value"),
        none.alias("lower"),
        none.alias("upper"),
        F.when(F.col("__labelled"), millions_label(F.col(target))).alias("label"),
    )
    expected = forecast.select(
        key,
        period,
        F.lit(FORECAST).alias("kind"),
        F.col(target).alias("value"),
        (F.col(LOWER) if LOWER in forecast.columns else none).alias("lower"),
        (F.col(UPPER) if UPPER in forecast.columns else none).alias("upper"),
        millions_label(F.col(target)).alias("label"),
    )
    return actual.unionByName(expected)


def indicators_long(history: DataFrame, forecast: DataFrame, spec: PanelSpec) -> DataFrame:
    """Driver values of actuals and forecast, one row per driver and period."""
    keys = [spec.series_key, spec.order_col]
    both = history.select(*keys, *spec.drivers, F.lit(HISTORICAL).alias("kind")).unionByName(
        forecast.select(*keys, *spec.drivers, F.lit(FORECAST).alias("kind"))
    )
    return both.unpivot([*keys, "kind"], list(spec.drivers), "indicator", "value")
