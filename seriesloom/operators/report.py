"""Bands, changes, reports and display tables for a forecast.

A forecast holds ``horizon`` rows per series, so windows and joins over it by
series stay small whatever the length of the history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.functions.arithmetic import (
    band,
    in_millions,
    pct_change,
    round_even,
    step_change,
    whole_part,
)
from seriesloom.functions.text import fixed, left_aligned, plain, with_commas
from seriesloom.operators.features import with_numeric_values
from seriesloom.operators.history import PIECE, lag_name, last_rows, with_lags
from seriesloom.spec import PanelSpec

CHANGE = "year_over_year_change"
MILLIONS = "population_millions"
LOWER = "lower_bound"
UPPER = "upper_bound"

# Display names, digits and row types of the tables.
TABLE_NAMES = (
    "Year",
    "Population",
    "Change (%)",
    "Lower Bound (95%)",
    "Upper Bound (95%)",
    "Population (M)",
)
TABLE_DIGITS = (None, 0, 2, 0, 0, 2)
COMBINED_NAMES = ("Year", "Population", "YoY Change (%)", "Type")
HISTORICAL = "Historical"
FORECAST = "Forecast"


def with_change(
    forecast: DataFrame, spec: PanelSpec, last_actual: str = "last_actual"
) -> DataFrame:
    """Change of each forecast row against the one before; the first against the last actual."""
    steps = W.partitionBy(spec.series_key).orderBy(spec.order_col)
    first = F.row_number().over(steps) == 1
    previous = F.when(first, F.col(last_actual)).otherwise(F.lag(spec.target).over(steps))
    return forecast.withColumn(CHANGE, step_change(F.col(spec.target), previous))


def with_millions(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.withColumn(MILLIONS, in_millions(F.col(spec.target)))


def with_band(
    forecast: DataFrame, spec: PanelSpec, metrics: DataFrame | None, rmse: str = "test_rmse"
) -> DataFrame:
    """Bounds from an error per series; series without one get a share of the value."""
    if metrics is None:
        joined = forecast.withColumn("__rmse", F.lit(None).cast("double"))
    else:
        errors = metrics.select(spec.series_key, F.col(rmse).alias("__rmse"))
        joined = forecast.join(errors, spec.series_key, "left")
    lower, upper = band(F.col(spec.target), F.col("__rmse"))
    return joined.withColumn(LOWER, lower).withColumn(UPPER, upper).drop("__rmse")


def finish_forecast(
    forecast: DataFrame, spec: PanelSpec, metrics: DataFrame | None = None
) -> DataFrame:
    """A raw forecast with band, change and millions, in the published column order."""
    banded = with_band(forecast, spec, metrics)
    done = with_millions(with_change(banded, spec), spec)
    return done.select(*spec.columns, LOWER, UPPER, CHANGE, MILLIONS)


def series_profile(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """First and last period, number of rows and last value of each series."""
    period = spec.order_col
    return df.groupBy(spec.series_key).agg(
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
        F.count("*").alias("rows"),
        F.max_by(spec.target, period).alias("last_value"),
    )


def growth_report(
    history: DataFrame,
    forecast: DataFrame,
    spec: PanelSpec,
    metrics: DataFrame | None = None,
) -> DataFrame:
    """One row per forecast series: spans, growth, error measures and the forecast itself."""
    key, period, target = spec.series_key, spec.order_col, spec.target
    known = history.groupBy(key).agg(
        F.min(period).alias("start_year"),
        F.max(period).alias("end_year"),
        F.max_by(target, period).alias("current_population"),
    )
    columns = [period, *[c for c in forecast.columns if c not in (key, period)]]
    expected = forecast.groupBy(key).agg(
        F.struct(F.min(period).alias("first"), F.max(period).alias("last")).alias(
            "forecast_years"
        ),
        F.max_by(target, period).alias("forecast_population"),
        F.count("*").alias("__steps"),
        F.array_sort(F.collect_list(F.struct(*columns))).alias("forecasts"),
    )
    report = known.join(expected, key)
    if metrics is None:
        report = report.withColumn("model_metrics", F.lit(None).cast("map<string,double>"))
    else:
        names = [c for c in metrics.columns if c != key]
        pairs = [part for n in names for part in (F.lit(n), F.col(n))]
        report = report.join(
            metrics.select(key, F.create_map(*pairs).alias("model_metrics")), key, "left"
        )
    current, total = F.col("current_population"), F.col("total_change")
    return (
        report.withColumn("total_change", F.col("forecast_population") - current)
        .withColumn("percent_change", total / F.nullif(current, F.lit(0.0)) * 100)
        .withColumn("avg_annual_growth", F.col("percent_change") / F.col("__steps"))
        .select(
            key,
            "start_year",
            "end_year",
            "forecast_years",
            "current_population",
            "forecast_population",
            "total_change",
            "percent_change",
            "avg_annual_growth",
            "model_metrics",
            "forecasts",
        )
    )


def forecast_table(forecast: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rounded forecast under display names."""
    sources = (spec.order_col, spec.target, CHANGE, LOWER, UPPER, MILLIONS)
    columns = [
        F.col(c) if digits is None else round_even(F.col(c), digits).alias(c)
        for c, digits in zip(sources, TABLE_DIGITS)
    ]
    return forecast.select(spec.series_key, *columns).toDF(spec.series_key, *TABLE_NAMES)


def history_and_forecast(
    history: DataFrame, forecast: DataFrame, spec: PanelSpec, zero_base: str = "null"
) -> DataFrame:
    """Actual and forecast values in one table, with the change from row to row.

    The history is lagged by itself. Of it, the forecast needs one value per
    series: that of the last row, which its first row is compared with.
    """
    year, population, change, kind = COMBINED_NAMES
    key, period, target = spec.series_key, spec.order_col, spec.target
    numeric = with_numeric_values(history, spec, [target])
    actual = with_lags(numeric.select(*_known(history, key, period, target)), spec, 1, [target])
    last = last_rows(numeric.select(key, period, target), spec, 1).select(
        key, F.col(target).alias("__last")
    )
    steps = W.partitionBy(key).orderBy(period)
    expected = with_numeric_values(forecast, spec, [target]).join(last, key, "left")
    before = F.when(F.row_number().over(steps) == 1, F.col("__last")).otherwise(
        F.lag(target).over(steps)
    )

    def shown(part: DataFrame, previous: Column, label: str) -> DataFrame:
        moved = pct_change(F.col(target), previous, zero_base)
        return part.select(
            key,
            F.col(period).alias(year),
            round_even(F.col(target), 0).cast("bigint").alias(population),
            round_even(moved, 2).alias(change),
            F.lit(label).alias(kind),
        )

    return shown(actual, F.col(lag_name(target, 1)), HISTORICAL).unionByName(
        shown(expected, before, FORECAST)
    )


def _known(df: DataFrame, *columns: str) -> list[str]:
    """The columns, and the number of the piece where the table is cut already."""
    return [*columns, *[PIECE for _ in range(PIECE in df.columns)]]


def sorted_by_period(table: DataFrame, spec: PanelSpec, period: str = "Year") -> DataFrame:
    """Rows in display order."""
    return table.orderBy(spec.series_key, period)


# The labels of the texts below.
RATE_LABELS = (" (Birth Rate: ", ", Death Rate: ", ", Migration: ", ")")
CURRENT_LABEL = "Current Population"
FORECAST_LABEL = "Forecasted Population"
CHANGE_LABEL = "Total Change: "
GROWTH_LABEL = "Average Annual Growth Rate: "
SLOPE_LABELS = ("Population trend: ", " people per year")


def historical_lines(history: DataFrame, spec: PanelSpec) -> DataFrame:
    """One line of text per period: value and the three rates."""
    before_birth, before_death, before_migration, end = map(F.lit, RATE_LABELS)
    birth, death, migration = (plain(F.col(d)) for d in spec.drivers)
    line = F.concat(
        F.col(spec.order_col).cast("string"),
        F.lit(": "),
        with_commas(whole_part(F.col(spec.target))),
        before_birth,
        birth,
        before_death,
        death,
        before_migration,
        migration,
        end,
    )
    return history.select(spec.series_key, spec.order_col, line.alias("line"))


def trend_lines(forecast: DataFrame, spec: PanelSpec) -> DataFrame:
    """One line of text per forecast period: value, change and millions in columns."""
    # Column widths of the text table
    line = F.concat(
        left_aligned(F.col(spec.order_col), 10),
        with_commas(whole_part(F.col(spec.target))),
        F.lit(" " * 10),
        fixed(F.col(CHANGE), 2, "%"),
        F.lit(" " * 10),
        fixed(F.col(MILLIONS), 2, "M"),
    )
    return forecast.select(spec.series_key, spec.order_col, line.alias("line"))


def summary_lines(report: DataFrame, spec: PanelSpec) -> DataFrame:
    """The report's headline figures as text, one row per series."""
    last = F.col("end_year").cast("string")
    final = F.col("forecast_years.last").cast("string")

    def labelled(name: str, period: Column, value: Column) -> Column:
        return F.concat(F.lit(f"{name} ("), period, F.lit("): "), with_commas(value))

    total = F.concat(
        F.lit(CHANGE_LABEL),
        with_commas(F.col("total_change")),
        F.lit(" ("),
        fixed(F.col("percent_change"), 2, "%"),
        F.lit(")"),
    )
    growth = F.concat(
        F.lit(GROWTH_LABEL), fixed(F.col("avg_annual_growth"), 2, "%")
    )
    return report.select(
        spec.series_key,
        labelled(CURRENT_LABEL, last, F.col("current_population")).alias("current_line"),
        labelled(FORECAST_LABEL, final, F.col("forecast_population")).alias(
            "forecast_line"
        ),
        total.alias("change_line"),
        growth.alias("growth_line"),
    )


def slope_lines(slopes: DataFrame, spec: PanelSpec, slope: str = "slope") -> DataFrame:
    """The trend per period as text, one row per series."""
    line = F.concat(
        F.lit(SLOPE_LABELS[0]), with_commas(F.col(slope)), F.lit(SLOPE_LABELS[1])
    )
    return slopes.select(spec.series_key, line.alias("line"))
