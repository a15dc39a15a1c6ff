"""The whole job: train, score, forecast, report and tables for a panel."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from seriesloom.operators import charts, model, recursion, report, trend
from seriesloom.operators.history import cut
from seriesloom.operators.trend import HORIZON
from seriesloom.session import written
from seriesloom.sources.panel_csv import write_csv
from seriesloom.spec import PanelSpec

# Training settings of the published run.
RUN_SETTINGS = {
    "iterations": 2000,
    "learning_rate": 0.03,
    "depth": 6,
    "l2_leaf_reg": 3,
    "loss_function": "RMSE",
}

# Features and rows of the published run. All features, also those
# that know the row's own target; also the first rows, whose lags are missing;
# and the test rows decide when to stop.
RUN_OPTIONS = {
    "choice": model.FeatureChoice("full"),
    "drop_warmup": False,
    "stop_on_test": True,
}


@dataclass(frozen=True)
class ForecastRun:
    """Everything a run produces; all but the model are tables."""

    model: model.TrainedModel
    metrics: DataFrame
    importance: DataFrame
    forecast: DataFrame
    report: DataFrame
    summary: DataFrame
    forecast_table: DataFrame
    combined_table: DataFrame
    chart_band: DataFrame
    chart_indicators: DataFrame
    coverage: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name != "model"}


def run_forecast(
    panel: DataFrame,
    spec: PanelSpec,
    horizon: int = HORIZON,
    settings: Mapping | None = None,
    report_path: str | None = None,
    model_path: str | None = None,
    **options,
) -> ForecastRun:
    """Train on the panel and roll it forward; optionally write all tables and the model.

    ``options`` go to :func:`seriesloom.operators.model.train`; ``RUN_OPTIONS``
    are those of the published run. Panel and forecast are written to the shared
    folder once and read by every later step; the panel in pieces, unless
    ``spec.pieces`` is None.
    """
    panel = panel.select(*spec.columns)
    panel = written(panel, "panel") if spec.pieces is None else cut(panel, spec)
    settings = RUN_SETTINGS if settings is None else settings
    trained = model.train(panel, spec, settings, **options)
    if model_path:
        model.save_model(trained, model_path)
    forecast = written(recursion.recursive_forecast(panel, trained, horizon), "forecast")
    full_report = report.growth_report(panel, forecast, spec, trained.series_metrics)
    combined = report.history_and_forecast(panel, forecast, spec)
    run = ForecastRun(
        model=trained,
        metrics=trained.metrics(),
        importance=model.feature_importance(trained),
        forecast=forecast,
        report=full_report,
        summary=report.summary_lines(full_report, spec),
        forecast_table=report.forecast_table(forecast, spec),
        combined_table=combined,
        chart_band=charts.target_with_band(panel, forecast, spec),
        chart_indicators=charts.indicators_long(panel, forecast, spec),
        coverage=recursion.coverage(panel, forecast, spec),
    )
    if report_path:
        write_tables(run.tables(), report_path)
    return run


def write_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """Every table whole below one folder: as CSV, or as JSON where rows are nested."""
    for name, table in tables.items():
        nested = any(isinstance(f.dataType, (StructType, ArrayType, MapType)) for f in table.schema)
        if nested:
            table.write.mode("overwrite").json(f"{path}/{name}")
        else:
            write_csv(table, f"{path}/{name}")


@dataclass(frozen=True)
class TrendRun:
    listing: DataFrame
    slopes: DataFrame
    forecast: DataFrame
    lines: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def run_trend(
    panel: DataFrame, spec: PanelSpec, horizon: int = HORIZON, report_path: str | None = None
) -> TrendRun:
    """The forecast without a model: a line per series."""
    forecast = trend.trend_forecast(panel, spec, horizon)
    slope = F.col(f"{spec.target}_slope")
    fitted = trend.fit_lines(panel, spec, [spec.target])
    run = TrendRun(
        listing=report.historical_lines(panel, spec),
        slopes=report.slope_lines(fitted.select(spec.series_key, slope.alias("slope")), spec),
        forecast=forecast,
        lines=report.trend_lines(forecast, spec),
    )
    if report_path:
        write_tables(run.tables(), report_path)
    return run
