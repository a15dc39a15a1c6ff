"""Forecast a panel in CSV files: ``spark-submit ... -m seriesloom`` or ``python -m seriesloom``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from seriesloom.plans.run import RUN_OPTIONS, RUN_SETTINGS, run_forecast, run_trend
from seriesloom.session import remove_written
from seriesloom.sources.panel_csv import read_panel, read_single_series
from seriesloom.spec import PanelSpec

# Rows of a table that are printed; --report writes all rows of all tables.
PREVIEW_ROWS = 20


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="seriesloom", description=__doc__)
    parser.add_argument("input", help="CSV files of the panel")
    parser.add_argument("--single", action="store_true", help="the files hold one series, no key")
    parser.add_argument("--trend", action="store_true", help="lines only, no model")
    parser.add_argument("--horizon", type=int, default=6)
    parser.add_argument("--iterations", type=int, default=RUN_SETTINGS["iterations"])
    parser.add_argument(
        "--as-published",
        action="store_true",
        help="train on all features and rows; stop after 50 rounds without progress on the test"
        " rows",
    )
    parser.add_argument("--report", help="folder for all tables, whole")
    parser.add_argument("--model", help="folder for the trained model")
    return parser.parse_args()


def _show(title: str, table: DataFrame) -> None:
    print(f"\n{title} (first {PREVIEW_ROWS} rows)")
    table.show(PREVIEW_ROWS, truncate=False)


def main() -> None:
    arguments = _arguments()
    builder = SparkSession.builder.appName("seriesloom").config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    spec = PanelSpec()
    read = read_single_series if arguments.single else read_panel
    panel = read(spark, arguments.input, spec)
    order = [spec.series_key, spec.order_col]
    if arguments.trend:
        run = run_trend(panel, spec, arguments.horizon, arguments.report)
        _show("History", run.listing.orderBy(*order))
        _show("Slopes", run.slopes.orderBy(spec.series_key))
        _show("Lines ahead", run.lines.orderBy(*order))
    else:
        settings = {**RUN_SETTINGS, "iterations": arguments.iterations}
        run = run_forecast(
            panel,
            spec,
            arguments.horizon,
            settings,
            report_path=arguments.report,
            model_path=arguments.model,
            **(RUN_OPTIONS if arguments.as_published else {}),
        )
        _show("Errors", run.metrics)
        _show("Most important features", run.importance.limit(10))
        _show("Growth", run.summary.orderBy(spec.series_key))
        _show("Forecast", run.forecast_table.orderBy(spec.series_key, "Year"))
        _show("History and forecast", run.combined_table.orderBy(spec.series_key, "Year"))
    # all results are shown or stored
    remove_written(spark)
    spark.stop()


if __name__ == "__main__":
    main()
