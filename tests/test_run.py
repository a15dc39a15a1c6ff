import subprocess
import sys

import pytest

from panels import WHOLE, by_key, make
from seriesloom.plans.run import RUN_OPTIONS, run_forecast, run_trend
from seriesloom.sources.panel_csv import read_csv, write_csv
from test_model import SMALL, wave


def test_whole_run(spark, tmp_path):
    panel = make(spark, wave())
    report, model = str(tmp_path / "report"), str(tmp_path / "model")
    run = run_forecast(panel, WHOLE, 4, SMALL, report, model)
    assert run.forecast.count() == run.forecast_table.count() == 12
    assert run.combined_table.count() == 72 + 12
    assert run.chart_band.count() == 72 + 12
    assert run.chart_indicators.count() == 3 * (72 + 12)
    assert run.report.count() == run.summary.count() == 3
    written = read_csv(spark, f"{report}/forecast", run.forecast.schema)
    assert by_key(written) == by_key(run.forecast)
    assert run.coverage.filter("has_forecast").count() == 3


def test_tables_are_written_whole(spark, tmp_path):
    panel = make(spark, wave(series=100, rows=12))
    run = run_forecast(panel, WHOLE.with_pieces(3), 2, SMALL, str(tmp_path))
    for name, table in run.tables().items():
        stored = spark.read.json(f"{tmp_path}/{name}") if name == "report" else read_csv(
            spark, f"{tmp_path}/{name}", table.schema
        )
        assert stored.count() == table.count(), name
    assert run.summary.count() == 100 and run.combined_table.count() == 100 * 14
    trend = run_trend(panel, WHOLE, 2, str(tmp_path / "trend"))
    for name, table in trend.tables().items():
        assert read_csv(spark, f"{tmp_path}/trend/{name}", table.schema).count() == table.count()


def test_run_on_one_short_series_as_published(spark):
    panel = make(spark, wave(series=1, rows=10))
    run = run_forecast(panel, WHOLE, 6, SMALL, **RUN_OPTIONS)
    assert len(run.model.feature_names) == 35
    assert run.model.scored.filter("not is_test").count() == 8
    assert run.forecast.count() == 6


def test_trend_run(spark):
    run = run_trend(make(spark, wave()), WHOLE)
    assert run.forecast.count() == run.lines.count() == 18
    assert run.listing.count() == 72
    assert run.slopes.first()["line"].endswith("people per year")


@pytest.mark.parametrize("blocks", [None, 5])
def test_run_does_not_depend_on_blocks(spark, blocks):
    run = run_trend(make(spark, wave()), WHOLE.with_pieces(blocks), 2)
    assert [r["year"] for r in by_key(run.forecast)] == [2024, 2025] * 3


def test_command_line(spark, tmp_path):
    path = str(tmp_path / "panel")
    write_csv(make(spark, wave(rows=8)), path)
    done = subprocess.run(
        [sys.executable, "-m", "seriesloom", path, "--trend"],
        capture_output=True,
        text=True,
        timeout=300,
        check=True,
    )
    assert "Population trend:" in done.stdout
