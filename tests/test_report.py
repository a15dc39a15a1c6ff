import pytest
from pyspark.sql import functions as F

from panels import WHOLE, by_key, make, one_series
from seriesloom.functions.arithmetic import round_even, whole_part
from seriesloom.functions import text
from seriesloom.operators import charts, report, trend

FORECAST = (
    "series_key long, year int, population double, birth_rate double, death_rate double, "
    "migration_rate double, last_actual double"
)


@pytest.fixture
def forecast(spark):
    rows = [
        (1, 2004, 110.0, 1.0, 2.0, 3.0, 100.0),
        (1, 2005, 121.0, 1.5, 2.5, 3.5, 100.0),
        (2, 2004, 2_500_000.5, 1.0, 2.0, 3.0, 2_000_000.0),
        (3, 2004, 50.0, 1.0, 2.0, 3.0, 0.0),
    ]
    return make(spark, rows, FORECAST)


@pytest.fixture
def errors(spark):
    schema = "series_key long, test_rmse double"
    return make(spark, [(1, 10.0), (2, 0.0), (4, 1.0)], schema)


def test_band(forecast, errors):
    rows = by_key(report.finish_forecast(forecast, WHOLE, errors))
    assert [r["series_key"] for r in rows] == [1, 1, 2, 3]
    assert rows[0]["lower_bound"] == 110.0 - 1.96 * 10.0
    assert rows[1]["upper_bound"] == 121.0 + 1.96 * 10.0
    assert rows[2]["lower_bound"] == 2_500_000.5 * 0.98
    assert rows[3]["upper_bound"] == 50.0 * 1.02
    without = by_key(report.with_band(forecast, WHOLE, None))
    assert without[0]["lower_bound"] == 110.0 * 0.98


def test_change_is_chained(forecast):
    changes = [r["year_over_year_change"] for r in by_key(report.with_change(forecast, WHOLE))]
    assert changes[:2] == pytest.approx([10.0, 10.0])
    assert changes[3] is None


def test_report(spark, forecast, errors):
    history = one_series(spark, [70.0, 80.0, 90.0, 100.0])
    done = report.finish_forecast(forecast, WHOLE, errors)
    (row,) = report.growth_report(history, done, WHOLE, errors).collect()
    assert (row["start_year"], row["end_year"]) == (2000, 2003)
    assert tuple(row["forecast_years"]) == (2004, 2005)
    assert row["total_change"] == 21.0
    assert row["percent_change"] == 21.0
    assert row["avg_annual_growth"] == 10.5
    assert row["model_metrics"] == {"test_rmse": 10.0}
    assert [f["year"] for f in row["forecasts"]] == [2004, 2005]
    assert report.growth_report(history, done, WHOLE).first()["model_metrics"] is None


def test_summary_text(spark, forecast):
    history = one_series(spark, [1_234_567.0, 1_000_000.0], key=2, start=2002)
    full = report.growth_report(history, report.finish_forecast(forecast, WHOLE), WHOLE)
    line = report.summary_lines(full, WHOLE).first()
    assert line["current_line"] == "Current Population (2003): 1,000,000"
    assert line["forecast_line"] == "Forecasted Population (2004): 2,500,000"
    assert line["change_line"] == "Total Change: 1,500,000 (150.00%)"
    assert line["growth_line"] == "Average Annual Growth Rate: 150.00%"


def test_forecast_text(forecast):
    changed = report.with_millions(report.with_change(forecast, WHOLE), WHOLE)
    line = by_key(report.trend_lines(changed, WHOLE))[2]["line"]
    assert line == "2004      2,500,000" + " " * 10 + "25.00%" + " " * 10 + "2.50M"


def test_listing(spark):
    line = by_key(report.historical_lines(one_series(spark, [1234567.9]), WHOLE))[0]["line"]
    assert line == "2000: 1,234,567 (Birth Rate: 10.0, Death Rate: 5.0, Migration: 1.0)"


def test_missing_values_in_text(spark, forecast):
    line = by_key(report.historical_lines(one_series(spark, [None], births=[None]), WHOLE))[0]
    assert line["line"] == "2000: n/a (Birth Rate: n/a, Death Rate: 5.0, Migration: 1.0)"
    changed = report.with_millions(report.with_change(forecast, WHOLE), WHOLE)
    assert by_key(report.trend_lines(changed, WHOLE))[3]["line"].split() == [
        "2004",
        "50",
        "n/a",
        "0.00M",
    ]


def test_chart_without_band(spark):
    history = one_series(spark, [4.2e6, 5.9e6])
    points = charts.target_with_band(history, trend.line_forecast(history, WHOLE, 1), WHOLE)
    assert [r["lower"] for r in by_key(points)] == [None] * 3


def test_tables_round_half_to_even(spark):
    rows = [(1, 2004, 2.5, 0.0, 0.0, 0.0, 2.0), (1, 2005, 3.5, 0.0, 0.0, 0.0, 2.0)]
    done = report.finish_forecast(make(spark, rows, FORECAST), WHOLE)
    table = report.forecast_table(done, WHOLE)
    assert table.columns == [
        "series_key",
        "Year",
        "Population",
        "Change (%)",
        "Lower Bound (95%)",
        "Upper Bound (95%)",
        "Population (M)",
    ]
    assert [r["Population"] for r in by_key(table, "Year")] == [2.0, 4.0]


def test_combined_table(spark, forecast):
    history = one_series(spark, [80.0, 100.0], start=2002)
    table = report.history_and_forecast(history, forecast.filter("series_key = 1"), WHOLE)
    rows = by_key(table, "Year")
    assert [tuple(r)[1:] for r in rows] == [
        (2002, 80, None, "Historical"),
        (2003, 100, 25.0, "Historical"),
        (2004, 110, 10.0, "Forecast"),
        (2005, 121, 10.0, "Forecast"),
    ]


@pytest.mark.parametrize("block", [None, 2])
def test_chart_labels(spark, block):
    spec = WHOLE.with_pieces(block)
    history = one_series(spark, [4.2e6, 5.9e6, 6.0e6, 7.1e6])
    done = report.finish_forecast(trend.line_forecast(history, spec, 2), spec)
    rows = by_key(charts.target_with_band(history, done, spec))
    assert [r["label"] for r in rows[:4]] == [None, "5M", "6M", "7M"]
    assert all(r["label"] and r["lower"] < r["value"] < r["upper"] for r in rows[4:])


def test_indicators(spark, forecast):
    history = one_series(spark, [1.0, 2.0])
    long = charts.indicators_long(history, forecast, WHOLE)
    assert long.columns == ["series_key", "year", "kind", "indicator", "value"]
    assert long.count() == 3 * (2 + 4)


@pytest.mark.parametrize(
    ("value", "digits", "expected"),
    [(2.5, 0, 2.0), (3.5, 0, 4.0), (0.125, 2, 0.12), (2.675, 2, 2.68), (-2.5, 0, -2.0)],
)
def test_round_even(spark, value, digits, expected):
    frame = make(spark, [(value,)], "x double")
    assert frame.select(round_even(frame.x, digits)).first()[0] == expected


@pytest.mark.parametrize(("value", "expected"), [(146069455.9, 146069455), (-1.9, -1)])
def test_whole_part_is_cut(spark, value, expected):
    frame = make(spark, [(value,)], "x double")
    assert frame.select(whole_part(frame.x)).first()[0] == expected


EDGES = [
    0.0, -0.0, 2.675, 0.125, 0.375, -0.125, 0.0005, -0.001, 0.005, 0.015, 1.005, 99.995, 1e7, 12345678.0,
    123456789.123, 1e15, 1e16, 1.5e16, 1e-4, 1.234e-4, 9.9e-5, 1e-300, 0.001, 1.0, 1e22, -2.5, 1e100,
]


def test_texts_of_numbers_are_those_of_python(spark):
    df = spark.createDataFrame([(v,) for v in EDGES], "v double").coalesce(1)
    rows = df.select(
        "v", text.plain(F.col("v")).alias("plain"), text.fixed(F.col("v"), 2, "%").alias("fixed")
    ).collect()
    for r in rows:
        assert r["plain"] == repr(r["v"])
        if abs(r["v"]) < 1e23:  # the engine fills further digits with zeros
            assert r["fixed"] == f"{r['v']:.2f}%"
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "v double")
    assert [r[0] for r in odd.select(text.plain(F.col("v"))).collect()] == ["n/a", "nan", "inf"]


def test_texts_of_random_numbers(spark):
    import random

    source = random.Random(3)
    values = [source.uniform(-1, 1) * 10 ** source.randint(-3, 12) for _ in range(500)]
    values += [source.randint(-4000, 4000) / 8 for _ in range(200)]
    values += [source.randint(-4000, 4000) / 1000 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", text.fixed(F.col("v"), 2).alias("fixed")).collect():
        assert r["fixed"] == f"{r['v']:.2f}", r["v"]
