import pytest

from panels import WHOLE, by_key, make, one_series
from seriesloom.operators import trend
from seriesloom.spec import PanelSpec


def test_exact_line(spark):
    panel = make(spark, [(1, t, 2.0 * t + 1, 1.0, 1.0 * t, -0.5 * t) for t in range(10)])
    line = trend.fit_lines(panel, WHOLE).first()
    assert line["population_slope"] == pytest.approx(2.0)
    assert line["population_intercept"] == pytest.approx(1.0)
    assert line["birth_rate_slope"] == 0.0
    rows = by_key(trend.trend_forecast(panel, WHOLE))
    assert [r["year"] for r in rows] == list(range(10, 16))
    assert [r["population"] for r in rows] == pytest.approx([2.0 * t + 1 for t in range(10, 16)])
    assert [r["migration_rate"] for r in rows] == pytest.approx([-0.5 * t for t in range(10, 16)])
    assert rows[0]["year_over_year_change"] == pytest.approx((21 - 19) / 19 * 100)
    assert rows[1]["year_over_year_change"] == pytest.approx((23 - 21) / 21 * 100)
    assert rows[0]["population_millions"] == pytest.approx(21e-6)


@pytest.mark.parametrize("origin", [0, 2000, 5000])
def test_origin_does_not_move_the_forecast(spark, origin):
    panel = one_series(spark, [5.0, 7.0, 8.0, 13.0])
    spec = PanelSpec(origin=origin, pieces=None)
    values = [r["population"] for r in by_key(trend.line_forecast(panel, spec, 2))]
    assert values == pytest.approx([14.5, 17.0], rel=1e-9)


def test_no_line_no_forecast(spark):
    one_row = one_series(spark, [3.0])
    same_period = make(spark, [(2, 1, 1.0, 1.0, 1.0, 1.0), (2, 1, 3.0, 1.0, 1.0, 1.0)])
    for panel in (one_row, same_period):
        assert trend.fit_lines(panel, WHOLE).first()["population_slope"] is None
        assert trend.trend_forecast(panel, WHOLE).isEmpty()


def test_missing_values_do_not_count(spark):
    panel = one_series(spark, [1.0, None, 3.0, 4.0])
    assert trend.fit_lines(panel, WHOLE).first()["population_slope"] == pytest.approx(1.0)


def test_only_the_chosen_rows_are_fitted(spark):
    panel = one_series(spark, [1.0, 2.0, 3.0, 100.0])
    for spec in (WHOLE, WHOLE.with_pieces(2)):
        lined = trend.with_lines(panel, spec, ["population"], panel["year"] < 2003)
        assert {round(r["population_slope"], 9) for r in lined.collect()} == {1.0}
        assert lined.count() == 4


def test_horizon_is_checked(spark):
    with pytest.raises(ValueError):
        trend.trend_forecast(one_series(spark, [1.0, 2.0]), WHOLE, 0)


def test_two_rows(spark):
    from seriesloom.operators.features import full_features

    panel = one_series(spark, [4.0, 6.0])
    assert trend.fit_lines(panel, WHOLE).first()["population_slope"] == pytest.approx(2.0)
    assert [r["population_ma_3"] for r in by_key(full_features(panel, WHOLE))] == [0.0, 0.0]
    assert [r["population_ma_2"] for r in by_key(full_features(panel, WHOLE))] == [0.0, 5.0]


def test_driver_forecast_keeps_series_with_any_line(spark):
    rows = [(1, t, 5.0, None, 2.0 * t, 1.0) for t in range(4)] + [(2, t, 5.0, None, None, None) for t in range(4)]
    found = by_key(trend.driver_forecast(make(spark, rows), WHOLE, 2))
    assert [(r["series_key"], r["year"], r["birth_rate"], r["death_rate"]) for r in found] == [
        (1, 4, None, 8.0),
        (1, 5, None, 10.0),
    ]
    assert trend.trend_forecast(make(spark, rows), WHOLE, 2).count() == 4
