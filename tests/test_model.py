import math

import pytest
from pyspark.sql import functions as F

from panels import WHOLE, by_key, make
from seriesloom.operators import model, recursion
from seriesloom.sources import versions

SMALL = {"iterations": 5, "depth": 3, "learning_rate": 0.3}


def wave(series=3, rows=24, missing=False):
    made = []
    for key in range(series):
        for t in range(rows):
            target = 100.0 * (key + 1) + 3 * t + 10 * math.sin(t)
            birth = None if missing and t % 7 == 3 else 10.0 + t % 4
            made.append((key, 2000 + t, target, birth, 5.0 + t % 3, 1.0 - 0.1 * t))
    return made


@pytest.fixture(scope="module")
def panel(spark):
    return make(spark, wave()).cache()


@pytest.fixture(scope="module")
def trained(panel):
    return model.train(panel, WHOLE, SMALL)


def test_training_table(panel):
    table = model.training_table(panel, WHOLE)
    first = [r for r in by_key(table) if r["series_key"] == 0]
    assert [r["year"] for r in first] == list(range(2003, 2024))
    assert [r["year"] for r in first if r["is_test"]] == list(range(2019, 2024))
    assert [r["year"] for r in first if r["is_validation"]] == list(range(2015, 2019))
    assert model.training_table(panel, WHOLE, drop_warmup=False).count() == 72


def test_metrics_and_scores(panel, trained):
    row = trained.metrics().first()
    parts, measures = ("train", "test"), ("mae", "rmse", "r2")
    assert set(row.asDict()) == {f"{p}_{m}" for p in parts for m in measures}
    assert all(math.isfinite(v) for v in row)
    assert trained.scored.count() == 63
    assert trained.series_metrics.count() == 3


def test_importance(trained):
    rows = model.feature_importance(trained).collect()
    assert len(rows) == 31
    assert sum(r["importance"] for r in rows) == pytest.approx(100.0)
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True)
    assert model.feature_importance(trained, 10).count() == 10


def test_basic_model(panel):
    trained = model.train_basic(panel, WHOLE, SMALL)
    assert len(trained.feature_names) == 15
    assert trained.scored.filter("is_test").count() == 3 * math.ceil(21 * 0.2)
    forecast = recursion.recursive_forecast(panel, trained, 2)
    assert forecast.count() == 6


def test_full_set_and_stopping_on_test(panel):
    choice = model.FeatureChoice("full")
    trained = model.train(panel, WHOLE, SMALL, choice, stop_on_test=True)
    assert len(trained.feature_names) == 35
    assert trained.scored.filter("is_validation and not is_test").isEmpty()


def test_missing_driver_values(spark):
    panel = make(spark, wave(missing=True))
    trained = model.train(panel, WHOLE, SMALL)
    assert trained.scored.filter(F.col("prediction").isNull()).isEmpty()
    assert recursion.recursive_forecast(panel, trained, 2).count() == 6


def test_save_and_load(spark, panel, trained, tmp_path):
    path = str(tmp_path / "model")
    model.save_model(trained, path)
    loaded = model.load_model(spark, path)
    assert loaded.feature_names == trained.feature_names
    assert loaded.spec == trained.spec
    before = recursion.recursive_forecast(panel, trained, 3)
    after = recursion.recursive_forecast(panel, loaded, 3)
    assert by_key(before) == by_key(after)
    with pytest.raises(ValueError):
        loaded.metrics()
    model.save_model(loaded, path)
    again = model.load_model(spark, path)
    assert by_key(again.series_metrics, "series_key") == by_key(trained.series_metrics, "series_key")
    with pytest.raises(ValueError):
        model.load_model(spark, str(tmp_path / "nothing"))


@pytest.mark.parametrize("step", ["parquet", "json", "commit", "remove_others"])
def test_a_save_that_is_stopped_leaves_the_former_model(spark, panel, trained, tmp_path, monkeypatch, step):
    path = str(tmp_path / "model")
    model.save_model(trained, path)
    other = model.train(panel, WHOLE, {**SMALL, "iterations": 1})

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        if step in ("parquet", "json"):
            patch.setattr(type(panel.write), step, stop)
        else:
            patch.setattr(versions, step, stop)
        with pytest.raises(RuntimeError):
            model.save_model(other, path)
    expected = other if step == "remove_others" else trained
    loaded = model.load_model(spark, path)
    assert loaded.pipeline.stages[-1].getNumTrees == expected.pipeline.stages[-1].getNumTrees
    assert by_key(loaded.series_metrics, "series_key") == by_key(expected.series_metrics, "series_key")
    # the next save goes through and clears what was left behind
    model.save_model(other, path)
    assert model.load_model(spark, path).pipeline.stages[-1].getNumTrees == 1
    assert len(list((tmp_path / "model").glob("version-*"))) == 2


def test_save_and_load_without_errors(spark, panel, trained, tmp_path):
    path = str(tmp_path / "model")
    model.save_model(trained, path)
    model.save_model(model.TrainedModel(trained.pipeline, trained.spec, trained.choice), path)
    loaded = model.load_model(spark, path)
    assert loaded.series_metrics is None
    assert recursion.recursive_forecast(panel, loaded, 2).count() == 6


def test_every_series_is_accounted_for(spark):
    rows = [r if r[0] != 7 else (*r[:3], None, *r[4:]) for r in wave(series=24)]
    panel = make(spark, [*rows, (99, 2000, 1.0, 1.0, 1.0, 1.0)])
    trained = model.train(panel, WHOLE, SMALL)
    forecast = recursion.recursive_forecast(panel, trained, 2)
    found = {r["series_key"]: r for r in recursion.coverage(panel, forecast, WHOLE).collect()}
    assert len(found) == 25
    assert [k for k, r in found.items() if not r["has_forecast"]] == [99]
    assert found[99]["reason"] == recursion.TOO_SHORT
    ahead = forecast.filter("series_key = 7").collect()
    assert len(ahead) == 2 and all(r["birth_rate"] is None and r["population"] for r in ahead)


def test_recursive_forecast(panel, trained):
    forecast = recursion.recursive_forecast(panel, trained, 6)
    rows = by_key(forecast)
    assert forecast.columns == [
        "series_key",
        "year",
        "population",
        "birth_rate",
        "death_rate",
        "migration_rate",
        "lower_bound",
        "upper_bound",
        "year_over_year_change",
        "population_millions",
    ]
    assert len(rows) == 18
    assert [r["year"] for r in rows[:6]] == list(range(2024, 2030))
    for r in rows:
        assert r["lower_bound"] < r["population"] < r["upper_bound"]
    widths = {round(r["upper_bound"] - r["lower_bound"], 6) for r in rows[:6]}
    assert len(widths) == 1


def test_untrained_and_empty(spark, panel, tmp_path):
    with pytest.raises(ValueError):
        model.save_model(None, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        recursion.recursive_forecast(panel, None)
    with pytest.raises(ValueError):
        model.train_basic(panel.limit(0), WHOLE, SMALL)


def test_settings():
    defaults = model.BoostingParams(**model.FULL_DEFAULTS)
    assert (defaults.iterations, defaults.learning_rate, defaults.depth) == (1000, 0.05, 6)
    changed = defaults.override({"iterations": 2000, "learning_rate": 0.03, "l2_leaf_reg": 5})
    assert (changed.iterations, changed.learning_rate, changed.l2_leaf_reg) == (2000, 0.03, 5)
    assert defaults.l2_leaf_reg == 3
    with pytest.raises(ValueError):
        defaults.override({"rounds": 5})
    with pytest.raises(ValueError):
        defaults.override({"loss_function": "MAE"})
    with pytest.raises(ValueError):
        defaults.override({"stopping": "never"})
    with pytest.raises(ValueError):
        defaults.override({"l2_leaf_reg": -1})


def step_by_step(values, horizon):
    values = list(values)
    for _ in range(horizon):
        lags = [values[-i] if len(values) >= i else 0.0 for i in (1, 2, 3)]
        values.append((lags[0] + lags[1] + lags[2]) / 3.0)
    return values[-horizon:]


@pytest.mark.parametrize("horizon", [1, 6, 14])
@pytest.mark.parametrize("block", [None, 4])
def test_rule_rolled_forward(spark, horizon, block):
    from seriesloom.operators.features import full_feature_list

    spec = WHOLE.with_pieces(block)
    series = {1: [5.0, 9.0, 2.0, 7.0], 2: [4.0, 8.0], 3: [6.0]}
    rows = [
        (key, t, v, 1.0 * t, 2.0, 3.0)
        for key, values in series.items()
        for t, v in enumerate(values)
    ]
    features = full_feature_list(spec)
    steps = recursion.recursive_steps(
        make(spark, rows), spec, features, recursion.mean_of_lags(spec, features), horizon
    )
    got = by_key(steps)
    assert {r["series_key"] for r in got} == {1, 2}
    for key in (1, 2):
        mine = [r for r in got if r["series_key"] == key]
        assert [r["population"] for r in mine] == step_by_step(series[key], horizon)
        assert [r["birth_rate"] for r in mine] == pytest.approx([1.0 * r["year"] for r in mine])


def test_features_of_a_step_match_the_feature_table(spark, panel):
    """What a step computes equals the table built on history plus an open row."""
    from seriesloom.operators.features import full_feature_list, full_features

    features = full_feature_list(WHOLE)
    names = [f.name for f in features]
    seen = []

    def remember(df):
        seen.append(df.select("series_key", *names))
        return df.withColumn("prediction", F.lit(500.0))

    steps = recursion.recursive_steps(panel, WHOLE, features, remember, 2)
    open_rows = steps.withColumn(
        "population", F.when(F.col("year") < 2025, F.col("population"))
    ).select(*WHOLE.columns)
    table = full_features(panel.unionByName(open_rows), WHOLE).filter("year = 2025")
    expected = by_key(table.select("series_key", *names), "series_key")
    for got, wanted in zip(by_key(seen[1], "series_key"), expected, strict=True):
        assert list(got) == pytest.approx(list(wanted))
