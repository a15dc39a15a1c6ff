"""Continued boosting, penalised leaves, and trees as a table."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from panels import WHOLE, by_key, make
from seriesloom.operators import boosting, model, recursion, trees
from seriesloom.sources import versions
from test_model import SMALL, wave


@pytest.fixture(scope="module")
def panel(spark):
    return make(spark, wave()).cache()


@pytest.fixture(scope="module")
def rows(spark, panel):
    table = model.training_table(panel, WHOLE).filter("not is_test")
    names = [f.name for f in model.FeatureChoice().features(WHOLE)]
    made = VectorAssembler(inputCols=names, outputCol="features").transform(table)
    return made.select("features", F.col("population").alias("label"), "is_validation").cache()


SETTINGS = {"learning_rate": 0.3, "depth": 3}


def predictions(ensemble, rows):
    return [r[0] for r in ensemble.transform(rows).select("prediction").collect()]


def test_same_as_sparks_boosting_without_a_penalty(rows):
    booster = boosting.Booster(rows, **SETTINGS)
    booster.grow(3)
    booster.grow(4)
    fit_rows = rows.filter("not is_validation")
    whole = GBTRegressor(labelCol="label", maxIter=7, stepSize=0.3, maxDepth=3, seed=42).fit(fit_rows)
    assert predictions(booster.ensemble(), rows) == pytest.approx(predictions(whole, rows), rel=1e-12)
    unseen = rows.filter("is_validation")
    assert booster.errors == pytest.approx(whole.evaluateEachIteration(unseen, "squared"), rel=1e-9)
    scored = [r[0] for r in booster.state.select("score").collect()]
    assert sorted(scored) == pytest.approx(sorted(predictions(whole, rows)), rel=1e-12)


@pytest.mark.parametrize("penalty", [0.0, 2.5])
def test_segments_do_not_matter(rows, penalty):
    found = []
    for lengths in ([5], [2, 3], [1, 1, 1, 1, 1]):
        booster = boosting.Booster(rows, **SETTINGS, penalty=penalty)
        for length in lengths:
            booster.grow(length)
        found.append(predictions(booster.ensemble(), rows))
        assert booster.trained == len(booster.errors) == 5
        booster.close()
    assert found[1] == pytest.approx(found[0], rel=1e-12)
    assert found[2] == pytest.approx(found[0], rel=1e-12)


def test_penalised_leaves_of_one_split(rows):
    """Sums over rows plus the penalty, the first tree's drawn to the mean."""
    booster = boosting.Booster(rows, learning_rate=0.5, depth=1, penalty=3.0)
    booster.grow(2)
    known = rows.filter("not is_validation").collect()
    mean = sum(r.label for r in known) / len(known)
    score = {}
    for number, made in enumerate(booster.rounds):
        root = made.tree._java_obj.rootNode()
        feature, threshold = root.split().featureIndex(), root.split().threshold()
        weight, centre = (0.5, 0.0) if number else (1.0, mean)
        for side in (True, False):
            own = [r for r in known if (r.features[feature] <= threshold) == side]
            left = [2 * (r.label - score[r]) if number else r.label for r in own]
            value = centre + sum(x - centre for x in left) / (len(own) + 3)
            assert made.values[not side] == pytest.approx(value, rel=1e-9)
            for r in own:
                score[r] = score.get(r, 0) + weight * value
    ensemble = booster.ensemble()
    found = ensemble.transform(rows.filter("not is_validation")).collect()
    assert [r.prediction for r in found] == pytest.approx([score[k] for k in known], rel=1e-9)
    large = boosting.Booster(rows, learning_rate=0.5, depth=1, penalty=1e12)
    large.grow(1)
    assert predictions(large.ensemble(), rows) == pytest.approx([mean] * rows.count())


def test_a_round_reads_the_rows_for_its_tree_alone(spark, rows):
    """Leaf sums take no job of their own, and nothing stays cached."""
    context, booster = spark.sparkContext, boosting.Booster(rows, **SETTINGS, penalty=3.0)
    fit = booster.regressor.fit

    def counted(training):
        context.setJobGroup("trees of a segment", "")
        try:
            return fit(training)
        finally:
            context.setJobGroup("rest of a segment", "")

    booster.regressor.fit = counted
    before = len(context._jsc.sc().getPersistentRDDs().keys().toList().mkString(",").split(","))
    context.setJobGroup("rest of a segment", "")
    try:
        booster.grow(6)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # the write of the scores and the errors of all rounds
    assert len(context.statusTracker().getJobIdsForGroup("rest of a segment")) <= 4
    after = len(context._jsc.sc().getPersistentRDDs().keys().toList().mkString(",").split(","))
    assert after <= before
    for made in booster.rounds:
        leaf = made.tree.transform(rows.filter("not is_validation")).groupBy("leaf").count().collect()
        assert [n for _, n in sorted((r["leaf"], r["count"]) for r in leaf)] == boosting.leaf_rows(made.tree)
    booster.close()


@pytest.mark.parametrize(
    ("errors", "patience", "rounds"),
    [
        ([5.0, 4.0, 3.0], 2, 3),
        ([5.0, 4.0, 4.5, 4.2, 1.0], 2, 2),
        ([5.0, 4.0, 4.5, 4.2, 1.0], 3, 5),
        ([5.0, 6.0], 1, 1),
        ([3.0, 3.0, 3.0], 5, 1),
    ],
)
def test_best_round(errors, patience, rounds):
    assert boosting.best_round(errors, patience) == rounds


def test_first_idle_round(rows):
    assert boosting.first_idle_round([5.0, 4.0, 3.0], 0.0) == (3, False)
    assert boosting.first_idle_round([5.0, 4.0, 4.0], 0.1) == (2, True)
    assert boosting.first_idle_round([5.0, 4.0, 4.5, 1.0], 0.0) == (2, True)
    # Spark's trainer stops at the same round
    own = GBTRegressor(
        labelCol="label", maxIter=40, stepSize=0.05, maxDepth=3, seed=42,
        validationIndicatorCol="is_validation", validationTol=0.0,
    ).fit(rows)
    booster = boosting.Booster(rows, learning_rate=0.05, depth=3)
    assert boosting.grow_until(booster, 40, None, 0.0) == own.getNumTrees


def test_no_more_rounds_than_kept_and_waited_for(monkeypatch, rows):
    """Each round is trained once, and none beyond the best one plus the patience."""
    for rate, patience in ((0.3, 6), (0.02, 5)):
        booster = boosting.Booster(rows, learning_rate=rate, depth=2, penalty=1.0)
        kept = boosting.grow_until(booster, 60, patience)
        assert booster.trained == len(booster.rounds) == min(60, kept + patience)
        assert kept == boosting.best_round(booster.errors, patience)
        assert min(booster.errors) == booster.errors[kept - 1]
    monkeypatch.setattr(boosting, "SEGMENT", 3)
    again = boosting.Booster(rows, learning_rate=rate, depth=2, penalty=1.0)
    assert boosting.grow_until(again, 60, patience) == kept and again.trained == booster.trained


@pytest.mark.parametrize("penalty", [0.0, 2.0])
def test_training_goes_on_from_a_checkpoint(rows, tmp_path, monkeypatch, penalty):
    monkeypatch.setattr(boosting, "SEGMENT", 4)
    folder = str(tmp_path / "rounds")
    whole = boosting.Booster(rows, **SETTINGS, penalty=penalty)
    boosting.grow_until(whole, 10, None)

    first = boosting.Booster(rows, **SETTINGS, penalty=penalty, checkpoint=folder)
    fit, calls = first.regressor.fit, []

    class Stopping:
        def fit(self, df):
            calls.append(1)
            if len(calls) == 7:
                raise RuntimeError("the job is lost in its second segment")
            return fit(df)

    first.regressor = Stopping()
    with pytest.raises(RuntimeError):
        boosting.grow_until(first, 10, None)

    second = boosting.Booster(rows, **SETTINGS, penalty=penalty, checkpoint=folder)
    assert len(second.rounds) == len(second.errors) == 4
    boosting.grow_until(second, 10, None)
    assert second.trained == 6
    assert predictions(second.ensemble(), rows) == pytest.approx(predictions(whole.ensemble(), rows), rel=1e-12)
    assert second.errors == pytest.approx(whole.errors, rel=1e-9)
    # ten rounds are there: nothing is trained for fewer, and two for twelve
    third = boosting.Booster(rows, **SETTINGS, penalty=penalty, checkpoint=folder)
    assert boosting.grow_until(third, 6, None) == 6 and third.trained == 0
    assert boosting.grow_until(third, 12, None) == 12 and third.trained == 2
    with pytest.raises(ValueError):
        boosting.Booster(rows, learning_rate=0.1, depth=3, penalty=penalty, checkpoint=folder)
    assert versions.exists(rows.sparkSession, folder)


def test_training_a_model_longer(panel, tmp_path):
    folder, settings = str(tmp_path / "rounds"), {**SMALL, "early_stopping_rounds": 0}
    model.train(panel, WHOLE, settings, checkpoint=folder)
    longer = model.train(panel, WHOLE, {**settings, "iterations": 9}, checkpoint=folder)
    at_once = model.train(panel, WHOLE, {**settings, "iterations": 9})
    keys = ["series_key", "year"]
    got, want = by_key(longer.scored), by_key(at_once.scored)
    assert [[r[k] for k in keys] for r in got] == [[r[k] for k in keys] for r in want]
    assert [r["prediction"] for r in got] == pytest.approx([r["prediction"] for r in want], rel=1e-12)
    assert longer.pipeline.stages[-1].getNumTrees == 9


def test_refit_trains_on_the_deciding_rows_too(panel):
    settings = {**SMALL, "iterations": 12, "early_stopping_rounds": 3, "refit": True}
    stopped = model.train(panel, WHOLE, settings)
    count = stopped.pipeline.stages[-1].getNumTrees
    fit_rows = model.training_table(panel, WHOLE).filter("not is_test").withColumn("is_validation", F.lit(False))
    unstopped = {**settings, "iterations": count, "early_stopping_rounds": 0}
    again = model.fit(fit_rows, WHOLE, stopped.choice, model.BoostingParams().override(unstopped))
    keys = ["series_key", "year", "prediction"]
    got = by_key(again.predict(model.training_table(panel, WHOLE)).select(keys))
    want = by_key(stopped.scored.select(keys))
    assert [r["prediction"] for r in got] == pytest.approx([r["prediction"] for r in want], rel=1e-12)


def test_patience_outlasts_the_first_bad_round(panel):
    settings = {"iterations": 80, "depth": 3, "learning_rate": 0.05, "early_stopping_rounds": 10}
    rounds = {
        rule: model.train(panel, WHOLE, {**settings, "stopping": rule}).pipeline.stages[-1].getNumTrees
        for rule in ("tolerance", "patience")
    }
    assert model.BoostingParams().stopping == "patience"
    assert rounds["patience"] >= rounds["tolerance"]


@pytest.mark.parametrize("penalty", [0.0, 3.0])
def test_trees_as_a_table(spark, panel, penalty):
    trained = model.train(panel, WHOLE, {**SMALL, "l2_leaf_reg": penalty})
    nodes = trees.tree_table(trained).cache()
    roots = nodes.filter("node = 0").orderBy("tree").collect()
    assert [r["weight"] for r in roots] == [1.0, *[0.3] * (len(roots) - 1)]
    known = trained.scored.filter("not is_test and not is_validation").count()
    assert all(r["rows"] == known for r in roots)
    inner = nodes.filter("left is not null").alias("n")
    for side in ("left", "right"):
        child = nodes.select("tree", F.col("node").alias(side), F.col("rows").alias("below"))
        joined = inner.join(child, ["tree", side])
        assert joined.count() == inner.count() and joined.filter("below >= rows").isEmpty()
    assert nodes.filter("left is null and (feature is not null or threshold is not null)").isEmpty()

    table = model.training_table(panel, WHOLE)
    joined = trees.predictor(trained, nodes, ["series_key", "year"])(table)
    keys = ["series_key", "year", "prediction"]
    got, want = by_key(joined.select(keys)), by_key(trained.predict(table).select(keys))
    assert [r["prediction"] for r in got] == pytest.approx([r["prediction"] for r in want], rel=1e-12)

    own = {r["feature"]: r["importance"] for r in model.feature_importance(trained).collect()}
    assert {r["feature"]: r["importance"] for r in trees.importances(trained, nodes).collect()} == pytest.approx(own)

    steps = recursion.recursive_steps(
        panel, WHOLE, trained.choice.features(WHOLE), trees.predictor(trained, nodes, ["series_key"]), 3, steps_per_plan=1
    )
    forecast = recursion.recursive_forecast(panel, trained, 3)
    assert [r["population"] for r in by_key(steps)] == pytest.approx([r["population"] for r in by_key(forecast)])


def test_a_tree_without_a_split(spark, panel):
    trained = model.train(panel, WHOLE, {"depth": 0, "iterations": 2, "early_stopping_rounds": 0})
    nodes = trees.tree_table(trained)
    assert nodes.count() == 2
    table = model.training_table(panel, WHOLE)
    joined = trees.predictor(trained, nodes, ["series_key", "year"])(table)
    assert joined.select("prediction").distinct().count() == 1
    assert {r["importance"] for r in trees.importances(trained, nodes).collect()} == {0.0}
