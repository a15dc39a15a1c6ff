import pathlib
import re

import pytest

import seriesloom
from panels import SCHEMA, WHOLE, make, random_rows
from plans import check, count, executed
from seriesloom.operators import features, history, metrics, model, recursion, split, trend
from seriesloom.plans import queries
from seriesloom.session import written


AVOIDED = ("localCheckpoint", ".collect()", "toPandas", ".rdd", "crossJoin", "broadcast(")


@pytest.fixture(scope="module")
def stored(spark):
    return written(make(spark, random_rows(1), SCHEMA))


@pytest.mark.parametrize(
    "operator",
    [
        features.full_features,
        features.basic_features,
        split.split_time_ordered,
        split.split_random,
        trend.trend_forecast,
        model.training_table,
        lambda df, spec: history.last_rows(df, spec, 3),
        lambda df, spec: history.with_min_length(df, spec, 3),
        lambda df, spec: metrics.score_by_series(metrics.trend_predictions(df, spec), spec),
    ],
)
def test_one_shuffle_for_whole_series(stored, operator):
    df = operator(stored, WHOLE)
    check(df)
    assert count(executed(df), "Exchange") == 1


def test_all_features_share_one_window(stored):
    plan = executed(features.full_features(stored, WHOLE))
    assert count(plan, "Window") == count(plan, "Sort") == 1


def test_last_rows_are_cut_before_the_shuffle(stored):
    plan = executed(history.last_rows(stored, WHOLE, 3))
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


@pytest.mark.parametrize("operator", [features.full_features, split.split_time_ordered])
def test_rows_of_blocks_are_never_shuffled_by_series_alone(stored, operator):
    plan = executed(operator(stored, WHOLE.with_pieces(7)))
    for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan):
        if "__piece" not in keys:
            # only the list of blocks is ordered per series
            assert keys.startswith("series_key")
    assert plan.count("__piece") > 2


def test_steps_of_a_forecast_do_not_shuffle(stored):
    picked = features.full_feature_list(WHOLE)
    rule = recursion.mean_of_lags(WHOLE, picked)

    def shuffles(horizon):
        steps = recursion.recursive_steps(stored, WHOLE, picked, rule, horizon)
        return count(executed(steps), "Exchange")

    assert shuffles(1) == shuffles(6)


def test_scans_read_only_what_they_need(spark):
    folder = "/root/testdata/sf0.001"
    if not pathlib.Path(folder).is_dir():
        pytest.skip("no test tables")
    plan = executed(queries.days(spark, folder))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in (
        plan
    )
    plan = executed(queries.months(spark, folder))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan
    assert "PushedFilters: [IsNotNull(c_custkey)]" in plan


def test_package_keeps_to_distributed_work():
    # the text operators have checks of their own
    package = pathlib.Path(seriesloom.__file__).parent
    for path in (p for p in package.rglob("*.py") if "llm" not in p.parts):
        text = path.read_text()
        for name in AVOIDED:
            assert name not in text, (path.name, name)
