import math

import pytest

from panels import WHOLE, by_key, make, one_series
from seriesloom.operators import metrics, split


@pytest.mark.parametrize(("rows", "size"), [(10, 0.2), (10, 0.9), (7, 0.2), (1, 0.5), (13, 0.33)])
def test_time_ordered_sizes(spark, rows, size):
    panel = one_series(spark, [float(i) for i in range(rows)])
    flags = [r["is_test"] for r in by_key(split.split_time_ordered(panel, WHOLE, size))]
    train = int(rows * (1 - size))
    assert flags == [False] * train + [True] * (rows - train)


@pytest.mark.parametrize(("rows", "size"), [(7, 0.2), (10, 0.2), (10, 0.25), (3, 0.5)])
def test_random_sizes_and_seed(spark, rows, size):
    panel = one_series(spark, [float(i) for i in range(rows)])

    def chosen(seed):
        made = split.split_random(panel, WHOLE, size, seed).filter("is_test")
        return {r["year"] for r in made.collect()}

    assert len(chosen(42)) == math.ceil(rows * size)
    assert chosen(42) == chosen(42)
    assert len({frozenset(chosen(seed)) for seed in range(8)}) > 1


@pytest.mark.parametrize("size", [0, 1, -0.1, 1.5])
def test_size_is_checked(spark, size):
    with pytest.raises(ValueError):
        split.split_time_ordered(one_series(spark, [1.0]), WHOLE, size)


def test_measures(spark):
    rows = [
        (1, 1, 10.0, 12.0, False),
        (1, 2, 20.0, 17.0, False),
        (1, 3, 30.0, 30.0, True),
        (1, 4, 40.0, 38.0, True),
        (2, 1, 5.0, 4.0, False),
        (2, 2, 5.0, 5.0, False),
        (2, 3, None, 5.0, True),
    ]
    schema = "series_key long, year int, population double, prediction double, is_test boolean"
    scored = make(spark, rows, schema)
    first, second = by_key(metrics.score_by_series(scored, WHOLE), "series_key")
    assert first["train_mae"] == 2.5
    assert first["train_rmse"] == pytest.approx(math.sqrt(6.5))
    assert first["train_r2"] == pytest.approx(1 - 13 / 50)
    assert first["test_mae"] == 1.0
    assert first["test_r2"] == pytest.approx(1 - 4 / 50)
    assert second["train_r2"] is None
    assert second["test_mae"] is None
    overall = metrics.score(scored, WHOLE, measures=("mae",)).first()
    assert overall.asDict() == {"train_mae": 1.5, "test_mae": 1.0}
