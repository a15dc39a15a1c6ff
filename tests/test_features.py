import math

import pytest
from pyspark.sql import functions as F

from panels import SCHEMA, WHOLE, by_key, make, one_series, random_rows
from seriesloom.functions.arithmetic import lenient_double
from seriesloom.operators import features
from seriesloom.spec import PanelSpec


def test_feature_names_in_order():
    names = [f.name for f in features.full_feature_list(WHOLE)]
    assert len(names) == 35 == len(set(names))
    assert names[:8] == [
        "birth_rate",
        "death_rate",
        "migration_rate",
        "year_squared",
        "population_lag_1",
        "birth_rate_lag_1",
        "death_rate_lag_1",
        "migration_rate_lag_1",
    ]
    assert names[8:12] == [
        "population_yoy_change",
        "population_diff",
        "birth_rate_yoy_change",
        "birth_rate_diff",
    ]
    assert names[24:] == [
        "birth_death_ratio",
        "natural_growth",
        "total_growth",
        "population_ma_2",
        "birth_rate_ma_2",
        "death_rate_ma_2",
        "migration_rate_ma_2",
        "population_ma_3",
        "birth_rate_ma_3",
        "death_rate_ma_3",
        "migration_rate_ma_3",
    ]


def test_causal_features_leave_out_the_current_target():
    full = {f.name for f in features.feature_list(WHOLE, "full")}
    causal = {f.name for f in features.feature_list(WHOLE, "causal")}
    assert full - causal == {
        "population_yoy_change",
        "population_diff",
        "population_ma_2",
        "population_ma_3",
    }
    assert len(features.feature_list(WHOLE, "basic")) == 15
    with pytest.raises(ValueError):
        features.feature_list(WHOLE, "other")


def test_causal_features_do_not_depend_on_the_current_target(spark):
    names = [f.name for f in features.feature_list(WHOLE, "causal")]
    made = [
        by_key(features.full_features(one_series(spark, [3.0, 5.0, 9.0, last]), WHOLE))[-1]
        for last in (1.0, 1000.0)
    ]
    assert [made[0][n] for n in names] == [made[1][n] for n in names]


def test_values(spark):
    rows = by_key(features.full_features(one_series(spark, [10.0, 15.0, 12.0, 18.0]), WHOLE))
    last = rows[3]
    assert last["year_squared"] == 2003 * 2003
    assert [last[f"population_lag_{i}"] for i in (1, 2, 3)] == [12.0, 15.0, 10.0]
    assert last["population_yoy_change"] == (18.0 / 12.0 - 1) * 100
    assert last["population_diff"] == 6.0
    assert last["population_ma_2"] == 15.0
    assert last["population_ma_3"] == 15.0
    assert last["birth_death_ratio"] == 13.0 / 11.0
    assert last["natural_growth"] == 2.0
    assert last["total_growth"] == 0.0
    for before, now in zip(rows, rows[1:]):
        assert now["population"] == now["population_lag_1"] + now["population_diff"]
        assert now["population_lag_1"] == before["population"]
    assert rows[0]["population_lag_1"] == rows[1]["population_ma_3"] == 0.0


def test_short_series(spark):
    three = one_series(spark, [1.0, 2.0, 3.0])
    assert features.basic_features(three, WHOLE).isEmpty()
    assert features.full_features(three, WHOLE).count() == 3
    assert features.basic_features(one_series(spark, [1.0] * 10), WHOLE).count() == 7


@pytest.mark.parametrize(
    ("now", "infinite"), [(5.0, float("inf")), (-5.0, float("-inf")), (0.0, 0.0)]
)
def test_change_from_zero(spark, now, infinite):
    panel = one_series(spark, [0.0, now])
    assert by_key(features.full_features(panel, WHOLE))[1]["population_yoy_change"] == 0.0
    signed = features.full_features(panel, WHOLE, zero_base="inf")
    assert by_key(signed)[1]["population_yoy_change"] == infinite


def test_zero_divisor(spark):
    panel = one_series(spark, [1.0, 2.0, 3.0], deaths=[0.0, 0.0, 4.0])
    ratios = [r["birth_death_ratio"] for r in by_key(features.full_features(panel, WHOLE))]
    assert ratios == [0.0, 0.0, 3.0]


def test_missing_target_at_the_end(spark):
    last = by_key(features.full_features(one_series(spark, [1.0, 2.0, 3.0, None]), WHOLE))[3]
    for name in ("yoy_change", "diff", "ma_2", "ma_3"):
        assert last[f"population_{name}"] == 0.0
    assert [last[f"population_lag_{i}"] for i in (1, 2, 3)] == [3.0, 2.0, 1.0]
    assert last["population"] is None


def test_missing_target_inside_is_not_padded(spark):
    rows = by_key(features.full_features(one_series(spark, [1.0, 2.0, None, 4.0, 6.0]), WHOLE))
    assert [r["population_yoy_change"] for r in rows] == [0.0, 100.0, 0.0, 0.0, 50.0]
    assert [r["population_ma_2"] for r in rows] == [0.0, 1.5, 0.0, 0.0, 5.0]
    assert [r["population_ma_3"] for r in rows] == [0.0] * 5


def test_missing_driver_is_kept(spark):
    panel = make(spark, [(1, 1, 1.0, None, 2.0, 3.0), (1, 2, 2.0, 4.0, 2.0, 3.0)])
    rows = by_key(features.full_features(panel, WHOLE))
    assert rows[0]["birth_rate"] is None
    assert rows[0]["natural_growth"] == 0.0
    assert rows[1]["birth_rate_diff"] == 0.0


def test_gap_is_the_previous_row(spark):
    panel = make(spark, [(1, t, float(t), 1.0, 1.0, 1.0) for t in (1, 2, 9, 10)])
    assert [r["population_diff"] for r in by_key(features.full_features(panel, WHOLE))] == [
        0.0,
        1.0,
        7.0,
        1.0,
    ]


def test_text_target_is_read_leniently(spark):
    schema = "series_key long, year int, population string, birth_rate double," + (
        "death_rate double, migration_rate double"
    )
    panel = make(spark, [(1, 1, "7", 1.0, 1.0, 1.0), (1, 2, "x", 1.0, 1.0, 1.0)], schema)
    rows = by_key(features.full_features(panel, WHOLE))
    assert [r["population"] for r in rows] == [7.0, None]


def test_other_names_lookback_and_windows(spark):
    spec = PanelSpec("shop", "week", "sales", ("a", "b", "c"), pieces=4)
    schema = "shop string, week int, sales double, a double, b double, c double"
    panel = make(spark, [("x", t, t * 1.0, 1.0, 2.0, 3.0) for t in range(9)], schema)
    made = features.full_features(panel, spec, lookback=1, windows=(5,))
    last = sorted(made.collect(), key=lambda r: r["week"])[-1]
    assert last["sales_ma_5"] == 6.0
    assert "sales_lag_2" not in made.columns
    assert features.feature_matrix(made, spec).columns[0] == "a"


def test_spec_is_checked():
    with pytest.raises(ValueError):
        PanelSpec(drivers=("a", "b"))
    with pytest.raises(ValueError):
        PanelSpec(pieces=-1)


def in_pandas(rows):
    """All features of one series, column by column."""
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["series_key", "year", *WHOLE.variables])
    frame = frame.sort_values("year").astype({v: float for v in WHOLE.variables})
    derived = {"year_squared": frame["year"].astype("int64") ** 2}
    for v in WHOLE.variables:
        column = frame[v]
        derived[f"{v}_yoy_change"] = column.pct_change(fill_method=None) * 100
        derived[f"{v}_diff"] = column.diff()
        for rows_back in (1, 2, 3):
            derived[f"{v}_lag_{rows_back}"] = column.shift(rows_back)
        for window in (2, 3):
            shifted = [column.shift(i) for i in reversed(range(window))]
            derived[f"{v}_ma_{window}"] = sum(shifted[1:], shifted[0]) / window
    birth, death, migration = (frame[d] for d in WHOLE.drivers)
    derived["birth_death_ratio"] = birth / death.where(death != 0)
    derived["natural_growth"] = birth - death
    derived["total_growth"] = birth - death + migration
    return frame.assign(**{name: values.fillna(0) for name, values in derived.items()})


@pytest.mark.parametrize("seed", [21, 22, 23])
@pytest.mark.parametrize("block", [None, 6])
def test_all_features_against_pandas(spark, seed, block):
    rows = random_rows(seed, series=3)
    spec = WHOLE.with_pieces(block)
    made = features.full_features(make(spark, rows), spec, zero_base="inf")
    got = {(r["series_key"], r["year"]): r.asDict() for r in made.collect()}
    assert len(got) == len(rows)
    for key in range(3):
        expected = in_pandas([r for r in rows if r[0] == key])
        assert set(expected.columns) == set(made.columns)
        for wanted in expected.to_dict("records"):
            row = got[key, wanted["year"]]
            for name, value in wanted.items():
                missing = value != value
                assert row[name] is None if missing else row[name] == value, name


def test_periods_in_milliseconds(spark):
    start = 1_700_000_000_000
    rows = [(1, start + 60_000 * i, float(i), 1.0, 2.0, 3.0) for i in range(5)]
    panel = spark.createDataFrame(rows, SCHEMA.replace("year int", "year long"))
    made = by_key(features.full_features(panel, WHOLE))
    assert [r["year_squared"] for r in made] == [float(r[1]) ** 2 for r in rows]


def test_not_a_number_is_missing(spark):
    rows = [(1, t, float("nan") if t == 2 else float(t), 1.0, float("nan") if t == 3 else 2.0, 3.0) for t in range(6)]
    empty = [(k, t, *[None if v != v else v for v in rest]) for k, t, *rest in rows]
    for operator in (features.full_features, features.basic_features):
        assert by_key(operator(make(spark, rows), WHOLE)) == by_key(operator(make(spark, empty), WHOLE))


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("1.5", 1.5), (" -2e3 ", -2000.0), (".5", 0.5), ("5.", 5.0), ("inf", math.inf), ("-Infinity", -math.inf),
        ("nan", None), ("1.0d", None), ("1f", None), ("x", None), ("", None), ("1 2", None), (None, None),
    ],
)
def test_numbers_in_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(lenient_double(F.col("v"))).first()[0] == number
