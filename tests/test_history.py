"""Cutting a panel into pieces never shows in a result."""

import math

import pytest

from panels import SCHEMA, WHOLE, by_key, make, random_rows
from plans import executed
from seriesloom.operators import features, history, metrics, report, split, trend

PIECES = (1, 3, 8, 40)


def plain(rows):
    def value(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return [tuple(value(v) for v in r) for r in rows]


@pytest.fixture(scope="module", params=[1, 2])
def panel(request, spark):
    return make(spark, random_rows(request.param), SCHEMA).cache()


OPERATORS = {
    "lags": lambda df, spec: history.with_lags(df, spec, 3),
    "deep_lags": lambda df, spec: history.with_lags(df, spec, 9, ["population"]),
    "positions": history.with_positions,
    "full_features": features.full_features,
    "basic_features": features.basic_features,
    "time_split": split.split_time_ordered,
    "random_split": split.split_random,
    "min_length": lambda df, spec: history.with_min_length(df, spec, 20),
    "last_rows": lambda df, spec: history.last_rows(df, spec, 3),
    "combined": lambda df, spec: report.history_and_forecast(
        df.na.fill(0.0), trend.line_forecast(df, spec), spec
    ),
}


@pytest.mark.parametrize("pieces", PIECES)
@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_cuts_do_not_show(panel, name, pieces):
    operator = OPERATORS[name]
    whole = operator(panel, WHOLE)
    cut = operator(panel, WHOLE.with_pieces(pieces))
    order = ("series_key", "Year") if name == "combined" else ("series_key", "year")
    assert cut.columns == whole.columns
    assert plain(by_key(cut, *order)) == plain(by_key(whole, *order))


@pytest.mark.parametrize("pieces", PIECES)
def test_cuts_do_not_show_in_errors(panel, pieces):
    def errors(spec):
        predicted = metrics.trend_predictions(panel, spec)
        return by_key(metrics.score_by_series(predicted, spec), "series_key")

    for cut, whole in zip(errors(WHOLE.with_pieces(pieces)), errors(WHOLE), strict=True):
        for name, value in whole.asDict().items():
            close = None if value is None else pytest.approx(value, rel=1e-9, abs=1e-9)
            assert cut[name] == close, name


def test_lags_against_brute_force(spark):
    rows = random_rows(11)
    got = {
        (r["series_key"], r["year"]): [r[f"population_lag_{i}"] for i in (1, 2, 3)]
        for r in history.with_lags(make(spark, rows), WHOLE.with_pieces(5), 3).collect()
    }
    series = {}
    for key, t, target, *_ in sorted(rows, key=lambda r: r[:2]):
        earlier = series.setdefault(key, [])
        padded = [None] * 3 + earlier
        assert got[key, t] == padded[:-4:-1]
        earlier.append(target)
    assert len(got) == len(rows)


@pytest.mark.parametrize("pieces", [2, 5, 13])
def test_lags_over_wide_gaps(spark, pieces):
    """Pieces of several rows, of few and of a single one."""
    periods = [0, 1, 2, 5, 99, 101, 130, 750, 2001, 2002, 2003, 2500, 9000]
    rows = [(1, t, float(t), 1.0, 1.0, 1.0) for t in periods]
    made = history.with_lags(make(spark, rows), WHOLE.with_pieces(pieces), 3)
    for place, row in enumerate(by_key(made)):
        before = [float(t) for t in periods[max(0, place - 3) : place]][::-1]
        got = [row[f"population_lag_{i}"] for i in (1, 2, 3)]
        assert got == before + [None] * (3 - len(before))


def test_random_split_ranks_by_digest(spark):
    import hashlib

    rows = random_rows(12)
    got = {
        (r["series_key"], r["year"])
        for r in split.split_random(make(spark, rows), WHOLE.with_pieces(5), 0.3, 7).collect()
        if r["is_test"]
    }
    expected = set()
    for key in {r[0] for r in rows}:
        periods = [r[1] for r in rows if r[0] == key]
        periods.sort(key=lambda t: hashlib.md5(f"{key}|{t}|7".encode()).hexdigest())
        expected |= {(key, t) for t in periods[: math.ceil(len(periods) * 0.3)]}
    assert got == expected


def test_input_order_and_other_series_do_not_matter(spark):
    rows = random_rows(5, series=2)
    one = [r for r in rows if r[0] == 0]
    altered = one + [(1, r[1], 1.0, *r[3:]) for r in rows if r[0] == 1]
    reference = plain(by_key(features.full_features(make(spark, sorted(one, key=str)), WHOLE)))
    for variant in (one, altered):
        made = features.full_features(make(spark, variant), WHOLE).filter("series_key = 0")
        assert plain(by_key(made)) == reference


@pytest.mark.parametrize("unit", [1, 86_400, 60_000])
def test_one_long_series_is_spread_over_tasks(spark, unit):
    """Whatever a period counts: rows, seconds with a row a day, milliseconds with a row a minute."""
    from pyspark.sql import functions as F

    rows = 20_000
    start = 0 if unit == 1 else 1_700_000_000
    panel = spark.range(rows).select(
        F.when(F.col("id") % 50 == 0, F.col("id") % 7 + 2).otherwise(1).alias("series_key"),
        (F.col("id") * unit + start).alias("year"),
        *[F.col("id").cast("double").alias(v) for v in WHOLE.variables],
    )
    pieces = history.cut(panel, WHOLE.with_pieces(16))
    sizes = [r["count"] for r in pieces.groupBy(history.PIECE).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * rows / 16
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        made = features.full_features(pieces, WHOLE)
        assert executed(made).count("FileScan") <= 2
        tasks = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(setting)
    assert sum(tasks) == rows
    assert max(tasks) < rows / 2
