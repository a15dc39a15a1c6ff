"""Appending rows to states, against the whole panel built at once."""

import random

import pytest
from pyspark.sql import functions as F

from panels import SCHEMA, WHOLE, by_key, make, random_rows
from seriesloom.operators import append, features, history, trend


def stretches(rows, cuts):
    """The rows by period, cut at the given periods."""
    found = [[] for _ in range(len(cuts) + 1)]
    for row in rows:
        found[sum(row[1] >= c for c in cuts)].append(row)
    return found


@pytest.mark.parametrize("pieces", [None, 3])
@pytest.mark.parametrize("cuts", [[0], [-20, 10, 11], [-59, 200]])
def test_same_as_the_whole_panel(spark, pieces, cuts):
    spec = WHOLE.with_pieces(pieces)
    rows = random_rows(7, series=6)
    whole = make(spark, rows)
    wanted = {
        "features": {(r["series_key"], r["year"]): tuple(r) for r in features.full_features(whole, spec).collect()},
        "positions": {
            (r["series_key"], r["year"]): r["position"] for r in history.with_positions(whole, spec).collect()
        },
    }
    first, *later = stretches(rows, cuts)
    state = append.state_of(make(spark, first), spec)
    for part in later:
        done = append.append(state, make(spark, part), spec)
        assert done.late.isEmpty()
        seen = {(r["series_key"], r["year"]): tuple(r) for r in done.features.collect()}
        assert seen == {k: wanted["features"][k] for k in {r[:2] for r in part}}
        numbers = {(r["series_key"], r["year"]): r["position"] for r in done.positions.collect()}
        assert numbers == {k: wanted["positions"][k] for k in {r[:2] for r in part}}
        state = done.state
    rebuilt = append.state_of(whole, spec)
    got, want = by_key(state, "series_key"), by_key(rebuilt, "series_key")
    for a, b in zip(got, want, strict=True):
        assert (a["rows"], a["last_period"], a["last"]) == (b["rows"], b["last_period"], b["last"])
    lines = by_key(append.lines_of(state, spec), "series_key")
    fitted = by_key(trend.fit_lines(whole, spec), "series_key")
    for a, b in zip(lines, fitted, strict=True):
        for name, value in b.asDict().items():
            if value is None:
                assert a[name] is None
            else:
                assert a[name] == pytest.approx(value, rel=1e-9, abs=1e-9)


def test_late_rows_are_given_back(spark):
    old = make(spark, [(1, t, 1.0 * t, 1.0, 1.0, 1.0) for t in range(5)])
    state = append.state_of(old, WHOLE)
    new = [(1, 4, 9.0, 1.0, 1.0, 1.0), (1, 2, 9.0, 1.0, 1.0, 1.0), (1, 5, 6.0, 1.0, 1.0, 1.0), (2, 0, 7.0, 1.0, 1.0, 1.0)]
    done = append.append(state, make(spark, new), WHOLE)
    assert [r["year"] for r in by_key(done.late)] == [2, 4]
    assert [(r["series_key"], r["year"], r["population_lag_1"]) for r in by_key(done.features)] == [
        (1, 5, 4.0),
        (2, 0, 0.0),
    ]
    assert {r["series_key"]: r["rows"] for r in done.state.collect()} == {1: 6, 2: 1}


def test_nothing_new_and_nothing_old(spark):
    panel = make(spark, random_rows(3))
    none = make(spark, [], SCHEMA)
    state = append.state_of(panel, WHOLE)
    done = append.append(state, none, WHOLE)
    assert done.features.isEmpty() and done.positions.isEmpty() and done.late.isEmpty()
    assert by_key(done.state, "series_key") == by_key(state.select(done.state.columns), "series_key")
    begun = append.append(append.state_of(none, WHOLE), panel, WHOLE)
    assert begun.features.count() == panel.count()


def test_order_of_merging_does_not_matter(spark):
    parts = [make(spark, part) for part in stretches(random_rows(11, series=3), [-30, 0, 30])]
    one = append.append_all(append.state_of(parts[0], WHOLE), parts[1:], WHOLE)
    states = [append.state_of(p, WHOLE) for p in parts]
    halves = [append.merged(states[0], states[1], WHOLE), append.merged(states[2], states[3], WHOLE)]
    other = append.merged(*halves, WHOLE)
    got, want = (by_key(append.lines_of(s, WHOLE), "series_key") for s in (one, other))
    for a, b in zip(got, want, strict=True):
        assert list(a) == pytest.approx(list(b), rel=1e-9, abs=1e-9, nan_ok=True)


def test_saved_states_and_what_appending_reads(spark, tmp_path):
    rows = random_rows(5)
    path, more = str(tmp_path / "state"), str(tmp_path / "new")
    append.save_state(append.state_of(make(spark, rows), WHOLE), path)
    state = append.load_state(spark, path)
    random.Random(1).shuffle(rows)
    make(spark, [(k, 500, 1.0, 1.0, 1.0, 1.0) for k in {r[0] for r in rows}]).write.parquet(more)
    done = append.append(state, spark.read.parquet(more), WHOLE)
    read = {f.rsplit("/", 2)[0] for f in done.features.inputFiles()}
    assert all("/state" in f or f.endswith(str(tmp_path)) for f in read)
    append.save_state(done.state, path)
    assert append.load_state(spark, path).filter(F.col("last_period") == 500).count() == state.count()
    with pytest.raises(ValueError):
        append.load_state(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        append.append(state, make(spark, rows), WHOLE, features.full_feature_list(WHOLE, lookback=5))
