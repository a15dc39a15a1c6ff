"""New rows of a panel without a second look at the old ones.

What later rows need of a series is a row of state: how many rows it has, the
last few of them, and the moments of its lines. States of two stretches of a
panel merge into the state of both, so appending a day reads the states and the
day's rows, and gives the features, positions and lines that the whole panel
would.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.operators.features import (
    LOOKBACK,
    Feature,
    depth_of,
    full_feature_list,
    select_features,
    with_numeric_values,
)
from seriesloom.operators.history import cut, last_rows, with_positions
from seriesloom.sources import versions
from seriesloom.spec import PanelSpec

# Moments of a line: rows with both values, means, and sums of products about them.
_PARTS = ("n", "mean_x", "mean_y", "sxx", "sxy")


def _moments(column: str) -> str:
    return f"{column}_moments"


def state_of(panel: DataFrame, spec: PanelSpec, depth: int = LOOKBACK) -> DataFrame:
    """One row per series: rows, last_period, the last ``depth`` rows newest first, and moments.

    Partial sums are taken before the shuffle, and of the rows of a series each
    task sends on the last ones only.
    """
    key, period = spec.series_key, spec.order_col
    numeric = with_numeric_values(panel, spec).select(*spec.columns)
    x = (F.col(period) - F.lit(spec.origin)).cast("double")
    moments = [
        F.struct(
            F.regr_count(v, x).alias("n"),
            F.regr_avgx(v, x).alias("mean_x"),
            F.regr_avgy(v, x).alias("mean_y"),
            F.regr_sxx(v, x).alias("sxx"),
            F.regr_sxy(v, x).alias("sxy"),
        ).alias(_moments(v))
        for v in spec.variables
    ]
    sums = numeric.groupBy(key).agg(
        F.count("*").alias("rows"), F.max(period).alias("last_period"), *moments
    )
    row = F.struct(period, *spec.variables)
    ends = last_rows(numeric, spec, depth).groupBy(key).agg(
        F.sort_array(F.collect_list(row), asc=False).alias("last")
    )
    return sums.join(ends, key)


def _merged_moments(a: Column, b: Column) -> Column:
    """Moments of two sets of points from those of each."""
    n = a["n"] + b["n"]
    dx, dy = b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"]
    share, weight = b["n"] / n, a["n"].cast("double") * b["n"] / n
    both = F.struct(
        n.alias("n"),
        (a["mean_x"] + dx * share).alias("mean_x"),
        (a["mean_y"] + dy * share).alias("mean_y"),
        (a["sxx"] + b["sxx"] + dx * dx * weight).alias("sxx"),
        (a["sxy"] + b["sxy"] + dx * dy * weight).alias("sxy"),
    )

    def empty(side: Column) -> Column:
        return side.isNull() | (side["n"] == 0)

    return F.when(empty(a), F.coalesce(b, a)).when(empty(b), a).otherwise(both)


def merged(state: DataFrame, newer: DataFrame, spec: PanelSpec, depth: int = LOOKBACK) -> DataFrame:
    """The state of both stretches, where each series' rows in ``newer`` follow those in ``state``."""
    key = spec.series_key
    a, b = state.alias("a"), newer.alias("b")
    none = F.array().cast(state.schema["last"].dataType)
    last = F.concat(F.coalesce("b.last", none), F.coalesce("a.last", none))
    moments = [
        _merged_moments(F.col(f"a.{_moments(v)}"), F.col(f"b.{_moments(v)}")).alias(_moments(v))
        for v in spec.variables
    ]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(
        F.coalesce(f"a.{key}", f"b.{key}").alias(key),
        (F.coalesce("a.rows", F.lit(0)) + F.coalesce("b.rows", F.lit(0))).alias("rows"),
        F.coalesce("b.last_period", "a.last_period").alias("last_period"),
        *moments,
        F.slice(last, 1, depth).alias("last"),
    )


def lines_of(state: DataFrame, spec: PanelSpec) -> DataFrame:
    """``{column}_slope`` and ``{column}_intercept`` per series, as a fit of all its rows gives them."""
    fits = []
    for v in spec.variables:
        m = F.col(_moments(v))
        slope = m["sxy"] / F.nullif(m["sxx"], F.lit(0.0))
        fits += [
            slope.alias(f"{v}_slope"),
            (m["mean_y"] - slope * m["mean_x"]).alias(f"{v}_intercept"),
        ]
    return state.select(spec.series_key, *fits)


@dataclass(frozen=True)
class Appended:
    """What appending rows gives.

    ``features`` and ``positions`` are those of the new rows alone, ``state`` is
    that of all rows. ``late`` are rows that do not follow their series' last
    one: they are in none of the others and need that series to be built anew.
    """

    features: DataFrame
    positions: DataFrame
    state: DataFrame
    late: DataFrame


def append(
    state: DataFrame,
    rows: DataFrame,
    spec: PanelSpec,
    features: Sequence[Feature] | None = None,
    depth: int = LOOKBACK,
    filled: bool = True,
) -> Appended:
    """Append ``rows`` to the panel that ``state`` stands for.

    ``state`` must have been made with this ``depth``, which must reach as far
    back as the features do. Series may be new, and may have any number of rows.
    """
    features = full_feature_list(spec) if features is None else list(features)
    if depth_of(features) > depth:
        raise ValueError(f"the features look back {depth_of(features)} rows, the state holds {depth}")
    key, period = spec.series_key, spec.order_col
    numeric = with_numeric_values(rows, spec).select(*spec.columns)
    known = numeric.join(state.select(key, "last_period", F.col("rows").alias("__before")), key, "left")
    follows = F.col("last_period").isNull() | (F.col(period) > F.col("last_period"))
    fresh = known.filter(follows).select(*spec.columns)
    late = known.filter(~follows).select(*spec.columns)

    touched = state.join(fresh.select(key).distinct(), key, "left_semi")
    carried = touched.select(key, F.inline("last")).select(*spec.columns, F.lit(False).alias("__new"))
    both = carried.unionByName(fresh.withColumn("__new", F.lit(True)))
    made = select_features(both, spec, features, filled=filled, keep=["__new"])

    numbered = with_positions(cut(fresh, spec), spec).join(
        state.select(key, F.col("rows").alias("__before")), key, "left"
    )
    before = F.coalesce("__before", F.lit(0))
    positions = numbered.select(
        key, period, (F.col("position") + before).alias("position"), (F.col("length") + before).alias("length")
    )
    return Appended(
        features=made.filter("__new").drop("__new"),
        positions=positions,
        state=merged(state, state_of(fresh, spec, depth), spec, depth),
        late=late,
    )


def append_all(state: DataFrame, stretches: Sequence[DataFrame], spec: PanelSpec, depth: int = LOOKBACK) -> DataFrame:
    """The state after several stretches, each later than the one before."""
    return reduce(lambda s, rows: merged(s, state_of(rows, spec, depth), spec, depth), stretches, state)


def save_state(state: DataFrame, path: str) -> None:
    """Write the state as a version of its own; it counts from the moment it is whole."""
    spark = state.sparkSession
    former, version = versions.committed(spark, path), versions.fresh(path)
    state.write.parquet(version)
    name = version.rsplit("/", 1)[1]
    versions.commit(spark, path, name)
    # the former one may still be read
    versions.remove_others(spark, path, {name, former})


def load_state(spark: SparkSession, path: str) -> DataFrame:
    name = versions.committed(spark, path)
    if name is None:
        raise ValueError(f"there is no saved state in {path}")
    return spark.read.parquet(f"{path}/{name}")
