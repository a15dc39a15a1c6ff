"""Model features of a panel: lags, changes, ratios and trailing means.

The feature list is data (:class:`Feature`), rendered against whatever holds the
current and previous values: lag columns here, the carried state in a forecast.
Everything but the lags is a projection, so a feature table costs one window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from seriesloom.functions.arithmetic import lenient_double, mean_of, pct_change, safe_ratio
from seriesloom.operators.history import lag_name, with_lags
from seriesloom.spec import PanelSpec

LOOKBACK = 3
WINDOWS = (2, 3)

# Names of the features that combine the drivers.
RATIO = "birth_death_ratio"
NATURAL = "natural_growth"
TOTAL = "total_growth"

FEATURE_SETS = ("causal", "full", "basic")

# value(column, rows back) -> expression
ValueAt = Callable[[str, int], Column]


@dataclass(frozen=True)
class Feature:
    name: str
    kind: str
    column: str | None = None
    rows: int = 0

    def reads_current(self, column: str) -> bool:
        return self.column == column and self.kind in ("change", "difference", "mean")


def basic_feature_list(spec: PanelSpec, lookback: int = LOOKBACK) -> list[Feature]:
    """Drivers and all lags: 15 features for a lookback of 3."""
    drivers = [Feature(d, "value", d) for d in spec.drivers]
    return drivers + [f for back in range(1, lookback + 1) for f in _lag_list(spec, back)]


def full_feature_list(
    spec: PanelSpec, lookback: int = LOOKBACK, windows: Sequence[int] = WINDOWS
) -> list[Feature]:
    """Everything: 35 features for a lookback of 3 and windows of 2 and 3 rows."""
    features = [Feature(d, "value", d) for d in spec.drivers]
    features.append(Feature(f"{spec.order_col}_squared", "square", spec.order_col))
    changes = [
        Feature(f"{v}_{suffix}", kind, v, 1)
        for v in spec.variables
        for suffix, kind in (("yoy_change", "change"), ("diff", "difference"))
    ]
    # Fixed value: the order of the features, with the changes after the first lags.
    first, *others = [_lag_list(spec, back) for back in range(1, lookback + 1)] or [[]]
    features += first + changes + [f for lags in others for f in lags]
    features += [Feature(RATIO, "ratio"), Feature(NATURAL, "natural"), Feature(TOTAL, "total")]
    features += [Feature(f"{v}_ma_{k}", "mean", v, k) for k in windows for v in spec.variables]
    return features


def feature_list(
    spec: PanelSpec,
    feature_set: str = "causal",
    lookback: int = LOOKBACK,
    windows: Sequence[int] = WINDOWS,
) -> list[Feature]:
    """Features a model is trained on.

    ``causal`` leaves out the features computed from the target of the row
    itself, which a forecast cannot know; ``full`` keeps them.
    """
    if feature_set not in FEATURE_SETS:
        raise ValueError(f"feature_set must be one of {FEATURE_SETS}, not {feature_set!r}")
    if feature_set == "basic":
        return basic_feature_list(spec, lookback)
    features = full_feature_list(spec, lookback, windows)
    if feature_set == "full":
        return features
    return [f for f in features if not f.reads_current(spec.target)]


def _lag_list(spec: PanelSpec, back: int) -> list[Feature]:
    return [Feature(lag_name(v, back), "lag", v, back) for v in spec.variables]


def depth_of(features: Sequence[Feature]) -> int:
    """How many previous rows the features read."""
    reach = {"lag": 0, "change": 0, "difference": 0, "mean": -1}
    return max((f.rows + reach[f.kind] for f in features if f.kind in reach), default=0)


def render(feature: Feature, spec: PanelSpec, value: ValueAt, zero_base: str = "null") -> Column:
    """Expression of one feature, missing where its inputs are."""
    birth, death, migration = spec.drivers
    column, rows = feature.column, feature.rows
    match feature.kind:
        case "value":
            return value(column, 0)
        case "square":
            # as a double: the square of a period in milliseconds is no bigint
            period = value(column, 0).cast("double")
            return period * period
        case "lag":
            return value(column, rows)
        case "change":
            return pct_change(value(column, 0), value(column, rows), zero_base)
        case "difference":
            return value(column, 0) - value(column, rows)
        case "ratio":
            return safe_ratio(value(birth, 0), value(death, 0))
        case "natural":
            return value(birth, 0) - value(death, 0)
        case "total":
            return value(birth, 0) - value(death, 0) + value(migration, 0)
        case "mean":
            return mean_of([value(column, back) for back in reversed(range(rows))])
    raise ValueError(f"unknown kind of feature: {feature.kind!r}")


def render_filled(
    feature: Feature, spec: PanelSpec, value: ValueAt, zero_base: str = "null"
) -> Column:
    """As :func:`render`, with 0 for missing values in all but the drivers themselves."""
    expression = render(feature, spec, value, zero_base)
    if feature.kind == "value":
        return expression
    return F.coalesce(expression, F.lit(0.0))


def lag_columns_at(column: str, back: int) -> Column:
    """Values held in the columns that ``with_lags`` adds."""
    return F.col(lag_name(column, back) if back else column)


def select_features(
    df: DataFrame,
    spec: PanelSpec,
    features: Sequence[Feature],
    zero_base: str = "null",
    filled: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Key, period, target, the given features and the columns to keep, in that order."""
    make = render_filled if filled else render
    lagged = with_lags(df, spec, depth_of(features))
    value = cache(lag_columns_at)
    made = [make(f, spec, value, zero_base).alias(f.name) for f in features]
    return lagged.select(spec.series_key, spec.order_col, spec.target, *made, *keep)


def with_numeric_values(
    df: DataFrame, spec: PanelSpec, columns: Sequence[str] | None = None
) -> DataFrame:
    """Target and drivers as doubles; what cannot be read, and NaN, becomes missing."""
    columns = spec.variables if columns is None else columns
    text = {c: isinstance(df.schema[c].dataType, StringType) for c in columns}
    return df.withColumns({c: lenient_double(F.col(c), text[c]) for c in columns})


def basic_features(df: DataFrame, spec: PanelSpec, lookback: int = LOOKBACK) -> DataFrame:
    """Drivers and lags; rows with any missing value are dropped."""
    features = basic_feature_list(spec, lookback)
    numeric = with_numeric_values(df, spec)
    return select_features(numeric, spec, features, filled=False).na.drop("any")


def full_features(
    df: DataFrame,
    spec: PanelSpec,
    lookback: int = LOOKBACK,
    windows: Sequence[int] = WINDOWS,
    zero_base: str = "null",
) -> DataFrame:
    """All features for all rows; missing derived values become 0."""
    features = full_feature_list(spec, lookback, windows)
    return select_features(with_numeric_values(df, spec), spec, features, zero_base)


def feature_matrix(features: DataFrame, spec: PanelSpec) -> DataFrame:
    """Only the model inputs: everything but key, period and target."""
    return features.drop(spec.series_key, spec.order_col, spec.target)
