"""Error measures of predictions, as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.history import cut
from seriesloom.operators.split import TEST_SIZE, split_time_ordered
from seriesloom.operators.trend import fitted, with_lines
from seriesloom.session import written
from seriesloom.spec import PanelSpec

MEASURES = ("mae", "rmse", "r2")
PARTS = ("train", "test")


def _measures(actual: Column, predicted: Column) -> dict[str, Column]:
    error = actual - predicted
    squared = error * error
    spread = F.var_pop(actual) * F.count(actual)
    return {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(squared)),
        "r2": 1 - F.sum(squared) / F.nullif(spread, F.lit(0.0)),
    }


def score(
    df: DataFrame,
    spec: PanelSpec,
    prediction: str = "prediction",
    flag: str = "is_test",
    by: Sequence[str] = (),
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """``train_*`` and ``test_*`` measures, overall or per group, in one pass.

    R² is null where the target does not vary.
    """
    both = F.col(spec.target).isNotNull() & F.col(prediction).isNotNull()
    in_part = {"train": ~F.col(flag), "test": F.col(flag)}
    per_part = {
        part: _measures(
            F.when(both & in_part[part], F.col(spec.target)),
            F.when(both & in_part[part], F.col(prediction)),
        )
        for part in PARTS
    }
    aggregates = [per_part[part][m].alias(f"{part}_{m}") for m in measures for part in PARTS]
    return df.groupBy(*by).agg(*aggregates)


def score_by_series(df: DataFrame, spec: PanelSpec, **options) -> DataFrame:
    return score(df, spec, by=[spec.series_key], **options)


def trend_predictions(
    df: DataFrame, spec: PanelSpec, test_size: float = TEST_SIZE
) -> DataFrame:
    """Target, split flag and the line fitted to the training rows, for every row.

    Where series are cut into pieces, the flagged rows are read by the fit and by
    the join with its lines, and are written once in between.
    """
    rows = df.select(spec.series_key, spec.order_col, spec.target)
    split = split_time_ordered(cut(rows, spec), spec, test_size)
    if spec.pieces is not None:
        split = written(split, "split")
    lined = with_lines(split, spec, [spec.target], where=~F.col("is_test"))
    return lined.select(
        *rows.columns,
        "is_test",
        fitted(spec, spec.target, F.col(spec.order_col)).alias("prediction"),
    )
