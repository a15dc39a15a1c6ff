"""Holdouts within each series, as a flag column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.history import with_hash_positions, with_positions
from seriesloom.spec import PanelSpec

TEST_SIZE = 0.2
SEED = 42


def _checked(test_size: float) -> float:
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must lie between 0 and 1")
    return float(test_size)


def split_time_ordered(
    df: DataFrame, spec: PanelSpec, test_size: float = TEST_SIZE, flag: str = "is_test"
) -> DataFrame:
    """Flag the rows after the first ``int(n * (1 - test_size))`` of each series."""
    train_share = 1.0 - _checked(test_size)
    numbered = with_positions(df, spec, "__position", "__length")
    train_rows = F.floor(F.col("__length").cast("double") * F.lit(train_share))
    return numbered.withColumn(flag, F.col("__position") > train_rows).drop(
        "__position", "__length"
    )


def split_random(
    df: DataFrame,
    spec: PanelSpec,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    flag: str = "is_test",
) -> DataFrame:
    """Flag ``ceil(n * test_size)`` rows of each series, chosen by a seeded hash.

    The choice depends on key, period and seed alone, so a recomputed task and a
    different partitioning give the same split.
    """
    share = _checked(test_size)
    identity = F.concat_ws(
        "|", F.col(spec.series_key).cast("string"), F.col(spec.order_col).cast("string"),
        F.lit(str(seed)),
    )
    hashed = df.withColumn("__digest", F.md5(identity))
    numbered = with_hash_positions(hashed, spec, "__digest", "__position", "__length")
    test_rows = F.ceil(F.col("__length").cast("double") * F.lit(share))
    return numbered.withColumn(flag, F.col("__position") <= test_rows).drop(
        "__digest", "__position", "__length"
    )
