"""Previous rows, row numbers and per-series values, without a whole series per task.

Unless ``spec.pieces`` is None, a panel is cut by series and period into pieces of
equal rows, whatever its periods count, and every window runs per (series,
piece). What crosses a cut is small: the last few rows before it, or the number
of rows before it. A series has at most as many such entries as there are
pieces, and only they are ever ordered per series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.session import written
from seriesloom.spec import PanelSpec

PIECE = "__piece"


def lag_name(column: str, back: int) -> str:
    return f"{column}_lag_{back}"


def cut(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``df`` written in pieces, each row with the number of its piece.

    Every operator on long series cuts a table that is not cut yet; do it once
    where several of them read the same table.
    """
    if spec.pieces is None or PIECE in df.columns:
        return df
    shuffled = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = df.repartitionByRange(spec.pieces or int(shuffled), spec.series_key, spec.order_col)
    return written(ranged.withColumn(PIECE, F.spark_partition_id()), "pieces")


def _as_before(result: DataFrame, df: DataFrame) -> DataFrame:
    """``result`` without the number of the piece, unless the input had it."""
    return result if PIECE in df.columns else result.drop(PIECE)


def _lags(columns: Sequence[str], depth: int, window) -> list[Column]:
    return [
        F.lag(c, back).over(window).alias(lag_name(c, back))
        for back in range(1, depth + 1)
        for c in columns
    ]


def with_lags(
    df: DataFrame, spec: PanelSpec, depth: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """Add ``{column}_lag_1 .. _lag_depth``: values of the previous rows of the series.

    Previous means the previous row in period order; a gap is not noticed.
    """
    columns = list(spec.variables if columns is None else columns)
    if depth < 1:
        return df
    if spec.pieces is None:
        series = W.partitionBy(spec.series_key).orderBy(spec.order_col)
        return df.select("*", *_lags(columns, depth, series))

    pieces = cut(df, spec)
    carried = _rows_before_each_piece(pieces, spec, depth, columns)
    rows = pieces.withColumn("__carried", F.lit(False)).unionByName(
        carried.withColumn("__carried", F.lit(True)), allowMissingColumns=True
    )
    within = W.partitionBy(spec.series_key, PIECE).orderBy(spec.order_col)
    lagged = rows.select("*", *_lags(columns, depth, within)).filter(~F.col("__carried"))
    return _as_before(lagged.drop("__carried"), df)


def _rows_before_each_piece(
    pieces: DataFrame, spec: PanelSpec, depth: int, columns: Sequence[str]
) -> DataFrame:
    """The last ``depth`` rows of a series before each of its pieces, labelled with that piece."""
    key, period = spec.series_key, spec.order_col
    latest_first = W.partitionBy(key, PIECE).orderBy(F.desc(period))
    ends = (
        pieces.select(key, PIECE, period, *columns)
        .withColumn("__rank", F.row_number().over(latest_first))
        .filter(F.col("__rank") <= depth)
        .groupBy(key, PIECE)
        .agg(F.array_sort(F.collect_list(F.struct(period, *columns))).alias("__end"))
    )
    # a piece of a series holds at least one row, so depth pieces hold depth rows
    in_order = W.partitionBy(key).orderBy(PIECE)
    ends_before = [F.lag("__end", back).over(in_order) for back in range(depth, 0, -1)]
    earlier = F.flatten(F.array_compact(F.array(*ends_before)))
    rows = ends.select(key, PIECE, earlier.alias("__rows"))
    first = F.greatest(F.lit(1), F.size("__rows") - depth + 1)
    return rows.select(key, PIECE, F.inline(F.slice("__rows", first, depth)))


def with_positions(
    df: DataFrame, spec: PanelSpec, position: str = "position", length: str = "length"
) -> DataFrame:
    """Add the 1-based row number in period order and the number of rows of the series."""
    numbered = _positions(cut(df, spec), spec, [spec.order_col], PIECE, position, length)
    return _as_before(numbered, df)


def _positions(
    df: DataFrame,
    spec: PanelSpec,
    order: Sequence[str],
    piece: str,
    position: str,
    length: str,
) -> DataFrame:
    key = spec.series_key
    if spec.pieces is None:
        ordered = W.partitionBy(key).orderBy(*order)
        return df.select(
            "*",
            F.row_number().over(ordered).cast("bigint").alias(position),
            F.count("*").over(W.partitionBy(key)).alias(length),
        )
    sizes = df.groupBy(key, piece).agg(F.count("*").alias("__size"))
    earlier = W.partitionBy(key).orderBy(piece).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        key,
        piece,
        F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"),
        F.sum("__size").over(W.partitionBy(key)).alias(length),
    )
    within = W.partitionBy(key, piece).orderBy(*order)
    numbered = df.join(offsets, [key, piece]).withColumn(
        position, F.row_number().over(within) + F.col("__offset")
    )
    return numbered.select(*df.columns, position, length)


def with_hash_positions(
    df: DataFrame, spec: PanelSpec, digest: str, position: str, length: str
) -> DataFrame:
    """Like :func:`with_positions`, in the order of a hex digest column."""
    # four hex digits: 65,536 pieces of a series, in the order of the whole digest
    leading = F.conv(F.substring(digest, 1, 4), 16, 10).cast("bigint")
    split = df.withColumn("__leading", leading)
    order = [digest, spec.order_col]
    return _positions(split, spec, order, "__leading", position, length).drop("__leading")


def last_rows(df: DataFrame, spec: PanelSpec, count: int, rank: str | None = None) -> DataFrame:
    """The last ``count`` rows of each series, optionally with their rank from the end.

    The limit is applied on the map side before the shuffle, so a long series
    costs ``count`` rows per task.
    """
    name = rank or "__rank"
    latest_first = W.partitionBy(spec.series_key).orderBy(F.desc(spec.order_col))
    ranked = df.withColumn(name, F.row_number().over(latest_first)).filter(F.col(name) <= count)
    return ranked if rank else ranked.drop(name)


def join_series(
    df: DataFrame, per_series: DataFrame, spec: PanelSpec, how: str = "inner"
) -> DataFrame:
    """Join rows with one row per series.

    A series that is cut into pieces is joined per piece: the per-series row is
    first copied to the pieces that exist, then met there by the piece's rows.
    """
    key = spec.series_key
    if spec.pieces is None:
        return df.join(per_series, key, how)
    pieces = cut(df, spec)
    per_piece = pieces.select(key, PIECE).distinct().join(per_series, key)
    return _as_before(pieces.join(per_piece, [key, PIECE], how), df)


def with_min_length(df: DataFrame, spec: PanelSpec, rows: int) -> DataFrame:
    """Rows of the series that have at least ``rows`` rows."""
    if spec.pieces is None:
        counted = df.withColumn("__length", F.count("*").over(W.partitionBy(spec.series_key)))
        return counted.filter(F.col("__length") >= rows).drop("__length")
    pieces = cut(df, spec)
    lengths = pieces.groupBy(spec.series_key).agg(F.count("*").alias("__length"))
    long_enough = lengths.filter(F.col("__length") >= rows).select(spec.series_key)
    return _as_before(join_series(pieces, long_enough, spec), df)
