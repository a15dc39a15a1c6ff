"""Rows carried through an operator whatever their columns are called."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII blanks and letters of the operators' contracts.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

ROW = "_row"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as one struct beside the operator's own columns."""
    own = [value.alias(name) for name, value in columns.items()]
    return df.select(F.struct(*[df[name] for name in df.columns]).alias(ROW), *own)


def unpacked(df: DataFrame, **columns: Column) -> DataFrame:
    """The packed rows with new columns; those replace input columns of the same name."""
    taken = {name.lower() for name in columns}
    fields = [f.name for f in df.schema[ROW].dataType.fields]
    kept = [F.col(ROW).getField(name).alias(name) for name in fields if name.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fingerprint(value: Column) -> list[Column]:
    """128 bits of hash as two longs; ``value`` is a string or binary column."""
    return [F.xxhash64(value), F.xxhash64(F.lit(1), value)]


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])
