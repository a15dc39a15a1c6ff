"""Panels in CSV files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.functions.arithmetic import lenient_double
from seriesloom.spec import PanelSpec

# Why a line is no row of the panel.
TOO_FEW, TOO_MANY = "too few fields", "too many fields"
NO_KEY, NO_PERIOD = "no series key", "no period"
NO_NUMBER = "no number in {}"

# A field in quotes, in which a backslash keeps the next character from ending it.
_QUOTED = r'"(?:[^"\\]|\\.)*"'


def read_panel(
    spark: SparkSession,
    path: str,
    spec: PanelSpec,
    key_type: T.DataType | None = None,
    order_type: T.DataType | None = None,
) -> DataFrame:
    """CSV files with a header, read with the panel's declared schema."""
    return read_csv(spark, path, spec.schema(key_type, order_type))


def read_single_series(
    spark: SparkSession, path: str, spec: PanelSpec, key: str = "all"
) -> DataFrame:
    """A CSV file without a key column: one series, named ``key``."""
    fields = [f for f in spec.schema().fields if f.name != spec.series_key]
    series = read_csv(spark, path, T.StructType(fields))
    return series.select(F.lit(key).alias(spec.series_key), *[f.name for f in fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files whose header must match; empty, unreadable and NaN numbers are all null."""
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    missing = F.lit(None).cast("double")
    doubles = [f.name for f in schema if f.dataType == T.DoubleType()]
    return raw.withColumns({c: F.nanvl(F.col(c), missing) for c in doubles})


@dataclass(frozen=True)
class CheckedPanel:
    """The rows of CSV files that fit a panel, and the lines that do not.

    Every line but headers and blank ones is in one of the two.
    """

    panel: DataFrame
    rejected: DataFrame


def read_checked(
    spark: SparkSession,
    path: str,
    spec: PanelSpec,
    key_type: T.DataType | None = None,
    order_type: T.DataType | None = None,
    strict: bool = False,
) -> CheckedPanel:
    """CSV files line by line: the panel, and file, line and reason of what is no row of it.

    A line is rejected if it has too few or too many fields, or no key or period
    of the declared type. Numbers that cannot be read are missing values, as in
    :func:`read_panel`; with ``strict`` they reject the line too, unless the
    field is empty or NaN. A header is a line of the column names, wherever it
    stands; a record must not span lines. Both tables read the files when used.
    """
    schema = spec.schema(key_type, order_type)
    names = schema.names
    header = ",".join(names)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")
    )
    plain = F.regexp_replace(F.regexp_replace("line", '"', ""), r"\s*,\s*", ",")
    wanted = lines.filter((F.trim("line") != "") & (F.trim(plain) != header))
    fields = ", ".join(f"`{n}` string" for n in names)
    options = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    parsed = wanted.withColumn("fields", F.from_csv("line", fields, options))
    count = F.size(F.split(F.regexp_replace("line", _QUOTED, ""), ",", -1))

    def value(field: T.StructField):
        raw = F.col(f"fields.`{field.name}`")
        if field.dataType == T.DoubleType():
            return lenient_double(raw)
        return F.when(raw != "", raw).try_cast(field.dataType)

    key, period = schema[spec.series_key], schema[spec.order_col]
    problem = (
        F.when(count < len(names), TOO_FEW)
        .when(count > len(names), TOO_MANY)
        .when(value(key).isNull(), NO_KEY)
        .when(value(period).isNull(), NO_PERIOD)
    )
    if strict:
        for name in spec.variables:
            raw = F.lower(F.coalesce(f"fields.`{name}`", F.lit("")))
            unread = ~raw.isin("", "nan") & value(schema[name]).isNull()
            problem = problem.when(unread, NO_NUMBER.format(name))
    judged = parsed.withColumn("reason", problem)
    panel = judged.filter("reason is null").select(*[value(f).alias(f.name) for f in schema])
    return CheckedPanel(panel, judged.filter("reason is not null").select("file", "line", "reason"))


def write_csv(df: DataFrame, path: str) -> None:
    """Write with a header into the folder ``path``, replacing what was there."""
    df.write.mode("overwrite").option("header", True).csv(path)
