"""Panels built from order and event tables.

All builders aggregate to one row per (series, period) with partial sums on the
map side, so a customer, user or event type with a large share of the raw rows
reaches the shuffle as a handful of rows per task.

Amounts are summed as whole cents: exact, independent of row order, and without
a decimal object per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.spec import PanelSpec

# A row per month or day: the calendar bounds the rows of a series, whatever the
# size of the tables, so series stay in one piece. Origins are the first period
# of the tables (January 1995; 2024-01-01 as days since 1970-01-01).
MONTH_SPEC = PanelSpec(origin=1995 * 12, pieces=None)
DAY_SPEC = PanelSpec(origin=19723, pieces=None)

# A row per second and only a few event types: few, very long series, cut into pieces.
SECOND_SPEC = PanelSpec(origin=19723 * 86_400)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _cents(amount: Column) -> Column:
    return F.rint(amount * 100).cast("bigint")


def _number(count: Column) -> Column:
    return count.cast("double")


def nation_month(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Order value per nation and month, with shares of urgent, finished and low orders.

    Orders shrink to one row per customer and month before the join, so a single
    busy customer cannot skew it. Whether the customer side is broadcast is left
    to the planner, which knows its size.
    """
    ordered = F.col("o_orderdate")
    per_customer = (
        orders.select(
            "o_custkey",
            (F.year(ordered) * 12 + F.month(ordered) - 1).alias("year"),
            _cents(F.col("o_totalprice")).alias("cents"),
            (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
            (F.col("o_orderpriority") == "5-LOW").alias("low"),
            (F.col("o_orderstatus") == "F").alias("finished"),
        )
        .groupBy("o_custkey", "year")
        .agg(
            F.sum("cents").alias("cents"),
            F.count("*").alias("orders"),
            F.count_if("urgent").alias("urgent"),
            F.count_if("low").alias("low"),
            F.count_if("finished").alias("finished"),
        )
    )
    nations = customer.select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_nationkey").cast("bigint").alias("series_key"),
    )
    sums = (
        per_customer.join(nations, "o_custkey")
        .groupBy("series_key", "year")
        .agg(*[F.sum(c).alias(c) for c in ("cents", "orders", "urgent", "low", "finished")])
    )
    orders_ = _number(F.col("orders"))
    return sums.select(
        "series_key",
        "year",
        (F.col("cents") / 100.0).alias("population"),
        (F.col("urgent") * 100.0 / orders_).alias("birth_rate"),
        (F.col("finished") * 100.0 / orders_).alias("death_rate"),
        ((F.col("low") - F.col("urgent")) * 100.0 / orders_).alias("migration_rate"),
    )


def user_day(events: DataFrame) -> DataFrame:
    """Event value per user and day (days since 1970-01-01), with counts per kind."""
    kind = F.col("event_type")
    return (
        events.select(
            F.col("user_id").cast("bigint").alias("series_key"),
            F.unix_date(F.to_date("ts")).alias("year"),
            _cents(F.col("value")).alias("cents"),
            "event_type",
        )
        .groupBy("series_key", "year")
        .agg(
            (F.sum("cents") / 100.0).alias("population"),
            _number(F.count_if(kind == "signup")).alias("birth_rate"),
            _number(F.count_if(kind == "error")).alias("death_rate"),
            _number(F.count_if(kind == "click") - F.count_if(kind == "view")).alias(
                "migration_rate"
            ),
        )
    )


def kind_second(events: DataFrame) -> DataFrame:
    """Event value per event type and second (seconds since 1970-01-01)."""
    ts = F.col("ts")
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    second = day * 86_400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return (
        events.select(
            F.col("event_type").alias("series_key"),
            second.alias("year"),
            _cents(F.col("value")).alias("cents"),
        )
        .groupBy("series_key", "year")
        .agg(
            (F.sum("cents") / 100.0).alias("population"),
            _number(F.count("*")).alias("birth_rate"),
            _number(F.count_if(F.col("cents") < 500)).alias("death_rate"),
            _number(
                F.count_if(F.col("cents") >= 2000) - F.count_if(F.col("cents") < 2000)
            ).alias("migration_rate"),
        )
    )
