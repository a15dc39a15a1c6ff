"""Registered queries: each operator over a panel built from the given tables.

Line fits are rounded, since the order of a distributed sum shows in the last
bits; everything else is returned as computed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.functions import text
from seriesloom.functions.arithmetic import lenient_double, pct_change, whole_part
from seriesloom.operators import append, charts, features, history, metrics, model, recursion, report
from seriesloom.operators import split, trees, trend
from seriesloom.session import scratch_path, written
from seriesloom.sources import panel_csv, tables
from seriesloom.sources.tables import DAY_SPEC, MONTH_SPEC, SECOND_SPEC

Query = Callable[[SparkSession, str], DataFrame]

_REGISTERED: dict[str, Query] = {}

# Rounds of the registered basic model, which never stops early. Its default is
# 1000: those took 385 s on a panel of 1,975 rows, with all cores shared with another job,
# since a round is several small jobs whatever the number of rows.
BASIC_ROUNDS = 100

MIN_ROWS = 27


def query(build: Query) -> Query:
    _REGISTERED[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_REGISTERED)


def months(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.read_table(spark, folder, "orders")
    return tables.nation_month(orders, tables.read_table(spark, folder, "customer"))


def days(spark: SparkSession, folder: str) -> DataFrame:
    return tables.user_day(tables.read_table(spark, folder, "events"))


def seconds(spark: SparkSession, folder: str) -> DataFrame:
    return tables.kind_second(tables.read_table(spark, folder, "events"))


def once(panel: DataFrame) -> DataFrame:
    """A panel that is read more than once: written, so the raw tables are scanned once."""
    return written(panel, "panel")


# Fits are rounded to multiples of a power of two, given here as bits after the
# point. Quotients of small counts do lie on the halves of a decimal grid, where
# the last bit of a sum would decide; they do not lie on the halves of these.
AMOUNT_BITS = 10
PERCENT_BITS = 20
RATE_BITS = 30
SLOPE_BITS = 50

FORECAST_BITS = {
    "population": AMOUNT_BITS,
    "birth_rate": RATE_BITS,
    "death_rate": RATE_BITS,
    "migration_rate": RATE_BITS,
}
BAND_BITS = {c: AMOUNT_BITS for c in ("population", "lower_bound", "upper_bound")}
METRIC_BITS = {
    "train_mae": AMOUNT_BITS,
    "test_mae": AMOUNT_BITS,
    "train_rmse": AMOUNT_BITS,
    "test_rmse": AMOUNT_BITS,
    "train_r2": PERCENT_BITS,
    "test_r2": PERCENT_BITS,
}


def rounded(df: DataFrame, bits: dict[str, int]) -> DataFrame:
    def on_grid(column: str, places: int):
        steps = F.lit(2.0**places)
        # adding zero turns a negative zero into a plain one
        return F.rint(F.col(column) * steps) / steps + F.lit(0.0)

    return df.withColumns({c: on_grid(c, places) for c, places in bits.items()})


# --- panels, sources and sinks ---


@query
def panel_nation_month(spark, folder):
    return months(spark, folder)


@query
def panel_user_day(spark, folder):
    return days(spark, folder)


@query
def panel_kind_second(spark, folder):
    return seconds(spark, folder)


@query
def csv_round_trip(spark, folder):
    path = scratch_path(spark, "panel-csv")
    panel_csv.write_csv(days(spark, folder), path)
    return panel_csv.read_panel(spark, path, DAY_SPEC)


@query
def csv_rejects(spark, folder):
    """Lines of a panel's file, some of them damaged, by what reading them says."""
    panel = days(spark, folder)
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in DAY_SPEC.columns}

    def line(**other):
        return F.concat_ws(",", *{**text, **other}.values())

    whole = line()
    damaged = (
        F.when(F.col("birth_rate") > 0, F.substring_index(whole, ",", 4))
        .when(F.col("death_rate") > 0, F.concat(whole, F.lit(",1")))
        .when(F.col("migration_rate") > 0, line(year=F.lit("soon")))
        .when(F.col("migration_rate") < -1, line(series_key=F.lit("")))
    )
    path = scratch_path(spark, "lines")
    panel.select(F.coalesce(damaged, whole)).write.text(path)
    header = spark.createDataFrame([(",".join(DAY_SPEC.columns),)], "line string")
    header.write.mode("append").text(path)
    found = panel_csv.read_checked(spark, path, DAY_SPEC)
    # the period stands behind the key in every line but those without one
    year = F.get(F.split("line", ","), F.lit(1)).try_cast("bigint")
    refused = found.rejected.select("reason", year.alias("year"))
    accepted = found.panel.select(F.lit("accepted").alias("reason"), F.col("year").cast("bigint"))
    return (
        accepted.unionByName(refused)
        .groupBy("reason")
        .agg(F.count("*").alias("lines"), F.sum("year").alias("years"))
    )


@query
def lenient_cast(spark, folder):
    """Order amounts as text, withheld for one priority, read back leniently."""
    orders = tables.read_table(spark, folder, "orders")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    withheld = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a")).otherwise(amount)
    return orders.select(
        "o_orderkey",
        lenient_double(withheld).alias("amount"),
        lenient_double(F.col("o_orderpriority")).alias("priority"),
    )


# --- profiles and picks ---


@query
def series_profile(spark, folder):
    return report.series_profile(days(spark, folder), DAY_SPEC)


@query
def min_history_filter(spark, folder):
    return history.with_min_length(days(spark, folder), DAY_SPEC, MIN_ROWS)


@query
def min_history_filter_long(spark, folder):
    """The series of at least mean length; the mean is a single number."""
    panel = history.cut(seconds(spark, folder), SECOND_SPEC)
    lengths = panel.groupBy("series_key").count()
    mean = lengths.agg(F.ceil(F.avg("count"))).first()[0]
    return history.with_min_length(panel, SECOND_SPEC, mean or 0).drop(history.PIECE)


@query
def last_state(spark, folder):
    return history.last_rows(days(spark, folder), DAY_SPEC, 1)


@query
def last_k_rows(spark, folder):
    return history.last_rows(days(spark, folder), DAY_SPEC, 3)


@query
def last_k_rows_long(spark, folder):
    return history.last_rows(seconds(spark, folder), SECOND_SPEC, 3)


# --- lines ---


@query
def trend_coefficients(spark, folder):
    lines = trend.fit_lines(months(spark, folder), MONTH_SPEC)
    bits = {
        c: AMOUNT_BITS if c.startswith("population") else RATE_BITS for c in lines.columns[1:]
    }
    return rounded(lines, bits)


@query
def trend_coefficients_long(spark, folder):
    lines = trend.fit_lines(seconds(spark, folder), SECOND_SPEC)
    bits = {c: SLOPE_BITS if c.endswith("slope") else RATE_BITS for c in lines.columns[1:]}
    return rounded(lines, bits)


def _with_last_day_appended(spark, folder) -> append.Appended:
    """The user-day panel up to its last day as states, and that day appended."""
    panel = once(days(spark, folder))
    last = panel.agg(F.max("year")).first()[0]
    path = scratch_path(spark, "state")
    append.save_state(append.state_of(panel.filter(F.col("year") < last), DAY_SPEC), path)
    return append.append(append.load_state(spark, path), panel.filter(F.col("year") == last), DAY_SPEC)


@query
def append_features(spark, folder):
    """Features of the last day's rows from the states of the days before."""
    return _with_last_day_appended(spark, folder).features


@query
def append_lines(spark, folder):
    """Lines of all days from merged states."""
    state = _with_last_day_appended(spark, folder).state
    lines = append.lines_of(state, DAY_SPEC)
    bits = {
        c: AMOUNT_BITS if c.startswith("population") else RATE_BITS for c in lines.columns[1:]
    }
    return state.select("series_key", "rows", "last_period").join(rounded(lines, bits), "series_key")


@query
def future_frame(spark, folder):
    last = days(spark, folder).groupBy("series_key").agg(F.max("year").alias("last_period"))
    return trend.future_frame(last, DAY_SPEC).select("series_key", "step", "year")


@query
def rate_extrapolation(spark, folder):
    forecast = trend.driver_forecast(months(spark, folder), MONTH_SPEC)
    return rounded(forecast, {d: RATE_BITS for d in MONTH_SPEC.drivers})


@query
def trend_forecast(spark, folder):
    forecast = trend.trend_forecast(months(spark, folder), MONTH_SPEC)
    whole = forecast.withColumn("whole_population", whole_part(F.col("population")))
    derived = {"year_over_year_change": PERCENT_BITS, "population_millions": PERCENT_BITS}
    return rounded(whole, {**FORECAST_BITS, **derived})


# --- features ---


def _picked(features_: Sequence[features.Feature], *kinds: str) -> list[features.Feature]:
    return [f for f in features_ if f.kind in kinds]


def _day_features(spark, folder, *kinds: str) -> DataFrame:
    picked = _picked(features.full_feature_list(DAY_SPEC), *kinds)
    return features.select_features(days(spark, folder), DAY_SPEC, picked, filled=False)


@query
def feat_lags(spark, folder):
    return _day_features(spark, folder, "lag")


@query
def feat_changes(spark, folder):
    return _day_features(spark, folder, "change", "difference")


@query
def feat_moving_avg(spark, folder):
    return _day_features(spark, folder, "mean")


@query
def feat_interactions(spark, folder):
    return _day_features(spark, folder, "ratio", "natural", "total")


@query
def pct_change_zero_base(spark, folder):
    """Changes of a rate that is often 0, under both rules; infinities as text."""
    lagged = history.with_lags(days(spark, folder), DAY_SPEC, 1, ["death_rate"])
    now, before = F.col("death_rate"), F.col("death_rate_lag_1")
    signed = pct_change(now, before, "inf")
    infinity = F.lit(float("inf"))
    return lagged.select(
        "series_key",
        "year",
        F.when(signed == infinity, "inf").when(signed == -infinity, "-inf").alias("infinite"),
        F.when(F.abs(signed) < infinity, signed).alias("finite"),
        F.coalesce(pct_change(now, before), F.lit(0.0)).alias("filled"),
    )


@query
def features_basic(spark, folder):
    return features.basic_features(days(spark, folder), DAY_SPEC)


@query
def features_basic_long(spark, folder):
    return features.basic_features(seconds(spark, folder), SECOND_SPEC)


@query
def features_full(spark, folder):
    return features.full_features(days(spark, folder), DAY_SPEC)


@query
def features_full_nation_month(spark, folder):
    return features.full_features(months(spark, folder), MONTH_SPEC)


@query
def features_full_long(spark, folder):
    return features.full_features(seconds(spark, folder), SECOND_SPEC)


@query
def feature_matrix(spark, folder):
    return features.feature_matrix(
        features.full_features(days(spark, folder), DAY_SPEC), DAY_SPEC
    )


# --- holdouts and errors ---


def _basic(df: DataFrame) -> DataFrame:
    return df.select("series_key", "year", "population")


@query
def split_time_ordered(spark, folder):
    return split.split_time_ordered(_basic(days(spark, folder)), DAY_SPEC)


@query
def split_time_ordered_long(spark, folder):
    return split.split_time_ordered(_basic(seconds(spark, folder)), SECOND_SPEC)


@query
def split_random(spark, folder):
    kept = features.basic_features(days(spark, folder), DAY_SPEC)
    return split.split_random(_basic(kept), DAY_SPEC)


@query
def split_random_long(spark, folder):
    return split.split_random(_basic(once(seconds(spark, folder))), SECOND_SPEC)


@query
def metrics_by_series(spark, folder):
    predicted = metrics.trend_predictions(days(spark, folder), DAY_SPEC)
    return rounded(metrics.score_by_series(predicted, DAY_SPEC), METRIC_BITS)


@query
def metrics_by_series_long(spark, folder):
    predicted = metrics.trend_predictions(seconds(spark, folder), SECOND_SPEC)
    return rounded(metrics.score_by_series(predicted, SECOND_SPEC), METRIC_BITS)


@query
def metrics_overall(spark, folder):
    predicted = metrics.trend_predictions(days(spark, folder), DAY_SPEC)
    return rounded(metrics.score(predicted, DAY_SPEC), METRIC_BITS)


# --- tables and reports on the trend forecast ---


def _finished(panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trend forecast with a band from the trend's own test error, and that error."""
    errors = metrics.score_by_series(metrics.trend_predictions(panel, MONTH_SPEC), MONTH_SPEC)
    lines = trend.line_forecast(panel, MONTH_SPEC)
    return report.finish_forecast(lines, MONTH_SPEC, errors), errors


@query
def forecast_band(spark, folder):
    forecast, _ = _finished(once(months(spark, folder)))
    banded = forecast.select("series_key", "year", "population", "lower_bound", "upper_bound")
    return rounded(banded, BAND_BITS)


@query
def forecast_band_fallback(spark, folder):
    lines = trend.line_forecast(months(spark, folder), MONTH_SPEC, columns=["population"])
    banded = report.with_band(lines, MONTH_SPEC, None).drop("last_actual")
    return rounded(banded, BAND_BITS)


@query
def forecast_yoy(spark, folder):
    lines = trend.line_forecast(months(spark, folder), MONTH_SPEC, columns=["population"])
    changed = report.with_change(lines, MONTH_SPEC)
    return rounded(changed, {"population": AMOUNT_BITS, "year_over_year_change": PERCENT_BITS})


@query
def growth_report(spark, folder):
    panel = once(months(spark, folder))
    forecast, errors = _finished(panel)
    full = report.growth_report(panel, forecast, MONTH_SPEC, errors)
    flat = full.select(
        "series_key",
        "start_year",
        "end_year",
        F.col("forecast_years.first").alias("forecast_first"),
        F.col("forecast_years.last").alias("forecast_last"),
        "current_population",
        "forecast_population",
        "total_change",
        "percent_change",
        "avg_annual_growth",
        F.col("model_metrics")["test_rmse"].alias("test_rmse"),
        F.size("forecasts").alias("forecast_rows"),
        F.element_at("forecasts", -1)["population"].alias("last_forecast"),
    )
    return rounded(
        flat,
        {
            "forecast_population": AMOUNT_BITS,
            "total_change": AMOUNT_BITS,
            "percent_change": PERCENT_BITS,
            "avg_annual_growth": PERCENT_BITS,
            "test_rmse": AMOUNT_BITS,
            "last_forecast": AMOUNT_BITS,
        },
    )


@query
def forecast_table(spark, folder):
    forecast, _ = _finished(once(months(spark, folder)))
    return report.forecast_table(forecast, MONTH_SPEC)


@query
def history_and_forecast(spark, folder):
    panel = once(months(spark, folder))
    lines = trend.line_forecast(panel, MONTH_SPEC, columns=["population"])
    table = report.history_and_forecast(panel, lines, MONTH_SPEC)
    return report.sorted_by_period(table, MONTH_SPEC)


@query
def history_and_forecast_long(spark, folder):
    panel = history.cut(seconds(spark, folder), SECOND_SPEC)
    lines = trend.line_forecast(panel, SECOND_SPEC, columns=["population"])
    return report.history_and_forecast(panel, lines, SECOND_SPEC)


@query
def history_and_forecast_inf(spark, folder):
    """User-day counts of errors as the target: changes from 0 are infinite, shown as text."""
    spec = replace(DAY_SPEC, target="death_rate", drivers=("birth_rate", "migration_rate", "population"))
    panel = once(days(spark, folder))
    lines = trend.line_forecast(panel, spec, columns=["death_rate"])
    table = report.history_and_forecast(panel, lines, spec, zero_base="inf")
    change = F.col("YoY Change (%)")
    infinite = F.abs(change) == float("inf")
    return table.select(
        "series_key",
        "Year",
        F.when(infinite, F.when(change > 0, "inf").otherwise("-inf")).alias("infinite"),
        F.when(~infinite & (F.col("Type") == report.HISTORICAL), change).alias("finite"),
        "Type",
    )


@query
def formatted_summary(spark, folder):
    panel = once(months(spark, folder))
    lines = trend.line_forecast(panel, MONTH_SPEC)
    return report.summary_lines(report.growth_report(panel, lines, MONTH_SPEC), MONTH_SPEC)


@query
def formatted_forecast(spark, folder):
    forecast = trend.trend_forecast(months(spark, folder), MONTH_SPEC)
    return report.trend_lines(forecast, MONTH_SPEC)


@query
def historical_listing(spark, folder):
    return report.historical_lines(days(spark, folder), DAY_SPEC)


@query
def formatted_slope(spark, folder):
    fitted = trend.fit_lines(months(spark, folder), MONTH_SPEC, ["population"])
    slopes = fitted.select("series_key", F.col("population_slope").alias("slope"))
    return report.slope_lines(slopes, MONTH_SPEC)


@query
def formatted_edges(spark, folder):
    """Texts of halves, tiny and huge values made from the parts' sizes."""
    size = F.col("p_size").cast("double")
    values = {
        "half": size / 8,
        "cents": size + 0.675,
        "tiny": size / 1000 * 0.0005,
        "huge": size * 1234567.0,
        "below": -size / 1000,
    }
    shown = [text.plain(v).alias(f"{n}_plain") for n, v in values.items()]
    shown += [text.fixed(v, 2, "%").alias(f"{n}_fixed") for n, v in values.items()]
    return tables.read_table(spark, folder, "part").select("p_partkey", *shown)


@query
def missing_markers(spark, folder):
    """Event values as text of several kinds, read back: one missing marker for all of them."""
    value = F.col("value").cast("decimal(18,2)").cast("string")
    kinds = {"view": "nan", "click": "NaN", "signup": "", "error": "1.0d"}
    kind = F.col("event_type")
    written_as = value
    for name, marker in kinds.items():
        written_as = F.when(kind == name, F.lit(marker)).otherwise(written_as)
    not_a_number = F.when(kind == "view", F.lit(float("nan"))).otherwise(F.col("value"))
    return tables.read_table(spark, folder, "events").select(
        "event_id",
        lenient_double(written_as).alias("from_text"),
        lenient_double(not_a_number, text=False).alias("from_double"),
    )


@query
def chart_target_band(spark, folder):
    panel = once(months(spark, folder))
    forecast, _ = _finished(panel)
    steady = rounded(forecast, BAND_BITS)
    return charts.target_with_band(panel, steady, MONTH_SPEC)


@query
def chart_target_band_long(spark, folder):
    panel = once(seconds(spark, folder))
    lines = trend.line_forecast(panel, SECOND_SPEC, columns=["population"])
    steady = rounded(lines, {"population": AMOUNT_BITS})
    return charts.target_with_band(panel, steady, SECOND_SPEC)


@query
def chart_indicators_long(spark, folder):
    panel = once(months(spark, folder))
    forecast = trend.driver_forecast(panel, MONTH_SPEC)
    steady = rounded(forecast, {d: RATE_BITS for d in MONTH_SPEC.drivers})
    return charts.indicators_long(panel, steady, MONTH_SPEC)


# --- recursive forecasts and boosted trees ---


@query
def recursive_forecast_linear(spark, folder):
    """The recursion with a rule in place of the model: the mean of the last three values."""
    picked = features.full_feature_list(DAY_SPEC)
    steps = recursion.recursive_steps(
        once(days(spark, folder)), DAY_SPEC, picked, recursion.mean_of_lags(DAY_SPEC, picked)
    )
    return rounded(steps, {d: RATE_BITS for d in DAY_SPEC.drivers}).drop("last_actual")


# One model per application and folder: several queries look at the same one.
_TRAINED: dict[tuple[str, str], tuple[DataFrame, model.TrainedModel]] = {}


def _model(spark, folder) -> tuple[DataFrame, model.TrainedModel]:
    """The stored panel and the model with its default settings, trained once."""
    name = (spark.sparkContext.applicationId, folder)
    if name not in _TRAINED:
        panel = once(months(spark, folder))
        _TRAINED[name] = panel, model.train(panel, MONTH_SPEC)
    return _TRAINED[name]


@query
def training_table(spark, folder):
    return model.training_table(months(spark, folder), MONTH_SPEC)


@query
def training_table_full(spark, folder):
    choice = model.FeatureChoice("full")
    return model.training_table(months(spark, folder), MONTH_SPEC, choice, drop_warmup=False)


@query
def mean_model_metrics(spark, folder):
    """A model of trees without a split knows the mean of its rows, as SQL does."""
    settings = {"depth": 0, "iterations": 2, "early_stopping_rounds": 0}
    trained = model.train(months(spark, folder), MONTH_SPEC, settings)
    return rounded(trained.metrics(), METRIC_BITS)


@query
def gbt_basic_metrics(spark, folder):
    settings = {"iterations": BASIC_ROUNDS}
    trained = model.train_basic(months(spark, folder), MONTH_SPEC, settings)
    return metrics.score(trained.scored, MONTH_SPEC, measures=("mae", "rmse"))


@query
def gbt_full_metrics(spark, folder):
    return _model(spark, folder)[1].metrics()


@query
def gbt_full_metrics_long(spark, folder):
    return model.train(seconds(spark, folder), SECOND_SPEC).metrics()


@query
def gbt_scored_rows(spark, folder):
    """Rows the model was scored on, with their flags; predictions only as whether they are there."""
    there = F.coalesce(F.abs("prediction") < float("inf"), F.lit(False))
    scored = _model(spark, folder)[1].scored
    return scored.withColumn("predicted", there).drop("prediction")


def _close(left: Column, right: Column, share: float = 1e-9) -> Column:
    """Whether two numbers agree but for the last digits of their sums."""
    return F.abs(left - right) <= share * F.greatest(F.abs(left), F.abs(right))


@query
def gbt_metric_checks(spark, folder):
    """Whether the errors are those of predictions made again from the table of trees."""
    panel, trained, nodes = _trees(spark, folder)
    again = _predicted_again(panel, trained, nodes)
    table = trained.scored.drop("prediction").join(again, ["series_key", "year"])
    other = metrics.score(table, MONTH_SPEC)
    names = other.columns
    both = trained.metrics().withColumn("again", F.lit(False)).unionByName(other.withColumn("again", F.lit(True)))

    def of(name: str, again: bool) -> Column:
        return F.max(F.when(F.col("again") == again, F.col(name)))

    return both.agg(*[_close(of(c, False), of(c, True)).alias(f"{c}_agrees") for c in names])


def _trees(spark, folder) -> tuple[DataFrame, model.TrainedModel, DataFrame]:
    """The stored panel, the model and its trees as a table."""
    panel, trained = _model(spark, folder)
    return panel, trained, written(trees.tree_table(trained), "trees")


def _predicted_again(panel: DataFrame, trained: model.TrainedModel, nodes: DataFrame) -> DataFrame:
    table = written(model.training_table(panel, MONTH_SPEC), "features")
    predict = trees.predictor(trained, nodes, ["series_key", "year"])
    return written(predict(table).select("series_key", "year", "prediction"), "predicted")


@query
def gbt_trees(spark, folder):
    """All nodes of all trees."""
    return _trees(spark, folder)[2]


@query
def gbt_tree_predictions(spark, folder):
    """Whether joins of the rows with the table of trees predict as the model does."""
    panel, trained, nodes = _trees(spark, folder)
    again = _predicted_again(panel, trained, nodes).withColumnRenamed("prediction", "joined")
    return trained.scored.join(again, ["series_key", "year"]).select(
        "series_key", "year", _close(F.col("prediction"), F.col("joined")).alias("same_prediction")
    )


@query
def gbt_tree_importances(spark, folder):
    """Whether the gains in the table of trees give the importances of the model."""
    _, trained, nodes = _trees(spark, folder)
    own = model.feature_importance(trained).withColumnRenamed("importance", "own")
    found = trees.importances(trained, nodes)
    return found.join(own, "feature").select(
        "feature", (F.abs(F.col("importance") - F.col("own")) < 1e-9).alias("same_importance")
    )


@query
def gbt_tree_forecast(spark, folder):
    """Whether six steps that predict by joins with the table of trees are the model's forecast."""
    panel, trained, nodes = _trees(spark, folder)
    steps = recursion.recursive_steps(
        panel,
        MONTH_SPEC,
        trained.choice.features(MONTH_SPEC),
        trees.predictor(trained, nodes, ["series_key"]),
        filled=trained.choice.filled,
        steps_per_plan=1,
    ).select("series_key", "year", F.col("population").alias("joined"))
    forecast = recursion.recursive_forecast(panel, trained)
    return forecast.join(steps, ["series_key", "year"]).select(
        "series_key", "year", _close(F.col("population"), F.col("joined")).alias("same_step")
    )


# One split per tree and as many bins as rows, so that every split is a candidate.
STUMPS = {"depth": 1, "iterations": 2, "early_stopping_rounds": 0, "l2_leaf_reg": 3.0, "max_bins": 4000}


@query
def gbt_stumps(spark, folder):
    """Predictions of two trees with one split and penalised leaves, as SQL works them out."""
    trained = model.train(months(spark, folder), MONTH_SPEC, STUMPS)
    return rounded(trained.scored, {"prediction": AMOUNT_BITS})


@query
def gbt_predictions(spark, folder):
    return _model(spark, folder)[1].scored


@query
def feature_importance(spark, folder):
    return model.feature_importance(_model(spark, folder)[1], model.TOP_FEATURES)


@query
def feature_importance_checks(spark, folder):
    """All causal features by name, and whether shares add up and the first ten are the largest."""
    trained = _model(spark, folder)[1]
    every = model.feature_importance(trained)
    first = model.feature_importance(trained, model.TOP_FEATURES)
    # a number per feature: what they sum to, and the last of the first ones
    total = every.agg(F.sum("importance")).first()[0]
    least, firsts = first.agg(F.min("importance"), F.count("*")).first()
    marked = every.join(first.select("feature", F.lit(True).alias("is_first")), "feature", "left")
    larger, smaller = F.col("importance") >= least, F.col("importance") <= least
    return marked.select(
        "feature",
        F.lit(abs(total - 100) < 1e-6).alias("sums_to_100"),
        F.lit(firsts == model.TOP_FEATURES).alias("ten_are_first"),
        F.when(F.col("is_first"), larger).otherwise(smaller).alias("in_order"),
    )


@query
def model_round_trip(spark, folder):
    """Whether a saved and loaded model predicts the same, also when saved over its own folder."""
    panel, trained = _model(spark, folder)
    path = scratch_path(spark, "model")
    model.save_model(trained, path)
    model.save_model(model.load_model(spark, path), path)
    loaded = model.load_model(spark, path)
    table = model.training_table(panel, loaded.spec, loaded.choice)
    again = loaded.predict(table).select("series_key", "year", "prediction")
    before = trained.scored.select(
        "series_key", "year", F.col("prediction").alias("prediction_before")
    )
    errors = loaded.series_metrics.select("series_key", F.lit(True).alias("has_errors"))
    return (
        again.join(before, ["series_key", "year"])
        .join(errors, "series_key")
        .select(
            "series_key",
            "year",
            (F.col("prediction") == F.col("prediction_before")).alias("same_prediction"),
            "has_errors",
        )
    )


@query
def recursive_forecast(spark, folder):
    panel, trained = _model(spark, folder)
    return recursion.recursive_forecast(panel, trained)


@query
def recursive_forecast_checks(spark, folder):
    """Periods and drivers of the boosted forecast, and how its columns agree."""
    panel, trained = _model(spark, folder)
    forecast = recursion.recursive_forecast(panel, trained)
    value = F.col("population")
    up, down = F.col("upper_bound") - value, value - F.col("lower_bound")
    last = history.last_rows(panel, MONTH_SPEC, 1).select("series_key", F.col("population").alias("last"))
    steps = W.partitionBy("series_key").orderBy("year")
    before = F.coalesce(F.lag("population").over(steps), F.col("last"))
    change = (value - before) / before * 100
    checked = forecast.join(last, "series_key").select(
        "series_key",
        "year",
        *MONTH_SPEC.drivers,
        (F.abs(up - down) <= 1e-6 * F.abs(value)).alias("band_is_even"),
        (F.abs(change - F.col("year_over_year_change")) < 1e-6).alias("change_agrees"),
        (F.abs(F.col("population_millions") * 1e6 - value) < 1e-3).alias("millions_agree"),
    )
    return rounded(checked, {d: RATE_BITS for d in MONTH_SPEC.drivers})


@query
def forecast_coverage(spark, folder):
    """Every user, and whether a forecast is made for it."""
    panel = once(days(spark, folder))
    picked = features.full_feature_list(DAY_SPEC)
    steps = recursion.recursive_steps(
        panel, DAY_SPEC, picked, recursion.mean_of_lags(DAY_SPEC, picked)
    )
    return recursion.coverage(panel, steps, DAY_SPEC)
