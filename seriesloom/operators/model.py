"""One boosted-tree model over all series of a panel, with Spark ML."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.operators.boosting import Booster, grow_until
from seriesloom.operators.features import (
    LOOKBACK,
    WINDOWS,
    Feature,
    feature_list,
    select_features,
    with_numeric_values,
)
from seriesloom.operators.history import cut, with_positions
from seriesloom.operators.metrics import score, score_by_series
from seriesloom.operators.split import SEED, TEST_SIZE, split_random
from seriesloom.session import written
from seriesloom.sources import versions
from seriesloom.spec import PanelSpec

log = logging.getLogger(__name__)

# Training defaults of the two model variants.
FULL_DEFAULTS = {"iterations": 1000, "learning_rate": 0.05, "depth": 6, "l2_leaf_reg": 3.0}
BASIC_DEFAULTS = {"iterations": 1000, "learning_rate": 0.1, "depth": 6, "l2_leaf_reg": 3.0}

# Settings users of other boosting libraries pass that change no result.
WITHOUT_COUNTERPART = ("verbose",)

# Stands for a missing driver: below every value, so a tree can split it off.
BELOW_ALL = -1e300

TOP_FEATURES = 10

# Rows that a task of the trainer has at least, where there are so many.
ROWS_OF_A_TASK = 20_000


@dataclass(frozen=True)
class BoostingParams:
    """Settings of the trainer; ``early_stopping_rounds`` of 0 or None never stops early.

    ``stopping="patience"`` keeps the best round before the first
    ``early_stopping_rounds`` rounds without progress on the validation rows,
    and trains as many rounds as it keeps and waits for.
    ``stopping="tolerance"`` is Spark's own rule: stop as soon as a round gains
    less than ``stopping_tolerance`` on the validation rows.

    ``l2_leaf_reg`` draws leaf values towards zero: a leaf's sum is divided by
    its rows plus this. ``refit`` trains the rounds to be kept once more, on the
    validation rows too, unless those are the test rows.
    """

    iterations: int = 1000
    learning_rate: float = 0.05
    depth: int = 6
    early_stopping_rounds: int | None = 50
    stopping: str = "patience"
    stopping_tolerance: float = 0.0
    random_seed: int = SEED
    loss_function: str = "RMSE"
    l2_leaf_reg: float = 3.0
    max_bins: int = 32
    refit: bool = False

    def __post_init__(self):
        if self.loss_function != "RMSE":
            raise ValueError("only loss_function='RMSE' is supported")
        if self.stopping not in ("tolerance", "patience"):
            raise ValueError("stopping must be 'tolerance' or 'patience'")
        if self.l2_leaf_reg < 0:
            raise ValueError("l2_leaf_reg must not be negative")

    def override(self, settings: Mapping | None) -> BoostingParams:
        known = dict(settings or {})
        for name in WITHOUT_COUNTERPART:
            if known.pop(name, None) is not None:
                log.warning("%s has no counterpart in Spark ML and is ignored", name)
        unknown = set(known) - set(asdict(self))
        if unknown:
            raise ValueError(f"unknown training settings: {sorted(unknown)}")
        return replace(self, **known)


@dataclass(frozen=True)
class FeatureChoice:
    """Which features a model reads; kept with the model, never inferred from a table."""

    feature_set: str = "causal"
    lookback: int = LOOKBACK
    windows: tuple[int, ...] = WINDOWS

    def features(self, spec: PanelSpec) -> list[Feature]:
        return feature_list(spec, self.feature_set, self.lookback, self.windows)

    @property
    def filled(self) -> bool:
        return self.feature_set != "basic"


@dataclass(frozen=True)
class TrainedModel:
    pipeline: PipelineModel
    spec: PanelSpec
    choice: FeatureChoice
    scored: DataFrame | None = field(default=None, repr=False)
    series_metrics: DataFrame | None = field(default=None, repr=False)

    @property
    def feature_names(self) -> list[str]:
        return [f.name for f in self.choice.features(self.spec)]

    def predictor(self) -> Callable[[DataFrame], DataFrame]:
        """A function adding ``prediction`` to rows that hold the model's features."""
        inputs = _assembled(self.spec, self.feature_names)
        return lambda df: self.pipeline.transform(df.select("*", inputs)).drop(
            "__inputs", "features"
        )

    def predict(self, df: DataFrame) -> DataFrame:
        return self.predictor()(df)

    def metrics(self) -> DataFrame:
        """Errors over all series, one row."""
        if self.scored is None:
            raise ValueError("a loaded model holds no scored rows; use series_metrics")
        return score(self.scored, self.spec)


def _inputs(spec: PanelSpec, names: Sequence[str]) -> dict[str, Column]:
    """What the trees see of each feature: a double, below all values where a driver is missing."""
    values = {name: F.col(name).cast("double") for name in names}
    missing = F.lit(BELOW_ALL)
    return {n: F.coalesce(v, missing) if n in spec.drivers else v for n, v in values.items()}


def input_values(model: TrainedModel) -> dict[str, Column]:
    """The inputs of a trained model by the names of its features."""
    return _inputs(model.spec, model.feature_names)


def _assembled(spec: PanelSpec, names: Sequence[str]) -> Column:
    return F.struct(*[v.alias(n) for n, v in _inputs(spec, names).items()]).alias("__inputs")


def training_table(
    panel: DataFrame,
    spec: PanelSpec,
    choice: FeatureChoice = FeatureChoice(),
    test_size: float = TEST_SIZE,
    drop_warmup: bool = True,
) -> DataFrame:
    """Features with ``is_test`` and ``is_validation``.

    The test rows are the last ``test_size`` of each series, the validation rows
    the last ``test_size`` of what comes before. ``drop_warmup`` leaves out the
    rows whose lags reach before the start of the series.
    """
    numeric = cut(with_numeric_values(panel, spec).select(*spec.columns), spec)
    features = choice.features(spec)
    flags = ["is_test", "is_validation"]
    if not choice.filled:
        complete = select_features(numeric, spec, features, filled=False).na.drop("any")
        return _with_flags(complete, spec, test_size).drop("__position")
    # the narrow panel is numbered, not the wide table of features
    flagged = _with_flags(numeric, spec, test_size)
    table = select_features(flagged, spec, features, keep=[*flags, "__position"])
    if drop_warmup:
        table = table.filter(F.col("__position") > choice.lookback)
    return table.drop("__position")


def _with_flags(df: DataFrame, spec: PanelSpec, test_size: float) -> DataFrame:
    numbered = with_positions(df, spec, "__position", "__length")
    share = F.lit(1.0 - test_size)
    train_rows = F.floor(F.col("__length").cast("double") * share)
    fit_rows = F.floor(train_rows.cast("double") * share)
    position = F.col("__position")
    is_validation = (position > fit_rows) & (position <= train_rows)
    return numbered.withColumns(
        {"is_test": position > train_rows, "is_validation": is_validation}
    ).drop("__length")


def train_basic(
    panel: DataFrame,
    spec: PanelSpec,
    params: Mapping | None = None,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    lookback: int = LOOKBACK,
    checkpoint: str | None = None,
) -> TrainedModel:
    """Drivers and lags only, random holdout, no early stop; ``checkpoint`` as for :func:`train`."""
    choice = FeatureChoice("basic", lookback)
    features = select_features(panel, spec, choice.features(spec), filled=False).na.drop("any")
    table = split_random(features, spec, test_size, seed)
    defaults = BoostingParams(**BASIC_DEFAULTS, early_stopping_rounds=None, random_seed=seed)
    return fit(table, spec, choice, defaults.override(params), checkpoint)


def train(
    panel: DataFrame,
    spec: PanelSpec,
    params: Mapping | None = None,
    choice: FeatureChoice = FeatureChoice(),
    test_size: float = TEST_SIZE,
    drop_warmup: bool = True,
    stop_on_test: bool = False,
    checkpoint: str | None = None,
) -> TrainedModel:
    """All (causal) features, time-ordered holdout, early stop.

    ``stop_on_test`` lets the test rows decide when to stop, which makes the test
    error optimistic; by default the end of the training rows decides.

    ``checkpoint`` is a folder for the rounds: training that was stopped, or is
    asked for more rounds, goes on from those it holds.
    """
    table = training_table(panel, spec, choice, test_size, drop_warmup)
    if stop_on_test:
        table = table.withColumn("is_validation", F.col("is_test"))
    return fit(table, spec, choice, BoostingParams(**FULL_DEFAULTS).override(params), checkpoint)


def fit(
    table: DataFrame,
    spec: PanelSpec,
    choice: FeatureChoice,
    params: BoostingParams,
    checkpoint: str | None = None,
) -> TrainedModel:
    """Train on the rows of ``table`` that are not test rows, and score all rows.

    The table is written to the shared folder first: the trainer passes over it
    many times and must not rebuild the panel when an executor is lost.
    """
    if "is_validation" not in table.columns:
        table = table.withColumn("is_validation", F.lit(False))
    names = [f.name for f in choice.features(spec)]
    flags = ("is_test", "is_validation")
    table = written(
        table.filter(F.col(spec.target).isNotNull()).select(
            spec.series_key, spec.order_col, spec.target, *names, *flags
        ),
        "features",
    )
    known = table.filter(~F.col("is_test") | F.col("is_validation"))
    counted, trained_on = known.agg(F.count("*"), F.count_if(~F.col("is_validation"))).first()
    if not trained_on:
        raise ValueError("not enough rows to train on after building the features")
    stop_early = bool(params.early_stopping_rounds)
    validate = stop_early and counted > trained_on

    # the nested inputs keep a feature's name apart from the column of the panel
    inputs = [f"__inputs.{name}" for name in names]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    flag = F.col("is_validation") if validate else F.col("is_test") & F.lit(False)
    vectors = assembler.transform(known.select("*", _assembled(spec, names))).select(
        "features", F.col(spec.target).cast("double").alias("label"), flag.alias("is_validation"), "is_test"
    )
    # a round passes over the rows level by level; tasks of few rows are all overhead
    rows = written(vectors.coalesce(-(-counted // ROWS_OF_A_TASK)), "vectors")
    booster, count = _boosted(rows, params, validate, checkpoint)
    pipeline = PipelineModel(stages=[assembler, booster.ensemble(count)])
    booster.close()

    trained = TrainedModel(pipeline, spec, choice)
    scored = trained.predict(table).select(
        spec.series_key, spec.order_col, spec.target, *flags, "prediction"
    )
    scored = written(scored, "scored")
    return replace(trained, scored=scored, series_metrics=score_by_series(scored, spec))


def _boosted(
    rows: DataFrame, params: BoostingParams, validate: bool, checkpoint: str | None
) -> tuple[Booster, int]:
    """The trained rounds, and how many of them to keep."""
    settings = {
        "learning_rate": params.learning_rate,
        "depth": params.depth,
        "penalty": params.l2_leaf_reg,
        "max_bins": params.max_bins,
        "seed": params.random_seed,
    }
    booster = Booster(rows, **settings, checkpoint=checkpoint)
    tolerance = params.stopping_tolerance if params.stopping == "tolerance" else None
    count = grow_until(booster, params.iterations, params.early_stopping_rounds, tolerance)
    if not (validate and params.refit):
        return booster, count
    booster.close()
    kept = rows.filter(~F.col("is_test")).withColumn("is_validation", F.lit(False))
    again = Booster(kept, **settings, checkpoint=checkpoint and f"{checkpoint}/refit")
    return again, grow_until(again, count, None)


def feature_importance(model: TrainedModel, top: int | None = None) -> DataFrame:
    """Features by descending importance; importances sum to 100.

    The importances are part of the model on the driver: a number per feature.
    """
    spark = session_of(model)
    names = model.feature_names
    # the model counts features up to the last one that it uses
    weights = [*model.pipeline.stages[-1].featureImportances.toArray(), *[0.0] * len(names)]
    rows = [(n, float(w) * 100) for n, w in zip(names, weights)]
    ranked = spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
    return ranked if top is None else ranked.limit(top)


def session_of(model: TrainedModel) -> SparkSession:
    """The session of the model's tables; the active one for a model without any."""
    tables = [t for t in (model.scored, model.series_metrics) if t is not None]
    return tables[0].sparkSession if tables else SparkSession.active()


def save_model(model: TrainedModel | None, path: str) -> None:
    """Write the model, what it needs to be used again, and its errors per series.

    They go to a fresh folder below ``path``, which counts from the moment the
    marker in ``path`` names it: a save that is stopped leaves the former model
    as it was. The former version is kept beside the new one, since tables read
    from it may be in use; older ones go.
    """
    if model is None:
        raise ValueError("the model has not been trained yet")
    spark = session_of(model)
    former, version = versions.committed(spark, path), versions.fresh(path)
    model.pipeline.write().save(f"{version}/pipeline")
    errors = model.series_metrics
    if errors is not None:
        errors.write.parquet(f"{version}/metrics")
    kept = {
        "spec": asdict(model.spec),
        "choice": asdict(model.choice),
        "has_errors": errors is not None,
    }
    spark.createDataFrame([(json.dumps(kept),)], "settings string").write.json(f"{version}/settings")
    name = version.rsplit("/", 1)[1]
    versions.commit(spark, path, name)
    versions.remove_others(spark, path, {name, former})


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    """Read a saved model; the band finds the errors if any were saved with it."""
    name = versions.committed(spark, path)
    if name is None:
        raise ValueError(f"there is no saved model in {path}")
    path = f"{path}/{name}"
    pipeline = PipelineModel.load(f"{path}/pipeline")
    row = spark.read.schema("settings string").json(f"{path}/settings").first()
    settings = json.loads(row["settings"])
    spec = settings["spec"]
    spec["drivers"] = tuple(spec["drivers"])
    choice = settings["choice"]
    choice["windows"] = tuple(choice["windows"])
    return TrainedModel(
        pipeline,
        PanelSpec(**spec),
        FeatureChoice(**choice),
        series_metrics=spark.read.parquet(f"{path}/metrics") if settings["has_errors"] else None,
    )
