"""Boosted regression trees that can be continued, with penalised leaf values.

Each round fits one tree of Spark ML to what the rounds before left over, as
Spark's own boosting does: the first tree counts whole, every later one fits
twice the residual and counts by the learning rate, and without a penalty the
result is the same. With one, the value of a leaf is the sum of its rows'
residuals over their number plus the penalty; the first tree's leaves are drawn
towards the mean of the target. Sums and numbers of rows are those that the tree
was grown by, so a round reads the rows for its tree alone.

Rounds come in segments. Within one, a round's scores are cached until the next
has its own; what the rows are predicted so far is written after each, so a segment's plans hold its own trees alone, training longer trains the
further rounds only, and a job that names a checkpoint folder and is stopped
goes on from its last whole segment.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressionModel,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.session import scratch_path
from seriesloom.sources import versions

# Rounds between two writes of the rows' scores.
SEGMENT = 8

FEATURES, LABEL, SCORE, LEAF, HELD_OUT = "features", "label", "score", "leaf", "is_validation"


@dataclass(frozen=True)
class Round:
    tree: DecisionTreeRegressionModel
    values: tuple[float, ...]


class Booster:
    """Trees for rows of ``features`` (a vector), ``label`` and ``is_validation``.

    Validation rows are scored and not trained on; ``errors`` has their mean
    squared error after each round. The rows are read many times and must be a
    written table. ``settings`` are the parameters that rounds depend on.
    """

    def __init__(
        self,
        rows: DataFrame,
        learning_rate: float,
        depth: int,
        penalty: float = 0.0,
        max_bins: int = 32,
        seed: int = 42,
        checkpoint: str | None = None,
    ):
        self.spark: SparkSession = rows.sparkSession
        self.rate, self.penalty, self.checkpoint = learning_rate, penalty, checkpoint
        known = rows.filter(~F.col(HELD_OUT)).agg(F.count("*"), F.avg(LABEL)).first()
        self.mean = known[1]
        self.settings = {
            "learning_rate": learning_rate,
            "depth": depth,
            "penalty": penalty,
            "max_bins": max_bins,
            "seed": seed,
            "rows": known[0],
        }
        self.regressor = DecisionTreeRegressor(
            featuresCol=FEATURES,
            labelCol="residual",
            predictionCol="",
            leafCol=LEAF,
            maxDepth=depth,
            maxBins=max_bins,
            seed=seed,
        )
        self.rounds: list[Round] = []
        self.errors: list[float] = []
        self.trained = 0
        self.state = rows.select(FEATURES, LABEL, HELD_OUT, F.lit(0.0).alias(SCORE))
        self.state_path: str | None = None
        self.segments: list[str] = []
        if checkpoint:
            self._resume()

    def grow(self, count: int) -> None:
        """Train ``count`` more rounds as one segment."""
        start, scored, scores, cached = len(self.rounds), self.state, [], []
        for number in range(start, start + count):
            residual = 2 * (F.col(LABEL) - F.col(SCORE)) if number else F.col(LABEL)
            training = scored.filter(~F.col(HELD_OUT)).select(FEATURES, residual.alias("residual"))
            tree = self.regressor.fit(training)
            # the rows as of this round are cached now, those of the round before are read no more
            for done in cached[:-1]:
                done.unpersist()
            self.rounds.append(Round(tree, self._leaf_values(tree, number)))
            # a lost part is made again from the table of the last segment
            scored = self._advanced(scored, number).withColumn(f"score_{number}", F.col(SCORE)).persist()
            cached = [*cached[-1:], scored]
            scores.append(f"score_{number}")
        self.trained += count
        self._store(scored.select(FEATURES, LABEL, HELD_OUT, SCORE, *scores), scores)
        for done in cached:
            done.unpersist()
        if self.checkpoint:
            self._commit(start)

    def _leaf_values(self, tree: DecisionTreeRegressionModel, number: int) -> tuple[float, ...]:
        """The value of each leaf, in the order of the tree's leaf column."""
        if not self.penalty:
            return tuple(leaf_values(tree))
        centre = 0.0 if number else self.mean
        return tuple(
            centre + (value - centre) * rows / (rows + self.penalty)
            for value, rows in zip(leaf_values(tree), leaf_rows(tree))
        )

    def _advanced(self, scored: DataFrame, number: int) -> DataFrame:
        """``scored`` with the share of one round added to the score."""
        made = self.rounds[number]
        weight = self.rate if number else 1.0
        # as text, since a column is a call to the JVM for each value
        values = ", ".join(f"{float(v)!r}D" for v in made.values)
        share = F.expr(f"element_at(array({values}), cast({LEAF} + 1 as int))") * weight
        return made.tree.transform(scored).withColumn(SCORE, F.col(SCORE) + share).drop(LEAF)

    def _store(self, scored: DataFrame, scores: Sequence[str]) -> None:
        """Write the rows' scores, note the errors of the rounds, and drop what was written before."""
        path, former = scratch_path(self.spark, "boosting"), self.state_path
        scored.write.parquet(path)
        stored = self.spark.read.schema(scored.schema).parquet(path)
        squares = [F.avg((F.col(LABEL) - F.col(s)) * (F.col(LABEL) - F.col(s))) for s in scores]
        if squares:
            found = stored.filter(HELD_OUT).agg(*squares).first()
            self.errors += [e for e in found if e is not None]
        self.state, self.state_path = stored.select(FEATURES, LABEL, HELD_OUT, SCORE), path
        if former:
            versions.delete(self.spark, former)

    def close(self) -> None:
        """Delete the rows' scores."""
        if self.state_path:
            versions.delete(self.spark, self.state_path)
            self.state_path = None

    def ensemble(self, count: int | None = None, start: int = 0) -> GBTRegressionModel:
        """Rounds ``start`` to ``count`` as a model of Spark ML."""
        chosen = self.rounds[start:count]
        weights = [self.rate if n else 1.0 for n in range(start, start + len(chosen))]
        made = _assembled(self.spark, [r.tree for r in chosen], weights)
        if not self.penalty:
            return made
        return _with_leaf_values(self.spark, made, [r.values for r in chosen])

    def _commit(self, start: int) -> None:
        name = versions.fresh("", "segment").strip("/")
        self.ensemble(start=start).write().save(f"{self.checkpoint}/{name}")
        self.segments.append(name)
        kept = {"settings": self.settings, "segments": self.segments, "errors": self.errors}
        versions.commit(self.spark, self.checkpoint, json.dumps(kept))

    def _resume(self) -> None:
        """Take up the rounds of the checkpoint folder, if it has any."""
        kept = json.loads(versions.committed(self.spark, self.checkpoint) or "{}")
        if not kept:
            return
        if kept["settings"] != self.settings:
            raise ValueError(f"{self.checkpoint} holds rounds of other settings or rows")
        for name in kept["segments"]:
            saved = GBTRegressionModel.load(f"{self.checkpoint}/{name}")
            for tree in saved.trees:
                tree.setPredictionCol("").setLeafCol(LEAF).setFeaturesCol(FEATURES)
                self.rounds.append(Round(tree, tuple(leaf_values(tree))))
        self.segments, self.errors = kept["segments"], kept["errors"]
        for low in range(0, len(self.rounds), SEGMENT):
            scored = self.state
            for number in range(low, min(low + SEGMENT, len(self.rounds))):
                scored = self._advanced(scored, number)
            self._store(scored, [])


def leaf_values(tree: DecisionTreeRegressionModel) -> list[float]:
    """The predictions of a tree's leaves from left to right."""
    return [leaf.prediction() for leaf in _leaves(tree._java_obj.rootNode())]


def leaf_rows(tree: DecisionTreeRegressionModel) -> list[int]:
    """The rows that came to a tree's leaves in training, from left to right."""
    return [int(leaf.impurityStats().rawCount()) for leaf in _leaves(tree._java_obj.rootNode())]


def _leaves(node) -> list:
    if node.getClass().getSimpleName() == "LeafNode":
        return [node]
    return _leaves(node.leftChild()) + _leaves(node.rightChild())


def _assembled(
    spark: SparkSession, trees: Sequence[DecisionTreeRegressionModel], weights: Sequence[float]
) -> GBTRegressionModel:
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kinds = jvm.org.apache.spark.ml.regression
    own = gateway.new_array(kinds.DecisionTreeRegressionModel, len(trees))
    shares = gateway.new_array(jvm.double, len(trees))
    for n, (tree, weight) in enumerate(zip(trees, weights)):
        own[n], shares[n] = tree._java_obj, float(weight)
    made = kinds.GBTRegressionModel(f"boosted_{uuid.uuid4().hex[:12]}", own, shares)
    return GBTRegressionModel(made).setFeaturesCol(FEATURES)


def _with_leaf_values(
    spark: SparkSession, model: GBTRegressionModel, values: Sequence[Sequence[float]]
) -> GBTRegressionModel:
    """The model with other leaf values, by way of its stored form, in which a node is a row."""
    path = scratch_path(spark, "ensemble")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    # the leaves of a tree by number, as the leaf column counts them
    leaves = nodes.filter("nodeData.leftChild < 0").groupBy("treeID").agg(
        F.sort_array(F.collect_list("nodeData.id")).alias("ids")
    )
    rows = [(n, [float(v) for v in own]) for n, own in enumerate(values)]
    given = spark.createDataFrame(rows, "treeID int, values array<double>")
    pairs = leaves.join(given, "treeID").select(
        F.col("treeID").alias("tree"), F.inline(F.arrays_zip(F.col("ids").alias("id"), F.col("values").alias("value")))
    )
    own = (F.col("treeID") == F.col("tree")) & (F.col("nodeData.id") == F.col("id"))
    value = F.coalesce("value", "nodeData.prediction")
    changed = nodes.join(pairs, own, "left").select(
        "treeID", F.col("nodeData").withField("prediction", value).alias("nodeData")
    )
    stored = f"{path}-changed"
    changed.write.parquet(stored)
    spark.read.schema(nodes.schema).parquet(stored).write.mode("overwrite").parquet(f"{path}/data")
    loaded = GBTRegressionModel.load(path)
    # the loaded model is in memory
    for done in (path, stored):
        versions.delete(spark, done)
    return loaded


def best_round(errors: Sequence[float], patience: int) -> int:
    """Number of rounds to keep: the best one before ``patience`` rounds without progress."""
    best = 0
    for number, error in enumerate(errors):
        if error < errors[best]:
            best = number
        elif number - best >= patience:
            break
    return best + 1


def first_idle_round(errors: Sequence[float], tolerance: float) -> tuple[int, bool]:
    """Rounds to keep by Spark's own rule, and whether a round that gained too little has come."""
    best = 0
    for number, error in enumerate(errors[1:], 1):
        if errors[best] - error < tolerance * max(error, 0.01):
            return best + 1, True
        best = number
    return best + 1, False


def grow_until(
    booster: Booster, iterations: int, patience: int | None, tolerance: float | None = None
) -> int:
    """Train until the validation rows ask for no more; returns the rounds to keep.

    With ``patience`` no round beyond the best one plus ``patience`` is trained;
    with ``tolerance`` none beyond the first idle one's segment; with neither
    ``iterations`` are.
    """
    while True:
        done, limit, kept = len(booster.rounds), iterations, iterations
        if booster.errors and tolerance is not None:
            kept, idle = first_idle_round(booster.errors[:iterations], tolerance)
            limit = done if idle else limit
        elif booster.errors and patience:
            kept = best_round(booster.errors[:iterations], patience)
            limit = min(limit, kept + patience)
        if done >= limit:
            return min(kept, iterations)
        if not booster.errors and patience:
            limit = min(limit, done + patience + 1)
        booster.grow(min(SEGMENT, limit - done))
