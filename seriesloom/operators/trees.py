"""A boosted model as a table with a row per node, and what follows from it by joins.

The table holds all there is to know of the trees: predictions are sums of the
weighted values of the leaves that a row falls into, importances sums of gains.
:meth:`TrainedModel.predict` is the fast way to predict; this one shows why.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.model import TrainedModel, input_values, session_of
from seriesloom.session import scratch_path

# Names of the stored form of Spark ML's ensembles.
_NODES = "nodeData"


def tree_table(model: TrainedModel) -> DataFrame:
    """tree, weight, node, feature, threshold, left, right, value, gain and rows.

    Nodes count from the root, 0. A row goes to the node ``left`` if its feature
    is not above the threshold, else to ``right``; leaves have neither, nor a
    feature, threshold or gain. ``value`` is what a node predicts by itself, and
    ``rows`` the training rows that came to it.
    """
    spark = session_of(model)
    path = scratch_path(spark, "trees")
    model.pipeline.stages[-1].write().save(path)
    trees = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "kind", "weight")
    names = F.array(*[F.lit(name) for name in model.feature_names])
    node, inner = F.col(_NODES), F.col(f"{_NODES}.leftChild") >= 0

    def of_inner(value: Column) -> Column:
        return F.when(inner, value)

    return spark.read.parquet(f"{path}/data").join(trees, "treeID").select(
        F.col("treeID").alias("tree"),
        "weight",
        node["id"].alias("node"),
        of_inner(F.get(names, node["split"]["featureIndex"])).alias("feature"),
        of_inner(F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        of_inner(node["leftChild"]).alias("left"),
        of_inner(node["rightChild"]).alias("right"),
        node["prediction"].alias("value"),
        of_inner(node["gain"]).alias("gain"),
        node["rawCount"].alias("rows"),
    )


def predictor(
    model: TrainedModel, nodes: DataFrame, keys: Sequence[str]
) -> Callable[[DataFrame], DataFrame]:
    """A function adding ``prediction`` to rows of the model's features, by joins with ``nodes``.

    ``keys`` tell the rows apart. Each row is taken to each tree and goes down
    it a join per level, so this reads as many rows as there are rows and trees.
    """
    stage = model.pipeline.stages[-1]
    count, depth = stage.getNumTrees, max(tree.depth for tree in stage.trees)
    trees = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("tree")
    inner = nodes.filter("left is not null").select("tree", "node", "feature", "threshold", "left", "right")
    leaves = nodes.filter("left is null").select("tree", "node", "weight", "value")

    def predict(df: DataFrame) -> DataFrame:
        values = [part for n, v in input_values(model).items() for part in (F.lit(n), v)]
        at = df.select(*keys, F.create_map(*values).alias("values"), trees, F.lit(0).alias("node"))
        for _ in range(depth):
            below = F.when(F.col("values")[F.col("feature")] <= F.col("threshold"), F.col("left"))
            step = F.when(F.col("left").isNull(), F.col("node")).otherwise(below.otherwise(F.col("right")))
            at = at.join(inner, ["tree", "node"], "left").select(
                *keys, "values", "tree", step.alias("node")
            )
        share = F.sum(F.col("weight") * F.col("value")).alias("prediction")
        found = at.join(leaves, ["tree", "node"]).groupBy(*keys).agg(share)
        return df.join(found, list(keys))

    return predict


def importances(model: TrainedModel, nodes: DataFrame) -> DataFrame:
    """Every feature's share of the gains of all splits, in per cent."""
    gained = nodes.filter("left is not null").groupBy("feature").agg(
        F.sum(F.col("gain") * F.col("rows")).alias("gained")
    )
    total = gained.agg(F.sum("gained")).first()[0] or 1.0
    spark = session_of(model)
    names = spark.createDataFrame([(n,) for n in model.feature_names], "feature string")
    return names.join(gained, "feature", "left").select(
        "feature", (F.coalesce("gained", F.lit(0.0)) / total * 100).alias("importance")
    )
