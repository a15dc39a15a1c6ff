"""Near-copies among embeddings: HNSW graphs per shard, verified cosine, components.

Vectors with one label are dealt into shards of bounded size. Each shard builds
a graph; every vector is looked up in every shard of its label; what lies
within the cosine is linked, and linked vectors are joined to components.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.components import components
from seriesloom.llm.hnsw import Graph
from seriesloom.llm.rows import packed, unpacked
from seriesloom.session import written

SHARD = 8192
LINKS = 16
BUILD_BEAM = 48
BEAM = 48
# Queries audited at least, and the share of its links and nearest nodes each of them must find.
AUDIT = 64
RECALL = 0.99

NODE = (
    "label string, dim int, shard int, shards int, h1 long, h2 long, id long, n long, vector array<double>, "
    "level int, links array<array<int>>, n_links long, root long"
)


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no null, infinite or NaN component, and not all zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors) -> np.ndarray:
    rows = np.array([np.asarray(v, np.float64) for v in vectors])
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("id,id->i", rows, rows))[:, None]


def _roots(ids: np.ndarray, row: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Smallest id that each node reaches over the links (row, node)."""
    order = np.argsort(ids, kind="stable")
    root = np.empty(len(ids), np.int64)
    root[order] = np.arange(len(ids))
    while True:
        least = root.copy()
        np.minimum.at(least, row, root[node])
        np.minimum.at(least, node, root[row])
        least = least[order[least]]
        if (least == root).all():
            return ids[order[root]]
        root = least


def _built(shard: pd.DataFrame, least: float) -> pd.DataFrame:
    """One shard's graph, one row per node, with its links inside the shard."""
    shard = shard.sort_values(["h1", "h2"], ignore_index=True)
    # the level comes from the hash, so that a task run anew builds the same graph
    chance = ((shard["h2"].to_numpy(np.int64).view(np.uint64) >> np.uint64(11)) + 0.5) / 2.0**53
    shard["level"] = np.floor(-np.log(chance) / np.log(LINKS)).astype(int)
    shard = shard.sort_values("level", ascending=False, kind="stable", ignore_index=True)
    unit, levels = _unit(shard["vector"]), shard["level"].to_numpy()
    graph = Graph.build(unit, levels, LINKS, BUILD_BEAM)
    row, node = graph.links(unit, least, BEAM, AUDIT, RECALL, np.arange(len(unit)))
    other = row != node
    row, node = row[other], node[other]
    many, ids = shard["n"].to_numpy(), shard["id"].to_numpy()
    shard["n_links"] = (many - 1 + np.bincount(row, many[node], len(shard))).astype(int)
    shard["root"] = _roots(ids, row, node)
    shard["vector"] = list(unit)
    shard["links"] = [
        [layer[i][layer[i] >= 0] for layer in graph.layers[: levels[i] + 1]] for i in range(len(shard))
    ]
    return shard


def _loaded(nodes: pd.DataFrame) -> Graph:
    layers = []
    for level in range(int(nodes["level"].iloc[0]) + 1):
        lists = [links[level] for links in nodes["links"] if len(links) > level]
        layer = np.full((len(lists), max(1, max(map(len, lists)))), -1, np.int32)
        for i, found in enumerate(lists):
            layer[i, : len(found)] = found
        layers.append(layer)
    return Graph(np.array(nodes["vector"].tolist()), layers)


def _across(nodes: pd.DataFrame, queries: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links of another shard's vectors into this one: how many, and into which of its pieces."""
    columns = ["h1", "h2", "id", "n_links", "roots"]
    if not len(nodes) or not len(queries):
        return pd.DataFrame(columns=columns)
    nodes = nodes.sort_values(["level", "h1", "h2"], ascending=[False, True, True], ignore_index=True)
    row, node = _loaded(nodes).links(
        np.array(queries["vector"].tolist()), least, BEAM, AUDIT, RECALL
    )
    count = np.bincount(row, nodes["n"].to_numpy()[node], len(queries)).astype(int)
    pairs = pd.DataFrame({"row": row, "root": nodes["root"].to_numpy()[node]}).drop_duplicates()
    roots = pairs.groupby("row")["root"].agg(list)
    found = queries[["h1", "h2", "id"]].reset_index(drop=True)
    found["n_links"] = count
    found["roots"] = [roots.get(i, []) for i in range(len(found))]
    return found[found["n_links"] > 0]


def embedding_neardup(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    least: float = 0.98,
    shard: int = SHARD,
) -> DataFrame:
    """``vectors`` with ``n_links``, ``component_id`` and ``kept`` (the id is the component's).

    Vectors link at a cosine of ``least`` or more if their labels are equal and
    not null and they have as many components. A vector that is null, zero,
    empty or holds a null or non-finite component links with nothing, nor does
    a row without an id or a label: its component is its own id. Equal vectors
    count as links of each other and are looked up once; rows that repeat an id
    and a vector are one vector. An empty table gives an empty one.
    """
    good = (
        vectors[vec_id].isNotNull() & vectors[label].isNotNull() & usable(vectors[embedding])
    )
    wide = vectors[embedding].cast("array<double>")
    name = vectors[label].cast("string")
    marks = [
        F.when(good, F.xxhash64(F.lit(seed), name, F.size(wide), wide)) for seed in (1, 2)
    ]
    rows = written(
        vectors.select(
            vectors[vec_id].cast("long").alias("id"),
            *[m.alias(f"h{i}") for i, m in enumerate(marks, 1)],
            name.alias("label"),
            wide.alias("vector"),
        ).filter("h1 is not null"),
        "vectors",
    )
    alike = rows.groupBy("label", F.size("vector").alias("dim"), "h1", "h2").agg(
        F.min("id").alias("id"),
        F.count_distinct("id").alias("n"),
        F.first("vector").alias("vector"),
    )
    alike = written(alike, "distinct")
    shards = alike.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    placed = alike.join(shards, ["label", "dim"]).withColumn(
        "shard", F.pmod("h1", "shards").cast("int")
    )
    # dealt out by all keys: the join's own partitions hold whole labels
    graphs = written(
        placed.repartition("label", "dim", "shard")
        .groupBy("label", "dim", "shard")
        .applyInPandas(lambda part: _built(part, least)[[c.split()[0] for c in NODE.split(", ")]], NODE),
        "graphs",
    )
    found = graphs.select("h1", "h2", "id", "n_links", F.array("root").alias("roots"))

    spread = graphs.filter("shards > 1")
    if not spread.isEmpty():
        others = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
        nodes = spread.withColumn("asking", others).filter("asking <> shard")
        queries = spread.select(
            "label", "dim", F.col("shard").alias("asking"), "h1", "h2", "id", "vector", others.alias("shard")
        ).filter("asking <> shard")
        queries = queries.toDF(*queries.columns)  # a table of its own for the cogrouping
        keys = ["label", "dim", "shard", "asking"]
        across = nodes.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
            lambda a, b: _across(a, b, least),
            "h1 long, h2 long, id long, n_links long, roots array<long>",
        )
        found = written(found.unionByName(across), "links")

    edges = found.select(F.col("id").alias("u"), F.explode("roots").alias("v"))
    roots = components(edges).withColumnRenamed("root", "component_id")
    counts = found.groupBy("h1", "h2", "id").agg(F.sum("n_links").alias("n_links"))
    results = counts.join(roots, counts.id == roots.node, "left").select(
        F.col("h1").alias("g1"),
        F.col("h2").alias("g2"),
        "n_links",
        F.coalesce("component_id", "id").alias("component_id"),
    )
    whole = packed(
        vectors, id=vectors[vec_id].cast("long"), h1=marks[0], h2=marks[1]
    )
    joined = whole.join(
        results, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")), "left"
    )
    component = F.coalesce("component_id", "id")
    return unpacked(
        joined,
        n_links=F.coalesce("n_links", F.lit(0).cast("long")),
        component_id=component,
        kept=F.col("id").eqNullSafe(component),
    )
