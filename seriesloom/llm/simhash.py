"""SimHash near-dedup by multi-index hashing.

A fingerprint's bit is set where most hashed word shingles set it. Fingerprints
are cut into segments; within each, every value of a small Hamming ball is
looked up in the table of segments, and candidates are checked over all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.components import components
from seriesloom.llm.rows import fingerprint, packed, same, unpacked
from seriesloom.session import written

BITS = 64
# Hashes unpacked to bits at once.
CHUNK = 1 << 15


def simhash(text: str | None, shingle: int, seed: int) -> int:
    """Signed 64-bit fingerprint of one text; 0 where it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([digest(line[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * votes > len(starts)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def with_fingerprint(
    docs: DataFrame, doc_id: str, text: str, shingle: int, seed: int, **more: Column
) -> DataFrame:
    """(id, fp) of every row, and long columns of the row that are asked for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = [simhash(t, shingle, seed) for t in batch["text"]]
            yield batch.drop(columns="text").assign(fp=np.array(prints, np.int64))

    own = [value.alias(name) for name, value in more.items()]
    frame = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].alias("text"), *own)
    return frame.mapInPandas(run, ", ".join(f"{name} long" for name in ("id", *more, "fp")))


def segments(max_bits: int, parts: int) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each segment.

    The radii plus one sum to ``max_bits`` + 1, so two fingerprints that differ
    in no more bits agree up to the radius in one segment at least.
    """
    parts = min(parts, max_bits + 1)
    cuts = [BITS * i // parts for i in range(parts + 1)]
    base, more = divmod(max_bits + 1, parts)
    return [
        (cuts[i], cuts[i + 1] - cuts[i], base + (i < more) - 1) for i in range(parts)
    ]


def _ball(width: int, radius: int) -> list[int]:
    """All flips of up to ``radius`` of ``width`` bits."""
    return [
        sum(1 << b for b in bits)
        for r in range(radius + 1)
        for bits in combinations(range(width), r)
    ]


def _segment_values(prints: DataFrame, parts, flips: bool) -> DataFrame:
    """(fp, seg, value): the segments of each fingerprint, or the balls around them."""
    probes = [
        F.struct(F.lit(i).alias("seg"), F.lit(low).alias("low"), F.lit((1 << width) - 1).alias("mask"), F.lit(flip).alias("flip"))
        for i, (low, width, radius) in enumerate(parts)
        for flip in (_ball(width, radius) if flips else [0])
    ]
    at = F.explode(F.array(*probes)).alias("p")
    value = F.expr("(shiftrightunsigned(fp, p.low) & p.mask) ^ p.flip")
    return prints.select("fp", at).select("fp", "p.seg", value.alias("value"))


def _spanning(block: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Edges that connect what the links of one block of a bucket connect.

    ``home`` rows are linked to the visitors near them; each adds an edge to
    every piece it touches, so there are never more edges than rows.
    """
    homes = block.loc[block["home"], "fp"].to_numpy(np.int64).view(np.uint64)
    guests = block.loc[~block["home"], "fp"].to_numpy(np.int64).view(np.uint64)
    piece = np.arange(len(guests))
    links: list[tuple[np.uint64, np.uint64]] = []
    for fp in homes:
        near = np.bitwise_count(guests ^ fp) <= max_bits
        touched = np.unique(piece[near])
        if len(touched):
            links += [(fp, guests[t]) for t in touched]
            piece[np.isin(piece, touched)] = touched[0]
    edges = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"u": edges[:, 0], "v": edges[:, 1]})


def links(prints: DataFrame, max_bits: int, parts: int, small: int, block: int) -> DataFrame:
    """Edges (u, v) whose components are those of all links of ``prints``, one row each.

    In buckets of up to ``small`` fingerprints every link found is an edge. A
    larger bucket is dealt out in blocks, against blocks of the probes that
    reach it; each pair of blocks gives a spanning set of its links.
    """
    plan = segments(max_bits, parts)
    table = _segment_values(prints, plan, flips=False)
    probes = _segment_values(prints, plan, flips=True).withColumnRenamed("fp", "guest")
    crowded = written(
        table.groupBy("seg", "value").agg(F.count("*").alias("n")).filter(F.col("n") > small),
        "crowded",
    )
    quiet = table.join(crowded, ["seg", "value"], "left_anti")
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("guest")))
    # merged, never broadcast: Spark sizes a probe of every flip like the one row it comes from
    few = (
        quiet.join(
            probes.hint("merge"),
            (quiet.seg == probes.seg)
            & (quiet.value == probes.value)
            & (F.col("fp") < F.col("guest"))
            & (differ <= max_bits),
        )
        .select(F.col("fp").alias("u"), F.col("guest").alias("v"))
    )
    if crowded.isEmpty():
        return few

    guests = probes.join(crowded.select("seg", "value"), ["seg", "value"])
    # written, so that its size is known and it is the side that may be broadcast
    sizes = written(
        crowded.join(
            guests.groupBy("seg", "value").agg(F.count("*").alias("m")), ["seg", "value"]
        ).select(
            "seg",
            "value",
            F.ceil(F.col("n") / block).cast("int").alias("hn"),
            F.ceil(F.col("m") / block).cast("int").alias("gn"),
        ),
        "sizes",
    )

    def dealt(rows: DataFrame, own: str, others: str) -> list:
        mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(others) - 1))
        return rows.join(sizes, ["seg", "value"]).select(
            "seg", "value", "fp", mine.alias(own[0]), every.alias(others[0])
        )

    homes = dealt(table, "hn", "gn").withColumn("home", F.lit(True))
    visits = dealt(guests.withColumnRenamed("guest", "fp"), "gn", "hn").withColumn("home", F.lit(False))
    # dealt out by all keys: the joins' own partitions hold whole buckets
    many = (
        homes.unionByName(visits)
        .repartition("seg", "value", "h", "g")
        .groupBy("seg", "value", "h", "g")
        .applyInPandas(lambda b: _spanning(b, max_bits), "u long, v long")
    )
    return few.unionByName(many)


def simhash_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    max_bits: int = 4,
    seed: int = 42,
    parts: int = 3,
    small: int = 64,
    block: int = 2048,
    **more: Column,
) -> DataFrame:
    """(id, fp, component): every row's fingerprint and the smallest id it reaches.

    ``more`` names long columns that are carried beside the id.

    Copies meet in one fingerprint, so only distinct fingerprints are compared.
    A null or wordless text has fingerprint 0 and is linked like any other.
    Rows without an id take part, but no component is named after them; a group
    of such rows alone has a null component. Repeated rows are told apart by
    nothing and share a component. An empty table gives an empty one.
    """
    found = written(with_fingerprint(docs, doc_id, text, shingle, seed, **more), "fingerprints")
    prints = written(found.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    roots = components(links(prints.select("fp"), max_bits, parts, small, block))
    placed = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component"))
    return found.join(placed.join(named, "root").select("fp", "component"), "fp")


def hex_digits(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that represent their group: those with its smallest id.

    Rows without an id stay only where their group has no id at all. Rows that
    repeat an id and a text stay or go together; other rows of an id are judged
    by the group of their own text.
    """
    h1, h2 = fingerprint(docs[text])
    groups = simhash_groups(docs, doc_id, text, h1=h1, h2=h2, **settings)
    gone = groups.filter(~F.col("id").eqNullSafe(F.col("component"))).select("id", "h1", "h2").distinct()
    whole = packed(docs, id=docs[doc_id].cast("long"), h1=h1, h2=h2)
    return unpacked(whole.join(gone, same(whole, gone, "id", "h1", "h2"), "left_anti"))
