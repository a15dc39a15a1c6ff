"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents, shuffled by hash, form a stream of words that is cut
into blocks of equal size. The points of a golden-ratio sequence, mapped
through the sources' cumulative shares, say which source fills each slot of the
mix; a source's n-th slot takes its n-th block.

Everything is DataFrame expressions. Running totals are taken in two steps, per
bucket and over the buckets' sums, so that a source of any size is spread out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesloom.llm.rows import BLANKS, packed, same, unpacked
from seriesloom.session import written

# Fixed values of the mix: weights by rank of the source, and its size.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2

# Slots of the schedule, about; a block holds the mix's words over this number.
SLOTS = 1 << 14
# Slots between which running counts are carried, and pieces of the cumulative shares.
STRETCH = 512
CELLS = 1024

GOLDEN = (5**0.5 - 1) / 2


def n_words(text: Column) -> Column:
    """Number of runs of anything but ASCII blanks."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, f"[{BLANKS}]+"))).cast("long")


def running(df: DataFrame, keys: list[str], bucket: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all earlier rows of the same keys.

    Rows are ordered by ``bucket``, then by ``order``. A window sees one bucket;
    another sees one row per bucket.
    """
    valued = df.withColumn("_value", value)
    sums = valued.groupBy(*keys, bucket).agg(F.sum("_value").alias("_sum"))
    # one row per bucket, so a few thousand for a key at most
    over = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)]).orderBy(bucket)
    earlier = F.sum("_sum").over(over.rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select(*keys, bucket, F.coalesce(earlier, F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    within = F.sum("_value").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (
        valued.withColumn("_within", F.coalesce(within, F.lit(0)))
        .join(starts, [*keys, bucket])
        .withColumn(name, F.col("_start") + F.col("_within"))
        .drop("_start", "_within", "_value")
    )


def source_targets(sizes: DataFrame) -> DataFrame:
    """(src, source, source_size, weight, target) of (source, source_size).

    ``src`` ranks the sources by code point, null last. Sources above the most
    they may give are set to it and the rest is shared anew, until none is above.
    """
    ranged = written(
        sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn(
            "part", F.spark_partition_id()
        ),
        "sources",
    ).withColumn("last", F.col("source").isNull())
    ranked = running(ranged, [], "part", ["last", "source"], F.lit(1).cast("long"), "src")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("src") % len(WEIGHTS)).cast("int") + 1)
    sources = written(ranked.select("src", "part", "source", "source_size", weight.alias("weight")), "weights")

    total = sources.agg(F.sum("source_size")).first()[0] or 0
    unit, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(unit) > MOST * F.col("source_size")
        n, given, weights = sources.agg(
            F.count_if(above),
            F.sum(F.when(above, MOST * F.col("source_size"))),
            F.sum(F.when(~above, F.col("weight"))),
        ).first()
        if n == capped or not weights:
            break
        capped, unit = n, (SHARE * total - (given or 0)) / weights
    share = F.col("weight") * F.lit(unit)
    most = MOST * F.col("source_size").cast("double")
    return sources.withColumn("target", F.when(share > most, most).otherwise(share))


def schedule(sources: DataFrame, slots: int) -> tuple[DataFrame, int]:
    """(slot, src, block): which block of which source fills each slot; and words per block.

    A source is given as many slots as its target has blocks. The points come
    within a few slots of that; what they give beyond is left out, and what
    they lack follows at the end.
    """
    total = sources.agg(F.sum(F.floor("target"))).first()[0] or 0
    block = max(1, -(-total // slots))
    wanted = sources.select("src", "part", F.floor("target").alias("quota")).withColumn(
        "n", F.ceil(F.col("quota") / block).cast("long")
    )
    spans = written(running(wanted, [], "part", ["src"], F.col("n"), "low"), "spans")
    length = spans.agg(F.sum("n")).first()[0] or 0
    width = max(1, -(-length // CELLS))

    point = F.lit(GOLDEN) * (F.col("slot") + 0.5)
    at = F.least(F.floor((point - F.floor(point)) * length), F.lit(length - 1))
    points = (
        sources.sparkSession.range(length)
        .withColumnRenamed("id", "slot")
        .withColumn("at", at.cast("long"))
        .withColumn("cell", F.floor(F.col("at") / width))
    )
    last = F.col("low") + F.col("n") - 1
    cells = F.sequence(F.floor(F.col("low") / width), F.floor(last / width))
    pieces = spans.filter("n > 0").select("src", "low", last.alias("high"), F.explode(cells).alias("cell"))
    dealt = (
        points.join(pieces, "cell")
        .filter(F.col("at").between(F.col("low"), F.col("high")))
        .select("src", "slot", F.floor(F.col("slot") / STRETCH).alias("stretch"))
    )
    ranked = running(dealt, ["src"], "stretch", ["slot"], F.lit(1).cast("long"), "block")
    given = dealt.groupBy("src").agg(F.count("*").alias("given"))
    kept = ranked.join(spans.select("src", "n"), "src").filter("block < n").select("slot", "src", "block")
    lacking = (
        spans.join(given, "src", "left")
        .withColumn("given", F.coalesce("given", F.lit(0).cast("long")))
        .filter("given < n")
        .select("src", "low", F.explode(F.sequence(F.col("given"), F.col("n") - 1)).alias("block"))
        .select((F.lit(length) + F.col("low") + F.col("block")).alias("slot"), "src", "block")
    )
    return kept.unionByName(lacking), block


class Mix:
    """The mix of one corpus: ``docs`` per row, ``sources``, and ``pieces`` slot by slot.

    Sizes are words of the text; null and blank texts have none and are never
    taken. Rows without a source form one, ranked last; rows without an id are
    documents like others. Repeated rows count each. An empty table has no
    sources and an empty mix.

    ``docs``: id, th (hash of the text), copy (number among equal rows), source,
    size, source_size, target, taken. ``pieces``: slot, src, block, id, th, copy
    and the words [begin, end) of the document in the order they are to be read.
    """

    def __init__(self, docs: DataFrame, doc_id="doc_id", text="text", source="source", slots: int = SLOTS):
        key = F.md5(F.coalesce(docs[doc_id].cast("string"), F.lit("")).cast("binary"))
        base = written(
            docs.select(
                docs[doc_id].alias("id"),
                F.xxhash64(docs[text]).alias("th"),
                docs[source].cast("string").alias("source"),
                n_words(docs[text]).alias("size"),
                key.alias("key"),
            ),
            "sizes",
        )
        sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
        self.sources = written(source_targets(sizes), "targets")
        named = self.sources.select(
            "src", F.col("source").alias("name"), "source_size", "target", F.floor("target").alias("quota")
        )
        shuffled = base.join(named, base.source.eqNullSafe(F.col("name"))).drop("name")
        order = ["key", "size", "th"]
        placed = running(
            shuffled.withColumn("bucket", F.substring("key", 1, 3)), ["src"], "bucket", order, F.col("size"), "before"
        )
        equal = Window.partitionBy("id", "th").orderBy("src", "before")
        self.placed = written(placed.withColumn("copy", F.row_number().over(equal)), "placed")
        self.pieces = self._pieces(slots)
        taken = self.pieces.groupBy("src", "before").agg(F.sum(F.col("end") - F.col("begin")).alias("taken"))
        self.docs = (
            self.placed.join(taken.withColumnRenamed("src", "s").withColumnRenamed("before", "b"),
                             (F.col("src") == F.col("s")) & (F.col("before") == F.col("b")) & (F.col("size") > 0), "left")
            .select(
                "id", "th", "copy", "source", "size", "source_size", "target",
                F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
            )
        )

    def _pieces(self, slots: int) -> DataFrame:
        plan, block = schedule(self.sources, slots)
        rounds = F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))).alias("round")
        low = F.col("round") * F.col("source_size") + F.col("before")
        high = F.least(low + F.col("size"), F.col("quota"))
        runs = (
            self.placed.select("*", rounds)
            .select("src", "id", "th", "copy", "before", low.alias("low"), high.alias("high"))
            .filter("low < high")
        )
        blocks = F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block))
        cut = runs.withColumn("block", F.explode(blocks))
        begin = F.greatest(F.col("low"), F.col("block") * block) - F.col("low")
        end = F.least(F.col("high"), (F.col("block") + 1) * block) - F.col("low")
        # merged, never broadcast: Spark sizes the blocks of a run like the one row they come from
        return cut.hint("merge").join(plan, ["src", "block"]).select(
            "slot", "src", "block", "id", "th", "copy", "before", begin.alias("begin"), end.alias("end")
        )


def mix(docs: DataFrame, doc_id="doc_id", text="text", source="source", slots: int = SLOTS) -> DataFrame:
    """The rows of ``docs`` that the mix takes words of, with size, source_size, target and taken."""
    found = Mix(docs, doc_id, text, source, slots).docs.filter("taken > 0")
    whole = packed(docs, id=docs[doc_id], th=F.xxhash64(docs[text]))
    numbered = whole.withColumn(
        "copy", F.row_number().over(Window.partitionBy("id", "th").orderBy("th"))
    )
    joined = numbered.join(found, same(numbered, found, "id", "th", "copy"))
    return unpacked(
        joined, **{c: found[c] for c in ("size", "source_size", "target", "taken")}
    )
