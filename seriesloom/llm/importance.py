"""Importance resampling: draw the documents that are most like a target corpus.

Texts are reduced to words with single spaces between them. An overlapped scan
with a pattern per length, held at word boundaries by lookarounds, gives every
n-gram as a span of the line, which is hashed into a bucket as it is found. The
log ratio of a bucket's share in the target and in the corpus is its gain; a
document's weight is the mean gain of its n-grams, and the highest weights with
Gumbel noise are a draw without replacement.

Texts are scanned once: a document's buckets are written beside its id.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.mixing import running
from seriesloom.llm.rows import LOWER, UPPER, packed, same, unpacked
from seriesloom.session import written

BUCKETS = 10000
GRAMS = (1, 2)
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"

# Fixed value: all of ASCII but letters and digits separates words.
_SEPARATORS = regex.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWERED = str.maketrans(UPPER, LOWER)


def normal_line(text: str | None) -> bytes:
    """The words of a text, A-Z in lower case, with single spaces between them."""
    line = _SEPARATORS.sub(" ", (text or "").translate(_LOWERED)).strip(" ")
    return line.encode("utf-8", "surrogatepass")


def gram_pattern(n: int) -> regex.Pattern:
    """Runs of ``n`` words that begin and end at a space or an end of the line."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def gram_buckets(line: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """The bucket of every n-gram, repeats included."""
    spans = (m.group() for p in patterns for m in p.finditer(line, overlapped=True))
    return np.fromiter((crc32(gram) % buckets for gram in spans), np.uint32)


def _narrow(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def features(texts: DataFrame, grams: tuple[int, int], buckets: int) -> DataFrame:
    """(id, th, n_words, n_features, buckets) of (id, th, text)."""
    kind = _narrow(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [gram_pattern(n) for n in range(grams[0], grams[1] + 1)]
        for batch in batches:
            words, sizes, found = [], [], []
            for text in batch.column("text"):
                line = normal_line(text.as_py())
                own = gram_buckets(line, patterns, buckets)
                words.append(line.count(b" ") + 1 if line else 0)
                sizes.append(len(own))
                found.append(own.astype(kind).tobytes())
            made = [pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())]
            names = ["id", "th", "n_words", "n_features", "buckets"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), *made], names=names)

    return texts.mapInArrow(run, "id long, th long, n_words long, n_features long, buckets binary")


def bucket_counts(found: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): occurrences over all rows, summed within a task first."""
    kind = _narrow(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for own in batch.column("buckets"):
                np.add.at(counts, np.frombuffer(own.as_buffer(), kind), 1)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    parts = found.select("buckets").mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of all buckets: 1000 times the log ratio of smoothed shares, rounded down."""
    s, t = corpus.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    all_s, all_t = (side.agg(F.sum("n")).first()[0] or 0 for side in (corpus, target))
    counts = (
        corpus.sparkSession.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(s, "bucket", "left")
        .join(t, "bucket", "left")
        .select("bucket", *[(F.coalesce(c, F.lit(0)) + 1).cast("double").alias(c) for c in ("s", "t")])
    )
    above = F.col("t") * F.lit(float(all_s + buckets))
    below = F.col("s") * F.lit(float(all_t + buckets))
    return counts.select("bucket", F.floor(1000 * F.log(above / below)).alias("gain"))


def with_weights(found: DataFrame, gains: np.ndarray, buckets: int) -> DataFrame:
    """``found`` with ``weight``, the mean gain of a document's features rounded down, in place of its buckets."""
    kind = _narrow(buckets)
    sent = found.sparkSession.sparkContext.broadcast(gains)
    kept = [c for c in found.columns if c != "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(sent.value[np.frombuffer(b.as_buffer(), kind)].sum()) for b in batch.column("buckets")]
            sizes = batch.column("n_features").to_pylist()
            weights = [total // size if size else 0 for total, size in zip(sums, sizes)]
            made = [*[batch.column(c) for c in kept], pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=[*kept, "weight"])

    schema = ", ".join(f"{c} long" for c in [*kept, "weight"])
    return found.mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise of an id in thousandths, rounded down; rows without an id are like an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def importance_scores(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    grams: tuple[int, int] = GRAMS,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """Per row of ``docs``: id, th (hash of its text), n_words, n_features, weight, score and rank.

    ``grams`` are the least and the largest number of words of a feature. Ranks
    go to ``percent`` in a hundred of the rows with ``min_words`` words or more,
    highest scores first, ties by smaller id, rows without an id last; others
    have none. Null, empty and wordless texts have no features, weight 0 and no
    rank. Repeated rows score alike and are ranked each. An empty target makes
    all buckets' gains those of their rarity in the corpus; an empty table gives
    an empty one.
    """
    rows = docs.select(
        docs[doc_id].cast("long").alias("id"), F.xxhash64(docs[text]).alias("th"), docs[text].alias("text")
    )
    wanted = target.select(
        F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("th"), target[target_text].alias("text")
    )
    # "row" tells equal rows apart
    found = written(features(rows, grams, buckets).withColumn("row", F.monotonically_increasing_id()), "grams")
    corpus = written(bucket_counts(found, buckets), "corpus")
    goal = written(bucket_counts(features(wanted, grams, buckets), buckets), "target")
    # a number per bucket
    gains = bucket_gains(corpus, goal, buckets).orderBy("bucket").toPandas()["gain"].to_numpy(np.int64)
    weighted = with_weights(found, gains, buckets)
    scored = weighted.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    return ranked(scored.withColumn("drawable", F.col("n_words") >= min_words), percent)


def ranked(scored: DataFrame, percent: int) -> DataFrame:
    """``scored`` with the rank of its best rows.

    Rows are dealt out by ranges of the order, so a rank is a row's place in its
    range and the rows of the ranges before; equal scores may lie in several.
    """
    order = [
        F.col("drawable").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("th").asc(), F.col("row").asc()
    ]
    scored = written(scored, "scores")
    count = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = written(
        scored.repartitionByRange(count, *order).withColumn("piece", F.spark_partition_id()), "ranges"
    )
    drawn = percent * pieces.agg(F.count_if("drawable")).first()[0] // 100
    placed = running(pieces, [], "piece", order, F.lit(1).cast("long"), "before")
    rank = F.when(F.col("drawable") & (F.col("before") < drawn), F.col("before") + 1)
    return placed.select("id", "th", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings
) -> DataFrame:
    """The drawn rows of ``docs`` with n_features, weight, score and rank.

    Rows that repeat both id and text stay or go together and share the best of
    their ranks, so there may be a few rows more than ranks.
    """
    found = importance_scores(docs, target, doc_id, text, **settings).filter(F.col("rank").isNotNull())
    names = ["n_features", "weight", "score"]
    best = found.groupBy("id", "th").agg(*[F.first(c).alias(c) for c in names], F.min("rank").alias("rank"))
    whole = packed(docs, id=docs[doc_id].cast("long"), th=F.xxhash64(docs[text]))
    joined = whole.join(best, same(whole, best, "id", "th"))
    return unpacked(joined, **{c: best[c] for c in [*names, "rank"]})
