"""Benchmark decontamination by winnowing.

Both sides keep, of every run of word k-grams that fits a window, the one with
the least hash; any shared window then shares a kept hash. Documents look up
their kept hashes in a bitmap of the benchmark's, and the windows around a hit
are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.polyhash import FACTOR, Prefixes, mixed
from seriesloom.llm.rows import LOWER, UPPER, packed, same, unpacked
from seriesloom.session import written

# The filter has 2 ** FILTER_BITS bits, 8 MB, whatever the size of the benchmark.
# A full filter lets more windows through to the exact join and loses none.
FILTER_BITS = 26
GRAM = 5

_BLANK = 32
# Separators (all of ASCII but letters and digits) become blanks, A-Z become a-z.
_TABLE = bytes(
    (LOWER.encode() + bytes([b]))[UPPER.encode().find(b)] if b < 0x80 and chr(b).isalnum() or b >= 0x80 else _BLANK
    for b in range(256)
)


class Words:
    """One text: its words as spans of bytes, and a hash of each."""

    def __init__(self, text: str | None):
        self.line = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
        data = np.frombuffer(self.line, np.uint8)
        inside = np.concatenate([[0], (data != _BLANK).view(np.int8), [0]])
        edge = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.n = len(self.starts)
        if self.n:
            self.hashes = mixed(Prefixes(data).run(self.starts, self.ends))

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all runs of ``k`` words."""
        m = self.n - k + 1
        found = np.full(m, k, np.uint64)
        for j in range(k):
            found = found * FACTOR + self.hashes[j : j + m]
        return mixed(found)

    def kept(self, window: int) -> np.ndarray:
        """For every window of words, the least hash of its grams."""
        grams = self.grams(GRAM)
        span = np.lib.stride_tricks.sliding_window_view(grams, window - GRAM + 1)
        return span.min(axis=1)

    def window(self, start: int, size: int) -> str:
        run = self.line[self.starts[start] : self.ends[start + size - 1]]
        return b" ".join(run.split()).decode("utf-8", "surrogatepass")


def _keys(words: Words, size: int, window: int) -> np.ndarray:
    """One hash for each window of ``size`` words: the winnowed one of full windows."""
    return words.kept(window) if size == window else words.grams(size)


def benchmark_windows(bench: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item, size, hash, words) of all windows of the benchmark's items."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, content in zip(batch["item"], batch["text"]):
                words = Words(content)
                size = min(words.n, window)
                if size:
                    keys = _keys(words, size, window).view(np.int64)
                    rows += [(item, size, k, words.window(i, size)) for i, k in enumerate(keys)]
            yield pd.DataFrame(rows, columns=["item", "size", "hash", "words"])

    frame = bench.select(
        bench[item_id].cast("string").alias("item"), bench[text].alias("text")
    )
    return frame.mapInPandas(run, "item string, size int, hash long, words string").distinct()


def hash_filter(windows: DataFrame) -> np.ndarray:
    """Bitmap of the hashes' leading bits; its size is fixed, so the driver may hold it."""
    bit = F.shiftrightunsigned(F.col("hash"), 64 - FILTER_BITS)
    words = (
        windows.select(
            F.shiftright(bit, 6).cast("int").alias("at"),
            F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - FILTER_BITS}) & 63 as int))").alias("bit"),
        )
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()
    )
    found = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    found[words["at"].to_numpy()] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return found


def _in_filter(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bit = keys >> np.uint64(64 - FILTER_BITS)
    return (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def candidates(docs: DataFrame, sizes: list[int], bitmap, window: int) -> DataFrame:
    """Per (id, th): the number of words, and the windows that may be in the benchmark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = bitmap.value
        for batch in batches:
            rows = []
            for content in batch["text"]:
                words = Words(content)
                starts, lengths, runs = [], [], []
                for size in sizes:
                    if words.n >= size:
                        hit = np.flatnonzero(_in_filter(_keys(words, size, window), bits)).tolist()
                        starts += hit
                        lengths += [size] * len(hit)
                        runs += [words.window(i, size) for i in hit]
                rows.append((words.n, starts, lengths, runs))
            found = pd.DataFrame(rows, columns=["n_words", "starts", "sizes", "runs"])
            yield pd.concat([batch[["id", "th"]].reset_index(drop=True), found], axis=1)

    schema = "id long, th long, n_words long, starts array<int>, sizes array<int>, runs array<string>"
    return docs.mapInPandas(run, schema)


def _covered(spans: Column) -> Column:
    """Number of words in the union of ascending (start, size) spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))

    def add(state, span):
        end = F.greatest(state["end"], span["start"] + span["size"])
        new = end - F.least(end, F.greatest(state["end"], span["start"]))
        return F.struct(end.alias("end"), (state["total"] + new).alias("total"))

    return F.aggregate(spans, start, add, lambda state: state["total"])


def _sources(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        docs[doc_id].cast("long").alias("id"),
        F.xxhash64(docs[text]).alias("th"),
        docs[text].alias("text"),
    )


def contamination(
    docs: DataFrame,
    bench: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
) -> DataFrame:
    """Per row of ``docs``: id, th (hash of its text), n_words, n_hit and the items found.

    A document's word is hit if it lies in an occurrence of a window of the
    benchmark: ``window`` consecutive words of an item, or all of an item that
    has fewer. ``items`` are the ids, as ascending strings, of the items of
    which a window occurs; items without an id hit words but are not listed.
    Null, empty and wordless texts have no words, and as items no window.
    Repeated rows each get the same result; so do rows that share an id but not
    a text, each its own. An empty benchmark hits nothing.
    """
    spark: SparkSession = docs.sparkSession
    windows = written(benchmark_windows(bench, item_id, item_text, window), "windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    bitmap = spark.sparkContext.broadcast(hash_filter(windows))
    found = written(candidates(_sources(docs, doc_id, text), sizes, bitmap, window), "candidates")
    spans = found.select(
        "id", "th", F.explode(F.arrays_zip("starts", "sizes", "runs")).alias("w")
    ).select("id", "th", F.struct("w.starts", "w.sizes").alias("span"), "w.runs").distinct()
    hits = (
        spans.join(windows.select("words", "item"), F.col("runs") == F.col("words"))
        .groupBy("id", "th")
        .agg(
            F.sort_array(F.collect_set("span")).alias("spans"),
            F.sort_array(F.collect_set("item")).alias("items"),
        )
        .select(
            "id",
            "th",
            "items",
            _covered(F.transform("spans", lambda s: F.struct(s["starts"].alias("start"), s["sizes"].alias("size")))).alias("n_hit"),
        )
    )
    base = found.select("id", "th", "n_words")
    return base.join(hits, same(base, hits, "id", "th"), "left").select(
        base["id"],
        base["th"],
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminate(
    docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings
) -> DataFrame:
    """The rows of ``docs`` of which no word is hit."""
    found = contamination(docs, bench, doc_id, text, **settings)
    hit = found.filter("n_hit > 0").select("id", "th").distinct()
    whole = packed(docs, id=docs[doc_id].cast("long"), th=F.xxhash64(docs[text]))
    return unpacked(whole.join(hit, same(whole, hit, "id", "th"), "left_anti"))
