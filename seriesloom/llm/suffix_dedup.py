"""Suffix-array dedup: bytes of strings that occur elsewhere are removed.

Of the suffixes of all texts only some can start a repeat, and only near their
like. Each string of ``size`` bytes is dealt to an anchor, the least hashed gram
in it, so that equal strings meet at equal anchors. Strings at anchors that
occur once are done with. The others are sorted as suffixes, bucket by bucket,
by a mergesort that compares hashes, and neighbours with a common extension of
``size`` bytes are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.polyhash import Prefixes, mixed
from seriesloom.llm.rows import packed, unpacked
from seriesloom.llm.suffix_sort import Suffixes
from seriesloom.session import written

SIZE = 400
# Strings of one text that are dealt out at a time.
STRETCH = 1 << 20
# Hulls sorted in one task, about, and in one bucket; larger buckets are split by string.
TOGETHER = 2048
CROWD = 1024


def _gram(size: int) -> int:
    return max(1, size * 8 // 25)


def _anchors(data: np.ndarray, size: int) -> np.ndarray:
    """For the string at every start, where its least hashed gram starts; the first of equals."""
    gram = _gram(size)
    hashes = mixed(Prefixes(data).all_runs(gram))
    # the place decides between equal hashes and says afterwards which it was
    bits = np.uint64(21)
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width, span = size - gram + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    least = np.minimum(least[: len(least) - rest], least[rest:])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _hulls(data: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(core hash, side, first start, last start, anchor) of runs of strings with one anchor.

    Strings of which the anchor lies in the first half, and in the second half,
    are told apart. All that an anchor can have on one side contain its core,
    so equal strings have equal cores.
    """
    gram = _gram(size)
    reach = size - gram
    half = reach // 2
    anchors = _anchors(data, size)
    starts = np.arange(len(anchors))
    late = (anchors - starts) > half
    cut = np.flatnonzero(np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (late[1:] != late[:-1])]))
    first, last = cut, np.concatenate([cut[1:], [len(anchors)]]) - 1
    anchor, side = anchors[first], late[first]
    begin = np.where(side, anchor - half - 1, anchor)
    end = np.where(side, anchor - reach + size, anchor - half + size)
    core = mixed(Prefixes(data).run(begin, end) + side.astype(np.uint64))
    return core, side, first, last, anchor


def _strings(texts: DataFrame, size: int) -> DataFrame:
    """(core, hull, doc, low, high, ahead): the runs of strings of all texts, by hash.

    ``low`` and ``high`` are the first and last start, ``ahead`` the bytes from
    the first to the anchor.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            parts = []
            for doc, text in zip(batch["doc"], batch["text"]):
                whole = (text or "").encode("utf-8", "surrogatepass")
                for at in range(0, len(whole) - size + 1, STRETCH):
                    line = whole[at : at + STRETCH + size - 1]
                    data = np.frombuffer(line, np.uint8)
                    core, _, first, last, anchor = _hulls(data, size)
                    # the place of the anchor is part of the hull
                    spans = zip(first.tolist(), (last + size).tolist(), (anchor - first).tolist())
                    hulls = np.array([digest(line[a:b], seed) for a, b, seed in spans], np.uint64)
                    own = np.full(len(core), doc, np.int64)
                    parts.append((core.view(np.int64), hulls.view(np.int64), own, first + at, last + at, anchor - first))
            if parts:
                names = ["core", "hull", "doc", "low", "high", "ahead"]
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*parts)))))

    return texts.mapInPandas(run, "core long, hull long, doc long, low int, high int, ahead int")


def _cut(texts: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(core, hull, ahead, bytes): the bytes of one example of each hull."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch["text"], batch["wanted"]):
                whole = (text or "").encode("utf-8", "surrogatepass")
                rows += [
                    (w["core"], w["hull"], w["ahead"], whole[w["low"] : w["high"] + size]) for w in wanted
                ]
            yield pd.DataFrame(rows, columns=["core", "hull", "ahead", "bytes"])

    wanted = classes.groupBy("doc").agg(
        F.collect_list(F.struct("core", "hull", "ahead", "low", "high")).alias("wanted")
    )
    # a row that repeats another gives the same bytes again
    joined = texts.join(wanted, "doc").select("text", "wanted")
    return joined.mapInPandas(run, "core long, hull long, ahead int, bytes binary")


def _sorted(bucket: pd.DataFrame, size: int) -> pd.DataFrame:
    """(core, hull, first, last): of each hull's strings that another hull has too.

    What lies between overlaps both, so it need not be told apart.
    """
    bucket = bucket.drop_duplicates(["core", "hull"], ignore_index=True)
    data = np.frombuffer(b"".join(bucket["bytes"]), np.uint8)
    lengths = bucket["bytes"].str.len().to_numpy()
    base = np.cumsum(lengths) - lengths
    strings = lengths - size + 1
    owner = np.repeat(np.arange(len(bucket)), strings)
    nth = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings)
    starts = base[owner] + nth
    core = np.unique(bucket["core"], return_inverse=True)[1]
    place = bucket["ahead"].to_numpy()[owner] - nth
    found = Suffixes(data, size).repeated(starts, core[owner] * size + place)
    hulls = np.searchsorted(base, found, side="right") - 1
    ends = pd.Series(found - base[hulls]).groupby(hulls).agg(["min", "max"])
    return pd.DataFrame(
        {
            "core": bucket["core"].to_numpy()[ends.index],
            "hull": bucket["hull"].to_numpy()[ends.index],
            "first": ends["min"].to_numpy(),
            "last": ends["max"].to_numpy(),
        }
    )


def _split(crowd: DataFrame, size: int) -> DataFrame:
    """As ``_sorted`` for buckets too large for a task: string by string, dealt by hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for core, hull, line in zip(batch["core"], batch["hull"], batch["bytes"]):
                for i in range(len(line) - size + 1):
                    mark = hashlib.blake2b(line[i : i + size], digest_size=16).digest()
                    rows.append((core, hull, i, mark))
            yield pd.DataFrame(rows, columns=["core", "hull", "start", "mark"])

    marks = written(crowd.mapInPandas(run, "core long, hull long, start int, mark binary"), "marks")
    # the same hull may be here once for every repeat of its row
    several = (
        marks.groupBy("core", "mark")
        .agg(F.min("hull").alias("a"), F.max("hull").alias("b"))
        .filter("a <> b")
        .select(F.col("core").alias("c"), F.col("mark").alias("m"))
    )
    return (
        marks.join(several, (F.col("core") == F.col("c")) & (F.col("mark") == F.col("m")))
        .groupBy("core", "hull")
        .agg(F.min("start").alias("first"), F.max("start").alias("last"))
    )


def repeats(texts: DataFrame, size: int) -> DataFrame:
    """(doc, begins, ends): runs of bytes of each text that lie in a repeated string, by begin."""
    strings = written(_strings(texts, size), "strings")
    shared = strings.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core")
    members = written(strings.join(written(shared, "shared"), "core"), "members")
    classes = members.groupBy("core", "hull").agg(
        (F.count("*") > 1).alias("many"), F.min(F.struct("doc", "low", "high", "ahead")).alias("one")
    )
    classes = written(classes.select("core", "hull", "many", "one.*"), "classes")
    apart = classes.groupBy("core").agg(F.count("*").alias("hulls")).filter("hulls > 1")
    apart = written(apart, "apart")
    unlike, crowded = apart.agg(
        F.coalesce(F.sum("hulls"), F.lit(0)), F.count_if(F.col("hulls") > CROWD)
    ).first()

    found = classes.filter("many").select(
        "core", "hull", F.lit(0).alias("first"), (F.col("high") - F.col("low")).alias("last")
    )
    if unlike:
        lines = written(_cut(texts, classes.join(apart.select("core"), "core"), size), "hulls")
        few = lines.join(apart.filter(F.col("hulls") <= CROWD).select("core"), "core")
        parts = -(-unlike // TOGETHER)
        sorted_ = (
            few.groupBy(F.pmod(F.xxhash64("core"), F.lit(parts)).alias("part"))
            .applyInPandas(lambda b: _sorted(b, size), "core long, hull long, first int, last int")
        )
        if crowded:
            crowd = lines.join(apart.filter(F.col("hulls") > CROWD).select("core"), "core")
            sorted_ = sorted_.unionByName(_split(crowd, size))
        once = classes.filter("not many").select("core", "hull")
        found = found.unionByName(sorted_.join(once, ["core", "hull"]))
    found = written(found, "repeats")

    spans = members.join(found, ["core", "hull"]).select(
        "doc",
        F.struct(
            (F.col("low") + F.col("first")).alias("begin"),
            (F.col("low") + F.col("last") + size).alias("end"),
        ).alias("span"),
    )
    spans = spans.groupBy("doc").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    return spans.select("doc", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends"))


def _without(line: bytes, begins, ends) -> tuple[bytes, int, int]:
    """``line`` without some runs of bytes, how many bytes those are, and in how many runs."""
    if begins is None or not len(begins):
        return line, 0, 0
    begins, ends = np.asarray(begins), np.maximum.accumulate(np.asarray(ends))
    new = np.concatenate([[True], begins[1:] > ends[:-1]])
    begins, ends = begins[new], ends[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ends) - 1]])]
    edges = [0, *np.stack([begins, ends], axis=1).ravel().tolist(), len(line)]
    kept = b"".join(line[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return kept, len(line) - len(kept), len(begins)


def suffix_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE
) -> DataFrame:
    """``docs`` with ``kept_bytes`` (what is left, binary), n_bytes, n_removed and n_spans.

    A byte goes if it lies in a string of ``size`` bytes that also starts
    elsewhere, in the same text or another; texts are judged as they came. A
    null text is empty. Texts shorter than ``size`` stay whole. Rows that repeat
    an id and a text are texts of their own, so long ones lose everything; rows
    without an id are texts like others. An empty table gives an empty one.
    """
    mark = F.xxhash64(docs[doc_id], docs[text])
    texts = docs.select(mark.alias("doc"), docs[text].alias("text")).filter(F.octet_length("text") >= size)
    spans = repeats(texts, size)
    whole = packed(docs, doc=mark, data=F.coalesce(docs[text], F.lit("")).cast("binary"))
    joined = whole.join(spans.withColumnRenamed("doc", "found"), F.col("doc") == F.col("found"), "left")

    @F.pandas_udf("kept binary, removed long, spans long")
    def left_over(data: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = [_without(line, a, b) for line, a, b in zip(data, begins, ends)]
        return pd.DataFrame(rows, columns=["kept", "removed", "spans"])

    cut = joined.withColumn("cut", left_over("data", "begins", "ends"))
    return unpacked(
        cut,
        kept_bytes=F.col("cut.kept"),
        n_bytes=F.octet_length("data").cast("long"),
        n_removed=F.col("cut.removed"),
        n_spans=F.col("cut.spans"),
    )
