"""Toxicity scores of a factorization machine over hashed terms.

A text's terms are its words and their first letters, hashed into a fixed table
of buckets, each once more for every doubling of its occurrences, and the text's
length to a power of two. The machine adds a weight per bucket and an
interaction per pair of buckets, which it keeps as inner products of short
vectors, so pairs that were rarely seen together are known too. Every bucket is
trained: none is chosen beforehand, so a term that means something in a pair
only is there to be learned.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.rows import packed, unpacked
from seriesloom.session import written

# Labelled rows the machine is fitted on at most, those with the least hash of the id.
SAMPLE = 20_000
BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6)
# A term's occurrences count up to this power of two.
MOST_DOUBLINGS = 4
FACTORS = 4
EPOCHS = 12
BATCH = 64
# Linear weights are zero until their gradients have added up to more than this.
LEAST_GRADIENT = 10.0
RATE = 1.0
FACTOR_RATE = 0.1
SHRINK = 1e-3
FIRST_FACTORS = 0.05
# Words whose terms a task remembers, and characters of text it looks at together.
REMEMBERED = 1 << 18
TOGETHER = 1 << 20

WORD = re.compile(r"[^\W\d_]+")


def _hashed(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass")) % BUCKETS


def word_terms(word: str) -> list[int]:
    """Buckets of the word and of its first letters."""
    return [_hashed("=" + word)] + [_hashed(word[:n]) for n in PREFIXES if len(word) > n]


class Words(dict[str, int]):
    """Words by the order they were met in, and a row of buckets for each, filled up with -1."""

    def __init__(self):
        self.terms = array("i")

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        found = word_terms(word)
        self.terms.extend(found + [-1] * (1 + len(PREFIXES) - len(found)))
        return number

    def rows(self, numbers: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.terms, np.int32).reshape(-1, 1 + len(PREFIXES))[numbers]

    def forget(self) -> None:
        self.clear()
        self.terms = array("i")


def text_buckets(texts: Sequence[str | None], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(starts, buckets): the distinct buckets of each text, one text after the other."""
    if len(words) > REMEMBERED:
        words.forget()
    found = [WORD.findall((text or "").lower()) for text in texts]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    numbers = np.fromiter((words[w] for row in found for w in row), np.int64, lengths.sum())
    sizes = np.array([_hashed(f"#{int(n).bit_length()}") for n in lengths], np.int64)
    codes = [np.arange(len(found)) * BUCKETS + sizes]
    if len(numbers):
        pair, n = np.unique(np.repeat(np.arange(len(found)), lengths) << 32 | numbers, return_counts=True)
        terms = words.rows(pair & 0xFFFFFFFF)
        use = terms >= 0
        code = ((pair >> 32)[:, None] * BUCKETS + terms)[use]
        n = np.broadcast_to(n[:, None], terms.shape)[use]
        order = np.argsort(code)
        code, n = code[order], n[order]
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        code, n = code[first], np.add.reduceat(n, first)
        for level in range(MOST_DOUBLINGS + 1):
            often = code[n >= 1 << level]
            codes.append(often - often % BUCKETS + (often + level) % BUCKETS)
    code = np.sort(np.concatenate(codes))
    code = code[np.append(True, code[1:] != code[:-1])] if len(code) else code
    starts = np.searchsorted(code, np.arange(len(found) + 1) * BUCKETS)
    return starts, (code % BUCKETS).astype(np.int32)


def stretches(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``TOGETHER`` characters, or of one text."""
    first = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= TOGETHER:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _chance(total: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


class _Batch:
    """Some texts' buckets, and the order that brings equal buckets together."""

    def __init__(self, starts: np.ndarray, buckets: np.ndarray, chosen: np.ndarray, labels: np.ndarray):
        self.sizes = starts[chosen + 1] - starts[chosen]
        self.starts = np.append(0, np.cumsum(self.sizes)[:-1])
        found = np.concatenate([buckets[starts[i] : starts[i + 1]] for i in chosen])
        used, place = np.unique(found, return_inverse=True)
        order = np.argsort(place, kind="stable")
        groups = np.searchsorted(place[order], np.arange(len(used)))
        # all batches are held at once, so each number takes no more bytes than it needs
        small = np.min_scalar_type(len(found))
        self.used, self.groups = used.astype(np.int32), groups.astype(small)
        self.place, self.order = place.astype(small), order.astype(small)
        self.labels = labels[chosen]


def _pairs(factors: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sum of factors, and what its pairs of buckets add to its total, shared by all."""
    sums = np.add.reduceat(factors, starts)
    apart = np.add.reduceat(factors**2, starts)
    return sums, 0.5 * (sums**2 - apart).sum(axis=1) / sizes


@dataclass
class Machine:
    """A bias, and the linear weight and the factors of every bucket."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    @classmethod
    def fit(cls, starts: np.ndarray, buckets: np.ndarray, labels: np.ndarray, seed: int = 7) -> Machine:
        """Adaptive gradient steps on the logistic loss; text i has ``buckets[starts[i]:starts[i + 1]]``.

        Every text has a bucket at least, that of its length. Linear weights
        follow the sum of their gradients, less a constant: what a rare term
        happens to add up in a few texts stays zero. Factors shrink instead.
        """
        rng = np.random.default_rng(seed)
        linear = np.zeros(BUCKETS)
        gradients, linear_squares = np.zeros(BUCKETS), np.zeros(BUCKETS)
        factors = rng.normal(0, FIRST_FACTORS, (BUCKETS, FACTORS)).astype(np.float32)
        factor_squares = np.full(factors.shape, 0.01, np.float32)
        bias, bias_squares = 0.0, 1.0
        order = rng.permutation(len(labels))
        batches = [
            _Batch(starts, buckets, order[a : a + BATCH], labels) for a in range(0, len(order), BATCH)
        ]
        for _ in range(EPOCHS):
            for number in rng.permutation(len(batches)):
                b = batches[number]
                weight, vector = linear[b.used], factors[b.used]
                own = vector[b.place]
                sums, pairs = _pairs(own, b.starts, b.sizes)
                error = _chance(bias + np.add.reduceat(weight[b.place], b.starts) + pairs) - b.labels

                change = np.add.reduceat(np.repeat(error, b.sizes)[b.order], b.groups)
                before = linear_squares[b.used]
                after = before + change**2
                total = gradients[b.used] + change - (np.sqrt(after) - np.sqrt(before)) / RATE * weight
                over = np.sign(total) * np.maximum(np.abs(total) - LEAST_GRADIENT, 0)
                linear_squares[b.used], gradients[b.used] = after, total
                linear[b.used] = -over * RATE / (1 + np.sqrt(after))

                share = (error / b.sizes).astype(np.float32)
                slope = (np.repeat(sums, b.sizes, axis=0) - own) * np.repeat(share, b.sizes)[:, None]
                change = np.add.reduceat(slope[b.order], b.groups) + SHRINK * vector
                squares = factor_squares[b.used] + change**2
                factor_squares[b.used] = squares
                factors[b.used] = vector - FACTOR_RATE * change / np.sqrt(squares)

                bias_squares += error.sum() ** 2
                bias -= 0.1 * error.sum() / bias_squares**0.5
        if not len(labels):
            factors[:] = 0
        return cls(float(bias), linear, factors)

    def score(self, starts: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each text."""
        _, pairs = _pairs(self.factors[buckets].astype(np.float64), starts[:-1], np.diff(starts))
        return _chance(self.bias + np.add.reduceat(self.linear[buckets], starts[:-1]) + pairs)


def _text_buckets(docs: DataFrame) -> DataFrame:
    """(label, buckets): the distinct buckets of (label, text), as 32-bit numbers in a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in stretches(texts):
                starts, buckets = text_buckets(texts[a:b], words)
                rows = [buckets[x:y].tobytes() for x, y in zip(starts, starts[1:])]
                yield pd.DataFrame({"label": batch["label"].iloc[a:b].to_numpy(), "buckets": rows})

    return docs.mapInPandas(run, "label int, buckets binary")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Machine:
    """A machine fitted on ``sample`` labelled documents at most.

    Rows without an id or a label are left out; a document with several labels
    counts by the largest, and one that is repeated counts as often. Rows are
    learned from in the order of their labels and buckets, so ties do not matter.
    Without any labelled text the machine says one half.
    """
    marked = written(
        labels.select(labels[doc_id].alias("id"), labels[label].cast("int").alias("label"))
        .filter("id is not null and label is not null")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample),
        "marked",
    )
    texts = docs.select(docs[doc_id].alias("id"), docs[text].alias("text"))
    rows = _text_buckets(texts.join(marked, "id").select("label", "text")).toPandas()
    rows = rows.sort_values(["label", "buckets"], ignore_index=True)
    marks = rows["label"].to_numpy(np.float32)
    sizes = rows["buckets"].map(len).to_numpy(np.int64) // 4
    buckets = np.frombuffer(b"".join(rows.pop("buckets")), np.int32)
    return Machine.fit(np.append(0, np.cumsum(sizes)), buckets, marks)


def score(docs: DataFrame, machine: Machine, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the machine's probability of label 1.

    Null, empty and wordless texts have the bucket of their length alone.
    Rows stay as they are, repeated ones included.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model: Machine = shared.value
        words = Words()
        for part in parts:
            texts = part.tolist()
            found = [model.score(*text_buckets(texts[a:b], words)) for a, b in stretches(texts)]
            yield pd.Series(np.concatenate([np.empty(0), *found]))

    return unpacked(packed(docs, value=scored(docs[text])), **{name: F.col("value")})


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
