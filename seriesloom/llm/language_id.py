"""Language identification by rank-order profiles.

The profile of a language is the list of its most frequent letter n-grams. A
document goes to the language whose profile its own list is least out of place
against.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesloom.llm.rows import packed, unpacked
from seriesloom.session import written

# Length of the longest n-gram: three code points of 21 bits fit a long.
GRAMS = 3
BITS = 21
BLANK = ord(" ")
UNKNOWN = "und"
# Distinct n-grams that a task counts before it hands its counts on.
HELD = 1 << 20
# Languages are short codes; more distinct values than this are no languages.
MAX_LANGS = 4096


@cache
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """All 1- to 3-grams of the text's words, with a blank at either end; packed."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[points]
    if not letters.any():
        return np.empty(0, np.int64)
    line = np.where(letters, points, BLANK).astype(np.int64)
    line = np.concatenate([[BLANK], line, [BLANK]])
    line = line[np.concatenate([[True], (line[1:] != BLANK) | (line[:-1] != BLANK)])]
    pairs = (line[:-1] << BITS) | line[1:]
    triples = (pairs[:-1] << BITS) | line[2:]
    # a triple around a blank spans two words
    return np.concatenate([line[line != BLANK], pairs, triples[line[1:-1] != BLANK]])


def ranked(text: str | None, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties by code point."""
    found, counts = np.unique(grams(text), return_counts=True)
    return found[np.argsort(-counts, kind="stable")[:size]]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text); several rows of counts per n-gram."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        size = 0

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)

        def counted():
            for lang, parts in held.items():
                keys, n = merged(parts)
                yield pd.DataFrame({"lang": lang, "gram": keys, "n": n})

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                found = np.unique(grams(text), return_counts=True)
                if len(found[0]):
                    held.setdefault(lang, []).append(found)
                    size += len(found[0])
                if size > HELD:
                    held = {k: [merged(v)] for k, v in held.items()}
                    size = sum(len(v[0][0]) for v in held.values())
                    if size > HELD // 2:
                        yield from counted()
                        held, size = {}, 0
        yield from counted()

    return docs.mapInPandas(run, "lang string, gram long, n long")


def profiles(docs: DataFrame, size: int) -> DataFrame:
    """(lang, grams): each language's ``size`` most frequent n-grams over all its rows."""
    totals = gram_counts(docs).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the grams of one language are dealt over tasks, of which each keeps its first ones
    part = F.pmod(F.xxhash64("gram"), F.lit(64))
    order = [F.col("n").desc(), F.col("gram")]
    some = totals.withColumn("part", part).withColumn(
        "nth", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    ).filter(F.col("nth") <= size)
    first = some.withColumn(
        "nth", F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ).filter(F.col("nth") <= size)
    return first.groupBy("lang").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("nth", "gram"))), lambda g: g["gram"]).alias("grams")
    )


class Profiles:
    """Profiles of all languages as one table: n-gram to rank in each language."""

    def __init__(self, rows: list, size: int):
        rows = sorted((r["lang"], r["grams"]) for r in rows)
        self.langs = [lang for lang, _ in rows]
        self.size = size
        every = [np.array(g, np.int64) for _, g in rows]
        self.grams = np.unique(np.concatenate(every)) if every else np.empty(0, np.int64)
        self.ranks = np.full((len(self.grams), len(rows)), size, np.int32)
        for i, own in enumerate(every):
            self.ranks[np.searchsorted(self.grams, own), i] = np.arange(len(own))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language, first by name among equals, and how near it is: 1 is in place."""
        own = ranked(text, self.size)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        there = self.ranks[at[known]]
        moved = np.abs(there - np.flatnonzero(known)[:, None])
        moved[there == self.size] = self.size
        far = moved.sum(axis=0) + self.size * int((~known).sum())
        best = int(far.argmin())
        return self.langs[best], 1 - float(far[best]) / (self.size * len(own))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = 400) -> Profiles:
    """Profiles from all rows with a language.

    The driver holds ``size`` n-grams for each language, MAX_LANGS of them at most.
    """
    known = docs.select(docs[lang].alias("lang"), docs[text].alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    found = written(profiles(known, size), "profiles")
    if found.count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    return Profiles(found.collect(), size)


def identify(docs: DataFrame, model: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1, out-of-place distance turned round).

    A null text, or one without a letter, is ``und`` with score 0, and so is
    every text for a model without languages. Equal distances go to the first
    language by name. Rows stay as they are, repeated ones included.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame(
                [shared.value.predict(t) for t in part], columns=["lang_pred", "score"]
            )

    found = packed(docs, found=predicted(docs[text]))
    return unpacked(
        found, lang_pred=F.col("found.lang_pred"), score=F.col("found.score")
    )


def held_out(doc_id: Column) -> Column:
    """Rows that profiles are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
