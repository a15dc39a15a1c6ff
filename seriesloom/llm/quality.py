"""Quality scores from weak labels.

Heuristic labellers vote good, bad or abstain on each text. Expectation
maximisation over the counts of all vote patterns estimates how far each can be
trusted and how likely each pattern is good; those probabilities train a linear
scorer over hashed features of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.rows import packed, unpacked
from seriesloom.session import written

# Texts the scorer is fitted on at most, those with the least hash of their id.
SAMPLE = 8192
FEATURES = 1 << 12
ROUNDS = 300
RATE = 0.05
SHRINK = 1e-4
EM_ROUNDS = 200
# Texts are dropped below this score: only those that are more likely bad by far.
LEAST = 0.3

# For each signal: where its labeller says bad, and where good. Between the two it abstains, as it
# does where the signal is null. Kinds of junk exclude each other, so a labeller of one kind only says bad.
LABELLERS = {
    "prose": (("below", 0.5), ("above", 0.85)),
    "sentences": (("outside", 0.02, 0.5), ("inside", 0.04, 0.2)),
    "varied": (("below", 0.3), ("above", 0.55)),
    "word_length": (("outside", 3.0, 7.0), ("inside", 4.0, 6.0)),
    "small_letters": (("below", 0.4), ("inside", 0.7, 0.97)),
    "commas": (None, ("inside", 0.02, 0.15)),
    "symbols": (("above", 0.08), None),
    "capitals": (("above", 0.4), None),
    "repeats": (("above", 0.15), None),
    "bare_symbols": (("above", 0.1), None),
    "exclamations": (("above", 0.2), None),
}
# How far a labeller is trusted before any vote is seen, and how many texts that counts for.
FIRST_ACCURACY, FIRST_TEXTS = 0.85, 10
VOTES = (-1, 0, 1)
# Shorter texts show nothing of sentences and variety.
LEAST_WORDS = 10
LOWER, UPPER, DIGIT, BLANK, STOP, SYMBOL = range(6)


@cache
def _classes() -> np.ndarray:
    """Class of every code point."""
    found = np.full(0x110000, SYMBOL, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            found[i] = UPPER if c.isupper() else LOWER
        elif c.isdigit():
            found[i] = DIGIT
        elif c.isspace():
            found[i] = BLANK
        elif c in ".,;:'\"-()?":
            found[i] = STOP
    return found


class Text:
    """Code points, their classes and the words of one text."""

    def __init__(self, text: str | None):
        self.points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
        self.classes = _classes()[self.points]
        self.words = (text or "").split()
        # words of letters only, but for a sign at the end
        self.plain = sum(w.isalpha() or (w[-1] in ".,;:?!" and w[:-1].isalpha()) for w in self.words)
        self.repeats = sum(a == b for a, b in zip(self.words, self.words[1:]))

    def signals(self) -> dict[str, float | None]:
        """What the labellers look at; null where there is nothing to look at."""
        n, words = np.bincount(self.classes, minlength=6), len(self.words)
        letters, marks = n[LOWER] + n[UPPER], n.sum() - n[BLANK]
        enough = words if words >= LEAST_WORDS else 0

        def share(part, whole):
            return float(part) / float(whole) if whole else None

        return {
            "prose": share(self.plain - self.repeats, words),
            "symbols": share(n[SYMBOL], marks),
            "capitals": share(n[UPPER], letters),
            "repeats": share(self.repeats, words - 1) if words > 1 else None,
            "bare_symbols": share(sum(len(w) == 1 and not w.isalnum() for w in self.words), words),
            "word_length": share(marks, words),
            "sentences": share(sum(w[-1] in ".!?" for w in self.words), enough),
            "varied": share(len(set(self.words)), enough),
            "small_letters": share(sum(w[0].islower() for w in self.words), enough),
            "commas": share(sum(w[-1] == "," for w in self.words), enough),
            "exclamations": share((self.points == ord("!")).sum(), words),
        }

    def votes(self) -> tuple[int, ...]:
        """1 good, 0 abstain, -1 bad, of each labeller."""
        signals = self.signals()

        def says(name, rule) -> bool:
            value = signals[name]
            if rule is None or value is None:
                return False
            side, *bounds = rule
            if side == "above":
                return value > bounds[0]
            if side == "below":
                return value < bounds[0]
            return (bounds[0] <= value <= bounds[1]) == (side == "inside")

        return tuple(
            -1 if says(name, bad) else int(says(name, good))
            for name, (bad, good) in LABELLERS.items()
        )

    def features(self) -> np.ndarray:
        """Roots of the shares of hashed 3-grams of characters and of their classes."""
        found = np.zeros(FEATURES, np.float32)
        if len(self.points) >= 3:
            for kind, line in ((1, self.points), (2, self.classes)):
                line = line.astype(np.uint64)
                grams = (line[:-2] << np.uint64(42)) ^ (line[1:-1] << np.uint64(21)) ^ line[2:]
                mixed = (grams * np.uint64(4) + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
                bucket = ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
                found += np.bincount((bucket % np.uint64(FEATURES - 2)).astype(np.int64), minlength=FEATURES)
            found = np.sqrt(found / len(self.points))
        found[-1] = np.sqrt(self.repeats / max(1, len(self.words)))
        found[-2] = 1 / (1 + len(self.words))
        return found


@dataclass
class LabelModel:
    """How texts of either class, bad and good, are voted on, and how many are good.

    ``rates[c, j, v]`` is how often labeller j gives the vote ``VOTES[v]`` to a text of
    class c, ``accuracy`` how often a labeller that votes is right.
    """

    good: float
    rates: np.ndarray
    accuracy: np.ndarray

    @classmethod
    def fit(cls, votes: np.ndarray, counts: np.ndarray) -> LabelModel:
        """Expectation maximisation of the share of good texts and of all rates.

        It starts from labellers that are all right as often. Without any vote
        every text is as likely good as bad.
        """
        given = (votes[:, :, None] == np.array(VOTES)).astype(float)
        shares = (given * counts[:, None, None]).sum(axis=0) / max(1.0, counts.sum())
        lean = np.array([2 * FIRST_ACCURACY, 1.0, 2 - 2 * FIRST_ACCURACY])
        # for bad and good texts; a vote nobody gave says nothing
        first = np.stack([shares * lean, shares * lean[::-1]]) + 1e-9
        model = cls(0.5, first / first.sum(axis=2, keepdims=True), np.full(votes.shape[1], FIRST_ACCURACY))
        for _ in range(EM_ROUNDS if len(votes) else 0):
            p = model.posterior(votes)
            weight = np.stack([1 - p, p]) * counts
            seen = np.einsum("cn,njv->cjv", weight, given) + FIRST_TEXTS * first
            rates = seen / seen.sum(axis=2, keepdims=True)
            right, wrong = seen[0, :, 0] + seen[1, :, 2], seen[1, :, 0] + seen[0, :, 2]
            good = (weight[1].sum() + FIRST_TEXTS / 2) / (counts.sum() + FIRST_TEXTS)
            moved = np.abs(rates - model.rates).max()
            model = cls(float(good), rates, right / (right + wrong))
            if moved < 1e-9:
                break
        return model

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that each row of votes is of a good text; to abstain says nothing."""
        ratio = np.log(self.rates[1]) - np.log(self.rates[0])
        ratio[:, VOTES.index(0)] = 0
        total = np.log(self.good) - np.log(1 - self.good)
        total = total + ratio[np.arange(votes.shape[1]), votes + 1].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


@dataclass
class Scorer:
    labels: LabelModel
    weights: np.ndarray
    bias: float

    @staticmethod
    def train(features: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, float]:
        """Logistic regression on probabilities, by Adam over all rows."""
        weights = np.zeros(features.shape[1] + 1)
        mean, square = np.zeros_like(weights), np.zeros_like(weights)
        for step in range(1, ROUNDS + 1 if len(targets) else 1):
            score = features @ weights[:-1].astype(np.float32) + weights[-1]
            error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - targets) / len(targets)
            slope = np.append(features.T @ error.astype(np.float32), error.sum())
            slope[:-1] += SHRINK * weights[:-1]
            mean = 0.9 * mean + 0.1 * slope
            square = 0.999 * square + 0.001 * slope**2
            weights -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        return weights[:-1].astype(np.float32), float(weights[-1])

    def score(self, text: Text) -> float:
        total = float(text.features() @ self.weights) + self.bias
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def vote_counts(docs: DataFrame, text: str) -> DataFrame:
    """(votes, n): how often each pattern of votes occurs, over all texts."""

    @F.pandas_udf("array<byte>")
    def voted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([Text(t).votes() for t in part])

    return docs.select(voted(docs[text]).alias("votes")).groupBy("votes").agg(F.count("*").alias("n"))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Scorer:
    """Label model over the votes on all texts, scorer over ``sample`` texts at most.

    A null text is empty. Rows without an id vote but are not learned from,
    rows with the same id and text are learned from as often as they occur, and
    an empty table gives a scorer that says one half.
    """
    # at most 3 patterns to the power of the labellers that say both, 2 to that of the others: 15,552
    patterns = vote_counts(docs, text).toPandas()
    votes = np.array(patterns["votes"].tolist(), int).reshape(len(patterns), len(LABELLERS))
    order = np.lexsort(votes.T)
    labels = LabelModel.fit(votes[order], patterns["n"].to_numpy(np.float64)[order])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (t.votes(), t.features().astype(np.float16).tobytes()) for t in map(Text, batch["text"])
            ]
            votes, features = zip(*found) if found else ((), ())
            yield pd.DataFrame({"id": batch["id"], "votes": votes, "features": features})

    # ids first, so that only the texts of the sample are sorted and moved
    ids = docs.select(docs[doc_id].alias("id")).filter("id is not null").distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(docs[doc_id].alias("id"), docs[text].alias("text")).join(chosen, "id")
    rows = written(
        texts.mapInPandas(run, "id long, votes array<byte>, features binary"), "features"
    ).orderBy("id").limit(sample).toPandas()
    features = np.empty((len(rows), FEATURES), np.float32)
    for i, row in enumerate(rows.pop("features")):
        features[i] = np.frombuffer(row, np.float16)
    marks = np.array(rows["votes"].tolist(), int).reshape(len(rows), len(LABELLERS))
    weights, bias = Scorer.train(features, labels.posterior(marks))
    return Scorer(labels, weights, bias)


def score(docs: DataFrame, scorer: Scorer, text: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with ``weak_label`` (probability by the votes), ``score`` and ``kept``.

    A null, empty or blank text has no words, and all labellers abstain. Rows
    stay as they are, repeated ones included.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("weak_label double, score double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model: Scorer = shared.value
        for part in parts:
            # one text at a time: its words and classes take many times its size
            found = [(t.votes(), model.score(t)) for t in map(Text, part)]
            votes = np.array([v for v, _ in found], int).reshape(len(found), len(LABELLERS))
            yield pd.DataFrame(
                {"weak_label": model.labels.posterior(votes), "score": [s for _, s in found]}
            )

    found = packed(docs, found=scored(docs[text]))
    return unpacked(
        found,
        weak_label=F.col("found.weak_label"),
        score=F.col("found.score"),
        kept=F.col("found.score") >= least,
    )
