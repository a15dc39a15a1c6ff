"""Interactions of filters: what each removes, in every order of applying them.

The ids that fail a filter are stored as a table, one per filter. What is left
of a failing table after some other filters went first is a chain of left-anti
joins with their tables, and what they took of it one of left-semi joins. Those
chains follow the filters' own order, so each combination is made once, from a
smaller one; all orders of applying the filters are then read off the counts,
since what a prefix removes does not depend on the order within it.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.rows import BLANKS, UPPER
from seriesloom.session import written

# Fixed values of the five filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
SYMBOLS = "[#$%&*|]"

# n filters have n! orders, and a row of the result per order and filter.
MOST_FILTERS = 6


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of one text: too short, repetitive, upper case, or with symbols."""
    whole = F.coalesce(text, F.lit(""))
    bare = F.btrim(whole, F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{BLANKS}]+"))
    n_words = F.size(words)
    n_upper = F.length(whole) - F.length(F.translate(whole, UPPER, ""))
    return {
        "A": n_words < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < MIN_DISTINCT_PERCENT * n_words.cast("long"),
        "C": 100 * n_upper.cast("long") > MAX_UPPER_PERCENT * F.length(whole).cast("long"),
        "D": whole.rlike(SYMBOLS),
    }


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per row of ``docs``: row (a number of its own), id, part and whether it fails A, B, C, D and E.

    E fails a row whose text a smaller id has too; texts are told apart by
    SHA-256. A row without an id is no earlier than any and follows none. Null
    texts are empty, and so are null parts. The rows are written, which fixes
    their numbers.
    """
    found = text_failures(docs[text])
    digest = F.sha2(F.coalesce(docs[text], F.lit("")), 256)
    facts = written(
        docs.select(
            docs[doc_id].alias("id"),
            F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
            digest.alias("digest"),
            *[value.alias(name) for name, value in found.items()],
        ).withColumn("row", F.monotonically_increasing_id()),
        "facts",
    )
    # written, so that the join deals out both sides anew and a text that fills a
    # partition can be split
    first = written(
        facts.groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("known"), "first"),
        "copied",
    )
    joined = facts.join(first, facts.digest == first.known, "left")
    copied = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return written(joined.select("row", "id", "part", *found, copied.alias("E")), "failures")


def flagged(df: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``df`` with whether its id is among ``ids`` (column ``id``, repeats allowed)."""
    marked = df.join(ids, "id", "left_semi").withColumn(name, F.lit(True))
    return marked.unionByName(df.join(ids, "id", "left_anti").withColumn(name, F.lit(False)))


def failing_tables(
    found: DataFrame, filters: Sequence[str], losses: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """The stored table of each filter: row, id and part of what fails it, with a flag per loss."""
    kept = ["row", "id", "part"]
    tables = {}
    for name in filters:
        failing = found.filter(F.col(name)).select(*kept)
        marked = reduce(lambda df, loss: flagged(df, losses[loss], loss), losses, failing)
        tables[name] = written(marked, f"failing-{name}")
    return tables


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def prefix_counts(
    tables: Mapping[str, DataFrame], losses: Sequence[str]
) -> DataFrame:
    """Per part, filter (its number ``f``) and set ``s`` of others before it, as bits: what it removes.

    ``removed`` counts rows of the filter's table that no filter of ``s`` took,
    and the losses are the flagged ones among them; ``taken`` counts the rows that
    the last filter of ``s`` took and those before it in ``s`` did not.
    """
    names = list(tables)
    left = [
        table.drop("id").withColumns({"f": F.lit(n), "s": F.lit(0)})
        for n, table in enumerate(tables.values())
    ]
    lost = [F.count_if(loss).alias(loss) for loss in losses]
    taken = []
    for n, name in enumerate(names):
        earlier = _union(left).filter(F.col("f") != n)
        first = tables[name].select("row")
        bit = F.col("s").bitwiseOR(F.lit(1 << n))
        survive = earlier.join(first, "row", "left_anti").withColumn("s", bit)
        caught = earlier.join(first, "row", "left_semi").withColumn("s", bit)
        left.append(written(survive, f"left-of-{name}"))
        taken.append(caught.groupBy("part", "f", "s").agg(F.count("*").alias("taken")))
    removed = _union(left).groupBy("part", "f", "s").agg(F.count("*").alias("removed"), *lost)
    return removed.join(_union(taken), ["part", "f", "s"], "full").na.fill(0)


def _key(f: int, s: int) -> int:
    """One number for a filter and the set before it."""
    return f << MOST_FILTERS | s


def _built(s: int) -> list[tuple[int, int, int]]:
    """How ``s`` is made in the filters' own order: (filter, set before, set after) of each step."""
    bits = [b for b in range(MOST_FILTERS) if s >> b & 1]
    return [(b, s & ((1 << b) - 1), s & ((2 << b) - 1)) for b in bits]


def _combinations(n: int, uses: Counter[int]) -> list[dict]:
    """Each filter with each set of others before it, and the counts that tell what it does there."""
    found = []
    for f in range(n):
        rest = (1 << n) - 1 - (1 << f)
        sets = [s for s in range(1 << n) if not s >> f & 1]
        for s in sets:
            found.append(
                {
                    "key": _key(f, s),
                    "rest": _key(f, rest),
                    "earlier": [_key(f, after) for _, _, after in _built(s)],
                    "gone": [_key(g, before) for g, before, _ in _built(s | 1 << f)],
                    "sums": [{"key": _key(f, t), "uses": uses[_key(f, t)]} for t in sets],
                }
            )
    return found


_COMBINATIONS = (
    "array<struct<key: int, rest: int, earlier: array<int>, gone: array<int>,"
    " sums: array<struct<key: int, uses: long>>>>"
)
_ORDERS = "array<struct<filter_order: string, keys: array<int>>>"


def _constant(value: list, schema: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), schema)


def audit(
    found: DataFrame,
    filters: Sequence[str],
    losses: Mapping[str, DataFrame] | None = None,
    orders: Iterable[Sequence[str]] | None = None,
) -> DataFrame:
    """What each filter removes at each step of each order, per part.

    ``found`` has row, id, part and a boolean per filter, as of
    :func:`failures`; ``losses`` names tables of ids whose removal is counted as
    ``<name>_lost``; ``orders`` are all permutations of the filters by default. A row per part,
    filter_order and step: kept (after the step), removed (by it), redundant
    (fail its filter but went earlier), unique_fails (fail its filter alone),
    the losses, and shapley (removed by its filter, summed over all orders).
    Zeros are included. Rows without an id are in no loss; repeated rows and
    rows that share an id count each. No rows give none. At most six filters.
    """
    filters, losses = list(filters), dict(losses or {})
    orders = list(permutations(filters) if orders is None else orders)
    if not 0 < len(filters) <= MOST_FILTERS:
        raise ValueError(f"the audit takes 1 to {MOST_FILTERS} filters")
    if any(sorted(order) != sorted(filters) for order in orders):
        raise ValueError("an order names each filter once")
    ids = {name: df.select("id").distinct() for name, df in losses.items()}
    counts = written(prefix_counts(failing_tables(found, filters, ids), list(ids)), "counts")
    return _read_off(found, counts, filters, orders, list(ids))


def _read_off(
    found: DataFrame, counts: DataFrame, filters: list[str], orders: list[Sequence[str]], losses: list[str]
) -> DataFrame:
    """The rows of all orders from the counts, of which a part has a few per filter."""
    number = {name: n for n, name in enumerate(filters)}
    keyed = [
        [_key(number[f], sum(1 << number[g] for g in order[:n])) for n, f in enumerate(order)] for order in orders
    ]
    uses = Counter(key for keys in keyed for key in keys)
    named = [{"filter_order": "".join(order), "keys": keys} for order, keys in zip(orders, keyed)]

    measures = ["removed", "taken", *losses]
    key = (F.col("f") * (1 << MOST_FILTERS) + F.col("s")).cast("int")
    entry = F.struct(key.alias("key"), F.struct(*measures).alias("n"))
    held = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(entry)).alias("held"))
    parts = found.groupBy("part").agg(F.count("*").alias("total")).join(held, "part", "left")

    def of(key: Column, name: str) -> Column:
        return F.coalesce(F.try_element_at("held", key)[name], F.lit(0).cast("long"))

    def total(keys: Column, add) -> Column:
        return F.aggregate(keys, F.lit(0).cast("long"), lambda sum_, k: sum_ + add(k))

    def line(c: Column) -> Column:
        values = {
            "kept": F.col("total") - total(c["gone"], lambda k: of(k, "removed")),
            "removed": of(c["key"], "removed"),
            "redundant": total(c["earlier"], lambda k: of(k, "taken")),
            "unique_fails": of(c["rest"], "removed"),
            **{f"{name}_lost": of(c["key"], name) for name in losses},
            "shapley": total(c["sums"], lambda k: of(k["key"], "removed") * k["uses"]),
        }
        named_values = [part for n, v in values.items() for part in (F.lit(n), v)]
        return F.struct(c["key"], F.named_struct(*named_values))

    lines = F.map_from_entries(F.transform(_constant(_combinations(len(filters), uses), _COMBINATIONS), line))
    ordered = parts.select("part", lines.alias("lines"), F.explode(_constant(named, _ORDERS)).alias("order"))
    stepped = ordered.select("part", "lines", "order.filter_order", F.posexplode("order.keys").alias("step", "key"))
    columns = ["kept", "removed", "redundant", "unique_fails", *[f"{n}_lost" for n in losses], "shapley"]
    found_line = F.element_at("lines", F.col("key"))
    return stepped.select(
        "part", "filter_order", (F.col("step") + 1).alias("step"), *[found_line[c].alias(c) for c in columns]
    )
