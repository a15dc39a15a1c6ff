"""Line dedup: lines that many documents share stay in one of them.

Lines are normalised, hashed to 128 bits and counted by distinct document. A
line over the threshold is dropped everywhere but in the largest id holding it;
the rest is put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.rows import BLANKS, fingerprint, lower_ascii, packed, same, unpacked
from seriesloom.session import written


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in ``min_docs`` documents or more, with the document that keeps them."""
    return (
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct(F.struct("id")).alias("n_docs"), F.max("id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
        .select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "keeper")
    )


def without(lines: Column, dropped: Column) -> Column:
    """``lines`` without the ascending positions ``dropped``: the runs between them, joined.

    Linear in both arrays; testing each line against the list would not be.
    """
    edges = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))
    runs = F.transform(
        F.sequence(F.lit(1), F.size(dropped) + 1),
        lambda i: F.slice(
            lines, F.get(edges, i - 1) + 2, F.get(edges, i) - F.get(edges, i - 1) - 1
        ),
    )
    return F.flatten(runs)


def line_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
) -> DataFrame:
    """``docs`` with shared lines cut from ``text``, ``n_lines`` before and ``n_dropped``.

    Null and empty texts are one empty line and stay as they are. Rows without
    an id count as one document, which keeps no shared line. Repeated rows are
    one document too and are treated alike. An empty table gives an empty one.
    """
    whole = packed(
        docs, id=docs[doc_id], text=docs[text], th=F.xxhash64(docs[text]).alias("th")
    )
    lines = written(
        docs.select(
            docs[doc_id].alias("id"),
            F.xxhash64(docs[text]).alias("th"),
            F.posexplode(F.transform(lines_of(docs[text]), line_key)).alias("pos", "key"),
        )
        .filter(F.length("key") >= min_chars)
        .select("id", "th", "pos", *[h.alias(n) for h, n in zip(fingerprint(F.col("key")), ("h1", "h2"))]),
        "lines",
    )
    # written, so that the join deals out both sides anew and a line that fills
    # a partition can be split
    shared = written(shared_lines(lines, min_docs), "shared")
    dropped = (
        lines.join(shared, (lines.h1 == shared.g1) & (lines.h2 == shared.g2))
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id", "th")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )
    joined = whole.join(dropped, same(whole, dropped, "id", "th"), "left")
    left_over = F.concat_ws("\n", without(lines_of(whole["text"]), F.col("dropped")))
    return unpacked(
        joined,
        **{
            text: F.when(F.col("dropped").isNull(), whole["text"]).otherwise(left_over),
            "n_lines": F.size(lines_of(whole["text"])).cast("long"),
            "n_dropped": F.coalesce(F.size("dropped"), F.lit(0)).cast("long"),
        },
    )
