"""From raw documents to a training mix, stage by stage.

Each stage takes all that its predecessor kept and is written before the next
reads it. Language identification drops texts of no known language, line dedup
cuts lines that many documents share, SimHash keeps one document of each group
of near-copies, decontamination drops documents that hold passages of the
benchmark, and mixing says how many words of each document the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import decontaminate, language_id, line_dedup, mixing, simhash
from seriesloom.llm.rows import read
from seriesloom.session import written

# A text less like every language than this is none of them. Prose scores 0.4 and more.
LEAST_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones are in.

    Null texts, texts without a letter and texts unlike all profiles go.
    """
    found = language_id.identify(docs, language_id.learn(docs))
    kept = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.filter(kept).select(docs.columns)


def cut_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that five or more share; ``n_chars`` follows the text."""
    cut = line_dedup.line_dedup(docs)
    changed = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", changed.cast("long")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    return simhash.simhash_dedup(docs).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with the words it takes of each (``taken``, repeats counted)."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", cut_shared_lines),
    ("simhash_neardup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
]

# SimHash fingerprints and their groups have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
