"""Registered queries of the text operators: whole tables, production settings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import decontaminate, embedding_neardup, filter_audit, importance, language_id
from seriesloom.llm import line_dedup as lines
from seriesloom.llm import mixing, pitman_yor, quality, simhash, suffix_dedup, token_files, toxicity
from seriesloom.llm.rows import read
from seriesloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

_REGISTERED: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    _REGISTERED[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_REGISTERED)


def all_sql() -> dict[str, str]:
    return dict(_SQL)


@query
def op1_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    found = embedding_neardup.embedding_neardup(read(spark, folder, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    found = quality.score(docs, quality.fit(docs))
    return found.select("doc_id", "weak_label", "score", "kept")


@query
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(read(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )


@query
def op4_simhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_groups(read(spark, folder, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        simhash.hex_digits(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.Mix(read(spark, folder, "documents"))
    return mix.docs.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


_SQL["op5_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
),
ranked AS (
  SELECT source, source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
),
ordered AS (
  SELECT *, (SELECT sum(source_size) FROM ranked) AS total,
         coalesce(sum(2 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM ranked WINDOW w AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST)
),
units AS (
  SELECT *, row_number() OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST) AS nth,
         (CAST(1.5 AS DOUBLE) * CAST(total AS DOUBLE) - CAST(given AS DOUBLE)) / CAST(weights AS DOUBLE) AS unit
  FROM ordered
),
unit AS (SELECT arg_min(unit, nth) AS unit FROM units WHERE weight * unit <= 2 * source_size),
targets AS (
  SELECT source, source_size, least(weight * unit, CAST(2 * source_size AS DOUBLE)) AS target FROM ranked, unit
),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS quota,
         coalesce(sum(s.size) OVER (PARTITION BY t.source ORDER BY s.key, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE
         least(size, greatest(0, quota - before)) + least(size, greatest(0, quota - source_size - before)) END AS BIGINT) AS taken
FROM placed
"""


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = lines.line_dedup(read(spark, folder, "documents"))
    return docs.select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


_SQL["op6_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
  SELECT l.*, s.key IS NOT NULL AND l.doc_id <> s.keeper AS dropped
  FROM lines l LEFT JOIN shared s ON l.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        read(spark, folder, "documents"), read(spark, folder, "benchmark")
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_SQL["op7_decontaminate"] = r"""
WITH cut AS (
  SELECT 'd' AS side, doc_id AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT 'b', item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark
),
item_windows AS (
  SELECT DISTINCT id AS item_id, least(len(w), 10) AS size,
         array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS run
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s
        FROM cut WHERE side = 'b' AND len(w) > 0)
),
doc_windows AS (
  SELECT id AS doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS run
  FROM (SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS s
        FROM cut, (SELECT DISTINCT size FROM item_windows)
        WHERE side = 'd' AND len(w) >= size)
),
hits AS (
  SELECT doc_id, s, d.size, item_id FROM doc_windows d JOIN item_windows i ON d.run = i.run
),
words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS list
  FROM hits GROUP BY doc_id
)
SELECT c.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM cut c LEFT JOIN words_hit h ON c.id = h.doc_id LEFT JOIN items i ON c.id = i.doc_id
WHERE side = 'd'
"""


@query
def op8_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = pitman_yor.held_out(F.col("doc_id"))
    found = pitman_yor.scores(read(spark, folder, "documents"), ~held_out)
    return found.select(
        F.col("id").alias("doc_id"),
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    labels = read(spark, folder, "labels")
    machine = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.score(docs, machine).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").withColumn(
        "held_out", language_id.held_out(F.col("doc_id"))
    )
    model = language_id.learn(docs.filter(~F.col("held_out")))
    return language_id.identify(docs, model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(read(spark, folder, "documents"), path, str(tokenizer))
    found = token_files.read_tokens(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.importance_scores(
        read(spark, folder, "documents"), read(spark, folder, "benchmark"), grams=(1, 1), buckets=10000
    )
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


_SQL["op12_importance"] = r"""
WITH cut AS (
  SELECT 'd' AS side, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT 'b', NULL,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark
),
crc AS (
  SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
                          lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
),
words AS (SELECT side, doc_id, unnest(w) AS word FROM cut),
hashed AS (
  SELECT word,
         xor(list_reduce(list_concat([4294967295], bytes),
                         lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT word, list_transform(range(0, strlen(word)),
                       lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT)) AS bytes
        FROM (SELECT DISTINCT word FROM words)), crc
),
found AS (SELECT side, doc_id, bucket FROM words JOIN hashed USING (word)),
counts AS (
  SELECT bucket, CAST(count(*) FILTER (WHERE side = 'd') AS DOUBLE) AS s, CAST(count(*) FILTER (WHERE side = 'b') AS DOUBLE) AS t
  FROM found GROUP BY bucket
),
totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM counts, totals
),
weights AS (
  SELECT doc_id, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM found JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST(CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM cut LEFT JOIN weights USING (doc_id) WHERE side = 'd'
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, rank
FROM scored LEFT JOIN (SELECT * FROM ranked WHERE rank <= (SELECT count(*) FROM ranked) * 10 // 100) USING (doc_id)
"""


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = read(spark, folder, "labels").withColumnRenamed("doc_id", "id")
    losses = {"good": labels.filter("quality = 1"), "toxic": labels.filter("toxic = 1")}
    found = filter_audit.failures(read(spark, folder, "documents"))
    return filter_audit.audit(found, "ABCDE", losses)


_SQL["op13_filter_audit"] = r"""
WITH facts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
failing AS (
  SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d, doc_id > min(doc_id) OVER (PARTITION BY text) AS e,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM facts
),
kinds AS (
  SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, count(*) FILTER (WHERE good) AS good,
         count(*) FILTER (WHERE toxic) AS toxic
  FROM failing GROUP BY part, a, b, c, d, e
),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
),
steps AS (SELECT o, step, o[step] AS f, o[1 : step - 1] AS before FROM orders, (SELECT unnest(range(1, 6)) AS step)),
seen AS (
  SELECT k.*, s.*, fails[f] AS failing,
         len(list_filter(before, lambda i: fails[i])) > 0 AS gone,
         len(list_filter(fails, lambda x: x)) = 1 AS alone
  FROM kinds k, steps s
),
counted AS (
  SELECT part, o, step, f,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT failing), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE NOT gone AND failing), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE gone AND failing), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE failing AND alone), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT gone AND failing), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE NOT gone AND failing), 0) AS toxic_lost
  FROM seen GROUP BY part, o, step, f
)
SELECT part, list_aggregate(list_transform(o, lambda i: substr('ABCDE', i, 1)), 'string_agg', '') AS filter_order,
       CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
