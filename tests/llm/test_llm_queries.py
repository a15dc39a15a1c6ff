"""The registered text queries: against SQL, plain versions or held-out rows."""

import math
import os
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_points
import brute
import corpus_pipeline
from compare import connect, first_difference, spark_rows, spark_types, sql_rows, sql_types
from seriesloom.llm.queries import all_queries, all_sql

FOLDER = os.environ.get("SERIESLOOM_TEST_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def table(name):
    return pq.read_table(f"{FOLDER}/{name}.parquet").to_pylist()


def rows_of(spark, name):
    return {r[0]: r for r in all_queries()[name](spark, FOLDER).collect()}


def test_all_are_registered():
    names = set(entry_points.queries())
    assert set(all_queries()) <= names and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in all_queries()} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_same_as_sql(spark, name):
    connection = connect(FOLDER)
    df = all_queries()[name](spark, FOLDER)
    assert spark_types(df) == sql_types(connection, all_sql()[name])
    names, rows = spark_rows(df)
    expected_names, expected = sql_rows(connection, all_sql()[name])
    assert names == expected_names
    assert len(rows) == len(expected) > 0
    assert first_difference(rows, expected) is None


def test_embeddings_against_all_pairs(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table("embeddings")]
    found = rows_of(spark, "op1_embedding_neardup")
    want = brute.embedding_links(rows)
    assert {i: (r.n_links, r.component_id) for i, r in found.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in found.items())


def test_suffixes_against_all_strings(spark):
    docs = table("documents")
    found = rows_of(spark, "op3_suffix_dedup")
    want = brute.cut_repeats([d["text"] for d in docs], 400)
    assert {i: tuple(r)[1:] for i, r in found.items()} == {d["doc_id"]: w for d, w in zip(docs, want)}
    assert any(r.n_removed for r in found.values())


def test_simhash_against_all_pairs(spark):
    docs = [(d["doc_id"], d["text"]) for d in table("documents")]
    found = rows_of(spark, "op4_simhash_neardup")
    assert {i: tuple(r)[1:] for i, r in found.items()} == brute.simhash_groups(docs)


def test_language_model_counts_and_beats_its_base(spark):
    docs = table("documents")
    found = rows_of(spark, "op8_lm_scores")

    def tokens(text):
        return [*(text or "").encode().lower().split(), None]

    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 10 == 0 for d in docs}
    counts = Counter(t for d in docs if not held[d["doc_id"]] for t in tokens(d["text"]))
    total, distinct = sum(counts.values()), len(counts)
    for d in docs:
        r, own = found[d["doc_id"]], tokens(d["text"])
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        assert r.held_out == held[d["doc_id"]]
        assert (r.n_tokens, r.train_tokens) == (len(own), total)
        assert r.n_known == sum(t in counts for t in own)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0
    unseen = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_toxicity_scores_tell_the_labels_apart(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table("labels")}
    found = rows_of(spark, "op9_toxicity")
    assert len(found) == len(table("documents"))
    for r in found.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    known = [(r.score, labels[i]) for i, r in found.items() if not r.held_out and i in labels]
    toxic = [s for s, label in known if label]
    clean = [s for s, label in known if not label]
    assert sum(a > b for a in toxic for b in clean) > 0.95 * len(toxic) * len(clean)


def test_languages_of_held_out_texts(spark):
    docs = {d["doc_id"]: d for d in table("documents")}
    found = rows_of(spark, "op10_language_id")
    held = [i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert [i for i in docs if found[i].held_out] == held
    right = sum(found[i].lang_pred == docs[i]["lang"] for i in held)
    assert right >= 0.97 * len(held)


def test_quality_scores_agree_with_labels(spark):
    quality = {r["doc_id"]: r["quality"] for r in table("labels")}
    found = rows_of(spark, "op2_quality")
    assert len(found) == len(table("documents"))
    known = [(found[i].kept, bool(q)) for i, q in quality.items() if i in found]
    assert sum(a == b for a, b in known) >= 0.95 * len(known)


def test_weak_labels_against_a_plain_model(spark):
    """Labels of the query, what the votes are like, and accuracies against labels nobody saw."""
    docs = {d["doc_id"]: d["text"] for d in table("documents")}
    quality = {r["doc_id"]: r["quality"] for r in table("labels")}
    votes = {i: brute.weak_votes(t) for i, t in docs.items()}
    labels, accuracy = brute.weak_labels(list(votes.values()))
    labels = dict(zip(votes, labels))
    found = rows_of(spark, "op2_quality")
    assert all(abs(found[i].weak_label - p) < 1e-6 for i, p in labels.items())

    assert sum(max(v) > 0 > min(v) for v in votes.values()) >= 0.1 * len(votes)
    for j, estimate in enumerate(accuracy):
        cast = [(votes[i][j] > 0) == bool(q) for i, q in quality.items() if i in votes and votes[i][j]]
        assert cast and abs(estimate - sum(cast) / len(cast)) < 0.1
        assert any((votes[i][j] > 0) != (p > 0.5) for i, p in labels.items())
    right = sum((labels[i] > 0.5) == bool(q) for i, q in quality.items() if i in labels)
    majority = sum((sum(votes[i]) > 0) == bool(q) for i, q in quality.items() if i in votes)
    assert right > majority


def test_pipeline_against_plain_stages(spark):
    size = 400
    docs = {d["doc_id"]: d for d in table("documents")}
    langs = {d["lang"] for d in docs.values() if d["lang"]}
    profiles = {
        lang: brute.profile([d["text"] for d in docs.values() if d["lang"] == lang], size) for lang in langs
    }
    texts = {}
    for i, d in docs.items():
        lang, score = brute.language(d["text"], profiles, size)
        if lang != "und" and score >= corpus_pipeline.LEAST_SCORE:
            texts[i] = d["text"]
    texts = {i: left for i, (_, _, left) in brute.line_dedup(texts.items()).items()}
    groups = brute.simhash_groups(texts.items())
    texts = {i: t for i, t in texts.items() if groups[i][1] == i}
    items = [(r["item_id"], r["text"]) for r in table("benchmark")]
    hit = brute.contamination(texts.items(), items)
    texts = {i: t for i, t in texts.items() if not hit[i][1]}
    want = brute.mix([(i, t, docs[i]["source"]) for i, t in texts.items()])

    found = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert set(found) == {i for i, w in want.items() if w[3]}
    for i, r in found.items():
        assert (r.size, r.source_size, r.target, r.taken) == want[i]
        assert r.text == texts[i]


def test_pipeline_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).dtypes == docs.dtypes
