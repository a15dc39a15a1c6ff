"""Nulls, empty and long texts, ties, repeated rows, clashing names, empty tables."""

import math

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from seriesloom.llm import (
    decontaminate,
    embedding_neardup,
    language_id,
    line_dedup,
    mixing,
    pitman_yor,
    quality,
    simhash,
    suffix_dedup,
    toxicity,
)

LONG_LINE = "A line that is long enough to be counted among all the others"
PASSAGE = " ".join(f"passage{i}" for i in range(60))
VERY_LONG = "\n".join(f"{n} " + " ".join(f"w{n * k % 977}" for k in range(40)) for n in range(3000))

# Extra columns have the names that the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, th string, key string, "
    "fp long, component string, found string, h1 string, words string, _row string, size string, score string"
)
TEXTS = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n", "en", None),
    (4, f"{LONG_LINE}\nthe end of it", "en", "a"),
    (5, f"  {LONG_LINE.upper()}\t\nanother end", "en", "b"),
    (6, f"{LONG_LINE}\n{LONG_LINE}", None, "b"),
    (7, f"x\n{LONG_LINE}\ny", "en", "b"),
    (8, LONG_LINE, "en", ""),
    (9, VERY_LONG, "en", "a"),
    (10, f"before {PASSAGE} after", "de", "a"),
    (11, f"other {PASSAGE} words", "de", "c"),
    (12, "der die das und nicht mit einem ein eine ist das haus", "de", "c"),
    (13, "the and of to in is it that was for on are as with", "en", "c"),
    (14, "12345 !!! ???", "en", "c"),
    (15, "one", "en", "é"),
    (15, "one", "en", "é"),
    (16, "naïve café déjà vu élève 🙂 日本語", "fr", "日"),
    (None, "no id but some words the and of", "en", "a"),
    (None, LONG_LINE, "en", "a"),
]
KEYS = [("doc_id", 0), ("text", 1), ("lang", 2), ("source", 3)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, source, len(t or ""), 7, "x", "y", 1, "c", "f", "h", "w", "r", "s", "z") for i, t, lang, source in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def with_ids(rows):
    return [(i, t) for i, t, *_ in rows if i is not None]


def unique(rows):
    return list(dict.fromkeys(rows))


def same_columns(df, docs, *new):
    assert [c for c in df.columns if c not in new] == [c for c in docs.columns if c not in new]
    assert set(new) <= set(df.columns)


def test_line_dedup(docs, none):
    found = line_dedup.line_dedup(docs)
    same_columns(found, docs, "text", "n_lines", "n_dropped")
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in rows if r.doc_id}
    # rows without an id are one document more, which no id of its own keeps lines for
    want = brute.line_dedup(unique([(i or -1, t) for i, t, *_ in TEXTS if i or t == LONG_LINE]))
    want.pop(-1)
    assert got == want
    assert next(r for r in rows if r.doc_id == 1).text is None
    assert {r.n_dropped for r in rows if r.doc_id is None} == {0, 1}
    assert line_dedup.line_dedup(none).collect() == []


def test_line_dedup_keeps_the_threshold(spark):
    rows = [(i, f"{'a' * 40}\n{'b' * 39}\n{'c' * 40 if i > 1 else ''}") for i in range(1, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.line_dedup(df).collect()}
    assert got == brute.line_dedup(rows)
    assert [got[i][1] for i in range(1, 6)] == [1, 1, 1, 1, 0]


def test_simhash(docs, none):
    rows = simhash.simhash_groups(docs).collect()
    assert len(rows) == len(TEXTS)
    want = brute.simhash_groups(unique([(i, t) for i, t, *_ in TEXTS if i]))
    for r in rows:
        if r.id:
            assert (f"{r.fp % 2**64:016x}", r.component) == want[r.id]
    assert want[1][1] == want[2][1] == want[3][1] == 1
    # the row without an id that copies document 8 is in its group
    assert [r.component for r in rows if r.id is None and r.fp % 2**64 == int(want[8][0], 16)] == [want[8][1]]
    kept = simhash.simhash_dedup(docs)
    same_columns(kept, docs)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == sorted(i for i, *_ in TEXTS if i and want[i][1] == i)
    assert simhash.simhash_groups(none).collect() == []
    assert simhash.simhash_dedup(none).collect() == []


def test_simhash_drops_rows_not_ids(spark):
    def words(name):
        return " ".join(f"{name}{i}" for i in range(40))

    rows = [
        (1, words("a")),
        (None, words("a")),  # a copy of 1
        (None, words("b")),  # no id in its group
        (None, words("c")),
        (5, words("d")),  # names its group
        (6, words("d")),
        (3, words("e")),
        (5, words("e")),  # the same id in the group of 3
        (7, words("f")),
        (7, words("f")),
    ]
    kept = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    want = [rows[i] for i in (0, 2, 3, 4, 6, 8, 9)]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


def test_decontaminate(spark, docs, none):
    items = [
        (1, None),
        (2, ""),
        (3, "passage5 passage6 passage7 passage8 passage9 passage10 passage11 passage12 passage13 passage14 passage15"),
        (4, "ONE"),
        (5, "Der, die; das!"),
        (6, "日本語"),
        (7, "one"),
        (None, "vu élève"),
        (3, "the and of"),
    ]
    bench = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, item string, hash string")
    rows = decontaminate.contamination(docs, bench).collect()
    assert len(rows) == len(TEXTS)
    want = brute.contamination(unique(with_ids(TEXTS)), items)
    assert {r.id: (r.n_words, r.n_hit, r["items"]) for r in rows if r.id is not None} == want
    assert want[15][2] == ["4", "7"] and want[16] == (7, 3, ["6"]) and want[10][1] == 11
    kept = decontaminate.decontaminate(docs, bench)
    same_columns(kept, docs)
    hit = {i for i, w in want.items() if w[1]}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [i for i, *_ in TEXTS if i and i not in hit]
    assert decontaminate.contamination(none, bench).collect() == []
    assert {r.n_hit for r in decontaminate.contamination(docs, bench.filter("false")).collect()} == {0}
    assert decontaminate.decontaminate(docs, bench.filter("false")).count() == len(TEXTS)


def test_mix(docs, none):
    rows = mixing.Mix(docs).docs.collect()
    assert len(rows) == len(TEXTS)
    known = [t for t in unique(TEXTS) if t[0] is not None]
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r["size"]
    for source, own in by_source.items():
        assert sum(r["size"] for r in own) == own[0].source_size
        assert sum(r.taken for r in own) == math.floor(own[0].target)
    assert set(by_source) == {t[3] for t in known} and by_source[None][0].target == 0
    plain = brute.mix([(n, t, s) for n, (_, t, _, s) in enumerate(TEXTS)])
    assert {r.source: r.target for r in rows} == {TEXTS[n][3]: w[2] for n, w in plain.items()}
    mixed = mixing.mix(docs)
    same_columns(mixed, docs, "size", "source_size", "target", "taken")
    assert sum(r.taken for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.Mix(none).docs.collect() == []
    assert mixing.mix(none).collect() == []


def test_pieces_cover_what_is_taken(spark):
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), f"s{i % 4 if i % 3 else 0}") for i in range(300)]
    found = mixing.Mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), slots=200)
    taken = {r.id: r.taken for r in found.docs.collect()}
    assert taken == {i: w[3] for i, w in brute.mix(rows).items()}
    pieces = found.pieces.collect()
    slots = {(p.slot, p.src, p.block) for p in pieces}
    assert len(slots) == len({s for s, *_ in slots}) == len({(a, b) for _, a, b in slots})
    # whatever the length, what a source has been given is near its share
    shares = {}
    for nth, (_, src, _) in enumerate(sorted(slots)):
        shares.setdefault(src, []).append(nth)
    for own in shares.values():
        for n, nth in enumerate(own):
            assert abs((n + 1) / len(own) - (nth + 1) / len(slots)) < 0.15


def test_language(docs, none):
    model = language_id.learn(docs)
    assert model.langs == ["de", "en", "fr"]
    found = language_id.identify(docs, model)
    same_columns(found, docs, "lang_pred", "score")
    profiles = {
        lang: brute.profile([t for _, t, x, _ in TEXTS if x == lang], 400) for lang in model.langs
    }
    want = {t: brute.language(t, profiles, 400) for _, t, *_ in TEXTS}
    for r in found.collect():
        assert r.lang_pred == want[r.text][0]
        assert r.score == pytest.approx(float(want[r.text][1]))
    assert want[None] == want["12345 !!! ???"] == ("und", 0.0)
    assert language_id.identify(none, model).collect() == []
    nothing = language_id.learn(none)
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_toxicity(spark, docs, none):
    rows = [(4, 1), (5, 1), (7, 1), (8, 1), (9, 0), (10, 0), (13, None), (None, 1), (99, 1), (4, 0)]
    labels = spark.createDataFrame([(i, 1, t) for i, t in rows], "doc_id long, quality int, toxic int")
    machine = toxicity.fit(docs, labels)
    found = toxicity.score(docs, machine)
    same_columns(found, docs, "score")
    scores = [r.score for r in found.collect()]
    assert len(scores) == len(TEXTS) and all(0 <= s <= 1 for s in scores)
    assert toxicity.score(none, machine).collect() == []
    blank = toxicity.fit(none, labels)
    assert {r.score for r in toxicity.score(docs, blank).collect()} == {0.5}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.filter("false"))).collect()} == {0.5}


def test_quality(docs, none):
    scorer = quality.fit(docs)
    found = quality.score(docs, scorer)
    same_columns(found, docs, "weak_label", "score", "kept")
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= quality.LEAST) for r in rows)
    assert len({(r.weak_label, r.score) for r in rows if not (r.text or "").strip() and not r.text}) == 1
    assert quality.score(none, scorer).collect() == []
    assert quality.score(docs, quality.fit(none)).count() == len(TEXTS)


def test_suffixes(docs, none):
    found = suffix_dedup.suffix_dedup(docs)
    same_columns(found, docs, "kept_bytes", "n_bytes", "n_removed", "n_spans")
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    want = brute.cut_repeats([t for _, t, *_ in TEXTS], 400)
    by_text = {t: w for (_, t, *_), w in zip(TEXTS, want)}
    for r in rows:
        assert (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept_bytes))) == by_text[r.text]
    assert by_text[TEXTS[9][1]][1] >= len(PASSAGE)
    assert suffix_dedup.suffix_dedup(none).collect() == []


def test_language_model(docs, none):
    rows = pitman_yor.scores(docs, F.coalesce(F.col("doc_id") != 13, F.lit(True))).collect()
    assert len(rows) == len(TEXTS)
    by_id = {r.id: r for r in rows if r.id}
    assert by_id[1].n_tokens == by_id[2].n_tokens == by_id[3].n_tokens == by_id[1].n_known == 1
    assert by_id[1].score == by_id[2].score < 0
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert not by_id[13].train
    assert len({(r.score, r.base_score) for r in rows if r.id == 15}) == 1
    assert pitman_yor.scores(none, F.lit(True)).collect() == []
    unlearned = pitman_yor.scores(docs, F.lit(False)).collect()
    assert len(unlearned) == len(TEXTS)
    assert {(round(r.score, 9), round(r.base_score, 9), r.n_known) for r in unlearned} == {(0.0, 0.0, 0)}


def test_embeddings(spark):
    near, far = [1.0, 0.1, 0.0], [0.0, 1.0, 0.0]
    rows = [
        (1, near, 1),
        (2, [2.0, 0.2, 0.0], 1),
        (3, [1.0, 0.1, 0.01], 1),
        (4, far, 1),
        (5, near, 2),
        (6, near, None),
        (7, None, 1),
        (8, [], 1),
        (9, [0.0, 0.0, 0.0], 1),
        (10, [1.0, None, 0.0], 1),
        (11, [1.0, float("nan"), 0.0], 1),
        (12, [float("inf"), 1.0, 0.0], 1),
        (13, near, 1),
        (14, [1.0, 0.1], 1),
        (15, [1e-38, 1e-39, 0.0], 1),
        (None, near, 1),
        (4, far, 1),
    ]
    schema = "vec_id long, embedding array<float>, label int, id string, h1 string, vector string, root int"
    df = spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], schema)
    found = embedding_neardup.embedding_neardup(df)
    same_columns(found, df, "n_links", "component_id", "kept")
    got = found.collect()
    assert len(got) == len(rows)
    exact = [(r.vec_id, r.embedding, r.label) for r in df.limit(15).collect()]
    want = brute.embedding_links(exact)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == want
    assert want[13] == (4, 1) and want[5] == (0, 5)
    alone = [r for r in got if r.vec_id is None]
    assert [(r.n_links, r.component_id) for r in alone] == [(0, None)]
    assert embedding_neardup.embedding_neardup(df.filter("false")).collect() == []


def test_pipeline_stages(spark, docs, none, tmp_path):
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame, most in ((docs, len(TEXTS)), (none, 0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, frame, str(tmp_path))
            assert kept.columns == frame.columns
            assert kept.count() <= most
        assert corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).count() <= most
    kept = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()}
    assert not kept & {10, 11} and {4, 12, 13} <= kept
