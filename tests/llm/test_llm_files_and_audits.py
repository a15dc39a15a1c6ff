"""Token files, importance resampling and filter audits: whole tables and edge cases."""

import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from seriesloom.llm import filter_audit, importance, token_files
from test_llm_edges import TEXTS, VERY_LONG, docs, none  # noqa: F401
from test_llm_queries import FOLDER, rows_of, table

BYTE_LEVEL = str(public_tokenizers.path("byte_bpe_50k.json"))
WORD_ENDS = str(public_tokenizers.path("word_bpe_49k.json"))
AUDIT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_LEVEL)


@pytest.fixture(scope="module")
def encoder():
    with open(BYTE_LEVEL, encoding="utf-8") as file:
        definition = file.read()
    return lambda: token_files.Encoder(definition, "<u2", 0)


def ids_of(library, text, end=0):
    return [*library.encode(text or "", add_special_tokens=False).ids, end]


def same_ids(encoder, library, texts):
    for text, found in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(found, "<u2").tolist() == ids_of(library, text), text[:100]


def test_token_query_against_the_library(spark, library):
    found, start = rows_of(spark, "op11_token_files"), 0
    documents = sorted(table("documents"), key=lambda d: d["doc_id"])
    assert len(found) == len(documents)
    for d in documents:
        ids = np.array(ids_of(library, d["text"]), "<u4")
        assert tuple(found[d["doc_id"]]) == (d["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_words_are_encoded_as_the_library_does(encoder, library):
    draw = random.Random(3)
    parts = [
        "don't", "we'll 've 's'S", "'t", "  \n\t", "\r\n\r\n", "<|endoftext|>", " ", " ", " ", "\n", "\t", "   x", "12 345",
        "!!?", "na\u00efve", "\u65e5\u672c\u8a9e", "\xa0", "\u2003", "\x85", "\x1c\x1d\x1f", "\u200b", "\U0001f642",
        "\xe9", "\xbd\xb2\u2167", "\u0378", "\u0149", "\ufeff", "a_b-c", "\U0010ffff", "word", "another", ".", ",",
    ]
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(draw.choices(parts, k=draw.randrange(40))) for _ in range(5000)]
    texts += [" ".join(draw.choices(parts + points[:600], k=draw.randrange(60))) for _ in range(2000)]
    # every character of the first planes beside letters, digits and blanks
    texts += ["".join(f"a{c}1{c} {c}\n{c} b" for c in points[n : n + 64]) for n in range(0, 0x20000, 64)]
    texts += [f"{a}{c}{b}x" for c in points[:0x3100] for a, b in ((" ", " "), ("\n", ""), ("a", " "))]
    one = encoder()
    same_ids(one, library, ["", " ", *texts])
    same_ids(one, library, texts)
    assert sum(map(one._regular, texts)) > len(texts) / 3


def test_long_texts_are_cut_between_words(encoder, library, monkeypatch):
    monkeypatch.setattr(token_files, "STRETCH", 50)
    monkeypatch.setattr(token_files, "KNOWN", 40)
    odd_places = "a b\tc\n d \ne " * 30 + "x" * 300 + " 1 'tis we'll " * 20 + "y"
    small = encoder()
    same_ids(small, library, [VERY_LONG[:20000], odd_places, "", odd_places[::-1]])
    assert small._regular(odd_places) and len(list(token_files._stretches(odd_places))) > 5
    assert len(small.known.hashes) <= 40


def test_words_whose_hashes_meet(encoder, library, monkeypatch):
    monkeypatch.setattr(token_files, "mixed", lambda x: x & np.uint64(15))
    one = encoder()
    texts = [VERY_LONG[:3000], "some other words", "some words"]
    same_ids(one, library, texts)
    same_ids(one, library, [t[::-1] for t in texts])


def test_token_files(spark, docs, none, library, tmp_path):  # noqa: F811
    path = str(tmp_path / "tokens")
    manifest = token_files.write_tokens(docs, path, BYTE_LEVEL, part_bytes=1 << 14)
    rows = token_files.read_tokens(spark, path).collect()
    want = sorted(((i, t) for i, t, *_ in TEXTS if i is not None), key=lambda r: r[0])
    named = sorted((r for r in rows if r.doc_id is not None), key=lambda r: r.start)
    assert [r.doc_id for r in named] == [i for i, _ in want]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in named] == [ids_of(library, t) for _, t in want]
    # rows without an id come last
    nameless = sorted((r for r in rows if r.doc_id is None), key=lambda r: r.start)
    assert len(nameless) == 2 and nameless[0].start == named[-1].start + named[-1].n_tokens
    everything = np.concatenate([np.frombuffer(r.ids, "<u4") for r in [*named, *nameless]])

    assert manifest["dtype"] == "<u2" and len(manifest["parts"]) > 1
    flat = b"".join((tmp_path / "tokens" / f"{p['name']}.bin").read_bytes() for p in manifest["parts"])
    assert np.frombuffer(flat, "<u2").tolist() == everything.tolist()
    bases = [p["base"] for p in manifest["parts"]]
    assert bases == np.cumsum([0, *[p["ids"] for p in manifest["parts"]]])[:-1].tolist()

    files = token_files.TokenFiles(path)
    assert len(files) == len(everything) and files.n_docs == len(TEXTS)
    for start, size in [(0, 10), (bases[-1] - 5, 10), (bases[-1], 3), (1, len(files)), (len(files) - 3, 9), (len(files), 4)]:
        assert files.window(start, size).tolist() == everything[start : start + size].tolist()
    assert isinstance(files.document(0), np.memmap)
    assert [files.document(n).tolist() for n in range(len(want))] == [ids_of(library, t) for _, t in want]
    for wrong in (lambda: files.document(len(TEXTS)), lambda: files.window(-1, 3)):
        with pytest.raises(IndexError):
            wrong()

    empty = str(tmp_path / "empty")
    assert token_files.write_tokens(none, empty, BYTE_LEVEL)["parts"] == []
    assert token_files.read_tokens(spark, empty).collect() == []
    assert len(token_files.TokenFiles(empty)) == 0


def test_token_files_ignore_attempts_that_failed(spark, docs, tmp_path):  # noqa: F811
    path = tmp_path / "tokens"
    manifest = token_files.write_tokens(docs, str(path), BYTE_LEVEL)
    before = sorted(token_files.read_tokens(spark, str(path)).collect(), key=str)
    name = manifest["parts"][0]["name"]
    for kind in ("bin", "idx", "doc"):
        (path / f"{name}9.{kind}").write_bytes((path / f"{name}.{kind}").read_bytes()[:5])
    assert sorted(token_files.read_tokens(spark, str(path)).collect(), key=str) == before


def test_token_files_of_wide_ids_and_other_tokenizers(spark, docs, tmp_path):  # noqa: F811
    wide = str(tmp_path / "wide")
    assert token_files.write_tokens(docs, wide, WORD_ENDS, end_id=70000)["dtype"] == "<u4"
    library = Tokenizer.from_file(WORD_ENDS)
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read_tokens(spark, wide).collect()}
    for i, text, *_ in TEXTS:
        if i is not None:
            assert found[i] == ids_of(library, text, 70000)
    json.loads((tmp_path / "wide" / "manifest.json").read_text())


def test_grams_overlap():
    line = importance.normal_line("  One,two\tthree--ONE 2é! ")
    assert line == "one two three one 2é".encode()
    words = line.decode().split(" ")
    for n in (1, 2, 3, 6):
        spans = [m.group().decode() for m in importance.gram_pattern(n).finditer(line, overlapped=True)]
        assert spans == [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("grams, buckets, percent", [((1, 1), 10000, 10), ((1, 2), 97, 50), ((2, 3), 100_000, 100)])
def test_importance_against_plain_scores(spark, grams, buckets, percent):
    documents, items = table("documents"), [r["text"] for r in table("benchmark")]
    found = importance.importance_scores(
        spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/benchmark.parquet"),
        grams=grams, buckets=buckets, percent=percent,
    )
    got = {r.id: (r.id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()}
    want = brute.importance([(d["doc_id"], d["text"]) for d in documents], items, grams, buckets, percent=percent)
    assert got == {w[0]: w for w in want}


def test_importance_edges(spark, docs, none):  # noqa: F811
    goal = spark.createDataFrame([(None,), ("",), ("the and of to in",)], "words string")
    made = {"target_text": "words", "grams": (1, 2), "min_words": 1, "percent": 60}
    found = importance.importance_scores(docs, goal, **made).collect()
    want = brute.importance([r[:2] for r in TEXTS], ["the and of to in"], (1, 2), min_words=1, percent=60)

    def key(row):
        return str(row[:4])

    got = sorted(((r.id, r.n_features, r.weight, r.score, r["rank"]) for r in found), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in sorted(want, key=key)]
    # equal rows may swap their ranks
    assert Counter(g[4] for g in got) == Counter(w[4] for w in want)
    assert {g[0]: g[4] for g in got if g[0] not in (None, 15)} == {w[0]: w[4] for w in want if w[0] not in (None, 15)}

    kept = importance.resample(docs, goal, **made)
    new = ("n_features", "weight", "score", "rank")
    assert [c for c in kept.columns if c not in new] == [c for c in docs.columns if c not in new]
    drawn = {w[0] for w in want if w[4]}
    assert {r.doc_id for r in kept.collect()} == drawn
    assert importance.importance_scores(none, goal, **made).collect() == []
    assert importance.resample(none, goal, **made).collect() == []
    blank = importance.importance_scores(docs, goal.filter("false"), **made).collect()
    plain = brute.importance([r[:2] for r in TEXTS], [], (1, 2), min_words=1, percent=60)
    assert sorted(r.score for r in blank) == sorted(w[3] for w in plain)


def test_importance_of_many_equal_rows(spark):
    rows = [(None, "the same words " * 8)] * 300 + [(7, "the same words " * 8)] * 300 + [(i, f"w{i} " * 30) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    goal = spark.createDataFrame([("the same words",)], "text string")
    found = importance.importance_scores(df, goal, grams=(1, 1), percent=70).collect()
    want = brute.importance(rows, ["the same words"], percent=70)
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 631))
    scores = [r.score for r in sorted(found, key=lambda r: r["rank"] or 10**6) if r["rank"]]
    assert scores == sorted((w[3] for w in want), reverse=True)[:630]
    assert importance.resample(df, goal, grams=(1, 1), percent=70).count() >= 630


def test_audit_edges(spark, docs, none):  # noqa: F811
    rows = [r[:2] for r in TEXTS]
    failed = brute.text_failures(rows)
    found = filter_audit.failures(docs)
    got = sorted(
        (str(r.id), "".join(n for n in "ABCDE" if r[n])) for r in found.collect()
    )
    assert got == sorted((str(i), "".join(sorted(f))) for (i, _), f in zip(rows, failed))
    assert [r.E for r in found.filter("id in (2, 15)").collect()] == [True, False, False]

    good = spark.createDataFrame([(2,), (2,), (9,), (None,), (99,)], "id long")
    toxic = spark.createDataFrame([(4,), (15,), (7,)], "id long")
    seen = filter_audit.audit(found, "ABCDE", {"good": good, "toxic": toxic}).collect()
    parts = [(i, lang or "", f) for (i, _, lang, _), f in zip(TEXTS, failed)]
    want = brute.audit(parts, "ABCDE", [{2, 9}, {4, 15, 7}])
    assert len(seen) == len(want) == 120 * 5 * len({p for _, p, _ in parts})
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in AUDIT) for r in seen} == want
    assert filter_audit.audit(filter_audit.failures(none), "ABCDE", {"good": good}).collect() == []


def test_audit_of_other_filters_and_orders(spark):
    draw = random.Random(5)
    rows = [(n, n % 40, draw.choice(["x", "y", ""]), *[draw.random() < p for p in (0.5, 0.1, 0.9)]) for n in range(400)]
    found = spark.createDataFrame(rows, "row long, id long, part string, short boolean, odd boolean, loud boolean")
    orders = [("odd", "loud", "short"), ("short", "odd", "loud")]
    names = ["short", "odd", "loud"]
    seen = filter_audit.audit(found, names, orders=orders).collect()
    plain = [(r[1], r[2], {n for n, failed in zip(names, r[3:]) if failed}) for r in rows]
    want = brute.audit(plain, names, [])
    columns = ("kept", "removed", "redundant", "unique_fails")
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in seen}
    assert got == {(p, "".join(o), n): want[p, "".join(o), n][:4] for p in ("x", "y", "") for o in orders for n in (1, 2, 3)}
    removed = Counter()
    for r in seen:
        removed[r.part, orders[[ "".join(o) for o in orders].index(r.filter_order)][r.step - 1]] += r.removed
    assert all(r.shapley in removed.values() for r in seen)
    alone = filter_audit.audit(found, ["odd"]).collect()
    assert {r.part: (r.removed, r.redundant, r.unique_fails, r.shapley) for r in alone} == {
        p: (k, 0, k, k) for p in ("x", "y", "") for k in [sum(r[2] == p and r[4] for r in rows)]
    }
    for wrong in ({"filters": []}, {"filters": list("ABCDEFG")}, {"filters": ["odd"], "orders": [("loud",)]}):
        with pytest.raises(ValueError):
            filter_audit.audit(found, **wrong)
