"""Parts of the text operators: graphs, sorting, seating, fitting, crowded groups."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

import brute
from seriesloom.llm import embedding_neardup, hnsw, mixing, pitman_yor, quality, restaurants, simhash, suffix_dedup, toxicity
from seriesloom.llm.components import components
from seriesloom.llm.suffix_sort import Suffixes
from seriesloom.session import _written_by, written


def grouped(edges):
    groups = brute.Union()
    for a, b in edges:
        groups.join(a, b)
    return {x: groups.find(x) for x in groups.parent}


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(5, 5)],
        [(i, i + 1) for i in range(200)],
        [(0, i) for i in range(1, 300)],
        [(int(a), int(b)) for a, b in np.random.default_rng(3).integers(-50, 400, (300, 2))],
    ],
)
def test_components(spark, edges):
    df = spark.createDataFrame([*edges, *edges[:3]], "u long, v long")
    found = {r.node: r.root for r in components(df).collect()}
    want = {x: r for x, r in grouped(edges).items() if any(x in e and e[0] != e[1] for e in edges)}
    assert found == want


@pytest.mark.parametrize(("small", "block"), [(64, 2048), (2, 16), (10**9, 1)])
def test_crowded_buckets_lose_no_link(spark, small, block):
    rng = np.random.default_rng(1)
    prints = {
        int(f) ^ sum(1 << int(b) for b in rng.choice(62, rng.integers(0, 5), replace=False))
        for f in rng.integers(0, 2**62, 6)
        for _ in range(60)
    }
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.links(df, 4, 3, small, block)
    found = {r.node: r.root for r in components(edges).collect()}
    pairs = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    assert found == grouped(pairs)


def broadcast_subtrees(df):
    """What lies below each broadcast of a plan, as lines."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    depth = [len(re.match(r"[ :+-]*", line).group()) for line in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield lines[i:end]


@pytest.mark.parametrize("small", [64, 2])
def test_exploded_prints_are_not_broadcast(spark, small):
    df = spark.createDataFrame([(i << 40 | j,) for i in range(20) for j in range(20)], "fp long")
    edges = simhash.links(written(df), 4, 3, small, 16)
    assert not [tree for tree in broadcast_subtrees(edges) if "Generate explode" in "".join(tree)]


def test_exploded_blocks_are_not_broadcast(spark):
    docs = spark.createDataFrame([(i, "a b c " * 50, "x") for i in range(20)], "doc_id long, text string, source string")
    pieces = mixing.Mix(docs, slots=64).pieces
    below = ["".join(tree) for tree in broadcast_subtrees(pieces)]
    assert not [tree for tree in below if "copy#" in tree and "Generate explode(sequence(" in tree]


def test_segments_find_every_distance():
    for bits in range(9):
        for parts in (1, 2, 3, 4):
            plan = simhash.segments(bits, parts)
            assert sum(width for _, width, _ in plan) == 64
            assert sum(radius + 1 for *_, radius in plan) == bits + 1


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_sorted_suffixes(letters):
    rng = np.random.default_rng(letters)
    for size in (1, 7, 30):
        data = rng.integers(97, 97 + letters, 900).astype(np.uint8)
        data[300:380] = data[500:580]
        starts = np.arange(len(data) - size + 1)
        bucket = rng.integers(0, 2, len(starts))
        text = data.tobytes()
        counts = Counter((int(k), text[i : i + size]) for i, k in zip(starts, bucket))
        want = [i for i, k in zip(starts, bucket) if counts[int(k), text[i : i + size]] > 1]
        suffixes = Suffixes(data, size)
        assert suffixes.repeated(starts, bucket).tolist() == want
        order = np.argsort(bucket, kind="stable")
        done = suffixes.sorted_within(starts[order], bucket[order])
        for k in (0, 1):
            strings = [text[i : i + size] for i in done[bucket[order] == k]]
            assert strings == sorted(strings)


def test_collided_hashes_are_found_out(monkeypatch):
    data = np.frombuffer(b"abcdefabcdxfabcdef", np.uint8)
    suffixes = Suffixes(data, 6)
    monkeypatch.setattr(suffixes, "extension", lambda a, b: np.full(len(a), 6))
    assert suffixes.repeated(np.array([0, 6, 12]), np.zeros(3, int)).tolist() == [0, 12]


def repeated_texts():
    rng = np.random.default_rng(5)

    def words(n):
        return " ".join(f"w{i}" for i in rng.integers(0, 10**6, n))

    shared, twice = words(120), "ab cd " * 200
    near = words(300).split()
    texts = [f"{words(int(rng.integers(1, 80)))} {shared} {words(20)}" for _ in range(30)]
    for at in range(0, 300, 10):
        texts.append(" ".join([*near[:at], f"other{at}", *near[at + 1 :]]))
    return [*texts, twice, words(20) + twice, shared[:399], shared[:400], "é" * 500, "", words(2000)]


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 1])
def test_repeats_with_hot_passages(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    texts = repeated_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in suffix_dedup.suffix_dedup(docs).collect()}
    found = [
        (rows[i].n_bytes, rows[i].n_removed, rows[i].n_spans, brute.sha(bytes(rows[i].kept_bytes)))
        for i in range(len(texts))
    ]
    assert found == brute.cut_repeats(texts, 400)


def test_long_texts_are_dealt_out_in_stretches(monkeypatch):
    data = np.random.default_rng(0).integers(0, 256, 5000).astype(np.uint8)
    whole = suffix_dedup._hulls(data, 50)
    cores = {}
    for at in range(0, 5000 - 49, 700):
        part = suffix_dedup._hulls(data[at : at + 700 + 49], 50)
        for core, first, last in zip(part[0], part[2], part[3]):
            cores.update({at + s: core for s in range(first, last + 1)})
    assert cores == {s: c for c, a, b in zip(whole[0], whole[2], whole[3]) for s in range(a, b + 1)}


def test_graph_finds_what_a_scan_finds():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(120, 24))
    vectors = np.repeat(centres, 12, axis=0) + rng.normal(scale=0.12, size=(1440, 24))
    vectors = np.vstack([vectors, centres[:1] + rng.normal(scale=0.02, size=(600, 24))])
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    levels = np.sort(np.floor(-np.log(rng.random(len(vectors))) / np.log(16)))[::-1].astype(int)
    graph = hnsw.Graph.build(vectors, levels, 16, 48)
    assert all((layer < len(layer)).all() for layer in graph.layers)
    row, node = graph.links(vectors, 0.98, 48, 64, 0.99)
    close = vectors @ vectors.T >= 0.98
    assert close[row, node].all()
    assert len(np.unique(row * len(vectors) + node)) == len(row) >= 0.99 * close.sum()


def cut_off(vectors, lost):
    """A graph in which no walk reaches the nodes ``lost``."""
    graph = hnsw.Graph.build(vectors, np.zeros(len(vectors), int), 16, 48)
    layer = graph.layers[0]
    layer[np.isin(layer, lost)] = -1
    return graph


def test_audit_sees_past_a_hot_group():
    rng = np.random.default_rng(11)
    hot = rng.normal(size=(1, 24)) + rng.normal(scale=0.01, size=(700, 24))
    pairs = np.repeat(rng.normal(size=(150, 24)), 2, axis=0) + rng.normal(scale=0.02, size=(300, 24))
    vectors = np.vstack([hot, pairs])
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    graph = cut_off(vectors, np.arange(700, 1000))
    row, node = graph.links(vectors, 0.98, 48, 64, 0.99)
    rare = row >= 700
    assert rare.sum() == (vectors[700:] @ vectors.T >= 0.98).sum() >= 600


def test_audit_measures_queries_without_links():
    rng = np.random.default_rng(12)
    vectors = rng.normal(size=(1000, 24))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    queries = rng.normal(size=(1000, 24))
    # two links, of queries that are not audited
    queries[[1, 2]] = vectors[[800, 801]]
    queries /= np.linalg.norm(queries, axis=1)[:, None]
    row, node = cut_off(vectors, np.arange(700, 1000)).links(queries, 0.98, 48, 64, 0.99)
    assert {(1, 800), (2, 801)} <= set(zip(row.tolist(), node.tolist()))


def test_no_query_walks_where_a_look_at_all_costs_less(monkeypatch):
    """Building looks at the nodes before; a beam of 48 meets more than a sixteenth of 1,000 nodes, so only audits walk."""
    rng = np.random.default_rng(13)
    vectors = np.repeat(rng.normal(size=(250, 24)), 4, axis=0) + rng.normal(scale=0.02, size=(1000, 24))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    walked, walk = [], hnsw.Graph._walk
    monkeypatch.setattr(hnsw.Graph, "_walk", lambda self, q, *rest: walked.append(len(q)) or walk(self, q, *rest))
    graph = hnsw.Graph.build(vectors, np.zeros(len(vectors), int), 16, 48)
    assert not walked
    row, node = graph.links(vectors, 0.98, 48, 64, 0.99)
    assert len(row) == (vectors @ vectors.T >= 0.98).sum() and 0 < sum(walked) < 250


def test_shards_see_each_other(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 8))
    vectors = np.repeat(centres, 6, axis=0) + rng.normal(scale=0.05, size=(240, 8))
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = embedding_neardup.embedding_neardup(df, shard=30).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == brute.embedding_links(rows)


def test_seats():
    customers = np.array([0, 1, 2, 50, 10_000, 3_000_000])
    seeds = np.arange(6).astype(np.uint64)
    tables = restaurants.seat(customers, np.full(6, 2.0), 0.6, seeds)
    assert (tables <= customers).all() and (tables >= (customers > 0)).all()
    assert (tables == restaurants.seat(customers, np.full(6, 2.0), 0.6, seeds)).all()
    assert (restaurants.seat(customers, np.zeros(6), 0.6, seeds) == (customers > 0)).all()
    # with two customers the second opens a table as often as the rule says
    many = restaurants.seat(np.full(20_000, 2), np.full(20_000, 0.5), 0.2, np.arange(20_000).astype(np.uint64))
    assert abs((many == 2).mean() - 0.5 / (0.5 + 1 - 0.2)) < 0.02


def zipf_texts(seed, texts, words, most):
    rng = np.random.default_rng(seed)
    return [" ".join(f"v{min(most, int(1 / x))}" for x in rng.random(words) + 1e-9) for _ in range(texts)]


def test_probabilities_of_all_words_sum_to_one(spark):
    texts = [[int(w[1:]) for w in t.split()] + [0] for t in zipf_texts(6, 200, 80, 300)]
    dishes = 302
    cells, before, twice = restaurants.cells_of(
        np.array([d for t in texts for d in t]), np.array([len(t) for t in texts]), 0
    )
    assert before[:81].tolist() == [0, *texts[0][:-1]] and twice[81:83].tolist() == [0, 0]
    part = restaurants.Part(*np.unique(cells, return_counts=True))
    live = restaurants.Live.unpacked(part.live().packed())
    seats = live.start()
    sent = part.fixed(dishes) + live.sent(seats[1], dishes)
    assert sent.sum() == len(part.links)
    root, tables = restaurants.root_of(sent, np.array([0.4, 0.6, 0.8]), int((sent > 0).sum()), 0)
    for number in range(1, 4):
        seats = live.sweep(*seats, root, number)
        sent = part.fixed(dishes) + live.sent(seats[1], dishes)
        root, tables = restaurants.root_of(sent, root.discounts, tables, number)
    # pairs that occur, a pair that does not after a word that does, and a word that never occurs
    for v, u in [*zip(before[:40].tolist(), twice[:40].tolist()), (1, 301), (301, 301)]:
        asked = (v << 32) + (u << 16) + np.arange(dishes)
        assert part.probabilities(asked, [(*seats, root)]).sum() == pytest.approx(1)

    rare = pd.DataFrame({"word": np.arange(40) * 77, "n": np.arange(40) % 5 + 1})
    others = pitman_yor.RareWords(spark.createDataFrame(rare))
    known = (10.0 ** others.words.toPandas()["logp"]).sum()
    assert known + 10.0**others.unseen == pytest.approx(1, abs=1e-6)


def test_scores_are_those_of_a_plain_model(spark):
    """One restaurant after the other in dictionaries, customer by customer."""
    texts = [*zipf_texts(7, 150, 40, 120), "", None, "v1", "v1 v1 v1", "never seen v2"]
    rows = [(i, t, i % 10 != 3 and i < 154) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    want = brute.language_model([(t, train) for _, t, train in rows])
    found = {r.id: r.score for r in pitman_yor.scores(df, df["train"]).collect()}
    assert found == pytest.approx(dict(enumerate(want)), rel=1e-5)


def test_contexts_in_several_parts(spark, monkeypatch):
    """No word fills a part: contexts are dealt out whole, and scores are those of one part."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"v{j}" for j in rng.integers(0, 90, 60)), i % 7 > 0) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    want = {r.id: r.score for r in pitman_yor.scores(df, df["train"]).collect()}
    monkeypatch.setattr(restaurants, "PART", 700)
    assert {r.id: r.score for r in pitman_yor.scores(df, df["train"]).collect()} == pytest.approx(want, rel=1e-5)


def test_hot_contexts_are_one_restaurant_each(spark, monkeypatch):
    """Words that fill several parts, and pairs of two of them, know all their tokens: scores are those of a plain model."""
    texts = [*zipf_texts(17, 150, 40, 120), "v1 v1 v1 v1", "", "never seen v1 v1 v2", *["v1 v2 v1"] * 20]
    rows = [(i, t, i % 10 != 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    want = brute.language_model([(t, train) for _, t, train in rows])
    monkeypatch.setattr(restaurants, "PART", 600)
    found = {r.id: r.score for r in pitman_yor.scores(df, df["train"]).collect()}
    assert found == pytest.approx(dict(enumerate(want)), rel=1e-5)


def test_rare_words_after_hot_ones(spark, monkeypatch):
    """With three dishes of the root, words that are rare are told apart after a hot word as in one part."""
    monkeypatch.setattr(pitman_yor, "DISHES", 3)
    rows = [(i, t, i % 7 > 0) for i, t in enumerate(zipf_texts(18, 120, 40, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    want = {r.id: r.score for r in pitman_yor.scores(df, df["train"]).collect()}
    monkeypatch.setattr(restaurants, "PART", 500)
    assert {r.id: r.score for r in pitman_yor.scores(df, df["train"]).collect()} == pytest.approx(want, rel=1e-5)


def test_hot_contexts_are_spread():
    """A word with a third of all tokens, and a pair of it, are in no part alone."""
    rng = np.random.default_rng(9)
    dishes = np.where(rng.random(60_000) < 0.33, 1, rng.integers(2, 2000, 60_000))
    dishes[20_000:30_000] = 1
    sizes = np.full(600, 100)
    deal = restaurants.Deal(np.bincount(dishes, minlength=2001), 4000)
    cells, before, twice = restaurants.cells_of(dishes, sizes, 0)
    part = deal.of(before, twice, np.repeat(np.arange(600), 100))
    assert part.min() >= 0 and part.max() < deal.parts == 15
    assert np.bincount(part).max() < 2 * 4000
    cold = deal.copies[before] == 1
    assert len(set(zip(before[cold], part[cold]))) == len(set(before[cold]))


def test_contexts_share_what_they_know(spark):
    texts = ["red fox ran home", "red fox sat here", "blue sky is wide", "old fox ran here"] * 20
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(900, "red fox", False), (901, "red sky", False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    found = {r.id: r.score for r in pitman_yor.scores(df, df["train"]).collect()}
    assert found[900] > found[901] + 0.5


def test_words_beyond_the_frequent_ones_are_contexts(spark, monkeypatch):
    """With three dishes of the root, two pairs of rare words are told apart, in one part and in several."""
    monkeypatch.setattr(pitman_yor, "DISHES", 3)
    texts = ["red fox ran home", "red fox sat here", "blue sky is wide", "blue sky is here"] * 20
    texts += [f"home is here w{i}" for i in range(60)]
    asked = ["red fox", "red sky", "blue sky", "blue fox", "red never", "blue never"]
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(900 + i, t, False) for i, t in enumerate(asked)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    found = {r.id: r.score for r in pitman_yor.scores(df, df["train"]).collect()}
    assert found[900] > found[901] + 0.5 and found[902] > found[903] + 0.5
    # an unseen word after a word is a matter of that word's own restaurant
    assert all(np.isfinite(found[i]) and found[i] < found[900] for i in (904, 905))
    monkeypatch.setattr(restaurants, "PART", 250)
    again = {r.id: r.score for r in pitman_yor.scores(df, df["train"]).collect()}
    assert sorted(again) == sorted(found)
    assert again[900] > again[901] + 0.5 and again[902] > again[903] + 0.5


def test_probabilities_with_rare_words_sum_to_one():
    rng = np.random.default_rng(11)
    words = np.sort(restaurants.FIRST_OTHER + rng.integers(0, 1 << 40, 50))
    numbers = np.append(np.concatenate([np.arange(4), words])[np.minimum(53, rng.zipf(1.4, 3000) - 1)], 0)
    before, twice = restaurants.before_of(numbers, np.array([len(numbers)]), 0)
    names = restaurants.Names([words] * 3)
    codes = [np.where(x < 4, x, restaurants.OTHERS + np.searchsorted(words, x)) for x in (before, twice, numbers)]
    cells, n = np.unique(restaurants.joined(*codes, restaurants.WIDE), return_counts=True)
    share = rng.dirichlet(np.ones(50))
    part = restaurants.Part(cells, n, names, share)
    live = part.live()
    live.share = share[np.searchsorted(words, live.names.words[2])]
    live = restaurants.Live.unpacked(live.packed())
    sent = part.fixed(5) + live.sent(live.start()[1], 5)
    assert sent.sum() == len(part.links)
    root, _ = restaurants.root_of(sent, np.array([0.4, 0.6, 0.8]), 5, 0)
    seats = live.sweep(*live.start(), root, 1)
    every = np.concatenate([np.arange(4), restaurants.OTHERS + np.arange(50)])
    for v, u in [(codes[0][i], codes[1][i]) for i in range(1, 200, 9)]:
        p = part.probabilities(restaurants.joined(np.full(54, v), np.full(54, u), every, restaurants.WIDE), [(*seats, root)])
        # nothing is frequent but the first four words, so the root's last dish is spread over the rare ones
        assert p.sum() == pytest.approx(1)


def test_language_model_keeps_ids_and_no_table_it_has_read(spark, monkeypatch):
    """Large ids beside null ones, odd blanks, rare words counted in the parts that hold them, in many stretches."""
    monkeypatch.setattr(pitman_yor, "DISHES", 3)
    monkeypatch.setattr(pitman_yor, "STRETCH", 50)
    texts = ["  a b\x0b\tc ", "", None, "\n", "A\x1cb \u00c4 \u00e4\u0085x", "c d e f g", *(f"a w{i % 7} b" for i in range(30))]
    ids = [2**53 + 2 * i + 1 if i % 5 else None for i in range(len(texts))]
    rows = [(i, t, k % 3 > 0) for k, (i, t) in enumerate(zip(ids, texts))]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").coalesce(1)
    before = len(_written_by(spark))
    found = pitman_yor.scores(df, df["train"]).collect()
    # texts, what is known of rare words, and the last seats; not the counts, the rare words, nor earlier seats
    assert len(_written_by(spark)) - before == 3
    split = [[*(t or "").encode().lower().split(), None] for t in texts]
    counts = Counter(w for own, (_, _, train) in zip(split, rows) if train for w in own)
    whole = np.log10(counts.total() + 0.1 * (len(counts) + 1))
    want = [(i, train, len(own), sum(w in counts for w in own)) for own, (i, _, train) in zip(split, rows)]
    base = [sum(np.log10(counts[w] + 0.1) - whole for w in own) for own in split]

    def key(row):
        return str(row)

    assert sorted(((r.id, r.train, r.n_tokens, r.n_known) for r in found), key=key) == sorted(want, key=key)
    assert sorted(r.base_score for r in found) == pytest.approx(sorted(base), rel=1e-10)


@pytest.mark.parametrize("top", [0, 100, 2**15, 2**31, 2**63 - 1])
def test_packed_columns_come_back(top):
    columns = [np.array([-top - 1, 0, top]), np.empty(0, np.int64), np.arange(5), np.array([top], np.int64)]
    assert [c.tolist() for c in restaurants.unpack(restaurants.pack(*columns))] == [c.tolist() for c in columns]


def test_machine_learns_pairs(spark):
    """Two terms that say nothing alone, among 5,000 neutral ones: toxic is just one of them."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    vocabulary = ["".join(rng.choice(letters, rng.integers(4, 10))) for _ in range(5000)]
    rows = []
    for i in range(5000):
        marks = [m for m in ("insultish", "groupname") if rng.random() < 0.5]
        words = [vocabulary[j] for j in rng.choice(5000, 12, replace=False)] + marks
        rows.append((i, " ".join(rng.permutation(words)), int(len(marks) == 1)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    machine = toxicity.fit(df.select("doc_id", "text"), df.filter("doc_id < 4000").select("doc_id", "toxic"))
    found = toxicity.score(df.filter("doc_id >= 4000"), machine).collect()
    assert sum((r.score > 0.5) == bool(r.toxic) for r in found) > 0.95 * len(found)


def plain_terms(text):
    """Distinct buckets of a text, worked out word by word."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    counts = Counter(t for w in words for t in toxicity.word_terms(w))
    found = {(t + i) % toxicity.BUCKETS for t, n in counts.items() for i in range(5) if n >= 2**i}
    return sorted(found | {toxicity._hashed(f"#{len(words).bit_length()}")})


def test_toxicity_scores_are_those_of_all_pairs(spark):
    """Buckets and scores against a plain version that adds up every pair of buckets."""
    texts = ["you awful awful AWFUL thing", None, "", "12 _ 34", "fine words " * 40, "\u00c4rger \u0130stanbul"]
    texts += ["a fine day at sea", "awful day for you"] * 30
    rows = [(i, t, int("awful" in (t or ""))) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    machine = toxicity.fit(df, df)
    starts, buckets = toxicity.text_buckets(texts, toxicity.Words())
    found = {r.doc_id: r.score for r in toxicity.score(df, machine).collect()}
    for i, text in enumerate(texts):
        own = plain_terms(text)
        assert buckets[starts[i] : starts[i + 1]].tolist() == own
        f = machine.factors[own].astype(float)
        pairs = sum(f[x] @ f[y] for x in range(len(own)) for y in range(x))
        total = machine.bias + machine.linear[own].sum() + pairs / len(own)
        assert abs(found[i] - 1 / (1 + np.exp(-total))) < 1e-9
    assert min(found[i] for i, _, t in rows if t) > max(found[i] for i, _, t in rows if not t)


def test_label_model_finds_who_is_right():
    rng = np.random.default_rng(9)
    truth = np.where(rng.random(5000) < 0.6, 1, -1)
    accuracy, coverage = np.array([0.95, 0.8, 0.7, 0.85]), np.array([0.5, 0.7, 0.9, 0.4])
    right = rng.random((5000, 4)) < accuracy
    votes = np.where(right, truth[:, None], -truth[:, None]) * (rng.random((5000, 4)) < coverage)
    patterns = pd.DataFrame(votes).value_counts()
    model = quality.LabelModel.fit(np.array(patterns.index.tolist()), patterns.to_numpy(float))
    assert np.abs(model.accuracy - accuracy).max() < 0.06
    voted = (votes != 0).any(axis=1)
    guess = model.posterior(votes) > 0.5
    majority = votes.sum(axis=1) > 0
    assert (guess == (truth > 0))[voted].mean() > (majority == (truth > 0))[voted].mean()


def exchanges_below(plan, operator):
    """The keys of the nearest exchange below each occurrence of an operator in a physical plan."""
    found = []
    for part in plan.split(operator)[1:]:
        match = re.search(r"hashpartitioning\(([^)]*)\)", part)
        found.append({re.sub(r"#\d+L?$", "", key.strip()) for key in match.group(1).split(",")[:-1]})
    return found


def test_shards_and_blocks_are_dealt_out_by_all_keys(spark, monkeypatch):
    """At scale joins sort and merge, and a group's shards or blocks must not stay with its key."""
    plans = []
    grouped_frame = type(spark.range(1).groupBy("id"))
    build = grouped_frame.applyInPandas

    def remember(self, *args, **kwargs):
        made = build(self, *args, **kwargs)
        plans.append(made._jdf.queryExecution().executedPlan().toString())
        return made

    monkeypatch.setattr(grouped_frame, "applyInPandas", remember)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, [float(i % 7), 1.0, float(i)], "x") for i in range(60)]
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
        assert embedding_neardup.embedding_neardup(vectors, shard=10).count() == 60
        assert exchanges_below(plans[0], "FlatMapGroupsInPandas")[0] == {"label", "dim", "shard"}
        plans.clear()
        prints = spark.createDataFrame([(i,) for i in range(300)], "fp long")
        simhash.links(prints, 4, 3, 4, 16).count()
        assert exchanges_below(plans[0], "FlatMapGroupsInPandas")[0] == {"seg", "value", "h", "g"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
