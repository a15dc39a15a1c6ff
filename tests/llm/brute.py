"""Plain versions of the operators, row by row and pair by pair."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import xxhash

from seriesloom.llm import pitman_yor, restaurants

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


class Union:
    """Disjoint sets named by their smallest member."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def embedding_links(rows, least=0.98):
    """{id: (links, component)} of (id, vector, label)."""

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        size = math.sqrt(math.fsum(x * x for x in v))
        return [x / size for x in v]

    units = [(i, unit(v), label) for i, v, label in rows]
    links, groups = Counter(), Union()
    for a, (i, u, x) in enumerate(units):
        groups.find(i)
        for j, v, y in units[:a]:
            if u and v and x is not None and x == y and len(u) == len(v):
                if sum(p * q for p, q in zip(u, v)) >= least:
                    links[i] += 1
                    links[j] += 1
                    groups.join(i, j)
    return {i: (links[i], groups.find(i)) for i, _, _ in rows}


def cut_repeats(texts, size):
    """(bytes, removed, runs, sha256 of the rest) of each text."""
    whole = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + size] for b in whole for i in range(len(b) - size + 1))
    found = []
    for b in whole:
        gone = [False] * len(b)
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = [True] * size
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(x for x, g in zip(b, gone) if not g)
        found.append((len(b), sum(gone), runs, sha(rest)))
    return found


def simhash(text, shingle=4, seed=42):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return 0
    runs = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows, max_bits=4):
    """{id: (fingerprint, component)} of (id, text)."""
    prints = [(i, simhash(t)) for i, t in rows]
    groups = Union()
    for a, (i, x) in enumerate(prints):
        groups.find(i)
        for j, y in prints[:a]:
            if (x ^ y).bit_count() <= max_bits:
                groups.join(i, j)
    return {i: (f"{x:016x}", groups.find(i)) for i, x in prints}


def line_key(line):
    return line.strip(BLANKS).translate(LOWER)


def line_dedup(rows, min_chars=40, min_docs=5):
    """{id: (lines, dropped, text left)} of (id, text)."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= min_chars:
                holders[line_key(line)].add(i)
    shared = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    found = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if shared.get(line_key(x), i) == i]
        found[i] = (len(lines), len(lines) - len(left), "\n".join(left))
    return found


def contamination(rows, items, window=10):
    """{id: (words, hit, items found)} of (id, text)."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(text):
        return word.findall((text or "").translate(LOWER))

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for s in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[s : s + size])].add(item)
    sizes = {len(w) for w in windows}
    found = {}
    for i, text in rows:
        w = words(text)
        hit, those = set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                if tuple(w[s : s + size]) in windows:
                    hit.update(range(s, s + size))
                    those |= windows[tuple(w[s : s + size])]
        found[i] = (len(w), len(hit), sorted(str(x) for x in those if x is not None))
    return found


def mix(rows):
    """{id: (size, source size, target, taken)} of (id, text, source)."""
    sizes = {i: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t, _ in rows}
    total = Counter()
    for i, _, source in rows:
        total[source] += sizes[i]
    ranked = sorted(total, key=lambda s: (s is None, s.encode() if s else b""))
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(ranked)}
    capped, unit = set(), 0.0
    while len(capped) < len(ranked):
        left = 1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)
        unit = left / sum(weight[s] for s in ranked if s not in capped)
        above = {s for s in ranked if weight[s] * unit > 2 * total[s]}
        if above == capped:
            break
        capped = above
    target = {s: min(weight[s] * unit, 2.0 * total[s]) for s in ranked}
    found = {}
    for s in ranked:
        own = [i for i, _, source in rows if source == s]
        own.sort(key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), sizes[i]))
        quota, before = math.floor(target[s]), 0
        for i in own:
            taken = 0
            for start in (before, total[s] + before):
                taken += max(0, min(start + sizes[i], quota) - start)
            found[i] = (sizes[i], total[s], target[s], taken)
            before += sizes[i]
    return found


def profile(texts, size):
    """Most frequent letter 1- to 3-grams of words, each word between two blanks."""
    counts = Counter()
    for text in texts:
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        line = " " + " ".join(words) + " "
        if words:
            counts.update(c for c in line if c != " ")
            counts.update(line[i : i + 2] for i in range(len(line) - 1))
            counts.update(line[i : i + 3] for i in range(len(line) - 2) if line[i + 1] != " ")
    # ties by code points, shorter ones first
    packed = {g: sum(ord(c) << 21 * n for n, c in enumerate(reversed(g))) for g in counts}
    return [g for g, _ in sorted(counts.items(), key=lambda c: (-c[1], packed[c[0]]))][:size]


def language(text, profiles, size):
    """(language, score) of the nearest profile."""
    own = profile([text], size)
    if not own or not profiles:
        return "und", 0.0

    def far(lang):
        rank = {g: n for n, g in enumerate(profiles[lang])}
        return sum(abs(rank[g] - n) if g in rank else size for n, g in enumerate(own))

    best = min(sorted(profiles), key=far)
    return best, 1 - far(best) / (size * len(own))


def importance(rows, target, grams=(1, 1), buckets=10000, min_words=20, percent=10):
    """(id, features, weight, score, rank) of (id, text), in the same order."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        w = word.findall((text or "").translate(LOWER))
        runs = [" ".join(w[i : i + n]) for n in range(grams[0], grams[1] + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(r.encode()) % buckets for r in runs]

    own = [features(text) for _, text in rows]
    s = Counter(b for _, f in own for b in f)
    t = Counter(b for text in target for b in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))

    found = []
    for (i, _), (n_words, f) in zip(rows, own):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(sha(f"2024:{'' if i is None else i}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([i, len(f), weight, score, None, n_words])
    drawn = sorted((r for r in found if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(drawn[: percent * len(drawn) // 100]):
        row[4] = rank + 1
    return [tuple(r[:5]) for r in found]


def audit(rows, filters, losses):
    """{(part, order, step): (kept, removed, redundant, unique, *losses, shapley)} of (id, part, failed filters)."""
    found, sums = {}, Counter()
    for part in {p for _, p, _ in rows}:
        own = [(i, failed) for i, p, failed in rows if p == part]
        for order in permutations(filters):
            for n, f in enumerate(order):
                left = [r for r in own if not set(order[:n]) & r[1]]
                removed = [r for r in left if f in r[1]]
                failing = [r for r in own if f in r[1]]
                found[part, "".join(order), n + 1] = [
                    len(left) - len(removed),
                    len(removed),
                    len(failing) - len(removed),
                    sum(r[1] == {f} for r in failing),
                    *[sum(r[0] in ids for r in removed) for ids in losses],
                ]
                sums[part, f] += len(removed)
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def text_failures(rows):
    """The failed filters of (id, text), in the same order."""
    first = {}
    for i, text in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    found = []
    for i, text in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > first[text],
        }
        found.append({name for name, fails in failed.items() if fails})
    return found


def weak_votes(text):
    """1 good, 0 abstain, -1 bad of each labeller of texts, worked out character by character."""
    words = (text or "").split()
    marks = [c for c in text or "" if not c.isspace()]
    letters = [c for c in marks if c.isalpha()]
    signs = [c for c in marks if not (c.isalpha() or c.isdigit() or c in ".,;:'\"-()?")]
    twice = sum(a == b for a, b in zip(words, words[1:]))
    plain = sum(w.isalpha() or (w[-1] in ".,;:?!" and w[:-1].isalpha()) for w in words)
    long = len(words) if len(words) >= 10 else 0

    def vote(part, whole, bad, good):
        return 0 if not whole else -1 if bad(part / whole) else int(good(part / whole))

    def never(share):
        return False

    return (
        vote(plain - twice, len(words), lambda x: x < 0.5, lambda x: x > 0.85),
        vote(sum(w[-1] in ".!?" for w in words), long, lambda x: not 0.02 <= x <= 0.5, lambda x: 0.04 <= x <= 0.2),
        vote(len(set(words)), long, lambda x: x < 0.3, lambda x: x > 0.55),
        vote(len(marks), len(words), lambda x: not 3 <= x <= 7, lambda x: 4 <= x <= 6),
        vote(sum(w[0].islower() for w in words), long, lambda x: x < 0.4, lambda x: 0.7 <= x <= 0.97),
        vote(sum(w[-1] == "," for w in words), long, never, lambda x: 0.02 <= x <= 0.15),
        vote(len(signs), len(marks), lambda x: x > 0.08, never),
        vote(sum(c.isupper() for c in letters), len(letters), lambda x: x > 0.4, never),
        vote(twice, max(0, len(words) - 1), lambda x: x > 0.15, never),
        vote(sum(len(w) == 1 and not w.isalnum() for w in words), len(words), lambda x: x > 0.1, never),
        vote((text or "").count("!"), len(words), lambda x: x > 0.2, never),
    )


def weak_labels(votes, rounds=200):
    """(probability that each text is good, accuracy of each labeller), text by text."""
    n, labellers = len(votes), range(len(votes[0]))
    share = [{v: sum(row[j] == v for row in votes) / n for v in (-1, 0, 1)} for j in labellers]
    lean = {0: {-1: 1.7, 0: 1.0, 1: 0.3}, 1: {-1: 0.3, 0: 1.0, 1: 1.7}}
    first = {c: [{v: share[j][v] * lean[c][v] + 1e-9 for v in (-1, 0, 1)} for j in labellers] for c in (0, 1)}

    def rates(seen):
        return {c: [{v: s[v] / sum(s.values()) for v in s} for s in seen[c]] for c in (0, 1)}

    def posterior():
        found = []
        for row in votes:
            odds = math.log(good / (1 - good))
            odds += sum(math.log(now[1][j][v] / now[0][j][v]) for j, v in enumerate(row) if v)
            found.append(1 / (1 + math.exp(-max(-30, min(30, odds)))))
        return found

    good, now = 0.5, rates(first)
    for _ in range(rounds):
        p = posterior()
        seen = {c: [{v: 10 * first[c][j][v] for v in (-1, 0, 1)} for j in labellers] for c in (0, 1)}
        for row, x in zip(votes, p):
            for j, v in enumerate(row):
                seen[1][j][v] += x
                seen[0][j][v] += 1 - x
        good, before, now = (sum(p) + 5) / (n + 10), now, rates(seen)
        if max(abs(now[c][j][v] - before[c][j][v]) for c in (0, 1) for j in labellers for v in (-1, 0, 1)) < 1e-9:
            break
    right = [seen[0][j][-1] + seen[1][j][1] for j in labellers]
    wrong = [seen[1][j][-1] + seen[0][j][1] for j in labellers]
    return posterior(), [a / (a + b) for a, b in zip(right, wrong)]


def language_model(docs):
    """log10 probability of each (text, train): every restaurant a dictionary, seated customer by customer.

    Draws come from the operator's generator, so that seatings can be compared. No word is rare.
    """
    end = "<end>"
    texts = [((t or "").lower().split() + [end], train) for t, train in docs]
    counts = Counter(w for ws, train in texts if train for w in ws)
    number = {w: pitman_yor.END if w == end else pitman_yor.word_hash(w.encode()) for w in counts}
    dish = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (-counts[w], number[w])))}
    size = len(dish) + 1

    def cells(words):
        ids = [dish.get(w, size - 1) for w in words]
        padded = [dish[end], dish[end], *ids]
        return [(padded[i + 1], padded[i], w) for i, w in enumerate(ids)]

    def seat(customers, mass, d, cell, depth, sweep):
        seed = restaurants.seeds(np.array([cell]), depth, sweep)
        tables = seated = 1
        while seated < customers:
            group = 1 if seated < restaurants.ONE_BY_ONE else seated // 8
            group_size = min(group, customers - seated)
            chance = mass / (mass + seated - d * tables)
            opened = int(group_size * chance + restaurants.uniform(seed, seated)[0])
            tables = min(tables + opened, seated + group_size)
            seated += group
        return tables

    n = Counter(c for ws, train in texts if train for c in cells(ws))
    t2, t1 = dict.fromkeys(n, 1), {(v, w): 1 for v, _, w in n}

    def below(tables):
        found = Counter()
        for (v, _, w), t in tables.items():
            found[v, w] += t
        return found

    def sent():
        found = Counter()
        for (_, w), t in t1.items():
            found[w] += t
        return found

    def rate(found):
        few = Counter(found.values())
        return min(0.95, max(0.1, few[1] / (few[1] + 2 * few[2]))) if few[1] else 0.5

    d0, d1, d2 = rate(sent()), rate(below(t2)), rate(n)

    def root(before, sweep):
        c0 = sent()
        t0 = {w: seat(c, (1 + d0 * before) / size, d0, w, 0, sweep) for w, c in c0.items()}
        tables = sum(t0.values())
        rest = (1 + d0 * tables) / size
        total = 1 + sum(c0.values())
        return [(c0[w] - d0 * t0.get(w, 0) + rest) / total for w in range(size)], tables

    def model(p0):
        c1 = below(t2)
        room = {}
        for (v, w), c in c1.items():
            a, b = room.get((v,), (0, 0))
            room[v,] = a + c, b + t1[v, w]
        for (v, u, w), c in n.items():
            a, b = room.get((v, u), (0, 0))
            room[v, u] = a + c, b + t2[v, u, w]

        def one(v, w):
            customers, tables = room.get((v,), (0, 0))
            return (c1[v, w] - d1 * t1.get((v, w), 0) + (1 + d1 * tables) * p0[w]) / (1 + customers)

        def two(v, u, w):
            customers, tables = room.get((v, u), (0, 0))
            own = n.get((v, u, w), 0) - d2 * t2.get((v, u, w), 0)
            return (own + (1 + d2 * tables) * one(v, w)) / (1 + customers)

        return room, one, two

    p0, tables = root(len(sent()), 0)
    mean = Counter()
    asked = {c for ws, _ in texts for c in cells(ws)}
    for sweep in range(1, pitman_yor.BURN_IN + pitman_yor.SAMPLES + 1):
        room, one, _ = model(p0)
        mass2 = {(v, u, w): (1 + d2 * room[v, u][1]) * one(v, w) for v, u, w in n}
        mass1 = {(v, w): (1 + d1 * room[v,][1]) * p0[w] for v, w in t1}
        t2 = {c: seat(k, mass2[c], d2, (c[0] << 32) + (c[1] << 16) + c[2], 2, sweep) for c, k in n.items()}
        t1 = {c: seat(k, mass1[c], d1, (c[0] << 16) + c[1], 1, sweep) for c, k in below(t2).items()}
        p0, tables = root(tables, sweep)
        if sweep > pitman_yor.BURN_IN:
            two = model(p0)[2]
            for c in asked:
                mean[c] += two(*c) / pitman_yor.SAMPLES
    return [sum(math.log10(mean[c]) for c in cells(ws)) for ws, _ in texts]
