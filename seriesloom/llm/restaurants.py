"""Restaurants of all seen contexts of two words and of one, dealt out in parts.

A part holds the restaurants of some words and of all pairs that end in them, so
everything but the restaurant without context is sampled inside it. A word with
more tokens than fit a part, a hot one, is dealt out to several parts with its
pairs whole, except pairs of two such words, which are dealt out by document as
well. Restaurants of hot words and of pairs of two of them are still one each:
they lie in halls, by their link, to which parts send their customers after each
sweep, and which say how many customers and tables there are (``Hall``). What
parts and halls say of the root, the customers they send there, is summed after
each sweep, and so are the totals of the hot words and of their pairs.

Inside a part words have small codes: a frequent word its place among the
frequent ones, every other word a place in a list of the part's own (``Names``).

A customer who is alone at a dish has one table whatever is drawn. Such cells
are only counted; the cells of two customers and more, the live ones, are
seated by sweeps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard

# Tokens of one part.
PART = 1 << 20
STRENGTH = 1.0
# Customers beyond this number are seated in groups of an eighth of those seated.
ONE_BY_ONE = 32
# Bits of a dish; a cell is a number of three dishes: word, the word before it, the dish.
BITS = 16
LOW = (1 << BITS) - 1
# Bits of a code where words beyond the frequent ones have codes too, and the first of those.
WIDE = 21
OTHERS = 1 << BITS
# Numbers of words beyond the frequent ones, from their hashes, begin here.
FIRST_OTHER = 1 << 62


def pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, each in as few bytes as it needs, bytes of equal weight side by side, compressed."""
    widths = [_width(c) for c in columns]
    sizes = np.array([len(columns), *map(len, columns), *widths], np.int64)
    narrow = (c.astype(f"i{w}").view(np.uint8).reshape(-1, w) for c, w in zip(columns, widths))
    return zstandard.ZstdCompressor(level=1).compress(b"".join([sizes.tobytes(), *(c.T.tobytes() for c in narrow)]))


def _width(column: np.ndarray) -> int:
    bits = max(int(column.max(initial=0)).bit_length(), (~int(column.min(initial=0))).bit_length()) + 1
    return next(w for w in (1, 2, 4, 8) if bits <= 8 * w)


def unpack(blob: bytes) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    count = int(data[:8].view(np.int64)[0])
    sizes = data[8 : 8 + 16 * count].view(np.int64).tolist()
    at, found = 8 + 16 * count, []
    for size, width in zip(sizes[:count], sizes[count:]):
        planes = data[at : at + width * size].reshape(width, size)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"i{width}").astype(np.int64))
        at += width * size
    return found


def uniform(seed: np.ndarray, step: int) -> np.ndarray:
    """A number in [0, 1) for each seed and step, the same whenever it is asked for."""
    x = seed + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / 2.0**53


def seat(customers: np.ndarray, mass: np.ndarray, discount: float, seed: np.ndarray) -> np.ndarray:
    """Tables of each dish, its customers seated anew one after the other.

    ``mass`` is the weight of a new table: (strength + discount * tables) times
    the parent's probability of the dish.
    """
    tables = (customers > 0).astype(np.int64)
    seated = 1
    left = np.flatnonzero(customers > 1)
    while len(left):
        group = 1 if seated < ONE_BY_ONE else seated // 8
        size = np.minimum(group, customers[left] - seated)
        chance = mass[left] / (mass[left] + seated - discount * tables[left])
        tables[left] += np.floor(size * chance + uniform(seed[left], seated)).astype(np.int64)
        tables[left] = np.minimum(tables[left], seated + size)
        seated += group
        left = left[customers[left] > seated]
    return tables


def seeds(cells: np.ndarray, depth: int, number: int) -> np.ndarray:
    """A seed for each cell of a depth in a sweep."""
    return (cells.astype(np.uint64) * np.uint64(256) + np.uint64(64 * depth + number)) * np.uint64(0xD1342543DE82EF95)


def discount(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


class Deal:
    """The part of each token, by the word before it; ``counts`` are tokens per frequent word.

    ``total`` counts those of all words. Words without a count are dealt out whole by their number.
    """

    def __init__(self, counts: np.ndarray, size: int, total: int | None = None):
        self.parts = max(1, -(-int(counts.sum() if total is None else total) // size))
        self.copies = np.clip(-(-counts // max(1, size // 4)), 1, self.parts)
        self.first = self._first(np.arange(len(counts)))
        self.hot = self.copies > 1

    def _first(self, words: np.ndarray) -> np.ndarray:
        return np.floor(uniform(words.astype(np.uint64), 1) * self.parts).astype(np.int64)

    def _hot(self, words: np.ndarray) -> np.ndarray:
        return among(words, self.hot)

    def of(self, before: np.ndarray, twice: np.ndarray, rows: np.ndarray) -> np.ndarray:
        part = np.empty(len(before), np.int64)
        counted = before < len(self.first)
        part[counted] = self.first[before[counted]]
        part[~counted] = self._first(before[~counted])
        hot = np.flatnonzero(self._hot(before))
        u = twice[hot]
        seed = u.astype(np.uint64) << np.uint64(40)
        seed += np.where(self._hot(u), rows[hot], -1).astype(np.uint64)
        part[hot] += np.floor(uniform(seed, 2) * self.copies[before[hot]]).astype(np.int64)
        return part % self.parts


def among(codes: np.ndarray, hot: np.ndarray | None) -> np.ndarray:
    """Which of the codes are words that ``hot`` marks."""
    found = np.zeros(len(codes), bool)
    if hot is not None:
        known = np.flatnonzero(codes < len(hot))
        found[known] = hot[codes[known]]
    return found


def before_of(dishes: np.ndarray, sizes: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """Of the tokens of texts side by side, each with its end: the words before them, the words before those."""
    before = np.empty_like(dishes)
    before[:1], before[1:] = end, dishes[:-1]
    twice = np.empty_like(dishes)
    twice[:1], twice[1:] = end, before[:-1]
    twice[np.cumsum(sizes)[:-1]] = end
    return before, twice


def joined(before: np.ndarray, twice: np.ndarray, dishes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells of codes of three words."""
    return (before << 2 * bits) | (twice << bits) | dishes


def parted(cells: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = (1 << bits) - 1
    return cells >> 2 * bits, cells >> bits & low, cells & low


def columns_of(cells: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending cells as three columns that pack well; :func:`from_columns` is the way back."""
    before, twice, dishes = parted(cells, bits)
    step, rise = np.diff(before, prepend=0), np.diff(twice, prepend=0)
    rise[:1] = twice[:1]
    rise[step > 0] = twice[step > 0]
    return step, rise, dishes


def from_columns(step: np.ndarray, rise: np.ndarray, dishes: np.ndarray, bits: int = BITS) -> np.ndarray:
    new = step > 0
    new[:1] = True
    total, first = np.cumsum(rise), np.flatnonzero(new)
    below = (total - rise)[first]
    return joined(np.cumsum(step), total - below[np.cumsum(new) - 1], dishes, bits)


def cells_of(dishes: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the tokens of texts side by side, each with its end: cells, words before them, words before those."""
    before, twice = before_of(dishes, sizes, end)
    return joined(before, twice, dishes), before, twice


class Names:
    """Numbers of words that are not frequent, ascending, for each of the three places of a cell.

    The code of a frequent word is its number, that of another ``OTHERS`` and its place here.
    """

    def __init__(self, words: list[np.ndarray]):
        self.words = words

    def checked(self) -> Names:
        """These names, if cells have room for them; a part of ``PART`` tokens has."""
        if max(map(len, self.words)) > (1 << WIDE) - OTHERS:
            raise ValueError("a part holds too many different words; make restaurants.PART smaller")
        return self

    def numbers(self, codes: np.ndarray, place: int) -> np.ndarray:
        found = codes.astype(np.int64)
        other = codes >= OTHERS
        found[other] = self.words[place][codes[other] - OTHERS]
        return found

    def narrowed(self, codes: list[np.ndarray]) -> tuple[list[np.ndarray], Names]:
        """The codes where only the words among them have names, and those names."""
        found, words = [], []
        for own, names in zip(codes, self.words):
            other = np.flatnonzero(own >= OTHERS)
            used, at = _used(own[other] - OTHERS, len(names))
            own = own.copy()
            own[other] = OTHERS + at
            found.append(own)
            words.append(names[used])
        return found, Names(words).checked()

    def packed(self) -> list[np.ndarray]:
        return [np.diff(w, prepend=0) for w in self.words]

    @classmethod
    def unpacked(cls, columns: list[np.ndarray]) -> Names:
        return cls([np.cumsum(c) for c in columns])


def merged(blobs: list[tuple[np.ndarray, Names]]) -> tuple[np.ndarray, Names]:
    """Cells of several tables of names, one after the other, by the names of all; empties the list."""
    names = Names([np.unique(np.concatenate([n.words[place] for _, n in blobs])) for place in range(3)]).checked()
    found, end = np.empty(sum(len(cells) for cells, _ in blobs), np.int64), 0
    blobs.reverse()
    while blobs:
        cells, own = blobs.pop()
        codes = list(parted(cells, WIDE))
        for place in range(3):
            other = codes[place] >= OTHERS
            at = np.searchsorted(names.words[place], own.words[place])
            codes[place][other] = OTHERS + at[codes[place][other] - OTHERS]
        found[end : end + len(cells)] = joined(*codes, WIDE)
        end += len(cells)
    return found, names


def _used(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places below ``size``, ascending, and which of them each is."""
    if size > 64 * len(places):
        return np.unique(places, return_inverse=True)
    marked = np.zeros(size, bool)
    marked[places] = True
    used = np.flatnonzero(marked)
    which = np.empty(size, np.int64)
    which[used] = np.arange(len(used))
    return used, which[places]


@dataclass
class Hot:
    """Customers and tables of all restaurants of hot words, by word, and of pairs of two, by ``pair_key``, ascending."""

    word_c: np.ndarray
    word_t: np.ndarray
    pairs: np.ndarray
    pair_c: np.ndarray
    pair_t: np.ndarray

    def of_pairs(self, before: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        customers, tables = np.zeros(len(before), np.int64), np.zeros(len(before), np.int64)
        hit, at = _found(pair_key(before, twice), self.pairs)
        customers[hit], tables[hit] = self.pair_c[at], self.pair_t[at]
        return customers, tables


def pair_key(before: np.ndarray, twice: np.ndarray) -> np.ndarray:
    return (before << BITS) | twice


@dataclass
class Root:
    """What the restaurant without context says of each dish, the discounts of all depths, and totals of hot words."""

    p: np.ndarray
    discounts: np.ndarray
    hot: Hot | None = None

    def of(self, dish: np.ndarray, share: np.ndarray | None) -> np.ndarray:
        """Probabilities of dishes; those that are not frequent have a ``share`` each of the last."""
        p = self.p[np.minimum(dish, len(self.p) - 1)]
        if share is not None:
            other = dish >= OTHERS
            p[other] *= share[dish[other] - OTHERS]
        return p


def root_of(customers: np.ndarray, discounts: np.ndarray, before: int, number: int) -> tuple[Root, int]:
    """The root's customers seated anew; ``before`` is its number of tables in the sweep before."""
    d, base = discounts[0], 1 / len(customers)
    cells = np.arange(len(customers))
    tables = seat(customers, np.full(len(customers), (STRENGTH + d * before) * base), d, seeds(cells, 0, number))
    new = (STRENGTH + d * tables.sum()) * base
    return Root((customers - d * tables + new) / (STRENGTH + customers.sum()), discounts), int(tables.sum())


class Live:
    """Cells of a part with several customers, and what all others add to their restaurants.

    Of pairs (depth 2) the cells with ``n2`` customers; of links, that is a word
    and a dish after it (depth 1), ``alone`` customers from pairs that serve it
    once; of pairs and words the tables of cells that are not live. Links of
    ``hot`` words are guests: halls know their customers and seat them.
    """

    def __init__(self, cells, n2, links, alone, pair_fixed, word_fixed, names=None, share=None, hot=None):
        self.cells, self.n2, self.links, self.alone = cells, n2, links, alone
        self.pair_fixed, self.word_fixed = pair_fixed, word_fixed
        self.names, self.share, bits = names, share, WIDE if names else BITS
        self.pair = _runs(cells >> bits)[1]
        words, self.word = _runs(links >> bits)
        host = among(words, hot)
        self.guest, self.hosts, self.host_words = host[self.word], np.flatnonzero(host), words[host]
        self.up = np.searchsorted(links, links_of(cells, bits))
        self.dish = links & ((1 << bits) - 1)

    def packed(self) -> bytes:
        cells, links = columns_of(self.cells, WIDE if self.names else BITS), np.diff(self.links, prepend=0)
        named = [*self.names.packed(), *([] if self.share is None else [self.share.view(np.int64)])] if self.names else []
        return pack(*cells, self.n2, links, self.alone, self.pair_fixed, self.word_fixed, *named)

    @classmethod
    def unpacked(cls, blob: bytes, hot: np.ndarray | None = None) -> Live:
        step, rise, dishes, n2, links, alone, pair_fixed, word_fixed, *named = unpack(blob)
        cells = from_columns(step, rise, dishes, WIDE if named else BITS)
        names = Names.unpacked(named[:3]) if named else None
        share = named[3].view(np.float64) if len(named) > 3 else None
        return cls(cells, n2, np.cumsum(links), alone, pair_fixed, word_fixed, names, share, hot)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """What the draws of cells and of links go by, the same in whatever part they lie."""
        if self.names is None:
            return self.cells, self.links
        number, low = self.names.numbers, (1 << WIDE) - 1
        v, u, w = (number(codes, place) for place, codes in enumerate(parted(self.cells, WIDE)))
        link = (number(self.links >> WIDE, 0) << BITS) + number(self.links & low, 2)
        return (v << 2 * BITS) + (u << BITS) + w, link

    def start(self) -> tuple[np.ndarray, np.ndarray]:
        """One table for each cell, none for guests."""
        return np.ones(len(self.n2), np.int64), (~self.guest).astype(np.int64)

    def customers(self, t2: np.ndarray) -> np.ndarray:
        """Customers of the links: one for each table of a pair that serves them."""
        return self.alone + np.bincount(self.up, t2, len(self.links)).astype(np.int64)

    def totals(self, t2: np.ndarray, t1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tables of the pairs; customers and tables of the words."""
        c1 = self.customers(t2)
        return (
            self.pair_fixed + np.bincount(self.pair, t2, len(self.pair_fixed)),
            self.word_fixed + np.bincount(self.word, c1, len(self.word_fixed)),
            self.word_fixed + np.bincount(self.word, t1, len(self.word_fixed)),
        )

    def sweep(
        self, t2: np.ndarray, t1: np.ndarray, root: Root, number: int, heard: tuple | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Seats all customers anew, pairs first; ``heard`` are customers and tables of the guests, whose tables here are 0."""
        _, d1, d2 = root.discounts
        pair_t, word_c, word_t = self.totals(t2, t1)
        c1 = self.customers(t2)
        if heard:
            t1 = t1.copy()
            c1[self.guest], t1[self.guest] = heard
            word_c[self.hosts], word_t[self.hosts] = root.hot.word_c[self.host_words], root.hot.word_t[self.host_words]
        cell_keys, link_keys = self.keys()
        new = (STRENGTH + d1 * word_t[self.word]) * root.of(self.dish, self.share)
        p1 = (c1 - d1 * t1 + new) / (STRENGTH + word_c[self.word])
        mass = (STRENGTH + d2 * pair_t[self.pair]) * p1[self.up]
        t2 = seat(self.n2, mass, d2, seeds(cell_keys, 2, number))
        t1 = seat(self.customers(t2), new, d1, seeds(link_keys, 1, number))
        t1[self.guest] = 0
        return t2, t1

    def told(self, t2: np.ndarray) -> np.ndarray:
        """Customers that live cells send to each guest."""
        return np.bincount(self.up, t2, len(self.links)).astype(np.int64)[self.guest]

    def sent(self, t1: np.ndarray, dishes: int) -> np.ndarray:
        """Customers that live links send to the root, those of all words that are not frequent to its last dish."""
        return np.bincount(np.minimum(self.dish, dishes - 1), t1, dishes).astype(np.int64)


class Part:
    """All cells of a part: distinct, ascending, with their customers.

    ``names`` are those of the words that are not frequent, ``share`` what the
    restaurant of these words says of each dish among them. Cells after pairs of
    two ``hot`` words are no part's; links of a hot word are guests.
    """

    def __init__(
        self,
        cells: np.ndarray,
        n: np.ndarray,
        names: Names | None = None,
        share: np.ndarray | None = None,
        hot: np.ndarray | None = None,
    ):
        self.cells, self.n = cells, n
        self.names, self.share, self.bits = names, share, WIDE if names else BITS
        self.pairs, self.pair = _runs(cells >> self.bits)
        self.links, self.up = np.unique(links_of(cells, self.bits), return_inverse=True)
        self.words, self.word = _runs(self.links >> self.bits)
        self.pair_n = np.bincount(self.pair, n, len(self.pairs)).astype(np.int64)
        self.many = n > 1
        self.served = np.bincount(self.up, minlength=len(self.links))
        several = np.bincount(self.up, self.many, len(self.links)) > 0
        self.hot, self.guest = hot, among(self.words, hot)[self.word]
        self.link_live = several | ((self.served > 1) & ~self.guest)

    def live(self) -> Live:
        many, links = self.many, self.link_live
        pairs, words = np.unique(self.pair[many]), np.unique(self.word[links])
        alone = np.bincount(self.up, ~many, len(self.links))[links]
        pair_fixed = np.bincount(self.pair, ~many, len(self.pairs))[pairs]
        word_fixed = np.bincount(self.word, ~links, len(self.words))[words]
        others = (x.astype(np.int64) for x in (alone, pair_fixed, word_fixed))
        cells, live_links, names = self.cells[many], self.links[links], self.names
        if names:
            low = (1 << WIDE) - 1
            up = np.searchsorted(live_links, links_of(cells, WIDE))
            codes = [live_links >> WIDE, cells >> WIDE & low, live_links & low]
            (v, u, w), names = names.narrowed(codes)
            cells, live_links = joined(v[up], u, w[up], WIDE), (v << WIDE) | w
        return Live(cells, self.n[many], live_links, *others, names, hot=self.hot)

    def fixed(self, dishes: int) -> np.ndarray:
        """Customers that all other links send to the root, one each."""
        dish = self.links[~self.link_live & ~self.guest] & ((1 << self.bits) - 1)
        return np.bincount(np.minimum(dish, dishes - 1), minlength=dishes)

    def few(self) -> np.ndarray:
        """Cells with one customer and with two, of links and of pairs."""
        return np.array([(x == k).sum() for x in (self.served[~self.guest], self.n) for k in (1, 2)], np.int64)

    def probabilities(
        self, asked: np.ndarray, samples: list[tuple[np.ndarray, np.ndarray, Root]], heard: list | None = None
    ) -> np.ndarray:
        """Of the dish of each asked cell after its two words, averaged over samples of tables and roots.

        Contexts never seen say what their parent does. Asked cells are distinct and ascending.
        ``heard`` are customers and tables, by sample, of all asked links that are guests.
        """
        bits = self.bits
        link, up = np.unique(links_of(asked, bits), return_inverse=True)
        room1, served1 = _found(link >> bits, self.words), _found(link, self.links)
        room2, served2 = _found(asked >> bits, self.pairs), _found(asked, self.cells)
        mean = np.zeros(len(asked))
        guest = np.flatnonzero(among(link >> bits, self.hot))
        for number, (t2, t1, root) in enumerate(samples):
            _, d1, d2 = root.discounts
            all2, all1 = np.ones(len(self.cells), np.int64), np.ones(len(self.links), np.int64)
            all2[self.many], all1[self.link_live] = t2, t1
            c1 = np.bincount(self.up, all2, len(self.links))
            word_c = np.bincount(self.word, c1, len(self.words))
            word_t = np.bincount(self.word, all1, len(self.words))
            pair_t = np.bincount(self.pair, all2, len(self.pairs))
            p0 = root.of(link & ((1 << bits) - 1), self.share)
            own = p0[guest]
            p1 = _predicted(p0, d1, room1, served1, c1 - d1 * all1, word_c, word_t)
            if heard:
                p1[guest] = _after_hot(link[guest] >> bits, own, *heard[number], root)
            mean += _predicted(p1[up], d2, room2, served2, self.n - d2 * all2, self.pair_n, pair_t)
        return mean / len(samples)


def _after_hot(v: np.ndarray, p: np.ndarray, customers: np.ndarray, tables: np.ndarray, root: Root) -> np.ndarray:
    """Probabilities after hot words of dishes with these customers and tables; the root says ``p`` of them."""
    d = root.discounts[1]
    return (customers - d * tables + (STRENGTH + d * root.hot.word_t[v]) * p) / (STRENGTH + root.hot.word_c[v])


def hall_of(v: np.ndarray, w: np.ndarray, halls: int) -> np.ndarray:
    """The hall of the link of a hot word and the number of a dish."""
    return np.floor(uniform(((v << BITS) + w).view(np.uint64), 3) * halls).astype(np.int64)


class Hall:
    """Whole restaurants of hot words and of pairs of two, of the links that are dealt to a hall.

    Links are distinct (v, w), ascending, w the number of any word; ``share`` is
    what the restaurant of rare words says of w, 1 for frequent ones. ``alone``
    customers come from cells of parts that have one customer. Cells are those
    after two hot words (link, u), with ``n`` customers. ``asks`` are, by part,
    the links and the cells it wants to hear of, in its order.
    """

    def __init__(self, static: list[np.ndarray], asks: dict[int, tuple[np.ndarray, np.ndarray]], c1=None, t1=None, t2=None):
        self.v, self.w, self.share, self.alone, self.up, self.u, self.n = static
        self.asks, self.c1, self.t1, self.t2 = asks, c1, t1, t2

    @classmethod
    def opened(cls, told: dict[int, list[np.ndarray]]) -> Hall:
        """From what each part tells: v, w, share, cells and cells with one customer of links; v, u, w, share, n of cells."""
        parts = list(told)
        columns = [np.concatenate(own) for own in zip(*(told[p] for p in parts))]
        v, w, share, served, single, cell_v, u, cell_w, cell_share, n = columns
        both_v, both_w = np.concatenate([v, cell_v]), np.concatenate([w, cell_w])
        first, at = _distinct(both_v, both_w)
        links, cells = at[: len(v)], at[len(v) :]
        own, which = _distinct(cells, u)
        borders = [np.cumsum([0, *(len(told[p][i]) for p in parts)]) for i in (0, 5)]
        asks = {
            p: (links[borders[0][i] : borders[0][i + 1]], which[borders[1][i] : borders[1][i + 1]])
            for i, p in enumerate(parts)
        }
        customers = np.bincount(which, n, len(own)).astype(np.int64)
        static = [both_v[first], both_w[first], np.concatenate([share, cell_share])[first].view(np.float64)]
        static += [np.bincount(links, single, len(first)).astype(np.int64), cells[own], u[own], customers]
        t2 = (customers > 0).astype(np.int64)
        c1 = (np.bincount(links, served, len(first)) + np.bincount(cells[own], t2, len(first))).astype(np.int64)
        return cls(static, asks, c1, (c1 > 0).astype(np.int64), t2)

    def packed(self) -> bytes:
        """What stays the same."""
        static = [self.v, self.w, self.share.view(np.int64), self.alone, self.up, self.u, self.n]
        asked = [np.array([*self.asks], np.int64), *(np.array([len(own[i]) for own in self.asks.values()], np.int64) for i in (0, 1))]
        return pack(*static, *asked, *(np.concatenate([own[i] for own in self.asks.values()]) for i in (0, 1)))

    def seats(self) -> bytes:
        return pack(self.c1, self.t1, self.t2)

    @classmethod
    def unpacked(cls, blob: bytes, seats: bytes) -> Hall:
        *static, parts, many, few, links, cells = unpack(blob)
        static[2] = static[2].view(np.float64)
        asked = zip(np.split(links, np.cumsum(many)[:-1]), np.split(cells, np.cumsum(few)[:-1]))
        return cls(static, dict(zip(parts.tolist(), asked)), *unpack(seats))

    def _root(self, root: Root) -> np.ndarray:
        return root.p[np.minimum(self.w, len(root.p) - 1)] * self.share

    def sweep(self, told: dict[int, np.ndarray], root: Root, number: int) -> None:
        """Seats all customers anew; ``told`` are those that live cells of parts send to the links they ask for."""
        _, d1, d2 = root.discounts
        new = (STRENGTH + d1 * root.hot.word_t[self.v]) * self._root(root)
        p1 = (self.c1 - d1 * self.t1 + new) / (STRENGTH + root.hot.word_c[self.v])
        v = self.v[self.up]
        mass = (STRENGTH + d2 * root.hot.of_pairs(v, self.u)[1]) * p1[self.up]
        keys = (v << 2 * BITS) + (self.u << BITS) + self.w[self.up]
        self.t2 = seat(self.n, mass, d2, seeds(keys, 2, number))
        self.c1 = self.alone + np.bincount(self.up, self.t2, len(self.v)).astype(np.int64)
        for part, customers in told.items():
            self.c1[self.asks[part][0]] += customers
        self.t1 = seat(self.c1, new, d1, seeds((self.v << BITS) + self.w, 1, number))

    def sent(self, dishes: int) -> np.ndarray:
        """Customers that its links send to the root."""
        return np.bincount(np.minimum(self.w, dishes - 1), self.t1, dishes).astype(np.int64)

    def few(self) -> np.ndarray:
        """Links with one customer and with two, cells with one and with two."""
        return np.array([(x == k).sum() for x in (self.c1, self.n) for k in (1, 2)], np.int64)

    def totals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Customers and tables here of hot words and of pairs of two: whether a pair, its key or the word, and these."""
        words, at = np.unique(self.v, return_inverse=True)
        pairs, which = np.unique(pair_key(self.v[self.up], self.u), return_inverse=True)
        sums = [
            np.concatenate([np.bincount(at, a, len(words)), np.bincount(which, b, len(pairs))]).astype(np.int64)
            for a, b in ((self.c1, self.n), (self.t1, self.t2))
        ]
        return np.repeat([False, True], [len(words), len(pairs)]), np.concatenate([words, pairs]), *sums

    def answers(self) -> dict[int, bytes]:
        """To each part, customers and tables of the links it asks for."""
        return {part: pack(self.c1[links], self.t1[links]) for part, (links, _) in self.asks.items()}

    def last_answers(self, samples: list[tuple[list[np.ndarray], Root]]) -> dict[int, bytes]:
        """To each part, customers and tables of its links in each sample, and the probabilities of its cells."""
        mean, links = np.zeros(len(self.n)), []
        v = self.v[self.up]
        for (c1, t1, t2), root in samples:
            d2 = root.discounts[2]
            p1 = _after_hot(self.v, self._root(root), c1, t1, root)[self.up]
            customers, tables = root.hot.of_pairs(v, self.u)
            mean += (self.n - d2 * t2 + (STRENGTH + d2 * tables) * p1) / (STRENGTH + customers)
            links += [c1, t1]
        mean = (mean / len(samples)).view(np.int64)
        return {p: pack(mean[cells], *(own[at] for own in links)) for p, (at, cells) in self.asks.items()}


def _distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of numbers, where each distinct one occurs, ascending, and which of them each is."""
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def links_of(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    return (cells >> 2 * bits << bits) | (cells & ((1 << bits) - 1))


def _runs(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and which of them each is."""
    new = np.ones(len(ascending), bool)
    new[1:] = ascending[1:] != ascending[:-1]
    return ascending[new], np.cumsum(new) - 1


def _found(asked: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of those of ``asked`` that are known, where they were asked and which they are."""
    if not len(known):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1).astype(np.int32)
    hit = np.flatnonzero(known[at] == asked).astype(np.int32)
    return hit, at[hit]


def _predicted(p, d, room, served, own, customers, tables) -> np.ndarray:
    """Predictive probabilities in the restaurants of one depth; ``p`` are those of their parents."""
    hit, at = room
    p[hit] *= STRENGTH + d * tables[at]
    cell, which = served
    p[cell] += own[which]
    p[hit] /= STRENGTH + customers[at]
    return p
