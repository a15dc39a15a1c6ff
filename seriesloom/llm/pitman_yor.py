"""Hierarchical Pitman-Yor language model over words.

Every context that occurs has a restaurant: each pair of words, each word, and
one without context. A customer (a word seen there) sits down at a table of its
word or opens one, and each new table sends a customer to the parent restaurant:
two words of context, one, none. Seatings are sampled by Gibbs sweeps, and the
predictive probabilities of several are averaged. ``restaurants`` deals the
contexts out in parts and seats them.

Every word is a dish and a context of its own, in pairs too. The most frequent
ones, as many as two bytes tell apart, are dishes of the root. All others share
one dish there, "rare", and a restaurant below it that says which rare word it
is: what the parent says of a rare word is the product of the two. Its tables
are as many as there are words and stay in Spark; parts ask it once for the
words they hold. A sweep uses what the root said in the sweep before.

Restaurants of words that fill several parts, and of pairs of two of them, are
one each as well: halls hold them, parts send them their customers after each
sweep and hear from them before the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm import restaurants
from seriesloom.llm.restaurants import FIRST_OTHER, OTHERS, STRENGTH, WIDE
from seriesloom.llm.restaurants import Deal, Hall, Hot, Live, Names, Part, Root, discount, pack, seat, unpack
from seriesloom.session import remove_table, written, written_at

# Dishes of the root.
DISHES = restaurants.LOW
# Dishes of one sum, texts of one sum.
BLOCK = 4096
BURN_IN = 3
SAMPLES = 4
# Share of the rare restaurant's base that is an unseen word; the rest is spread evenly.
UNSEEN = 0.9
# Words of stretches that a task counts before it lets them go.
HELD = 1 << 20
# Bytes of the texts a task numbers, and deals out, at once: some 650,000 tokens.
STRETCH = 4 << 20
# Parts of one block of rare words, and of one hall.
ASKING = 8
PARTS_OF_A_HALL = 4

# What sums of logarithms are rounded to while they are dealt out, as parts of one.
FINE = 1 << 36

# The hash of the end of a text. No word has it but by chance of the hash.
END = 0


def word_hash(word: bytes) -> int:
    return int(word_hashes([word])[0])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64).view(np.int64)


def rare_number(hashes: np.ndarray) -> np.ndarray:
    """Numbers of words that are not frequent, from their hashes."""
    return (hashes & (FIRST_OTHER - 1)) | FIRST_OTHER


def _numbered(texts: pa.Array, train: np.ndarray) -> tuple[bytes, bytes]:
    """Texts as places in a list of the words they hold: that list, and how often each word is learned from; the texts."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = split.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    found = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # blanks at either end of a text leave an empty word there
    word = np.fromiter(map(len, distinct), np.int64, len(distinct))[found] > 0
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
    sizes = np.bincount(text[word], minlength=len(texts)).astype(np.int64) + 1
    # an empty word stands for no other word, so it may stand for the end
    hashes = np.append(word_hashes(distinct), END)
    words, at = np.unique(hashes, return_inverse=True)
    codes = np.full(sizes.sum(), at[-1], np.int64)
    last = np.zeros(len(codes), bool)
    last[np.cumsum(sizes) - 1] = True
    codes[~last] = at[found[word]]
    n = np.bincount(codes, np.repeat(train, sizes), len(words)).astype(np.int64)
    occur = np.bincount(codes, minlength=len(words)) > 0
    codes = (np.cumsum(occur) - 1)[codes]
    return pack(np.diff(words[occur], prepend=0), n[occur]), pack(sizes, train, codes)


def stretches(rows: DataFrame) -> DataFrame:
    """(row, ids, train, words, texts): rows of (id, train, text) side by side, their texts split into words once.

    ``row`` is the number of the first: that of the task and of the row in it. The numbers stay
    with the rows once this is written. A token is its word's place among ``words``, hashes in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column("text")
            size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            borders = np.flatnonzero(np.diff((size - 1) // STRETCH)) + 1
            for a, b in zip([0, *borders.tolist()], [*borders.tolist(), len(size)]):
                if a == b:
                    continue
                train = pc.fill_null(batch.column("train").slice(a, b - a), False)
                learned = train.to_numpy(zero_copy_only=False).astype(np.int64)
                packed = _numbered(texts.slice(a, b - a), learned)
                own = [_one_list(batch.column(name).slice(a, b - a)) for name in ("id", "train")]
                values = [pa.array([row], pa.int64()), *own, *(pa.array([x], pa.binary()) for x in packed)]
                yield pa.RecordBatch.from_arrays(values, ["row", "ids", "train", "words", "texts"])
                row += b - a

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "train", "text").mapInArrow(
        run, f"row long, ids array<{kind}>, train array<boolean>, words binary, texts binary"
    )


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): hash and number of every token learned from in stretches of texts, ends included."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def table() -> pd.DataFrame:
            words, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            return pd.DataFrame({"word": words, "n": np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)})

        for batch in batches:
            for blob in batch["words"]:
                steps, n = unpack(blob)
                held.append((np.cumsum(steps)[n > 0], n[n > 0]))
                size += len(steps)
                if size >= HELD:
                    yield table()
                    held, size = [], 0
        if held:
            yield table()

    return texts.select("words").mapInPandas(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The frequent words, by hash, most frequent first."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        self.hashes, self.counts = hashes, counts
        self.size = len(hashes)
        self.order = np.argsort(hashes)
        self.ordered = hashes[self.order]

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Dishes of words, below 0 for those that are not frequent."""
        places = np.full(len(hashes), -1, np.int64)
        hit, at = restaurants._found(hashes, self.ordered)
        places[hit] = self.order[at]
        return places


def counted(texts: DataFrame, vocabulary) -> DataFrame:
    """Per text: row, id, train, n_tokens, and of its frequent words n_known and base."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Vocabulary = vocabulary.value
        seen = np.append(np.log10(words.counts + 0.1), 0.0)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                places = words.places(np.cumsum(unpack(row.column("words")[0].as_py())[0]))
                sizes, _, codes = unpack(row.column("texts")[0].as_py())
                text = np.repeat(np.arange(len(sizes)), sizes)
                known = np.bincount(text, (places >= 0)[codes], len(sizes)).astype(np.int64)
                base = np.bincount(text, seen[places][codes], len(sizes))
                own = [_one_list(pa.array(x)) for x in (sizes, known, base)]
                values = [row.column(name) for name in ("row", "ids", "train")] + own
                yield pa.RecordBatch.from_arrays(values, ["row", "ids", "train", "n_tokens", "n_known", "base"])

    ids = texts.schema["ids"].dataType.simpleString()
    schema = f"row long, ids {ids}, train array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>"
    found = texts.mapInArrow(run, schema)
    zipped = F.arrays_zip("ids", "train", "n_tokens", "n_known", "base")
    return found.select("row", F.posexplode(zipped).alias("at", "t")).select(
        (F.col("row") + F.col("at")).alias("row"), F.col("t.ids").alias("id"), *(f"t.{c}" for c in ("train", "n_tokens", "n_known", "base"))
    )


def _dealt(batches: Iterator[pd.DataFrame], words: Vocabulary, deal: Deal, end: int) -> Iterator[tuple]:
    """Of each stretch: its first row, which texts are learned from, and for each part its cells, their names, and the texts of its tokens."""
    for batch in batches:
        for row, listed, packed in zip(batch["row"], batch["words"], batch["texts"]):
            hashes = np.cumsum(unpack(listed)[0])
            sizes, train, tokens = unpack(packed)
            tokens = tokens.astype(np.int32)
            numbers = words.places(hashes)
            rare = numbers < 0
            numbers[rare] = rare_number(hashes[rare])
            few, at = np.unique(numbers[rare], return_inverse=True)
            codes = numbers.astype(np.int32)
            codes[rare] = OTHERS + at
            at = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            part = deal.of(*restaurants.before_of(numbers[tokens], sizes, end), np.int64(row) + at).astype(np.int32)
            dishes = codes[tokens]
            before, twice = restaurants.before_of(dishes, sizes, codes[np.searchsorted(hashes, END)])
            names = Names([few] * 3)
            yield row, train, ((p, *_named(names, before[own], twice[own], dishes[own]), at[own]) for p, own in _split(part))


def _named(names: Names, *codes: np.ndarray) -> tuple[np.ndarray, Names]:
    codes, names = names.narrowed([own.astype(np.int64) for own in codes])
    return restaurants.joined(*codes, WIDE), names


def _split(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part.astype(np.uint16) if part.max(initial=0) < 1 << 16 else part, kind="stable")
    borders = np.flatnonzero(np.diff(part[order])) + 1
    for at in np.split(order, borders):
        if len(at):
            yield int(part[at[0]]), at


COLUMNS = ["row", "words", "texts"]


def customers(texts: DataFrame, vocabulary, deal, end: int) -> DataFrame:
    """(part, cells): cells of all texts with how often they occur in those learned from, packed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, train, parts in _dealt(batches, vocabulary.value, deal.value, end):
            found = []
            for part, cells, names, at in parts:
                distinct, cell = np.unique(cells, return_inverse=True)
                n = np.bincount(cell, train[at]).astype(np.int64)
                found.append((part, pack(*restaurants.columns_of(distinct, WIDE), *names.packed(), n)))
            yield pd.DataFrame(found, columns=["part", "cells"])

    return texts.select(*COLUMNS).mapInPandas(run, "part int, cells binary")


def tokens(texts: DataFrame, vocabulary, deal, end: int) -> DataFrame:
    """(part, cells): cells of all tokens with their text and whether it is learned from, packed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, train, parts in _dealt(batches, vocabulary.value, deal.value, end):
            found = []
            for part, cells, names, text in parts:
                # the tokens are still in the order of their texts
                here, place = restaurants._runs(text)
                order = np.argsort(cells)
                columns = restaurants.columns_of(cells[order], WIDE)
                own = (2 * place + train[text])[order], np.diff(np.int64(row) + here, prepend=0)
                found.append((part, pack(*columns, *names.packed(), *own)))
            yield pd.DataFrame(found, columns=["part", "cells"])

    return texts.select(*COLUMNS).mapInPandas(run, "part int, cells binary")


def _unpacked(blob: bytes) -> tuple[tuple[np.ndarray, Names], list[np.ndarray]]:
    """Cells and their names, and the columns beside them."""
    columns = unpack(blob)
    return (restaurants.from_columns(*columns[:3], WIDE), Names.unpacked(columns[3:6])), columns[6:]


def opened(counts: DataFrame, dishes: int, blocks: int, halls: int, deal) -> DataFrame:
    """Per part: its live cells, one table for each, what it sends to the root, its guests, and its rare dishes by block."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        blobs = [_unpacked(blob) for blob in group["cells"]]
        counted = np.concatenate([n for _, (n,) in blobs])
        cells, names = restaurants.merged([cells for cells, _ in blobs])
        del blobs
        cells, at = np.unique(cells, return_inverse=True)
        n = np.bincount(at, counted).astype(np.int64)
        hot = deal.value.hot if halls else None
        links, to, guest, both = _hot_of(cells, hot)
        own = n > 0
        own[both] = False
        part = Part(cells[own], n[own], names, hot=hot)
        live = part.live()
        t2, t1 = live.start()
        sent = live.sent(t1, dishes)
        rare = names.words[2]
        asked = [(block, pack(np.diff(rare[own], prepend=0))) for block, own in _split(rare % blocks)]
        found = (group["part"].iloc[0], live.packed(), pack(t2, t1), pack(sent), pack(part.fixed(dishes)))
        lists = (part.few().tolist(), [block for block, _ in asked], [words for _, words in asked])
        guests = b""
        if halls:
            # asked in order of the links; those that live cells send to, by their place among these
            at = np.searchsorted(links, part.links[part.link_live & part.guest])
            served, single = (np.bincount(to, x[guest], len(links)).astype(np.int64) for x in (n > 0, n == 1))
            v, u, w = (names.numbers(codes, place) for place, codes in enumerate(restaurants.parted(cells[both], WIDE)))
            guests = pack(*_numbers(links, names), served, single, v, u, w, n[both], at)
        names = ["part", "live", "seats", "sent", "fixed", "few", "blocks", "words", "guests"]
        return pd.DataFrame([(*found, *lists, guests)], columns=names)

    schema = (
        "part int, live binary, seats binary, sent binary, fixed binary, few array<long>, "
        "blocks array<int>, words array<binary>, guests binary"
    )
    return counts.groupBy("part").applyInPandas(run, schema)


def _hot_of(cells: np.ndarray, hot: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The links of hot words, which of them the cells after one hot word have, where these cells are, and those after two."""
    v, u, _ = restaurants.parted(cells, WIDE)
    host, second = restaurants.among(v, hot), restaurants.among(u, hot)
    guest, both = np.flatnonzero(host & ~second), np.flatnonzero(host & second)
    links, to = np.unique(restaurants.links_of(cells[guest], WIDE), return_inverse=True)
    return links, to, guest, both


def _numbers(links: np.ndarray, names: Names) -> tuple[np.ndarray, np.ndarray]:
    """Of links of hot words: the word, and the number of the dish."""
    return links >> WIDE, names.numbers(links & ((1 << WIDE) - 1), 2)


def shares(parts: DataFrame, rare: RareWords, blocks: int) -> DataFrame:
    """(part, block, share): of the part's rare dishes in a block, what the restaurant of rare words says, and its customers."""
    unseen = rare.unseen

    def run(asked: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        words = words.sort_values("word")
        known, logp, customers = words["word"].to_numpy(), words["logp"].to_numpy(), words["n"].to_numpy()
        found = []
        for part, blob in zip(asked["part"], asked["words"]):
            (own,) = unpack(blob)
            p = np.full(len(own), 10.0**unseen)
            hit, at = restaurants._found(np.cumsum(own), known)
            p[hit] = 10.0 ** logp[at]
            n = np.zeros(len(own), np.int64)
            n[hit] = customers[at]
            found.append((part, pack(p.astype(np.float32).view(np.int32), n)))
        return pd.DataFrame(found, columns=["part", "share"]).assign(block=asked["block"].iloc[:1].max())

    asked = parts.select("part", F.explode(F.arrays_zip("blocks", "words")).alias("a")).select(
        "part", F.col("a.blocks").alias("block"), F.col("a.words").alias("words")
    )
    number = F.col("word").bitwiseAND(FIRST_OTHER - 1).bitwiseOR(FIRST_OTHER)
    words = rare.words.select(number.alias("word"), "n", "logp").withColumn("block", F.pmod("word", F.lit(blocks)).cast("int"))
    return asked.groupBy("block").cogroup(words.groupBy("block")).applyInPandas(run, "part int, share binary, block int")


def _float32(column: np.ndarray) -> np.ndarray:
    """Numbers that were packed by their bits."""
    return column.astype(np.int32).view(np.float32).astype(np.float64)


def _shares_of(words: np.ndarray, blocks: int, said: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of all rare dishes of a part, in order: what the restaurant of rare words says, and its customers."""
    share, customers = np.empty(len(words)), np.empty(len(words), np.int64)
    places = dict(_split(words % blocks))
    for block, blob in zip(said["block"], said["share"]):
        p, customers[places[block]] = unpack(blob)
        share[places[block]] = _float32(p)
    return share, customers


def informed(parts: DataFrame, said: DataFrame, blocks: int, halls: int) -> DataFrame:
    """The parts, whose live cells now know what the restaurant of rare words says of their dishes; what they tell halls."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        row = group[group["live"].notna()].iloc[0]
        live = Live.unpacked(row["live"])
        words = np.sort(np.concatenate([np.empty(0, np.int64), *(np.cumsum(unpack(blob)[0]) for blob in row["words"])]))
        share, _ = _shares_of(words, blocks, group[group["share"].notna()])
        live.share = share[np.searchsorted(words, live.names.words[2])]

        def shared(w: np.ndarray) -> np.ndarray:
            found = np.ones(len(w))
            rare = w >= FIRST_OTHER
            found[rare] = share[np.searchsorted(words, w[rare])]
            return found.view(np.int64)

        guests, listed, told = b"", [], []
        if halls:
            v, w, served, single, cell_v, u, cell_w, n, at = unpack(row["guests"])
            links, cells = [v, w, shared(w), served, single], [cell_v, u, cell_w, shared(cell_w), n]
            hall, own = restaurants.hall_of(v, w, halls), restaurants.hall_of(cell_v, cell_w, halls)
            guests = pack(hall, at)
            listed = np.union1d(hall, own).tolist()
            told = [pack(*(c[hall == h] for c in links), *(c[own == h] for c in cells)) for h in listed]
        found = (row["part"], live.packed(), row["seats"], [], guests, listed, told)
        return pd.DataFrame([found], columns=[c.split()[0] for c in PARTS.split(", ")])

    both = parts.select("part", "live", "seats", "words", "guests").unionByName(said, allowMissingColumns=True)
    return both.groupBy("part").applyInPandas(run, PARTS)


PARTS = "part int, live binary, seats binary, kept array<binary>, guests binary, halls array<int>, told array<binary>"
HALLS = (
    "hall int, static binary, seats binary, kept array<binary>, sent binary, few array<long>, pairs array<boolean>, "
    "keys array<long>, customers array<long>, tables array<long>, parts array<int>, answers array<binary>"
)


def _told(parts: DataFrame) -> DataFrame:
    """(hall, part, told): what parts tell halls."""
    return parts.select("part", F.explode(F.arrays_zip("halls", "told")).alias("t")).select(
        F.col("t.halls").alias("hall"), "part", F.col("t.told").alias("told")
    )


def _answers(halls: DataFrame) -> DataFrame:
    """(part, hall, heard): what halls answer parts."""
    return halls.select("hall", F.explode(F.arrays_zip("parts", "answers")).alias("a")).select(
        F.col("a.parts").alias("part"), "hall", F.col("a.answers").alias("heard")
    )


def _hall_row(number: int, static: bytes, hall: Hall, kept: list[bytes], dishes: int) -> pd.DataFrame:
    pairs, *totals = hall.totals()
    answers = hall.answers()
    found = (number, static, hall.seats(), kept, pack(hall.sent(dishes)), hall.few().tolist(), pairs.tolist())
    found += (*(own.tolist() for own in totals), [*answers], [*answers.values()])
    return pd.DataFrame([found], columns=[c.split()[0] for c in HALLS.split(", ")])


def halls_opened(told: DataFrame, dishes: int) -> DataFrame:
    """The halls, one table for each cell and each link."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        hall = Hall.opened({part: unpack(blob) for part, blob in zip(group["part"], group["told"])})
        return _hall_row(group["hall"].iloc[0], hall.packed(), hall, [], dishes)

    return told.groupBy("hall").applyInPandas(run, HALLS)


def halls_swept(halls: DataFrame, told: DataFrame, root, number: int, dishes: int) -> DataFrame:
    """The halls with all customers seated anew, and the seats to keep."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        row = group[group["static"].notna()].iloc[0]
        hall = Hall.unpacked(row["static"], row["seats"])
        heard = group[group["told"].notna()]
        hall.sweep({part: unpack(blob)[0] for part, blob in zip(heard["part"].astype(int), heard["told"])}, root.value, number)
        kept = [*row["kept"], *([hall.seats()] if number > BURN_IN else [])]
        return _hall_row(row["hall"], row["static"], hall, kept, dishes)

    both = halls.select("hall", "static", "seats", "kept").unionByName(told, allowMissingColumns=True)
    return both.groupBy("hall").applyInPandas(run, HALLS)


def halls_asked(halls: DataFrame, samples: list[Root]) -> DataFrame:
    """(part, hall, heard): what halls say at last of the links and cells of each part, by sample."""
    roots = halls.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, static, kept in zip(batch["hall"], batch["static"], batch["kept"]):
                hall = Hall.unpacked(static, kept[-1])
                answers = hall.last_answers([(unpack(blob), root) for blob, root in zip(kept, roots.value)])
                yield pd.DataFrame({"part": [*answers], "hall": number, "heard": [*answers.values()]})

    return halls.select("hall", "static", "kept").mapInPandas(run, "part int, hall int, heard binary")


def hot_totals(halls: DataFrame, dishes: int) -> Hot:
    """Sums over all halls; as many as there are hot words and pairs of two."""
    zipped = F.explode(F.arrays_zip("pairs", "keys", "customers", "tables")).alias("t")
    found = (
        halls.select(zipped)
        .groupBy(F.col("t.pairs").alias("pair"), F.col("t.keys").alias("key"))
        .agg(F.sum("t.customers").alias("customers"), F.sum("t.tables").alias("tables"))
        .orderBy("key")
        .toPandas()
    )
    words, pairs = found[~found["pair"]], found[found["pair"]]
    word_c, word_t = np.zeros(dishes, np.int64), np.zeros(dishes, np.int64)
    word_c[words["key"]], word_t[words["key"]] = words["customers"], words["tables"]
    return Hot(word_c, word_t, *(pairs[c].to_numpy(np.int64) for c in ("key", "customers", "tables")))


def swept(seated: DataFrame, answers: DataFrame | None, root, number: int, dishes: int, deal) -> DataFrame:
    """The parts with all customers seated anew, and the seats to keep; the last leaves its cells out."""
    last = number == BURN_IN + SAMPLES
    schema = f"{PARTS}, sent binary"
    own = ["part", "live", "seats", "kept", "guests"]

    def anew(row, heard: dict[int, bytes]) -> pd.DataFrame:
        part, blob, seats, kept, guests = row
        live = Live.unpacked(blob, deal.value.hot if guests else None)
        hall, at = unpack(guests) if guests else (None, None)
        found = None
        if guests:
            found = np.zeros((2, len(hall)), np.int64)
            places = dict(_split(hall))
            for h, said in heard.items():
                if h in places:
                    found[:, places[h]] = unpack(said)
            found = found[:, at]
        t2, t1 = live.sweep(*unpack(seats), root.value, number, found if found is None else tuple(found))
        seats, sent, told = pack(t2, t1), pack(live.sent(t1, dishes)), []
        if guests:
            customers = np.zeros(len(hall), np.int64)
            customers[at] = live.told(t2)
            told = [(h, pack(customers[place])) for h, place in places.items()]
        row = {"part": part, "live": b"" if last else blob, "seats": b"" if last else seats}
        row |= {"kept": [*kept, *([seats] if number > BURN_IN else [])], "guests": b"" if last else guests}
        return pd.DataFrame([row | {"halls": [h for h, _ in told], "told": [blob for _, blob in told], "sent": sent}])

    def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield anew(row, {})

    def hearing(group: pd.DataFrame) -> pd.DataFrame:
        heard = group[group["heard"].notna()]
        row = group.loc[group["live"].notna(), own].iloc[0]
        return anew(row, dict(zip(heard["hall"].astype(int), heard["heard"])))

    if answers is None:
        return seated.select(*own).mapInPandas(alone, schema)
    return seated.select(*own).unionByName(answers, allowMissingColumns=True).groupBy("part").applyInPandas(hearing, schema)


def summed(parts: DataFrame, column: str, dishes: int) -> np.ndarray:
    """Sum of the packed customers per dish over all parts, a block of dishes at a time."""

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(dishes, np.int64)
        for batch in batches:
            for blob in batch[column]:
                total += unpack(blob)[0]
        for a in range(0, dishes, BLOCK):
            yield pd.DataFrame({"first": [a], "sums": [total[a : a + BLOCK].tobytes()]})

    def across(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(sums, np.int64) for sums in group["sums"])
        return pd.DataFrame({"first": group["first"].iloc[:1], "sums": [total.tobytes()]})

    schema = "first int, sums binary"
    sums = parts.select(column).mapInPandas(within, schema).groupBy("first").applyInPandas(across, schema)
    found = np.zeros(dishes, np.int64)
    for r in sums.collect():
        block = np.frombuffer(r["sums"], np.int64)
        found[r["first"] : r["first"] + len(block)] = block
    return found


def _let_go(spark) -> None:
    """Lets Spark delete shuffled rows that nothing reads again now, rather than when the driver's memory is full."""
    spark._jvm.System.gc()


def sampled(
    counts: DataFrame, rare: RareWords, dishes: int, blocks: int, halls: int, deal
) -> tuple[DataFrame, DataFrame, DataFrame | None, list[Root]]:
    """The seats of each part in the samples, what its rare dishes have, what halls say, and the roots the seats were taken with."""
    spark = counts.sparkSession
    begun, first = written_at(opened(counts, dishes, blocks, halls, deal), "opened")
    _let_go(spark)
    said = written(shares(begun, rare, blocks), "shares")
    seated, path = written_at(informed(begun, said, blocks, halls), "seated")
    _let_go(spark)
    # what goes to the root at first, and what discounts are estimated by
    rooms, hot, rooms_at = [begun.select("sent", "few")], None, None
    if halls:
        hosts, rooms_at = written_at(halls_opened(_told(seated), dishes), "halls")
        rooms.append(hosts.select("sent", "few"))
        hot = hot_totals(hosts, dishes)
    every = reduce(DataFrame.unionByName, rooms)
    fixed = summed(begun, "fixed", dishes)
    sent = fixed + summed(every, "sent", dishes)
    few = every.agg(*[F.coalesce(F.sum(F.col("few")[i]), F.lit(0)) for i in range(4)]).first()
    discounts = np.array([discount((sent == 1).sum(), (sent == 2).sum()), discount(*few[:2]), discount(*few[2:])])
    root, tables = restaurants.root_of(sent, discounts, int((sent > 0).sum()), 0)
    root.hot = hot
    roots = []
    remove_table(spark, first)
    # a sweep needs what all parts sent to the root before it, so each is a job and a table
    for number in range(1, BURN_IN + SAMPLES + 1):
        shared = spark.sparkContext.broadcast(root)
        former = path
        answers = _answers(hosts) if halls else None
        seated, path = written_at(swept(seated, answers, shared, number, dishes, deal), "seated")
        remove_table(spark, former)
        rooms = [seated.select("sent")]
        if halls:
            former = rooms_at
            hosts, rooms_at = written_at(halls_swept(hosts, _told(seated), shared, number, dishes), "halls")
            remove_table(spark, former)
            rooms.append(hosts.select("sent"))
            hot = hot_totals(hosts, dishes)
            _let_go(spark)
        sent = fixed + summed(reduce(DataFrame.unionByName, rooms), "sent", dishes)
        root, tables = restaurants.root_of(sent, discounts, tables, number)
        root.hot = hot
        if number > BURN_IN:
            roots.append(root)
    heard = None
    if halls:
        heard = written(halls_asked(hosts, roots), "heard")
        remove_table(spark, rooms_at)
    return seated.select("part", "kept"), said, heard, roots


def text_scores(
    dealt: DataFrame,
    kept: DataFrame,
    said: DataFrame,
    blocks: int,
    samples: list[Root],
    heard: DataFrame | None,
    halls: int,
    deal,
) -> DataFrame:
    """(row, score, rare_known, rare_base): log10 probability of each text, averaged over the samples, and sums of its rare words."""
    roots = dealt.sparkSession.sparkContext.broadcast(samples)
    both = dealt.unionByName(kept, allowMissingColumns=True).unionByName(said, allowMissingColumns=True)
    if halls:
        both = both.unionByName(heard, allowMissingColumns=True)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        blobs, rows, texts, train, size = [], [], [], [], 0
        for blob in group["cells"].dropna():
            cells, (text, row) = _unpacked(blob)
            blobs.append(cells)
            rows.append(np.cumsum(row))
            texts.append(((text >> 1) + size).astype(np.int32))
            train.append((text & 1).astype(bool))
            size += len(row)
        said = group.loc[group["share"].notna(), ["block", "share"]]
        seats = [unpack(blob) for blob in group["kept"].dropna().iloc[0]]
        answers = group.loc[group["heard"].notna(), ["hall", "heard"]] if halls else None
        del group
        rows, text, train = np.concatenate(rows), np.concatenate(texts), np.concatenate(train)
        del texts
        cells, names = restaurants.merged(blobs)
        asked, at = np.unique(cells, return_inverse=True)
        at = at.astype(np.int32)
        del cells
        n = np.bincount(at[train], minlength=len(asked))
        share, seen = _shares_of(names.words[2], blocks, said)
        dish = asked & ((1 << WIDE) - 1)
        rare = np.flatnonzero(dish >= OTHERS)
        known, base = np.zeros(len(asked), np.int8), np.zeros(len(asked))
        known[rare], base[rare] = seen[dish[rare] - OTHERS] > 0, np.log10(seen[dish[rare] - OTHERS] + 0.1)
        del dish, rare
        known, base = np.bincount(text, known[at], len(rows)), np.bincount(text, base[at], len(rows))
        hot = deal.value.hot if halls else None
        links, _, _, both = _hot_of(asked, hot)
        own = np.ones(len(asked), bool)
        own[both] = False
        part = Part(asked[(n > 0) & own], n[(n > 0) & own], names, share, hot)
        samples = [(*own, root) for own, root in zip(seats, roots.value)]
        p, of_links = np.empty(len(asked)), None
        if halls:
            v, _, w = restaurants.parted(asked[both], WIDE)
            here = dict(_split(restaurants.hall_of(*_numbers(links, names), halls)))
            there = dict(_split(restaurants.hall_of(v, names.numbers(w, 2), halls)))
            found = np.zeros((2 * len(samples), len(links)), np.int64)
            for hall, blob in zip(answers["hall"].astype(int), answers["heard"]):
                mean, *counted = unpack(blob)
                if hall in here:
                    found[:, here[hall]] = counted
                if hall in there:
                    p[both[there[hall]]] = mean.view(np.float64)
            of_links = list(zip(found[::2], found[1::2]))
        p[own] = part.probabilities(asked[own], samples, of_links)
        score = np.log10(p)[at]
        total = np.bincount(text, score, len(rows))
        here = np.argsort(rows, kind="stable")
        row, total = rows[here], total[here].astype(np.float32).view(np.int32)
        known, base = known[here].astype(np.int64), np.rint(base[here] * FINE).astype(np.int64)
        cut = np.flatnonzero(np.diff(row // BLOCK)) + 1
        split = zip(*(np.split(x, cut) for x in (row, total, known, base)))
        found = [(int(r[0]) // BLOCK, pack(np.diff(r, prepend=0), *own)) for r, *own in split]
        return pd.DataFrame(found, columns=["block", "scores"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        found = [unpack(blob) for blob in group["scores"]]
        rows, scores, known, base = (np.concatenate(own) for own in zip(*((np.cumsum(r), *own) for r, *own in found)))
        row, at = np.unique(rows, return_inverse=True)
        scores = np.bincount(at, _float32(scores))
        known, base = np.bincount(at, known).astype(np.int64), np.bincount(at, base / FINE)
        return pd.DataFrame({"row": row, "score": scores, "rare_known": known, "rare_base": base})

    parts = both.groupBy("part").applyInPandas(run, "block long, scores binary")
    return parts.groupBy("block").applyInPandas(add, "row long, score double, rare_known long, rare_base double")


class RareWords:
    """The restaurant of rare words: (word, n, log10 p) in Spark, and log10 p of an unseen one."""

    def __init__(self, rare: DataFrame):
        words, served, once, twice = rare.agg(
            F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        ).first()
        d = discount(once, twice)
        unseen = UNSEEN if words else 1.0
        each = (1 - unseen) / max(1, words)
        # a word that occurs once has one table whatever is drawn
        several = rare.filter("n > 1")

        def tables(n: np.ndarray, word: np.ndarray, total: float, number: int) -> np.ndarray:
            mass = np.full(len(n), (STRENGTH + d * total) * each)
            return seat(n, mass, d, word.astype(np.int64).view(np.uint64) * np.uint64(2 * number + 1))

        def count(total: float, number: int) -> float:
            def run(batches):
                for batch in batches:
                    found = tables(batch["n"].to_numpy(), batch["word"].to_numpy(), total, number)
                    yield pd.DataFrame({"tables": [found.sum()]})

            return once + float(several.mapInPandas(run, "tables long").agg(F.sum("tables")).first()[0] or 0)

        # tables at the start and after each sweep
        totals = [float(words)]
        for number in range(BURN_IN + SAMPLES):
            totals.append(count(totals[-1], number))
        below = STRENGTH + served

        def run(batches):
            for batch in batches:
                n, word = batch["n"].to_numpy(), batch["word"].to_numpy()
                mean = np.zeros(len(n))
                for number in range(BURN_IN, BURN_IN + SAMPLES):
                    t = tables(n, word, totals[number], number)
                    mean += (n - d * t + (STRENGTH + d * totals[number + 1]) * each) / below / SAMPLES
                yield pd.DataFrame({"word": word, "n": n, "logp": np.log10(mean)})

        self.words = rare.mapInPandas(run, "word long, n long, logp double")
        self.unseen = float(np.log10((STRENGTH + d * np.mean(totals[BURN_IN + 1 :])) / below * unseen))


def scores(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, train, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from all rows where ``train`` holds. A null text is empty,
    and an empty one has one token, its end. Unseen words are one event. Rows
    without an id and repeated rows are texts like others. Of equally frequent
    words at the border of the root's dishes, the smaller hashes are in. Without any
    row to learn from, every word is unseen and all scores are 0.
    """
    rows = docs.select(docs[doc_id].alias("id"), train.alias("train"), docs[text].alias("text"))
    texts = written(stretches(rows), "texts")
    counts, counts_at = written_at(word_counts(texts), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # the end of a text is always a dish, since it may be a context
    top = counts.orderBy((F.col("word") == END).desc(), F.col("n").desc(), "word").limit(DISHES)
    first = sorted(((r["n"], r["word"]) for r in top.collect()), key=lambda r: (-r[0], r[1]))
    hashes = np.array([w for _, w in first], np.int64)
    vocabulary = Vocabulary(hashes, np.array([n for n, _ in first], np.int64))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)

    dishes = vocabulary.size + 1
    # the root's last dish, "rare", is no context
    table = Deal(np.append(vocabulary.counts, 0), restaurants.PART, total)
    deal, blocks = spark.sparkContext.broadcast(table), -(-table.parts // ASKING)
    halls = -(-table.parts // PARTS_OF_A_HALL) if table.hot.any() else 0
    place = int(vocabulary.places(np.array([END]))[0])
    end = place if place >= 0 else FIRST_OTHER

    frequent = spark.createDataFrame(pd.DataFrame({"word": hashes}), "word long")
    others, others_at = written_at(counts.join(frequent, "word", "left_anti"), "rare")
    remove_table(spark, counts_at)
    _let_go(spark)
    rare = RareWords(others)

    kept, said, heard, roots = sampled(customers(texts, shared, deal, end), rare, dishes, blocks, halls, deal)
    remove_table(spark, others_at)
    whole_scores = text_scores(tokens(texts, shared, deal, end), kept, said, blocks, roots, heard, halls, deal)

    whole = F.log10(F.lit(float(total)) + 0.1 * (distinct + 1))
    return counted(texts, shared).join(whole_scores, "row").select(
        "id",
        "train",
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare_base") - F.col("n_tokens") * whole).alias("base_score"),
        "score",
    )


def held_out(doc_id: Column) -> Column:
    """Rows that the model does not learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))
