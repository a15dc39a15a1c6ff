"""Token ids of all documents in flat files with 64-bit offsets, to be memory-mapped.

A folder of token files holds, in ascending order of document id:

- ``<part>.bin``: the ids of the part's documents one after the other, as little-endian
  unsigned integers of 16 bits, or of 32 where the vocabulary needs them, without a header
- ``<part>.idx``: a 64-bit offset per document, in ids from the start of the part, and the end
- ``<part>.doc``: a 64-bit document id per document
- ``manifest.json``: the parts in order, each with its base, the ids of all parts before it

Parts put end to end are one flat file for the whole table. Each task writes its
part without knowing the others; bases are prefix sums of the parts' lengths.
A part's name holds the task attempt, and the manifest only names parts of
attempts that ended well, so a lost executor leaves a file that nothing reads.

Paths may be local ones that all executors share, or of any file system that
pyarrow opens; where memory maps are not to be had, ranges are read instead.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesloom.llm.polyhash import FACTOR, Prefixes, mixed
from seriesloom.session import written

# Bytes of text per part, about: some 100 MB of 16-bit ids.
PART_BYTES = 1 << 28
# Documents that a reading task takes at a time, and ids per reading task, about.
SLICE_DOCS = 4096
READ_IDS = 1 << 24
# Bytes of ids handed to Spark at once.
READ_BYTES = 1 << 23

# Characters that are cut and looked up together, and words that a worker remembers.
STRETCH = 1 << 20
KNOWN = 1 << 21

# Fixed value: all that any tokenizer may hold for a blank, and more, but for space and line break.
_OTHER = r"\x00-\x09\x0b-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"
_OTHER_BLANK = re.compile(f"[{_OTHER}]")
# Runs of blanks that are not cut as single ones are.
_IRREGULAR = re.compile(f"[ \n{_OTHER}]{{3}}|[ \n{_OTHER}]{{2}}\\Z")
_PAIRS = ("  ", " \n", "\n ", "\n\n")
_BETWEEN = re.compile(f"(?<![ \n{_OTHER}]) (?![ \n{_OTHER}])")
_SPACE, _LINE = 32, 10

# A number for each byte, for the second of two hashes.
_CHECKS = mixed(np.arange(1, 257, dtype=np.uint64) * FACTOR)

PARTS = "number int, name string, docs long, ids long, without_id long"


def id_type(definition: str, end_id: int) -> str:
    """The narrowest type that holds all ids of the tokenizer and the end."""
    largest = max([end_id, *Tokenizer.from_str(definition).get_vocab().values()])
    return "<u2" if largest < 1 << 16 else "<u4"


class Words:
    """The ids of words, by two hashes of their bytes, in the order of the first."""

    def __init__(self, dtype: str):
        self.hashes, self.checks = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, dtype)

    def places(self, hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ascending hashes are or belong, and which of them are there."""
        at = np.searchsorted(self.hashes, hashes)
        near = np.minimum(at, len(self.hashes) - 1)
        if not len(self.hashes):
            return at, np.zeros(len(at), bool)
        same = self.hashes[near] == hashes
        if (self.checks[near] != checks)[same].any():
            raise HashesMeet
        return at, same

    def add(self, at: np.ndarray, hashes: np.ndarray, checks: np.ndarray, ids: list[bytes]) -> None:
        sizes = np.array([len(i) for i in ids], np.int64) // self.ids.itemsize
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.hashes, self.checks = np.insert(self.hashes, at, hashes), np.insert(self.checks, at, checks)
        self.starts, self.sizes = np.insert(self.starts, at, starts), np.insert(self.sizes, at, sizes)
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), self.ids.dtype)])


class HashesMeet(Exception):
    """Two words have one hash."""


class Encoder:
    """A tokenizer in a worker, which remembers the ids of words.

    Byte-level tokenizers begin a piece at a space and end one at a line break,
    but for runs of three blanks and more or at the end of a text, and encode
    each piece by itself. So texts without such runs are cut there, and each
    word, with its space and its punctuation, is encoded once and looked up from
    then on. Texts with such runs or an added token are encoded whole, as are
    all texts of other tokenizers.
    """

    def __init__(self, definition: str, dtype: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype(dtype)
        self.end = np.array([end_id], dtype).tobytes()
        parts = json.loads(definition)
        self.added = [t["content"] for t in parts.get("added_tokens") or []]
        self.cuts = _cuts_at_spaces(parts)
        self.known = Words(dtype)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text, and the end, as bytes."""
        found: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, str]] = []
        length = 0
        for n, text in enumerate(texts):
            if not self._regular(text):
                found[n] += self._whole([text])
                continue
            for stretch in _stretches(text):
                waiting.append((n, stretch))
                length += len(stretch)
                if length >= STRETCH:
                    self._flush(waiting, found)
                    waiting, length = [], 0
        self._flush(waiting, found)
        return [b"".join([*parts, self.end]) for parts in found]

    def _regular(self, text: str) -> bool:
        return (
            self.cuts
            and not any(token in text for token in self.added)
            and not _has_irregular_blanks(text)
        )

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in encoded]

    def _flush(self, waiting: list[tuple[int, str]], found: list[list[bytes]]) -> None:
        stretches = [stretch for _, stretch in waiting]
        if not any(stretches):
            return
        try:
            encoded = self._by_words(stretches)
        except HashesMeet:
            encoded = self._whole(stretches)
        for (n, _), ids in zip(waiting, encoded):
            found[n].append(ids)

    def _by_words(self, stretches: list[str]) -> list[bytes]:
        parts = [stretch.encode() for stretch in stretches]
        data = b"".join(parts)
        codes = np.frombuffer(data, np.uint8)
        bounds = np.cumsum([0, *map(len, parts)])
        line = codes == _LINE
        first = (codes == _SPACE) | line
        first[1:] |= line[:-1]
        first[bounds[bounds < len(codes)]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(codes))

        hashes, which, place = np.unique(
            mixed(Prefixes(codes).run(starts, ends)), return_index=True, return_inverse=True
        )
        checks = Prefixes(_CHECKS[codes]).run(starts, ends)
        if (checks[which][place] != checks).any():
            raise HashesMeet
        if len(self.known.hashes) + len(hashes) > KNOWN or len(self.known.ids) > 8 * KNOWN:
            self.known = Words(self.dtype)
        at, there = self.known.places(hashes, checks[which])
        new = ~there
        if new.any():
            spans = zip(starts[which][new].tolist(), ends[which][new].tolist())
            ids = self._whole([data[a:b].decode() for a, b in spans])
            self.known.add(at[new], hashes[new], checks[which][new], ids)
            at = np.searchsorted(self.known.hashes, hashes)

        sizes = self.known.sizes[at][place]
        ends_at = np.cumsum(sizes)
        shift = self.known.starts[at][place] - (ends_at - sizes)
        ids = self.known.ids[np.repeat(shift, sizes) + np.arange(ends_at[-1])]
        # ids before each stretch: those of the words before it
        cuts = np.append(0, ends_at)[np.searchsorted(starts, bounds)]
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def _has_irregular_blanks(text: str) -> bool:
    if not _OTHER_BLANK.search(text) and not any(pair in text for pair in _PAIRS):
        return False
    return _IRREGULAR.search(text) is not None


def _stretches(text: str) -> Iterator[str]:
    """The text cut before single spaces between words."""
    start = 0
    while len(text) - start > STRETCH:
        cut = _BETWEEN.search(text, start + STRETCH)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _cuts_at_spaces(parts: dict) -> bool:
    splitter, model = parts.get("pre_tokenizer") or {}, parts["model"]
    return (
        parts.get("normalizer") is None
        and splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space", True)
        and model["type"] == "BPE"
        and not model.get("dropout")
        and not model.get("ignore_merges")
    )


@lru_cache(maxsize=2)
def _encoder(definition: str, dtype: str, end_id: int) -> Encoder:
    """One encoder per worker process, kept from task to task."""
    return Encoder(definition, dtype, end_id)


class Folder:
    """A folder of token files, on whatever file system it is."""

    def __init__(self, path: str):
        known = path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path
        self.system, self.root = fs.FileSystem.from_uri(known)
        self.mapped = isinstance(self.system, fs.LocalFileSystem)

    def create(self, name: str) -> pa.NativeFile:
        self.system.create_dir(self.root, recursive=True)
        return self.system.open_output_stream(f"{self.root}/{name}")

    def read(self, name: str) -> bytes:
        with self.system.open_input_stream(f"{self.root}/{name}") as file:
            return file.read()

    def values(self, name: str, dtype: str, low: int, high: int) -> np.ndarray:
        """Values [low, high) of a flat file: a memory map, or a range read."""
        size, kind = high - low, np.dtype(dtype)
        if size <= 0:
            return np.empty(0, kind)
        if self.mapped:
            path = f"{self.root}/{name}"
            return np.memmap(path, kind, "r", offset=low * kind.itemsize, shape=(size,))
        with self.system.open_input_file(f"{self.root}/{name}") as file:
            return np.frombuffer(file.read_at(size * kind.itemsize, low * kind.itemsize), kind)


def _write_part(path: str, definition, dtype: str, end_id: int):
    """A function that encodes and writes one task's sorted rows and returns its line of the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = context.partitionId()
        name = f"part-{number:06d}-{context.taskAttemptId()}"
        rows = filter(lambda b: b.num_rows, batches)
        first = next(rows, None)
        if first is None:
            return
        folder = Folder(path)
        encoder = _encoder(definition.value, dtype, end_id)
        docs = ids = without_id = 0
        with (
            folder.create(f"{name}.bin") as flat,
            folder.create(f"{name}.idx") as offsets,
            folder.create(f"{name}.doc") as keys,
        ):
            offsets.write(np.zeros(1, "<u8").tobytes())
            for batch in chain([first], rows):
                encoded = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
                flat.write(b"".join(encoded))
                ends = ids + np.cumsum([len(e) // encoder.dtype.itemsize for e in encoded])
                offsets.write(ends.astype("<u8").tobytes())
                keys.write(batch.column("id").fill_null(0).to_numpy().astype("<i8").tobytes())
                docs, ids = docs + batch.num_rows, int(ends[-1])
                without_id += batch.column("id").null_count
        line = {"number": number, "name": name, "docs": docs, "ids": ids, "without_id": without_id}
        types = {"number": pa.int32(), "name": pa.string()}
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], types.get(k, pa.int64())) for k, v in line.items()], names=list(line)
        )

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    part_bytes: int = PART_BYTES,
) -> dict:
    """Encode ``text`` and write a folder of token files; returns its manifest.

    ``tokenizer`` is the path of a tokenizer file on the driver, which sends it
    to the executors. Special tokens are not added, ``end_id`` follows each
    document. Null and empty texts are the end alone. Documents are in ascending
    order of id, those without an id last, those of one id by a hash of their
    text; repeated rows are written each. No rows make a manifest without parts.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    dtype = id_type(definition, end_id)
    sent = spark.sparkContext.broadcast(definition)
    # "row" tells equal rows apart, so that a range can end among them
    rows = docs.select(
        docs[doc_id].cast("long").alias("id"),
        F.xxhash64(docs[text]).alias("th"),
        F.monotonically_increasing_id().alias("row"),
        docs[text].alias("text"),
    )
    total = docs.agg(F.sum(F.octet_length(docs[text]))).first()[0] or 0
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))
    order = [F.col("id").asc_nulls_last(), F.col("th"), F.col("row")]
    sorted_rows = rows.repartitionByRange(count, *order).sortWithinPartitions(*order).select("id", "text")
    parts = written(sorted_rows.mapInArrow(_write_part(path, sent, dtype, end_id), PARTS), "parts")
    lines = [r.asDict() for r in parts.orderBy("number").collect()]
    bases = accumulate([p["ids"] for p in lines], initial=0)
    manifest = {
        "dtype": dtype,
        "end_id": end_id,
        "parts": [{**p, "base": base} for p, base in zip(lines, bases)],
    }
    with Folder(path).create("manifest.json") as file:
        file.write(json.dumps(manifest).encode())
    return manifest


def _read_slices(path: str, dtype: str):
    """A function from slices of parts to their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(path)
        for batch in batches:
            for part in batch.to_pylist():
                yield from _documents(folder, part, dtype)

    return run


def _documents(folder: Folder, part: dict, dtype: str) -> Iterator[pa.RecordBatch]:
    name, low, high = part["name"], part["low"], min(part["low"] + SLICE_DOCS, part["docs"])
    offsets = folder.values(f"{name}.idx", "<u8", low, high + 1).astype(np.int64)
    keys = folder.values(f"{name}.doc", "<i8", low, high)
    nameless = np.arange(low, high) >= part["docs"] - part["without_id"]
    begin = 0
    while begin < len(keys):
        # as many documents as fit, one at least
        room = offsets[begin] + READ_BYTES // 4
        end = max(begin + 1, int(np.searchsorted(offsets, room, "right")) - 1)
        ids = folder.values(f"{name}.bin", dtype, int(offsets[begin]), int(offsets[end])).astype("<u4")
        data, at = ids.tobytes(), 4 * (offsets[begin : end + 1] - offsets[begin])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(keys[begin:end]), mask=nameless[begin:end]),
                pa.array(part["base"] + offsets[begin:end]),
                pa.array(np.diff(offsets[begin : end + 1])),
                pa.array([data[a:b] for a, b in zip(at, at[1:])], pa.binary()),
            ],
            names=["doc_id", "start", "n_tokens", "ids"],
        )
        begin = end


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a folder: doc_id, start (ids before it), n_tokens and ids.

    ``ids`` are little-endian unsigned 32-bit integers. Documents without an id
    have a null one.
    """
    manifest = json.loads(Folder(path).read("manifest.json"))
    schema = f"{PARTS}, base long"
    parts = spark.createDataFrame(
        [tuple(p[c] for c in ("number", "name", "docs", "ids", "without_id", "base")) for p in manifest["parts"]], schema
    )
    total = sum(p["ids"] for p in manifest["parts"])
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // READ_IDS))
    starts = F.sequence(F.lit(0).cast("long"), F.col("docs") - 1, F.lit(SLICE_DOCS).cast("long"))
    slices = parts.select("name", "docs", "without_id", "base", F.explode(starts).alias("low"))
    return slices.repartition(tasks).mapInArrow(
        _read_slices(path, manifest["dtype"]), "doc_id long, start long, n_tokens long, ids binary"
    )


class TokenFiles:
    """A folder of token files as one long sequence of ids, for a training loop."""

    def __init__(self, path: str):
        self.folder = Folder(path)
        manifest = json.loads(self.folder.read("manifest.json"))
        self.dtype, self.parts = manifest["dtype"], manifest["parts"]
        self.bases = [p["base"] for p in self.parts]
        self.first = list(accumulate([p["docs"] for p in self.parts], initial=0))
        self.n_docs = self.first[-1]

    def __len__(self) -> int:
        return self.parts[-1]["base"] + self.parts[-1]["ids"] if self.parts else 0

    def window(self, start: int, size: int) -> np.ndarray:
        """Ids [start, start + size) of the sequence, as far as it goes."""
        if start < 0:
            raise IndexError(start)
        found, end = [], min(start + size, len(self))
        at = max(0, bisect_right(self.bases, start) - 1)
        while start < end:
            part = self.parts[at]
            high = min(end, part["base"] + part["ids"])
            found.append(
                self.folder.values(f"{part['name']}.bin", self.dtype, start - part["base"], high - part["base"])
            )
            start, at = high, at + 1
        return np.concatenate(found) if found else np.empty(0, self.dtype)

    def document(self, n: int) -> np.ndarray:
        """Ids of the n-th document in order, with its end."""
        if not 0 <= n < self.n_docs:
            raise IndexError(n)
        at = bisect_right(self.first, n) - 1
        part, low = self.parts[at], n - self.first[at]
        begin, end = self.folder.values(f"{part['name']}.idx", "<u8", low, low + 2).tolist()
        return self.folder.values(f"{part['name']}.bin", self.dtype, begin, end)
