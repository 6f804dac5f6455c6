"""Benchmark passages in documents: SimHash of item-sized windows, a multi-index over Hamming blocks, exact verification.

For a benchmark item of L words, every window of L words of a document (the whole document, if it has fewer) that shares a
five-word shingle with the item gets a SimHash of its words; a window that shares none has similarity 0, so nothing is lost.
The items' fingerprints are indexed in four blocks of 16 bits: two fingerprints within ``RADIUS`` bits differ by at most a
quarter of that in one block, and the index holds every item under all block values that near, so it finds every fingerprint
within the radius. What it finds is verified exactly: sum of minima over sum of maxima of the shingle counts.

The benchmark is the query set. It is read in blocks of bounded size, each of which is broadcast and held against all
documents; documents are never shuffled.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, whole_text

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCKS, BLOCK_BITS = 4, 16
#: bounds of one broadcast block of the benchmark; a single longer item is a block of its own
BLOCK_ITEMS, BLOCK_CHARS = 1000, 8_000_000
_STARTS = 4096  # windows fingerprinted at a time

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(SHINGLE)], np.uint64)


def words_of(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters; A-Z in lower case."""
    return _WORD.findall(text.encode().lower())


def _word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(word) for word in words]), ">u8").astype(np.uint64)


def _shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """Of each five words; of all words, if there are fewer."""
    size = min(SHINGLE, len(hashes))
    if not size:
        return hashes
    count = len(hashes) - size + 1
    out = np.full(count, size, np.uint64)
    for i in range(size):
        out += hashes[i : i + count] * _POWERS[i]
    return out ^ (out >> np.uint64(29))


def shingles(words: list[bytes]) -> Counter:
    size = min(SHINGLE, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if size else Counter()


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two shingle counts."""
    shared = sum(min(n, b[s]) for s, n in a.items() if s in b)
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def window_fingerprints(hashes: np.ndarray, first: int, last: int, size: int) -> np.ndarray:
    """SimHash of the words of each window of ``size`` words that starts in ``first .. last``: a majority of set bits."""
    span = hashes[first : last + size]
    bits = np.unpackbits(span.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    sums = np.zeros((len(span) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = sums[size:] - sums[: len(span) - size + 1]
    return np.packbits(ones * 2 > size, axis=1).view(">u8").ravel().astype(np.uint64)


class Index:
    """A block of benchmark items: their shingles, and their fingerprints by Hamming blocks."""

    def __init__(self, texts: list[str], radius: int = RADIUS):
        self.words = [words_of(text) for text in texts]
        self.sizes = np.array([len(words) for words in self.words], np.int64)
        self.counts = [shingles(words) for words in self.words]
        self.radius = radius
        hashes = [_word_hashes(words) for words in self.words]
        owned = [_shingle_hashes(h) for h in hashes]
        self.shingle = np.concatenate([np.zeros(0, np.uint64), *owned])
        owner = np.repeat(np.arange(len(texts)), [len(h) for h in owned])
        order = np.argsort(self.shingle, kind="stable")
        self.shingle, self.owner = self.shingle[order], owner[order]
        self.fp = np.array([window_fingerprints(h, 0, 0, len(h))[0] if len(h) else 0 for h in hashes], np.uint64)
        self.tables = [self._table(self._block(self.fp, i)) for i in range(BLOCKS)]

    @staticmethod
    def _block(fps: np.ndarray, number: int) -> np.ndarray:
        return (fps >> np.uint64(number * BLOCK_BITS) & np.uint64(0xFFFF)).astype(np.int64)

    def _table(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items by every block value within a quarter of the radius: where a value's items begin, and the items."""
        masks = [sum(1 << bit for bit in chosen) for n in range(self.radius // BLOCKS + 1) for chosen in itertools.combinations(range(BLOCK_BITS), n)]
        keys = (values[:, None] ^ np.array(masks)[None, :]).ravel()
        items = np.repeat(np.arange(len(values)), len(masks))
        order = np.argsort(keys, kind="stable")
        return np.searchsorted(keys[order], np.arange((1 << BLOCK_BITS) + 1)), items[order]

    def near(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (position in ``fps``, item) within the radius."""
        found = []
        for number, (begins, items) in enumerate(self.tables):
            values = self._block(fps, number)
            counts = begins[values + 1] - begins[values]
            which = np.repeat(np.arange(len(fps)), counts)
            inside = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
            item = items[begins[values[which]] + inside]
            close = np.bitwise_count(fps[which] ^ self.fp[item]) <= self.radius
            found.append(which[close] * len(self.fp) + item[close])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.fp), pairs % len(self.fp)

    def matches(self, text: str, least: float) -> list[tuple[int, int, int, int, float]]:
        """``(item, start, n_words, distance, similarity)``: the best window of each item found, the first of equals."""
        words = words_of(text)
        if not words or not len(self.shingle):
            return []
        hashes = _word_hashes(words)
        own = _shingle_hashes(hashes)
        begins = np.searchsorted(self.shingle, own)
        hits = np.flatnonzero(self.shingle[np.minimum(begins, len(self.shingle) - 1)] == own)
        if not len(hits):
            return []
        ends = np.searchsorted(self.shingle, own[hits], side="right")
        counts = ends - begins[hits]
        where = np.repeat(hits, counts)
        items = self.owner[np.repeat(begins[hits], counts) + np.arange(len(where)) - np.repeat(np.cumsum(counts) - counts, counts)]
        best: dict[int, tuple] = {}
        for size in np.unique(self.sizes[items]).tolist():
            at = where[self.sizes[items] == size]
            for first, last in self._starts(at, min(size, len(words)), len(words)):
                self._windows(words, hashes, first, last, size, least, best)
        return [(item, start, n, distance, -score) for item, (score, start, n, distance) in sorted(best.items())]

    @staticmethod
    def _starts(at: np.ndarray, size: int, total: int) -> Iterator[tuple[int, int]]:
        """Runs of starts whose window holds the shingle at one of ``at``, in pieces of bounded length."""
        low = np.maximum(at - max(size - SHINGLE, 0), 0)
        high = np.minimum(at, total - size)
        first, last = None, None
        for a, b in zip(low.tolist(), high.tolist()):  # both ascend
            if first is None:
                first, last = a, b
            elif a <= last + 1:
                last = max(last, b)
            else:
                yield from ((i, min(i + _STARTS - 1, last)) for i in range(first, last + 1, _STARTS))
                first, last = a, b
        if first is not None:
            yield from ((i, min(i + _STARTS - 1, last)) for i in range(first, last + 1, _STARTS))

    def _windows(self, words, hashes, first: int, last: int, size: int, least: float, best: dict) -> None:
        n = min(size, len(words))
        fps = window_fingerprints(hashes, first, last, n)
        which, items = self.near(fps)
        right = self.sizes[items] == size
        for offset, item in zip(which[right].tolist(), items[right].tolist()):
            start = first + offset
            found = similarity(shingles(words[start : start + n]), self.counts[item])
            key = (-found, start, n, int(np.bitwise_count(fps[offset] ^ self.fp[item])))
            if found >= least and (item not in best or key < best[item]):
                best[item] = key


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    block, chars = [], 0
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    for item, text in items.toLocalIterator(prefetchPartitions=True):
        if block and (len(block) >= BLOCK_ITEMS or chars + len(text) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((item, text))
        chars += len(text)
    if block:
        yield block


SCHEMA = "doc_id long, text_hash long, item_id long, start_word long, n_words long, distance int, similarity double"


def matches(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs`` and benchmark item found in it, with the most similar window (the first of equals).

    Null and empty texts and items match nothing. Texts and items of fewer than five words have one shingle, all their words;
    so a short item is found only in a document that is just that. Repeated documents and items are reported each. An empty
    benchmark or table gives no rows; a null ``doc_id`` or ``item_id`` stays null.
    """
    spark = docs.sparkSession
    texts = whole_text(docs).withColumn("text_hash", F.xxhash64("text"))
    found = spark.createDataFrame([], SCHEMA)
    for block in _blocks(benchmark):
        spread, key = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batch: pa.RecordBatch, spread=spread, key=key) -> pa.RecordBatch:
            index, ids = _index(key, spread, radius)
            rows = [
                (doc, text_hash, ids[item], *rest)
                for doc, text_hash, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")))
                for item, *rest in index.matches(text, least)
            ]
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.float64()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in SCHEMA.split(", ")])

        found = found.unionByName(map_batches(texts, run, SCHEMA))
    return found


def without_matches(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark item is found."""
    for block in _blocks(benchmark):
        spread, key = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batch: pa.RecordBatch, spread=spread, key=key) -> pa.RecordBatch:
            index, _ = _index(key, spread, radius)
            return batch.filter(pa.array([not index.matches(text or "", least) for text in batch.column("text").to_pylist()], pa.bool_()))

        docs = map_batches(docs, run, docs.schema)
    return docs


_made: dict[str, tuple[Index, list]] = {}


def _index(key: str, spread, radius: int) -> tuple[Index, list]:
    """The index of a broadcast block, made once per Python worker; the latest is kept."""
    if key not in _made:
        _made.clear()
        _made[key] = Index([text for _, text in spread.value], radius), [item for item, _ in spread.value]
    return _made[key]
