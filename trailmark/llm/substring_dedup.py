"""Repeated byte strings across documents, by prefix-free parsing.

A rolling hash of ``GRAM`` bytes marks triggers: of every string of ``length`` bytes the trigger is the leftmost ``GRAM`` bytes of
smallest hash in it, so equal strings have equal triggers at equal places, wherever they stand. The strings that share one
trigger follow each other; from the first one's start to the last one's end they make a phrase, and consecutive phrases
overlap so that no phrase is a prefix of a longer reading and every string lies in exactly one.

The parse is the list of phrases of each document, the dictionary has each distinct phrase once with the first document that
holds it. A phrase that stands in an earlier document goes as a whole. What is left are first occurrences whose trigger has
other phrases too: their suffixes of ``length`` bytes are brought together across the dictionary by hash, and those that an
earlier document has go as well. Ranges of neighbouring strings are tried before single ones: the bytes that all strings of a
range have must stand in two documents. Order beyond equal or not is never needed, so no full suffix array is kept.

Whole copies of an earlier text are set apart first. The other texts are gathered in chunks, and every step is a round of
question and answer: a chunk sends its distinct keys to buckets of equal hashes, a bucket sends back a bit or two for each key, in
the order they came, and the chunk keeps the stretches of its texts whose strings are still searched for. The answers are exact
whatever the size of the corpus, a chunk shrinks from round to round, and nothing but bitmaps of documents goes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, let_go, materialize
from .common import map_batches, whole_text

LENGTH = 50
GRAM = 16
BITMAP_BITS = 27  # 16 MB at most, whatever the corpus is
_SPARSE = 8  # a bitmap is as small as leaves one bit in 2 ** 8 set
_CHUNK = 1 << 21  # bytes of texts in a chunk, if no text is longer
_PIECE = 1 << 16  # bytes parsed at a time, if the strings are not very long; the arrays stay in a core's cache
_KEY_BITS = 40
_BUCKET_BITS = 6  # at least
_BUCKET = 1 << 25  # bytes of texts for each bucket
_LARGE = 1 << 26  # bytes of texts whose shuffles are not kept between rounds
_GATES = (4, 12)  # ranges that the strings of a phrase are tried in, before each is tried alone

_ORDER = ["own_id", "text_hash"]


def _piece(length: int) -> int:
    return max(_PIECE, 1 << (4 * length).bit_length())


def _triggers(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``GRAM`` bytes at each place, and the trigger's place for the string of ``length`` bytes at each place."""
    words = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    hashes = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(32)
    hashes += words[8:]
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0x94D049BB133111EB)
    hashes ^= hashes >> np.uint64(32)
    least = (hashes >> np.uint64(32)).astype(np.uint32)
    places = np.uint32(_piece(length) - 1)
    least &= ~places
    least |= np.arange(len(hashes), dtype=np.uint32)
    width, size = length - GRAM + 1, 1
    while size * 2 <= width:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    return hashes, (least & places).astype(np.int64)


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Texts joined up to ``_piece(length)`` bytes, with ``(row, offset in the text, bytes)`` of each part; longer texts are cut so that
    every string of ``length`` bytes is whole in exactly one part."""
    piece, parts, joined, total = _piece(length), [], [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(len(text) - length + 1, 0), piece // 2):
            part = text[start : start + piece // 2 + length - 1]
            if total + len(part) > piece:
                yield b"".join(joined), parts
                parts, joined, total = [], [], 0
            parts.append((row, start, len(part)))
            joined.append(part)
            total += len(part)
    if parts:
        yield b"".join(joined), parts


def phrases(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple]:
    """``(data, row, start, count, offset in data, trigger hash, trigger offset in data)`` as arrays: each phrase covers ``count``
    strings from ``start``."""
    for data, parts in _pieces(texts, length):
        hashes, trigger = _triggers(data, length)
        row, offset, size = (np.array(x, np.int64) for x in zip(*parts))
        ends = np.cumsum(size)
        part = np.repeat(np.arange(len(parts)), size)[: len(trigger)]
        trigger[np.arange(len(trigger)) + length > ends[part]] = -1  # the string would leave its text
        turns = np.flatnonzero(np.diff(trigger, prepend=-2))
        counts = np.diff(np.append(turns, len(trigger)))
        real = trigger[turns] >= 0
        at, counts = turns[real], counts[real]
        mark = trigger[at]
        key = hashes[mark]
        yield data, row[part[at]], offset[part[at]] + at - (ends - size)[part[at]], counts, at, key.view(np.int64), mark


def _texts(docs: DataFrame) -> DataFrame:
    return whole_text(docs).select("doc_id", F.coalesce("doc_id", F.lit(-(2**63))).alias("own_id"), F.xxhash64("text").alias("text_hash"), "text")


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A bit for the leading bits of every key; at most ``2 ** BITMAP_BITS`` bits come to the driver, and fewer are kept of few keys."""
    slots = keys.select(F.shiftrightunsigned(column, 64 - BITMAP_BITS).alias("slot"))
    words = slots.select(F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, int(slot & 63))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    return _packed_bits(found["word"].to_numpy(), found["bits"].to_numpy().view(np.uint64))


def _packed_bits(word: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """A bitmap from its words that are not zero. Neighbouring bits of a sparse one are put together."""
    size = min(max(int(np.bitwise_count(bits).sum()).bit_length() + _SPARSE, 6), BITMAP_BITS)
    bitmap = np.zeros(1 << (size - 6), np.uint64)
    if size == BITMAP_BITS:
        bitmap[word] = bits
        return bitmap
    row, place = np.nonzero(np.unpackbits(bits.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64))
    slot = (word[row] << 6 | place) >> (BITMAP_BITS - size)
    np.bitwise_or.at(bitmap, slot >> 6, np.uint64(1) << (slot & 63).astype(np.uint64))
    return bitmap


def _shift(bitmap: np.ndarray) -> int:
    """How far a key of 64 bits is shifted to its bit."""
    return 59 - len(bitmap).bit_length()


def _are_set(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys >> np.uint64(_shift(bitmap))
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _has(bitmap, column: Column) -> Column:
    """Whether a key may be in the bitmap, as a filter on rows with texts."""

    @F.pandas_udf("boolean")
    def has(keys):
        import pandas as pd

        return pd.Series(_are_set(bitmap.value, keys.to_numpy().view(np.uint64)))

    return has(column)


def _once(texts: DataFrame, broadcast) -> DataFrame:
    """One row of each ``own_id`` and text. Only rows whose key may occur again are shuffled."""
    named = F.xxhash64(*_ORDER)
    again = texts.select(*_ORDER).groupBy(*_ORDER).agg(F.count("*").alias("n")).where("n > 1")
    flagged = texts.withColumn("again", _has(broadcast(_bitmap(again.select(named.alias("key")), "key")), named))
    return flagged.where(~F.col("again")).unionByName(flagged.where("again").dropDuplicates(_ORDER)).drop("again")


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where sorted columns differ from the row before."""
    changed = np.zeros(len(columns[0]), bool)
    changed[:1] = True
    for column in columns:
        changed[1:] |= column[1:] != column[:-1]
    return changed


def _hash(data: bytes, starts: np.ndarray, size: int, seed: int) -> np.ndarray:
    """64 bits by the ``size`` bytes at each of ``starts``."""
    words = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    found = np.full(len(starts), seed * 0x2545F4914F6CDD1D + size & (1 << 64) - 1, np.uint64)
    for offset in [*range(0, size - 8, 8), size - 8]:
        found ^= words[starts + offset]
        found *= np.uint64(0x9E3779B97F4A7C15 if seed % 2 else 0xD6E8FEB86659FD93)
        found ^= found >> np.uint64(29)
        found *= np.uint64(0xBF58476D1CE4E5B9 if seed % 2 else 0xA0761D6478BD642F)
        found ^= found >> np.uint64(32)
    return found


def _phrase_hash(data: bytes, at: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """A phrase has at most twice ``length`` bytes, so its first and its last string cover it."""
    return _mixed(_hash(data, at, length, 3), _hash(data, at + counts - 1, length, 4), counts.astype(np.uint64))


def _mixed(*values: np.ndarray) -> np.ndarray:
    found = np.zeros(len(values[0]), np.uint64)
    for value in values:
        found = (found ^ value.view(np.uint64)) * np.uint64(0x94D049BB133111EB)
        found ^= found >> np.uint64(31)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        found ^= found >> np.uint64(32)
    return found


def _merge(row: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings in order, those that follow each other in a row as one."""
    turns = np.ones(len(row), bool)
    turns[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + count[:-1])
    first = np.flatnonzero(turns)
    return row[first], start[first], np.add.reduceat(count, first) if len(first) else count


class _Chunk:
    """Stretches of texts that hold the strings still searched for, and the ``(text, start, size)`` that the texts lose so far."""

    SCHEMA = "chunk long, octets long, own_id binary, text_hash binary, text binary, start binary, size binary, data binary, lost binary"
    KINDS = {"own_id": "<i8", "text_hash": "<i8", "text": "<i4", "start": "<i4", "size": "<i4", "lost": "<i8"}

    def __init__(self, chunk: int, data: bytes, **columns: np.ndarray):
        self.chunk, self.data, self.columns = chunk, data, columns
        self.own_id, self.text, self.start, self.size = (columns[name] for name in ("own_id", "text", "start", "size"))

    @classmethod
    def read(cls, table: pa.Table | pa.RecordBatch) -> _Chunk:
        """From the only row of ``table``."""
        columns = {name: np.frombuffer(table[name][0].as_buffer(), kind) for name, kind in cls.KINDS.items()}
        octets = table["octets"][0].as_py()
        data = pa.decompress(table["data"][0].as_buffer(), octets, "zstd", asbytes=True) if octets else b""
        return cls(table["chunk"][0].as_py(), data, **columns)

    def written(self) -> pa.RecordBatch:
        packed = pa.compress(self.data, "zstd", asbytes=True) if self.data else b""
        raw = {name: np.ascontiguousarray(self.columns[name].astype(kind)).tobytes() for name, kind in self.KINDS.items()}
        values = {"chunk": self.chunk, "octets": len(self.data), **raw, "data": packed}
        names = [field.split()[0] for field in self.SCHEMA.split(", ")]
        return pa.record_batch([pa.array([values[n]], pa.int64() if n in ("chunk", "octets") else pa.binary()) for n in names], names=names)

    def stretches(self) -> list[bytes]:
        ends = np.cumsum(self.size, dtype=np.int64)
        return [self.data[a:b] for a, b in zip((ends - self.size).tolist(), ends.tolist())]

    def narrowed(self, length: int, row: np.ndarray, start: np.ndarray, count: np.ndarray, kept: np.ndarray, gone: np.ndarray) -> _Chunk:
        """With the runs of ``count`` strings that are ``kept``; those that are ``gone`` are lost."""
        old, columns = self.stretches(), dict(self.columns)
        at, first, n = _merge(row[gone], start[gone], count[gone])
        columns["lost"] = np.concatenate([columns["lost"], np.stack([self.text[at], self.start[at] + first, n + length - 1], 1).ravel().astype("<i8")])
        at, first, n = _merge(row[kept], start[kept], count[kept])
        columns |= {"text": self.text[at], "start": self.start[at] + first, "size": n + length - 1}
        data = b"".join([old[r][a : a + z] for r, a, z in zip(at.tolist(), first.tolist(), columns["size"].tolist())])
        return _Chunk(self.chunk, data, **columns)

    def losses(self) -> pa.RecordBatch:
        """A row for each text that loses something."""
        text, start, size = self.columns["lost"].reshape(-1, 3).T
        order = np.argsort(text, kind="stable")
        first = np.flatnonzero(_new(text[order]))
        pairs = pa.StructArray.from_arrays([pa.array(start[order]), pa.array(size[order])], names=["start", "size"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(text)).astype(np.int32)), pairs)
        own = [pa.array(self.columns[name][text[order][first]]) for name in _ORDER]
        return pa.record_batch([*own, lists], names=[*_ORDER, "lost"])


def _chunks(texts: DataFrame, length: int) -> DataFrame:
    """Texts of at least ``length`` bytes, ``_CHUNK`` bytes a row."""

    def chunk(number: int, rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        own_id, text_hash, found = zip(*rows)
        size = np.array([len(text) for text in found])
        columns = {"own_id": np.array(own_id, np.int64), "text_hash": np.array(text_hash, np.int64), "text": np.arange(len(rows)), "size": size}
        return _Chunk(number, b"".join(found), **columns, start=np.zeros(len(rows), np.int64), lost=np.zeros(0, np.int64)).written()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, octets = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for row in zip(batch["own_id"].to_pylist(), batch["text_hash"].to_pylist(), batch["text"].cast(pa.binary())):
                text = row[2].as_py()
                if len(text) < length:
                    continue
                if rows and octets + len(text) > _CHUNK:
                    yield chunk(number, rows)
                    number, rows, octets = number + 1, [], 0
                rows.append((row[0], row[1], text))
                octets += len(text)
        if rows:
            yield chunk(number, rows)

    return texts.mapInArrow(run, _Chunk.SCHEMA)


# What is asked about a chunk: the row, start and count of runs of strings, a key of 40 bits for each, and what else makes two alike
# if an earlier document is searched for (64 bits), not just another one.


def _joined(found: list[tuple], kinds: tuple) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate([np.zeros(0, kind), *columns]) for kind, columns in zip(kinds, zip(*found) if found else [()] * len(kinds)))


def _short(*values: np.ndarray) -> np.ndarray:
    return _mixed(*values) >> np.uint64(64 - _KEY_BITS)


_RUNS = (np.int64, np.int64, np.int64)


def _by_trigger(chunk: _Chunk, length: int) -> tuple:
    return *_joined([(row, start, count, _short(key)) for _, row, start, count, _, key, _ in phrases(chunk.stretches(), length)], (*_RUNS, np.uint64)), None


def _by_phrase(chunk: _Chunk, length: int) -> tuple:
    found = [(row, start, count, _short(key), _phrase_hash(data, at, count, length)) for data, row, start, count, at, key, _ in phrases(chunk.stretches(), length)]
    return _joined(found, (*_RUNS, np.uint64, np.uint64))


def _by_range(parts: int) -> Callable[[_Chunk, int], tuple]:
    """The strings of a phrase in ``parts`` ranges, by how far they begin before the trigger, and the bytes that all of a range have."""

    def asked(chunk: _Chunk, length: int) -> tuple:
        width, found = length - GRAM + 1, []
        edges = sorted({width * i // parts for i in range(parts + 1)})
        for data, row, start, count, at, _, mark in phrases(chunk.stretches(), length):
            before, runs = mark - at, []
            for low, high in zip(edges[-2::-1], edges[:0:-1]):
                begin, end = np.maximum(before - high + 1, 0), np.minimum(before - low + 1, count)
                some = np.flatnonzero(begin < end)
                core = _hash(data, mark[some] - low, length - (high - low - 1), 64 * parts + 2 * low + 1)
                runs.append((some, row[some], start[some] + begin[some], (end - begin)[some], _short(core)))
            phrase, *columns = _joined(runs, (np.int64, *_RUNS, np.uint64))
            order = np.argsort(phrase, kind="stable")
            found.append(tuple(column[order] for column in columns))
        return *_joined(found, (*_RUNS, np.uint64)), None

    return asked


def _by_string(chunk: _Chunk, length: int) -> tuple:
    counts, ends = chunk.size.astype(np.int64) - length + 1, np.cumsum(chunk.size, dtype=np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    both = (_hash(chunk.data + bytes(8), (ends - chunk.size)[row] + start, length, seed) for seed in (1, 2))
    return row, start, np.ones(len(row), np.int64), _short(next(both)), next(both)


class _Asked:
    """The distinct keys of a chunk, in order, with the smallest id that has them."""

    def __init__(self, chunk: _Chunk, asked: Callable[[_Chunk, int], tuple], length: int):
        self.row, self.start, self.count, key, more = asked(chunk, length)
        self.owner, self.exact = chunk.own_id[chunk.text[self.row]], more is not None
        if self.exact:
            order = np.lexsort((self.owner, more, key))
            first = _new(key[order], more[order])
            self.more = more[order][first]
        else:  # keys and ranks of the ids in one word are sorted faster
            ids, rank = np.unique(chunk.own_id, return_inverse=True)
            rank = rank[chunk.text[self.row]].astype(np.uint64)
            if len(ids) < 1 << 64 - _KEY_BITS:
                order = np.argsort(key << np.uint64(64 - _KEY_BITS) | rank)
            else:
                order = np.lexsort((rank, key))
            first = _new(key[order])
        self.key, owner = key[order][first], self.owner[order]
        turns = np.flatnonzero(first)
        self.least, self.most = owner[turns], owner[np.append(turns[1:], len(owner))[: len(turns)] - 1]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(first) - 1

    def buckets(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets that are asked, and where the keys of each end."""
        bucket = (self.key >> np.uint64(_KEY_BITS - bits)).astype(np.int32)
        ends = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True)[: len(bucket)]) + 1
        return bucket[ends - 1], ends

    def dealt(self, chunk: int, bits: int) -> pa.RecordBatch:
        """Columns as raw bytes, one row for each bucket."""
        bucket, ends = self.buckets(bits)

        def raw(column: np.ndarray, size: int) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer((np.append(0, ends) * size).astype(np.int32)), pa.py_buffer(column.tobytes())])

        columns = {"bucket": pa.array(bucket), "chunk": pa.array(np.full(len(bucket), chunk, np.int64)), "keys": raw(self.key.view(np.uint8).reshape(-1, 8)[:, :5], 5)}
        if self.exact:  # ids as what they are above the smallest, in as few bytes as that takes
            base = self.least.min(initial=2**63 - 1)
            above = self.least.view(np.uint64) - base.view(np.uint64)
            size = next(n for n in (1, 2, 4, 8) if int(above.max(initial=0)) < 1 << 8 * n)
            columns |= {"more": raw(self.more, 8), "base": pa.array(np.full(len(bucket), base, np.int64)), "above": raw(above.astype(f"<u{size}"), size)}
        return pa.record_batch(list(columns.values()), names=list(columns))

    def answered(self, answers: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Which runs are still searched for, and which stand in an earlier document."""
        bucket, ends = self.buckets(bits)
        answers = answers.sort_by("bucket")
        per_key = 1 + self.exact
        sizes = np.diff(ends, prepend=0) * per_key
        if not np.array_equal(answers["bucket"].to_numpy(), bucket) or [len(x) for x in answers["bits"].to_pylist()] != ((sizes + 7) // 8).tolist():
            raise RuntimeError("answers of other keys than were asked for")
        bit = np.unpackbits(np.frombuffer(b"".join(answers["bits"].to_pylist()), np.uint8))[_aligned(sizes)].astype(bool)
        if not self.exact:
            return (bit | (self.least < self.most))[self.place], np.zeros(len(self.place), bool)
        earlier = bit[::2][self.place] | (self.owner > self.least[self.place])
        return ~earlier & bit[1::2][self.place], earlier


_DEALT = ("bucket int, chunk long, keys binary", "bucket int, chunk long, keys binary, more binary, base long, above binary")


def _aligned(sizes: np.ndarray) -> np.ndarray:
    """Places of so many bits in a row each, if every row begins with a byte."""
    whole = (sizes + 7) // 8 * 8
    return np.arange(sizes.sum()) + np.repeat(np.cumsum(whole) - whole - (np.cumsum(sizes) - sizes), sizes)


def _judged(table: pa.Table) -> pa.Table:
    """For the keys of a bucket, whether they stand more than once; or whether an earlier id has the same key and ``more``, and
    whether the key has another ``more``. Of one id in two chunks, a key counts twice."""
    raw = table["keys"].to_pylist()
    sizes = np.array([len(keys) // 5 for keys in raw])
    keys = np.zeros((sizes.sum(), 8), np.uint8)
    keys[:, :5] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, 5)
    keys = keys.reshape(-1).view("<u8")
    if "more" in table.column_names:
        more = np.frombuffer(b"".join(table["more"].to_pylist()), "<u8")
        parts = zip(table["above"].to_pylist(), sizes.tolist(), table["base"].to_pylist())
        owner = np.concatenate([np.frombuffer(above, f"<u{len(above) // n}").astype(np.uint64) + np.uint64(base % 2**64) for above, n, base in parts]).view(np.int64)
        order = np.lexsort((owner, more, keys))
        key, owner = keys[order], owner[order]
        other, first = _new(key), _new(key, more[order])
        alike = np.cumsum(other) - 1
        bits = np.zeros((len(keys), 2), bool)
        bits[order, 0] = owner > owner[first][np.cumsum(first) - 1]
        bits[order, 1] = np.bincount(alike, first)[alike] > 1
    else:
        order = np.argsort(keys)
        again = keys[order][1:] == keys[order][:-1]
        bits = np.zeros((len(keys), 1), bool)
        bits[order, 0] = np.append(again, False) | np.append(False, again)
    sizes = sizes * bits.shape[1]
    ends = np.cumsum((sizes + 7) // 8)
    packed = np.zeros(8 * ends[-1], bool)
    packed[_aligned(sizes)] = bits.reshape(-1)
    offsets = np.append(0, ends).astype(np.int32)
    bits = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.packbits(packed))])
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "bits": bits})


def _round(chunks: DataFrame, asked: Callable[[_Chunk, int], tuple], length: int, exact: bool, octets: int) -> DataFrame:
    """Chunks with what is left after all buckets have answered; ``chunks``, of texts of so many bytes, is discarded."""
    bits = max(_BUCKET_BITS, (octets // _BUCKET).bit_length())

    def ask(batch: pa.RecordBatch) -> pa.RecordBatch:
        chunk = _Chunk.read(batch)
        return _Asked(chunk, asked, length).dealt(chunk.chunk, bits)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk.read(left)
        found = _Asked(chunk, asked, length)
        return pa.Table.from_batches([chunk.narrowed(length, found.row, found.start, found.count, *found.answered(right, bits)).written()])

    dealt = map_batches(chunks, ask, _DEALT[exact], 1)
    answers = materialize(dealt.groupBy("bucket").applyInArrow(_judged, "chunk long, bucket int, bits binary"), "answers")
    if octets > _LARGE:
        let_go()
    left = materialize(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(answer, _Chunk.SCHEMA), "chunks")
    discard(chunks, answers)
    if octets > _LARGE:
        let_go()
    return left


def spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``own_id, text_hash, start, size``: stretches to remove; together they cover exactly the repeated strings. They overlap."""
    return _spans(docs, length)[0].select(*_ORDER, F.inline("lost"))


def _spans(docs: DataFrame, length: int) -> tuple[DataFrame, Callable[[], None]]:
    """The rows of ``spans`` as a list for each text, and what lets go of all that they are made of."""
    context, held = docs.sparkSession.sparkContext, []

    def broadcast(bitmap: np.ndarray):
        held.append(context.broadcast(bitmap))
        return held[-1]

    def free(*frames: DataFrame) -> None:
        # each bitmap is a file of the driver and of every executor
        while held:
            held.pop().destroy()
        discard(*frames)
        let_go()

    texts = _texts(docs)
    named = F.xxhash64(*_ORDER)

    # a text that an earlier document has goes as a whole; only the others are parsed
    sized = texts.select(*_ORDER, F.xxhash64(F.lit(3), "text").alias("more"), F.octet_length("text").cast("long").alias("size"))
    firsts = sized.groupBy("text_hash", "more").agg(F.min("own_id").alias("first"))
    copies = materialize(sized.join(firsts, ["text_hash", "more"]).where("own_id > first").select(*_ORDER, "size").distinct(), "copies")
    maybe = _has(broadcast(_bitmap(copies.select(named.alias("key")), "key")), named)
    flagged = texts.withColumn("maybe", maybe)
    texts = flagged.where(~F.col("maybe")).unionByName(flagged.where("maybe").join(copies, _ORDER, "left_anti")).drop("maybe")
    chunks = materialize(_chunks(_once(texts, broadcast).select(*_ORDER, "text"), length), "chunks")
    free()

    octets = chunks.agg(F.sum("octets")).first()[0] or 0

    # triggers of two documents; the dictionary: phrases of an earlier document go, first ones whose trigger has others stay open
    chunks = _round(chunks, _by_trigger, length, False, octets)
    chunks = _round(chunks, _by_phrase, length, True, octets)
    # string by string, if other documents have what neighbouring strings share
    for parts in _GATES:
        chunks = _round(chunks, _by_range(parts), length, False, octets)
    chunks = _round(chunks, _by_string, length, True, octets)

    losses = map_batches(chunks, lambda batch: _Chunk.read(batch).losses(), "own_id long, text_hash long, lost array<struct<start:long,size:long>>", 1)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), "size")).alias("lost")
    return copies.where(F.col("size") >= length).select(*_ORDER, whole).unionByName(losses), lambda: free(copies, chunks)


def _is_set(bits: np.ndarray, key: int) -> bool:
    slot = (key & (1 << 64) - 1) >> _shift(bits)
    return bool(int(bits[slot >> 6]) >> (slot & 63) & 1)


def cut(text: bytes, found: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without the stretches ``(start, size)``, and the maximal removed runs ``(start, end)``."""
    runs: list[list[int]] = []
    for start, size in sorted(found):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], start + size)
        else:
            runs.append([start, start + size])
    kept, at = [], 0
    for start, end in runs:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]]), [tuple(run) for run in runs]


def _merged(lost: pa.ListArray, sizes: list[int]) -> list[list[tuple[int, int]]]:
    """For each text of so many bytes, the runs ``(start, size)`` that its stretches make."""
    per_row = lost.value_lengths().fill_null(0).to_numpy()
    start, size = (field.to_numpy() for field in lost.flatten().flatten())
    base = np.cumsum([0, *sizes]) + np.arange(len(sizes) + 1)  # a byte between texts keeps their runs apart
    at = start + np.repeat(base[:-1], per_row)
    order = np.argsort(at)
    at, reach = at[order], np.maximum.accumulate((at + size)[order])
    turns = np.flatnonzero(np.append(True, at[1:] > reach[:-1])[: len(at)])
    low, high = at[turns], reach[np.append(turns[1:], len(at))[: len(turns)] - 1]
    row = np.searchsorted(base, low, "right") - 1
    edges = np.searchsorted(row, np.arange(len(sizes) + 1)).tolist()
    runs = list(zip((low - base[row]).tolist(), (high - low).tolist()))
    return [runs[a:b] for a, b in zip(edges, edges[1:])]


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, size in bytes, bytes and runs removed, and the bytes kept.

    A byte goes if a string of ``length`` bytes over it also starts in a document of smaller ``doc_id``; strings are judged on the
    input. Documents of one ``doc_id`` are not earlier than each other; a null ``doc_id`` is earlier than all others. Null texts
    are empty; texts shorter than ``length`` keep all their bytes. Kept bytes need not be valid UTF-8.
    """
    if length < GRAM + 8:
        raise ValueError(f"strings of at least {GRAM + 8} bytes")
    texts = _texts(docs)
    found, free = _spans(docs, length)
    lost = materialize(found, "spans")
    free()
    named = F.xxhash64(*_ORDER)
    concerned = docs.sparkSession.sparkContext.broadcast(_bitmap(lost.select(named.alias("key")), "key"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, texts = [], _bytes(batch)
        for text, stretches in zip(texts, _merged(batch.column("lost"), [len(text) for text in texts])):
            kept, runs = cut(text, stretches)
            rows.append((len(text), len(text) - len(kept), len(runs), kept))
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.record_batch([batch.column("doc_id"), *arrays], names=[c.split()[0] for c in SCHEMA.split(", ")])

    flagged = texts.withColumn("some", _has(concerned, named))
    none = F.lit(None).cast("array<struct<start:long,size:long>>")
    touched = flagged.where("some").join(lost, _ORDER, "left").select("doc_id", "text", "lost")
    return map_batches(flagged.where(~F.col("some")).select("doc_id", "text", none.alias("lost")).unionByName(touched), run, SCHEMA)

