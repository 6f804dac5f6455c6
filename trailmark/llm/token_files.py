"""Token ids of a corpus in binary files of patched frame-of-reference blocks, as a Spark data source.

A file holds whole documents one after the other, without padding between them:

    magic | blocks | document ids, null flags, lengths | block index | footer

A block has 1,024 ids: its minimum, the width at which nine tenths of the differences to it fit, all differences packed at that
width, and a list of places and differences for those that do not fit. The index has the place of every block, so that a reader
can begin anywhere. A folder holds one file for each task that wrote rows and a manifest that names the files in order.

Files become part of a folder only when the driver commits the manifest, so tasks may be repeated: what a lost or doubled attempt
has written is never read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import whole_text

BLOCK = 1024
PERCENTILE = 0.9
MAGIC = b"PFORBLK1"
MANIFEST = "manifest.json"
SPLIT_IDS = 4 << 20
BATCH_IDS = 1 << 20
MAX_WORDS = 600_000
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"

_HEADER = struct.Struct("<IBHH")  # minimum, width, ids, exceptions
_FOOTER = struct.Struct("<qqqqq8s")  # ids, documents, blocks, place of the documents, place of the index, magic


# -- blocks -------------------------------------------------------------------------------------------------------


def pack(values: np.ndarray) -> list[bytes]:
    """``values`` (unsigned 32-bit) as blocks; only the last one may hold fewer than ``BLOCK``."""
    if not len(values):
        return []
    n_blocks = -(-len(values) // BLOCK)
    sizes = np.full(n_blocks, BLOCK)
    sizes[-1] = len(values) - BLOCK * (n_blocks - 1)
    grid = np.concatenate([values, np.full(n_blocks * BLOCK - len(values), values[-1], np.uint32)]).reshape(n_blocks, BLOCK)
    least = grid.min(axis=1)
    over = grid - least[:, None]
    nth = int(PERCENTILE * (BLOCK - 1))
    widths = np.frexp(np.partition(over, nth, axis=1)[:, nth].astype(np.float64))[1]  # bits of the percentile
    exceeds = over.astype(np.uint64) >> widths[:, None].astype(np.uint64) != 0
    exceeds[-1, sizes[-1] :] = False
    fitting = np.where(exceeds, 0, over).astype("<u4")
    packed: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        for some in np.array_split(rows, -(-len(rows) // 256)):
            bits = np.unpackbits(fitting[some].view(np.uint8).reshape(len(some), BLOCK, 4), axis=2, bitorder="little")[:, :, :width]
            for row, data in zip(some.tolist(), np.packbits(bits.reshape(len(some), -1), axis=1, bitorder="little"), strict=True):
                packed[row] = data.tobytes()
    blocks = []
    for row in range(n_blocks):
        places = np.flatnonzero(exceeds[row])
        head = _HEADER.pack(int(least[row]), int(widths[row]), int(sizes[row]), len(places))
        blocks.append(b"".join([head, packed[row], places.astype("<u2").tobytes(), over[row, places].astype("<u4").tobytes()]))
    return blocks


def unpack(block: bytes) -> np.ndarray:
    least, width, size, n_exceptions = _HEADER.unpack_from(block)
    at = _HEADER.size
    values = np.zeros((BLOCK, 32), np.uint8)
    n_bytes = BLOCK * width // 8
    values[:, :width] = np.unpackbits(np.frombuffer(block, np.uint8, n_bytes, at), bitorder="little").reshape(BLOCK, width)
    over = np.packbits(values, axis=1, bitorder="little").view("<u4").ravel()
    at += n_bytes
    places = np.frombuffer(block, "<u2", n_exceptions, at)
    over[places] = np.frombuffer(block, "<u4", n_exceptions, at + 2 * n_exceptions)
    return (over + np.uint32(least))[:size]


# -- files --------------------------------------------------------------------------------------------------------

# file systems that executors open by themselves, by URI scheme
_SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs"}


def _place(path: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    if not colon:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES[scheme]}:{rest}")


class FileWriter:
    """A file of documents; only a block of ids and 13 bytes per document are held in memory."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0
        self.blocks, self.doc_ids, self.lengths = [0], [], []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.put(MAGIC)
        self.blocks = [self.at]

    def put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_ids: list[int | None], ids: list[bytes]) -> None:
        self.doc_ids += doc_ids
        self.lengths += [len(x) // 4 for x in ids]
        self.waiting.append(np.frombuffer(b"".join(ids), "<u4"))
        self.n_waiting += len(self.waiting[-1])
        if self.n_waiting >= 256 * BLOCK:
            values = np.concatenate(self.waiting)
            whole = len(values) // BLOCK * BLOCK
            self.flush(values[:whole])
            self.waiting, self.n_waiting = [values[whole:]], len(values) - whole

    def flush(self, values: np.ndarray) -> None:
        for block in pack(values):
            self.put(block)
            self.blocks.append(self.at)

    def close(self) -> None:
        if self.n_waiting:
            self.flush(np.concatenate(self.waiting))
        documents = self.at
        missing = np.array([i is None for i in self.doc_ids], bool)
        self.put(np.array([i or 0 for i in self.doc_ids], "<i8").tobytes())
        self.put(np.packbits(missing).tobytes())
        self.put(np.array(self.lengths, "<u4").tobytes())
        index = self.at
        self.put(np.array(self.blocks, "<i8").tobytes())
        self.put(_FOOTER.pack(sum(self.lengths), len(self.doc_ids), len(self.blocks) - 1, documents, index, MAGIC))


class FileReader:
    """Documents of a file, from anywhere in it."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        self.n_ids, self.n_docs, n_blocks, documents, index, magic = _FOOTER.unpack(file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a file of token blocks")
        self.blocks = np.frombuffer(file.read_at(8 * (n_blocks + 1), index), "<i8")
        data, flags = file.read_at(index - documents, documents), 8 * self.n_docs
        self.doc_ids = np.frombuffer(data, "<i8", self.n_docs)
        lengths_at = flags + -(-self.n_docs // 8)
        self.missing = np.unpackbits(np.frombuffer(data, np.uint8, lengths_at - flags, flags), count=self.n_docs).astype(bool)
        self.ends = np.cumsum(np.frombuffer(data, "<u4", self.n_docs, lengths_at), dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]) if self.n_docs else self.ends

    def ids(self, low: int, high: int) -> np.ndarray:
        """Ids from ``low`` to before ``high``, out of the blocks that hold them."""
        if low >= high:
            return np.zeros(0, "<u4")
        first, last = low // BLOCK, (high - 1) // BLOCK
        begin = self.blocks[first]
        data = self.file.read_at(int(self.blocks[last + 1] - begin), int(begin))
        places = (self.blocks[first : last + 2] - begin).tolist()
        values = np.concatenate([unpack(data[i:j]) for i, j in zip(places, places[1:], strict=False)])
        return values[low - first * BLOCK : high - first * BLOCK]

    def documents(self, low: int, high: int, offset: int, last: bool) -> Iterator[pa.RecordBatch]:
        """The documents that begin at ``low`` or later and before ``high``, some at a time; ``last``: those without ids at
        ``high`` too. ``offset`` is the number of ids before this file."""
        first, stop = np.searchsorted(self.starts, [low, high], "left")
        stop = self.n_docs if last else stop
        while first < stop:
            until = max(first + 1, min(stop, np.searchsorted(self.ends, self.starts[first] + BATCH_IDS, "right")))
            begin = int(self.starts[first])
            values = self.ids(begin, int(self.ends[until - 1])).astype("<u4").tobytes()
            starts, ends = self.starts[first:until], self.ends[first:until]
            cut = [values[4 * (i - begin) : 4 * (j - begin)] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.record_batch(
                [pa.array(self.doc_ids[first:until], pa.int64(), mask=self.missing[first:until]), pa.array(starts + offset), pa.array(ends - starts), pa.array(cut, pa.binary())],
                names=["doc_id", "start", "n_tokens", "ids"],
            )
            first = until


# -- the data source ----------------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    n_docs: int
    n_ids: int


@dataclass
class Slice(InputPartition):
    name: str
    low: int
    high: int
    offset: int
    last: bool


class BlockWriter(DataSourceArrowWriter):
    """Writes rows with ``ids``, or with ``text`` that is encoded by a vocabulary, both in their order."""

    def __init__(self, path: str, vocabulary: bytes = b"", end_id: int = 0):
        self.path, self.vocabulary, self.end_id = path.rstrip("/"), vocabulary, end_id

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part = TaskContext.get().partitionId()
        encoder = _encoder(self.vocabulary, self.end_id) if self.vocabulary else None
        name, out, stream = f"{part:06d}-{uuid.uuid4().hex}.pfor", None, None
        for batch in iterator:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                if out is None:
                    system, folder = _place(self.path)
                    system.create_dir(folder, recursive=True)
                    stream = system.open_output_stream(f"{folder}/{name}")
                    out = FileWriter(stream)
                ids = encoder.encode(rows.column("text").to_pylist()) if encoder else rows.column("ids").to_pylist()
                out.add(rows.column("doc_id").to_pylist(), ids)
        if out is None:
            return Written(part, "", 0, 0)
        out.close()
        stream.close()
        return Written(part, name, len(out.doc_ids), sum(out.lengths))

    def commit(self, messages: list[Written | None]) -> None:
        """Names the files, in the order of their tasks, with the number of ids before each."""
        files, offset = [], 0
        for m in sorted((m for m in messages if m and m.name), key=lambda m: m.part):
            files.append({"name": m.name, "n_docs": m.n_docs, "n_ids": m.n_ids, "offset": offset})
            offset += m.n_ids
        system, folder = _place(self.path)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{MANIFEST}") as stream:
            stream.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Without a manifest the files are never read."""


class BlockReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def partitions(self) -> list[Slice]:
        """Slices of the files by ids; a document belongs to the slice in which it begins."""
        system, folder = _place(self.path)
        with system.open_input_stream(f"{folder}/{MANIFEST}") as stream:
            files = json.loads(stream.read())
        found = []
        for f in files:
            limits = [*range(0, f["n_ids"], SPLIT_IDS), f["n_ids"]] if f["n_ids"] else [0, 0]
            cuts = list(zip(limits, limits[1:], strict=False))
            found += [Slice(f["name"], low, high, f["offset"], (low, high) == cuts[-1]) for low, high in cuts]
        return found or [Slice("", 0, 0, 0, True)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if partition.name:
            system, folder = _place(self.path)
            with system.open_input_file(f"{folder}/{partition.name}") as file:
                yield from FileReader(file).documents(partition.low, partition.high, partition.offset, partition.last)


class TokenBlocks(DataSource):
    """``spark.read.format("token_blocks").load(folder)``; rows are written with ``doc_id`` and ``ids``, in their order.

    With the options ``vocabulary`` (a file that the driver can open) and ``end_id``, rows have ``text`` instead of ``ids``.
    """

    @classmethod
    def name(cls) -> str:
        return "token_blocks"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> BlockReader:
        return BlockReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> BlockWriter:
        if "vocabulary" not in self.options:
            return BlockWriter(self.options["path"])
        with open(self.options["vocabulary"], "rb") as file:
            return BlockWriter(self.options["path"], file.read(), int(self.options["end_id"]))


# -- encoding -----------------------------------------------------------------------------------------------------


_MARKS = ",.;:!?"
_BESIDE = re.compile(r"[,.;:!?](?:(?<=[^A-Za-z0-9À-ÖØ-öø-ÿ \n\t\r][,.;:!?])|[^A-Za-z0-9À-ÖØ-öø-ÿ \n\t\r])")
_ALONE = re.compile(r"(?<=[A-Za-z0-9À-ÖØ-öø-ÿ \n\t\r])([,.;:!?])(?=[A-Za-z0-9À-ÖØ-öø-ÿ \n\t\r])")
_LETTERS = re.compile(r"[a-zß-öø-ÿ]+").fullmatch


def words_of(text: str) -> list[str]:
    """The words of a text, A-Z in lower case, and apart from them the marks that stand beside Latin letters, digits and blanks only.

    The tokenizer parts such marks from words, and lower-cases, itself; strings of special tokens stay as they are.
    """
    if "<|" not in text:
        text = text.encode().lower().decode()
    if _BESIDE.search(text):
        text = _ALONE.sub(r" \1 ", text)
    else:
        for mark in _MARKS:
            text = text.replace(mark, f" {mark} ")
    return text.replace("\n", " ").replace("\t", " ").split(" ")


class WordEncoder:
    """A tokenizer that drops white space between words: words are encoded apart, and remembered up to a bound."""

    def __init__(self, vocabulary: bytes, end_id: int):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        # words of small letters alone need neither the normalizer nor the pattern, and may come many in a text
        self.plain = Tokenizer.from_str(vocabulary.decode())
        self.plain.normalizer = normalizers.Sequence([])
        to_letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), to_letters])
        self.end = end_id.to_bytes(4, "little")
        self.known: dict[str, bytes] = {}

    def learn(self, new: set[str]) -> None:
        """Encode words that were not met before."""
        plain = list(filter(_LETTERS, new))
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        found = self.plain.encode_batch([" ".join(some) for some in groups], add_special_tokens=False)
        for some, encoded in zip(groups, found, strict=True):
            ends = (4 * np.searchsorted(encoded.word_ids, np.arange(len(some) + 1))).tolist()
            ids = np.array(encoded.ids, "<u4").tobytes()
            self.known.update((w, ids[i:j]) for w, i, j in zip(some, ends, ends[1:], strict=False))
        other = list(new.difference(plain))
        for word, encoded in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self.known[word] = np.array(encoded.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, the end id last, as little-endian unsigned 32-bit integers."""
        if len(self.known) > MAX_WORDS:
            self.known = {}
        words = [words_of(text) for text in texts]
        self.learn(set().union(*words).difference(self.known))
        get, end = self.known.__getitem__, self.end
        return [b"".join(map(get, some)) + end for some in words]


_made: dict[tuple[int, int], WordEncoder] = {}


def _encoder(vocabulary: bytes, end_id: int) -> WordEncoder:
    """The encoder of this Python process, with the words that it has met in earlier tasks."""
    key = (hash(vocabulary), end_id)
    if key not in _made:
        _made[key] = WordEncoder(vocabulary, end_id)
    return _made[key]


def in_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, range-partitioned and sorted by ``doc_id``, null first; rows of one id by a hash of their text.

    Rows alike in both are dealt out by their place in the input, so that any number of them spreads over partitions.
    """
    keyed = whole_text(docs).withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("doc_id"), F.asc("hash"), F.asc("place")]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Encode ``docs`` and write the ids to the folder ``path``, documents in ascending order of ``doc_id``.

    ``vocabulary`` is a tokenizer file whose tokenizer drops white space between words; each text gets ``end_id`` behind its ids.
    Strings of special tokens in a text become these tokens, as the library has it. Every row is a document, repeated rows too. Null and empty texts have the end id only; null ids stay null and come first;
    other columns don't matter; no rows give a folder without files.
    """
    docs.sparkSession.dataSource.register(TokenBlocks)
    in_order(docs).write.format("token_blocks").options(vocabulary=vocabulary, end_id=end_id).mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of a folder; ``start`` is the number of ids before it."""
    spark.dataSource.register(TokenBlocks)
    return spark.read.format("token_blocks").load(path)
