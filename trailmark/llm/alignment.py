"""Alignment of two tokenizations of the same texts.

Tokens of tokenizer A and of tokenizer B end at byte offsets of the text; offsets where both end cut the tokens into groups. A
stretch of the text gives a *fragment*: the tokens up to its first common end (open to the left), the closed groups after it,
and the tokens after its last common end (open to the right). Fragments of neighbouring stretches compose, associatively, so a
text can be cut anywhere: texts beyond ``range_bytes`` are cut into byte ranges which go to tasks of their own, and their
fragments are reduced over a tree, eight at a time.

Both tokenizers split a text at a blank or line break between two visible characters, whatever stands around it; ``cuts`` finds
these places. What lies between two of them is a piece. A piece is tokenized apart, and each distinct piece of a batch once.

The two tokens that end a group end together: they are a link. How often a pair of ids is linked in the whole corpus comes from
sums per chunk of documents; each chunk gets the sums of its own pairs back by a join, so no table of pairs is ever held whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import whole_text

RANGE_BYTES = 1 << 16
CHUNK_BYTES = 4 << 20
MAX_PIECES = 300_000
FAN_IN = 8

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_UNEVEN = re.compile(r"\s[ \n]|[ \n]\s")
_CLOSED = "chunk string, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, sha array<string>, held binary, times binary, pairs binary"

Tokens = tuple[tuple[int, ...], tuple[int, ...]]
NOTHING: Tokens = ((), ())


class Fragment(NamedTuple):
    """Tokens of a stretch of text. Without a common end (``cut`` false) all of them are in ``head``."""

    cut: bool = False
    head: Tokens = NOTHING
    closed: tuple[Tokens, ...] = ()
    tail: Tokens = NOTHING


def joined(left: Tokens, right: Tokens) -> Tokens:
    return (left[0] + right[0], left[1] + right[1])


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring stretches; associative, with ``Fragment()`` as its neutral element."""
    if not left.cut:
        return right._replace(head=joined(left.head, right.head))
    if not right.cut:
        return left._replace(tail=joined(left.tail, right.head))
    return Fragment(True, left.head, (*left.closed, joined(left.tail, right.head), *right.closed), right.tail)


def composed(fragments: list[Fragment]) -> Fragment:
    """Neighbouring fragments in pairs, level by level, so that a long list costs no more than its logarithm in copies."""
    while len(fragments) > 1:
        fragments = [compose(*fragments[i : i + 2]) if i + 1 < len(fragments) else fragments[i] for i in range(0, len(fragments), 2)]
    return fragments[0] if fragments else Fragment()


def fragment(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int]) -> Fragment:
    """The fragment of a stretch, from the ids of the tokens that end in it and the offsets where they end."""
    common = np.intersect1d(a_ends, b_ends)
    if not len(common):
        return Fragment(head=(tuple(a), tuple(b)))
    i, j = np.searchsorted(a_ends, common, "right").tolist(), np.searchsorted(b_ends, common, "right").tolist()
    groups = [(tuple(a[p:q]), tuple(b[r:s])) for p, q, r, s in zip([0, *i], i, [0, *j], j, strict=False)]
    return Fragment(True, groups[0], tuple(groups[1:]), (tuple(a[i[-1] :]), tuple(b[j[-1] :])))


def groups_of(whole: Fragment) -> list[Tokens]:
    """The groups of a whole text: its begin and its end are common ends."""
    return [*([whole.head] if whole.cut else []), *whole.closed]


def shown(groups: list[Tokens]) -> bytes:
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups).encode()


def cuts(full: str) -> list[str]:
    """A text (with its leading blank), or a range of it, in pieces, cut before blanks and line breaks between visible characters."""
    if full[0] != " " or full[-1].isspace() or _UNEVEN.search(full):
        return _CUT.split(full)
    return [part if part[0] == "\n" else " " + part for part in full[1:].replace("\n", " \n").split(" ")]


class Tokenizers:
    """The two tokenizers, with the bytes of their tokens."""

    def __init__(self, byte_level: bytes, piece_model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        entries = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = {i: bytes(map(_BYTES.__getitem__, t)) for t, i in entries.items()}
        self.b = SentencePieceProcessor(model_proto=piece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_sizes[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        # ids as shown in groups, by what follows them: "," and "|" for A, then "," and ";" for B
        self.signs = [f"{i}{mark}" for n, marks in ((len(self.a_sizes), ",|"), (len(pieces), ",;")) for mark in marks for i in range(n)]
        self.sign_sizes = np.array([len(x) for x in self.signs], np.int64)
        self.blank = self.b.piece_to_id("▁")
        # a token that goes on after a word would make the cuts wrong
        self.cuttable = not any(re.search("[^▁]▁|\n", p) for p in pieces)

    def pieces(self, full: str) -> list[str]:
        return cuts(full) if self.cuttable else [full]

    def tokens(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of A and of B of each piece, and whether the bytes of both are those of the piece."""
        of_a = [found.ids for found in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        of_b = self.b.encode([p.removeprefix(" ") for p in pieces], num_threads=1)
        for place, piece in enumerate(pieces):
            if piece[0] != " ":  # the model adds a blank to every text, which this piece does not have
                own = of_b[place]
                of_b[place] = own[1:] if own[:1] == [self.blank] else [0]
        if self.give_back(pieces, of_a, self.a_bytes, self.a_sizes) and self.give_back(pieces, of_b, self.b_bytes, self.b_sizes):
            return of_a, of_b, [True] * len(pieces)
        a, b = ([b"".join(map(table.__getitem__, ids)) for ids in found] for table, found in ((self.a_bytes, of_a), (self.b_bytes, of_b)))
        return of_a, of_b, [x == p.encode() == y for x, p, y in zip(a, pieces, b, strict=True)]

    def give_back(self, pieces: list[str], found: list[list[int]], table, sizes: np.ndarray) -> bool:
        """Whether the bytes of all tokens are those of their pieces, by one look at all of them."""
        flat = list(chain.from_iterable(found))
        if b"".join(map(table.__getitem__, flat)) != "".join(pieces).encode():
            return False
        ends = np.concatenate([[0], np.cumsum(sizes[flat])])[np.cumsum([len(ids) for ids in found])]
        return np.array_equal(ends, np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in pieces]))

    def stream(self, pieces: list[str]) -> tuple[list[int], np.ndarray, list[int], np.ndarray] | None:
        """Ids and ends of A and of B over neighbouring pieces; None if some bytes are not those of the text."""
        of_a, of_b, same = self.tokens(pieces)
        if not all(same):
            return None
        a, b = list(chain.from_iterable(of_a)), list(chain.from_iterable(of_b))
        a_ends, b_ends = self.ends(a, b)
        return a, a_ends, b, b_ends

    def ends(self, a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])


def _byte_alphabet() -> dict[str, int]:
    """The letters by which byte-level vocabularies show bytes: visible Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(rest)}


_BYTES = _byte_alphabet()
_made: dict[int, Tokenizers] = {}


def _tokenizers(files: tuple[bytes, bytes]) -> Tokenizers:
    if hash(files) not in _made:
        _made[hash(files)] = Tokenizers(*files)
    return _made[hash(files)]


class Chunk:
    """Documents of a chunk as they are aligned; distinct pieces are tokenized once, and remembered up to a bound."""

    def __init__(self, tokenizers: Tokenizers, number: str):
        self.tokenizers, self.number = tokenizers, number
        self.forget()
        self.clear()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # entry of each piece; -1: its tokens do not give it back
        self.pairs: dict[int, int] = {}
        # of each entry: groups as shown, places of its linked pairs, tokens of A and of B
        self.text: list[bytes] = []
        self.links: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []

    def clear(self) -> None:
        self.doc_ids, self.figures, self.sha, self.docs, self.bytes = [], [], [], [], 0

    def entry(self, groups: list[Tokens]) -> int:
        self.text.append(shown(groups))
        self.links.append(self.places(np.array([a[-1] << 32 | b[-1] for a, b in groups], np.int64)))
        self.sizes.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups)))
        return len(self.text) - 1

    def places(self, links: np.ndarray) -> bytes:
        """Linked pairs (the id of A above that of B) by their places among the pairs known."""
        distinct, which = np.unique(links, return_inverse=True)
        own = np.array([self.pairs.setdefault(pair, len(self.pairs)) for pair in distinct.tolist()], np.int32)
        return own[which].tobytes()

    def learn(self, new: list[str]) -> None:
        """Align pieces that were not seen before, all in one stream: every piece ends at a common end."""
        tokens = self.tokenizers
        of_a, of_b, same = tokens.tokens(new)
        if not all(same):
            self.known.update((p, -1) for p, fit in zip(new, same, strict=True) if not fit)
            new, of_a, of_b = ([x for x, fit in zip(found, same, strict=True) if fit] for found in (new, of_a, of_b))
            if not new:
                return
        a, b = (np.fromiter(chain.from_iterable(found), np.int64) for found in (of_a, of_b))
        n_a, n_b = (np.array([len(ids) for ids in found], np.int64) for found in (of_a, of_b))
        a_ends, b_ends = tokens.ends(a, b)
        closes_a, closes_b = np.isin(a_ends, b_ends, assume_unique=True), np.isin(b_ends, a_ends, assume_unique=True)
        links = self.places(a[closes_a] << 32 | b[closes_b])
        # the tokens of A of a group, then those of B, each with the mark that follows it
        signs = np.concatenate([a + closes_a * len(tokens.a_sizes), b + (2 * len(tokens.a_sizes)) + closes_b * len(tokens.b_sizes)])
        group = np.concatenate([np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b])
        signs = signs[np.argsort(group, kind="stable")]
        text = "".join(map(tokens.signs.__getitem__, signs.tolist())).encode()
        until = np.cumsum(n_a) - 1  # the token of A that ends a piece
        groups = np.cumsum(closes_a)[until]
        at = np.cumsum(tokens.sign_sizes[signs])[np.cumsum(n_a + n_b) - 1]
        groups, at = [0, *groups.tolist()], [0, *at.tolist()]
        known = len(self.text)
        self.known.update(zip(new, range(known, known + len(new)), strict=True))
        self.text += [text[i : j - 1] for i, j in zip(at, at[1:], strict=False)]
        self.links += [links[4 * i : 4 * j] for i, j in zip(groups, groups[1:], strict=False)]
        self.sizes += zip(n_a.tolist(), n_b.tolist(), strict=True)

    def add(self, batch: list[tuple[int | None, str]]) -> None:
        if len(self.known) > MAX_PIECES and not self.doc_ids:
            self.forget()
        cut = [self.tokenizers.pieces(" " + text) if text else [] for _, text in batch]
        new = set(chain.from_iterable(cut)).difference(self.known)
        if new:
            self.learn(list(new))
        for (doc_id, text), pieces in zip(batch, cut, strict=True):
            self.close(doc_id, list(map(self.known.__getitem__, pieces)), len(text))

    def add_whole(self, doc_id: int | None, groups: list[Tokens]) -> None:
        self.close(doc_id, [self.entry(groups)] if groups else [], 6 * len(groups))

    def close(self, doc_id: int | None, entries: list[int], size: int) -> None:
        if -1 in entries:
            entries = []
        self.doc_ids.append(doc_id)
        self.docs.append(np.array(entries, np.int64))
        self.sha.append(hashlib.sha256(b";".join([self.text[i] for i in entries])).hexdigest() if entries else "")
        self.bytes += size + 16

    def row(self) -> pa.RecordBatch:
        """The chunk as one row: figures per document, the pairs linked in it, and how often each document links which."""
        entries = np.concatenate([*self.docs, np.zeros(0, np.int64)])
        doc = np.repeat(np.arange(len(self.docs)), [len(d) for d in self.docs])
        sizes = np.array(self.sizes, np.int64).reshape(-1, 2)[entries]
        links = [self.links[i] for i in entries.tolist()]
        sizes = np.column_stack([sizes, np.array([len(x) // 4 for x in links], np.int64)])
        per_doc = np.stack([np.bincount(doc, sizes[:, k], len(self.docs)).astype(np.int64) for k in range(3)], axis=1)
        every, width = np.fromiter(self.pairs, np.int64, len(self.pairs)), max(len(self.pairs), 1)
        held = np.frombuffer(b"".join(links), np.int32) + np.repeat(np.arange(len(self.docs)), per_doc[:, 2]) * width
        held, n = np.unique(held, return_counts=True)
        holder, which = np.divmod(held, width)
        used, which = np.unique(which, return_inverse=True)
        pairs = every[used]
        total = np.bincount(which, n, len(pairs)).astype(np.int64)
        columns = [pa.array([self.number]), _list(self.doc_ids), *[_list(per_doc[:, k]) for k in range(3)], _list(self.sha, pa.string())]
        lengths = np.bincount(holder, minlength=len(self.docs))
        columns += [pa.array([x], pa.binary()) for x in (_packed(lengths, which), _packed(n, n[:0]), _packed(pairs, total))]
        out = pa.record_batch(columns, names=[part.split()[0] for part in _CLOSED.split(", ")])
        self.clear()
        return out


def _list(values, kind: pa.DataType = pa.int64()) -> pa.Array:
    return pa.array([values if isinstance(values, list) else values.tolist()], pa.list_(kind))


def _packed(first: np.ndarray, second: np.ndarray) -> bytes:
    """Two integer arrays, each in the narrowest type that holds it."""
    out = [len(first).to_bytes(8, "little")]
    for values in (first, second):
        kind = np.min_scalar_type(int(values.max(initial=0)))
        out += [kind.itemsize.to_bytes(1, "little"), values.astype(kind).tobytes()]
    return b"".join(out)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for count in (n, None):
        kind = np.dtype(f"<u{data[at]}")
        count = (len(data) - at - 1) // kind.itemsize if count is None else count
        out.append(np.frombuffer(data, kind, count, at + 1).astype(np.int64))
        at += 1 + count * kind.itemsize
    return out[0], out[1]


def _chunks(batches: Iterator[pa.RecordBatch], files, rows: int = 128) -> Iterator[pa.RecordBatch]:
    """Whole short documents, chunk by chunk."""
    chunk, number = None, 0
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            chunk = chunk or Chunk(_tokenizers(files.value), "")
            chunk.add(list(zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)))
            if chunk.bytes >= CHUNK_BYTES:
                chunk.number, number = f"s{TaskContext.get().partitionId()}.{number}", number + 1
                yield chunk.row()
    if chunk and chunk.doc_ids:
        chunk.number = f"s{TaskContext.get().partitionId()}.{number}"
        yield chunk.row()


# -- very long documents ------------------------------------------------------------------------------------------


def ranges(pieces: list[str], size: int) -> Iterator[tuple[str, int, int]]:
    """``text, low, high`` of byte ranges of about ``size``: a range owns the tokens that end in its text after ``low`` and up
    to ``high``, bytes from the begin of that text.

    Range ends lie where they fall, in the middle of a piece too; a range brings the whole pieces that it shares, so that the
    tokens there come out right. Only pieces longer than a range are not cut.
    """
    ends = np.cumsum([len(p.encode()) for p in pieces])
    begins = np.concatenate([[0], ends[:-1]])
    limits = np.arange(size, ends[-1], size)
    inside = np.searchsorted(ends, limits, "left")  # the piece in which a limit falls
    limits = limits[(ends - begins)[inside] <= size]
    for low, high in zip([0, *limits], [*limits, ends[-1]], strict=True):
        first, last = np.searchsorted(ends, low, "right"), np.searchsorted(ends, high, "left")
        yield "".join(pieces[first : last + 1]), int(low - begins[first]), int(high - begins[first])


def _cut_up(batches: Iterator[pa.RecordBatch], files, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("key", "doc_id", "text")], strict=True):
            found = list(ranges(_tokenizers(files.value).pieces(" " + text), size))
            texts, low, high = zip(*found, strict=True)
            n = len(found)
            yield pa.record_batch(
                [pa.array([key] * n, pa.int64()), pa.array([doc_id] * n, pa.int64()), pa.array(range(n), pa.int64())]
                + [pa.array(texts, pa.string()), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
                names=["key", "doc_id", "seq", "text", "low", "high"],
            )


def _flat(found: Fragment | None) -> bytes | None:
    """A fragment as bytes; None for a text without tokens."""
    if found is None:
        return None
    groups = [found.head, *found.closed, found.tail]
    lengths = np.array([[len(a), len(b)] for a, b in groups], np.int64).ravel()
    ids = np.array([i for a, b in groups for i in (*a, *b)], np.int64)
    return bytes([found.cut]) + _packed(lengths, ids)


def _unflat(data: bytes) -> Fragment:
    lengths, ids = _unpacked(data[1:])
    ends, flat = np.cumsum(lengths).tolist(), ids.tolist()
    parts = [tuple(flat[i:j]) for i, j in zip([0, *ends], ends, strict=False)]
    groups = list(zip(parts[::2], parts[1::2], strict=True))
    return Fragment(bool(data[0]), groups[0], tuple(groups[1:-1]), groups[-1])


def _range_fragments(batches: Iterator[pa.RecordBatch], files) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokenizers, out = _tokenizers(files.value), []
        for text, low, high in zip(*[batch.column(c).to_pylist() for c in ("text", "low", "high")], strict=True):
            found = tokenizers.stream(tokenizers.pieces(text))
            if found is None:
                out.append(None)
                continue
            a, a_ends, b, b_ends = found
            (i, j), (k, m) = np.searchsorted(a_ends, [low, high], "right"), np.searchsorted(b_ends, [low, high], "right")
            out.append(fragment(a[i:j], a_ends[i:j], b[k:m], b_ends[k:m]))
        yield pa.record_batch(
            [*[batch.column(c) for c in ("key", "doc_id", "seq")], pa.array(map(_flat, out), pa.binary())], names=["key", "doc_id", "seq", "part"]
        )


def _reduced(table: pa.Table) -> pa.Table:
    """Up to ``FAN_IN`` neighbouring fragments of a document as one."""
    parts = table.sort_by("seq").column("part").to_pylist()
    whole = None if None in parts else composed([_unflat(p) for p in parts])
    first = table.slice(0, 1)
    return pa.table(
        {"key": first.column("key"), "doc_id": first.column("doc_id"), "seq": pa.array([first.column("seq")[0].as_py() // FAN_IN], pa.int64()), "part": pa.array([_flat(whole)], pa.binary())}
    )


def _long_chunks(batches: Iterator[pa.RecordBatch], files) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, doc_id, part in zip(*[batch.column(c).to_pylist() for c in ("key", "doc_id", "part")], strict=True):
            chunk = Chunk(_tokenizers(files.value), f"l{key}")
            chunk.add_whole(doc_id, [] if part is None else groups_of(_unflat(part)))
            yield chunk.row()


def _long(docs: DataFrame, files, size: int) -> DataFrame:
    """Chunks of one very long document each, through fragments of its byte ranges."""
    kept = materialize(docs.withColumn("key", F.monotonically_increasing_id()), "long")
    parts = kept.mapInArrow(lambda b: _cut_up(b, files, size), "key long, doc_id long, seq long, text string, low long, high long")
    shape = "key long, doc_id long, seq long, part binary"
    found = materialize(parts.repartition("key", "seq").mapInArrow(lambda b: _range_fragments(b, files), shape), "fragments")
    widest = found.agg(F.max("seq")).first()[0] or 0
    while widest:
        found = found.groupBy("key", F.floor(F.col("seq") / FAN_IN).alias("part_of")).applyInArrow(_reduced, shape)
        widest //= FAN_IN
    return found.mapInArrow(lambda b: _long_chunks(b, files), _CLOSED)


# -- counts over the corpus ---------------------------------------------------------------------------------------


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
            pairs, n = _unpacked(data)
            yield pa.record_batch(
                [pa.array([chunk] * len(pairs), pa.string()), pa.array(np.arange(len(pairs), dtype=np.int32)), pa.array(pairs), pa.array(n)],
                names=["chunk", "place", "pair", "n"],
            )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures per document, from the corpus-wide counts of the pairs of its chunk."""
    for batch in batches:
        for row in batch.to_pylist():
            lengths, held = _unpacked(row["held"])
            times, _ = _unpacked(row["times"])
            place, count, best = (np.array([x[name] for x in row["counts"] or []], np.int64) for name in ("place", "count", "best"))
            ends, out = np.cumsum(lengths), []
            for figure in (best, count):
                by_place = np.zeros(len(place), np.int64)
                by_place[place] = figure
                running = np.concatenate([[0], np.cumsum(by_place[held] * times)])
                out.append(running[ends] - running[ends - lengths])
            columns = [pa.array(row[c], pa.int64()) for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_groups")]
            yield pa.record_batch(
                [*columns, *map(pa.array, out), pa.array(row["sha"], pa.string())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def align(docs: DataFrame, byte_level: str, piece_model: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``.

    ``byte_level`` and ``piece_model`` are the files of tokenizer A (byte-level BPE) and B (pieces with byte fallback). Null and
    empty texts, and texts whose tokens do not give back their bytes, have no tokens: zeros and an empty digest. Rows that
    occur twice are counted twice; null ids stay null; other columns don't matter; no rows give no rows.
    """
    with open(byte_level, "rb") as a, open(piece_model, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))  # vocabularies, whatever the corpus is
    texts = whole_text(docs)
    is_long = F.octet_length("text") > range_bytes
    short = texts.where(~is_long).mapInArrow(lambda batches: _chunks(batches, files), _CLOSED)
    chunks = materialize(short.unionByName(_long(texts.where(is_long), files, range_bytes)), "chunks")
    pairs = chunks.select("chunk", "pairs").mapInArrow(_pairs, "chunk string, place int, pair long, n long")
    counts = materialize(pairs.groupBy("pair").agg(F.sum("n").alias("count")), "counts")
    top = counts.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("count").alias("most"))
    judged = counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(top, "b")
    judged = judged.select("pair", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    back = pairs.select("chunk", "place", "pair").join(judged, "pair").groupBy("chunk").agg(F.collect_list(F.struct("place", "count", "best")).alias("counts"))
    shape = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return chunks.drop("pairs").join(back, "chunk", "left").mapInArrow(_summed, shape)
