"""Byte-level BPE: encoding by a transducer that is made deterministic while it runs, and streaming decoding.

A sequence of tokens is the BPE encoding of a piece exactly if every token encodes to itself and every two neighbours
encode to themselves when put together. A nondeterministic transducer reads bytes down the trie of tokens, and may close a
token where its neighbour to the left admits it. ``Transducer`` determinises it lazily: a state is the set of live readings
(last closed token, place in the trie, tokens closed but not yet emitted). What all readings have closed alike is emitted,
so a token leaves after a lookahead bounded by the longest token. States and steps are made on first use and kept up to
a bound, beyond which they are dropped and made again; that changes no result.
"""

from __future__ import annotations

import base64
import gc
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_batches, whole_text

_OPEN = -1  # no token closed yet
_made: dict[tuple[int, str], "Encoder | Decoder"] = {}  # one per Python worker and vocabulary


class Transducer:
    """Encodes single pieces; ``ranks`` maps token bytes to ids, lower ids merge first."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 150_000):
        self.ranks, self.max_states = ranks, max_states
        self.token = {rank: token for token, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.closes: list[int] = [_OPEN]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                below = self.children[node].get(byte)
                if below is None:
                    below = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.closes.append(_OPEN)
                node = below
            self.closes[node] = rank
        self.never = 1 << 40
        self.admitted: dict[int, bool] = {}
        self.edges: dict[int, tuple | None] = {}
        self._clear()

    def _clear(self) -> None:
        self.known: dict[tuple, int] = {}
        self.readings: list[tuple] = []
        self.steps: dict[int, tuple[int, tuple]] = {}  # by state and byte
        self.last: list[tuple] = []
        self._state(((_OPEN, 0, ()),))

    def _state(self, readings: tuple) -> int:
        number = self.known.get(readings)
        if number is None:
            number = self.known[readings] = len(self.readings)
            self.readings.append(readings)
            self.last.append(next((closed for _, node, closed in readings if node == 0), ()))
        return number

    def merge(self, piece: bytes, below: int) -> list[bytes]:
        """The defining rule, for single tokens: join the leftmost pair of lowest rank, as long as that is under ``below``."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1], below)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, token: int) -> tuple[list, list] | None:
        """What stands at a token's right and left end while it is built: (bytes, rank of the merge that takes it in).

        None for a token that merges never make. The whole token is first, taken in by nothing (infinite rank).
        """
        if token not in self.edges:
            text, found = self.token[token], None
            parts = self.merge(text, token)
            if len(parts) == 1 and len(text) == 1:
                found = [(text, self.never)], [(text, self.never)]
            elif len(parts) == 2:
                left, right = (self._edge(self.ranks[part]) for part in parts)
                if left and right:
                    found = tuple(
                        [(text, self.never), (side[0][0], token), *side[1:]] for side in (right[0], left[1])
                    )
            self.edges[token] = found
        return self.edges[token]

    def _admits(self, left: int, right: int) -> bool:
        """Whether no merge joins across the border of two neighbours.

        One does if both its parts stand at the border when its turn comes; of two merges of one rank the left one is first.
        """
        key = (left + 1 << 32) | right
        known = self.admitted.get(key)
        if known is None:
            if len(self.admitted) > 1_000_000:
                self.admitted.clear()
            ends, starts = left == _OPEN or self._edge(left), self._edge(right)
            known = bool(ends and starts)
            if known and left != _OPEN:
                rank, never = self.ranks.get, self.never
                known = not any(
                    (joined := rank(x + y, never)) < until_x and joined <= until_y and joined != never
                    for x, until_x in ends[0]
                    for y, until_y in starts[1]
                )
            self.admitted[key] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple]:
        after = []
        children, closes = self.children, self.closes
        for left, node, closed in self.readings[state]:
            node = children[node].get(byte)
            if node is None:
                continue
            if children[node]:
                after.append((left, node, closed))
            token = closes[node]
            if token != _OPEN and self._admits(left, token):
                after.append((token, 0, (*closed, token)))
        emitted = after[0][2]
        for _, _, closed in after:
            while closed[: len(emitted)] != emitted:
                emitted = emitted[:-1]
        if emitted:
            shared = len(emitted)
            after = [(left, node, closed[shared:]) for left, node, closed in after]
        step = (self._state(tuple(after)), emitted)
        self.steps[state << 8 | byte] = step
        return step

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:  # a piece that is a token stays whole, whether or not merges lead to it
            return [whole]
        state, out, known = 0, [], self.steps.get
        for byte in piece:
            step = known(state << 8 | byte)
            if step is None:
                if len(self.readings) > self.max_states:  # in the middle of a piece too; a state is its live readings
                    live = self.readings[state]
                    self._clear()
                    state, known = self._state(live), self.steps.get
                step = self._step(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        out += self.last[state]
        return out


class Utf8Stream:
    """Turns chunks of bytes into text; bytes of a character that a chunk cuts are held until the next one."""

    #: bytes that follow a first byte: 0xxxxxxx none, 110xxxxx one, 1110xxxx two, 11110xxx three
    _FOLLOW = [0] * 0xC0 + [1] * 0x20 + [2] * 0x10 + [3] * 0x10

    def __init__(self) -> None:
        self.held = b""

    def feed(self, chunk: bytes) -> str:
        data = self.held + chunk
        cut = len(data)
        for back in range(1, min(3, cut) + 1):
            byte = data[cut - back]
            if byte >= 0xC0:  # first byte of the last character: hold it if it wants more than there is
                cut -= back if self._FOLLOW[byte] >= back else 0
                break
            if byte < 0x80:
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Encoder:
    """Splits texts by the pattern and encodes each match; short pieces seen lately are looked up (two bounded generations)."""

    def __init__(self, vocabulary: bytes, pattern: str, max_pieces: int = 400_000):
        import regex

        self.transducer = Transducer(_ranks(vocabulary))
        self.split = regex.compile(pattern).findall
        self.max_pieces = max_pieces
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        pieces, out = self.pieces, []
        for piece in self.split(text):
            ids = pieces.get(piece)
            if ids is None:
                ids = self.older.get(piece)
                if ids is None:
                    found = self.transducer.encode(piece.encode())
                    ids = b"".join([i.to_bytes(4, "little") for i in found])
                if len(piece) <= 64:
                    if len(pieces) >= self.max_pieces:
                        self.older, self.pieces = pieces, {}
                        pieces = self.pieces
                    pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def round_trip(self, text: str) -> bytes:
        """The ids of a text, after they were decoded again and gave the text."""
        ids = self.encode(text)
        if _decode(self.transducer.token, ids, 4096) != text:
            raise ValueError("the token ids of a text do not decode to it")
        return ids


class Decoder:
    def __init__(self, vocabulary: bytes):
        self.token = {rank: token for token, rank in _ranks(vocabulary).items()}

    def decode(self, ids: bytes, chunk: int = 4096) -> str:
        return _decode(self.token, ids, chunk)


def _decode(token: dict[int, bytes], ids: bytes, chunk: int) -> str:
    stream, out = Utf8Stream(), []
    numbers = memoryview(ids).cast("I")
    for start in range(0, len(numbers), chunk):
        out.append(stream.feed(b"".join([token[i] for i in numbers[start : start + chunk]])))
    return "".join(out) + stream.end()


def _ranks(vocabulary: bytes) -> dict[bytes, int]:
    lines = (line.split() for line in vocabulary.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def _encoder(vocabulary: bytes, pattern: str) -> Encoder:
    key = (hash(vocabulary), pattern)
    if key not in _made:
        gc.set_threshold(200_000, 20, 100)  # the tables hold no cycles; walking them again and again is what takes time
        _made[key] = Encoder(vocabulary, pattern)
    return _made[key]


def _decoder(vocabulary: bytes) -> Decoder:
    key = (hash(vocabulary), "")
    if key not in _made:
        _made[key] = Decoder(vocabulary)
    return _made[key]


def _vocabulary(spark: SparkSession, path: str):
    """The rank file as a broadcast; a vocabulary is bounded whatever the corpus is."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row of ``docs``; ``ids`` are little-endian unsigned 32-bit integers.

    Null and empty texts give no ids; repeated rows are encoded each; columns other than doc_id and text don't matter.
    """
    spread = _vocabulary(docs.sparkSession, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _encoder(spread.value, pattern)
        ids = [encoder.encode(text) for text in batch.column("text").to_pylist()]
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids": pa.array(ids, pa.binary()),
            }
        )

    return map_batches(whole_text(docs), run, "doc_id long, n_tokens long, ids binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: of its ids, as ``encode`` has them, and of the text that the
    incremental decoder makes of these, in one pass that ships neither."""
    spread = _vocabulary(docs.sparkSession, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _encoder(spread.value, pattern)
        token, sizes, shown, decoded = encoder.transducer.token, [], [], []
        for text in batch.column("text").to_pylist():
            ids = encoder.encode(text)
            sizes.append(len(ids) // 4)
            shown.append(hashlib.sha256(ids).hexdigest())
            decoded.append(hashlib.sha256(_decode(token, ids, 4096).encode()).hexdigest())
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(shown, pa.string()), pa.array(decoded, pa.string())]
        return pa.record_batch(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(whole_text(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_to_arrays(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, token_ids`` of every row, the ids as an array of int; otherwise as ``encode``.

    The ids of every text are decoded too, by the incremental decoder; ids that do not give the text end the job.
    """
    spread = _vocabulary(docs.sparkSession, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _encoder(spread.value, pattern)
        ids = [encoder.round_trip(text) for text in batch.column("text").to_pylist()]
        sizes = [len(x) // 4 for x in ids]
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
        return pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), lists], names=["doc_id", "n_tokens", "token_ids"])

    return map_batches(whole_text(docs), run, "doc_id long, n_tokens long, token_ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, text``: the text of the ids, through the incremental decoder."""
    spread = _vocabulary(encoded.sparkSession, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        decoder = _decoder(spread.value)
        texts = [decoder.decode(ids) for ids in batch.column("ids").to_pylist()]
        return pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids", "text"])

    return map_batches(encoded.select("doc_id", "n_tokens", "ids"), run, "doc_id long, n_tokens long, ids binary, text string")
