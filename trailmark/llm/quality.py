"""Document quality from a linear-chain conditional random field over lines.

Every line gets a state, good or bad. What a line looks like, and what the lines before and after it look like, gives its
potential; two weights per pair of states tie neighbours. Marginals come from the forward-backward recursion, and a
document's score is their mean weighted by length. The model is fitted to a bounded sample of labelled documents whose lines
all carry the document's label; only the text goes into a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_batches, whole_text

#: bounds of the fit: labelled documents (those of smallest hash), and lines of all of them together
FIT_DOCUMENTS = 2000
FIT_LINES = 100_000

THRESHOLD = 0.3

# classes of characters
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _MARK, _QUOTE, _BAR, _SIGN = range(9)
_TABLE_SIZE = 0x3000


def _character_table() -> np.ndarray:
    table = np.full(_TABLE_SIZE, _SIGN, np.int8)
    for code in range(_TABLE_SIZE):
        c = chr(code)
        if c.isalpha():
            table[code] = _UPPER if c.isupper() else _LOWER
        elif c.isdigit():
            table[code] = _DIGIT
        elif c.isspace():
            table[code] = _SPACE
    for kind, chars in ((_STOP, ".,;:"), (_MARK, "!?"), (_QUOTE, "'\"-()"), (_BAR, "|\t")):
        for c in chars:
            table[ord(c)] = kind
    return table


_TABLE = _character_table()


def lines_of(text: str) -> list[str]:
    """The lines that are not blank; a text without any is one empty line."""
    return [line for line in text.split("\n") if line.strip()] or [""]


def _own_features(lines: list[str]) -> np.ndarray:
    codes = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le"), np.uint32)
    kinds = np.where(codes < _TABLE_SIZE, _TABLE[np.minimum(codes, _TABLE_SIZE - 1)], _LOWER)
    lengths = np.array([len(line) for line in lines])
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    count = np.stack([np.add.reduceat(kinds == kind, starts, dtype=np.int64) for kind in range(9)], axis=1).astype(float)
    count[:, _SPACE] -= 1  # the line break
    size = np.maximum(lengths, 1.0)
    letters = np.maximum(count[:, _LOWER] + count[:, _UPPER], 1.0)
    words, unlike, short, seen = (np.zeros(len(lines)) for _ in range(4))
    before: set[str] = set()
    for i, line in enumerate(lines):
        parts = line.split()
        words[i], unlike[i] = len(parts), len(set(parts))
        short[i] = sum(len(part) <= 3 for part in parts)
        seen[i] = line in before
        before.add(line)
    many = np.maximum(words, 1.0)
    last = np.array([line.rstrip()[-1:] in {".", "!", "?", ":", '"'} for line in lines], float)
    first = np.array([line.lstrip()[:1].isupper() for line in lines], float)
    return np.column_stack(
        [
            np.log1p(lengths), np.log1p(words), np.minimum(letters / many, 30), unlike / many, short / many, seen, last, first,
            count[:, _UPPER] / letters, np.minimum(count[:, _UPPER] / many, 3), count[:, _DIGIT] / size, count[:, _STOP] / many,
            np.minimum(count[:, _MARK] / many, 3), count[:, _QUOTE] / size, np.minimum(count[:, _BAR] / many, 2),
            np.minimum(count[:, _SIGN] / many, 5), count[:, _SPACE] / size, (count[:, _SIGN] + count[:, _BAR]) / size,
        ]
    )


N_OWN = 18
N_FEATURES = 3 * N_OWN + 3


def features(lines: list[str]) -> np.ndarray:
    """Of each line: its own, those of the line before and of the line after, whether these exist, and a constant."""
    own = _own_features(lines)
    none = np.zeros((1, N_OWN))
    edge = np.zeros((len(lines), 3))
    edge[0, 0] = edge[-1, 1] = edge[:, 2] = 1
    return np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none]), edge])


@dataclass
class Model:
    weights: np.ndarray  # of the good state against the bad one
    ties: np.ndarray  # 2 x 2, from and to, bad first
    centre: np.ndarray
    scale: np.ndarray

    def line_marginals(self, lines: list[str]) -> list[float]:
        """Probability of the good state, line by line, by forward-backward with normalised messages."""
        odds = np.clip(((features(lines) - self.centre) / self.scale) @ self.weights, -30, 30)
        good = np.exp(odds).tolist()  # potential of good; that of bad is 1
        (bb, bg), (gb, gg) = np.exp(self.ties).tolist()
        ahead, b, g = [], 0.5, 0.5
        for i, potential in enumerate(good):
            if i:
                b, g = b * bb + g * gb, b * bg + g * gg
            g *= potential
            total = b + g
            b, g = b / total, g / total
            ahead.append((b, g))
        out, b, g = [0.0] * len(good), 0.5, 0.5
        for i in range(len(good) - 1, -1, -1):
            fb, fg = ahead[i]
            out[i] = fg * g / (fb * b + fg * g)
            g *= good[i]
            b, g = b * bb + g * bg, b * gb + g * gg
            total = b + g
            b, g = b / total, g / total
        return out

    def score(self, text: str) -> float:
        lines = lines_of(text)
        sizes = [max(len(line), 1) for line in lines]
        return math.fsum(p * n for p, n in zip(self.line_marginals(lines), sizes)) / sum(sizes)


def fit(sequences: list[np.ndarray], labels: list[int], rounds: int = 80, penalty: float = 1e-3) -> Model:
    """Maximum likelihood by Adam on the exact gradient; sequences of like length go through the recursions side by side."""
    stacked = np.concatenate(sequences)
    centre, scale = stacked.mean(axis=0), stacked.std(axis=0) + 1e-6
    centre[-1], scale[-1] = 0.0, 1.0
    groups: dict[int, list[int]] = {}
    for i, sequence in enumerate(sequences):
        groups.setdefault(max(len(sequence) - 1, 31).bit_length(), []).append(i)
    parts = []
    for _, members in sorted(groups.items()):
        sizes = np.array([len(sequences[i]) for i in members])
        live = np.arange(sizes.max()) < sizes[:, None]
        flat = ((np.concatenate([sequences[i] for i in members]) - centre) / scale).astype(np.float32)
        parts.append((live, flat, np.array([labels[i] for i in members]), 1.0 / sizes))  # a document counts once, however long
    theta, m, v = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
    for step in range(1, rounds + 1):
        weights, ties = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
        gradient = np.zeros(N_FEATURES + 4)
        for live, flat, y, weight in parts:
            odds = np.zeros(live.shape)
            odds[live] = np.clip(flat @ weights.astype(np.float32), -30, 30)
            node, pair = _expectations(odds, ties, live)
            slip = np.where(live, y[:, None] - node, 0) * weight[:, None]
            gradient[:N_FEATURES] += flat.T @ slip[live].astype(np.float32)
            real = np.zeros((len(y), 2, 2))
            real[np.arange(len(y)), y, y] = 1
            same = live[:, 1:] & live[:, :-1]
            tied = ((real[:, None] - pair) * same[:, :, None, None] * weight[:, None, None, None]).sum(axis=(0, 1))
            gradient[N_FEATURES:] += tied.ravel()
        gradient = gradient / len(sequences) - penalty * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(theta[:N_FEATURES].copy(), theta[N_FEATURES:].reshape(2, 2).copy(), centre, scale)


def _products(steps: np.ndarray) -> np.ndarray:
    """Of each sequence of 2 x 2 matrices the products of its first 1, 2, 3, ... ones, up to scale, by doubling."""
    out, size = steps / steps.max(axis=(2, 3), keepdims=True), 1
    while size < out.shape[1]:
        left, right = out[:, :-size], out[:, size:]
        joined = left[..., :, :1] * right[..., :1, :] + left[..., :, 1:] * right[..., 1:, :]
        out = np.concatenate([out[:, :size], joined / joined.max(axis=(2, 3), keepdims=True)], axis=1)
        size *= 2
    return out


def _expectations(odds: np.ndarray, ties: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the good state and of pairs of states, for all sequences at once; steps past an end change nothing."""
    count, longest = odds.shape
    potential = np.stack([np.ones_like(odds), np.exp(odds)], axis=2)
    tie = np.exp(ties)
    ahead, back = np.zeros((count, longest, 2)), np.full((count, longest, 2), 0.5)
    ahead[:, 0] = potential[:, 0] / potential[:, 0].sum(axis=1, keepdims=True)
    if longest > 1:
        steps = np.where(live[:, 1:, None, None], tie * potential[:, 1:, None, :], np.eye(2))
        upto = _products(steps)
        ahead[:, 1:] = (ahead[:, :1, :, None] * upto).sum(axis=2)
        # from the end the products grow to the left: those of the transposed matrices, in reverse
        onward = np.swapaxes(_products(np.swapaxes(steps[:, ::-1], 2, 3)), 2, 3)[:, ::-1]
        back[:, :-1] = onward.sum(axis=3)
        ahead /= ahead.sum(axis=2, keepdims=True)
        back /= back.sum(axis=2, keepdims=True)
    both = ahead * back
    node = both[:, :, 1] / both.sum(axis=2)
    pair = ahead[:, :-1, :, None] * tie * (potential * back)[:, 1:, None, :]
    return node, pair / pair.sum(axis=(2, 3), keepdims=True)


def train(docs: DataFrame, labels: DataFrame, max_documents: int = FIT_DOCUMENTS, max_lines: int = FIT_LINES) -> Model | None:
    """A model from the labelled documents whose ``crc32(doc_id) mod 5`` is not 0; None if there are none.

    Takes the ``max_documents`` of smallest hash, whole, and of these fewer if they have more than ``max_lines`` lines together
    (one that does not fit is passed over; if none fits, the shortest is taken); their features are computed where the documents
    are. Repeated labels of a document count once, null ones not at all; of unlike texts of one id the one of smallest hash counts.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_documents)
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(lines_of(text)).astype(np.float32).tobytes() for text in batch.column("text").to_pylist()]
        return pa.record_batch({"doc_id": batch.column("doc_id"), "quality": batch.column("quality"), "x": pa.array(found, pa.binary())})

    # at most max_documents ids of eight bytes are broadcast
    alike = Window.partitionBy("doc_id").orderBy("text_hash", "text")
    texts = whole_text(docs).join(F.broadcast(chosen), "doc_id").withColumn("text_hash", F.xxhash64("text"))
    texts = texts.withColumn("copy", F.row_number().over(alike)).where("copy = 1").select("doc_id", "text", "quality")
    texts = materialize(texts, "labelled")
    sizes = texts.select("doc_id", F.size(F.split("text", "\n", -1)).alias("lines"), F.xxhash64("doc_id").alias("hash")).collect()
    if not sizes:
        return None
    taken, total = [], 0
    for row in sorted(sizes, key=lambda r: (r.hash, r.doc_id)):
        if total + row.lines <= max_lines:
            taken.append(row.doc_id)
            total += row.lines
    taken = taken or [min(sizes, key=lambda r: (r.lines, r.hash)).doc_id]
    some = texts.where(F.col("doc_id").isin(taken))
    ordered = sorted(map_batches(some, run, "doc_id long, quality int, x binary").collect(), key=lambda r: r.doc_id)
    sequences = [np.frombuffer(bytes(r.x), np.float32).reshape(-1, N_FEATURES).astype(float) for r in ordered]
    return fit(sequences, [int(r.quality) for r in ordered])


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, text_hash, score`` of every row. Null and empty texts are one empty line; without a model all score 0.5."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [0.5 if model is None else model.score(text) for text in batch.column("text").to_pylist()]
        return pa.record_batch({"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "score": pa.array(found, pa.float64())})

    return map_batches(whole_text(docs).withColumn("text_hash", F.xxhash64("text")), run, "doc_id long, text_hash long, score double")


def keep_good(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [0.5 if model is None else model.score(text or "") for text in batch.column("text").to_pylist()]
        return batch.filter(pa.array([score >= threshold for score in scores], pa.bool_()))

    return map_batches(docs, run, docs.schema)
