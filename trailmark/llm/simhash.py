"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into so few segments that, of two within the radius, one segment differs by at most one bit. Each
segment is indexed as it is and once for each of its bits left out; equal keys then bring together every pair within the
radius, and the bit distance decides. Only distinct fingerprints are indexed, so copies cost nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_batches, whole_text
from .graph import components

BITS = 64
BLOCK = 512  # fingerprints compared at a time; larger groups are compared block by block
_HASHES = 1 << 16  # shingle hashes counted at a time


def fingerprint(text: str, words_per_shingle: int, seed: int = 42) -> int:
    """A bit is 1 if more than half of the shingles' XXH64 have it; no words: 0. As a signed 64-bit number."""
    words = text.encode().lower().split()  # bytes: only A-Z and only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(words_per_shingle, len(words))
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends)]
    count, digest = len(words) - size + 1, xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for first in range(0, count, _HASHES):
        last = min(first + _HASHES, count)
        hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[first:last], ends[first + size - 1 : last + size - 1])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words_per_shingle: int) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row; null and empty texts have fingerprint 0."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(text, words_per_shingle) for text in batch.column("text").to_pylist()]
        return pa.record_batch({"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "fp": pa.array(found, pa.int64())})

    texts = whole_text(docs).withColumn("text_hash", F.xxhash64("text"))
    return map_batches(texts, run, "doc_id long, text_hash long, fp long")


def _masks(max_bits: int) -> list[tuple[int, int, int]]:
    """All index keys in order: number, the bits a key keeps, and the bit of its segment that it leaves out (0: none)."""
    pieces = max_bits // 2 + 1
    borders = [BITS * i // pieces for i in range(pieces + 1)]
    signed = lambda mask: mask - (1 << BITS) if mask >> (BITS - 1) else mask
    found = []
    for low, high in zip(borders, borders[1:]):
        segment = (1 << high) - (1 << low)
        for wild in (0, *(1 << bit for bit in range(low, high))):
            found.append((len(found), signed(segment & ~wild), signed(wild)))
    return found


def _variants(max_bits: int) -> list[list[Column]]:
    return [[F.lit(value).cast("long").alias(name) for name, value in zip(("id", "keep", "wild"), key)] for key in _masks(max_bits)]


def _within_blocks(blocks: DataFrame, max_bits: int) -> DataFrame:
    """Links of one block (``b`` null) or between two, reduced to as many as connect the same fingerprints."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        us, vs = [], []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            fps = np.unique(np.array(a if b is None else a + b, np.int64))
            bits = fps.view(np.uint64)
            near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= max_bits
            labels = np.arange(len(fps))
            while True:  # every fingerprint takes the smallest label near it
                lower = np.where(near, labels[None, :], len(fps)).min(axis=1)
                lower = lower[lower]
                if (lower == labels).all():
                    break
                labels = lower
            linked = labels != np.arange(len(fps))
            us.append(fps[linked])
            vs.append(fps[labels[linked]])
        empty = np.zeros(0, np.int64)
        return pa.record_batch({"u": np.concatenate([empty, *us]), "v": np.concatenate([empty, *vs])})

    return map_batches(blocks.select("a", "b"), run, "u long, v long")


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """``u, v``: links that connect exactly the fingerprints (column ``fp``, distinct) that a chain of pairs within ``max_bits`` connects.

    Groups under one key are compared whole if small, else in blocks of about ``BLOCK`` that spread over tasks; what leaves
    is a spanning set, never all pairs of a group.
    """
    # few bytes, but many keys come of them: dealt out anew, by something else than they are dealt by already
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = _variants(max_bits)
    keyed = fps.repartition(spread, F.xxhash64("fp")).select("fp", F.explode(F.array(*[F.struct(*key) for key in variants])).alias("key")).select(
        "fp",
        F.col("key.id").alias("id"),
        F.col("fp").bitwiseAND(F.col("key.keep")).alias("part"),
        (F.col("fp").bitwiseAND(F.col("key.wild")) != 0).cast("long").alias("side"),
    )
    # a key that leaves a bit out is needed only where that bit differs: equal segments meet under the key of the whole segment;
    # of two fingerprints, the smallest and the largest are all there are
    whole = F.col("id").isin([number for number, (_, _, wild) in enumerate(_masks(max_bits)) if not wild])
    near = F.bit_count(F.col("v").bitwiseXOR(F.col("u"))) <= max_bits
    keys = materialize(
        keyed.groupBy("id", "part")
        .agg(F.count("*").alias("n"), F.sum("side").alias("ones"), F.min("fp").alias("v"), F.max("fp").alias("u"))
        .where((F.col("n") > 2) | (F.col("n") == 2) & near)
        .where(whole | (F.col("ones") > 0) & (F.col("ones") < F.col("n")))
        .select("id", "part", "n", "u", "v"),
        "keys",
    )
    # merged at every size: how many keys there are is not bounded
    sizes = keys.where("n > 2").select("id", "part", F.ceil(F.col("n") / BLOCK).alias("blocks")).hint("merge")
    grouped = materialize(
        keyed.join(sizes, ["id", "part"])
        .groupBy("id", "part", "blocks", F.expr("pmod(xxhash64(fp), blocks)").alias("block"))
        .agg(F.collect_list("fp").alias("fps")),
        "groups",
    )
    single = grouped.select(F.col("fps").alias("a"), F.lit(None).cast("array<long>").alias("b"))
    left = grouped.where("blocks > 1").select("id", "part", "block", F.col("fps").alias("a"))
    right = left.select("id", "part", F.col("block").alias("other"), F.col("a").alias("b"))
    double = left.join(right, ["id", "part"]).where("block < other").select("a", "b")
    return keys.where("n = 2").select("u", "v").unionByName(_within_blocks(single.unionByName(double), max_bits))


def near_duplicates(docs: DataFrame, words_per_shingle: int, max_bits: int) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_hash, fp``, the ``root`` of its group, and the group's smallest ``doc_id``.

    Repeated rows and equal texts share a fingerprint and so a group. A null ``doc_id`` joins groups but never names one,
    unless a group has no other. Empty texts are linked like any others. An empty table gives no rows.
    """
    own = materialize(fingerprints(docs, words_per_shingle), "fingerprints")
    distinct = own.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = components(links(distinct.select("fp"), max_bits))
    rooted = materialize(
        distinct.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "roots"
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return own.join(rooted.join(smallest, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "text_hash", "fp", "root", "component_id"
    )


def one_of_each(docs: DataFrame, words_per_shingle: int, max_bits: int) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, all columns: that of smallest ``doc_id`` (null last), then smallest hash."""
    found = near_duplicates(docs, words_per_shingle, max_bits)
    no_id = F.lit(-(2**63))
    kept = (
        found.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best"))
        .select(F.coalesce("best.doc_id", no_id).alias("kept_id"), F.col("best.text_hash").alias("kept_hash"))
    )
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), no_id).alias("kept_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("kept_hash"),
    )
    keys = ["kept_id", "kept_hash"]
    return keyed.join(kept, keys).dropDuplicates(keys).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
