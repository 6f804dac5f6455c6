"""Records of CSV files whose quoted texts hold line breaks, with many tasks for each file.

A line break ends a record only outside quotes, which a task in the middle of a file cannot see by itself. But it can count:
quotes inside quoted texts are doubled, so a place is inside quotes if the number of quotes before it is odd. One pass adds up the
quotes of each split of a file; the sum over the splits before tells how a split begins. A second pass puts lines together to
records. A record that goes on into later splits leaves parts, at most two for each split, which one small grouping puts together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Endings of compressed files, which Spark does not split.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
PLACE_BITS = 44  # of a place in a file of up to 16 TB
_SHAPE = "path string, place long, part string, text string"


def split_size(spark: SparkSession) -> int:
    """Bytes beyond which Spark gives a file to several tasks."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()
    digits = text.rstrip("bkmgt")
    return int(digits) * _UNITS[text[len(digits) :][:1]]


def lines_of(spark: SparkSession, paths: list[str], plain: Column) -> DataFrame:
    """``path, split, value``: the lines of files; ``split`` is the byte at which the split of a line begins."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(plain.alias("path"), F.col("_metadata.file_block_start").alias("split"), "value")


def splits_inside_quotes(lines: DataFrame) -> dict[str, dict[int, bool]]:
    """For each file, whether its splits begin inside quotes; one entry for each split that has lines."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    odd = lines.groupBy("path", "split").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begins = odd.select("path", "split", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    found: dict[str, dict[int, bool]] = {}
    for row in begins.toLocalIterator():
        found.setdefault(row["path"], {})[row["split"]] = row["inside"]
    return found


def _rows(path: str, places, part: str, texts) -> pa.RecordBatch:
    n = len(texts)
    columns = [pa.array([path] * n, pa.string()), pa.array(places, pa.int64()), pa.array([part] * n, pa.string())]
    return pa.record_batch([*columns, texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())], names=["path", "place", "part", "text"])


class _Split:
    """The records of one split, from its lines in their order, some at a time."""

    def __init__(self, path: str, number: int, split: int, inside: bool):
        self.path, self.inside = path, inside
        # the line at the first byte of a later split belongs to the split before
        self.place = (number << PLACE_BITS) + split + (split > 0)
        self.waiting: list[str] = []
        self.opened, self.from_before = self.place, inside

    def add(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        places = self.place + np.concatenate([[0], np.cumsum(sizes)])
        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
        after = (np.cumsum(quotes) + self.inside) % 2 == 1
        starts = np.flatnonzero(~np.concatenate([[self.inside], after[:-1]]))
        until = int(starts[0]) if len(starts) else len(values)
        if until:  # lines of a record that is open
            self.waiting += values.slice(0, until).to_pylist()
            if not after[until - 1]:
                yield _rows(self.path, [self.opened], "head" if self.from_before else "record", ["\n".join(self.waiting)])
                self.waiting, self.from_before = [], False
        n = len(starts) - bool(len(starts) and after[-1])
        if n:
            ends = [*starts[:n].tolist(), int(starts[n]) if n < len(starts) else len(values)]
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values), "\n")
            yield _rows(self.path, places[starts[:n]], "record", texts)
        if n < len(starts):
            self.opened, self.waiting = int(places[starts[n]]), values.slice(int(starts[n])).to_pylist()
        self.inside, self.place = bool(after[-1]), int(places[-1])

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            yield _rows(self.path, [self.opened], "middle" if self.from_before else "tail", ["\n".join(self.waiting)])


def _assembled(batches: Iterator[pa.RecordBatch], begins) -> Iterator[pa.RecordBatch]:
    current, key = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, splits = batch.column("path"), batch.column("split")
        same = pc.and_(pc.equal(paths[1:], paths[:-1]), pc.equal(splits[1:], splits[:-1])).to_numpy(zero_copy_only=False).astype(bool)
        limits = [0, *(np.flatnonzero(~same) + 1).tolist(), batch.num_rows]
        for first, until in zip(limits, limits[1:], strict=False):
            here = (paths[first].as_py(), splits[first].as_py())
            if here != key:
                if current:
                    yield from current.close()
                number, inside = begins.value[here[0]]
                current, key = _Split(here[0], number, here[1], inside[here[1]]), here
            yield from current.add(batch.column("value").slice(first, until - first))
    if current:
        yield from current.close()


def records(spark: SparkSession, paths: list[str], plain: Column, first: int = 0) -> DataFrame:
    """``path, place, text``: the records of uncompressed files, without the first one of each file, which is its header.

    ``place`` is unique and follows the order of files, which are numbered from ``first`` on, and of their records. Blank records
    are left out, as Spark's reader does. Line ends inside quotes are kept as they are.
    """
    lines = lines_of(spark, paths, plain)
    inside = splits_inside_quotes(lines)
    begins = spark.sparkContext.broadcast({path: (first + n, inside[path]) for n, path in enumerate(sorted(inside))})  # a flag for each split
    parts = lines.mapInArrow(lambda batches: _assembled(batches, begins), _SHAPE)
    cut = parts.where("part <> 'record'")
    number = F.sum((F.col("part") == "tail").cast("int")).over(Window.partitionBy("path").orderBy("place"))
    pieces = F.array_sort(F.collect_list(F.struct("place", "text")))
    joined = (
        cut.withColumn("number", number)
        .groupBy("path", "number")
        .agg(F.min("place").alias("place"), F.array_join(F.transform(pieces, lambda piece: piece["text"]), "\n").alias("text"))
    )
    every = parts.where("part = 'record'").select("path", "place", "text").unionByName(joined.select("path", "place", "text"))
    return every.where(F.col("place") % (1 << PLACE_BITS) > 0).withColumn("text", F.regexp_replace("text", r"\r$", "")).where("trim(text) <> ''")
