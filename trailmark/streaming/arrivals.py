"""Drifting CSV files as they arrive, are replaced and go.

A ledger keeps of every file seen its size, time and source, and of every source the days that its cleaned rows fell into. A batch
compares the listing with the ledger, looks up the headers of files that are new or changed and of no others, reads and cleans
these, and replaces the days that they touch or did touch before. Copies of a row are told within its source, and a source is
always read as a whole, so the result is that of one run over all files.

Each batch writes to the ledger twice: before the days are replaced, as sources in work, and after. A batch that dies in between
is thereby noticed and done again by the next one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import CANONICAL
from ..operators import cleaning
from ..session import discard, materialize
from ..sources import csv_drop
from ..sources.versioned import VersionedTable, append_log, day_of, read_log

_FILES = "seq long, path string, source_file string, length long, modified timestamp, columns array<string>, days array<string>, done boolean"
#: columns of the raw files that are kept; others come and go with the headers
_RAW = ("source_file", *CANONICAL.values(), "source_file_referrer_missing", "row_seq")


@dataclass(frozen=True)
class Batch:
    """What a batch has found: paths of new, changed and gone files, and the days that were replaced."""

    new: tuple[str, ...] = ()
    changed: tuple[str, ...] = ()
    gone: tuple[str, ...] = ()
    days: tuple[str, ...] = ()


class Drop:
    """The stored state of a folder of arriving files, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, lineage: str = "file"):
        self.spark, self.lineage, self.root = spark, lineage, root.rstrip("/")
        self.ledger = f"{self.root}/ledger"
        self.events = VersionedTable(spark, f"{self.root}/events", day_of())

    def known(self) -> DataFrame:
        """The latest ledger entry of each file; without a length for files that are gone, not ``done`` while in work."""
        log = read_log(self.spark, self.ledger, _FILES)
        log = self.spark.createDataFrame([], _FILES) if log is None else log
        entry = F.struct("source_file", "length", "modified", "columns", "days", "done")
        return log.groupBy("path").agg(F.max_by(entry, "seq").alias("entry"), F.max("seq").alias("seq")).select("path", "seq", "entry.*")

    def file_schemas(self) -> DataFrame:
        """The columns of each source, as ``csv_drop.file_schemas`` has them, out of the ledger."""
        return csv_drop.file_schemas(self.known().where("length IS NOT NULL"))

    def pending(self, pattern: str) -> DataFrame:
        """Files that differ from the ledger: ``path, source_file, kind``, kind being new, changed or gone."""
        here = csv_drop.listing(self.spark, pattern).withColumn("source_file", csv_drop.source_of(F.col("path"), self.lineage))
        known = self.known().select(
            "path", F.col("source_file").alias("was_of"), F.col("length").alias("was_long"), F.col("modified").alias("was_modified"), "done"
        )
        same = ~F.col("done") | ~F.col("length").eqNullSafe(F.col("was_long")) | ~F.col("modified").eqNullSafe(F.col("was_modified"))
        kind = F.when(F.col("done").isNull(), "new").when(same, F.when(F.col("length").isNull(), "gone").otherwise("changed"))
        found = here.join(known, "path", "full").withColumn("kind", kind).where("kind IS NOT NULL")
        return found.select("path", F.coalesce("source_file", "was_of").alias("source_file"), "kind")

    def _catalog(self, pattern: str, sources: DataFrame) -> DataFrame:
        """Headers of the files of some sources, as they are now; no other file is opened."""
        named = csv_drop.listing(self.spark, pattern).withColumn("source_file", csv_drop.source_of(F.col("path"), self.lineage))
        files = materialize(named.join(sources, "source_file", "left_semi").select("path", "length", "modified"), "arrived")
        paths = [row["path"] for row in files.select("path").collect()]  # what has arrived since the last batch
        return materialize(csv_drop.headers_of(files, paths, self.lineage), "headers")

    def arrive(self, pattern: str, log: str | None = None) -> Batch:
        """Take in what has arrived, changed or gone since the last batch. Nothing new costs one listing.

        With ``log``, the path of a log of a step that follows, the days of earlier batches which that step has not marked by
        ``taken_in`` are among the days returned.
        """
        batch = self._arrive(pattern)
        return batch if log is None else replace(batch, days=tuple(sorted({*batch.days, *self._waiting(log)})))

    def _waiting(self, log: str) -> set[str]:
        written = read_log(self.spark, self.ledger, _FILES)
        if written is None:
            return set()
        taken = read_log(self.spark, log, "seq long")
        upto = -1 if taken is None else taken.agg(F.max("seq")).first()[0]
        return {row[0] for row in written.where(F.col("seq") > upto).select(F.explode("days")).distinct().collect()}

    def taken_in(self, log: str) -> None:
        """Mark that a step that follows has taken in all days of the ledger so far."""
        seq = read_log(self.spark, self.ledger, _FILES).agg(F.max("seq")).first()[0]
        append_log(self.spark.createDataFrame([(seq,)], "seq long"), log)

    def _arrive(self, pattern: str) -> Batch:
        pending = materialize(self.pending(pattern), "pending")
        rows = pending.select("path", "kind").collect()  # what has arrived since the last batch
        if not rows:
            return Batch()
        sources = pending.select("source_file").distinct()
        catalog = self._catalog(pattern, sources)
        stored = None
        if not catalog.where(F.size("header") > 0).isEmpty():
            raw = csv_drop.read_events(self.spark, pattern, self.lineage, catalog=catalog).select(*_RAW)
            stored = materialize(cleaning.clean_events(raw), "fresh")

        known = materialize(self.known().join(sources, "source_file", "left_semi"), "known")
        seq = 1 + (self.known().agg(F.max("seq")).first()[0] or 0)
        before = known.select(F.explode("days").alias("day"))
        days_now = None
        if stored is not None:
            days_now = materialize(stored.groupBy("source_file").agg(F.array_sort(F.collect_set(day_of())).alias("days")), "days")
        touched = before if days_now is None else before.union(days_now.select(F.explode("days")))
        days = sorted(row["day"] for row in touched.distinct().collect())

        named = catalog.select("path", "source_file").unionByName(known.select("path", "source_file")).distinct()
        # while in work a source has all days of before and now, so that a batch that dies is done again in full
        work = named.select(F.lit(seq).alias("seq"), "*", F.array(*map(F.lit, days)).cast("array<string>").alias("days"), F.lit(False).alias("done"))
        current = named.join(catalog.select("path", "length", "modified", "columns"), "path", "left")
        current = current.join(days_now, "source_file", "left") if days_now is not None else current.withColumn("days", F.array().cast("array<string>"))
        done = materialize(current.select(F.lit(seq + 1).alias("seq"), "*", F.lit(True).alias("done")), "ledger")
        append_log(work, self.ledger)

        kept = self.events.read(days)
        if kept is not None:
            kept = kept.join(sources, "source_file", "left_anti")
        merged = kept if stored is None else stored if kept is None else kept.unionByName(stored)
        if merged is not None:
            self.events.replace(merged, days)
        append_log(done, self.ledger)
        discard(pending, catalog, known, done, *[part for part in (stored, days_now) if part is not None])
        by_kind = {kind: tuple(sorted(r["path"] for r in rows if r["kind"] == kind)) for kind in ("new", "changed", "gone")}
        return Batch(**by_kind, days=tuple(days))


def arriving_drop(drop: Drop, folder: str, checkpoint: str, work: Callable[[Batch], None] | None = None) -> StreamingQuery:
    """A stream over ``folder`` that takes in what has arrived and then stops; ``work`` gets each batch that found something.

    The stream says when there are new files; the ledger says which, and sees replaced and removed ones too.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = drop.spark.readStream.schema(schema).format("binaryFile").option("recursiveFileLookup", True).load(folder)

    def run(_: DataFrame, __: int) -> None:
        batch = drop.arrive(folder)
        if work and batch.days:
            work(batch)

    return files.select("path").writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
