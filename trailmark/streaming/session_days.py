"""Numbered sessions as days arrive.

Stored are the runs of seconds of each day with the numbers of their sessions (see ``operators.sessions``), and a frontier: of
each client the last second and the last session number so far. A batch makes the runs of its own days anew, from the events of
these days, and numbers them on from the frontier; no event of another day is read.

Where a batch brings rows of a day that a client has already gone beyond, the runs of this client are numbered again from that day
on: runs, not events, and of such clients only. A session that goes on over days is the sum of its runs, so nothing stored has to
be changed when it does.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import sessions
from ..operators.sessions import SESSION_FIGURES, SESSION_GAP_SECONDS
from ..session import discard, materialize
from ..sources.versioned import UNDATED, VersionedTable

_DAY = 86_400


def _part() -> Column:
    """The day of a run, as the tables by day have it."""
    return F.coalesce(F.date_from_unix_date(F.col("day").cast("int")).cast("string"), F.lit(UNDATED))


class SessionDays:
    """Runs, frontier and sessions of the events of a table by day, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, gap: int = SESSION_GAP_SECONDS):
        self.spark, self.gap = spark, gap
        self.runs = VersionedTable(spark, f"{root}/runs", _part())
        self.front = VersionedTable(spark, f"{root}/frontier", F.lit("all"))

    def frontier(self) -> DataFrame:
        """``client_id, last_sec, last_seq`` of every client with dated events."""
        found = self.front.read()
        return self.spark.createDataFrame([], "client_id string, last_sec long, last_seq long") if found is None else found

    def _base(self, changed: DataFrame) -> DataFrame:
        """``client_id, since, last_sec, last_seq``: where each changed client stood before its first changed day (``since``)."""
        met = changed.join(self.frontier(), "client_id", "left").withColumn("late", F.coalesce(F.floor(F.col("last_sec") / _DAY) >= F.col("since"), F.lit(False)))
        met = materialize(met, "met")
        stored = self.runs.read(part for part in self.runs.parts() if part != UNDATED)
        late = met.where("late").select("client_id", "since")
        if stored is None or late.isEmpty():
            return met
        before = (
            stored.select("client_id", "day", F.col("last_sec").alias("sec"), F.col("session_seq").alias("seq"))
            .join(late, "client_id")
            .where("day < since")
            .groupBy("client_id")
            .agg(F.max(F.struct("sec", "seq")).alias("before"))
        )
        stood = [F.when(F.col("late"), F.col(f"before.{old}")).otherwise(F.col(new)).alias(new) for old, new in (("sec", "last_sec"), ("seq", "last_seq"))]
        return materialize(met.join(before, "client_id", "left").select("client_id", "since", "late", *stood), "base")

    def update(self, events: VersionedTable, days: Iterable[str]) -> list[str]:
        """Bring the sessions up to date after ``days`` of ``events`` were replaced. Returns the days whose runs have changed.

        May be repeated: a batch that has been taken in already, in full or in part, changes nothing.
        """
        days = sorted(set(days))
        fresh = events.read(days)
        old = self.runs.read(days)
        if fresh is not None:
            made = sessions.day_runs(sessions.seconds(fresh, self.gap, *SESSION_FIGURES), *SESSION_FIGURES)
            made = materialize(made.drop("run"), "runs")
        elif old is None:
            return []
        else:
            made = self.spark.createDataFrame([], old.drop("session_seq").schema)
        dated = made.where("day IS NOT NULL")
        seen = dated.select("client_id", "day")
        if old is not None:
            seen = seen.unionByName(old.where("day IS NOT NULL").select("client_id", "day"))
        base = self._base(seen.groupBy("client_id").agg(F.min("day").alias("since")))

        rows, later = dated, None
        late = base.where("late").select("client_id", "since")
        others = [part for part in self.runs.parts() if part != UNDATED and part not in days]
        stored = self.runs.read(others)
        if stored is not None and not late.isEmpty():
            later = materialize(stored.join(late, "client_id").where("day > since").drop("since"), "later")
            rows = rows.unionByName(later.drop("session_seq"))
        by_time = Window.partitionBy("client_id").orderBy("first_sec")
        previous = F.coalesce(F.lag("last_sec").over(by_time), F.col("stood_sec"))
        opened = F.when(sessions.opens_session(previous, self.gap), 1).otherwise(0)
        stood = base.select("client_id", F.col("last_sec").alias("stood_sec"), F.coalesce("last_seq", F.lit(0).cast("long")).alias("stood_seq"))
        numbered = (
            rows.join(stood, "client_id")
            .withColumn("opened", opened)
            .withColumn("session_seq", F.col("stood_seq") + F.sum("opened").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
            .drop("opened", "stood_sec", "stood_seq")
        )
        numbered = materialize(numbered, "numbered")

        result, touched = numbered, list(days)
        if later is not None:
            again = sorted({row["part"] for row in later.select(_part().alias("part")).distinct().collect()})
            if again:
                kept = self.runs.read(again).join(later.select("client_id", "day"), ["client_id", "day"], "left_anti")
                result, touched = result.unionByName(kept), sorted({*days, *again})
        if UNDATED in days:
            undated = made.where("day IS NULL").withColumn("session_seq", F.lit(None).cast("long"))
            result = result.unionByName(undated)
        self.runs.replace(result, touched)

        ends = numbered.groupBy("client_id").agg(F.max("last_sec").alias("sec"), F.max("session_seq").alias("seq"))
        now = base.join(ends, "client_id", "left").select("client_id", F.coalesce("sec", "last_sec").alias("last_sec"), F.coalesce("seq", "last_seq").alias("last_seq"))
        front = self.frontier().join(base, "client_id", "left_anti").unionByName(now.where("last_sec IS NOT NULL"))
        self.front.replace(front, ["all"])
        discard(numbered, base, *[part for part in (later, made if fresh is not None else None) if part is not None])
        return touched

    def placed(self) -> DataFrame | None:
        """All runs with the numbers of their sessions, as ``operators.sessions.runs`` has them."""
        stored = self.runs.read()
        if stored is None:
            return None
        dated = stored.where("day IS NOT NULL").withColumns({"first_seq": F.col("session_seq"), "shared": F.lit(False)})
        # undated events come last: the first one is in the session before it, all others open one each
        shared = F.col("last_seq").isNotNull()
        undated = (
            stored.where("day IS NULL")
            .drop("session_seq")
            .join(self.frontier().select("client_id", "last_seq"), "client_id", "left")
            .withColumn("shared", shared)
            .withColumn("session_seq", F.coalesce("last_seq", F.lit(0).cast("long")) + F.col("n_events") - F.col("shared").cast("int"))
            .withColumn("first_seq", F.col("session_seq") - F.col("n_events") + 1)
            .drop("last_seq")
        )
        return dated.unionByName(undated)

    def sessions(self) -> DataFrame | None:
        """All sessions, as ``operators.sessions.sessions`` has them, from the stored runs."""
        placed = self.placed()
        return None if placed is None else sessions.sessions_of(placed)
