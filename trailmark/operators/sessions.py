"""Sessions and users.

A session of a client ends where the next event is more than ``gap`` seconds away. That depends only on the distinct
seconds at which the client was active, so events are first combined per (client, second), before the shuffle. Seconds are
then chained within (client, day), at most 86,400 rows each, and what is left of a day, one row per run of seconds, is chained
over the days of a client: at most 49 rows a day with a gap of half an hour, however many events the client has.

Events without a client belong to no session. Events without a timestamp come last: the first one of a client stays in
the session before it, every further one is a session of its own (it has no previous time to compare with).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import PURCHASE
from ..functions.times import micros, whole_seconds

SESSION_GAP_SECONDS = 1800
_DAY = 86_400
_SLICE_BITS = 16
_SLICE = 1 << _SLICE_BITS
_DATED = "client_id IS NOT NULL AND timestamp_utc IS NOT NULL"

#: figures of a second, and how those of several are combined
_FIGURES = {
    "start": (lambda: F.min("timestamp_utc"), F.min),
    "end": (lambda: F.max("timestamp_utc"), F.max),
    "last_touch": (
        lambda: F.max(F.when(F.expr(f"utm_source IS NOT NULL AND {_DATED}"), F.struct("timestamp_utc", "row_seq", "utm_source"))),
        F.max,
    ),
    "bought": (lambda: F.count_if((F.col("event_name") == PURCHASE) & F.col("timestamp_utc").isNotNull()), F.sum),
}


SESSION_FIGURES = ("start", "end", "last_touch", "bought")


def session_id() -> Column:
    return F.concat(F.col("client_id"), F.lit("_session_"), F.col("session_seq").cast("string"))


def _duration(start: str, end: str) -> Column:
    return whole_seconds(F.col(end)) - whole_seconds(F.col(start))


def seconds(events: DataFrame, gap: int, *figures: str) -> DataFrame:
    """One row per client and active second: client_id, day, sec, n_events, run (numbered within the day) and the figures.

    The row with a NULL second stands for all undated events of the client.
    """
    grid = (
        events.where(F.col("client_id").isNotNull())
        .groupBy("client_id", whole_seconds(F.col("timestamp_utc")).alias("sec"))
        .agg(F.count("*").alias("n_events"), *[_FIGURES[name][0]().alias(name) for name in figures])
        .withColumn("day", F.floor(F.col("sec") / _DAY))
    )
    in_day = Window.partitionBy("client_id", "day").orderBy("sec")
    opened = F.when(F.col("sec") - F.lag("sec").over(in_day) > gap, 1).otherwise(0)
    return grid.withColumn("opened", opened).withColumn("run", F.sum("opened").over(in_day)).drop("opened")


def day_runs(grid: DataFrame, *figures: str) -> DataFrame:
    """One row per run of seconds within a day: client_id, day, run, first_sec, last_sec, n_events and the figures.

    It depends on the events of that day alone. The run of the undated events has a NULL day.
    """
    return grid.groupBy("client_id", "day", "run").agg(
        F.min("sec").alias("first_sec"),
        F.max("sec").alias("last_sec"),
        F.sum("n_events").alias("n_events"),
        *[_FIGURES[name][1](name).alias(name) for name in figures],
    )


def opens_session(previous: Column, gap: int) -> Column:
    """Whether a run opens a session, by the last second of the run before it."""
    return previous.isNull() | (F.col("first_sec") - previous > gap)


def runs(grid: DataFrame, gap: int, *figures: str) -> DataFrame:
    """One row per run of seconds within a day, with the number of its session.

    Columns: client_id, day, run, n_events, first_seq, session_seq and the figures. The run of the undated events (NULL day)
    takes the sessions first_seq .. session_seq, of which ``shared`` says whether the first one is a dated session too.
    """
    found = day_runs(grid, *figures)
    by_time = Window.partitionBy("client_id").orderBy(F.asc_nulls_last("first_sec"))
    previous = F.lag("last_sec").over(by_time)
    undated = F.col("first_sec").isNull()
    opened = (
        F.when(undated, F.col("n_events") - F.col("shared").cast("int"))
        .when(opens_session(previous, gap), 1)
        .otherwise(0)
    )
    numbered = (
        found.withColumn("shared", undated & previous.isNotNull())
        .withColumn("opened", opened)
        .withColumn("session_seq", F.sum("opened").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    )
    first = F.when(undated, F.col("session_seq") - F.col("n_events") + 1).otherwise(F.col("session_seq"))
    return numbered.withColumn("first_seq", first).drop("opened")


def sessions(events: DataFrame, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    """One row per session with bounds, duration and the last campaign source seen in it.

    Also carries ``purchases``, the dated purchases of the session. One pass over the events.
    """
    return sessions_of(runs(seconds(events, gap, *SESSION_FIGURES), gap, *SESSION_FIGURES))


def sessions_of(placed: DataFrame) -> DataFrame:
    """The sessions of numbered runs with the session figures."""
    # undated events open one session each; very many are written out in slices of numbers that spread over tasks
    low = F.col("first_seq") + F.col("shared").cast("int")
    slices = F.when(low <= F.col("session_seq"), F.sequence(low, F.col("session_seq"), F.lit(_SLICE).cast("bigint")))
    sliced = placed.withColumn("low", F.explode(F.when(F.col("day").isNull(), slices).otherwise(F.array("session_seq"))))
    numbers = F.sequence("low", F.least(F.col("session_seq"), F.col("low") + _SLICE - 1))
    spread = sliced.repartition("client_id", "low").withColumn("session_seq", F.explode(numbers))
    found = spread.groupBy("client_id", "session_seq").agg(
        F.min("start").alias("session_start"),
        F.max("end").alias("session_end"),
        F.max("last_touch")["utm_source"].alias("session_last_utm"),
        F.sum("bought").alias("purchases"),
    )
    return found.withColumns(
        {"session_id": session_id(), "session_duration_seconds": _duration("session_start", "session_end")}
    )


def _undated(events: DataFrame) -> DataFrame:
    """Undated events of clients; a table stored by day has them in one folder."""
    found = events.where("client_id IS NOT NULL AND timestamp_utc IS NULL")
    return found.where("dt IS NULL") if "dt" in events.columns else found


def _on_runs(events: DataFrame, placed: DataFrame, grid: DataFrame, columns: list[str]) -> DataFrame:
    """Every event of a client with session_seq and the given columns of its run.

    ``placed`` has one row per run and ``grid`` one per second, so a dated event has one match. Undated events are numbered
    by row order in slices of at most 65,536 rows, and joined to one row per client and slice.
    """
    by_second = grid.where("sec IS NOT NULL").join(
        placed.where("day IS NOT NULL").select("client_id", "day", "run", "session_seq", *columns), ["client_id", "day", "run"]
    )
    dated = (
        events.where(_DATED)
        .withColumn("sec", whole_seconds(F.col("timestamp_utc")))
        .join(by_second.select("client_id", "sec", "session_seq", *columns), ["client_id", "sec"])
        .drop("sec")
    )
    undated = _undated(events).withColumn("slice", F.shiftright("row_seq", _SLICE_BITS))
    before = F.sum("rows").over(Window.partitionBy("client_id").orderBy("slice")) - F.col("rows")
    of_client = placed.where("day IS NULL").select("client_id", "first_seq", "shared", *columns)
    slices = (
        undated.groupBy("client_id", "slice")
        .agg(F.count("*").alias("rows"))
        .withColumn("before", before)
        .join(of_client, "client_id")
    )
    nth = F.row_number().over(Window.partitionBy("client_id", "slice").orderBy("row_seq"))
    joined = F.col("shared") & (F.col("session_seq") == F.col("first_seq"))
    numbered = (
        undated.withColumn("nth", nth)
        .join(slices, ["client_id", "slice"])
        .withColumn("session_seq", F.col("first_seq") + F.col("before") + F.col("nth") - 1)
        .withColumns({name: F.when(joined, F.col(name)) for name in columns})
        .drop("nth", "slice", "rows", "before", "first_seq", "shared")
    )
    return dated.unionByName(numbered)


def session_events(events: DataFrame, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Every event of a client with the number and bounds of its session."""
    grid = seconds(events, gap, "start", "end")
    # a session may have runs on several days, and the undated run takes the bounds of the session it shares
    in_session = Window.partitionBy("client_id", "first_seq")
    bounds = {"session_start": F.min("start").over(in_session), "session_end": F.max("end").over(in_session)}
    placed = runs(grid, gap, "start", "end").withColumns(bounds)
    return _on_runs(events, placed, grid, ["session_start", "session_end"]).withColumns(
        {"session_id": session_id(), "session_duration_seconds": _duration("session_start", "session_end")}
    )


def session_sequence(events: DataFrame, gap: int = SESSION_GAP_SECONDS, crowd: int = _SLICE) -> DataFrame:
    """Every event of a client with its session and its ``position`` there, from 1, by time and row order.

    The events before a second are counted over the seconds of a day and over the runs of a session, those within a second by
    its rows, in parts where they are more than ``crowd``; so no array grows with a session, and no task with a second.
    """
    narrow = events.select(*[c for c in events.columns if c in ("client_id", "timestamp_utc", "row_seq", "event_name", "page_url", "dt")])
    grid = seconds(narrow, gap)
    in_run = Window.partitionBy("client_id", "day", "run").orderBy("sec")
    counted = grid.withColumn("within", F.sum("n_events").over(in_run) - F.col("n_events"))
    in_session = Window.partitionBy("client_id", "first_seq").orderBy(F.asc_nulls_last("first_sec"))
    earlier = F.coalesce(F.sum("n_events").over(in_session.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = runs(grid, gap).withColumn("earlier", earlier)
    by_second = (
        counted.where("sec IS NOT NULL")
        .join(placed.where("day IS NOT NULL").select("client_id", "day", "run", "session_seq", "earlier"), ["client_id", "day", "run"])
        .select("client_id", "sec", "session_seq", "n_events", (F.col("earlier") + F.col("within")).alias("earlier"))
    )
    # a second of very many events is numbered in parts: by microsecond, and there by slices of the row order
    crowded = F.col("n_events") > crowd
    part = {"part_us": F.when(crowded, micros(F.col("timestamp_utc"))), "part_seq": F.when(crowded, F.shiftright("row_seq", _SLICE_BITS))}
    of_part = ["client_id", "sec", "part_us", "part_seq"]
    timed = narrow.where(_DATED).withColumn("sec", whole_seconds(F.col("timestamp_utc")))
    hot = timed.select("client_id", "sec", "timestamp_utc", "row_seq").join(grid.where(crowded).select("client_id", "sec", "n_events"), ["client_id", "sec"])
    sizes = hot.withColumns(part).groupBy(*of_part).agg(F.count("*").alias("rows"))
    ahead = F.sum("rows").over(Window.partitionBy("client_id", "sec").orderBy("part_us", "part_seq")) - F.col("rows")
    in_part = Window.partitionBy(*of_part).orderBy("timestamp_utc", "row_seq")
    dated = (
        timed.join(by_second, ["client_id", "sec"])
        .withColumns(part)
        .withColumn("nth", F.row_number().over(in_part))
        .join(sizes.withColumn("ahead", ahead).drop("rows"), of_part, "left")
        .withColumn("position", F.col("earlier") + F.coalesce("ahead", F.lit(0)) + F.col("nth"))
        .drop("sec", "nth", "earlier", "ahead", "n_events", "part_us", "part_seq")
    )
    undated = _on_runs(narrow, placed, grid, ["earlier"]).where("timestamp_utc IS NULL")
    undated = undated.withColumn("position", F.coalesce("earlier", F.lit(0)) + 1).drop("earlier")
    return dated.unionByName(undated).withColumn("session_id", session_id())


def users(events: DataFrame, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    """One row per client: first and last seen, sessions, and how many user agents; ``user_agents`` lists those."""
    seen = (
        runs(seconds(events, gap, "start", "end"), gap, "start", "end")
        .groupBy("client_id")
        .agg(
            F.min("start").alias("first_seen"),
            F.max("end").alias("last_seen"),
            F.max("session_seq").alias("session_count"),
        )
    )
    agents = user_agents(events).groupBy("client_id").agg(F.count("*").alias("n_user_agents"))
    return seen.join(agents, "client_id", "left").withColumn("n_user_agents", F.coalesce("n_user_agents", F.lit(0)))


def user_agents(events: DataFrame) -> DataFrame:
    """Distinct (client, user agent) pairs."""
    return (
        events.where("client_id IS NOT NULL AND user_agent IS NOT NULL").select("client_id", "user_agent").distinct()
    )


def client_activity(events: DataFrame, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Events and sessions per client."""
    return (
        runs(seconds(events, gap), gap)
        .groupBy("client_id")
        .agg(F.sum("n_events").alias("n_events"), F.max("session_seq").alias("n_sessions"))
    )


def purchase_sessions(events: DataFrame, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Every purchase with the session it falls into; none without a client or a timestamp.

    Sessions of a client do not overlap, so a purchase's own second names its session.
    """
    bought = events.where(F.col("event_name") == PURCHASE)
    grid = seconds(events, gap, "bought")
    placed = runs(grid, gap).where("day IS NOT NULL").select("client_id", "day", "run", "session_seq")
    of_second = grid.where("bought > 0").join(placed, ["client_id", "day", "run"]).select("client_id", "sec", "session_seq")
    found = (
        bought.where(_DATED)
        .withColumn("sec", whole_seconds(F.col("timestamp_utc")))
        .join(of_second, ["client_id", "sec"], "left")
        .drop("sec")
    )
    return found.unionByName(bought.where(f"NOT ({_DATED})"), allowMissingColumns=True).withColumn(
        "session_id", session_id()
    )
