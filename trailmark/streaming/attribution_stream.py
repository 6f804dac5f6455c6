"""Attribution as a stream: purchases leave once, with their first and last touch, when no earlier event can arrive any more.

Touches and purchases go to keyed state. A purchase waits there until the watermark has passed it; a timer then looks up the touches
of its seven days and lets it go. Touches are combined per microsecond and dropped when no waiting or coming purchase can look back
on them, so the state of a client holds seven days and the watermark's delay, whatever the length of the stream.

A client may hold a third of all events. So its touches are dealt to ``parts`` keys by their minute, and its purchases go to all of
these; each key finds the first and last touch among its own, and the few rows of a purchase, which all leave in the same batch, are
put together before they are written.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.text import PURCHASE
from ..functions.times import MICROS, micros
from ..operators.attribution import LOOKBACK_DAYS, revenue_of

PARTS = 8
_UTM = ("utm_source", "utm_medium", "utm_campaign")
_TOUCH = ", ".join(["seq bigint", *[f"{name} string" for name in _UTM]])
_ENDS = ", ".join(f"{which}_{field}" for which in ("first", "last") for field in ["us bigint", *_TOUCH.split(", ")])
_OUT = f"client_id string, part int, us bigint, row_seq bigint, revenue double, {_ENDS}"
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LookBack(StatefulProcessor):
    """Touches by microsecond and purchases that wait, of one client and part."""

    def __init__(self, days: int = LOOKBACK_DAYS):
        self.reach = days * 86_400 * MICROS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ends = ", ".join(f"{which}_{field}" for which in ("first", "last") for field in _TOUCH.split(", "))
        self.touches = handle.getMapState("touches", "us bigint", ends)
        self.waiting = handle.getMapState("waiting", "us bigint, row_seq bigint", "revenue double")
        self.swept = handle.getValueState("swept", "us bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for row in batch.itertuples(index=False):
                if row.is_touch:
                    self._touch(row)
                if row.is_purchase:
                    self.waiting.updateValue((row.us, row.row_seq), (row.revenue,))
                    self.handle.registerTimer(row.us // 1000 + 1)
                elif row.is_touch:
                    self.handle.registerTimer((row.us + self.reach) // 1000 + 2)
        return iter(())

    def _touch(self, row) -> None:
        own = (row.row_seq, *(getattr(row, name) for name in _UTM))
        known = self.touches.getValue((row.us,)) if self.touches.containsKey((row.us,)) else None
        first = own if known is None or own[0] < known[0] else tuple(known[:4])
        last = own if known is None or own[0] > known[4] else tuple(known[4:])
        self.touches.updateValue((row.us,), (*first, *last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The first timer of a batch lets all due purchases go; the others find nothing left to do."""
        past = timerValues.getCurrentWatermarkInMs() * 1000
        if self.swept.exists() and self.swept.get()[0] == past:
            return
        self.swept.update((past,))
        waiting = sorted((us, seq, value[0]) for (us, seq), value in self.waiting.iterator())
        touches = sorted((entry[0], tuple(value)) for entry, value in self.touches.iterator())
        times = [at for at, _ in touches]
        due, out = waiting[: bisect_left(waiting, (past,))], []
        for us, seq, revenue in due:
            low, high = bisect_left(times, us - self.reach), bisect_right(times, us)
            ends = (None,) * 10
            if low < high:
                ends = (times[low], *touches[low][1][:4], times[high - 1], *touches[high - 1][1][4:])
            out.append((key[0], key[1], us, seq, revenue, *ends))
            self.waiting.removeKey((us, seq))
        oldest = min(past, *[us for us, _, _ in waiting[len(due) :][:1]], past)
        for at in times[: bisect_left(times, oldest - self.reach)]:
            self.touches.removeKey((at,))
        if out:
            yield pd.DataFrame(out, columns=[field.split()[0] for field in _OUT.split(", ")])


def attributed_stream(events: DataFrame, delay: str = "1 hour", revenue_policy: str = "total", days: int = LOOKBACK_DAYS, parts: int = PARTS) -> DataFrame:
    """Rows of purchases as they leave, one for each part (see ``whole_purchases``), of a stream of cleaned events."""
    is_touch, is_purchase = F.col("utm_source").isNotNull(), F.coalesce(F.col("event_name") == PURCHASE, F.lit(False))
    us = micros(F.col("timestamp_utc"))
    own = F.pmod(F.xxhash64(F.floor(us / (60 * MICROS))), F.lit(parts)).cast("int")
    placed = (
        events.where("client_id IS NOT NULL AND timestamp_utc IS NOT NULL")
        .withWatermark("timestamp_utc", delay)
        .where(is_touch | is_purchase)
        .select("client_id", "timestamp_utc", us.alias("us"), "row_seq", revenue_of(revenue_policy).alias("revenue"), *_UTM, is_touch.alias("touch"), is_purchase.alias("is_purchase"), own.alias("own"))
    )
    every = F.when(F.col("is_purchase"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array("own"))
    dealt = placed.withColumn("part", F.explode(every)).withColumn("is_touch", F.col("touch") & (F.col("part") == F.col("own"))).drop("touch", "own")
    return dealt.groupBy("client_id", "part").transformWithStateInPandas(LookBack(days), _OUT, "append", "eventTime")


def whole_purchases(rows: DataFrame) -> DataFrame:
    """One row per purchase from those of its parts: ``client_id, us, row_seq, revenue`` and both touches."""
    first = F.min(F.when(F.col("first_us").isNotNull(), F.struct("first_us", "first_seq", *[f"first_{name}" for name in _UTM])))
    last = F.max(F.when(F.col("last_us").isNotNull(), F.struct("last_us", "last_seq", *[f"last_{name}" for name in _UTM])))
    found = rows.groupBy("client_id", "us", "row_seq").agg(F.max("revenue").alias("revenue"), first.alias("first"), last.alias("last"))
    return found.select("client_id", "us", "row_seq", "revenue", *[f"{which}.{which}_{name}" for which in ("first", "last") for name in _UTM])


def attribute_stream(events: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Write attributed purchases to a folder of batches as they leave, take in all that has arrived, and stop.

    A batch that is repeated after a failure replaces what it wrote before.
    """
    spark: SparkSession = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)

    def write(rows: DataFrame, batch: int) -> None:
        whole_purchases(rows).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    stream = attributed_stream(events, **options)
    return stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
