"""Distinct clients over rolling windows of days.

The exact form counts distinct clients of each window from the distinct (client, device, day) rows. The other form keeps a HyperLogLog
sketch per day and device, of 4 kB whatever the day's traffic, which is made once and united for any window later; it is for
windows over stored days, where reading their events again costs more than an error of a few percent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.user_agent import device_type

WINDOWS = (7, 28)
LG_K = 12
#: standard error of a count, relative: 1.04 / sqrt(2 ** LG_K)
STANDARD_ERROR = 0.01625


def _day() -> Column:
    return F.to_date("timestamp_utc").alias("day")


def _active(events: DataFrame) -> DataFrame:
    return events.where("client_id IS NOT NULL AND timestamp_utc IS NOT NULL")


def _windows(rows: DataFrame, days: tuple[int, ...]) -> DataFrame:
    """Each row of a day once for every window that holds the day; windows end on days that have rows."""
    ends = rows.select(F.col("day").alias("until")).distinct()
    spans = F.explode(F.array(*[F.lit(n) for n in days])).alias("days")
    reached = rows.select("*", spans).withColumn("until", F.explode(F.sequence("day", F.date_add("day", F.col("days") - 1))))
    return reached.join(ends, "until", "left_semi").drop("day").withColumnRenamed("until", "day")


def rolling_users(events: DataFrame, days: tuple[int, ...] = WINDOWS) -> DataFrame:
    """``day, days, device_type, users``: distinct clients of a device in the ``days`` days up to a day, exactly."""
    seen = _active(events).select("client_id", device_type(F.col("user_agent")).alias("device_type"), _day()).distinct()
    return _windows(seen, days).groupBy("day", "days", "device_type").agg(F.countDistinct("client_id").alias("users"))


def daily_sketches(events: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``day, device_type, sketch`` of the clients; sketches of any days may be stored, added to and united."""
    return _active(events).groupBy(_day(), device_type(F.col("user_agent")).alias("device_type")).agg(F.hll_sketch_agg("client_id", F.lit(lg_k)).alias("sketch"))


def rolling_users_approx(sketches: DataFrame, days: tuple[int, ...] = WINDOWS) -> DataFrame:
    """``rolling_users`` from stored sketches, within a standard error of 1.6 percent."""
    return _windows(sketches, days).groupBy("day", "days", "device_type").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))
