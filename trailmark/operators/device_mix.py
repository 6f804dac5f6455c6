"""The mix of devices by day, and how far a day's mix is from that of the week before.

The distance is the Jensen-Shannon divergence in bits: 0 for equal shares, 1 for mixes without a common device. It is defined where
a device is missing on either side, and unlike a share of one device it sees any change of the mix.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import exact_sum, ratio, round_half_away
from ..functions.user_agent import DEVICES, device_type
from .drift import INFO
from .monitoring import WARN

LIMIT = 0.05


def device_mix(purchases: DataFrame) -> DataFrame:
    """Purchases, revenue and share of the day's revenue, by day and device; undated purchases are left out."""
    sums = (
        purchases.where("timestamp_utc IS NOT NULL")
        .groupBy(F.to_date("timestamp_utc").alias("day"), device_type(F.col("user_agent")).alias("device_type"))
        .agg(F.count("*").alias("purchases"), exact_sum(F.col("revenue")).alias("revenue"))
    )
    # at most one row for each device and day
    of_day = F.sum("revenue").over(Window.partitionBy("day"))
    return sums.withColumn("share", ratio(F.col("revenue"), of_day)).withColumn("revenue", F.col("revenue").cast("double"))


def _divergence(mine: dict[str, Column], other: dict[str, Column]) -> Column:
    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2.0 * p / (p + q))).otherwise(0.0)

    both = [part(mine[d], other[d]) + part(other[d], mine[d]) for d in mine]
    return reduce(Column.__add__, both) / 2.0


def mix_drift(mix: DataFrame, days: int = 7, limit: float = LIMIT, min_purchases: int = 10) -> DataFrame:
    """Each day's mix of revenue against the pooled mix of the ``days`` days with purchases before it.

    Severity is WARN beyond the limit, INFO for a day that is not judged because it or a day before has too few purchases. Days
    without all the days before, or without revenue on either side, have no row.
    """
    # one row per day, a column for each device
    revenue = {d: F.coalesce(F.sum(F.when(F.col("device_type") == d, F.col("revenue").cast("decimal(38,4)"))), F.lit(0)).alias(d) for d in DEVICES}
    daily = mix.groupBy("day").agg(F.sum("purchases").alias("purchases"), *revenue.values())
    window = Window.partitionBy().orderBy("day").rowsBetween(-days, -1)
    pooled = {f"{d}_before": F.sum(d).over(window) for d in DEVICES}
    placed = daily.withColumns(
        {**pooled, "_days": F.count("*").over(window), "_least": F.least(F.min("purchases").over(window), F.col("purchases"))}
    ).where(F.col("_days") == days)

    def shares(suffix: str) -> dict[str, Column]:
        total = reduce(Column.__add__, [F.col(d + suffix) for d in DEVICES])
        return {d: ratio(F.col(d + suffix), total) for d in DEVICES}

    found = placed.withColumn("divergence", _divergence(shares(""), shares("_before"))).where("divergence IS NOT NULL")
    severity = F.when(F.col("_least") < min_purchases, INFO).when(F.col("divergence") > limit, WARN)
    return found.select("day", "purchases", round_half_away(F.col("divergence"), 6).alias("divergence"), severity.alias("severity"))
