"""First and last campaign touch before each purchase.

A touch is an event with a campaign source; a purchase looks back seven days, both ends included, its own event too.

The look-up is an as-of search in two steps, so that no task has to hold one client's whole history. Touches and
purchases are first combined per client and microsecond. Within a time slice of a client a running window finds the
touch; across slices the same is done on one row per slice. With slices of a minute a client brings at most 1,440 rows
a day into the second step, and a slice has at most one row per microsecond, whatever the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import PURCHASE
from ..functions.times import MICROS, micros

LOOKBACK_DAYS = 7
SLICE_SECONDS = 60

_UTM = ("utm_source", "utm_medium", "utm_campaign")
_PLACED = "client_id IS NOT NULL AND timestamp_utc IS NOT NULL"


def revenue_of(policy: str = "total") -> Column:
    """``total``: order total or 0. ``price_first``: price, else order total, else 0."""
    columns = {"total": ("total",), "price_first": ("price", "total")}[policy]
    return F.coalesce(*columns, F.lit(0.0))


def _moments(events: DataFrame) -> DataFrame:
    """One row per client and microsecond that has a touch or a purchase."""
    us = micros(F.col("timestamp_utc"))
    is_touch = F.col("utm_source").isNotNull()
    is_purchase = F.col("event_name") == PURCHASE
    touch = F.when(is_touch, F.struct(us.alias("us"), "row_seq", *_UTM))
    return (
        events.where(_PLACED)
        .where(is_touch | is_purchase)
        .groupBy("client_id", us.alias("us"))
        .agg(
            F.min(touch).alias("first_here"),
            F.max(touch).alias("last_here"),
            F.coalesce(F.max(is_purchase), F.lit(False)).alias("bought"),
        )
    )


def _last_known(column: str, window) -> Column:
    return F.last(column, ignorenulls=True).over(window)


def touches_by_purchase(events: DataFrame, days: int = LOOKBACK_DAYS, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """(client_id, us, first_touch, last_touch) for each moment at which a client bought something.

    A purchase is looked up twice: backwards from its own time for the last touch, and forwards from the start of
    its look-back for the first one. The second look-up is an extra row, the probe, at that start.
    """
    reach = days * 86_400 * MICROS
    width = slice_seconds * MICROS
    nothing = F.lit(None)
    rows = (
        _moments(events)
        .withColumn(
            "role",
            F.explode(
                F.when(F.col("bought"), F.array(F.lit("moment"), F.lit("probe"))).otherwise(F.array(F.lit("moment")))
            ),
        )
        .withColumns(
            {
                "us": F.when(F.col("role") == "probe", F.col("us") - reach).otherwise(F.col("us")),
                "first_here": F.when(F.col("role") == "probe", nothing).otherwise(F.col("first_here")),
                "last_here": F.when(F.col("role") == "probe", nothing).otherwise(F.col("last_here")),
            }
        )
        .withColumn("slice", F.col("us") - F.pmod("us", F.lit(width)))
    )

    in_slice = Window.partitionBy("client_id", "slice").rowsBetween(Window.unboundedPreceding, 0)
    # a probe comes after a touch of the same microsecond: both directions include equal times
    searched = rows.withColumns(
        {
            "back": _last_known("last_here", in_slice.orderBy("us", "role")),
            "ahead": _last_known("first_here", in_slice.orderBy(F.desc("us"), "role")),
        }
    )

    before = Window.partitionBy("client_id").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        rows.groupBy("client_id", "slice")
        .agg(F.min("first_here").alias("slice_first"), F.max("last_here").alias("slice_last"))
        .select(
            "client_id",
            "slice",
            _last_known("slice_last", before.orderBy("slice")).alias("slice_back"),
            _last_known("slice_first", before.orderBy(F.desc("slice"))).alias("slice_ahead"),
        )
    )

    is_probe = F.col("role") == "probe"
    back = F.coalesce("back", "slice_back")
    ahead = F.coalesce("ahead", "slice_ahead")
    found = (
        searched.where("bought")
        .join(slices, ["client_id", "slice"])
        .select(
            "client_id",
            F.when(is_probe, F.col("us") + reach).otherwise(F.col("us")).alias("us"),
            F.when(~is_probe, back).alias("last_touch"),
            F.when(is_probe, ahead).alias("first_touch"),
        )
        .groupBy("client_id", "us")
        .agg(F.max("first_touch").alias("first_touch"), F.max("last_touch").alias("last_touch"))
    )
    return found.select(
        "client_id",
        "us",
        F.when(F.col("first_touch.us") <= F.col("us"), F.col("first_touch")).alias("first_touch"),
        F.when(F.col("last_touch.us") >= F.col("us") - reach, F.col("last_touch")).alias("last_touch"),
    )


def purchase_attribution(
    events: DataFrame,
    revenue_policy: str = "total",
    days: int = LOOKBACK_DAYS,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Every purchase with its revenue and first and last touch; NULL touches without a client or a time.

    ``events`` is read twice, so it should be a stored table. Purchases that cannot match are kept apart from the
    join, which would otherwise send all of them to one task.
    """
    purchases = events.where(F.col("event_name") == PURCHASE).withColumn("revenue", revenue_of(revenue_policy))
    touches = touches_by_purchase(events, days, slice_seconds)
    us = micros(F.col("timestamp_utc"))
    matched = purchases.where(_PLACED).withColumn("us", us).join(touches, ["client_id", "us"], "left").drop("us")
    alone = purchases.where(f"NOT ({_PLACED})")
    named = {
        f"{which}_{name}": F.col(f"{which}_touch.{name}") for which in ("first", "last") for name in _UTM
    }
    return (
        matched.unionByName(alone, allowMissingColumns=True).withColumns(named).drop("first_touch", "last_touch")
    )
