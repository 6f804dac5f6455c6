"""Linear and time-decay attribution: every touch of the look-back gets a part of the purchase.

No touch is paired with a purchase. Time is cut into blocks as long as the look-back, so a purchase's look-back is the begin of
its own block, up to the purchase, and the end of the block before, from where the look-back starts. Both are running sums over
the touches of one client and channel: forwards for the first, backwards for the second. Sums only ever add, and weights are
scaled to the begin of their block, so they lose no digits and cannot overflow however long the history is.

Running sums are taken in two steps, as in ``attribution``: within slices of a minute, and over one row per slice. Touches are
combined per microsecond before. A block has at most 10,080 slices of a minute, whatever the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import exact_sum, ratio, round_half_away
from ..functions.text import PURCHASE
from ..functions.times import MICROS, micros
from .attribution import LOOKBACK_DAYS, SLICE_SECONDS, revenue_of
from .marts import DIRECT

HALF_LIFE_DAYS = 7.0
_PLACED = "client_id IS NOT NULL AND timestamp_utc IS NOT NULL"
_SLICE = ("client_id", "channel", "block", "slice")


def _placed_in(us: Column, reach: int, width: int) -> dict[str, Column]:
    """The block of a time, how far into it the time is, and its slice there."""
    into = F.pmod(us, F.lit(reach))
    return {"block": F.floor(us / reach), "into": into, "slice": F.floor(into / width)}


def _touches(events: DataFrame) -> DataFrame:
    found = events.where(_PLACED).where("utm_source IS NOT NULL")
    return found.groupBy("client_id", F.col("utm_source").alias("channel"), micros(F.col("timestamp_utc")).alias("us")).agg(F.count("*").alias("n"))


def _look_ups(touches: DataFrame, moments: DataFrame, reach: int) -> DataFrame:
    """Each purchase moment with the channels that its client met in the block of the moment or the one before."""
    block = F.floor(F.col("us") / reach)
    met = touches.select("client_id", "channel", F.explode(F.array(block, block + 1)).alias("block")).distinct()
    return moments.withColumn("block", block).join(met, ["client_id", "block"]).select("client_id", "channel", "us")


def channel_weights(
    events: DataFrame,
    half_life_days: float | None = None,
    days: int = LOOKBACK_DAYS,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """(client_id, us, channel, touches, weight) for each moment at which a client bought something.

    Every touch weighs 1, or 2 to the power of -age / half-life. Channels without a touch in the look-back have no row.
    """
    reach, width = days * 86_400 * MICROS, slice_seconds * MICROS
    half = None if half_life_days is None else half_life_days * 86_400 * MICROS
    if half is not None and reach / half > 1000:
        raise ValueError("the half-life must be a thousandth of the look-back or more")
    grown = (lambda us: F.lit(1.0)) if half is None else (lambda us: F.pow(F.lit(2.0), us / F.lit(half)))

    touches = _touches(events)
    moments = events.where(_PLACED).where(F.col("event_name") == PURCHASE).select("client_id", micros(F.col("timestamp_utc")).alias("us")).distinct()
    probes = _look_ups(touches, moments, reach).select(
        "client_id", "channel", F.inline(F.array(F.struct("us", F.lit("1").alias("role")), F.struct((F.col("us") - reach).alias("us"), F.lit("2").alias("role"))))
    )
    # touches sort before look-ups of the same time in both directions, so both ends of the look-back are included
    rows = (
        touches.withColumn("role", F.lit("0"))
        .unionByName(probes, allowMissingColumns=True)
        .withColumns(_placed_in(F.col("us"), reach, width))
        .withColumn("w", F.col("n") * grown(F.col("into")))
    )
    in_slice = Window.partitionBy(*_SLICE).rowsBetween(Window.unboundedPreceding, 0)
    forwards, backwards = in_slice.orderBy("us", "role"), in_slice.orderBy(F.desc("us"), "role")
    is_moment = F.col("role") == "1"
    running = {name: F.when(is_moment, F.sum(name).over(forwards)).otherwise(F.sum(name).over(backwards)) for name in ("n", "w")}
    here = rows.withColumns({f"{name}_here": column for name, column in running.items()}).where("role <> '0'")

    of_block = Window.partitionBy(*_SLICE[:3])
    before = of_block.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    after = of_block.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    others = {f"{name}_{side}": F.sum(name).over(window) for name in ("n", "w") for side, window in (("before", before), ("after", after))}
    slices = rows.groupBy(*_SLICE).agg(F.sum("n").alias("n"), F.sum("w").alias("w")).withColumns(others).drop("n", "w")

    def total(name: str) -> Column:
        beside = F.when(is_moment, F.col(f"{name}_before")).otherwise(F.col(f"{name}_after"))
        return F.coalesce(f"{name}_here", F.lit(0)) + F.coalesce(beside, F.lit(0))

    # from the begin of the row's block to the purchase
    age = F.col("into") + F.when(is_moment, 0).otherwise(reach)
    return (
        here.join(slices, list(_SLICE))
        .select("client_id", "channel", F.when(is_moment, F.col("us")).otherwise(F.col("us") + reach).alias("us"), total("n").alias("n"), (total("w") / grown(age)).alias("w"))
        .groupBy("client_id", "us", "channel")
        .agg(F.sum("n").alias("touches"), F.sum("w").alias("weight"))
        .where("touches > 0")
    )


def credits(
    events: DataFrame,
    half_life_days: float | None = None,
    revenue_policy: str = "total",
    days: int = LOOKBACK_DAYS,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Every purchase once for each channel of its look-back: touches, share of the weight, and revenue by share.

    Purchases without a touch, without a client or without a time go to ``direct`` as a whole. ``events`` is read several times,
    so it should be a stored table.
    """
    return _credited(events, channel_weights(events, half_life_days, days, slice_seconds), {"": "weight"}, revenue_policy)


def credits_of_both(
    events: DataFrame,
    half_life_days: float = HALF_LIFE_DAYS,
    revenue_policy: str = "total",
    days: int = LOOKBACK_DAYS,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """The rows of ``credits`` by time decay, and beside them ``linear_share`` and ``linear_revenue``.

    The linear weight of a channel is the number of its touches, which time decay counts too: one pass gives both models.
    """
    weights = channel_weights(events, half_life_days, days, slice_seconds).withColumn("linear_weight", F.col("touches").cast("double"))
    return _credited(events, weights, {"": "weight", "linear_": "linear_weight"}, revenue_policy)


def _credited(events: DataFrame, weights: DataFrame, models: dict[str, str], revenue_policy: str) -> DataFrame:
    """Purchases by channel with the share and revenue of each model, by its prefix and the column of its weights."""
    per_moment = Window.partitionBy("client_id", "us")
    shares = weights.withColumns({f"{prefix}share": ratio(F.col(weight), F.sum(weight).over(per_moment)) for prefix, weight in models.items()})
    shares = shares.drop(*models.values())
    purchases = events.where(F.col("event_name") == PURCHASE).withColumn("revenue", revenue_of(revenue_policy))
    placed = purchases.where(_PLACED).withColumn("us", micros(F.col("timestamp_utc"))).join(shares, ["client_id", "us"], "left").drop("us")
    every = placed.unionByName(purchases.where(f"NOT ({_PLACED})"), allowMissingColumns=True)
    share = {prefix: F.coalesce(f"{prefix}share", F.lit(1.0)) for prefix in models}
    return every.withColumns(
        {
            "channel": F.coalesce("channel", F.lit(DIRECT)),
            "touches": F.coalesce("touches", F.lit(0).cast("bigint")),
            **{f"{prefix}share": column for prefix, column in share.items()},
            **{f"{prefix}revenue": F.col("revenue") * column for prefix, column in share.items()},
        }
    )


def channel_credit(credited: DataFrame) -> DataFrame:
    """Revenue and purchases by channel; a purchase counts by its shares. Shares are summed to six places."""
    return (
        credited.groupBy("channel")
        .agg(
            exact_sum(round_half_away(F.col("revenue"), 4)).cast("double").alias("revenue"),
            F.sum(round_half_away(F.col("share"), 6).cast("decimal(38,6)")).cast("double").alias("purchases"),
            F.sum("touches").alias("touches"),
        )
        .orderBy(F.desc("revenue"), "channel")
    )
