"""Business marts on cleaned events and attributed purchases.

``purchases`` is the result of ``purchase_attribution``. Every ordered limit ends in a key, so results are repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import exact_sum, ratio, round_half_away
from ..functions.text import PURCHASE
from ..functions.user_agent import browser, device_type, operating_system
from .attribution import revenue_of
from .sessions import SESSION_GAP_SECONDS, client_activity, sessions

DIRECT = "direct"


def _revenue() -> Column:
    return exact_sum(F.coalesce("revenue", F.lit(0.0))).cast("double").alias("revenue")


def _purchases() -> Column:
    return F.count("*").alias("purchases")


def events_with_device(events: DataFrame) -> DataFrame:
    agent = F.col("user_agent")
    return events.withColumns(
        {"device_type": device_type(agent), "os": operating_system(agent), "browser": browser(agent)}
    )


def daily_revenue(purchases: DataFrame) -> DataFrame:
    return (
        purchases.groupBy(F.to_date("timestamp_utc").alias("date"))
        .agg(_purchases(), _revenue())
        .withColumn("avg_order_value", ratio(F.col("revenue"), F.col("purchases")))
        .orderBy(F.asc_nulls_last("date"))
    )


def channel_revenue(purchases: DataFrame, touch: str = "last") -> DataFrame:
    """Revenue and purchases by the source of the ``first`` or ``last`` touch."""
    channel = F.coalesce(f"{touch}_utm_source", F.lit(DIRECT)).alias("channel")
    return purchases.groupBy(channel).agg(_revenue(), _purchases()).orderBy(F.desc("revenue"), "channel")


def top_channels(purchases: DataFrame, touch: str = "last", n: int = 10) -> DataFrame:
    return channel_revenue(purchases, touch).limit(n)


def top_products(purchases: DataFrame, n: int = 50) -> DataFrame:
    product = F.coalesce("product_id", F.lit("unknown")).alias("product_id")
    return purchases.groupBy(product).agg(_purchases(), _revenue()).orderBy(F.desc("revenue"), "product_id").limit(n)


def conversion_type(literal_direct: bool = True) -> Column:
    """Which way a purchase came; ``literal_direct`` takes a source named 'direct' for no source."""

    def direct(column: str) -> Column:
        missing = F.col(column).isNull()
        return missing | (F.col(column) == DIRECT) if literal_direct else missing

    pure = direct("first_utm_source")
    if literal_direct:
        pure = pure & direct("last_utm_source")
    return (
        F.when(pure, "Pure Direct")
        .when(F.col("first_utm_source") == F.col("last_utm_source"), "Single Channel")
        .otherwise("Assisted Conversion")
    )


def assisted_vs_direct(purchases: DataFrame, literal_direct: bool = True) -> DataFrame:
    """Purchases by conversion type."""
    return (
        purchases.groupBy(conversion_type(literal_direct).alias("conversion_type"))
        .agg(_purchases(), _revenue())
        .orderBy(F.desc("purchases"), "conversion_type")
    )


def conversion_type_share(purchases: DataFrame) -> DataFrame:
    """Share of each conversion type in percent; the window spans the three types."""
    total = F.sum("purchases").over(Window.partitionBy())
    return assisted_vs_direct(purchases).select(
        "conversion_type",
        "purchases",
        (100.0 * ratio(F.col("purchases"), total)).alias("share_percent"),
    )


def revenue_reconciliation(events: DataFrame, purchases: DataFrame) -> DataFrame:
    """Revenue of the purchases before and after attribution, side by side."""
    raw = events.where(F.col("event_name") == PURCHASE).agg(
        F.coalesce(exact_sum(revenue_of("total")).cast("double"), F.lit(0.0)).alias("raw_revenue")
    )
    attributed = purchases.agg(F.coalesce(exact_sum(F.col("revenue")).cast("double"), F.lit(0.0)))
    return raw.withColumn("attributed_revenue", attributed.scalar())


def conversion_by_channel(events: DataFrame, gap: int = SESSION_GAP_SECONDS, n: int = 200) -> DataFrame:
    """Purchases per session by the last source seen in the session.

    A session counts its own purchases while it is built, so purchases and sessions need no join. Purchases without
    a session (no client or no timestamp) count as direct; channels without sessions are left out.
    """
    outside = outside_sessions(events).agg(F.count("*").alias("purchases"))
    return conversion_of(sessions(events, gap), outside, n)


def outside_sessions(events: DataFrame) -> DataFrame:
    """Purchases that no session can hold."""
    return events.where(
        (F.col("event_name") == PURCHASE) & (F.col("client_id").isNull() | F.col("timestamp_utc").isNull())
    )


def conversion_of(found: DataFrame, outside: DataFrame, n: int = 200) -> DataFrame:
    """``conversion_by_channel`` from sessions and one row with the number of ``purchases`` outside of them."""
    channel = F.coalesce("session_last_utm", F.lit(DIRECT)).alias("channel")
    by_session = found.groupBy(channel).agg(
        F.coalesce(F.sum("purchases"), F.lit(0)).alias("purchases"), F.count("*").alias("sessions")
    )
    outside = outside.select(F.lit(DIRECT).alias("channel"), "purchases", F.lit(0).cast("bigint").alias("sessions"))
    rate = round_half_away(ratio(F.col("purchases"), F.col("sessions")), 6)
    return (
        by_session.unionByName(outside)
        .groupBy("channel")
        .agg(F.sum("purchases").alias("purchases"), F.sum("sessions").alias("sessions"))
        .where("sessions > 0")
        .withColumn("conversion_rate", rate)
        .orderBy(F.desc("conversion_rate"), "channel")
        .limit(n)
    )


def top_conversion_rates(events: DataFrame, n: int = 15) -> DataFrame:
    return conversion_by_channel(events).orderBy(F.desc("conversion_rate"), "channel").limit(n)


def conversion_rate_client_join(events: DataFrame, purchases: DataFrame) -> DataFrame:
    """Purchases by last channel, joined to all session rows of the client.

    The many-to-many join counts each purchase once per event of its client. Both sides are combined per client
    first, which gives the same numbers from a one-to-one join.
    """
    bought = (
        purchases.where("client_id IS NOT NULL")
        .groupBy("client_id", F.col("last_utm_source").alias("channel"))
        .agg(F.count("*").alias("n"))
    )
    return (
        bought.join(client_activity(events), "client_id")
        .groupBy("channel")
        .agg(F.sum(F.col("n") * F.col("n_events")).alias("purchases"), F.sum("n_sessions").alias("sessions"))
        .withColumn("conversion_rate", ratio(F.col("purchases"), F.col("sessions")))
        .orderBy(F.desc("conversion_rate"), "channel")
    )


def revenue_per_session_client_join(events: DataFrame) -> DataFrame:
    """Order totals by device, joined to all session rows of the client (many-to-many, see above)."""
    spent = (
        events.where("client_id IS NOT NULL")
        .groupBy("client_id", device_type(F.col("user_agent")).alias("device_type"))
        .agg(exact_sum(F.col("total")).alias("total"))
    )
    return (
        spent.join(client_activity(events), "client_id")
        .groupBy("device_type")
        .agg(F.sum("n_sessions").alias("sessions"), exact_sum(F.col("total") * F.col("n_events")).cast("double").alias("revenue"))
        .withColumn("revenue_per_session", ratio(F.col("revenue"), F.col("sessions")))
        .orderBy(F.desc_nulls_last("revenue_per_session"), "device_type")
    )


def device_days(events: DataFrame, revenue_policy: str = "price_first", dedup_join: bool = False) -> DataFrame:
    """Revenue by device of the purchase, client and day.

    By default a purchase counts once per event of its client at the same instant, as a join of purchases back to
    events on (client, time) does; ``dedup_join`` counts it once, without looking at other events. Purchases are combined
    first, and only the client and time of events are compared with their instants.
    """
    bought = (
        events.where(F.col("event_name") == PURCHASE)
        .groupBy("client_id", "timestamp_utc", device_type(F.col("user_agent")).alias("device_type"))
        .agg(exact_sum(revenue_of(revenue_policy)).alias("revenue"))
    )
    if not dedup_join:
        instant = ["client_id", "timestamp_utc"]
        instants = bought.where("client_id IS NOT NULL AND timestamp_utc IS NOT NULL").select(*instant).distinct()
        here = events.select(*instant).join(instants, instant, "left_semi").groupBy(*instant).agg(F.count("*").alias("events_here"))
        bought = bought.join(here, instant, "left").withColumn("revenue", F.col("revenue") * F.coalesce("events_here", F.lit(1)))
    return bought.groupBy("device_type", "client_id", F.to_date("timestamp_utc").alias("dt")).agg(exact_sum(F.col("revenue")).alias("revenue"))


def revenue_by_device(events: DataFrame, revenue_policy: str = "price_first", dedup_join: bool = False) -> DataFrame:
    """Revenue by device, per distinct client and day; ``dedup_join`` as for ``device_days``."""
    days = device_days(events, revenue_policy, dedup_join)
    return per_device(days.groupBy("device_type").agg(F.count("client_id").alias("sessions"), exact_sum(F.col("revenue")).alias("revenue")))


def per_device(sums: DataFrame) -> DataFrame:
    return (
        sums.withColumn("revenue", F.col("revenue").cast("double"))
        .withColumn("revenue_per_session", round_half_away(ratio(F.col("revenue"), F.col("sessions")), 2))
        .orderBy(F.desc("revenue"), "device_type")
    )


def session_sample(events: DataFrame, n: int = 10) -> DataFrame:
    return (
        sessions(events)
        .select("session_id", "session_start", "session_end", "session_duration_seconds")
        .orderBy("session_id")
        .limit(n)
    )
