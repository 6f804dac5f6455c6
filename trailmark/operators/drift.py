"""Daily metrics, their drift against the days before, and engagement figures.

The heavy part is one aggregation by day of each input; windows run over the resulting rows, one per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import exact_sum, ratio, round_half_away
from ..functions.text import KNOWN_EVENTS, PURCHASE
from ..functions.user_agent import browser, device_type, operating_system
from .monitoring import WARN, Limits, monitors
from .sessions import SESSION_GAP_SECONDS, sessions

INFO = "INFO"


def daily_metrics(events: DataFrame, purchases: DataFrame, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    """One row per day with events: volume, purchases, sessions begun, revenue, and shares of revenue and purchases."""
    day = F.to_date("timestamp_utc").alias("day")
    first, last = F.col("first_utm_source"), F.col("last_utm_source")
    volume = (
        events.where("timestamp_utc IS NOT NULL")
        .groupBy(day)
        .agg(F.count("*").alias("events"), F.count_if(F.col("event_name") == PURCHASE).alias("purchases"))
    )
    begun = (
        sessions(events, gap)
        .where("session_start IS NOT NULL")
        .groupBy(F.to_date("session_start").alias("day"))
        .agg(F.count("*").alias("sessions"))
    )
    is_mobile = device_type(F.col("user_agent")) == "mobile"
    sold = purchases.groupBy(day).agg(
        exact_sum(F.col("revenue")).cast("double").alias("revenue"),
        exact_sum(F.when(is_mobile, F.col("revenue"))).cast("double").alias("mobile_revenue"),
        F.count_if(first.isNotNull() & (first != last)).alias("assisted"),
    )
    return volume.join(begun, "day", "left").join(sold, "day", "left").select(
        "day",
        "events",
        "purchases",
        F.coalesce("sessions", F.lit(0)).alias("sessions"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
        ratio(F.col("purchases"), F.col("sessions")).alias("conversion_rate"),
        ratio(F.col("mobile_revenue"), F.col("revenue")).alias("mobile_revenue_share"),
        ratio(F.col("assisted"), F.col("purchases")).alias("assisted_share"),
    )


def _days_before(days: int):
    return Window.partitionBy().orderBy("day").rowsBetween(-days, -1)


def relative_drop(
    daily: DataFrame,
    metric: str,
    limit: float = 0.30,
    severity: str = WARN,
    days: int = 7,
    volume: str = "sessions",
    min_volume: int = 0,
) -> DataFrame:
    """Each day's metric against the mean of the days before it.

    Severity is ``severity`` beyond the limit, INFO for a day that the volume guard leaves unchecked, else NULL. A day is
    checked when all ``days`` before it exist and they and the day itself have enough volume.
    """
    window = _days_before(days)
    drop = ratio(F.col("baseline") - F.col(metric), F.col("baseline"))
    return (
        daily.select("day", metric, volume)
        .withColumns(
            {
                "baseline": F.avg(metric).over(window),
                "_days": F.count("*").over(window),
                "_least": F.least(F.min(volume).over(window), F.col(volume)),
            }
        )
        .where(F.col("_days") == days)
        .select(
            "day",
            round_half_away(F.col(metric).cast("double"), 6).alias("value"),
            round_half_away(F.col("baseline"), 6).alias("baseline"),
            F.when(F.col("_least") < min_volume, INFO)
            .when((F.col("baseline") > 0) & (drop > limit), severity)
            .alias("severity"),
        )
    )


def unusual_volume(daily: DataFrame, sigmas: float = 3.0, days: int = 7) -> DataFrame:
    """Days whose event count is more than some standard deviations away from the days before."""
    window = _days_before(days)
    far = F.abs(F.col("events") - F.col("mean")) > sigmas * F.col("deviation")
    return (
        daily.select("day", "events")
        .withColumns(
            {
                "mean": F.avg("events").over(window),
                "deviation": F.stddev_samp("events").over(window),
                "_days": F.count("*").over(window),
            }
        )
        .where(F.col("_days") == days)
        .select(
            "day",
            "events",
            round_half_away(F.col("mean"), 6).alias("mean"),
            round_half_away(F.col("deviation"), 6).alias("deviation"),
            F.when(far, WARN).alias("severity"),
        )
    )


def integrity_rates(events: DataFrame, known: tuple[str, ...] = KNOWN_EVENTS) -> DataFrame:
    """Shares of cleaned events with an unknown name, without a referrer and without a campaign source."""

    def share(condition: Column) -> Column:
        return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))

    return events.agg(
        share(~F.col("event_name").isin(*known)).alias("invalid_name_rate"),
        share(F.col("referrer").isNull()).alias("missing_referrer_rate"),
        share(F.col("utm_source").isNull()).alias("missing_utm_rate"),
    )


def engagement(events: DataFrame, gap: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Sessions per user, mean duration and the share of sessions that lasted no time."""
    length = F.col("session_duration_seconds")
    per_user = (
        sessions(events, gap)
        .groupBy("client_id")
        .agg(
            F.count("*").alias("n"),
            F.sum(length).alias("seconds"),
            F.count(length).alias("timed"),
            F.count_if(length == 0).alias("bounced"),
        )
    )
    return per_user.agg(
        F.count("*").alias("users"),
        F.sum("n").alias("sessions"),
        ratio(F.sum("n"), F.count("*")).alias("sessions_per_user"),
        ratio(F.sum("seconds"), F.sum("timed")).alias("mean_duration_seconds"),
        ratio(F.sum("bounced"), F.sum("n")).alias("bounce_share"),
    )


def platforms(events: DataFrame) -> DataFrame:
    """Events by device, operating system and browser."""
    agent = F.col("user_agent")
    return events.groupBy(
        device_type(agent).alias("device_type"), operating_system(agent).alias("os"), browser(agent).alias("browser")
    ).agg(F.count("*").alias("events"))



#: shares that must not fall below their mean of the week before by more than a limit, and how an alert names them
DRIFTING = {
    "conversion_rate": "Conversion rate",
    "mobile_revenue_share": "Mobile share of revenue",
    "assisted_share": "Assisted share of purchases",
}
#: rates that alert beyond a limit
RATE_LIMITS = {"invalid_name_rate": 0.01, "missing_referrer_rate": 0.50, "missing_utm_rate": 0.90}


def _row(name: str, metric: Column, severity: Column, message: Column) -> Column:
    return F.struct(
        F.lit(name).alias("monitor"),
        round_half_away(metric.cast("double"), 6).alias("metric"),
        severity.alias("severity"),
        F.when(severity == WARN, message).alias("message"),
    )


def drift_monitors(daily: DataFrame, limit: float = 0.30, sigmas: float = 3.0, days: int = 7, min_volume: int = 10) -> DataFrame:
    """Monitors of the latest day against the days before it, out of one pass over the days.

    Severity is NULL without enough days, INFO if a day has too few sessions to judge shares.
    """
    window = _days_before(days)
    figures = {f"{name}_before": F.avg(name).over(window) for name in DRIFTING}
    placed = daily.withColumns(
        {
            **figures,
            "_days": F.count("*").over(window),
            "_least": F.least(F.min("sessions").over(window), F.col("sessions")),
            "_mean": F.avg("events").over(window),
            "_deviation": F.stddev_samp("events").over(window),
        }
    )
    latest = placed.orderBy(F.desc("day")).limit(1)
    full = F.col("_days") == days
    rows = []
    for name, title in DRIFTING.items():
        value, before = F.col(name), F.col(f"{name}_before")
        drop = ratio(before - value, before)
        severity = F.when(full & (F.col("_least") < min_volume), INFO).when(full & (before > 0) & (drop > limit), WARN)
        rows.append(_row(f"{name}_drop", F.when(full, drop), severity, F.format_string(f"{title} down: %.3f vs baseline %.3f", value, before)))
    away = F.abs(F.col("events") - F.col("_mean"))
    unusual = F.when(full & (away > sigmas * F.col("_deviation")), WARN)
    rows.append(_row("event_volume", F.when(full, F.col("events")), unusual, F.format_string("Unusual event volume: %d vs mean %.0f", F.col("events"), F.rint("_mean"))))
    return latest.select(F.inline(F.array(*rows)))


def rate_monitors(events: DataFrame) -> DataFrame:
    """Shares of events with unknown names, without referrer and without campaign, against their limits."""
    rows = []
    for name, limit in RATE_LIMITS.items():
        rate = F.col(name)
        text = F.concat(F.lit(name.replace("_", " ").capitalize() + " high: "), F.format_string("%.3f", rate))
        rows.append(_row(name, rate, F.when(rate > limit, WARN), text))
    return integrity_rates(events).select(F.inline(F.array(*rows)))


def freshness(events: DataFrame) -> DataFrame:
    """Days by which the newest event lags behind the newest file, whose name carries its day."""
    file_day = F.try_to_date(F.regexp_extract("source_file", r"(\d{8})", 1), "yyyyMMdd")
    lag = F.date_diff(F.max(file_day), F.max(F.to_date("timestamp_utc")))
    text = F.format_string("Events lag files by %d days", F.col("lag"))
    return events.agg(lag.alias("lag")).select(F.inline(F.array(_row("freshness", F.col("lag"), F.when(F.col("lag") > 0, WARN), text))))


def extended_monitors(events: DataFrame, purchases: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The monitors of the daily report, then freshness, integrity rates and drift; ``position`` gives the order."""
    rows = monitors(events, purchases, limits)
    more = freshness(events).unionByName(rate_monitors(events)).unionByName(drift_monitors(daily_metrics(events, purchases)))
    order = F.array(*[F.lit(name) for name in ("freshness", *RATE_LIMITS, *[f"{name}_drop" for name in DRIFTING], "event_volume")])
    return rows.unionByName(more.withColumn("position", F.array_position(order, F.col("monitor")) + 100))
