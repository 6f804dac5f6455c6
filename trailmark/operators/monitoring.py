"""Integrity and drift monitors: one row (monitor, metric, severity, message) each, severity NULL without an alert."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import exact_sum, percent_text, ratio
from ..functions.text import PURCHASE, digest_of

CRITICAL, WARN = "CRITICAL", "WARN"

# Alert texts, below, and columns whose equality makes two cleaned events duplicates for the monitor.
DUPLICATE_KEY = ("source_file", "timestamp_utc", "event_name", "event_data")


REPORT_ORDER = (
    "events",
    "purchases",
    "null_client_rate",
    "dup_rate",
    "json_error_rate",
    "revenue_drop",
    "direct_share",
)


@dataclass(frozen=True)
class Limits:
    baseline_days: int = 7
    null_client_rate: float = 0.20
    dup_rate: float = 0.001
    json_error_rate: float = 0.01
    direct_share: float = 0.80
    revenue_drop: float = 0.40


def _monitor(name: str, metric: Column, alert: Column, severity: str, message: Column) -> list[Column]:
    return [
        F.lit(name).alias("monitor"),
        metric.cast("double").alias("metric"),
        F.when(alert, severity).alias("severity"),
        F.when(alert, message).alias("message"),
    ]


def _rate_monitor(name: str, rate: Column, limit: float, text: str) -> list[Column]:
    return _monitor(name, rate, rate > limit, WARN, F.concat(F.lit(f"{text}: "), percent_text(rate)))


def totals(events: DataFrame) -> DataFrame:
    """One row with the latest day and the counts that the scalar monitors need, in one pass."""
    return events.agg(
        F.max(F.to_date("timestamp_utc")).alias("date"),
        F.count("*").alias("rows"),
        F.count_if(F.col("event_name") == PURCHASE).alias("purchases"),
        F.avg(F.col("client_id").isNull().cast("int")).alias("null_client_rate"),
        F.avg((F.col("event_data").isNotNull() & F.col("event_data_parsed").isNull()).cast("int")).alias(
            "json_error_rate"
        ),
    )


def anchor_date(events: DataFrame) -> DataFrame:
    """The day the monitors refer to: the latest one in the data."""
    return events.agg(F.max(F.to_date("timestamp_utc")).alias("date"))


def _scalar_monitors(limits: Limits) -> dict[str, list[Column]]:
    rows, purchases = F.col("rows"), F.col("purchases")
    return {
        "events": _monitor("events", rows, rows == 0, CRITICAL, F.lit("No events ingested today")),
        "purchases": _monitor("purchases", purchases, purchases == 0, CRITICAL, F.lit("No purchases recorded today")),
        "null_client_rate": _rate_monitor(
            "null_client_rate", F.col("null_client_rate"), limits.null_client_rate, "High null client_id rate"
        ),
        "json_error_rate": _rate_monitor(
            "json_error_rate", F.col("json_error_rate"), limits.json_error_rate, "JSON parse error rate high"
        ),
    }


def scalar_monitors(events: DataFrame, *names: str, limits: Limits = Limits()) -> DataFrame:
    """The named monitors out of one pass; by default all of events, purchases, null_client_rate, json_error_rate."""
    return scalar_monitors_of(totals(events), *names, limits=limits)


def scalar_monitors_of(row: DataFrame, *names: str, limits: Limits = Limits()) -> DataFrame:
    """The named monitors from the one row of ``totals``."""
    monitors_by_name = _scalar_monitors(limits)
    rows = [F.struct(*monitors_by_name[name]) for name in names or monitors_by_name]
    return row.select(F.inline(F.array(*rows)))


def duplicate_groups(events: DataFrame, *by: str) -> DataFrame:
    """``groups`` of equal keys, and how many of them have ``several`` events, in all or by some columns."""
    groups = events.groupBy(*by, *digest_of(*DUPLICATE_KEY)).agg(F.count("*").alias("n"))
    return groups.groupBy(*by).agg(F.count("*").alias("groups"), F.count_if(F.col("n") > 1).alias("several"))


def duplicates(events: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Share of key groups that have more than one event."""
    return duplicates_of(duplicate_groups(events), limits)


def duplicates_of(row: DataFrame, limits: Limits = Limits()) -> DataFrame:
    rate = ratio(F.col("several"), F.col("groups"))
    return row.select(*_rate_monitor("dup_rate", rate, limits.dup_rate, "Duplicate rate high"))


def daily_totals(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("event_name") == PURCHASE)
        .groupBy(F.to_date("timestamp_utc").alias("day"))
        .agg(exact_sum(F.col("total")).alias("revenue"))
    )


def revenue_drop(events: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Revenue of the latest day with purchases against the mean of the days with purchases before it."""
    return revenue_drop_of(daily_totals(events), limits)


def revenue_drop_of(daily: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The same from ``daily_totals``."""
    window = limits.baseline_days + 1
    newest_first = F.desc_nulls_last("day")
    # at most eight rows are left, so the window without partitions is small
    recent = daily.orderBy(newest_first).limit(window)
    placed = recent.withColumn("nth", F.row_number().over(Window.partitionBy().orderBy(newest_first)))
    latest, baseline, drop = F.col("latest"), F.col("baseline"), F.col("drop")
    text = F.format_string("Revenue drop detected: %.0f vs baseline %.0f", F.rint(latest), F.rint(baseline))
    return (
        placed.agg(
            F.count("*").alias("days"),
            F.max(F.when(F.col("nth") == 1, F.col("revenue"))).cast("double").alias("latest"),
            ratio(
                F.sum(F.when(F.col("nth") > 1, F.col("revenue"))), F.count(F.when(F.col("nth") > 1, F.col("revenue")))
            ).alias("baseline"),
        )
        .withColumn(
            "drop",
            F.when((F.col("days") == window) & (baseline > 0), ratio(baseline - latest, baseline)),
        )
        .select(*_monitor("revenue_drop", drop, drop > limits.revenue_drop, CRITICAL, text))
    )


def direct_share(purchases: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Share of revenue whose last touch is direct; NULL without any direct purchase or without revenue."""
    return direct_share_of(direct_revenue(purchases), limits)


def direct_revenue(purchases: DataFrame, *by: Column) -> DataFrame:
    """Revenue of purchases whose last touch is direct (``direct``, NULL without any) and of all, in all or by some columns."""
    is_direct = F.coalesce("last_utm_source", F.lit("direct")) == "direct"
    return purchases.groupBy(*by).agg(
        exact_sum(F.when(is_direct, F.col("revenue"))).alias("direct"), exact_sum(F.col("revenue")).alias("all")
    )


def direct_share_of(row: DataFrame, limits: Limits = Limits()) -> DataFrame:
    share = ratio(F.col("direct"), F.col("all"))
    return row.select(*_rate_monitor("direct_share", share, limits.direct_share, "Direct traffic unusually high"))


def monitors(events: DataFrame, purchases: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """All monitors in report order; ``purchases`` is ``purchase_attribution(events)``."""
    return monitors_of(totals(events), duplicate_groups(events), daily_totals(events), direct_revenue(purchases), limits)


def monitors_of(counted: DataFrame, copies: DataFrame, daily: DataFrame, direct: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """All monitors from ``totals``, ``duplicate_groups``, ``daily_totals`` and ``direct_revenue``."""
    rows = scalar_monitors_of(counted, limits=limits)
    for frame in (duplicates_of(copies, limits), revenue_drop_of(daily, limits), direct_share_of(direct, limits)):
        rows = rows.unionByName(frame)
    order = F.array(*[F.lit(name) for name in REPORT_ORDER])
    return rows.withColumn("position", F.array_position(order, F.col("monitor")))


def report(rows: DataFrame, date: DataFrame) -> DataFrame:
    """One row: date, alerts in order and status, FAIL if any alert is critical."""
    alert = F.struct("position", "severity", "message")
    alerts = F.array_sort(F.collect_list(F.when(F.col("severity").isNotNull(), alert)))
    failed = F.coalesce(F.max((F.col("severity") == CRITICAL).cast("int")), F.lit(0)) == 1
    return rows.agg(
        F.transform(alerts, lambda entry: entry.dropFields("position")).alias("alerts"),
        F.when(failed, "FAIL").otherwise("PASS").alias("status"),
    ).select(date.scalar().alias("date"), "alerts", "status")
