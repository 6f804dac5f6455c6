"""The four steps of the daily run: check, clean, analyse, monitor.

Each step reads stored tables and writes stored tables, so steps can be run apart, repeated and resumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import attribution, cleaning, device_mix, drift, marts, monitoring, multi_touch, quality, sessions
from ..session import discard, materialize
from ..sources import csv_drop, tables
from ..streaming.arrivals import Batch, Drop
from ..streaming.mart_days import MartDays
from ..streaming.session_days import SessionDays


@dataclass(frozen=True)
class Layout:
    """Where the outputs go, below one folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self) -> str:
        return self.path("raw_events.parquet")

    @property
    def files(self) -> str:
        return self.path("source_files.parquet")

    @property
    def cleaned(self) -> str:
        return self.path("cleaned_events.parquet")

    @property
    def attribution(self) -> str:
        return self.path("purchase_attribution.parquet")


def ingest(spark: SparkSession, pattern: str, out: Layout, lineage: str = "file") -> DataFrame:
    """The raw rows of all files and the columns of each source, as tables; headers are looked up and files parsed once."""
    catalog = materialize(csv_drop.header_catalog(spark, pattern, lineage), "headers")
    tables.write_table(csv_drop.file_schemas(catalog), out.files)
    tables.write_table(csv_drop.read_events(spark, pattern, lineage, catalog=catalog), out.raw)
    discard(catalog)
    return tables.read_table(spark, out.raw)


def check(spark: SparkSession, out: Layout) -> DataFrame:
    """Quality report as table and Markdown, the full lists behind it, and a sample of the rows with issues."""
    raw = cleaning.normalize(tables.read_table(spark, out.raw))
    files = tables.read_table(spark, out.files)
    counts = materialize(quality.profile(raw), "profile")
    tables.write_table(quality.report(raw, files, counts), out.path("dq_checks.parquet"))
    rows = tables.read_table(spark, out.path("dq_checks.parquet"))
    tables.write_lines(quality.report_lines(rows), out.path("dq_report.md"))
    tables.write_table(quality.unusual_files(counts, files.select("source_file")), out.path("dq_unusual_files.parquet"))
    tables.write_table(quality.invalid_event_names(counts), out.path("dq_invalid_event_names.parquet"))
    tables.write_table(quality.missing_columns(files), out.path("dq_missing_columns.parquet"))
    sample = quality.issue_sample(raw).drop("event_data_parsed")
    tables.write_csv(sample, out.path("detected_issues_sample.csv"))
    discard(counts)
    return rows


def clean(spark: SparkSession, out: Layout) -> DataFrame:
    """Cleaned events by day, the enriched projection and the attributed purchases."""
    tables.write_events(cleaning.clean_events(tables.read_table(spark, out.raw)), out.cleaned)
    events = tables.read_table(spark, out.cleaned)
    tables.write_events(cleaning.enriched(events), out.path("events_enriched.parquet"), rebalance=False)
    tables.write_table(attribution.purchase_attribution(events), out.attribution)
    return events


def analyse(spark: SparkSession, out: Layout) -> dict[str, DataFrame]:
    """The marts as CSV, from the stored attribution; only the revenue differs between steps."""
    events = tables.read_table(spark, out.cleaned)
    purchases = tables.read_table(spark, out.attribution).withColumn("revenue", attribution.revenue_of("price_first"))
    results = {
        "daily_revenue": marts.daily_revenue(purchases),
        "channel_revenue_last_click": marts.channel_revenue(purchases, "last"),
        "channel_revenue_first_click": marts.channel_revenue(purchases, "first"),
        "channel_revenue_linear": multi_touch.channel_credit(multi_touch.credits(events, None, "price_first")),
        "channel_revenue_time_decay": multi_touch.channel_credit(
            multi_touch.credits(events, multi_touch.HALF_LIFE_DAYS, "price_first")
        ),
        "conversion_rate_by_channel": marts.conversion_by_channel(events),
        "revenue_by_device": marts.revenue_by_device(events),
        "assisted_vs_direct": marts.assisted_vs_direct(purchases),
        "top_products": marts.top_products(purchases),
    }
    for name, mart in results.items():
        tables.write_csv(mart, out.path(f"{name}.csv"))
    return results


def monitor(spark: SparkSession, out: Layout, limits: monitoring.Limits = monitoring.Limits()) -> DataFrame:
    """The monitoring report as JSON; all monitors, freshness, rates, drift and the mix of devices by day as tables."""
    events = tables.read_table(spark, out.cleaned)
    purchases = tables.read_table(spark, out.attribution)
    tables.write_table(drift.extended_monitors(events, purchases, limits), out.path("monitors.parquet"))
    mix = device_mix.device_mix(purchases)
    tables.write_table(mix, out.path("device_mix.parquet"))
    tables.write_table(device_mix.mix_drift(mix), out.path("device_mix_drift.parquet"))
    rows = tables.read_table(spark, out.path("monitors.parquet")).where(F.col("monitor").isin(*monitoring.REPORT_ORDER))
    tables.write_json(monitoring.report(rows, monitoring.anchor_date(events)), out.path("monitoring_report.json"))
    return rows


def run_all(spark: SparkSession, pattern: str, root: str, lineage: str = "file", stop_on_failure: bool = False) -> None:
    out = Layout(root)
    ingest(spark, pattern, out, lineage)
    rows = check(spark, out)
    if stop_on_failure:
        quality.gate(rows)
    clean(spark, out)
    analyse(spark, out)
    monitor(spark, out)


def update_all(spark: SparkSession, pattern: str, root: str, lineage: str = "file") -> Batch:
    """The daily run by what has arrived: files new, replaced or gone since the last call, and only the days that they touch.

    Leaves the events, sessions and daily sums below ``root``, and the marts and the report as ``run_all`` does. It may be called
    again after a failure; without news it leaves everything as it is.
    """
    drop = Drop(spark, f"{root}/incremental", lineage)
    found = SessionDays(spark, f"{root}/incremental/sessions")
    days = MartDays(spark, f"{root}/incremental/marts", drop.events, found)
    log = f"{root}/incremental/published"
    batch = drop.arrive(pattern, log)
    if batch.days:
        found.update(drop.events, batch.days)
        days.update(batch.days)
        out = Layout(root)
        for name, mart in days.marts().items():
            tables.write_csv(mart, out.path(f"{name}.csv"))
        tables.write_json(days.report(), out.path("monitoring_report.json"))
        drop.taken_in(log)
    return batch


def write_sessions(spark: SparkSession, out: Layout) -> None:
    """Sessions, users and session events as tables."""
    events = tables.read_table(spark, out.cleaned)
    tables.write_table(sessions.sessions(events), out.path("sessions.parquet"))
    tables.write_table(sessions.users(events), out.path("users.parquet"))
    tables.write_table(sessions.user_agents(events), out.path("user_agents.parquet"))
    tables.write_table(sessions.session_sequence(events), out.path("session_sequence.parquet"))
