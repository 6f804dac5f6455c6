"""Named queries over a folder of test tables.

Row-level and quality queries start from the raw events; the later ones read the cleaned events, which are stored once
per application in the shared folder, as the daily run stores them. Timestamps leave as epoch microseconds and arrays as
joined text, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import payload, urls
from ..functions.numbers import round_half_away
from ..functions.text import repaired_event_name
from ..functions.times import micros, parse_utc
from ..operators import attribution, audience, cleaning, device_mix, drift, marts, monitoring, multi_touch, quality, sessions
from ..session import configure, materialize, staged
from ..sources import csv_drop, tables
from ..sources.versioned import VersionedTable, day_of
from ..sources.web_events import web_events, write_daily_files
from ..streaming.arrivals import Drop
from ..streaming.mart_days import MartDays
from ..streaming.session_days import SessionDays

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_read: dict[str, DataFrame] = {}


def query(function: Query) -> Query:
    """Register a function under its name; the session settings are applied first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- inputs -------------------------------------------------------------------------------------------------------


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.normalize(web_events(spark, sf_dir))


def cleaned_path(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        tables.write_events(cleaning.clean_events(web_events(spark, sf_dir)).drop("copy_no"), path)

    return staged(configure(spark), f"cleaned:{sf_dir}", build)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = cleaned_path(spark, sf_dir)
    if path not in _read:
        _read[path] = tables.read_table(spark, path)
    return _read[path]


def daily_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of daily CSV exports of the raw events, with the drift days lacking a column."""
    return staged(spark, f"daily:{sf_dir}", lambda path: write_daily_files(web_events(spark, sf_dir), path))


def attributed(spark: SparkSession, sf_dir: str, policy: str = "price_first") -> DataFrame:
    return attribution.purchase_attribution(cleaned(spark, sf_dir), policy)


def file_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_drop.file_schemas(csv_drop.header_catalog(spark, daily_files(spark, sf_dir), "folder"))


def _us(column: str, name: str) -> Column:
    return micros(F.col(column)).alias(name)


# -- row-level operators ------------------------------------------------------------------------------------------


@query
def event_name_remap(spark, sf_dir):
    name = F.col("event_name")
    return raw_events(spark, sf_dir).select(
        "row_seq", "copy_no", name.alias("raw_name"), repaired_event_name(name).alias("event_name")
    )


def _urls(spark: SparkSession, sf_dir: str, event_column: str) -> DataFrame:
    """URLs of the events and of the crawled pages."""
    own = raw_events(spark, sf_dir).select(
        F.lit("event").alias("origin"), F.col("row_seq").alias("id"), "copy_no", F.col(event_column).alias("url")
    )
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.lit("page").alias("origin"), F.col("page_id").alias("id"), F.lit(0).alias("copy_no"), "url"
    )
    return own.unionByName(pages)


@query
def referrer_domain(spark, sf_dir):
    url = F.col("url")
    return _urls(spark, sf_dir, "referrer").select(
        "origin", "id", "copy_no", urls.domain(url).alias("referrer_domain"), urls.authority(url).alias("authority")
    )


@query
def utm_extract(spark, sf_dir):
    return urls.with_utm(_urls(spark, sf_dir, "page_url"), "url").select("origin", "id", "copy_no", *urls.UTM_KEYS)


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload.with_payload(raw_events(spark, sf_dir).select("row_seq", "copy_no", "event_data"))


@query
def payload_parse_flags(spark, sf_dir):
    parsed = F.col("event_data_parsed")
    present = F.col("event_data").isNotNull()
    return _payloads(spark, sf_dir).select(
        "row_seq",
        "copy_no",
        present.alias("present"),
        parsed.isNotNull().alias("payload_ok"),
        (present & parsed.isNull()).alias("json_error"),
    )


@query
def payload_price(spark, sf_dir):
    return _payloads(spark, sf_dir).select(
        "row_seq", "copy_no", payload.price_of(payload.fields_of(F.col("event_data_parsed"))).alias("price")
    )


@query
def payload_items(spark, sf_dir):
    items = F.col("items")
    return (
        _payloads(spark, sf_dir)
        .withColumn("items", payload.fields_of(F.col("event_data_parsed"))["items"])
        .select(
            "row_seq",
            "copy_no",
            payload.items_total(items, "quantity").alias("items_quantity"),
            payload.items_total(items, "price").alias("items_price"),
            payload.text_of(payload.items_first(items, "product_id")).alias("items_product_id"),
            payload.text_of(payload.items_first(items, "sku")).alias("items_sku"),
        )
    )


@query
def payload_fields(spark, sf_dir):
    return payload.with_payload_fields(_payloads(spark, sf_dir)).select(
        "row_seq", "copy_no", "quantity", "product_id", "unit_price"
    )


@query
def order_total(spark, sf_dir):
    return payload.with_payload_fields(_payloads(spark, sf_dir)).select("row_seq", "copy_no", "total")


@query
def timestamp_validity(spark, sf_dir):
    parsed = raw_events(spark, sf_dir).withColumn("parsed", parse_utc(F.col("timestamp")))
    return parsed.select("row_seq", "copy_no", _us("parsed", "ts_us"), F.col("parsed").isNotNull().alias("is_valid"))


def _device_column(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return marts.events_with_device(raw_events(spark, sf_dir)).select("row_seq", "copy_no", name)

    return run


for _key, _column in (("ua_device_type", "device_type"), ("ua_os", "os"), ("ua_browser", "browser")):
    _run = _device_column(_column)
    _run.__name__ = _key
    query(_run)


# -- cleaning -----------------------------------------------------------------------------------------------------


@query
def referrer_missing_flags(spark, sf_dir):
    return cleaning.flag_missing(raw_events(spark, sf_dir)).select(
        "row_seq", "copy_no", "source_file", "source_file_referrer_missing", "referrer_missing", "client_id_missing"
    )


@query
def dedupe_keep_first(spark, sf_dir):
    return cleaning.keep_first(cleaning.repair_names(raw_events(spark, sf_dir))).select("row_seq", *cleaning.COPY_KEY)


@query
def dedupe_dropped_count(spark, sf_dir):
    return cleaning.count_copies(cleaning.repair_names(raw_events(spark, sf_dir)))


_CLEAN_COLUMNS = ("row_seq", *[c for c in cleaning.ENRICHED_COLUMNS if c not in ("timestamp_utc", "event_data_parsed")])


@query
def clean_events(spark, sf_dir):
    return cleaning.clean_events(web_events(spark, sf_dir)).select(
        *_CLEAN_COLUMNS,
        "timestamp",
        "unit_price",
        _us("timestamp_utc", "timestamp_us"),
        F.col("event_data_parsed").isNotNull().alias("payload_ok"),
    )


@query
def events_enriched(spark, sf_dir):
    return cleaning.enriched(cleaned(spark, sf_dir)).select(
        *[name for name in cleaning.ENRICHED_COLUMNS if name not in ("timestamp_utc", "event_data_parsed")],
        _us("timestamp_utc", "timestamp_us"),
        F.col("event_data_parsed").isNotNull().alias("payload_ok"),
    )


@query
def events_enriched_dated(spark, sf_dir):
    return cleaning.enriched_dated(cleaned(spark, sf_dir)).select(
        "row_seq",
        "client_id",
        _us("timestamp_ts", "timestamp_us"),
        "dt",
        "utm_source_coalesced",
        "utm_medium_coalesced",
        "utm_campaign_coalesced",
    )


@query
def events_with_device(spark, sf_dir):
    return marts.events_with_device(cleaned(spark, sf_dir)).select(
        *_CLEAN_COLUMNS, _us("timestamp_utc", "timestamp_us"), "device_type", "os", "browser"
    )


# -- sessions and users -------------------------------------------------------------------------------------------

_SESSION_COLUMNS = ("client_id", "session_seq", "session_id", "session_duration_seconds")


def _bounds() -> list[Column]:
    return [_us("session_start", "session_start_us"), _us("session_end", "session_end_us")]


@query
def sessions_event_grain(spark, sf_dir):
    return sessions.session_events(cleaned(spark, sf_dir)).select("row_seq", *_SESSION_COLUMNS, *_bounds())


def _sessions(spark, sf_dir):
    return sessions.sessions(cleaned(spark, sf_dir)).select(*_SESSION_COLUMNS, *_bounds(), "session_last_utm")


_sessions.__name__ = "sessions"
query(_sessions)


@query
def session_event_sequence(spark, sf_dir):
    return sessions.session_sequence(cleaned(spark, sf_dir)).select(
        "client_id", "session_seq", "session_id", "position", "row_seq", "event_name", "page_url", _us("timestamp_utc", "timestamp_us")
    )


@query
def users(spark, sf_dir):
    return sessions.users(cleaned(spark, sf_dir)).select(
        "client_id",
        _us("first_seen", "first_seen_us"),
        _us("last_seen", "last_seen_us"),
        "session_count",
        "n_user_agents",
    )


@query
def user_agents(spark, sf_dir):
    return sessions.user_agents(cleaned(spark, sf_dir))


@query
def purchase_to_session(spark, sf_dir):
    return sessions.purchase_sessions(cleaned(spark, sf_dir)).select("row_seq", "client_id", "session_seq", "session_id")


@query
def session_sample(spark, sf_dir):
    return marts.session_sample(cleaned(spark, sf_dir)).select(
        "session_id", "session_duration_seconds", *_bounds()
    )


# -- attribution and marts ----------------------------------------------------------------------------------------


def _touch(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    return attributed(spark, sf_dir, "total").select(
        "row_seq", "client_id", *[f"{which}_{name}" for name in ("utm_source", "utm_medium", "utm_campaign")]
    )


@query
def attribution_first_touch(spark, sf_dir):
    return _touch(spark, sf_dir, "first")


@query
def attribution_last_touch(spark, sf_dir):
    return _touch(spark, sf_dir, "last")


@query
def purchase_attribution(spark, sf_dir):
    touches = [f"{which}_{name}" for which in ("first", "last") for name in ("utm_source", "utm_medium", "utm_campaign")]
    return attributed(spark, sf_dir, "total").select(
        *_CLEAN_COLUMNS, _us("timestamp_utc", "timestamp_us"), "revenue", *touches
    )


@query
def channel_revenue_last_click(spark, sf_dir):
    return marts.channel_revenue(attributed(spark, sf_dir), "last")


@query
def channel_revenue_first_click(spark, sf_dir):
    return marts.channel_revenue(attributed(spark, sf_dir), "first")


_HALF_LIVES = {"linear": None, "time_decay": multi_touch.HALF_LIFE_DAYS}


def _credit_query(model: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return multi_touch.credits(cleaned(spark, sf_dir), _HALF_LIVES[model]).select(
            "row_seq",
            "client_id",
            "channel",
            "touches",
            round_half_away(F.col("share"), 6).alias("share"),
            round_half_away(F.col("revenue"), 4).alias("revenue"),
        )

    return run


def _channel_credit_query(model: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return multi_touch.channel_credit(multi_touch.credits(cleaned(spark, sf_dir), _HALF_LIVES[model], "price_first"))

    return run


for _model in _HALF_LIVES:
    for _key, _make in (("attribution", _credit_query), ("channel_revenue", _channel_credit_query)):
        _run = _make(_model)
        _run.__name__ = f"{_key}_{_model}"
        query(_run)


@query
def top10_channels(spark, sf_dir):
    return marts.top_channels(attributed(spark, sf_dir), "last", 10)


@query
def daily_revenue(spark, sf_dir):
    return marts.daily_revenue(attributed(spark, sf_dir))


@query
def conversion_rate_by_channel(spark, sf_dir):
    return marts.conversion_by_channel(cleaned(spark, sf_dir))


@query
def top15_conversion_rates(spark, sf_dir):
    return marts.top_conversion_rates(cleaned(spark, sf_dir))


@query
def conversion_rate_client_join(spark, sf_dir):
    return marts.conversion_rate_client_join(cleaned(spark, sf_dir), attributed(spark, sf_dir, "total"))


@query
def revenue_per_session_client_join(spark, sf_dir):
    return marts.revenue_per_session_client_join(cleaned(spark, sf_dir))


@query
def revenue_by_device(spark, sf_dir):
    return marts.revenue_by_device(cleaned(spark, sf_dir))


@query
def assisted_vs_direct_strict_null(spark, sf_dir):
    return marts.assisted_vs_direct(attributed(spark, sf_dir, "total"), literal_direct=False)


@query
def assisted_vs_direct(spark, sf_dir):
    return marts.assisted_vs_direct(attributed(spark, sf_dir))


@query
def conversion_type_share(spark, sf_dir):
    return marts.conversion_type_share(attributed(spark, sf_dir))


@query
def top_products(spark, sf_dir):
    return marts.top_products(attributed(spark, sf_dir))


@query
def revenue_reconciliation(spark, sf_dir):
    return marts.revenue_reconciliation(cleaned(spark, sf_dir), attributed(spark, sf_dir, "total"))


# -- quality ------------------------------------------------------------------------------------------------------


def _profile_check(name: str, check: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return check(quality.profile(raw_events(spark, sf_dir)))

    run.__name__ = name
    query(run)


_profile_check("dq_row_counts", quality.check_row_counts)
_profile_check("dq_timestamp", quality.check_timestamp)
_profile_check("dq_event_taxonomy", quality.check_taxonomy)
_profile_check("dq_invalid_event_names", quality.invalid_event_names)
_profile_check("dq_json_parse", quality.check_json)
_profile_check("dq_client_id_nulls", quality.check_clients)
_profile_check("dq_referrer_anonymization", quality.check_referrers)
_profile_check("dq_utm_coverage", quality.check_utm)
_profile_check("dq_purchase_price", quality.check_prices)


@query
def dq_duplicates(spark, sf_dir):
    return quality.check_duplicates(raw_events(spark, sf_dir))


@query
def dq_schema_per_file(spark, sf_dir):
    return quality.check_schema_per_file(file_schemas(spark, sf_dir))


@query
def dq_schema_global(spark, sf_dir):
    return quality.check_schema(file_schemas(spark, sf_dir))


@query
def dq_issue_rows(spark, sf_dir):
    return quality.issue_sample(raw_events(spark, sf_dir)).select(
        "source_file", "row_seq", "event_name", "client_id", "json_error", "is_duplicate", "is_unknown_event", "is_client_missing"
    )


@query
def dq_report(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    counts = materialize(quality.profile(raw), "profile")
    files = materialize(file_schemas(spark, sf_dir), "files")
    return quality.report(raw, files, counts).select("position", "check", "status", "metric", "details")


# -- monitoring ---------------------------------------------------------------------------------------------------


@query
def monitor_anchor_date(spark, sf_dir):
    return monitoring.anchor_date(cleaned(spark, sf_dir))


@query
def monitor_health(spark, sf_dir):
    return monitoring.scalar_monitors(cleaned(spark, sf_dir), "events", "purchases")


@query
def monitor_null_client_rate(spark, sf_dir):
    return monitoring.scalar_monitors(cleaned(spark, sf_dir), "null_client_rate")


@query
def monitor_json_error_rate(spark, sf_dir):
    return monitoring.scalar_monitors(cleaned(spark, sf_dir), "json_error_rate")


@query
def monitor_dup_rate(spark, sf_dir):
    return monitoring.duplicates(cleaned(spark, sf_dir))


@query
def monitor_revenue_drop(spark, sf_dir):
    return monitoring.revenue_drop(cleaned(spark, sf_dir))


@query
def monitor_direct_share(spark, sf_dir):
    return monitoring.direct_share(attributed(spark, sf_dir, "total"))


@query
def monitor_report(spark, sf_dir):
    events = cleaned(spark, sf_dir)
    rows = monitoring.monitors(events, attributed(spark, sf_dir, "total"))
    alert = F.transform("alerts", lambda a: F.concat_ws(": ", a["severity"], a["message"]))
    return monitoring.report(rows, monitoring.anchor_date(events)).select(
        "date", F.array_join(alert, "; ").alias("alerts"), "status"
    )


@query
def monitor_report_extended(spark, sf_dir):
    return drift.extended_monitors(cleaned(spark, sf_dir), attributed(spark, sf_dir, "total")).select(
        "position", "monitor", "metric", "severity", "message"
    )


@query
def daily_metrics(spark, sf_dir):
    return drift.daily_metrics(cleaned(spark, sf_dir), attributed(spark, sf_dir, "total"))


@query
def monitor_conversion_drift(spark, sf_dir):
    daily = drift.daily_metrics(cleaned(spark, sf_dir), attributed(spark, sf_dir, "total"))
    return drift.relative_drop(daily, "conversion_rate", min_volume=10)


@query
def monitor_event_volume(spark, sf_dir):
    daily = drift.daily_metrics(cleaned(spark, sf_dir), attributed(spark, sf_dir, "total"))
    return drift.unusual_volume(daily)


@query
def monitor_integrity_rates(spark, sf_dir):
    return drift.integrity_rates(cleaned(spark, sf_dir))


@query
def device_revenue_mix(spark, sf_dir):
    mix = device_mix.device_mix(attributed(spark, sf_dir, "total"))
    return mix.withColumn("share", round_half_away(F.col("share"), 6))


@query
def monitor_device_mix(spark, sf_dir):
    return device_mix.mix_drift(device_mix.device_mix(attributed(spark, sf_dir, "total")))


@query
def rolling_users(spark, sf_dir):
    return audience.rolling_users(cleaned(spark, sf_dir))


@query
def rolling_users_sketched(spark, sf_dir):
    """The exact counts, and whether those from daily sketches lie within four standard errors of them."""
    events = cleaned(spark, sf_dir)
    exact = audience.rolling_users(events)
    found = audience.rolling_users_approx(audience.daily_sketches(events)).withColumnRenamed("users", "estimate")
    close = F.abs(F.col("estimate") - F.col("users")) <= 4 * audience.STANDARD_ERROR * F.col("users") + 0.5
    return exact.join(found, ["day", "days", "device_type"], "full").select("day", "days", "device_type", "users", close.alias("within"))


@query
def engagement(spark, sf_dir):
    return drift.engagement(cleaned(spark, sf_dir))


@query
def platforms(spark, sf_dir):
    return drift.platforms(cleaned(spark, sf_dir))


# -- days as they arrive ------------------------------------------------------------------------------------------


def day_stores(spark: SparkSession, sf_dir: str) -> tuple[SessionDays, MartDays]:
    """Sessions and marts that took in all cleaned events in batches: early days, later ones with late rows, and some days twice."""

    def stores(path: str) -> tuple[VersionedTable, SessionDays, MartDays]:
        table, found = VersionedTable(spark, f"{path}/events", day_of()), SessionDays(spark, f"{path}/sessions")
        return table, found, MartDays(spark, f"{path}/marts", table, found)

    def build(path: str) -> None:
        table, found, days = stores(path)
        events = cleaned(spark, sf_dir).drop("dt").withColumn("day", day_of())
        dates = sorted(row["day"] for row in events.select("day").distinct().collect())
        middle = dates[len(dates) // 2]
        early = events.where((F.col("day") < middle) & (F.pmod("row_seq", F.lit(11)) > 0))
        for rows, touched in ((early, [d for d in dates if d < middle]), (events, dates[len(dates) // 3 :]), (events, dates[: len(dates) // 3 + 1])):
            table.replace(rows.where(F.col("day").isin(touched)).drop("day"), touched)
            found.update(table, touched)
            days.update(touched)

    return stores(staged(spark, f"days:{sf_dir}", build))[1:]


@query
def incremental_sessions(spark, sf_dir):
    return day_stores(spark, sf_dir)[0].sessions().select(*_SESSION_COLUMNS, *_bounds(), "session_last_utm")


@query
def incremental_monitor_report(spark, sf_dir):
    alert = F.transform("alerts", lambda a: F.concat_ws(": ", a["severity"], a["message"]))
    return day_stores(spark, sf_dir)[1].report().select("date", F.array_join(alert, "; ").alias("alerts"), "status")


#: marts that are kept by daily sums
DAILY_MARTS = (
    "daily_revenue",
    "channel_revenue_last_click",
    "channel_revenue_first_click",
    "channel_revenue_linear",
    "channel_revenue_time_decay",
    "conversion_rate_by_channel",
    "revenue_by_device",
    "assisted_vs_direct",
    "top_products",
)


def _daily_mart(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return day_stores(spark, sf_dir)[1].marts()[name]

    run.__name__ = f"incremental_{name}"
    return run


for _name in DAILY_MARTS:
    query(_daily_mart(_name))


@query
def arriving_files(spark, sf_dir):
    """Cleaned events of the daily files, which arrive in two drops."""

    def build(path: str) -> None:
        drop = Drop(spark, path, "folder")
        drop.arrive(f"{daily_files(spark, sf_dir)}/source_file=*0[1-9].csv")
        drop.arrive(daily_files(spark, sf_dir))

    events = Drop(spark, staged(spark, f"drop:{sf_dir}", build), "folder").events.read()
    columns = ("source_file", "client_id", "page_url", "referrer", "event_name", "event_data", "user_agent", "utm_source", "price", "total")
    return events.select(*columns, "source_file_referrer_missing", _us("timestamp_utc", "timestamp_us"))


# -- drifting files -----------------------------------------------------------------------------------------------


@query
def file_schema_catalog(spark, sf_dir):
    return file_schemas(spark, sf_dir).select(
        "source_file", F.array_join("columns", ",").alias("columns"), "has_referrer"
    )


@query
def union_drifted_files(spark, sf_dir):
    return csv_drop.read_events(spark, daily_files(spark, sf_dir), "folder").select(
        "source_file",
        "client_id",
        "page_url",
        "referrer",
        "timestamp",
        "event_name",
        "event_data",
        "user_agent",
        "source_file_referrer_missing",
    )
