"""Raw events to cleaned events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.payload import with_payload, with_payload_fields
from ..functions.text import CANONICAL, blank_to_null, digest_of, repaired_event_name
from ..functions.times import parse_utc
from ..functions.urls import domain, with_utm

# Columns whose equality makes two cleaned rows copies of each other (NULL equals NULL).
COPY_KEY = ("source_file", "timestamp", "event_name", "event_data", "page_url", "referrer", "client_id")

ENRICHED_COLUMNS = (
    "source_file",
    "client_id",
    "page_url",
    "referrer",
    "timestamp_utc",
    "event_name",
    "event_data",
    "event_data_parsed",
    "user_agent",
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "price",
    "total",
    "quantity",
    "product_id",
    "referrer_domain",
    "client_id_missing",
    "source_file_referrer_missing",
    "referrer_missing",
)


def normalize(raw: DataFrame) -> DataFrame:
    """Missing-value tokens to NULL in every raw text column."""
    return raw.withColumns({name: blank_to_null(F.col(name)) for name in CANONICAL.values()})


def repair_names(events: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    return events.withColumn("event_name", repaired_event_name(F.col("event_name"), renames))


def flag_missing(events: DataFrame) -> DataFrame:
    """Row-level flags; the file-level one comes with the source, which knows each file's header."""
    return events.withColumns(
        {"referrer_missing": F.col("referrer").isNull(), "client_id_missing": F.col("client_id").isNull()}
    )


def keep_first(events: DataFrame, key: tuple[str, ...] = COPY_KEY, order: str = "row_seq") -> DataFrame:
    """The first row of each group of copies.

    Spark limits each group before the shuffle as well (WindowGroupLimit), so however many copies a group has,
    every task sends one of them. The hash comes first in the sort, so long texts are compared only between copies.
    """
    copies = Window.partitionBy("_hash", *key).orderBy(order)
    return (
        events.withColumn("_hash", F.xxhash64(*key))
        .withColumn("_copy", F.row_number().over(copies))
        .where("_copy = 1")
        .drop("_copy", "_hash")
    )


def count_copies(events: DataFrame, key: tuple[str, ...] = COPY_KEY) -> DataFrame:
    """One row: rows, rows after keeping the first of each group, rows dropped."""
    groups = events.groupBy(*digest_of(*key)).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")
    ).withColumn("dropped", F.col("rows_before") - F.col("rows_after"))


def derive(events: DataFrame) -> DataFrame:
    """Timestamp, payload, campaign and referrer columns of normalized events."""
    parsed = with_payload(events.withColumn("timestamp_utc", parse_utc(F.col("timestamp"))))
    return with_utm(with_payload_fields(parsed)).withColumn("referrer_domain", domain(F.col("referrer")))


def clean_events(raw: DataFrame) -> DataFrame:
    """Repair names, flag, drop copies (after the repair, before any parsing) and derive the typed columns."""
    return derive(keep_first(flag_missing(repair_names(normalize(raw)))))


def enriched(events: DataFrame) -> DataFrame:
    """The analytics projection of cleaned events."""
    return events.select(*ENRICHED_COLUMNS)


def enriched_dated(events: DataFrame) -> DataFrame:
    """Cleaned events with timestamp, day and campaign columns that default to ``direct``."""
    direct = {f"{key}_coalesced": F.coalesce(key, F.lit("direct")) for key in ("utm_source", "utm_medium", "utm_campaign")}
    return events.withColumns(
        {"timestamp_ts": F.col("timestamp_utc"), "dt": F.to_date("timestamp_utc"), **direct}
    )
