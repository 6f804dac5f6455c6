"""Small cleaned-event frames."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

START = datetime(2025, 3, 1, 12, 0, 0, tzinfo=timezone.utc)

SCHEMA = (
    "row_seq bigint, client_id string, timestamp_utc timestamp, event_name string, page_url string, user_agent string, "
    "utm_source string, utm_medium string, utm_campaign string, price double, total double, product_id string"
)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def events(spark, rows):
    """Rows as dicts; ``t`` is seconds after the start, None for an undated event."""
    filled = []
    for position, row in enumerate(rows):
        moment = row.get("t")
        filled.append(
            (
                row.get("row_seq", position),
                row.get("client", "a"),
                None if moment is None else at(moment),
                row.get("name", "page_viewed"),
                row.get("url", "/"),
                row.get("ua"),
                row.get("source"),
                row.get("medium"),
                row.get("campaign"),
                row.get("price"),
                row.get("total"),
                row.get("product"),
            )
        )
    return spark.createDataFrame(filled, SCHEMA)
