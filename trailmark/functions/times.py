"""Timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms besides ISO 8601.
EXTRA_FORMATS = ("yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "dd-MMM-yyyy HH:mm:ss")

MICROS = 1_000_000


def parse_utc(text: Column, formats: tuple[str, ...] = EXTRA_FORMATS) -> Column:
    """UTC timestamp of a text, NULL where no accepted form fits."""
    # the plain cast would read a bare time of day as today's date
    iso = F.when(text.rlike(r"^\s*\d{4}-"), text.try_cast("timestamp"))
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(form)) for form in formats])


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def whole_seconds(ts: Column) -> Column:
    """Epoch second; the difference of two counts the second boundaries between them."""
    return F.unix_seconds(ts)
