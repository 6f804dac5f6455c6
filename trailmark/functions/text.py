"""Text normalisation: missing-value tokens, header names and event names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that mean "missing" in the raw exports.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Canonical column names by their squeezed spelling.
CANONICAL = {
    "clientid": "client_id",
    "pageurl": "page_url",
    "referrer": "referrer",
    "timestamp": "timestamp",
    "eventname": "event_name",
    "eventdata": "event_data",
    "useragent": "user_agent",
}

# Event names that are another spelling of a known event.
EVENT_RENAMES = {"checkout_completed": "purchase"}

# The known event names.
KNOWN_EVENTS = (
    "page_viewed",
    "email_filled_on_popup",
    "product_added_to_cart",
    "checkout_started",
    "purchase",
)

PURCHASE = "purchase"

_WHITESPACE = " \t\n\r\f\v"


def blank_to_null(col: Column) -> Column:
    """NULL for every missing-value token."""
    return F.when(~col.isin(*NA_TOKENS), col)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(_WHITESPACE))


def squeeze(name: str) -> str:
    """Header spelling without case, blanks and punctuation."""
    return re.sub("[^a-z0-9]", "", name.lower())


def repaired_event_name(col: Column, renames: dict[str, str] | None = None) -> Column:
    """Stripped event name with known misspellings mapped; blank becomes NULL."""
    name = F.nullif(strip(col), F.lit(""))
    repaired = name
    for wrong, right in (EVENT_RENAMES if renames is None else renames).items():
        repaired = F.when(name == wrong, F.lit(right)).otherwise(repaired)
    return repaired


def digest_of(*names: str) -> list[Column]:
    """128 bits that stand for the values of some columns, NULL apart from any text: keys that are cheap to shuffle."""
    values = [part for name in names for part in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(*values).alias("_key_1"), F.xxhash64(F.lit("second"), *values).alias("_key_2")]
