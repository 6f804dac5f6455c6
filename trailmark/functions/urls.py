"""URL parts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# host part up to the path, query or fragment; brackets only as one pair
_PLAIN = r"[^/?#\[\]]*"
_AUTHORITY = rf"^[\x00-\x20]*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//({_PLAIN}(?:\[{_PLAIN}\]{_PLAIN})?)(?:[/?#]|$)"

_QUERY = r"^[^?#]*\?([^#]*)"

UTM_KEYS = ("utm_source", "utm_medium", "utm_campaign")


def authority(url: Column) -> Column:
    """Lower-case ``user@host:port`` part, ``''`` if there is none, NULL for NULL.

    Leading blanks and control characters don't count, nor do tabs and line breaks anywhere.
    """
    return F.lower(F.regexp_extract(F.translate(url, "\t\r\n", ""), _AUTHORITY, 1))


def domain(url: Column) -> Column:
    """Like ``authority`` with NULL for an empty one."""
    return F.nullif(authority(url), F.lit(""))


def percent_decode(text: Column) -> Column:
    """Percent and plus decoding; a stray ``%`` stays as it is."""
    return F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def query_text(url: Column) -> Column:
    """Text between the first ``?`` and the fragment; NULL where it cannot hold a campaign parameter."""
    return F.when(F.contains(url, F.lit("utm")), F.regexp_extract(url, _QUERY, 1))


def _parameter(names: str) -> str:
    return rf"(?:^|&)(?:{names.replace('_', '(?:_|%5[Ff])')})=([^&]+)"


def query_parameter(query: Column, key: str) -> Column:
    """First non-blank value of a key in a query text, decoded."""
    raw = F.regexp_extract(query, _parameter(key), 1)
    return F.when(raw != "", percent_decode(raw))


def with_utm(df: DataFrame, url: str = "page_url") -> DataFrame:
    """Add the campaign parameters of a URL column."""
    found = {key: query_parameter(F.col("_query"), key) for key in UTM_KEYS}
    return df.withColumn("_query", query_text(F.col(url))).withColumns(found).drop("_query")


def has_utm(url: Column) -> Column:
    """Whether any campaign parameter has a value; false for NULL."""
    return F.coalesce(query_text(url).rlike(_parameter("|".join(UTM_KEYS))), F.lit(False))


def looks_anonymized(host: Column) -> Column:
    """Very long hosts and hosts with a long hexadecimal run; false for NULL."""
    return F.coalesce((F.length(host) > 30) | host.rlike("[0-9a-f]{12,}"), F.lit(False))
