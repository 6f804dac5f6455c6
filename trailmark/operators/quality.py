"""Quality checks on raw events: one row (check, status, metric, details) per check.

All row-level checks come out of one aggregation by (file, event name), see ``profile``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..functions.payload import fields_of, price_of, with_payload
from ..functions.text import CANONICAL, KNOWN_EVENTS, PURCHASE, digest_of
from ..functions.times import parse_utc
from ..functions.urls import authority, has_utm, looks_anonymized

# Columns whose equality makes two raw rows duplicates.
DUPLICATE_KEY = ("source_file", "timestamp", "event_name", "event_data")
# Required columns, squeezed spelling, and those whose absence is severe.
REQUIRED = ("clientid", "pageurl", "referrer", "timestamp", "eventname", "eventdata", "useragent")
SEVERE = ("timestamp", "eventname", "eventdata", "clientid", "pageurl")


def _check(name: str, status: Column, metric: Column, details: Column) -> list[Column]:
    return [
        F.lit(name).alias("check"),
        status.alias("status"),
        metric.cast("double").alias("metric"),
        details.alias("details"),
    ]


def _above(metric: Column, fail: float, warn: float) -> Column:
    return F.when(metric > fail, "fail").when(metric > warn, "warn").otherwise("pass")


def _below(metric: Column, fail: float, warn: float) -> Column:
    return F.when(metric < fail, "fail").when(metric < warn, "warn").otherwise("pass")


def _any(count: Column, status: str = "fail") -> Column:
    return F.when(count > 0, status).otherwise("pass")


def _listing(rows: DataFrame, key: str, text: Column, around: str) -> DataFrame:
    """One row: how many rows there are and all their texts joined in key order.

    The rows are files or event names, not events; they are a frame of their own too, for those who read them by machine.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), text.alias("text"))))
    joined = F.array_join(F.transform("entries", lambda entry: entry["text"]), ", ")
    return rows.agg(F.count("*").alias("found"), entries.alias("entries")).select(
        "found", F.concat(F.lit(around[0]), joined, F.lit(around[1])).alias("listed")
    )


# -- row-level checks ---------------------------------------------------------------------------------------------


def inspect(raw: DataFrame) -> DataFrame:
    """Raw events with parsed timestamp and payload and the flags that the checks count."""
    parsed = with_payload(raw.withColumn("timestamp_parsed", parse_utc(F.col("timestamp"))))
    shared = {"referrer_domain": authority(F.col("referrer")), "_fields": fields_of(F.col("event_data_parsed"))}
    return parsed.withColumns(shared).withColumns(
        {
            "json_error": F.col("event_data").isNotNull() & F.col("event_data_parsed").isNull(),
            "referrer_anonymized": looks_anonymized(F.col("referrer_domain")),
            "has_utm": has_utm(F.col("page_url")),
            "price": price_of(F.col("_fields")),
        }
    ).drop("_fields")


def profile(raw: DataFrame) -> DataFrame:
    """All counts of the row-level checks by (source_file, event_name), in one pass over the events."""
    is_purchase = F.col("event_name") == PURCHASE
    no_price = F.col("price").isNull()
    return (
        inspect(raw)
        .groupBy("source_file", "event_name")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("timestamp_parsed").isNull()).alias("bad_timestamps"),
            F.count_if("json_error").alias("json_errors"),
            F.count_if(F.col("client_id").isNull()).alias("null_clients"),
            F.count_if("referrer_anonymized").alias("anonymized"),
            F.count_if("has_utm").alias("with_utm"),
            F.count_if(is_purchase & no_price).alias("price_missing"),
            F.count_if(is_purchase & (no_price | (F.col("price") <= 0))).alias("price_not_positive"),
        )
    )


def _totals(counts: DataFrame, *names: str) -> DataFrame:
    return counts.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])


def check_timestamp(counts: DataFrame) -> DataFrame:
    bad = F.col("bad_timestamps")
    return _totals(counts, "bad_timestamps").select(
        *_check("timestamp", _any(bad), bad, F.concat(F.lit("bad_timestamps="), bad.cast("string")))
    )


def check_json(counts: DataFrame) -> DataFrame:
    bad = F.col("json_errors")
    return _totals(counts, "json_errors").select(*_check("json_parse", _any(bad), bad, F.lit("")))


def check_clients(counts: DataFrame) -> DataFrame:
    bad = F.col("null_clients")
    return _totals(counts, "null_clients").select(
        *_check("client_id_nulls", _any(bad, "warn"), bad, bad.cast("string"))
    )


def check_referrers(counts: DataFrame) -> DataFrame:
    rate = ratio(F.col("anonymized"), F.col("rows"))
    return _totals(counts, "anonymized", "rows").select(
        *_check(
            "referrer_anonymization",
            _above(rate, 0.20, 0.05),
            rate,
            F.concat(F.lit("anonymized_rate="), F.format_string("%.3f", rate)),
        )
    )


def check_utm(counts: DataFrame) -> DataFrame:
    rate = ratio(F.col("with_utm"), F.col("rows"))
    return _totals(counts, "with_utm", "rows").select(
        *_check(
            "utm_coverage",
            _below(rate, 0.05, 0.15),
            rate,
            F.concat(F.lit("utm_rate="), F.format_string("%.3f", rate)),
        )
    )


def check_prices(counts: DataFrame) -> DataFrame:
    """Raw purchases without a price or with one that is not positive; a missing price counts in both."""
    missing, low = F.col("price_missing"), F.col("price_not_positive")
    return _totals(counts, "price_missing", "price_not_positive").select(
        *_check(
            "purchase_price_validation",
            _any(missing + low),
            low,
            F.format_string("missing=%d, zero_or_negative=%d", missing, low),
        )
    )


def check_row_counts(counts: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Files whose row count is more than half the mean away from the mean; files without rows fail.

    ``files`` (source_file) adds the files that have a header only; the mean is over the others.
    """
    unusual = unusual_files(counts, files)
    text = F.format_string("{'source_file': '%s', 'rows': %d}", F.col("source_file"), F.col("rows"))
    empty = unusual.agg(F.count_if(F.col("rows") == 0)).scalar()
    status = F.when(F.col("empty") > 0, "fail").when(F.col("found") > 0, "warn").otherwise("pass")
    return _listing(unusual, "source_file", text, "[]").withColumn("empty", empty).select(
        *_check("row_counts", status, F.col("found"), F.when(F.col("found") > 0, F.col("listed")).otherwise("{}"))
    )


def unusual_files(counts: DataFrame, files: DataFrame | None = None) -> DataFrame:
    per_file = counts.groupBy("source_file").agg(F.sum("rows").alias("rows"))
    mean = per_file.agg(F.avg("rows")).scalar()
    if files is not None:
        per_file = files.join(per_file, "source_file", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    # if there are empty files, only they are reported
    least = per_file.agg(F.min("rows")).scalar()
    return (
        per_file.withColumns({"mean": mean, "least": least})
        .where(F.when(F.col("least") == 0, F.col("rows") == 0).otherwise(F.abs(F.col("rows") - F.col("mean")) > 0.5 * F.col("mean")))
        .select("source_file", "rows")
    )


def invalid_event_names(counts: DataFrame, known: tuple[str, ...] = KNOWN_EVENTS) -> DataFrame:
    """Event names outside the taxonomy with their row counts."""
    names = counts.where(F.col("event_name").isNotNull() & ~F.col("event_name").isin(*known))
    return names.groupBy("event_name").agg(F.sum("rows").alias("rows"))


def check_taxonomy(counts: DataFrame, known: tuple[str, ...] = KNOWN_EVENTS) -> DataFrame:
    quoted = F.concat(F.lit("'"), F.col("event_name"), F.lit("'"))
    return _listing(invalid_event_names(counts, known), "event_name", quoted, "[]").select(
        *_check("event_taxonomy", _any(F.col("found")), F.col("found"), F.col("listed"))
    )


# -- duplicates and issues ----------------------------------------------------------------------------------------


def check_duplicates(raw: DataFrame, key: tuple[str, ...] = DUPLICATE_KEY) -> DataFrame:
    """Rows that repeat an earlier row's key; NULL equals NULL."""
    groups = raw.groupBy(*digest_of(*key)).agg(F.count("*").alias("n"))
    extra = F.col("extra")
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra")).select(
        *_check("duplicates", _any(extra), extra, extra.cast("string"))
    )


def issue_sample(raw: DataFrame, n: int = 200, known: tuple[str, ...] = KNOWN_EVENTS) -> DataFrame:
    """The first ``n`` rows, by file and row, with a payload error, an earlier twin, an unknown name or no client.

    A row with more than ``n`` twins before it has at least ``n`` reported rows before it, so only the first
    ``n + 1`` rows of each group can matter; Spark applies that limit before the shuffle.
    """
    twins = Window.partitionBy(*DUPLICATE_KEY).orderBy("row_seq")
    near = raw.withColumn("nth", F.row_number().over(twins)).where(F.col("nth") <= n + 1)
    name = F.col("event_name")
    return (
        inspect(near)
        .withColumns(
            {
                "is_duplicate": F.col("nth") > 1,
                "is_unknown_event": F.coalesce(~name.isin(*known), F.lit(False)),
                "is_client_missing": F.col("client_id").isNull(),
            }
        )
        .where("json_error OR is_duplicate OR is_unknown_event OR is_client_missing")
        .orderBy("source_file", "row_seq")
        .limit(n)
        .drop("nth")
    )


# -- schema checks ------------------------------------------------------------------------------------------------


def _squeezed(columns: str) -> Column:
    return F.transform(columns, lambda name: F.regexp_replace(F.lower(name), "[^a-z0-9]", ""))


def missing_columns(files: DataFrame) -> DataFrame:
    """Sources that lack required columns; ``files`` is the result of ``file_schemas``."""
    required = F.array(*[F.lit(name) for name in REQUIRED])
    severe = F.array(*[F.lit(name) for name in SEVERE])
    missing = F.array_except(required, _squeezed("columns"))
    return (
        files.select("source_file", missing.alias("missing"))
        .where(F.size("missing") > 0)
        .withColumn("severe", F.arrays_overlap("missing", severe))
    )


def check_schema_per_file(files: DataFrame) -> DataFrame:
    bad = missing_columns(files)
    names = F.array_join(F.transform("missing", lambda name: F.concat(F.lit("'"), name, F.lit("'"))), ", ")
    text = F.concat(F.lit("'"), F.col("source_file"), F.lit("': ["), names, F.lit("]"))
    severe = bad.agg(F.count_if("severe")).scalar()
    status = F.when(F.col("severe") > 0, "fail").when(F.col("found") > 0, "warn").otherwise("pass")
    return (
        _listing(bad, "source_file", text, "{}")
        .withColumn("severe", severe)
        .select(*_check("schema_per_file", status, F.col("found"), F.col("listed")))
    )


def check_schema(files: DataFrame) -> DataFrame:
    """Canonical columns that no file has."""
    seen = files.select(F.explode(_squeezed("columns")).alias("name")).where(F.col("name").isin(*CANONICAL)).distinct()
    # at most seven names are left
    absent = F.array_except(F.array(*[F.lit(name) for name in CANONICAL]), F.col("seen"))
    canonical = F.create_map(*[F.lit(text) for pair in CANONICAL.items() for text in pair])
    named = F.transform("absent", lambda name: F.concat(F.lit("'"), canonical[name], F.lit("'")))
    found = F.size("absent")
    return (
        seen.agg(F.collect_list("name").alias("seen"))
        .select(absent.alias("absent"))
        .select(*_check("schema", _any(found), found, F.concat(F.lit("missing=["), F.array_join(named, ", "), F.lit("]"))))
    )


# -- the report ---------------------------------------------------------------------------------------------------


def report(raw: DataFrame, files: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """All checks in report order.

    ``counts`` is ``profile(raw)``; pass a stored one, since several checks read it.
    """
    counts = profile(raw) if counts is None else counts
    checks = [
        check_schema_per_file(files),
        check_row_counts(counts, files.select("source_file")),
        check_schema(files),
        check_timestamp(counts),
        check_taxonomy(counts),
        check_json(counts),
        check_duplicates(raw),
        check_clients(counts),
        check_referrers(counts),
        check_utm(counts),
        check_prices(counts),
    ]
    rows = checks[0].withColumn("position", F.lit(0))
    for position, check in enumerate(checks[1:], start=1):
        rows = rows.unionByName(check.withColumn("position", F.lit(position)))
    return rows


def report_lines(rows: DataFrame) -> DataFrame:
    """The report as Markdown, one line per row; headings and line form are fixed values."""
    entry = F.format_string("- **%s** → *%s* — %s", F.col("check"), F.col("status"), F.col("details"))
    head = rows.sparkSession.createDataFrame(
        [(-2, "# Incoming Data Quality Report\n"), (-1, "## Summary of Checks\n")], "position int, line string"
    )
    return head.unionByName(rows.select("position", entry.alias("line"))).orderBy("position").select("line")


class QualityGateError(RuntimeError):
    """A batch failed its checks."""


def gate(rows: DataFrame) -> None:
    """Raise if a check of the report failed (eleven rows at most come to the driver)."""
    failed = [row["check"] for row in rows.where("status = 'fail'").select("check").take(50)]
    if failed:
        raise QualityGateError("failed checks: " + ", ".join(sorted(failed)))
