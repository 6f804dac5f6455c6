from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trailmark.operators import cleaning, monitoring, quality

RAW = (
    "source_file string, row_seq bigint, client_id string, page_url string, referrer string, timestamp string, "
    "event_name string, event_data string, user_agent string, source_file_referrer_missing boolean"
)


def raw_frame(spark, rows):
    base = ("f", None, "a", "http://h/", None, "2025-03-01 10:00:00", "page_viewed", "{}", None, False)
    names = [part.split()[0] for part in RAW.split(", ")]
    filled = []
    for position, row in enumerate(rows):
        values = dict(zip(names, base, strict=True)) | {"row_seq": position} | row
        filled.append(tuple(values[name] for name in names))
    return spark.createDataFrame(filled, RAW)


def test_copies_are_limited_before_the_shuffle(spark):
    # a group of copies holds most rows; the first one stays, NULL equals NULL, names are repaired first
    rows = [{"client_id": None, "event_name": "purchase", "user_agent": str(i)} for i in range(50)]
    rows += [{"client_id": None, "event_name": "checkout_completed"}, {"client_id": "b"}]
    raw = raw_frame(spark, rows)
    named = cleaning.repair_names(cleaning.normalize(raw))
    kept = cleaning.keep_first(named)
    assert sorted(row["row_seq"] for row in kept.collect()) == [0, 51]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[exchange:] and "WindowGroupLimit" in plan[exchange:]
    assert tuple(cleaning.count_copies(named).head()) == (52, 2, 50)


def checks(spark, raw):
    counts = quality.profile(cleaning.normalize(raw))
    return {
        "json": quality.check_json(counts).head(),
        "clients": quality.check_clients(counts).head(),
        "names": quality.check_taxonomy(counts).head(),
        "prices": quality.check_prices(counts).head(),
        "utm": quality.check_utm(counts).head(),
        "referrers": quality.check_referrers(counts).head(),
        "times": quality.check_timestamp(counts).head(),
    }


def test_row_checks(spark):
    rows = [
        {"event_data": "null "},
        {"event_data": "{x", "client_id": None},
        {"event_data": None, "event_name": "odd"},
        {"event_name": "purchase", "event_data": "{}"},
        {"event_name": "purchase", "event_data": '{"price": 0}'},
        {"event_name": "purchase", "event_data": '{"price": 3}', "page_url": "http://h/?utm_campaign=c"},
        {"event_name": "checkout_completed", "event_data": "{}", "timestamp": "?"},
        {"referrer": "http://0123456789abcdef.com/"},
    ]
    got = checks(spark, raw_frame(spark, rows))
    assert (got["json"]["status"], got["json"]["metric"]) == ("fail", 2.0)
    assert (got["clients"]["status"], got["clients"]["details"]) == ("warn", "1")
    assert got["names"]["details"] == "['checkout_completed', 'odd']"
    assert got["prices"]["details"] == "missing=1, zero_or_negative=2"
    assert (got["utm"]["status"], got["utm"]["details"]) == ("warn", "utm_rate=0.125")
    assert (got["referrers"]["status"], got["referrers"]["details"]) == ("warn", "anonymized_rate=0.125")
    assert got["times"]["details"] == "bad_timestamps=1"


def test_issue_sample_with_many_twins(spark):
    rows = [{} for _ in range(30)] + [{"client_id": None, "timestamp": "2025-03-01 11:00:00"}]
    raw = cleaning.normalize(raw_frame(spark, rows))
    assert [row["row_seq"] for row in quality.issue_sample(raw, 5).collect()] == [1, 2, 3, 4, 5]
    assert quality.issue_sample(raw, 100).count() == 30
    assert quality.check_duplicates(raw).head()["details"] == "29"


def test_gate(spark):
    rows = spark.createDataFrame([("a", "pass"), ("b", "warn")], "check string, status string")
    quality.gate(rows)
    with pytest.raises(quality.QualityGateError, match="a"):
        quality.gate(rows.withColumn("status", F.lit("fail")))


EVENTS = "source_file string, client_id string, timestamp_utc timestamp, event_name string, event_data string, event_data_parsed string, total double"


def sales(spark, amounts):
    rows = [("f", "a", None, "purchase", "{}", "{}", amount) for amount in amounts]
    df = spark.createDataFrame(rows, EVENTS)
    days = {amount: day for day, amount in enumerate(amounts, start=1)}
    day = F.create_map(*[F.lit(x) for pair in days.items() for x in pair])[F.col("total")]
    return df.withColumn("timestamp_utc", F.make_timestamp(F.lit(2025), F.lit(3), day, F.lit(0), F.lit(0), F.lit(0.0)))


def test_revenue_drop(spark):
    row = monitoring.revenue_drop(sales(spark, [90.0, 100.0, 110.0, 95.0, 105.0, 98.0, 102.0, 50.0])).head()
    assert row["severity"] == "CRITICAL" and row["metric"] == 0.5
    assert row["message"] == "Revenue drop detected: 50 vs baseline 100"
    # seven days are too few
    short = monitoring.revenue_drop(sales(spark, [100.0, 110.0, 95.0, 105.0, 98.0, 102.0, 50.0])).head()
    assert short["severity"] is None and short["metric"] is None


def test_empty_input_raises_alerts(spark):
    empty = spark.createDataFrame([], EVENTS)
    purchases = spark.createDataFrame([], "revenue double, last_utm_source string")
    rows = monitoring.monitors(empty, purchases)
    row = monitoring.report(rows, monitoring.anchor_date(empty)).head()
    assert row["date"] is None and row["status"] == "FAIL"
    assert [alert["message"] for alert in row["alerts"]] == ["No events ingested today", "No purchases recorded today"]


def test_direct_share(spark):
    purchases = spark.createDataFrame([(9.0, None), (1.0, "x")], "revenue double, last_utm_source string")
    row = monitoring.direct_share(purchases).head()
    assert (row["severity"], row["message"]) == ("WARN", "Direct traffic unusually high: 90.00%")
    assert monitoring.direct_share(purchases.where("last_utm_source = 'x'")).head()["severity"] is None
