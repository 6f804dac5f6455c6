"""Column functions on literals; expected values are worked out by hand."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from trailmark.functions import numbers, payload, text, times, urls, user_agent
from trailmark.sources.web_events import USER_AGENTS

PAYLOADS = [
    # text, price, quantity, product_id, unit_price, total
    ('{"price": 10, "quantity": 2, "product_id": "a"}', 10, 2, "a", 10, 20),
    ("{'price': 10, 'quantity': \"2\", 'sku': 'b'}", 10, 2, "b", 10, 20),
    ('{"items":[{"product_id":"a","price":10,"quantity":2},{"price":1,"quantity":2}]}', None, 4, "a", 11, 44),
    ('{"total": 30}', 30, None, None, 30, None),
    ('{"price": 0, "quantity": 0, "items":[{"price":7,"quantity":1,"sku":"s"}]}', 0, 1, "s", 7, 7),
    ('{"price": "abc", "amount": 9}', None, None, None, None, None),
    ('{"quantity": "0"}', None, 0, None, None, None),
    ('{"items":[{"quantity": null}]}', None, 0, None, None, None),
    ('{"items":[{"quantity": "x"}, 5]}', None, None, None, None, None),
    ("{bad json", None, None, None, None, None),
    (None, None, None, None, None, None),
    ("  ", None, None, None, None, None),
    ('{"price": "12.5"}', 12.5, None, None, 12.5, None),
    ('{"price": "1d"}', None, None, None, None, None),
    ('{"price": true}', 1, None, None, 1, None),
    ('{"price": null, "total": 4}', None, None, None, None, None),
    ("null", None, None, None, None, None),
    ("[1]", None, None, None, None, None),
    ("7", None, None, None, None, None),
    ('{"items": 3}', None, None, None, None, None),
    ('{"items": []}', None, None, None, None, None),
    ('{"price": 1, "price": 2}', 2, None, None, 2, None),
    ('{"price": 1} x', None, None, None, None, None),
    ('{"price": 1}, {"price": 2}', None, None, None, None, None),
    ('{"quantity": "x", "items":[{"quantity":1}]}', None, None, None, None, None),
    ('{"quantity": [], "items":[{"quantity":1}]}', None, 1, None, None, None),
    ('{"product_id": "", "item_id": 0, "sku": 5}', None, None, "5", None, None),
    ('{"items":[{"item_id": ""}]}', None, None, "", None, None),
    ('{"items":[{"product_id": null},{"product_id":"p"}], "sku": null}', None, None, None, None, None),
    ('{"price": 2.50, "quantity": 1e1}', 2.5, 10, None, 2.5, 25),
    ("{}", None, None, None, None, None),
]


def test_payload_fields(spark):
    rows = [(i, case[0]) for i, case in enumerate(PAYLOADS)]
    df = spark.createDataFrame(rows, "i int, event_data string")
    got = payload.with_payload_fields(payload.with_payload(df)).orderBy("i").collect()
    for case, row in zip(PAYLOADS, got, strict=True):
        found = (row["price"], row["quantity"], row["product_id"], row["unit_price"], row["total"])
        assert found == case[1:], case[0]


@pytest.mark.parametrize(
    ("value", "parsed"),
    [("{}", True), ("null", False), ("[1]", True), ("7", True), ('{"a":1}] x', False), ("{'a': 'b'}", True), ("{", False)],
)
def test_payload_presence(spark, value, parsed):
    df = payload.with_payload(spark.createDataFrame([(value,)], "event_data string"))
    assert df.select(F.col("event_data_parsed").isNotNull()).head()[0] is parsed


def test_utm(spark):
    cases = {
        "http://h/?utm_source=g%20x+y&utm_medium=": ("g x y", None, None),
        "http://h/?utm_source=&utm_source=b": ("b", None, None),
        "http://h/#x?utm_source=1": (None, None, None),
        "http://h/?utm_source=%zz": ("%zz", None, None),
        "http://h/?utm_source=%zz%20y": ("%zz y", None, None),
        "http://h/?a=1&utm_campaign=c#f": (None, None, "c"),
        "http://h/?xutm_source=1": (None, None, None),
        "http://h/?utm%5Fsource=e": ("e", None, None),
        "?utm_source=q": ("q", None, None),
        "http://h/p": (None, None, None),
        None: (None, None, None),
    }
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "i int, page_url string")
    got = urls.with_utm(df).withColumn("any", urls.has_utm(F.col("page_url"))).orderBy("i").collect()
    for expected, row in zip(cases.values(), got, strict=True):
        assert (row["utm_source"], row["utm_medium"], row["utm_campaign"]) == expected, row["page_url"]
        assert row["any"] == any(value is not None for value in expected)


def test_domain(spark):
    cases = {
        "http://U@Host.COM:80/x y": "u@host.com:80",
        "//h/p": "h",
        "a.com": "",
        "http://[::1]:8/x": "[::1]:8",
        "http://[bad": "",
        "https://h?q": "h",
        "https://h#f": "h",
        "1http://h/": "",
        None: None,
    }
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "i int, u string")
    got = df.orderBy("i").select(urls.authority(F.col("u")), urls.domain(F.col("u"))).collect()
    for expected, row in zip(cases.values(), got, strict=True):
        assert (row[0], row[1]) == (expected, expected or None)


def test_anonymized(spark):
    hosts = {"a" * 31: True, "0123456789ab.com": True, "0123456789a.com": False, "": False, None: False}
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hosts)], "i int, h string")
    got = [row[0] for row in df.orderBy("i").select(urls.looks_anonymized(F.col("h"))).collect()]
    assert got == list(hosts.values())


def test_user_agents(spark):
    expected = [
        ("tablet", "iOS", "Safari"),
        ("mobile", "iOS", "Chrome (iOS)"),
        ("mobile", "Android", "Chrome"),
        ("tablet", "Android", "Chrome"),
        ("desktop", "Windows", "Edge"),
        ("desktop", "MacOS", "Safari"),
        ("desktop", "Linux", "Firefox"),
        ("unknown", "Other", "Other"),
    ]
    df = spark.createDataFrame(list(enumerate([*USER_AGENTS, None])), "i int, ua string")
    agent = F.col("ua")
    got = df.orderBy("i").select(
        user_agent.device_type(agent), user_agent.operating_system(agent), user_agent.browser(agent)
    )
    assert [tuple(row) for row in got.collect()] == expected


def test_timestamps(spark):
    cases = {
        "2025-03-01 12:00:00.123456": 1740830400123456,
        "2025-03-01T12:00:00Z": 1740830400000000,
        "2025-03-01T14:00:00+02:00": 1740830400000000,
        "2025/03/01 12:00:00": 1740830400000000,
        "12:00": None,
        "nonsense": None,
        "2025-13-01": None,
        None: None,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = [row[0] for row in df.orderBy("i").select(times.micros(times.parse_utc(F.col("t")))).collect()]
    assert got == list(cases.values())


def test_missing_tokens_and_names(spark):
    assert len(text.NA_TOKENS) == 19
    df = spark.createDataFrame([(token,) for token in text.NA_TOKENS], "t string")
    assert df.where(text.blank_to_null(F.col("t")).isNotNull()).count() == 0
    names = [(0, " checkout_completed\t"), (1, "  "), (2, "purchase"), (3, "odd"), (4, None)]
    got = spark.createDataFrame(names, "i int, n string").orderBy("i").select(text.repaired_event_name(F.col("n")))
    assert [row[0] for row in got.collect()] == ["purchase", None, "purchase", "odd", None]


def test_rounding(spark):
    values = [1.005, 0.285, 2.5, -2.5, 0.125]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    got = [row[0] for row in df.orderBy("i").select(numbers.round_half_away(F.col("x"), 2)).collect()]
    assert got == [math.copysign(math.floor(abs(x) * 100 + 0.5) / 100, x) for x in values]


def test_blanks_and_controls_before_a_url(spark):
    from urllib.parse import urlparse

    texts = [" http://Shop.example/x", "\x00\x1f\t //h.example", "http://sp\tl\nit.example/y", "ht tp://h/", " ", "\xa0http://h/"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, u string")
    got = [row[0] for row in df.orderBy("i").select(urls.authority(F.col("u"))).collect()]
    assert got == [urlparse(text).netloc.lower() for text in texts]
