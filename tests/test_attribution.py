from __future__ import annotations

import random

from helpers import events

from trailmark.operators import attribution, marts

DAY = 86_400
NAMES = ("first_utm_source", "first_utm_medium", "last_utm_source", "last_utm_medium")


def touches(df, **options):
    rows = attribution.purchase_attribution(df, **options).collect()
    return {row["row_seq"]: tuple(row[name] for name in NAMES) for row in rows}


def test_edges(spark):
    week = 7 * DAY
    rows = [
        {"t": 0, "source": "edge", "medium": "m"},
        {"t": week, "name": "purchase"},
        {"t": 0, "client": "b", "source": "late"},
        {"t": week + 0.000001, "client": "b", "name": "purchase"},
        {"t": 9, "client": "c", "name": "purchase", "source": "own"},
        {"t": 0, "client": None, "source": "nobody"},
        {"t": 1, "client": None, "name": "purchase"},
        {"t": 0, "client": "d", "medium": "only"},
        {"t": 1, "client": "d", "name": "purchase"},
        {"t": 0, "client": "e", "source": "t1"},
        {"t": 0, "client": "e", "source": "t2", "medium": "z"},
        {"t": 0, "client": "e", "name": "purchase"},
        {"t": None, "client": "e", "name": "purchase"},
        {"t": 5, "client": "f", "name": "purchase"},
        {"t": 6, "client": "f", "source": "after"},
    ]
    none = (None,) * 4
    assert touches(events(spark, rows)) == {
        1: ("edge", "m", "edge", "m"),
        3: none,
        4: ("own", None, "own", None),
        6: none,
        8: none,
        11: ("t1", None, "t2", "z"),
        12: none,
        13: none,
    }


def brute(rows, reach):
    result = {}
    for p in rows:
        if p["name"] != "purchase":
            continue
        seen = [
            t
            for t in rows
            if p["client"] and t["client"] == p["client"] and t["source"] and None not in (p["t"], t["t"])
            and round(p["t"] - reach, 6) <= t["t"] <= p["t"]
        ]
        seen.sort(key=lambda t: (t["t"], t["row_seq"]))
        ends = (seen[0], seen[-1]) if seen else ()
        result[p["row_seq"]] = tuple(x for t in ends for x in (t["source"], t["medium"])) or (None,) * 4
    return result


def test_against_brute_force_for_any_slice_width(spark):
    rng = random.Random(5)
    rows = [
        {
            "row_seq": i,
            "client": "hot" if i % 3 == 0 else rng.choice(["a", "b", None]),
            "t": None if rng.random() < 0.03 else round(rng.choice([rng.uniform(0, 20 * DAY), rng.randint(0, 9) * DAY]), 6),
            "name": rng.choice(["purchase", "page_viewed"]),
            "source": rng.choice([None, "x", "y"]),
            "medium": rng.choice([None, "m", "n"]),
        }
        for i in range(400)
    ]
    df = events(spark, rows)
    expected = brute(rows, 7 * DAY)
    for width in (1, 60, 30 * DAY):
        assert touches(df, slice_seconds=width) == expected
    assert touches(df, days=1) == brute(rows, DAY)


def test_every_purchase_comes_back_once(spark):
    rows = [{"t": 1, "name": "purchase", "total": 2.0}] * 3 + [{"t": None, "name": "purchase", "price": 4.0}]
    df = events(spark, [dict(row) for row in rows])
    assert attribution.purchase_attribution(df).count() == 4
    total = marts.revenue_reconciliation(df, attribution.purchase_attribution(df)).head()
    assert tuple(total) == (6.0, 6.0)
    first = attribution.purchase_attribution(df, "price_first").agg({"revenue": "sum"}).head()[0]
    assert first == 10.0


def test_revenue_by_device_counts_ties(spark):
    rows = [
        {"t": 0, "name": "purchase", "price": 5.0, "ua": "iPhone"},
        {"t": 0, "ua": "iPhone"},
        {"t": 7, "name": "purchase", "price": 1.0, "ua": "iPhone"},
        {"t": 7, "client": None, "name": "purchase", "price": 3.0, "ua": "Windows"},
    ]
    df = events(spark, rows)
    got = {row["device_type"]: tuple(row)[1:] for row in marts.revenue_by_device(df).collect()}
    assert got == {"mobile": (1, 11.0, 11.0), "desktop": (0, 3.0, None)}
    plain = {row["device_type"]: row["revenue"] for row in marts.revenue_by_device(df, dedup_join=True).collect()}
    assert plain == {"mobile": 6.0, "desktop": 3.0}


def test_conversion_types(spark):
    def kinds(**options):
        df = spark.createDataFrame(
            [(None, None, 1.0), ("direct", "direct", 1.0), ("x", "x", 1.0), ("x", "y", 1.0)],
            "first_utm_source string, last_utm_source string, revenue double",
        )
        return {row["conversion_type"]: row["purchases"] for row in marts.assisted_vs_direct(df, **options).collect()}

    assert kinds() == {"Pure Direct": 2, "Single Channel": 1, "Assisted Conversion": 1}
    assert kinds(literal_direct=False) == {"Pure Direct": 1, "Single Channel": 2, "Assisted Conversion": 1}
