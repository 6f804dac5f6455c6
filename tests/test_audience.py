from __future__ import annotations

import random
from datetime import timedelta
from math import log2

import pytest
from helpers import START, events

from trailmark.operators import audience, device_mix, sessions

DAY = 86_400
AGENTS = {"desktop": "Windows", "mobile": "iPhone", "tablet": "iPad", "unknown": None}


def test_rolling_users(spark):
    pick = random.Random(2)
    rows = [
        {"t": None if n % 50 == 0 else pick.randint(0, 12) * DAY, "client": pick.choice([None, *"abcdef"]), "ua": pick.choice(list(AGENTS.values()))}
        for n in range(150)
    ]
    want = {}
    device_of = {agent: device for device, agent in AGENTS.items()}
    ends = {row["t"] // DAY for row in rows if row["t"] is not None and row["client"]}
    for row in rows:
        if row["t"] is not None and row["client"]:
            for end in ends:
                for n in (3, 7):
                    if 0 <= end - row["t"] // DAY < n:
                        want.setdefault((START.date() + timedelta(days=end), n, device_of[row["ua"]]), set()).add(row["client"])
    got = {(r.day, r.days, r.device_type): r.users for r in audience.rolling_users(events(spark, rows), (3, 7)).collect()}
    assert got == {key: len(clients) for key, clients in want.items()}
    sketched = audience.rolling_users_approx(audience.daily_sketches(events(spark, rows)), (3, 7)).collect()
    assert {(r.day, r.days, r.device_type): r.users for r in sketched} == got  # few clients are counted exactly


def test_error_of_sketches(spark):
    # 20,000 clients on each of four days, of which half come again on the next day
    base = spark.range(80_000).selectExpr(
        "concat('c', id div 20000 * 10000 + id % 20000) AS client_id", "timestamp'2025-03-01 10:00:00' + make_interval(0, 0, 0, int(id div 20000)) AS timestamp_utc", "'iPhone' AS user_agent"
    )
    exact = {r.day: r.users for r in audience.rolling_users(base, (4,)).collect()}
    found = {r.day: r.users for r in audience.rolling_users_approx(audience.daily_sketches(base), (4,)).collect()}
    assert sorted(exact.values()) == [20_000, 30_000, 40_000, 50_000] and set(found) == set(exact)
    assert all(abs(found[day] / n - 1) < 4 * audience.STANDARD_ERROR for day, n in exact.items())
    assert any(found[day] != n for day, n in exact.items())


def bought(day, device, revenue):
    return {"t": day * DAY, "name": "purchase", "ua": AGENTS[device], "total": float(revenue)}


def drift(spark, rows, **options):
    purchases = events(spark, rows).withColumnRenamed("total", "revenue")
    return {(r.day - START.date()).days: (r.divergence, r.severity) for r in device_mix.mix_drift(device_mix.device_mix(purchases), **options).collect()}


def test_mix_drift(spark):
    week = [bought(day, device, 30 if device == "desktop" else 10) for day in range(7) for device in ("desktop", "mobile") for _ in range(5)]
    same = [bought(7, device, 30 if device == "desktop" else 10) for device in ("desktop", "mobile") for _ in range(5)]
    assert drift(spark, week + same) == {7: (0.0, None)}
    other = [bought(7, "tablet", 1) for _ in range(10)]
    assert drift(spark, week + other) == {7: (1.0, "WARN")}
    # three quarters and a quarter before, now the other way round: no device is new, and shares of one alone look like less
    turned = [bought(7, device, 10 if device == "desktop" else 30) for device in ("desktop", "mobile") for _ in range(5)]
    expected = 0.75 * log2(0.75 / 0.5) + 0.25 * log2(0.25 / 0.5)
    assert drift(spark, week + turned) == {7: (pytest.approx(expected, abs=1e-6), "WARN")}
    assert drift(spark, week + turned[:1]) == {7: (pytest.approx(0.137925, abs=1e-6), "INFO")}
    assert drift(spark, week + [bought(7, "desktop", 0)] * 12) == {}
    assert drift(spark, week) == {} and drift(spark, week[:1]) == {}


def test_a_crowded_second_is_numbered_in_parts(spark):
    pick = random.Random(4)
    rows = [{"row_seq": n << 14, "t": 100 + pick.choice([0, 0, 0, 0.25, 0.999999, 5, 4000]), "client": pick.choice("aab")} for n in range(300)]
    df = events(spark, rows)
    whole = sorted(tuple(r) for r in sessions.session_sequence(df).select("row_seq", "session_seq", "position").collect())
    for crowd in (0, 10, 100):
        assert sorted(tuple(r) for r in sessions.session_sequence(df, crowd=crowd).select("row_seq", "session_seq", "position").collect()) == whole
