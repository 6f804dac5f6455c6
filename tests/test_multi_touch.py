from __future__ import annotations

import random

import pytest
from helpers import events

from trailmark.operators import multi_touch

DAY = 86_400


def brute(rows, half_life, reach=7 * DAY):
    """Shares by (purchase, channel), touch by touch."""
    found = {}
    for p in (row for row in rows if row["name"] == "purchase"):
        weights = {}
        for t in rows:
            if p["client"] and t["client"] == p["client"] and t["source"] is not None and None not in (p["t"], t["t"]):
                age = round(p["t"] - t["t"], 6)
                if 0 <= age <= reach:
                    n, w = weights.get(t["source"], (0, 0.0))
                    weights[t["source"]] = (n + 1, w + (1 if half_life is None else 2 ** (-age / (half_life * DAY))))
        total = sum(w for _, w in weights.values())
        for channel, (n, w) in weights.items():
            found[p["row_seq"], channel] = (n, w / total)
        if not weights:
            found[p["row_seq"], "direct"] = (0, 1.0)
    return found


def shares(df, half_life, **options):
    return {(r.row_seq, r.channel): (r.touches, r.share) for r in multi_touch.credits(df, half_life, **options).collect()}


def assert_same(got, want):
    assert set(got) == set(want)
    for key, (n, share) in want.items():
        assert got[key][0] == n and got[key][1] == pytest.approx(share, rel=1e-12)


@pytest.mark.parametrize("half_life", [None, 7.0, 0.01])
@pytest.mark.parametrize("slice_seconds", [60, 3600, 7 * DAY])
def test_equals_pairs(spark, half_life, slice_seconds):
    pick = random.Random(7)
    rows = []
    for number in range(700):
        near = pick.choice([0, 7 * DAY, 14 * DAY, -7 * DAY])  # ends of look-backs and of blocks
        t = pick.choice([near, near + pick.choice([-1, 1]) * 1e-6, pick.randint(-20 * DAY, 20 * DAY), pick.uniform(0, 3 * DAY)])
        client = pick.choice(["a", "a", "a", "b", None, f"c{number % 9}"])
        row = {"row_seq": number, "t": None if number % 41 == 0 else round(t, 6), "client": client}
        row |= {"name": pick.choice(["purchase", "page_viewed"]), "source": pick.choice([None, "x", "y", "direct", ""] if number % 3 else [None])}
        rows.append(row)
    assert_same(shares(events(spark, rows), half_life, slice_seconds=slice_seconds), brute(rows, half_life))


def test_ends_of_the_look_back(spark):
    rows = [
        {"row_seq": 0, "t": 0, "client": "a", "source": "edge", "name": "page_viewed"},
        {"row_seq": 1, "t": 7 * DAY, "client": "a", "source": "own", "name": "purchase"},
        {"row_seq": 2, "t": 0, "client": "b", "source": "late", "name": "page_viewed"},
        {"row_seq": 3, "t": 7 * DAY + 1e-6, "client": "b", "source": None, "name": "purchase"},
        {"row_seq": 4, "t": 8 * DAY, "client": "b", "source": "after", "name": "page_viewed"},
    ]
    assert shares(events(spark, rows), None) == {(1, "edge"): (1, 0.5), (1, "own"): (1, 0.5), (3, "direct"): (0, 1.0)}
    decayed = shares(events(spark, rows), 7.0)
    assert decayed[1, "edge"][1] == pytest.approx(1 / 3) and decayed[1, "own"][1] == pytest.approx(2 / 3)


@pytest.mark.parametrize("half_life", [None, 1.5])
def test_revenue_is_kept(spark, half_life):
    pick = random.Random(3)
    rows = [
        {"t": pick.randint(0, 30 * DAY), "client": pick.choice(["a", "b", None]), "name": pick.choice(["purchase", "view"]), "source": pick.choice("pqr"), "total": pick.randint(1, 999) / 7}
        for _ in range(400)
    ]
    credited = multi_touch.credits(events(spark, rows), half_life).collect()
    spent = sum(row["total"] for row in rows if row["name"] == "purchase")
    assert sum(r.revenue for r in credited) == pytest.approx(spent, rel=1e-12)
    by_purchase = {}
    for r in credited:
        by_purchase[r.row_seq] = by_purchase.get(r.row_seq, 0) + r.share
    assert len(by_purchase) == sum(row["name"] == "purchase" for row in rows)
    assert all(total == pytest.approx(1, rel=1e-12) for total in by_purchase.values())
    mart = multi_touch.channel_credit(multi_touch.credits(events(spark, rows), half_life)).collect()
    assert sum(r.revenue for r in mart) == pytest.approx(spent, abs=0.05) and sum(r.purchases for r in mart) == pytest.approx(len(by_purchase), abs=1e-3)


def test_old_history_neither_overflows_nor_blurs(spark):
    # thirty years of touches before the purchase, with a half-life of a quarter of an hour
    rows = [{"row_seq": n, "t": -n * 30 * DAY, "client": "a", "source": "old", "name": "view"} for n in range(1, 365)]
    rows += [{"row_seq": 1000, "t": 0, "client": "a", "source": "x", "name": "view"}, {"row_seq": 1001, "t": 900, "client": "a", "source": "y", "name": "view"}]
    rows += [{"row_seq": 1002, "t": 900, "client": "a", "source": None, "name": "purchase"}]
    assert shares(events(spark, rows), 900 / DAY) == {(1002, "x"): (1, pytest.approx(1 / 3)), (1002, "y"): (1, pytest.approx(2 / 3))}
    with pytest.raises(ValueError, match="half-life"):
        multi_touch.channel_weights(events(spark, rows), 0.001)


def test_a_client_with_a_third_of_all_touches_is_split(spark):
    # 9,000 touches of one client within a day: no window partition holds more than the slices or the microseconds of one slice
    rows = [{"t": n * 9.6, "client": "hot", "source": "s", "name": "view"} for n in range(9000)]
    rows += [{"t": DAY, "client": "hot", "name": "purchase", "total": 1.0}]
    df = events(spark, rows)
    assert shares(df, None) == {(9000, "s"): (9000, 1.0)}
    touches = multi_touch._touches(df)
    reach, width = 7 * DAY * 10**6, 60 * 10**6
    sizes = touches.withColumns(multi_touch._placed_in(touches["us"], reach, width)).groupBy("block", "slice").count()
    assert max(r["count"] for r in sizes.collect()) <= 7 and sizes.count() <= 1441


def test_both_models_of_one_pass(spark):
    pick = random.Random(11)
    rows = [
        {
            "row_seq": n, "t": None if n % 37 == 0 else pick.uniform(0, 20 * DAY), "client": pick.choice(["a", "b", None]),
            "source": pick.choice([None, "x", "y", ""]), "name": pick.choice(["purchase", "page_viewed"]),
        }
        for n in range(300)
    ]
    df = events(spark, rows)
    both = multi_touch.credits_of_both(df, 2.0).collect()
    for half_life, prefix in ((None, "linear_"), (2.0, "")):
        want = {(r.row_seq, r.channel): (r.touches, r.share, r.revenue) for r in multi_touch.credits(df, half_life).collect()}
        assert {(r.row_seq, r.channel): (r.touches, r[f"{prefix}share"], r[f"{prefix}revenue"]) for r in both} == want
