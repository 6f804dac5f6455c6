from __future__ import annotations

import random

from helpers import at, events
from pyspark.sql import functions as F

from trailmark.operators import marts, sessions


def brute_sessions(rows, gap=1800):
    """Session number per row_seq, event by event in time order."""
    result = {}
    by_client = {}
    for row in rows:
        if row["client"] is not None:
            by_client.setdefault(row["client"], []).append(row)
    for client, mine in by_client.items():
        mine.sort(key=lambda r: (r["t"] is None, r["t"] or 0, r["row_seq"]))
        number, previous, first = 0, None, True
        for row in mine:
            new = first or previous is None
            if not new and row["t"] is not None:
                new = int(row["t"] // 1) - int(previous // 1) > gap
            number += new
            result[row["row_seq"]] = (client, number)
            previous, first = row["t"], False
    return result


def test_gap_is_counted_in_second_boundaries(spark):
    rows = [{"t": 0.0}, {"t": 1800.0}, {"t": 3601.0}, {"t": 3601.9}, {"t": 5402.1}]
    got = sessions.session_events(events(spark, rows)).orderBy("row_seq").collect()
    # 1800 s: same; 1801 s: new; 3601.9 -> 5402.1 is 1800.2 s but 1801 boundaries: new
    assert [row["session_seq"] for row in got] == [1, 1, 2, 2, 3]


def test_undated_events(spark):
    rows = [{"t": 0}, {"t": None}, {"t": None}, {"t": 10}, {"t": None, "client": "b"}, {"t": None, "client": "b"}]
    df = events(spark, rows)
    got = {row["row_seq"]: row["session_seq"] for row in sessions.session_events(df).collect()}
    assert got == {0: 1, 3: 1, 1: 1, 2: 2, 4: 1, 5: 2}
    by_session = {
        (row["client_id"], row["session_seq"]): row["session_start"] is None for row in sessions.sessions(df).collect()
    }
    assert by_session == {("a", 1): False, ("a", 2): True, ("b", 1): True, ("b", 2): True}
    counts = {row["client_id"]: row["session_count"] for row in sessions.users(df).collect()}
    assert counts == {"a": 2, "b": 2}


def _random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for position in range(600):
        # client "hot" has a third of the rows, many of them at the same second
        client = "hot" if position % 3 == 0 else rng.choice(["a", "b", "c", None])
        moment = None if rng.random() < 0.05 else round(rng.choice([rng.uniform(0, 90_000), rng.uniform(0, 30), 77.0]), 3)
        rows.append(
            {
                "row_seq": position,
                "client": client,
                "t": moment,
                "name": rng.choice(["purchase", "page_viewed", None]),
                "source": rng.choice([None, None, "x", "y"]),
                "url": f"/{position}",
            }
        )
    return rows


def test_against_event_by_event(spark):
    rows = _random_rows(1)
    df = events(spark, rows)
    expected = brute_sessions(rows)
    got = {r["row_seq"]: (r["client_id"], r["session_seq"]) for r in sessions.session_events(df).collect()}
    assert got == expected
    members = {}
    for row in rows:
        if row["row_seq"] in expected:
            members.setdefault(expected[row["row_seq"]], []).append(row)
    found = {(r["client_id"], r["session_seq"]): r for r in sessions.sessions(df).collect()}
    assert set(found) == set(members)
    for key, mine in members.items():
        dated = sorted((r for r in mine if r["t"] is not None), key=lambda r: (r["t"], r["row_seq"]))
        touches = [r["source"] for r in dated if r["source"]]
        assert found[key]["session_last_utm"] == (touches[-1] if touches else None)
        assert found[key]["purchases"] == sum(r["name"] == "purchase" for r in dated)
        if dated:
            assert found[key]["session_duration_seconds"] == int(dated[-1]["t"] // 1) - int(dated[0]["t"] // 1)


def test_sequence_positions(spark):
    rows = _random_rows(2)
    rows += [{"row_seq": 1000 + i, "client": "long", "t": i * 3.0, "name": None, "source": None, "url": "/"} for i in range(12_000)]
    members = {}
    key = {row["row_seq"]: (row["t"] is None, row["t"] or 0, row["row_seq"]) for row in rows}
    for row_seq, session in brute_sessions(rows).items():
        members.setdefault(session, []).append(row_seq)
    expected = {
        row_seq: (*session, place) for session, mine in members.items() for place, row_seq in enumerate(sorted(mine, key=key.get), 1)
    }
    found = sessions.session_sequence(events(spark, rows)).collect()
    assert {r["row_seq"]: (r["client_id"], r["session_seq"], r["position"]) for r in found} == expected


def test_sessions_over_days_run_no_job_and_scan_once(spark):
    rows = [{"row_seq": i, "client": "d", "t": 86_400.0 * (i // 3) + 43_200 + (i % 3 - 1) * 900} for i in range(30)]  # across midnight
    rows += [{"row_seq": 100 + i, "client": "e", "t": i * 1500.0} for i in range(400)]  # one session over a week
    df = events(spark, rows)
    got = {r["row_seq"]: (r["client_id"], r["session_seq"]) for r in sessions.session_events(df).collect()}
    assert got == brute_sessions(rows)
    bounds = {(r["client_id"], r["session_seq"]): r["session_duration_seconds"] for r in sessions.sessions(df).collect()}
    assert bounds[("e", 1)] == 399 * 1500 and len(bounds) == 11
    found = sessions.sessions(df)
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_session_window_agrees(spark):
    rows = [row for row in _random_rows(3) if row["t"] is not None and row["client"]]
    df = events(spark, rows)
    windows = df.groupBy("client_id", F.session_window(F.date_trunc("second", "timestamp_utc"), "1800 seconds")).count()
    assert windows.count() == sessions.sessions(df).count()


def test_many_undated_run_over_slices(spark, monkeypatch):
    monkeypatch.setattr(sessions, "_SLICE_BITS", 3)
    monkeypatch.setattr(sessions, "_SLICE", 8)
    rows = [{"row_seq": i, "client": "h", "t": 5.0 if i == 7 else None} for i in range(40)]
    df = events(spark, rows)
    got = {r["row_seq"]: r["session_seq"] for r in sessions.session_events(df).collect()}
    assert got == {row_seq: number for row_seq, (_, number) in brute_sessions(rows).items()}
    assert sorted(r["session_seq"] for r in sessions.sessions(df).collect()) == list(range(1, 40))


def test_users_and_agents(spark):
    rows = [{"t": 0, "ua": "x"}, {"t": 5, "ua": "y"}, {"t": 9, "ua": "x"}, {"t": 1, "client": "b"}]
    df = events(spark, rows)
    got = {row["client_id"]: row for row in sessions.users(df).collect()}
    assert got["a"]["n_user_agents"] == 2 and got["b"]["n_user_agents"] == 0
    assert got["a"]["first_seen"].timestamp() == at(0).timestamp()
    assert sessions.user_agents(df).count() == 2


def test_purchases_outside_sessions_count_as_direct(spark):
    rows = [
        {"t": 0, "source": "x"},
        {"t": 5, "name": "purchase"},
        {"t": 0, "client": "b"},
        {"t": 3, "client": None, "name": "purchase"},
        {"t": None, "name": "purchase"},
    ]
    df = events(spark, rows)
    got = {row["channel"]: tuple(row)[1:] for row in marts.conversion_by_channel(df).collect()}
    assert got == {"x": (1, 1, 1.0), "direct": (2, 1, 2.0)}
    placed = {row["row_seq"]: row["session_seq"] for row in sessions.purchase_sessions(df).collect()}
    assert placed == {1: 1, 3: None, 4: None}
