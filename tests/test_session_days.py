from __future__ import annotations

import random

import pytest
from helpers import START, at, events
from pyspark.sql import functions as F

from trailmark.operators import sessions
from trailmark.sources.versioned import VersionedTable, day_of
from trailmark.streaming.session_days import SessionDays

DAY = 86_400


@pytest.fixture()
def store(spark, tmp_path):
    """A table of events by day and the sessions over it; ``put`` replaces the days that some rows fall into or fell into."""
    table = VersionedTable(spark, str(tmp_path / "events"), day_of())
    days = SessionDays(spark, str(tmp_path / "sessions"))
    held = []

    def put(rows, drop=()):
        gone = [row for row in held if row["row_seq"] in drop]
        held[:] = [row for row in held if row["row_seq"] not in drop] + rows
        touched = {("none" if row["t"] is None else str(at(row["t"]).date())) for row in rows + gone}
        now = [row for row in held if ("none" if row["t"] is None else str(at(row["t"]).date())) in touched]
        table.replace(events(spark, now), touched)
        return days.update(table, touched)

    return days, put, held, table


def rows_of(df):
    names = ["client_id", "session_seq", "session_id", "session_start", "session_end", "session_last_utm", "purchases"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=str)


def assert_equals_one_run(spark, days, held):
    assert rows_of(days.sessions()) == rows_of(sessions.sessions(events(spark, held)))


def make(pick, number, low, high):
    client = pick.choice(["a", "a", "b", f"c{pick.randint(0, 6)}", None])
    t = None if pick.random() < 0.05 else pick.choice([pick.uniform(low, high), pick.randint(int(low), int(high))])
    return {"row_seq": number, "t": t, "client": client, "source": pick.choice([None, "x", "y"]), "name": pick.choice(["purchase", "view", "view"])}


def test_day_by_day_equals_all_at_once(spark, store):
    days, put, held, _ = store
    pick, number = random.Random(1), 0
    for day in range(3):
        rows = []
        for _ in range(50):
            # most events around midnight, so that sessions go on over days
            low = pick.choice([day * DAY + DAY / 2 - 1500, day * DAY - DAY / 2, day * DAY])
            rows.append(make(pick, number, low, low + 1500))
            number += 1
        put(rows)
        assert_equals_one_run(spark, days, held)


def test_late_rows_renumber_what_comes_after(spark, store):
    days, put, held, table = store
    put([{"row_seq": n, "t": n * DAY, "client": c} for n, c in enumerate("abab")])
    # between, before and after what is there; joining two sessions; another client is left alone
    late = [
        {"row_seq": 10, "t": 1.5 * DAY, "client": "a"},
        {"row_seq": 11, "t": -3 * DAY, "client": "a"},
        {"row_seq": 12, "t": 2 * DAY + 1700, "client": "a"},
        {"row_seq": 13, "t": 2 * DAY + 3300, "client": "a", "source": "s"},
        {"row_seq": 14, "t": 2 * DAY + 4900, "client": "a", "name": "purchase"},
    ]
    for some in (late[:1], late[1:3], late[3:]):
        changed = put(some)
        assert_equals_one_run(spark, days, held)
        assert {str(at(row["t"]).date()) for row in some} <= set(changed)
    assert days.sessions().where("client_id = 'b'").agg(F.max("session_seq")).first()[0] == 2
    # only the days of the client that was late are written again: none after the last one
    assert put([{"row_seq": 20, "t": 3 * DAY + 60, "client": "b"}]) == [str(at(3 * DAY).date())]
    # the same days once more, and a day taken back
    days.update(table, [str(at(n * DAY).date()) for n in range(4)])
    put([], drop={0, 14})
    assert_equals_one_run(spark, days, held)


def test_undated_events_come_last(spark, store):
    days, put, held, _ = store
    put([{"row_seq": 0, "t": None, "client": "a"}, {"row_seq": 1, "t": None, "client": "a"}, {"row_seq": 2, "t": None, "client": "b"}])
    assert_equals_one_run(spark, days, held)
    put([{"row_seq": 3, "t": 5, "client": "a", "source": "x"}])
    put([{"row_seq": 4, "t": None, "client": "a"}, {"row_seq": 5, "t": DAY, "client": "a"}])
    assert_equals_one_run(spark, days, held)


def test_a_batch_that_dies_between_its_two_tables(spark, store, monkeypatch):
    days, put, held, table = store
    put([{"row_seq": 0, "t": 0, "client": "a"}, {"row_seq": 1, "t": DAY, "client": "b"}])
    with monkeypatch.context() as broken:
        broken.setattr(days.front, "replace", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            put([{"row_seq": 2, "t": DAY, "client": "a"}, {"row_seq": 3, "t": 2 * DAY, "client": "a"}])
    days.update(table, [str(at(n * DAY).date()) for n in (1, 2)])
    assert_equals_one_run(spark, days, held)
    assert START.hour == 12  # days of the tests begin at noon


def test_history_is_not_read(spark, store, monkeypatch):
    days, put, _, table = store
    for day in range(3):
        put([{"row_seq": day, "t": day * DAY, "client": "a"}])
    read, seen = VersionedTable.read, []
    monkeypatch.setattr(VersionedTable, "read", lambda self, parts=None: seen.append((self.root, None if parts is None else sorted(parts))) or read(self, parts))
    put([{"row_seq": 9, "t": 3 * DAY, "client": "a"}])
    assert [parts for root, parts in seen if root == table.root] == [[str(at(3 * DAY).date())]]
