from __future__ import annotations

import pytest

from trailmark.operators import attribution, cleaning, marts, monitoring, multi_touch, sessions
from trailmark.sources.versioned import VersionedTable, day_of
from trailmark.sources.web_events import web_events
from trailmark.streaming.mart_days import MartDays
from trailmark.streaming.session_days import SessionDays

SF = "/root/testdata/sf0.001"


def full_run(events):
    """Marts and monitors of all events at once."""
    bought = attribution.purchase_attribution(events, "price_first")
    half_life = multi_touch.HALF_LIFE_DAYS
    return {
        "daily_revenue": marts.daily_revenue(bought),
        "channel_revenue_last_click": marts.channel_revenue(bought, "last"),
        "channel_revenue_first_click": marts.channel_revenue(bought, "first"),
        "channel_revenue_linear": multi_touch.channel_credit(multi_touch.credits(events, None, "price_first")),
        "channel_revenue_time_decay": multi_touch.channel_credit(multi_touch.credits(events, half_life, "price_first")),
        "conversion_rate_by_channel": marts.conversion_by_channel(events),
        "revenue_by_device": marts.revenue_by_device(events),
        "assisted_vs_direct": marts.assisted_vs_direct(bought),
        "top_products": marts.top_products(bought),
        "monitors": monitoring.monitors(events, attribution.purchase_attribution(events, "total")),
    }


@pytest.fixture(scope="module")
def events(spark):
    return cleaning.clean_events(web_events(spark, SF)).drop("copy_no").cache()


def test_four_batches_equal_one_run(spark, tmp_path_factory, events):
    root = str(tmp_path_factory.mktemp("days"))
    table = VersionedTable(spark, f"{root}/events", day_of())
    found = SessionDays(spark, f"{root}/sessions")
    days = MartDays(spark, f"{root}/marts", table, found)
    batches = [
        "timestamp_utc < '2024-01-12' AND pmod(row_seq, 5) > 0",
        "timestamp_utc < '2024-01-18' OR timestamp_utc IS NULL",  # with late rows of the days before
        "timestamp_utc < '2024-01-31' OR timestamp_utc IS NULL",
        "timestamp_utc < '2024-01-31' OR timestamp_utc IS NULL",
    ]
    held = None
    for number, batch in enumerate(batches):
        rows = events.where(batch)
        fresh = rows if held is None else rows.join(held.select("row_seq"), "row_seq", "left_anti")
        touched = sorted(r[0] for r in (rows if number == 3 else fresh).select(day_of()).distinct().collect())
        touched = touched[-3:] if number == 3 else touched  # the last batch once more
        table.replace(rows.where(day_of().isin(touched)), touched)
        found.update(table, touched)
        redone = days.update(touched)
        assert set(touched) <= set(redone) and (number < 3 or redone == touched)
        held = rows
    assert "none" in table.parts() and "none" in days.sums.parts()
    want = full_run(table.read())
    got = {**days.marts(), "monitors": days.monitors()}
    assert set(got) == set(want)
    for name, mart in want.items():
        assert [tuple(r) for r in got[name].select(mart.columns).collect()] == [tuple(r) for r in mart.collect()], name
    rows = [{row["client_id"], row["session_id"]} for row in found.sessions().collect()]
    assert len(rows) == sessions.sessions(table.read()).count()
    report, whole = days.report().first(), monitoring.report(want["monitors"], monitoring.anchor_date(table.read())).first()
    assert report == whole

    # a day that goes: its purchases go, and those that looked back on it change
    table.replace(events.limit(0), ["2024-01-20"])
    found.update(table, ["2024-01-20"])
    assert days.update(["2024-01-20"]) == [f"2024-01-{n}" for n in range(20, 28)]
    want = full_run(table.read())
    for name in ("channel_revenue_last_click", "channel_revenue_time_decay", "conversion_rate_by_channel"):
        assert [tuple(r) for r in days.marts()[name].select(want[name].columns).collect()] == [tuple(r) for r in want[name].collect()], name


def test_touches_are_searched_once_a_batch(spark, tmp_path, events, monkeypatch):
    calls, search = [], multi_touch.channel_weights
    monkeypatch.setattr(multi_touch, "channel_weights", lambda *args: calls.append(args) or search(*args))
    table = VersionedTable(spark, f"{tmp_path}/events", day_of())
    days = MartDays(spark, f"{tmp_path}/marts", table, SessionDays(spark, f"{tmp_path}/sessions"))
    some = ["2024-01-03", "2024-01-04"]
    table.replace(events.where(day_of().isin(some)), some)
    days.update(some)
    assert len(calls) == 1
    for model, half_life in (("linear", None), ("time_decay", multi_touch.HALF_LIFE_DAYS)):
        want = multi_touch.channel_credit(multi_touch.credits(table.read(), half_life, "price_first"))
        assert days._credited(model).select(want.columns).collect() == want.collect()
