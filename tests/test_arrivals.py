from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from trailmark.operators import cleaning
from trailmark.sources import csv_drop
from trailmark.sources.versioned import VersionedTable
from trailmark.streaming.arrivals import Drop, arriving_drop

FULL = "client_id,page_url,referrer,timestamp,event_name,event_data,user_agent\n"
SHORT = "clientId,Page-URL,timestamp,Event Name,event_data,userAgent\n"
COLUMNS = ["source_file", "client_id", "page_url", "referrer", "event_name", "timestamp_utc", "total", "user_agent", "source_file_referrer_missing"]


def full(day, *clients, hour=10):
    return FULL + "".join(f'{c},http://h/{c}?utm_source=s,http://r.com,2025-03-0{day} {hour}:00:0{i},purchase,"{{""total"":\n {i}}}",ua\n' for i, c in enumerate(clients))


def short(day, *clients):
    return SHORT + "".join(f"{c},http://h/{c},2025-03-0{day} 11:00:00,checkout_completed,,ua\n" for c in clients)


@pytest.fixture()
def drop(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def write(name, text, age=0):
        (folder / name).write_text(text)
        stamp = 1_700_000_000 + age
        os.utime(folder / name, (stamp, stamp))

    return Drop(spark, str(tmp_path / "state")), str(folder), write


def rows(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def assert_equals_one_run(spark, drop, folder):
    assert rows(drop.events.read()) == rows(cleaning.clean_events(csv_drop.read_events(spark, folder)))
    whole = csv_drop.file_schemas(csv_drop.header_catalog(spark, folder))
    assert sorted(map(str, drop.file_schemas().collect())) == sorted(map(str, whole.collect()))


def names(paths):
    return [os.path.basename(p) for p in paths]


def test_three_drops_and_a_replaced_file(spark, drop):
    state, folder, write = drop
    write("events_20250301.csv", full(1, "a", "b", "b"))
    write("events_20250302.csv", short(2, "c", "c"))
    first = state.arrive(folder)
    assert names(first.new) == ["events_20250301.csv", "events_20250302.csv"] and first.days == ("2025-03-01", "2025-03-02")
    assert_equals_one_run(spark, state, folder)

    write("events_20250303.csv", full(3, "d") + "e,http://h/late,,2025-03-01 23:00:00,page_viewed,,ua\nf,u,,no time,page_viewed,,ua\n")
    second = state.arrive(folder)
    assert second.days == ("2025-03-01", "2025-03-03", "none") and not second.changed
    assert_equals_one_run(spark, state, folder)

    # the same length and another time; its rows are on another day now, and fewer
    write("events_20250301.csv", full(4, "x", "y", "z"), age=60)
    write("events_20250304.csv", FULL)
    third = state.arrive(folder)
    assert names(third.changed) == ["events_20250301.csv"] and names(third.new) == ["events_20250304.csv"]
    assert third.days == ("2025-03-01", "2025-03-04")
    assert_equals_one_run(spark, state, folder)
    assert state.arrive(folder).days == () == state.arrive(folder).new

    os.remove(f"{folder}/events_20250302.csv")
    write("events_20250304.csv", short(5, "only"), age=90)
    fourth = state.arrive(folder)
    assert names(fourth.gone) == ["events_20250302.csv"] and fourth.days == ("2025-03-02", "2025-03-05")
    assert_equals_one_run(spark, state, folder)
    assert state.arrive(folder).gone == ()


def test_only_new_headers_are_read(spark, drop, monkeypatch):
    state, folder, write = drop
    write("events_20250301.csv", full(1, "a"))
    state.arrive(folder)
    seen = []
    peek = csv_drop._peek
    monkeypatch.setattr(csv_drop, "_peek", lambda files: seen.extend(names(r["path"] for r in files.collect())) or peek(files))
    write("events_20250302.csv", full(2, "b"))
    state.arrive(folder)
    assert seen == ["events_20250302.csv"]


def test_a_batch_that_dies_is_done_again(spark, drop, monkeypatch):
    state, folder, write = drop
    write("events_20250301.csv", full(1, "a"))
    write("events_20250302.csv", full(2, "b"))
    state.arrive(folder)
    os.remove(f"{folder}/events_20250302.csv")
    write("events_20250301.csv", full(3, "a", "c"), age=60)
    with monkeypatch.context() as broken:  # after the days are replaced, before the ledger is closed
        replace = VersionedTable.replace

        def die(table, *args):
            replace(table, *args)
            raise RuntimeError("lost")

        broken.setattr(VersionedTable, "replace", die)
        with pytest.raises(RuntimeError, match="lost"):
            state.arrive(folder)
    write("events_20250301.csv", full(4, "a"), age=120)
    again = state.arrive(folder)
    assert again.days == ("2025-03-01", "2025-03-02", "2025-03-03", "2025-03-04") and names(again.gone) == ["events_20250302.csv"]
    assert_equals_one_run(spark, state, folder)
    assert state.events.parts() == ["2025-03-04"]


def test_part_files_of_a_folder_are_one_source(spark, tmp_path):
    folder = tmp_path / "in"
    for day in (1, 2):
        (folder / f"source_file=day{day}").mkdir(parents=True)
        (folder / f"source_file=day{day}" / "part-0.csv").write_text(full(day, "a"))
    state = Drop(spark, str(tmp_path / "state"), lineage="folder")
    state.arrive(str(folder))
    (folder / "source_file=day2" / "part-1.csv").write_text(full(2, "a", "b"))  # with a copy of a row of the other part
    batch = state.arrive(str(folder))
    assert batch.days == ("2025-03-02",) and names(batch.new) == ["part-1.csv"]
    whole = cleaning.clean_events(csv_drop.read_events(spark, str(folder), "folder"))
    assert rows(state.events.read()) == rows(whole)


def test_as_a_stream(spark, drop, tmp_path):
    state, folder, write = drop
    days = []
    for name, text in (("events_20250301.csv", full(1, "a")), ("events_20250302.csv", short(2, "b"))):
        write(name, text)
        arriving_drop(state, folder, str(tmp_path / "checkpoint"), lambda batch: days.append(batch.days)).awaitTermination()
        assert_equals_one_run(spark, state, folder)
    assert days == [("2025-03-01",), ("2025-03-02",)]


def test_parts_are_replaced_together(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), F.col("day"))
    assert table.read() is None and table.parts() == []
    table.replace(spark.createDataFrame([("a", 1), ("b", 2)], "day string, n int"), ["a", "b"])
    with pytest.raises(ValueError, match="not named"):
        table.replace(spark.createDataFrame([("c", 1)], "day string, n int"), ["a"])
    with monkeypatch.context() as broken:
        broken.setattr("trailmark.sources.versioned.append_log", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.replace(spark.createDataFrame([("a", 9), ("b", 9)], "day string, n int"), ["a", "b"])
    assert sorted(map(tuple, table.read().collect())) == [("a", 1), ("b", 2)]
    table.replace(spark.createDataFrame([("b", 3)], "day string, n int"), ["a", "b"])
    assert [tuple(r) for r in table.read().collect()] == [("b", 3)] and table.read(["a"]) is None
