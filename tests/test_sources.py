"""Drifting CSV files, from text files written by hand."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from trailmark.operators import cleaning, quality
from trailmark.sources import csv_drop, tables


@pytest.fixture()
def drop(tmp_path):
    folder = tmp_path / "drop +1%20"
    folder.mkdir()

    def write(name, text):
        (folder / name).write_text(text, encoding="utf-8")

    write(
        "events_20250301.csv",
        'client_id,page_url,referrer,timestamp,event_name,event_data,user_agent\n'
        '1,http://h/?utm_source=s,http://r.com/x,2025-03-01 10:00:00,purchase,"{""price"": 5,\n ""note"": 1}",ua\n'
        'NA,http://h/,null,2025-03-01 10:00:01,page_viewed,,\n',
    )
    write(
        "events_20250302.csv",
        "﻿clientId, Page-URL ,timestamp,Event Name,event_data,userAgent\n"
        "2,http://h/p,2025-03-02 09:00:00, checkout_completed ,\"{'total': 7}\",ua2\n"
        "2,http://h/p,2025-03-02 09:00:00, checkout_completed ,\"{'total': 7}\",ua3\n",
    )
    write("events_20250303.csv", "client_id,page_url,referrer,timestamp,event_name,event_data,user_agent\n")
    return str(folder)


def test_catalog(spark, drop):
    for direct in (True, False):
        catalog = csv_drop.header_catalog(spark, drop, direct=direct)
        columns = {row["source_file"]: row["columns"] for row in catalog.collect()}
        full = ["client_id", "page_url", "referrer", "timestamp", "event_name", "event_data", "user_agent"]
        assert columns == {
            "events_20250301.csv": full,
            "events_20250302.csv": ["clientid", "page-url", "timestamp", "event name", "event_data", "useragent"],
            "events_20250303.csv": full,
        }


def test_union_keeps_columns_in_place(spark, drop):
    rows = csv_drop.read_events(spark, drop).orderBy("row_seq").collect()
    found = {(row["source_file"], row["client_id"], row["page_url"], row["referrer"]) for row in rows}
    assert found == {
        ("events_20250301.csv", "1", "http://h/?utm_source=s", "http://r.com/x"),
        ("events_20250301.csv", None, "http://h/", None),
        ("events_20250302.csv", "2", "http://h/p", None),
    }
    assert len({row["row_seq"] for row in rows}) == len(rows) == 4
    assert {row["source_file"]: row["source_file_referrer_missing"] for row in rows} == {
        "events_20250301.csv": False,
        "events_20250302.csv": True,
    }


def test_clean_from_files(spark, drop):
    rows = cleaning.clean_events(csv_drop.read_events(spark, drop)).orderBy("source_file", "timestamp").collect()
    assert [(r["event_name"], r["price"], r["utm_source"], r["referrer_domain"], r["user_agent"]) for r in rows] == [
        ("purchase", 5.0, "s", "r.com", "ua"),
        ("page_viewed", None, None, None, None),
        ("purchase", 7.0, None, None, "ua2"),
    ]


def test_spellings_of_one_column_are_merged(spark, tmp_path):
    (tmp_path / "e.csv").write_text("Client_ID,clientid,event_name\n,x,n\ny,,n\n")
    rows = csv_drop.read_events(spark, str(tmp_path)).orderBy("row_seq").collect()
    assert [row["client_id"] for row in rows] == ["x", "y"]
    assert rows[0]["user_agent"] is None


def test_nothing_to_read(spark, tmp_path):
    with pytest.raises(AnalysisException):
        csv_drop.read_events(spark, str(tmp_path / "none"))


def test_schema_checks(spark, drop):
    files = csv_drop.file_schemas(csv_drop.header_catalog(spark, drop))
    row = quality.check_schema_per_file(files).head()
    assert (row["status"], row["details"]) == ("warn", "{'events_20250302.csv': ['referrer']}")
    assert quality.check_schema(files).head()["details"] == "missing=[]"
    severe = files.selectExpr("source_file", "filter(columns, c -> c <> 'timestamp') AS columns")
    assert quality.check_schema_per_file(severe).head()["status"] == "fail"
    row = quality.check_schema(severe).head()
    assert (row["status"], row["details"]) == ("fail", "missing=['timestamp']")


def test_header_only_file_fails_the_row_count(spark, drop):
    raw = cleaning.normalize(csv_drop.read_events(spark, drop))
    files = csv_drop.file_schemas(csv_drop.header_catalog(spark, drop)).select("source_file")
    counts = quality.profile(raw)
    row = quality.check_row_counts(counts, files).head()
    assert (row["status"], row["details"]) == ("fail", "[{'source_file': 'events_20250303.csv', 'rows': 0}]")
    assert quality.check_row_counts(counts).head()["status"] == "pass"


def test_sinks(spark, drop, tmp_path):
    events = cleaning.clean_events(csv_drop.read_events(spark, drop))
    tables.write_events(events, str(tmp_path / "c"))
    again = tables.register(spark, str(tmp_path / "c"), "cleaned")
    assert spark.sql("SELECT count(*) FROM cleaned").head()[0] == 3
    assert "PartitionFilters: [isnotnull(dt" in again.where("dt = DATE'2025-03-02'")._jdf.queryExecution().toString()
    tables.write_csv(again.select("client_id", "event_data"), str(tmp_path / "m"))
    assert spark.read.csv(str(tmp_path / "m"), header=True, escape='"', multiLine=True).count() == 3


def test_split_files_equal_whole_ones(spark, tmp_path):
    rows = [f"c{i},http://h/{i},2025-03-01 10:00:00,page_viewed,x" for i in range(3000)]
    head = "client_id,page_url,timestamp,event_name,user_agent\n"
    (tmp_path / "plain.csv").write_text(head + "\n".join(rows) + "\n")
    broken = list(rows)
    for i in range(0, 3000, 7):
        broken[i] = f'c{i},http://h/{i},2025-03-01 10:00:00,page_viewed,"two\nlines ""quoted"" of {i}"'
    (tmp_path / "broken.csv").write_text(head + "\n".join(broken) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        found = csv_drop.read_events(spark, str(tmp_path))
        shown = sorted(map(tuple, found.select("source_file", "client_id", "page_url", "user_agent").collect()))
        assert found.rdd.getNumPartitions() > 10
        assert csv_drop.files_with_broken_records(spark, [f"file:{tmp_path}/plain.csv", f"file:{tmp_path}/broken.csv"]) == {f"file:{tmp_path}/broken.csv".replace("file://", "file:/")}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = csv_drop.read_events(spark, str(tmp_path), multiline=True)
    assert shown == sorted(map(tuple, whole.select("source_file", "client_id", "page_url", "user_agent").collect()))
    assert len(shown) == 6000


def test_long_headers_and_other_endings(spark, tmp_path):
    import bz2

    extra = ",".join(f"column_{i:07d}" for i in range(120_000))
    (tmp_path / "wide.csv").write_text(f"client_id,{extra},event_name\n")
    (tmp_path / "small.csv.bz2").write_bytes(bz2.compress(b"client_id,event_name\nz,purchase\n"))
    catalog = {r["source_file"]: r["columns"] for r in csv_drop.header_catalog(spark, str(tmp_path)).collect()}
    assert len(catalog["wide.csv"]) == 120_002 and catalog["wide.csv"][-1] == "event_name"
    assert catalog["small.csv.bz2"] == ["client_id", "event_name"]
    rows = csv_drop.read_events(spark, str(tmp_path / "small*")).collect()
    assert [(r["client_id"], r["event_name"]) for r in rows] == [("z", "purchase")]


def test_reports_list_every_issue(spark):
    counts = spark.createDataFrame([("f", f"name_{i:03d}", 1) for i in range(150)], "source_file string, event_name string, rows long")
    row = quality.check_taxonomy(counts).head()
    assert row["metric"] == 150 and row["details"].count("name_") == 150


def large(spark, folder, split, **options):
    """Events of a folder, with files beyond ``split`` bytes read by many tasks."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        found = csv_drop.read_events(spark, folder, **options)
        columns = sorted(c for c in found.columns if c != "row_seq")
        return found.select("row_seq", *columns).collect(), found.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [300, 5000])
def test_records_across_splits(spark, tmp_path, end, split):
    import random

    pick = random.Random(split)
    head = ["client_id", "page_url", "timestamp", "event_name", "user_agent"]
    for name in ("a", "b"):
        rows = [head]
        for i in range(150):
            text = pick.choice(["", "x", 'say ""hi""', "two\nlines", 'a ""b""\n\nc', "long\n" * pick.randint(1, 60), "com,ma"])
            quoted = f'"{text}"' if any(c in text for c in '\n",') else text
            rows.append([f"{name}{i}", f"http://h/{i}", "2025-03-01 10:00:00", "page_viewed", quoted])
        # blank lines between records, and no line end behind the last one
        (tmp_path / f"{name}.csv").write_bytes(end.join(",".join(row) + (end if pick.random() < 0.1 else "") for row in rows).encode())
    got, tasks = large(spark, str(tmp_path), split)
    want, _ = large(spark, str(tmp_path), split, multiline=True)
    assert len(got) == 300 and tasks > 4
    assert sorted(tuple(r)[1:] for r in got) == sorted(tuple(r)[1:] for r in want)
    for name in ("a", "b"):  # in the order of the file
        own = sorted((r for r in got if r.source_file == f"{name}.csv"), key=lambda r: r.row_seq)
        assert [r.client_id for r in own] == [f"{name}{i}" for i in range(150)]
    assert len({r.row_seq for r in got}) == 300


def test_large_files_with_unlike_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("client_id,place,event_name\n" + "".join(f'a{i},"x\ny",n\n' for i in range(300)))
    (tmp_path / "b.csv").write_text('"client\nid",event_name,_extra\n' + "".join(f'b{i},"open\n' + "z" * 400 + '",e\n' for i in range(40)))
    (tmp_path / "c.csv").write_text('client_id,event_name\nc0,"never closed\nat all')
    got, _ = large(spark, str(tmp_path), 100)
    want, _ = large(spark, str(tmp_path), 100, multiline=True)
    assert sorted(map(str, (tuple(r)[1:] for r in got if r.source_file != "c.csv"))) == sorted(map(str, (tuple(r)[1:] for r in want if r.source_file != "c.csv")))
    assert len({r.row_seq for r in got}) == len(got) == 341
    assert {r.place for r in got if r.source_file == "a.csv"} == {"x\ny"}


def test_split_size(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for text, size in (("7000", 7000), ("128m", 128 << 20), ("134217728b", 128 << 20), ("1g", 1 << 30), ("2GB", 2 << 30), ("16kb", 16 << 10)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", text)
            assert csv_drop.split_csv.split_size(spark) == size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
