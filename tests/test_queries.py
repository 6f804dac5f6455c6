"""Every registered query against its SQL text, at the smallest scale."""

from __future__ import annotations

import json

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences
from trailmark.plans import steps
from trailmark.plans.registry import all_queries
from trailmark.sources import tables
from trailmark.sources.web_events import web_events, write_daily_files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(all_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["channel", "revenue", "purchases"]


def test_daily_run(spark, tmp_path):
    source, out = str(tmp_path / "daily"), str(tmp_path / "out")
    write_daily_files(web_events(spark, SF), source)
    steps.run_all(spark, source, out, lineage="folder")
    layout = steps.Layout(out)

    lines = [row[0] for row in spark.read.text(layout.path("dq_report.md")).collect()]
    assert lines[0] == "# Incoming Data Quality Report"
    assert sum(line.startswith("- **") for line in lines) == 11
    assert any(line.startswith("- **schema_per_file** → *warn* — {'events_202401") for line in lines)

    events = tables.read_table(spark, layout.cleaned)
    assert events.count() == entry.queries()["dedupe_keep_first"](spark, SF).count()
    attributed = tables.read_table(spark, layout.attribution)
    assert attributed.count() == events.where("event_name = 'purchase'").count()
    mart = spark.read.csv(layout.path("channel_revenue_last_click.csv"), header=True, inferSchema=True)
    expected = entry.queries()["channel_revenue_last_click"](spark, SF)
    assert sorted(map(tuple, mart.collect())) == sorted(map(tuple, expected.collect()))
    report = json.loads(spark.read.text(layout.path("monitoring_report.json")).head()[0])
    assert set(report) == {"date", "alerts", "status"} and report["date"] == "2024-01-30"
