from __future__ import annotations

import pytest

from trailmark.plans import steps
from trailmark.streaming.mart_days import MartDays

HEAD = "client_id,page_url,referrer,timestamp,event_name,event_data,user_agent\n"
MARTS = ("daily_revenue", "channel_revenue_last_click", "channel_revenue_linear", "conversion_rate_by_channel", "revenue_by_device", "top_products")


def day(number, *clients):
    rows = []
    for i, client in enumerate(clients):
        at = f"2025-03-{number:02d} 10:{i:02d}:00"
        rows.append(f"{client},http://h/?utm_source=s{i % 2},,{at},page_viewed,,Windows")
        rows.append(f'{client},http://h/,,{at[:-2]}30,purchase,"{{""total"": {10 * number + i}, ""product_id"": ""p{i}""}}",iPhone')
    return HEAD + "\n".join(rows) + "\n"


def stored(spark, root, name):
    return sorted(map(str, spark.read.csv(f"{root}/{name}.csv", header=True).collect()))


def test_updates_equal_a_full_run(spark, tmp_path, monkeypatch):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "events_20250301.csv").write_text(day(1, "a", "b", "c"))
    (folder / "events_20250302.csv").write_text(day(2, "a", "d"))
    assert steps.update_all(spark, str(folder), root).days == ("2025-03-01", "2025-03-02")
    # a run that dies after the files were taken in: the next one brings the marts up to date, though no file is new
    (folder / "events_20250303.csv").write_text(day(3, "b", "") + day(1, "late").split("\n")[1] + "\n")
    with monkeypatch.context() as broken:
        broken.setattr(MartDays, "update", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            steps.update_all(spark, str(folder), root)
    batch = steps.update_all(spark, str(folder), root)
    assert batch.new == () and batch.days == ("2025-03-01", "2025-03-03")
    assert steps.update_all(spark, str(folder), root).days == ()

    steps.run_all(spark, str(folder), str(tmp_path / "full"))
    for name in MARTS:
        assert stored(spark, root, name) == stored(spark, str(tmp_path / "full"), name), name
    report = [spark.read.json(f"{path}/monitoring_report.json").first() for path in (root, str(tmp_path / "full"))]
    assert report[0] == report[1]
