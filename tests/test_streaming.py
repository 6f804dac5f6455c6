from __future__ import annotations

from pyspark.sql import functions as F

from trailmark.operators import attribution, cleaning, sessions
from trailmark.sources import tables
from trailmark.sources.web_events import web_events
from trailmark.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_streams_agree_with_the_batch_run(spark, tmp_path):
    raw = web_events(spark, SF).drop("copy_no").where("timestamp <> 'not a time'")
    raw.repartitionByRange(3, "source_file").sortWithinPartitions("source_file", "row_seq").write.parquet(
        str(tmp_path / "in")
    )
    arriving = incremental.arriving_events(spark, str(tmp_path / "in"))
    cleaned = incremental.clean_stream(arriving, delay="40 days")
    incremental.write_stream(cleaned, str(tmp_path / "clean"), str(tmp_path / "cp1")).awaitTermination()
    batch = cleaning.clean_events(raw)
    stored = tables.read_table(spark, str(tmp_path / "clean"))
    keys = ["row_seq", "client_id", "price", "quantity", "total", "utm_source", "referrer_domain"]
    assert sorted(map(tuple, stored.select(keys).collect()), key=str) == sorted(map(tuple, batch.select(keys).collect()), key=str)

    # the stream emits a session once the watermark has passed it, so the last ones stay open
    live = spark.readStream.schema(stored.schema).parquet(str(tmp_path / "clean"))
    found = incremental.session_stream(live)
    incremental.write_stream(found, str(tmp_path / "sess"), str(tmp_path / "cp2")).awaitTermination()
    closed = tables.read_table(spark, str(tmp_path / "sess"))
    names = ["client_id", "session_start", "session_end", "session_last_utm", "purchases"]
    got = {tuple(row) for row in closed.select(names).collect()}
    everything = {tuple(row) for row in sessions.sessions(stored).select(names).collect()}
    newest = max(row[2] for row in everything)
    assert got <= everything and closed.count() == len(got)
    open_ones = everything - got
    assert open_ones and all((newest - row[2]).total_seconds() < 2 * 3600 for row in open_ones)


def test_undated_rows_of_the_stream(spark, tmp_path):
    raw = web_events(spark, SF).drop("copy_no")
    raw.where("timestamp = 'not a time'").write.parquet(str(tmp_path / "in"))
    found = incremental.undated_stream(incremental.arriving_events(spark, str(tmp_path / "in")))
    incremental.write_stream(found, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert tables.read_table(spark, str(tmp_path / "out")).count() == raw.where("timestamp = 'not a time'").count()


def test_batches_with_late_and_undated_rows_equal_one_run(spark, tmp_path):
    events = cleaning.clean_events(web_events(spark, SF)).drop("copy_no")
    path = str(tmp_path / "days")
    # every batch has rows of many days, late ones and undated ones; the last batch comes twice
    for batch in (0, 1, 2, 2):
        incremental.update_days(events.where(f"pmod(hash(row_seq), 3) = {batch}"), path)
    stored = tables.read_table(spark, path)
    assert stored.drop("event_data_parsed").count() == events.count()
    assert {r[0] for r in stored.select("row_seq").collect()} == {r[0] for r in events.select("row_seq").collect()}

    names = ["row_seq", "first_utm_source", "last_utm_source"]
    wanted = "dt IS NULL OR dt BETWEEN DATE'2024-01-20' AND DATE'2024-01-22'"
    some = incremental.attribute_days(spark, path, "2024-01-20", "2024-01-22").select(names)
    full = attribution.purchase_attribution(stored).where(wanted).select(names)
    assert sorted(map(tuple, some.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)

    seen = []
    stream = spark.readStream.schema(stored.schema).parquet(path)
    work = lambda df, _: seen.append(df.agg(F.count("*")).head()[0])
    incremental.per_batch(stream, work, str(tmp_path / "cp")).awaitTermination()
    assert sum(seen) == events.count()
