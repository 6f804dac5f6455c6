from __future__ import annotations

import random

from helpers import events

from trailmark.operators import attribution
from trailmark.streaming.attribution_stream import attribute_stream

DAY = 86_400
NAMES = ["row_seq", "client_id", "revenue", *[f"{which}_utm_{part}" for which in ("first", "last") for part in ("source", "medium", "campaign")]]


def test_purchases_leave_once_and_equal_the_batch(spark, tmp_path):
    pick = random.Random(6)
    rows = []
    for n in range(160):
        t = round(pick.choice([n * 0.2 * DAY + pick.uniform(0, 0.05 * DAY), (n // 8) * 1.6 * DAY]), 6)
        rows.append({
            "row_seq": n, "t": t, "client": pick.choice(["hot", "hot", "a", "b", None]), "name": pick.choice(["purchase", "view", "view"]),
            "source": pick.choice([None, "x", "y"]), "medium": pick.choice([None, "m"]), "total": float(n),
        })
    # the ends of the look-back
    rows += [{"row_seq": 200, "t": 40 * DAY, "client": "edge", "source": "s"}, {"row_seq": 201, "t": 47 * DAY, "client": "edge", "name": "purchase", "total": 1.0}]
    rows += [{"row_seq": 202, "t": 47 * DAY + 1e-6, "client": "edge", "name": "purchase", "total": 2.0}]
    df = events(spark, rows)
    want = {tuple(r) for r in attribution.purchase_attribution(df).where("client_id IS NOT NULL").select(NAMES).collect()}

    path, seen = str(tmp_path / "in"), []
    for low, high in ((0, 70), (70, 130), (130, 300)):
        spark.createDataFrame(df.where(f"row_seq >= {low} AND row_seq < {high}").collect(), df.schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(df.schema).parquet(path)
        query = attribute_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), delay="2 days")
        query.awaitTermination()
        state = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        seen.append(state)
    # something late enough that all purchases before it leave, in two more runs
    for t in (80, 90):
        spark.createDataFrame(events(spark, [{"row_seq": 500 + t, "t": t * DAY, "client": "z", "source": "s"}]).collect(), df.schema).coalesce(1).write.mode("append").parquet(path)
        query = attribute_stream(spark.readStream.schema(df.schema).parquet(path), str(tmp_path / "out"), str(tmp_path / "checkpoint"), delay="2 days")
        query.awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select(NAMES).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # what is left are touches and timers of the last days
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < max(seen)
