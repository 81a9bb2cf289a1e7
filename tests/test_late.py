"""Late and repeated events of a stream."""

from __future__ import annotations

import datetime

from orderlens.streaming.late import LateGate


def test_repeats_and_late_events(spark, tmp_path):
    schema = "event_id long, ts timestamp, note string"

    def at(hour):
        return datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hour)

    empty = spark.createDataFrame([], schema)
    root = str(tmp_path / "root")
    gate = LateGate(spark, root, empty.schema, ["event_id"], "ts", "10 hours")
    empty.write.parquet(f"{root}/landing")
    source = spark.readStream.schema(empty.schema).parquet(f"{root}/landing")
    deliveries = [
        [(1, at(0), "a"), (1, at(0), "a"), (2, at(50), "b")],
        [(3, at(45), "in time"), (4, at(30), "late"), (4, at(30), "late"), (2, at(50), "again"), (1, at(0), "again"), (5, at(90), "c")],
        [(6, at(60), "late now")],
    ]
    for rows in deliveries:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/landing")
        gate.run(source)
    assert sorted(r.event_id for r in gate.accepted().collect()) == [1, 2, 3, 5]
    assert sorted(r.event_id for r in gate.late().collect()) == [4, 6]
    gate.run(source)
    assert gate.accepted().count() == 4
