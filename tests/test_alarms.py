"""Alarms over several micro-batches, with gaps, late points and runs that end in silence."""

from __future__ import annotations

import time

from feedmill.operators.metrics import FAILED, FINAL_SCORE
from feedmill.streaming import alarms, streams


def test_alarms_over_batches(spark, tmp_path):
    schema = "ts timestamp, metric string, value double"

    def at(minute, value, metric=FINAL_SCORE):
        return f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:30", metric, float(value)

    loads = [
        # Two low windows, a gap, two low windows: no alarm. One window with three failures.
        [at(0, 50), at(5, 50), at(15, 60), at(20, 60), at(1, 1, FAILED), at(2, 1, FAILED), at(4, 1, FAILED)],
        # The run goes on over the border of the load: alarm at 25; a high point in the same window keeps the average low.
        [at(25, 10), at(26, 100), at(30, 50), at(35, 50)],
        # Back to normal at 40.
        [at(40, 90), at(45, 20)],
        # Late for 10, which is closed: dropped. Three low windows, then silence of the metric: the timer ends the alarm at 60.
        [at(10, 10), at(50, 20), at(55, 20), at(90, 1, FAILED), at(91, 5, FAILED)],
        [at(130, 1, FAILED), at(131, 0, FAILED)],
        # The same metric again, long after.
        [at(180, 20), at(185, 20), at(190, 20), at(195, 20), at(300, 99)],
    ]
    source = tmp_path / "in"
    source.mkdir()
    for i, rows in enumerate(loads):
        part = tmp_path / f"load{i}"
        spark.createDataFrame(rows, "ts string, metric string, value double").selectExpr("cast(ts as timestamp) as ts", "metric", "value").coalesce(1).write.parquet(str(part))
        next(part.glob("*.parquet")).rename(source / f"{i}.parquet")
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    with alarms.state_store(spark):
        found = streams.run_to_table(alarms.stream_alarms(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted((r["rule"], r["window_start"].strftime("%H:%M"), r["status"]) for r in found.collect())
    assert got == [
        ("failures", "00:00", "ALARM"), ("failures", "00:05", "OK"), ("failures", "01:30", "ALARM"), ("failures", "01:35", "OK"),
        ("low-quality", "00:25", "ALARM"), ("low-quality", "00:40", "OK"), ("low-quality", "00:55", "ALARM"), ("low-quality", "01:00", "OK"),
        ("low-quality", "03:10", "ALARM"), ("low-quality", "03:20", "OK"),
    ]
