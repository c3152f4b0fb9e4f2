"""Micro-batches of the streamed events follow the writings, not the files."""

from datetime import datetime, timedelta

from obs_engine.plans import catalogue
from obs_engine.plans.stand_ins import Inputs
from obs_engine.streaming import flows


def test_two_writings_are_two_micro_batches(spark, tmp_path):
    rows = [(n, datetime(2024, 1, 1) + timedelta(minutes=n), n % 3) for n in range(40)]
    events = spark.createDataFrame(rows, "event_id LONG, ts TIMESTAMP, user_id LONG").repartition(4)
    events.write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a file, a task
    try:
        seen = []
        stream = catalogue._event_stream(Inputs(spark, str(tmp_path)))
        flows.each_batch(stream, lambda b, n: seen.append((n, b.count())), str(tmp_path / "c")).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [n for n, _ in seen] == [0, 1] and sum(k for _, k in seen) == 40
