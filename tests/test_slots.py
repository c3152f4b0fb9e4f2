"""First rows kept by slots: many keys of one slot, each forgotten at its own time."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from obs_engine.streaming import expiring, flows

NOON = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
ROWS = "k STRING, id LONG, ts TIMESTAMP"


def test_state_follows_the_slots_and_forgets_each_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(expiring, "SLOTS", 2, raising=False)
    source, out, held = str(tmp_path / "source"), [], []
    # Sixty keys of three hours, repeated and new ones, then keys a day later.
    many = [(f"k{n}", n, 60 * (n % 3)) for n in range(60)]
    rounds = [many, [("k1", 100, 60), ("k2", 101, 120), ("new", 102, 100)], [("late", 200, 1440)], [("last", 300, 1500)]]
    for i, rows in enumerate(rounds):
        typed = [(k, n, NOON + timedelta(minutes=m)) for k, n, m in rows]
        spark.createDataFrame(typed, ROWS).coalesce(1).write.mode("append").parquet(source)
        stream = flows.stream_files(spark, source, spark.createDataFrame([], ROWS).schema)
        first = expiring.expiring_first(stream.withColumn("end", F.expr("ts + INTERVAL 1 HOUR")), ["k"], "ts", "id", "2 hours", "end")
        keep = lambda b, _, i=i: out.extend((i, r["k"], r["id"]) for r in b.collect())
        q = flows.each_batch(first, keep, str(tmp_path / "checkpoint"), "update")
        q.awaitTermination()
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sorted(out) == sorted([(0, k, n) for k, n, _ in many] + [(1, "new", 102), (2, "late", 200), (3, "last", 300)])
    assert max(held) <= 8, "a value and a timer for each slot, none for each key"
