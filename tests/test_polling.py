"""Polls as a stream: windows in offsets, replays, and state that expires."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from obs_engine.sources.pages import IngestError
from obs_engine.sources.polling import PollReader, polled_documents
from obs_engine.streaming import expiring, flows

NOON = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)


def numbers(notes):
    """A feed with one record a minute; notes which windows it is asked for."""

    def page(low, high, offset, size):
        import uuid
        from datetime import timedelta

        with open(f"{notes}/{uuid.uuid4().hex}", "w") as f:
            f.write(f"{low.isoformat()} {high.isoformat()} {offset}")
        n = int((high - low).total_seconds()) // 60 + 1
        minutes = [(low + timedelta(minutes=i)).isoformat() for i in range(n)]
        return {"total_count": n, "results": [{"t": m} for m in minutes[offset : offset + size]]}

    return page


def asked(folder):
    return {f.read_text() for f in folder.iterdir()}


def reader(**options):
    return PollReader({"provider": "", **{k: str(v) for k, v in options.items()}})


def test_windows_of_offsets():
    first = reader(now=NOON.isoformat())
    window = first.latestOffset()
    assert window == {"start": "2024-05-01T06:00:00+00:00", "end": "2024-05-01T12:00:00+00:00"}
    assert first.latestOffset() == window, "no new poll without a later clock"
    known = reader(now=NOON.isoformat(), watermark=(NOON - timedelta(minutes=30, microseconds=7)).isoformat())
    assert known.latestOffset()["start"] == "2024-05-01T09:29:59+00:00"
    ahead = reader(now=NOON.isoformat(), watermark=(NOON + timedelta(hours=9)).isoformat())
    assert ahead.latestOffset()["start"] == ahead.latestOffset()["end"]
    chunks = first.partitions({}, window)
    assert [(c.chunk_no, c.of) for c in chunks] == [(0, 3), (1, 3), (2, 3)]
    assert chunks[0].end == chunks[1].start and chunks[-1].end == window["end"]
    same = {"start": window["end"], "end": window["end"]}
    assert len(first.partitions(window, same)) == 1


def test_a_running_query_overlaps_its_windows(monkeypatch):
    live = reader(everySeconds=600)
    times = iter([NOON, NOON + timedelta(minutes=10)])
    monkeypatch.setattr(live, "clock", lambda: next(times))
    one, two = live.latestOffset(), live.latestOffset()
    assert two["end"] > one["end"] and two["start"] == (NOON - timedelta(hours=2)).isoformat()


@pytest.mark.parametrize("bad", [{"chunkHours": 0}, {"pageSize": 0}, {"pageSize": 101}])
def test_bad_options_are_refused(bad):
    with pytest.raises(ValueError):
        reader(**bad)


def test_a_failed_poll_asks_for_its_window_again(spark, tmp_path):
    notes, checkpoint = tmp_path / "notes", str(tmp_path / "checkpoint")
    notes.mkdir()
    seen = []

    def poll(now, watermark, fail=False):
        docs = polled_documents(spark, numbers(str(notes)), watermark, now, hours=3)

        def load(batch, number):
            rows = batch.collect()
            if fail:
                raise RuntimeError("store is down")
            seen.append((number, sum(len(json.loads(r["document"])["results"]) for r in rows)))

        flows.each_poll(docs, load, checkpoint)

    with pytest.raises(StreamingQueryException):
        poll(NOON, None, fail=True)
    first = asked(notes)
    for f in notes.iterdir():
        f.write_text("")
    # An hour later, with another watermark: the old window first, then the new one.
    poll(NOON + timedelta(hours=1), NOON - timedelta(hours=1))
    again = asked(notes) - {""}
    assert first <= again and [n for n, _ in seen] == [0, 1]
    assert seen[0][1] == 6 * 60 + 2 and seen[1][1] == 4 * 60 + 2  # a border is in both its chunks
    poll(NOON + timedelta(hours=1), NOON - timedelta(hours=1))
    assert len(seen) == 2, "nothing is polled twice at one time"


def test_too_many_records_halve_the_window(spark, tmp_path):
    docs = polled_documents(spark, numbers(str(tmp_path)), None, NOON, hours=6, max_records=100)
    got = []
    flows.each_batch(docs, lambda b, _: got.extend(b.collect()), str(tmp_path / "c")).awaitTermination()
    assert len({r["chunk_no"] for r in got}) >= 4
    assert max(json.loads(r["document"])["total_count"] for r in got) <= 100
    with pytest.raises(StreamingQueryException):
        dense = polled_documents(spark, numbers(str(tmp_path)), None, NOON, max_records=0)
        flows.each_batch(dense, lambda b, _: b.collect(), str(tmp_path / "d")).awaitTermination()
    assert issubclass(IngestError, ValueError)


ROWS = "k STRING, id LONG, ts TIMESTAMP"


def deliver(spark, tmp_path, rounds, build):
    """Rounds of rows through one stateful query; what each emitted, and the keys it still holds."""
    source, out, held = str(tmp_path / "source"), [], []
    for i, rows in enumerate(rounds):
        typed = [(k, n, NOON + timedelta(minutes=m) if m is not None else None) for k, n, m in rows]
        spark.createDataFrame(typed, ROWS).coalesce(1).write.mode("append").parquet(source)
        stream = flows.stream_files(spark, source, spark.createDataFrame([], ROWS).schema)
        keep = lambda b, _, i=i: out.extend((i, *r) for r in b.collect())
        q = flows.each_batch(build(stream), keep, str(tmp_path / "checkpoint"), "update")
        q.awaitTermination()
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    return out, held


def test_latest_state_expires(spark, tmp_path):
    rounds = [
        [("a", 1, 0), ("a", 2, 0), ("b", 3, 10), (None, 9, 5), ("c", 9, None)],
        [("a", 4, 300)],  # the watermark passes a's and b's rows
        [("b", 5, 150), ("b", 6, 200), ("a", 7, 290)],  # too late; just in time; older than the latest
        [("b", 8, 600)],
        [("b", 8, 600), ("a", 10, 400)],  # repeated; too late
    ]
    latest = lambda s: expiring.expiring_latest(s, ["k"], "ts", "id", "2 hours")
    out, held = deliver(spark, tmp_path, rounds, latest)
    assert sorted((r[0], r[1], r[2]) for r in out) == [(0, "a", 2), (0, "b", 3), (1, "a", 4), (2, "b", 6), (3, "b", 8)]
    assert held[-1] < max(held) or held[-1] <= 2


def test_first_rows_stay_while_late_ones_can_come(spark, tmp_path):
    rounds = [
        [("a", 1, 5), ("a", 2, 3), ("b", 3, 20)],
        [("a", 4, 1), ("b", 5, 20), ("c", 6, 400)],  # known keys; a new one
        [("d", 7, 285), ("e", 8, 279)],  # five hours late: inside and outside the horizon
    ]

    def first(s):
        return expiring.expiring_first(s.withColumn("end", F.col("ts") + F.expr("INTERVAL 1 HOUR")), ["k"], "ts", "id", "2 hours", "end")

    out, _ = deliver(spark, tmp_path, rounds, first)
    assert sorted((r[0], r[1], r[2]) for r in out) == [(0, "a", 2), (0, "b", 3), (1, "c", 6), (2, "d", 7)]


def test_micros_of_naive_and_zoned_times():
    assert expiring.micros(NOON) == expiring.micros(NOON.replace(tzinfo=None)) == int(NOON.timestamp()) * 1_000_000
