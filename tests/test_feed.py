"""The stored feed: pages for Python workers, whatever the session's Parquet settings."""

import base64
import subprocess
import sys
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle

from obs_engine.plans.feed import StoredFeed, feed_records
from obs_engine.plans.stand_ins import Inputs
from obs_engine.sources.polling import PollSource

START = datetime(2024, 1, 2, 6, tzinfo=timezone.utc)


def stored(spark, tmp_path, stamps):
    rows = [(n, START + timedelta(minutes=n), n % 3, "click", 1.5 * n, '{"k": 1}') for n in range(30)]
    schema = "event_id LONG, ts TIMESTAMP, user_id LONG, event_type STRING, value DOUBLE, props STRING"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", stamps)
    try:
        feed_records(Inputs(spark, str(tmp_path))).write.parquet(str(tmp_path / "feed"))
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", before)
    return str(tmp_path / "feed")


@pytest.mark.parametrize("stamps", ["INT96", "TIMESTAMP_MICROS"])
def test_pages_of_a_feed_stored_under_any_timestamp_setting(spark, tmp_path, stamps):
    path = stored(spark, tmp_path, stamps)
    first, later = StoredFeed(path, 0), StoredFeed(path, 2)
    low, high = START, START + timedelta(minutes=9)
    page = first(low, high, 0, 4)
    # Records 0 to 9 without number 3, which is published one poll late.
    assert page["total_count"] == 9 and [r["t_1h"][14:16] for r in page["results"]] == ["00", "01", "02", "04"]
    assert [r["t_1h"][14:16] for r in first(low, high, 8, 4)["results"]] == ["09"]
    corrected = later(low, high, 0, 100)
    assert corrected["total_count"] == 10
    assert corrected["results"][5]["q"] == page["results"][3]["q"] + 1.5 + 1


def test_workers_need_no_copy_of_the_package(tmp_path):
    text = base64.b64encode(cloudpickle.dumps((StoredFeed("nowhere", 1), PollSource))).decode()
    code = (
        "import base64, sys; from pyspark import cloudpickle\n"
        f"feed, source = cloudpickle.loads(base64.b64decode('{text}'))\n"
        "assert feed.poll == 1 and 'obs_engine' not in sys.modules\n"
        "source({'provider': '', 'now': '2024-05-01T12:00:00+00:00'}).streamReader(None).latestOffset()\n"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin"}, timeout=120)
    assert run.returncode == 0, run.stderr
