"""What a job keeps on disk: no shuffle of an ended query, compressed pages and tables, staged rows while needed."""

import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from builders import land, page, station
from obs_engine.operators import merge
from obs_engine.operators.merge import DuplicateKey, TableSpec, Warehouse, by_bucket, by_day
from obs_engine.plans import catalogue, jobs
from obs_engine.plans.stand_ins import Inputs

SPEC = TableSpec("readings", ("id", "at"), by_day("at"))
LINES = "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_shipdate TIMESTAMP_NTZ"


def readings(spark, days, per_day=3, value=1, at=datetime(2024, 1, 1)):
    rows = [(i, at + timedelta(days=d), value) for d in range(days) for i in range(per_day)]
    return spark.createDataFrame([*rows, (99, None, value)], "id INT, at TIMESTAMP_NTZ, value INT")


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark, warehouse):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name)
    kept = [warehouse.stage(readings(spark, 4).repartition(4, "id").groupBy("id").count(), "grouped")]
    kept.append(warehouse.insert_ignore(SPEC, readings(spark, 4)))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(name) == setting


def test_pages_are_landed_compressed_with_the_same_text(spark, tmp_path):
    rows = [(o, 1, s, n, 5.0, datetime(2000, 1, 30) + timedelta(days=d)) for o in (1, 2) for s in (None, 17, 33, 50) for n in (1, 2) for d in range(3)]
    spark.createDataFrame([*rows, (9, 1, 3, 1, None, datetime(2000, 1, 1))], LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    x = Inputs(spark, str(tmp_path))
    x.write_station_pages(str(tmp_path / "plain"), per_page=5)
    x.write_station_pages(str(tmp_path / "packed"), per_page=5, compression="gzip")
    assert {f.suffix for f in (tmp_path / "packed").rglob("part-*")} == {".gz"}
    plain, packed = (sorted(r[0] for r in spark.read.text(str(tmp_path / n)).collect()) for n in ("plain", "packed"))
    assert plain == packed and len(plain) == 6


def test_station_job_lands_compressed_pages(spark, tmp_path, monkeypatch):
    rows = [(o, 1, s, 1, 5.0, datetime(2000, 1, 30) + timedelta(days=o)) for o in range(4) for s in (3, 4)]
    spark.createDataFrame(rows, LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    landed, run = [], jobs.run_stations

    def noted(wh, path, *args, **named):
        landed.append({f.suffix for f in Path(path).rglob("part-*")})
        return run(wh, path, *args, **named)

    monkeypatch.setattr(jobs, "run_stations", noted)
    assert catalogue.station_job_rows(Inputs(spark, str(tmp_path))).count() == 8
    assert landed == [{".gz"}, {".gz"}]


def test_staged_pages_go_before_the_records_are_merged(spark, tmp_path):
    seen = []

    class Watched(Warehouse):
        def stage(self, df, label, *args, **named):
            staged = super().stage(df, label, *args, **named)
            if label == "pages":
                seen.append(staged._obs_path)
            return staged

        def insert_ignore(self, spec, batch):
            seen.append(self.path_exists(seen[0]))
            return super().insert_ignore(spec, batch)

    wh = Watched(spark, str(tmp_path / "warehouse"))
    path = land(tmp_path / "pages", [(1, 0, page(1, station()))])
    assert jobs.run_stations(wh, path, "r1", datetime(2031, 3, 10)).load.inserted == 1
    assert seen[1:] == [False]


@pytest.mark.parametrize("layout", [by_day("at"), by_bucket("id", 5)])
def test_many_staged_rows_are_written_in_ranges_of_whole_partitions(spark, tmp_path, monkeypatch, layout):
    spec, written, classified = TableSpec("readings", ("id", "at"), layout), [], []

    class Watched(Warehouse):
        def _write(self, spec, df, *args, **named):
            written.append({r[0] for r in df.select(spec.partition).distinct().collect()})
            super()._write(spec, df, *args, **named)

        def stage(self, df, label, keep=None, more=(), **figures):
            if label.endswith("classified"):
                classified.append(1 + len(more))
            return super().stage(df, label, keep, more, **figures)

    for most in ("LAID_OUT_ROWS", "CLASSIFIED_ROWS"):
        monkeypatch.setattr(merge, most, 6)
    wh = Watched(spark, str(tmp_path / "warehouse"))
    assert wh.insert_ignore(spec, readings(spark, 8)).inserted == 25
    first, added = len(written), readings(spark, 8, at=datetime(2025, 1, 1)).dropna()
    assert wh.insert_ignore(spec, added).inserted == 24
    assert wh.insert_ignore(spec, added).unchanged == 24
    assert first > 2 and len(written) > first + 2 and min(classified) > 2
    for part in (written[:first], written[first:]):
        assert sum(map(len, part)) == len(set().union(*part))
    whole = readings(spark, 8).unionByName(added)
    assert sorted(map(str, wh.read(spec).collect())) == sorted(map(str, whole.collect()))
    changed = whole.withColumn("value", F.when(F.col("id") == 1, 7).otherwise(F.col("value")))
    assert wh.upsert(spec, changed, ["value"]).updated == 16
    assert sorted(map(str, wh.read(spec).dropna().collect())) == sorted(map(str, changed.dropna().collect()))


def test_a_repeated_key_leaves_no_table(spark, warehouse, monkeypatch):
    monkeypatch.setattr(merge, "LAID_OUT_ROWS", 6)
    with pytest.raises(DuplicateKey):
        warehouse.insert_ignore(SPEC, readings(spark, 8).unionByName(readings(spark, 1)))
    assert not warehouse.exists(SPEC)
