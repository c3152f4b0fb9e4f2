"""Stored feeds: what follows from a fact is built on the stored one; a load log is one job."""

from datetime import date, datetime

from obs_engine.operators.merge import STORED, TOUCHED, TableSpec, by_day
from obs_engine.plans import arcs, catalogue, stations
from obs_engine.plans.stand_ins import Inputs
from test_check_plan import small_tables

SPEC = TableSpec("loads", ("id", "at"), by_day("at"))


def test_a_rebuild_logs_partitions_and_table_in_one_write(spark, warehouse):
    rows = [
        (1, datetime(2024, 1, 1, 5), datetime(2024, 1, 3)), (2, datetime(2024, 1, 1, 6), datetime(2024, 1, 4)),
        (3, datetime(2024, 1, 2, 5), datetime(2024, 1, 2)), (4, None, datetime(2024, 1, 9)), (5, datetime(2024, 1, 7), None),
    ]
    warehouse.rebuild(SPEC, spark.createDataFrame(rows, "id INT, at TIMESTAMP_NTZ, ingested_at TIMESTAMP_NTZ"))
    log = spark.read.parquet(f"{warehouse.path(SPEC)}-loads")
    assert len(log.inputFiles()) == 1
    micros = {d: int(datetime(2024, 1, d).timestamp() - datetime(1970, 1, 1).timestamp()) * 1_000_000 for d in (2, 4, 9)}
    assert sorted(map(str, log.select("kind", "part", "column", "micros").collect())) == sorted(
        f"Row(kind='{k}', part={p!r}, column='ingested_at', micros={micros[d]})"
        for k, p, d in (
            (TOUCHED, date(2024, 1, 1), 4), (TOUCHED, date(2024, 1, 2), 2), (TOUCHED, None, 9), (STORED, None, 9),
        )
    )


def test_dimensions_and_aggregates_of_stored_feeds_read_the_stored_facts(spark, tmp_path, monkeypatch):
    read = {}
    for module, name in ((stations, "station_dim"), (stations, "station_daily"), (arcs, "arc_dim"), (arcs, "arc_daily")):
        build = getattr(module, name)

        def noted(rows, build=build, name=name):
            read[name] = {f.split("/")[-4] for f in rows.inputFiles()}
            return build(rows)

        monkeypatch.setattr(module, name, noted)
    x = Inputs(spark, small_tables(spark, tmp_path))
    wh = catalogue._stored_feeds(x, "feeds")
    fact, traffic = {stations.FACT.name}, {arcs.FACT.name}
    assert read == {"station_dim": fact, "station_daily": fact, "arc_dim": traffic, "arc_daily": traffic}
    monkeypatch.undo()
    fresh = Inputs(spark, str(tmp_path))
    for spec, df in (
        (stations.DIM, fresh.station_dim), (stations.DAILY.monthly(), fresh.station_daily), (arcs.DIM, fresh.arc_dim),
        (arcs.DAILY, fresh.arc_daily),
    ):
        assert sorted(map(str, wh.read(spec).select(*df.columns).collect())) == sorted(map(str, df.collect()))
