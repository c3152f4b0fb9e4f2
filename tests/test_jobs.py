"""Complete runs over landed pages, with run log, checks and streams."""

from datetime import timedelta
from decimal import Decimal

import pytest
from builders import arc, land, page, station
from pyspark.sql import functions as F

from obs_engine.operators import runs
from obs_engine.operators.merge import MergeResult
from obs_engine.plans import arcs, checks, jobs, stations
from obs_engine.schemas import ARC_RECORD
from obs_engine.sources.pages import IngestError
from obs_engine.streaming import flows


def arc_pages(root, *records):
    return land(root, [(0, 0, page(len(records), *records))])


def test_arc_run_overlap_and_replay(spark, warehouse, tmp_path, utc):
    ten, eleven = "2026-07-18T10:00:00+00:00", "2026-07-18T11:00:00+00:00"
    first = arc_pages(tmp_path / "1", arc(iu_ac="1", t_1h=ten), arc(iu_ac="2", t_1h=ten))
    second = arc_pages(
        tmp_path / "2",
        arc(iu_ac="1", t_1h="2026-07-18T12:00:00+02:00"),  # the first row again
        arc(iu_ac="2", t_1h=ten, q=1),  # corrected
        arc(iu_ac="1", t_1h=eleven),  # new
    )
    now = utc(2026, 7, 18, 11, 35)
    got = jobs.run_arcs(warehouse, first, "r1", now)
    assert got.load == MergeResult(2, 2, 0, 0)
    got = jobs.run_arcs(warehouse, second, "r2", now + timedelta(hours=1))
    assert got.load == MergeResult(3, 1, 1, 1)
    assert got.fact == MergeResult(2, 1, 1, 0)
    assert got.daily == MergeResult(2, 0, 2, 0)
    got = jobs.run_arcs(warehouse, second, "r3", now + timedelta(hours=2))
    assert got.load == MergeResult(3, 0, 0, 3)
    assert got.fact.received == got.daily.received == 0

    daily = {r["arc_id"]: r for r in warehouse.read(arcs.DAILY).collect()}
    assert daily["1"]["observation_count"] == 2
    assert daily["2"]["average_vehicle_flow"] == Decimal("1.00")
    log = {r["run_key"]: r for r in warehouse.read(runs.ARC_RUNS).collect()}
    assert log["arcs::r1"]["watermark_before"] is None
    third = log["arcs::r3"]
    assert (third["status"], third["records_unchanged"], third["records_received"]) == (
        "success", 3, 3
    )
    window = warehouse.read(runs.ARC_RUNS).filter("run_key = 'arcs::r2'").selectExpr(
        "cast(window_start as string)", "cast(window_end as string)"
    ).first()
    assert tuple(window) == ("2026-07-18 08:00:00", "2026-07-18 12:35:00")


def test_bad_record_fails_the_run_and_loads_nothing(warehouse, tmp_path, utc):
    bad = arc_pages(tmp_path / "1", arc(iu_ac="1"), arc(iu_ac="2", q="NaN"))
    with pytest.raises(IngestError, match="vehicle_flow"):
        jobs.run_arcs(warehouse, bad, "r1", utc(2026, 7, 18))
    assert not warehouse.exists(arcs.RAW)
    row = warehouse.read(runs.ARC_RUNS).first()
    assert (row["status"], row["records_received"], row["records_inserted"]) == ("failed", 2, 0)
    assert "vehicle_flow" in row["error_message"]
    # the same run id succeeds later and replaces its row
    good = arc_pages(tmp_path / "2", arc(iu_ac="1"))
    jobs.run_arcs(warehouse, good, "r1", utc(2026, 7, 18, 1))
    assert [r["status"] for r in warehouse.read(runs.ARC_RUNS).collect()] == ["success"]


def test_incomplete_fetch_fails_the_run(warehouse, tmp_path, utc):
    short = land(tmp_path / "p", [(0, 0, page(2, arc()))])
    with pytest.raises(IngestError, match="incomplete"):
        jobs.run_arcs(warehouse, short, "r1", utc(2026, 7, 18))


def test_station_runs_first_row_wins_and_dimension_follows_the_load(spark, warehouse, tmp_path, utc):
    def run(n, *records):
        root = land(tmp_path / str(n), [(0, 0, page(len(records), *records))])
        return jobs.run_stations(warehouse, root, f"r{n}", utc(2026, 7, 18, n))

    early, late = "2026-07-17T22:00:00+00:00", "2026-07-17T23:00:00+00:00"
    assert run(1, station(capacity=1, duedate=early)).load == MergeResult(1, 1, 0, 0)
    again = run(2, station(capacity=99, duedate=early), station(capacity=52, duedate=late))
    assert again.load == MergeResult(2, 1, 0, 1)
    assert sorted(r["total_capacity"] for r in warehouse.read(stations.FACT).collect()) == [1, 52]
    assert [r["total_capacity"] for r in warehouse.read(stations.DIM).collect()] == [52]
    log = {r["run_id"]: r for r in warehouse.read(runs.STATION_RUNS).collect()}
    assert (log["r2"]["records_inserted"], log["r2"]["duplicates_ignored"]) == (1, 1)
    # capacity 1 with 5 bikes: reported, not blocking
    tables = jobs.served_tables(warehouse, utc(2026, 7, 18, 3))
    over = checks.business_checks({**tables, **_arc_side(tables)}, utc(2026, 7, 18, 3))
    failing, severity = over["bikes_under_capacity"]
    assert (failing.count(), severity) == (1, "warn")


def _arc_side(t):
    """Arc tables are absent here; the station checks do not read these."""
    return {n: t["fct_station_status"].withColumnsRenamed({"station_id": "arc_id"}).withColumns({
        c: F.lit(None).cast("double") for c in (
            "vehicle_flow", "occupancy_rate", "observed_at", "daily_traffic_id", "observation_count",
            "vehicle_flow_observation_count", "occupancy_observation_count", "average_vehicle_flow",
            "maximum_vehicle_flow", "average_occupancy_rate", "maximum_occupancy_rate",
            "first_observed_at", "last_observed_at", *arcs.TRAFFIC_COUNTERS.values(),
            *arcs.ARC_COUNTERS.values())
    }).withColumn("observation_date", F.lit("2026-07-18").cast("date")) for n in (
        "stg_road_traffic", "fct_road_traffic", "agg_road_traffic_daily", "arc_current")}


def test_both_feeds_serve_and_pass_all_checks(spark, warehouse, tmp_path, utc):
    now = utc(2026, 7, 18, 0)
    jobs.run_arcs(warehouse, arc_pages(tmp_path / "a", arc(), arc(iu_ac="7")), "r1", now)
    root = land(tmp_path / "s", [(0, 0, page(1, station()))])
    jobs.run_stations(warehouse, root, "r1", now)
    results = jobs.check_warehouse(warehouse, now)
    assert results.count() == 194
    tables = jobs.served_tables(warehouse, now)
    jobs.register_views(tables)
    assert spark.sql("select count(*) n from all_runs where is_success").first()["n"] == 2
    assert tables["arc_current"].filter("is_fresh").count() == 2


def test_failing_check_blocks(spark, warehouse, tmp_path, utc):
    now = utc(2026, 7, 18, 0)
    jobs.run_arcs(warehouse, arc_pages(tmp_path / "a", arc(etat_trafic="Lent")), "r1", now)
    root = land(tmp_path / "s", [(0, 0, page(1, station()))])
    jobs.run_stations(warehouse, root, "r1", now)
    with pytest.raises(IngestError, match="accepted_values_fct_road_traffic_traffic_status"):
        jobs.check_warehouse(warehouse, now)


# -- run rows


def test_run_row_metrics(utc):
    start = utc(2026, 7, 1)
    row = runs.build_run_row(
        "stations", {"run_id": "r"}, start, start + timedelta(seconds=3, microseconds=456_000),
        {"records_received": 1516, "records_inserted": 61},
    )
    assert (row["duplicates_ignored"], row["duration_seconds"]) == (1455, Decimal("3.456"))
    failed = runs.build_run_row("arcs", {}, start, start, {}, error="x" * 5000)
    assert (failed["status"], len(failed["error_message"])) == ("failed", 4000)


@pytest.mark.parametrize(
    "feed, finished, counts",
    [
        ("stations", True, {"records_received": 1, "records_inserted": 2}),
        ("arcs", True, {"records_received": 2, "records_updated": 2, "records_unchanged": 1}),
        ("stations", True, {"pages_fetched": -1}),
        ("stations", False, {}),
        ("trams", True, {}),
    ],
)
def test_invalid_run_rows(utc, feed, finished, counts):
    start = utc(2026, 7, 1)
    with pytest.raises(runs.RunError):
        runs.build_run_row(feed, {}, start, start if finished else None, counts)


def test_constraints_reject_a_row_before_it_is_written(warehouse, utc):
    start = utc(2026, 7, 1)
    row = runs.build_run_row(
        "stations", {"run_id": "r", "dag_id": "d", "task_id": "t"}, start, start, {}
    )
    with pytest.raises(runs.RunError, match="status is final"):
        runs.upsert_run(warehouse, "stations", {**row, "status": "running"})
    assert not warehouse.exists(runs.STATION_RUNS)


# -- streams


def test_streamed_pages_equal_the_batch_run(spark, warehouse, tmp_path, utc):
    import json

    folder = tmp_path / "lines"
    folder.mkdir()

    def drop(n, *records):
        line = {"chunk_no": n, "offset": 0, **page(len(records), *records)}
        (folder / f"{n}.json").write_text(json.dumps(line) + "\n")

    def run_stream():
        records = flows.stream_records(spark, str(folder), ARC_RECORD)
        parsed = arcs.parse_arcs(records, utc(2026, 7, 18), "stream").drop("reject_reasons")
        flows.upsert_stream(
            parsed, warehouse, arcs.RAW, arcs.COMPARED, ["chunk_no", "offset", "pos"],
            str(tmp_path / "checkpoint"),
        ).awaitTermination(120)

    drop(0, arc(iu_ac="1", q=200), arc(iu_ac="1", q=250), arc(iu_ac="2"))
    run_stream()
    drop(1, arc(iu_ac="2", q=9), arc(iu_ac="3"))
    run_stream()
    got = {r["arc_id"]: int(r["vehicle_flow"]) for r in warehouse.read(arcs.RAW).collect()}
    assert got == {"1": 250, "2": 9, "3": 40}
