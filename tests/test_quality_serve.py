"""Checks and dashboard queries on small tables."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obs_engine.operators import aggregates, joins, quality, serve
from obs_engine.operators.quality import TableChecks
from obs_engine.plans import arcs


def test_column_report_is_one_pass_and_nulls_pass_accepted_values(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "a int, b string")
    checks = TableChecks(not_null=("a", "b"), accepted={"b": ("x",)})
    report = quality.column_report(df, "t", checks)
    assert {r["check"]: r["failures"] for r in report.collect()} == {
        "not_null_t_a": 1, "not_null_t_b": 1, "accepted_values_t_b": 1
    }
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") <= 2


def test_graded_results(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",)], "k string")
    tables = {"child": child, "parent": parent}
    declared = {"child": TableChecks(not_null=("k",), unique=("k",), parents={"k": "parent"})}
    got = {r["check"]: (r["failures"], r["status"])
           for r in quality.run_table_checks(tables, declared).collect()}
    assert got == {
        "not_null_child_k": (1, "fail"),
        "unique_child_k": (1, "fail"),
        "relationships_child_k": (2, "fail"),
    }
    warned = quality.counted("c", child, "warn").first()
    assert (warned["failures"], warned["status"]) == (4, "warn")


@pytest.mark.parametrize(
    "hour, status", [(12, "pass"), (14, "pass"), (15, "warn"), (18, "warn"), (19, "error")]
)
def test_freshness_thresholds(spark, utc, hour, status):
    df = spark.sql("select timestamp_ntz'2026-07-18 12:00:00' as ingested_at")
    got = quality.freshness(df, "ingested_at", utc(2026, 7, 18, hour)).first()
    assert got["status"] == status


def test_empty_source_is_not_fresh(spark, utc):
    df = spark.createDataFrame([], "ingested_at timestamp_ntz")
    assert quality.freshness(df, "ingested_at", utc(2026, 1, 1)).first()["status"] == "error"


def daily_row(**changes):
    row = dict(
        daily_traffic_id="d", arc_id="a", observation_date=date(2026, 7, 1), observation_count=2,
        vehicle_flow_observation_count=2, occupancy_observation_count=0,
        average_vehicle_flow=Decimal("1.50"), maximum_vehicle_flow=Decimal("1.499"),
        average_occupancy_rate=None, maximum_occupancy_rate=None,
        first_observed_at=datetime(2026, 7, 1, 1), last_observed_at=datetime(2026, 7, 1, 2),
        **{n: 0 for n in arcs.TRAFFIC_COUNTERS.values()},
        **{n: 0 for n in arcs.ARC_COUNTERS.values()},
    )
    row.update(fluid_observation_count=2, open_arc_observation_count=1,
               invalid_arc_observation_count=1)
    return {**row, **changes}


@pytest.mark.parametrize(
    "changes, fails",
    [
        ({}, False),  # the rounded maximum equals the mean
        ({"maximum_vehicle_flow": Decimal("1.4")}, True),
        ({"fluid_observation_count": 1}, True),
        ({"open_arc_observation_count": 2}, True),
        ({"average_occupancy_rate": Decimal("1.00")}, True),
        ({"occupancy_observation_count": 1}, True),
        ({"occupancy_observation_count": 1, "average_occupancy_rate": Decimal("99.00"),
          "maximum_occupancy_rate": Decimal("101")}, True),
        ({"vehicle_flow_observation_count": 3}, True),
        ({"last_observed_at": datetime(2026, 7, 1, 0)}, True),
    ],
)
def test_arc_daily_consistency(spark, changes, fails):
    row = daily_row(**changes)
    types = {"observation_date": "date", "daily_traffic_id": "string", "arc_id": "string"}

    def kind(name):
        if "average" in name or "maximum" in name:
            return "decimal(28,12)"
        return "timestamp_ntz" if name.endswith("_at") else types.get(name, "bigint")

    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} {kind(n)}" for n in row))
    bad = quality.arc_daily_inconsistent(
        df, list(arcs.TRAFFIC_COUNTERS.values()), list(arcs.ARC_COUNTERS.values())
    )
    assert bad.count() == int(fails)


def test_null_coordinates_and_measures_pass(spark):
    dim = spark.createDataFrame([("a", None, None), ("b", 200.0, 1.0)],
                                "station_id string, longitude double, latitude double")
    assert [r["station_id"] for r in quality.invalid_coordinates(dim).collect()] == ["b"]
    fact = spark.createDataFrame(
        [("1", None, None), ("2", Decimal(-1), None), ("3", None, Decimal(101)), ("4", Decimal(1), Decimal(5))],
        "observation_id string, vehicle_flow decimal(28,12), occupancy_rate decimal(28,12)",
    ).withColumns({"arc_id": F.lit("a"), "observed_at": F.lit(None).cast("timestamp")})
    assert {r["observation_id"] for r in quality.invalid_measurements(fact).collect()} == {"2", "3"}


def test_reconcile_only_looks_at_recent_days(spark, utc):
    fact = spark.sql(
        "select 'a' arc_id, timestamp'2026-01-10 01:00:00Z' observed_at, 1.0 vehicle_flow,"
        " 1.0 occupancy_rate union all select 'a', timestamp'2026-07-10 01:00:00Z', 1.0, null"
    )
    daily = spark.createDataFrame(
        [], "arc_id string, observation_date date, observation_count bigint,"
            " vehicle_flow_observation_count bigint, occupancy_observation_count bigint"
    )
    got = quality.arc_daily_mismatch(fact, daily, utc(2026, 7, 11))
    assert [(str(r["observation_date"]), r["observation_count"]) for r in got.collect()] == [
        ("2026-07-10", None)
    ]


def test_tuple_distinct_counts_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", 1)], "x string, y int")
    assert aggregates.distinct_tuples(df, ["x", "y"]).first()[0] == 2
    assert quality.key_consistency({"t": (df, ("x", "y"))}).first()["valid"] is False


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    parent = spark.createDataFrame([(2,)], "k int")
    assert [tuple(r) for r in joins.orphans(child, "k", parent, "k").collect()] == [(1, 2)]


# -- serving

RUNS = "pipeline_name string, is_success boolean, records_received int, duration_seconds decimal(12,3)"


@pytest.fixture
def some_runs(spark):
    return spark.createDataFrame(
        [("x", True, 10, Decimal("1.000")), ("x", False, None, Decimal("2.000")),
         ("y", True, 5, Decimal("4.000"))], RUNS,
    )


def test_filters_select_and_empty_selects_all(some_runs):
    assert serve.run_count(some_runs, {"pipeline_name": ["x"]}).first()[0] == 2
    assert serve.run_count(some_runs, {"pipeline_name": []}).first()[0] == 3
    assert serve.success_rate(some_runs, {"pipeline_name": ["x"]}).first()[0] == Decimal("50.00")
    assert serve.success_rate(some_runs).first()[0] == Decimal("66.67")
    assert serve.success_rate_by_cast(some_runs).first()[0] == Decimal("66.67")
    assert serve.average_duration(some_runs).first()[0] == Decimal("2.33")
    assert serve.records_received(some_runs).first()[0] == 15


def test_success_rate_of_nothing_is_null(some_runs):
    assert serve.success_rate(some_runs, {"pipeline_name": ["z"]}).first()[0] is None


def test_share_counts_the_null_category(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "c string, id int")
    got = aggregates.share_of_total(df, "c", F.count_distinct("id"), "n", 2).collect()
    assert [(r["c"], r["share"]) for r in got] == [("a", 0.5), ("b", 0.25)]


def test_last_month_is_half_open(spark, utc):
    df = spark.sql("select explode(sequence(date'2024-02-20', date'2024-04-02')) d")
    days = [r["d"] for r in serve.last_month(df, "d", utc(2024, 3, 31)).collect()]
    assert (min(days), max(days)) == (date(2024, 2, 29), date(2024, 3, 30))


def test_weighted_and_plain_mean_of_days(spark, utc):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 1), Decimal("10.00"), 1), ("b", date(2024, 1, 1), Decimal("20.00"), 3),
         ("c", date(2024, 1, 2), None, 0)],
        "arc_id string, observation_date date, average_vehicle_flow decimal(20,2),"
        " vehicle_flow_observation_count bigint",
    )
    got = [tuple(r) for r in serve.flow_per_day(df, utc(2024, 1, 15)).collect()]
    assert [(str(d)[:10], v) for d, v in got] == [("2024-01-01", 17.5), ("2024-01-02", None)]


def test_map_points_drop_unlocated_rows(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "longitude double, latitude double")
    assert serve.located_only(df).count() == 1
