"""The data tests declared for the sources and models, as data."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.functions.keys import day_of
from obs_engine.functions.metrics import STATION_STATUSES
from obs_engine.operators import quality as q
from obs_engine.operators.check_plan import COUNT, EQUAL, PRESENT, CheckPlan, KeySide
from obs_engine.operators.quality import TableChecks
from obs_engine.plans import arcs
from obs_engine.schemas import (
    ARC_FEED_LABEL,
    ARC_STATUSES,
    RUN_STATUSES,
    STATION_FEED_LABEL,
    TRAFFIC_STATUSES,
)

_BOTH = (True, False)

# Columns and accepted values of the declared data tests.
SOURCES: dict[str, TableChecks] = {
    "raw_stations": TableChecks(not_null=("stationcode", "last_reported", "ingested_at")),
    "raw_road_traffic": TableChecks(
        not_null=("arc_id", "observed_at", "ingested_at", "source_run_id")
    ),
    "ingestion_runs": TableChecks(
        not_null=("run_id", "status", "started_at"),
        unique=("run_id",),
        accepted={"status": RUN_STATUSES},
    ),
    "traffic_ingestion_runs": TableChecks(
        not_null=(
            "run_key", "airflow_run_id", "dag_id", "task_id", "started_at", "finished_at",
            "status", "window_start", "window_end", "records_received", "duration_seconds",
        ),
        unique=("run_key",),
        accepted={"status": RUN_STATUSES},
    ),
}

MODELS: dict[str, TableChecks] = {
    "dim_stations": TableChecks(
        not_null=("station_id", "station_name", "total_capacity", "first_seen_at", "last_seen_at"),
        unique=("station_id",),
    ),
    "fct_station_status": TableChecks(
        not_null=(
            "observation_id", "station_id", "station_name", "total_capacity",
            "status_updated_at", "loaded_at", "station_status",
        ),
        unique=("observation_id",),
        accepted={"station_status": STATION_STATUSES},
        parents={"station_id": "dim_stations"},
    ),
    "agg_station_daily": TableChecks(
        not_null=(
            "daily_station_id", "station_id", "observation_date", "observation_count",
            "average_bikes_available", "minimum_bikes_available", "maximum_bikes_available",
            "average_docks_available", "average_occupancy_rate_percent",
            "empty_observation_count", "no_dock_observation_count",
            "out_of_service_observation_count", "capacity_anomaly_count", "first_observed_at",
            "last_observed_at", "last_loaded_at",
        ),
        unique=("daily_station_id",),
        parents={"station_id": "dim_stations"},
    ),
    "station_current": TableChecks(
        not_null=(
            "observation_id", "station_id", "station_name", "bikes_available",
            "mechanical_bikes", "electric_bikes", "docks_available", "total_capacity",
            "station_status", "status_updated_at", "loaded_at", "data_age_minutes", "is_fresh",
        ),
        unique=("observation_id", "station_id"),
        accepted={"station_status": STATION_STATUSES},
        parents={"station_id": "dim_stations"},
    ),
    "dim_road_arcs": TableChecks(
        not_null=(
            "arc_id", "first_observed_at", "last_observed_at", "first_loaded_at",
            "last_loaded_at",
        ),
        unique=("arc_id",),
    ),
    "fct_road_traffic": TableChecks(
        not_null=(
            "observation_id", "arc_id", "observed_at", "has_vehicle_flow", "has_occupancy_rate",
            "has_traffic_measurement", "loaded_at", "source_run_id",
        ),
        unique=("observation_id",),
        accepted={
            "traffic_status": TRAFFIC_STATUSES,
            "arc_status": ARC_STATUSES,
            "has_vehicle_flow": _BOTH,
            "has_occupancy_rate": _BOTH,
            "has_traffic_measurement": _BOTH,
        },
        parents={"arc_id": "dim_road_arcs"},
    ),
    "agg_road_traffic_daily": TableChecks(
        not_null=(
            "daily_traffic_id", "arc_id", "observation_date", "observation_count",
            "vehicle_flow_observation_count", "occupancy_observation_count",
            *arcs.TRAFFIC_COUNTERS.values(), *arcs.ARC_COUNTERS.values(),
            "first_observed_at", "last_observed_at", "last_loaded_at",
        ),
        unique=("daily_traffic_id",),
        parents={"arc_id": "dim_road_arcs"},
    ),
    "arc_current": TableChecks(
        not_null=(
            "observation_id", "arc_id", "arc_label", "observed_at", "traffic_status",
            "arc_status", "has_vehicle_flow", "has_occupancy_rate", "has_traffic_measurement",
            "loaded_at", "data_age_minutes", "is_fresh",
        ),
        unique=("observation_id", "arc_id"),
        accepted={"traffic_status": TRAFFIC_STATUSES, "arc_status": ARC_STATUSES},
        parents={"arc_id": "dim_road_arcs"},
    ),
    "station_runs": TableChecks(
        not_null=("run_id", "status", "started_at", "finished_at", "duration_seconds",
                  "is_success"),
        unique=("run_id",),
        accepted={"status": RUN_STATUSES},
    ),
    "arc_runs": TableChecks(
        not_null=(
            "run_key", "airflow_run_id", "dag_id", "task_id", "started_at", "finished_at",
            "status", "window_start", "window_end", "records_received", "records_inserted",
            "records_updated", "records_unchanged", "duration_seconds", "records_per_second",
            "insertion_rate_percent", "update_rate_percent", "unchanged_rate_percent",
            "classified_record_count", "counts_are_consistent", "is_success",
        ),
        unique=("run_key",),
        accepted={"status": RUN_STATUSES, "counts_are_consistent": (True,)},
    ),
    "all_runs": TableChecks(
        not_null=(
            "pipeline_run_id", "pipeline_name", "airflow_run_id", "started_at", "finished_at",
            "status", "records_received", "records_inserted", "records_updated",
            "records_unchanged", "changed_record_count", "duration_seconds",
            "records_per_second", "unchanged_rate_percent", "is_success",
        ),
        unique=("pipeline_run_id",),
        accepted={
            "pipeline_name": (STATION_FEED_LABEL, ARC_FEED_LABEL),
            "status": RUN_STATUSES,
        },
    ),
}

DECLARED = {**SOURCES, **MODELS}


def business_checks(t: Mapping[str, DataFrame], as_of: datetime | None = None) -> dict:
    """Business checks as ``name -> (failing rows, severity)`` (Q5-Q14)."""
    checks = {
        "bike_breakdown_matches_total": q.breakdown_mismatch(t["fct_station_status"]),
        "bikes_under_capacity": q.over_capacity(t["fct_station_status"]),
        "non_negative_availability": q.negative_availability(t["fct_station_status"]),
        "valid_station_coordinates": q.invalid_coordinates(t["dim_stations"]),
        "valid_traffic_measurements": q.invalid_measurements(t["fct_road_traffic"]),
        "station_status_row_count": q.current_row_count(
            t["stg_stations"], t["station_current"], "station_id", "station"
        ),
        "arc_status_row_count": q.current_row_count(
            t["stg_road_traffic"], t["arc_current"], "arc_id", "arc"
        ),
        "station_daily_matches_fact": q.station_daily_mismatch(
            t["fct_station_status"], t["agg_station_daily"]
        ),
        "arc_daily_matches_fact": q.arc_daily_mismatch(
            t["fct_road_traffic"], t["agg_road_traffic_daily"], as_of
        ),
        "station_daily_consistent": q.station_daily_inconsistent(t["agg_station_daily"]),
        "arc_daily_consistent": q.arc_daily_inconsistent(
            t["agg_road_traffic_daily"],
            list(arcs.TRAFFIC_COUNTERS.values()),
            list(arcs.ARC_COUNTERS.values()),
        ),
    }
    warn_only = {"bikes_under_capacity"}
    return {n: (df, "warn" if n in warn_only else "error") for n, df in checks.items()}


def check_plan(t: Mapping[str, DataFrame], as_of: datetime | None = None) -> CheckPlan:
    """Declared and business checks of the tables in ``t``, compiled to one pass over each."""
    plan = CheckPlan()
    for name, declared in DECLARED.items():
        if name in t and all(p in t for p in declared.parents.values()):
            plan.declare(name, declared)
    traffic, arc = list(arcs.TRAFFIC_COUNTERS.values()), list(arcs.ARC_COUNTERS.values())
    plan.row_check("bike_breakdown_matches_total", "fct_station_status", q.breakdown_differs())
    plan.row_check("bikes_under_capacity", "fct_station_status", q.exceeds_capacity(), "warn")
    plan.row_check("non_negative_availability", "fct_station_status", q.below_zero())
    plan.row_check("valid_station_coordinates", "dim_stations", q.off_the_globe())
    plan.row_check("valid_traffic_measurements", "fct_road_traffic", q.out_of_measure())
    plan.row_check("station_daily_consistent", "agg_station_daily", q.station_day_wrong())
    plan.row_check("arc_daily_consistent", "agg_road_traffic_daily", q.arc_day_wrong(traffic, arc))
    for name, staged, current, entity in (
        ("station_status_row_count", "stg_stations", "station_current", "station_id"),
        ("arc_status_row_count", "stg_road_traffic", "arc_current", "arc_id"),
    ):
        sides = [(staged, KeySide(name, (F.col(entity),))), (current, KeySide(name, (F.lit(""),), right=True))]
        plan.key_check(name, COUNT, sides)
    name, n = "station_daily_matches_fact", "observation_count"
    fact, daily = t["fct_station_status"], t["agg_station_daily"]
    sides = [
        ("fct_station_status", KeySide(name, (F.col("station_id"), day_in(fact, "status_updated_at")), measures=(F.lit(1),))),
        ("agg_station_daily", KeySide(name, (F.col("station_id"), F.col("observation_date")), True, (F.col(n),))),
    ]
    plan.key_check(name, PRESENT, sides)
    name, since = "arc_daily_matches_fact", q.kept_since(as_of)
    fact = t["fct_road_traffic"]
    day = day_in(fact, "observed_at")
    measured = (F.lit(1), F.col("vehicle_flow").isNotNull().cast("int"), F.col("occupancy_rate").isNotNull().cast("int"))
    stored = (F.col(n), *[F.col(c) for c in q.MEASURED])
    sides = [
        ("fct_road_traffic", KeySide(name, (F.col("arc_id"), day), False, measured, day > since)),
        ("agg_road_traffic_daily", KeySide(name, (F.col("arc_id"), F.col("observation_date")), True, stored, F.col("observation_date") > since)),
    ]
    plan.key_check(name, EQUAL, sides)
    return plan


def day_in(fact: DataFrame, ts: str) -> Column:
    return F.col("observation_date") if "observation_date" in fact.columns else day_of(ts)


def run_all_checks(t: Mapping[str, DataFrame], as_of: datetime | None = None) -> DataFrame:
    """Every declared and business check whose tables are present in ``t``."""
    return check_plan(t, as_of).results(t)
