"""Dashboard queries over the five served tables.

Each takes the dataset, optional multi-select ``filters`` (column -> values, an
empty list selects everything; this is also how cross-filtering works) and
returns one small DataFrame from one Spark job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.functions.clock import clock, first_day_from, months_before
from obs_engine.functions.metrics import success_pct, weighted_mean
from obs_engine.operators.aggregates import (
    case_sum,
    pivot_series,
    series,
    share_of_total,
    top_k,
)
from obs_engine.schemas import ARC_FEED_LABEL, CONGESTED_STATUSES, STATION_FEED_LABEL

Filters = Mapping[str, Sequence] | None

# Fixed value: length of the report of newest runs.
LATEST_RUNS = 20

LATEST_RUN_COLUMNS = (
    "pipeline_name", "started_at", "status", "records_received", "records_inserted",
    "records_updated", "records_unchanged", "duration_seconds", "records_per_second",
)


def select(df: DataFrame, filters: Filters = None) -> DataFrame:
    """Multi-select filters."""
    for column, values in (filters or {}).items():
        if values:
            df = df.filter(F.col(column).isin(*values))
    return df


def last_month(df: DataFrame, day: str, as_of: datetime | None = None) -> DataFrame:
    """Days in ``[as_of - 1 month, as_of)`` (P24); literal bounds prune partitions."""
    now = clock(as_of)
    low, high = first_day_from(months_before(now, 1)), first_day_from(now)
    return df.filter((F.col(day) >= F.lit(low)) & (F.col(day) < F.lit(high)))


def located_only(df: DataFrame) -> DataFrame:
    """Rows that can be put on a map (P25)."""
    return df.dropna(subset=["longitude", "latitude"])


def exact_mean(c: str) -> Column:
    """Unrounded mean of an exact column: exact sum, one division."""
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))


# -- runs ---------------------------------------------------------------------


def success_rate(runs: DataFrame, filters: Filters = None) -> DataFrame:
    """K1"""
    return select(runs, filters).agg(success_pct("is_success").alias("success_rate_percent"))


def run_count(runs: DataFrame, filters: Filters = None) -> DataFrame:
    """K2"""
    return select(runs, filters).agg(F.count(F.lit(1)).alias("run_count"))


def average_duration(runs: DataFrame, filters: Filters = None) -> DataFrame:
    """K3"""
    mean = F.round(F.avg("duration_seconds"), 2).cast("decimal(18,2)")
    return select(runs, filters).agg(mean.alias("average_duration_seconds"))


def records_received(runs: DataFrame, filters: Filters = None) -> DataFrame:
    """K4"""
    return select(runs, filters).agg(F.sum("records_received").alias("records_received"))


def duration_series(runs: DataFrame, filters: Filters = None) -> DataFrame:
    """Mean duration per minute, one column per feed (K5)."""
    return pivot_series(
        select(runs, filters), "started_at", "minute", "pipeline_name",
        [STATION_FEED_LABEL, ARC_FEED_LABEL], exact_mean("duration_seconds"),
    )


def volumes(runs: DataFrame, filters: Filters = None) -> DataFrame:
    """Received, inserted and unchanged records per feed (K6)."""
    names = ("records_received", "records_inserted", "records_unchanged")
    return (
        select(runs, filters)
        .groupBy("pipeline_name")
        .agg(*[F.sum(n).alias(n) for n in names])
        .orderBy("pipeline_name")
    )


def latest_runs(runs: DataFrame, filters: Filters = None, n: int = LATEST_RUNS) -> DataFrame:
    """Newest runs first (K7, L1)."""
    ties = ["pipeline_run_id"]
    newest = top_k(select(runs, filters).select(*LATEST_RUN_COLUMNS, *ties), "started_at", n, ties)
    return newest.select(*LATEST_RUN_COLUMNS)


def failed_runs(runs: DataFrame, run_id: str = "run_id") -> DataFrame:
    """Failed runs, newest first."""
    return runs.filter(~F.col("is_success")).orderBy(F.desc_nulls_first("started_at"), run_id)


def success_rate_by_cast(runs: DataFrame) -> DataFrame:
    """Success rate through ``avg(is_success::int)``."""
    ok = F.avg(F.col("is_success").cast("int").cast("decimal(10,0)"))
    return runs.agg(F.round(ok * 100, 2).cast("decimal(18,2)").alias("success_rate_percent"))


# -- stations -----------------------------------------------------------------


def station_count(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K8"""
    return select(current, filters).agg(F.count_distinct("station_id").alias("station_count"))


def bikes_now(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K9"""
    return select(current, filters).agg(F.sum("bikes_available").alias("bikes_available"))


def docks_now(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K10"""
    return select(current, filters).agg(F.sum("docks_available").alias("docks_available"))


def empty_stations(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K11"""
    return select(current, filters).agg(
        case_sum(F.col("bikes_available") == 0).alias("empty_stations")
    )


def stations_by_status(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K12"""
    return share_of_total(
        select(current, filters), "station_status", F.count_distinct("station_id"),
        "station_count",
    )


def station_points(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K13"""
    return (
        located_only(select(current, filters))
        .select("station_id", "longitude", "latitude", "station_status", "station_name",
                "docks_available", "bikes_available")
        .orderBy("station_id")
    )


def bikes_per_day(
    daily: DataFrame, as_of: datetime | None = None, filters: Filters = None
) -> DataFrame:
    """Mean of the daily means over the last month."""
    recent = last_month(select(daily, filters), "observation_date", as_of)
    return series(
        recent, "observation_date", "day", exact_mean("average_bikes_available"),
        "average_bikes_available",
    )


def station_history(fact: DataFrame, station_id: str, n: int = 100) -> DataFrame:
    """One station's observations, newest first."""
    return top_k(
        fact.filter(F.col("station_id") == station_id), "status_updated_at", n, ["observation_id"]
    )


# -- arcs ---------------------------------------------------------------------


def arc_count(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K15"""
    return select(current, filters).agg(F.count_distinct("arc_id").alias("arc_count"))


def mean_flow(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K16"""
    return select(current, filters).agg(exact_mean("vehicle_flow").alias("mean_vehicle_flow"))


def mean_occupancy(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K17"""
    return select(current, filters).agg(exact_mean("occupancy_rate").alias("mean_occupancy_rate"))


def congested_arcs(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K18"""
    congested = select(current, {"traffic_status": CONGESTED_STATUSES})
    return select(congested, filters).agg(F.count_distinct("arc_id").alias("congested_arcs"))


def arcs_by_status(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K19"""
    return share_of_total(
        select(current, filters), "traffic_status", F.count_distinct("arc_id"), "arc_count"
    )


def arc_points(current: DataFrame, filters: Filters = None) -> DataFrame:
    """K20"""
    return (
        located_only(select(current, filters))
        .select("arc_id", "longitude", "latitude", "traffic_status", "arc_label", "arc_status",
                "vehicle_flow", "occupancy_rate")
        .orderBy("arc_id")
    )


def flow_per_day(
    daily: DataFrame, as_of: datetime | None = None, filters: Filters = None
) -> DataFrame:
    """Observation-weighted daily flow over the last month."""
    recent = last_month(select(daily, filters), "observation_date", as_of)
    return series(
        recent, "observation_date", "day",
        weighted_mean("average_vehicle_flow", "vehicle_flow_observation_count"),
        "mean_daily_flow",
    )
