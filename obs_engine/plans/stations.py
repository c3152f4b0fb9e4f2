"""Bike-share stations: records, staging, dimension, fact, daily aggregate, status."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.functions.keys import surrogate_key, time_text
from obs_engine.functions.metrics import (
    data_age_minutes,
    flag,
    instant,
    is_fresh,
    mean2,
    occupancy_pct,
    station_status,
)
from obs_engine.functions.parsing import json_or_text
from obs_engine.operators.aggregates import daily_aggregate
from obs_engine.operators.dedup import latest_per_key, latest_with_span, one_row_per_key
from obs_engine.operators.merge import TableSpec, by_bucket, by_day
from obs_engine.schemas import STATION_RAW

# API field -> raw column, where the value is taken over as it is.
_FIELDS = {
    "stationcode": "stationcode",
    "name": "name",
    "is_installed": "is_installed",
    "capacity": "capacity",
    "numdocksavailable": "num_docks_available",
    "numbikesavailable": "num_bikes_available",
    "mechanical": "mechanical",
    "ebike": "ebike",
    "is_renting": "is_renting",
    "is_returning": "is_returning",
    "nom_arrondissement_communes": "nom_arrondissement_communes",
    "code_insee_commune": "code_insee_commune",
}

# Raw column -> staging column, where only the name changes.
_RENAMED = {
    "stationcode": "station_id",
    "name": "station_name",
    "capacity": "total_capacity",
    "num_docks_available": "docks_available",
    "num_bikes_available": "bikes_available",
    "mechanical": "mechanical_bikes",
    "ebike": "electric_bikes",
    "nom_arrondissement_communes": "commune",
    "code_insee_commune": "insee_code",
    "lon": "longitude",
    "lat": "latitude",
}

DESCRIPTION = (
    "station_name", "is_installed", "total_capacity", "commune", "insee_code",
    "longitude", "latitude",
)

RAW = TableSpec(
    "raw_stations", ("stationcode", "last_reported"), by_day("last_reported"),
)
DIM = TableSpec("dim_stations", ("station_id",), by_bucket("station_id"))
FACT = TableSpec(
    "fct_station_status", ("observation_id",), by_day("status_updated_at"),
    sort=("station_id", "status_updated_at"), protected=True, lookup=("station_id",),
)
DAILY = TableSpec(
    "agg_station_daily", ("daily_station_id",), by_day("observation_date", column="observation_date"),
    sort=("station_id",), protected=True,
)


def transform_station(records: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    """API records to typed raw rows (P1). A coordinate that is no object reads as NULL."""
    point = F.col("coordonnees_geo")
    out = records.select(
        *[F.col(field).alias(raw) for field, raw in _FIELDS.items()],
        # The offset is applied, then the UTC wall clock is kept without a zone.
        F.col("duedate").try_cast("timestamp").cast("timestamp_ntz").alias("last_reported"),
        F.get_json_object(point, "$.lon").try_cast("double").alias("lon"),
        F.get_json_object(point, "$.lat").try_cast("double").alias("lat"),
        json_or_text("station_opening_hours").alias("station_opening_hours"),
        instant(ingested_at).cast("timestamp_ntz").alias("ingested_at"),
    )
    return out.select(*STATION_RAW.fieldNames())


def named_stations(raw: DataFrame) -> DataFrame:
    """Renamed and flagged raw rows, duplicates included."""
    named = raw.filter(F.col("stationcode").isNotNull()).select(
        *[F.col(old).alias(new) for old, new in _RENAMED.items()],
        flag("is_installed").alias("is_installed"),
        flag("is_renting").alias("is_renting_active"),
        flag("is_returning").alias("is_returning_active"),
        F.col("last_reported").cast("timestamp_ntz").alias("status_updated_at"),
        F.col("ingested_at").cast("timestamp_ntz").alias("loaded_at"),
    )
    return named.select(
        "station_id", "station_name", "is_installed", "total_capacity", "docks_available",
        "bikes_available", "mechanical_bikes", "electric_bikes", "is_renting_active",
        "is_returning_active", "commune", "insee_code", "longitude", "latitude",
        "status_updated_at", "loaded_at",
    )


def stage_stations(raw: DataFrame) -> DataFrame:
    """One row per station and instant, the latest loaded one."""
    return one_row_per_key(
        named_stations(raw), ["station_id", "status_updated_at"], ["loaded_at"]
    )


def station_dim(staged: DataFrame) -> DataFrame:
    """Latest *ingested* description per station, with first and last load."""
    latest = latest_with_span(
        staged,
        ["station_id"],
        ["loaded_at", "status_updated_at"],
        {"loaded_at": ("first_seen_at", "last_seen_at")},
        keep=["station_id", *DESCRIPTION, "status_updated_at"],
    )
    return latest.select(
        "station_id", *DESCRIPTION, "first_seen_at", "last_seen_at",
        F.col("status_updated_at").alias("source_updated_at"),
    )


def station_fact(staged: DataFrame) -> DataFrame:
    """Observation key, occupancy and status label."""
    measured = staged.withColumn(
        "occupancy_rate_percent", occupancy_pct("bikes_available", "total_capacity")
    )
    return measured.select(
        surrogate_key("station_id", time_text("status_updated_at", zoned=False)).alias(
            "observation_id"
        ),
        "station_id", "station_name", "is_installed", "bikes_available", "mechanical_bikes",
        "electric_bikes", "docks_available", "total_capacity", "is_renting_active",
        "is_returning_active", "commune", "insee_code", "longitude", "latitude",
        "occupancy_rate_percent",
        station_status("is_installed", "is_renting_active", "occupancy_rate_percent").alias(
            "station_status"
        ),
        "status_updated_at", "loaded_at",
    )


def fact_of_raw(raw: DataFrame) -> DataFrame:
    """Raw rows of one load, or of all, to fact rows."""
    return station_fact(stage_stations(raw))


def station_daily(fact: DataFrame) -> DataFrame:
    """Daily availability per station (A1)."""
    whole = lambda c: F.col(c).cast("decimal(10,0)")
    daily = daily_aggregate(
        fact,
        "station_id",
        "status_updated_at",
        measures={
            "average_bikes_available": mean2(whole("bikes_available")),
            "minimum_bikes_available": F.min("bikes_available"),
            "maximum_bikes_available": F.max("bikes_available"),
            "average_docks_available": mean2(whole("docks_available")),
            "average_occupancy_rate_percent": mean2("occupancy_rate_percent"),
            "first_observed_at": F.min("status_updated_at"),
            "last_observed_at": F.max("status_updated_at"),
            "last_loaded_at": F.max("loaded_at"),
        },
        buckets={
            "empty_observation_count": F.col("bikes_available") == 0,
            "no_dock_observation_count": F.col("docks_available") == 0,
            "out_of_service_observation_count": F.col("station_status") == "Hors service",
            "capacity_anomaly_count": F.col("bikes_available") > F.col("total_capacity"),
        },
    )
    key = surrogate_key("station_id", "observation_date").alias("daily_station_id")
    return daily.select(
        key, "station_id", "observation_date", "observation_count", "average_bikes_available",
        "minimum_bikes_available", "maximum_bikes_available", "average_docks_available",
        "average_occupancy_rate_percent", "empty_observation_count", "no_dock_observation_count",
        "out_of_service_observation_count", "capacity_anomaly_count", "first_observed_at",
        "last_observed_at", "last_loaded_at",
    )


def station_current(rows: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Latest observed status per station, with its age.

    ``rows`` may still hold duplicates: the latest instant and then the latest
    load is the row that staging would have kept, so the view is taken straight
    from ``named_stations`` without the staging shuffle. Keys and labels are
    computed on one row per station.
    """
    latest = latest_per_key(rows, ["station_id"], ["status_updated_at", "loaded_at"])
    return station_fact(latest).withColumns(
        {
            "data_age_minutes": data_age_minutes("loaded_at", as_of),
            "is_fresh": is_fresh("loaded_at", as_of),
        }
    )
