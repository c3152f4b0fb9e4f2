"""Road arcs: records, staging, dimension, fact, daily aggregate, status."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.functions.keys import surrogate_key, time_text
from obs_engine.functions.metrics import data_age_minutes, has_any, instant, is_fresh, mean2
from obs_engine.functions.parsing import (
    canonical_json,
    non_blank,
    parse_date,
    parse_decimal,
    parse_point,
    parse_ts,
)
from obs_engine.operators.aggregates import daily_aggregate, status_buckets
from obs_engine.operators.dedup import latest_per_key, latest_with_span
from obs_engine.operators.merge import TableSpec, by_bucket, by_day
from obs_engine.schemas import ARC_RAW, LOAD_COLUMNS

KEY = ("arc_id", "observed_at")
COMPARED = tuple(c for c in ARC_RAW.fieldNames() if c not in (*KEY, *LOAD_COLUMNS))

DESCRIPTION = (
    "arc_label", "upstream_node_id", "upstream_node_label", "downstream_node_id",
    "downstream_node_label", "source_start_date", "source_end_date", "longitude", "latitude",
    "geo_shape",
)

# Status label -> daily counter.
TRAFFIC_COUNTERS = {
    "Fluide": "fluid_observation_count",
    "Pré-saturé": "pre_saturated_observation_count",
    "Saturé": "saturated_observation_count",
    "Bloqué": "blocked_observation_count",
    "Inconnu": "unknown_observation_count",
}
ARC_COUNTERS = {
    "Ouvert": "open_arc_observation_count",
    "Barré": "closed_arc_observation_count",
    "Invalide": "invalid_arc_observation_count",
}

RAW = TableSpec("raw_road_traffic", KEY, by_day("observed_at"))
DIM = TableSpec("dim_road_arcs", ("arc_id",), by_bucket("arc_id"))
FACT = TableSpec(
    "fct_road_traffic", ("observation_id",), by_day("observed_at"),
    sort=KEY, protected=True, lookup=("arc_id",),
)
DAILY = TableSpec(
    "agg_road_traffic_daily", ("daily_traffic_id",), by_day("observation_date", column="observation_date"),
    sort=("arc_id",), protected=True,
)


def parse_arcs(
    records: DataFrame, ingested_at: datetime | None, run_id: str
) -> DataFrame:
    """API records to typed raw rows plus ``reject_reasons``.

    Lineage columns of the records are kept, so a last-wins dedup can follow.
    """
    if not run_id:
        raise ValueError("a run id is required")
    if ingested_at is not None and ingested_at.tzinfo is None:
        raise ValueError("the ingestion time must carry a time zone")
    seen_at = parse_ts("t_1h")
    flow, occupancy = parse_decimal("q"), parse_decimal("k")
    start, end = parse_date("date_debut"), parse_date("date_fin")
    shape = canonical_json("geo_shape")
    point = F.col("geo_point_2d")
    absent = point.isNull() | (point == "")
    lon, lat, bad_point = parse_point(
        F.get_json_object(point, "$.lon"), F.get_json_object(point, "$.lat")
    )
    bad_point = ~absent & (bad_point | ~point.rlike(r"^\s*\{"))
    faults = {
        "arc identifier": non_blank("iu_ac").isNull(),
        "timestamp": seen_at.bad,
        "vehicle_flow": flow.bad,
        "occupancy_rate": occupancy.bad,
        "source_start_date": start.bad,
        "source_end_date": end.bad,
        "coordinates": bad_point,
        "geo_shape": shape.bad,
    }
    lineage = [c for c in ("chunk_no", "offset", "pos") if c in records.columns]
    return records.select(
        *lineage,
        F.col("iu_ac").alias("arc_id"),
        F.col("libelle").alias("arc_label"),
        seen_at.value.alias("observed_at"),
        flow.value.alias("vehicle_flow"),
        occupancy.value.alias("occupancy_rate"),
        F.col("etat_trafic").alias("traffic_status"),
        F.col("etat_barre").alias("arc_status"),
        non_blank("iu_nd_amont").alias("upstream_node_id"),
        F.col("libelle_nd_amont").alias("upstream_node_label"),
        non_blank("iu_nd_aval").alias("downstream_node_id"),
        F.col("libelle_nd_aval").alias("downstream_node_label"),
        start.value.alias("source_start_date"),
        end.value.alias("source_end_date"),
        lon.alias("longitude"),
        lat.alias("latitude"),
        shape.value.alias("geo_shape"),
        instant(ingested_at).alias("ingested_at"),
        F.lit(run_id).alias("source_run_id"),
        F.array_compact(
            F.array(*[F.when(bad, F.lit(name)) for name, bad in faults.items()])
        ).alias("reject_reasons"),
    )


def stage_arcs(raw: DataFrame) -> DataFrame:
    """Observation key and presence flags (P11-P13); raw is unique on its key."""
    columns = [c for c in ARC_RAW.fieldNames() if c not in LOAD_COLUMNS]
    return raw.select(
        surrogate_key("arc_id", time_text("observed_at", zoned=True)).alias("observation_id"),
        *columns,
        has_any("vehicle_flow").alias("has_vehicle_flow"),
        has_any("occupancy_rate").alias("has_occupancy_rate"),
        has_any("vehicle_flow", "occupancy_rate").alias("has_traffic_measurement"),
        F.col("ingested_at").alias("loaded_at"),
        "source_run_id",
    )


def arc_dim(staged: DataFrame) -> DataFrame:
    """Latest *observed* description per arc, with first and last times."""
    return latest_with_span(
        staged,
        ["arc_id"],
        ["observed_at", "loaded_at"],
        {
            "observed_at": ("first_observed_at", "last_observed_at"),
            "loaded_at": ("first_loaded_at", "last_loaded_at"),
        },
        keep=["arc_id", *DESCRIPTION],
    )


def arc_fact(staged: DataFrame) -> DataFrame:
    """The fact holds the staging columns unchanged."""
    return staged


def arc_daily(fact: DataFrame) -> DataFrame:
    """Daily flow, occupancy and status counters per arc (A2)."""
    daily = daily_aggregate(
        fact,
        "arc_id",
        "observed_at",
        measures={
            "vehicle_flow_observation_count": F.count("vehicle_flow"),
            "occupancy_observation_count": F.count("occupancy_rate"),
            "average_vehicle_flow": mean2("vehicle_flow"),
            "maximum_vehicle_flow": F.max("vehicle_flow"),
            "average_occupancy_rate": mean2("occupancy_rate"),
            "maximum_occupancy_rate": F.max("occupancy_rate"),
            "first_observed_at": F.min("observed_at"),
            "last_observed_at": F.max("observed_at"),
            "last_loaded_at": F.max("loaded_at"),
        },
        buckets={
            **status_buckets(
                "traffic_status", TRAFFIC_COUNTERS, TRAFFIC_COUNTERS["Inconnu"]
            ),
            **status_buckets("arc_status", ARC_COUNTERS, ARC_COUNTERS["Invalide"]),
        },
    )
    key = surrogate_key("arc_id", "observation_date").alias("daily_traffic_id")
    return daily.select(
        key, "arc_id", "observation_date", "observation_count", "vehicle_flow_observation_count",
        "occupancy_observation_count", "average_vehicle_flow", "maximum_vehicle_flow",
        "average_occupancy_rate", "maximum_occupancy_rate", *TRAFFIC_COUNTERS.values(),
        *ARC_COUNTERS.values(), "first_observed_at", "last_observed_at", "last_loaded_at",
    )


def arc_current(staged: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Latest observation per arc, with its age."""
    latest = latest_per_key(staged, ["arc_id"], ["observed_at", "loaded_at"])
    return latest.withColumns(
        {
            "data_age_minutes": data_age_minutes("loaded_at", as_of),
            "is_fresh": is_fresh("loaded_at", as_of),
        }
    )
