"""Explicit schemas of API records, raw tables and run logs; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_TYPES = {
    "STRING": StringType(),
    "INT": IntegerType(),
    "DOUBLE": DoubleType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
    "TIMESTAMP_NTZ": TimestampNTZType(),
    "EXACT": DecimalType(28, 12),
    "SECONDS": DecimalType(12, 3),
}


def _struct(columns: str) -> StructType:
    """``name TYPE [NOT NULL], ...``, readable without a running session."""
    fields = []
    for column in columns.split(","):
        name, kind, *rest = column.split()
        fields.append(StructField(name, _TYPES[kind], nullable=not rest))
    return StructType(fields)


STATION_RECORD = _struct(
    "stationcode STRING, name STRING, is_installed STRING, capacity INT, numdocksavailable INT, "
    "numbikesavailable INT, mechanical INT, ebike INT, is_renting STRING, is_returning STRING, "
    "duedate STRING, coordonnees_geo STRING, nom_arrondissement_communes STRING, "
    "code_insee_commune STRING, station_opening_hours STRING"
)

ARC_RECORD = _struct(
    "iu_ac STRING, libelle STRING, t_1h STRING, q STRING, k STRING, etat_trafic STRING, "
    "etat_barre STRING, iu_nd_amont STRING, libelle_nd_amont STRING, iu_nd_aval STRING, "
    "libelle_nd_aval STRING, date_debut STRING, date_fin STRING, geo_point_2d STRING, "
    "geo_shape STRING"
)

STATION_RAW = _struct(
    "stationcode STRING NOT NULL, name STRING, is_installed STRING, capacity INT, "
    "num_docks_available INT, num_bikes_available INT, mechanical INT, ebike INT, "
    "is_renting STRING, is_returning STRING, last_reported TIMESTAMP_NTZ NOT NULL, lon DOUBLE, "
    "lat DOUBLE, nom_arrondissement_communes STRING, code_insee_commune STRING, "
    "station_opening_hours STRING, ingested_at TIMESTAMP_NTZ NOT NULL"
)

ARC_RAW = _struct(
    "arc_id STRING NOT NULL, arc_label STRING, observed_at TIMESTAMP NOT NULL, "
    "vehicle_flow EXACT, occupancy_rate EXACT, traffic_status STRING, arc_status STRING, "
    "upstream_node_id STRING, upstream_node_label STRING, downstream_node_id STRING, "
    "downstream_node_label STRING, source_start_date DATE, source_end_date DATE, "
    "longitude DOUBLE, latitude DOUBLE, geo_shape STRING, ingested_at TIMESTAMP NOT NULL, "
    "source_run_id STRING NOT NULL"
)

STATION_RUN = _struct(
    "run_id STRING NOT NULL, dag_id STRING NOT NULL, task_id STRING NOT NULL, "
    "started_at TIMESTAMP NOT NULL, finished_at TIMESTAMP NOT NULL, status STRING NOT NULL, "
    "pages_fetched INT, reported_total INT, records_received INT, records_inserted INT, "
    "duplicates_ignored INT, duration_seconds SECONDS, error_message STRING, "
    "created_at TIMESTAMP"
)

ARC_RUN = _struct(
    "run_key STRING NOT NULL, airflow_run_id STRING NOT NULL, dag_id STRING NOT NULL, "
    "task_id STRING NOT NULL, started_at TIMESTAMP NOT NULL, finished_at TIMESTAMP NOT NULL, "
    "status STRING NOT NULL, window_start TIMESTAMP, window_end TIMESTAMP, "
    "watermark_before TIMESTAMP, pages_fetched INT, reported_total INT, records_received INT, "
    "records_inserted INT, records_updated INT, records_unchanged INT, "
    "duration_seconds SECONDS, error_message STRING"
)

# Columns that say when and by whom a row was loaded; a change in them alone is no change.
LOAD_COLUMNS = ("ingested_at", "source_run_id")

# Labels published by the feeds and stored in the run logs.
TRAFFIC_STATUSES = ("Fluide", "Pré-saturé", "Saturé", "Bloqué", "Inconnu")
CONGESTED_STATUSES = ("Saturé", "Bloqué")
ARC_STATUSES = ("Ouvert", "Barré", "Invalide")
RUN_STATUSES = ("success", "failed")
STATION_FEED_LABEL = "Vélib"
ARC_FEED_LABEL = "Trafic routier"
STATION_RUN_PREFIX = "velib::"
ARC_RUN_PREFIX = "traffic::"
