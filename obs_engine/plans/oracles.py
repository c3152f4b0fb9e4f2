"""DuckDB SQL that states the expected result of the registered queries.

Each oracle is a final SELECT over named common table expressions; ``build``
adds the ones a query needs. Exact decimals are handled as scaled integers so
that rounding is half up on both sides. Times and dates are rendered as text.
"""

from __future__ import annotations

import re

ARC_NOW = "TIMESTAMP '2024-01-31 06:00:00'"
STATION_NOW = "TIMESTAMP '2001-12-01 00:00:00'"
RUN_NOW = "TIMESTAMP '2001-08-15 00:00:00'"


def half_up(n: str, d: str) -> str:
    """round(n / d) for integers, half away from zero, as an integer."""
    return f"(sign({n}) * ((2 * abs({n}) + ({d})) // (2 * ({d}))))"


def two(n: str, d: str) -> str:
    """n / d rounded to two decimals, as DOUBLE; n and d are integers."""
    return f"({half_up(f'100 * ({n})', d)}::DOUBLE / 100)"


def pct(n: str, d: str) -> str:
    return f"(CASE WHEN {d} > 0 THEN {two(f'100 * ({n})', d)} ELSE 0.0::DOUBLE END)"


def text(*names: str) -> str:
    """Columns rendered as text under their own names."""
    return ", ".join(f"{n}::VARCHAR AS {n}" for n in names)


def age(loaded: str, now: str) -> str:
    return two(f"epoch_us({now}) - epoch_us({loaded})", "60000000")


TRAFFIC = {
    "fluid_observation_count": "traffic_status = 'Fluide'",
    "pre_saturated_observation_count": "traffic_status = 'Pré-saturé'",
    "saturated_observation_count": "traffic_status = 'Saturé'",
    "blocked_observation_count": "traffic_status = 'Bloqué'",
    "unknown_observation_count": "coalesce(traffic_status, 'Inconnu') = 'Inconnu'",
    "open_arc_observation_count": "arc_status = 'Ouvert'",
    "closed_arc_observation_count": "arc_status = 'Barré'",
    "invalid_arc_observation_count": "coalesce(arc_status, 'Invalide') = 'Invalide'",
}
_counters = ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in TRAFFIC.items())

STATUS_CASE = """CASE WHEN NOT is_installed THEN 'Non installée'
     WHEN NOT is_renting_active THEN 'Hors service'
     WHEN occ = 0 THEN 'Vide' WHEN occ >= 9000 THEN 'Presque pleine'
     WHEN occ <= 1500 THEN 'Presque vide' ELSE 'Normal' END"""

ARC_DESCRIPTION = (
    "arc_label, upstream_node_id, upstream_node_label, downstream_node_id, "
    "downstream_node_label, source_start_date::VARCHAR AS source_start_date, "
    "source_end_date::VARCHAR AS source_end_date, longitude, latitude, geo_shape"
)

CTES: dict[str, str] = {
    # flow100 and occ10 are the exact measures in hundredths and tenths
    "arc_base": """
SELECT event_id, user_id::VARCHAR AS arc_id, 'arc ' || user_id AS arc_label, ts AS observed_at,
  CASE WHEN event_id % 7 <> 0 THEN round(value * 100)::BIGINT END AS flow100,
  CASE WHEN event_id % 11 <> 0
       THEN regexp_extract(props, '"k": ([0-9]+)', 1)::BIGINT * 11 END AS occ10,
  CASE event_type WHEN 'click' THEN 'Fluide' WHEN 'view' THEN 'Pré-saturé'
       WHEN 'purchase' THEN 'Saturé' WHEN 'error' THEN 'Bloqué'
       ELSE CASE WHEN event_id % 2 = 0 THEN 'Inconnu' END END AS traffic_status,
  CASE event_id % 5 WHEN 0 THEN 'Barré' WHEN 1 THEN 'Invalide' WHEN 2 THEN NULL
       ELSE 'Ouvert' END AS arc_status,
  (user_id * 2)::VARCHAR AS upstream_node_id, 'node ' || user_id * 2 AS upstream_node_label,
  CASE WHEN user_id % 9 <> 0 THEN (user_id * 2 + 1)::VARCHAR END AS downstream_node_id,
  'node ' || CASE WHEN user_id % 9 <> 0 THEN user_id * 2 + 1 END AS downstream_node_label,
  DATE '2020-01-01' + (user_id % 365)::INT AS source_start_date,
  DATE '2020-01-01' + (user_id % 365)::INT + 1000 AS source_end_date,
  CASE WHEN user_id % 50 <> 0 THEN 2::DOUBLE + (user_id % 1000) / 1000::DOUBLE END AS longitude,
  CASE WHEN user_id % 50 <> 0 THEN 48::DOUBLE + (user_id % 700) / 1000::DOUBLE END AS latitude,
  '{"coordinates":[' || user_id % 1000 || ',' || user_id % 700 || '],"type":"Point"}' AS geo_shape,
  ts + to_hours((event_id % 5)::INT) AS ingested_at, 'run-' || event_id % 24 AS source_run_id
FROM events""",
    "arc_batch": f"""
SELECT * REPLACE (
  CASE WHEN event_id % 10 = 0 THEN coalesce(flow100, 0) + 100 ELSE flow100 END AS flow100,
  CASE WHEN event_id % 10 = 1 THEN observed_at + INTERVAL 1 HOUR ELSE observed_at END AS observed_at,
  {ARC_NOW} AS ingested_at, 'run-late' AS source_run_id)
FROM arc_base""",
    "arc_upserted": """
SELECT o.* REPLACE (
  CASE WHEN b.flow100 IS DISTINCT FROM o.flow100 AND b.arc_id IS NOT NULL
       THEN b.flow100 ELSE o.flow100 END AS flow100,
  CASE WHEN b.flow100 IS DISTINCT FROM o.flow100 AND b.arc_id IS NOT NULL
       THEN b.ingested_at ELSE o.ingested_at END AS ingested_at,
  CASE WHEN b.flow100 IS DISTINCT FROM o.flow100 AND b.arc_id IS NOT NULL
       THEN b.source_run_id ELSE o.source_run_id END AS source_run_id)
FROM arc_base o LEFT JOIN arc_batch b USING (arc_id, observed_at)
UNION ALL
SELECT b.* FROM arc_batch b ANTI JOIN arc_base o USING (arc_id, observed_at)""",
    "arc_staged": """
SELECT md5(arc_id || '|' || observed_at::VARCHAR || '+00') AS observation_id,
  * EXCLUDE (ingested_at), flow100 IS NOT NULL AS has_vehicle_flow,
  occ10 IS NOT NULL AS has_occupancy_rate,
  coalesce(flow100, occ10) IS NOT NULL AS has_traffic_measurement, ingested_at AS loaded_at
FROM arc_base""",
    "arc_dim": """
SELECT arc_id, arg_max(s, (observed_at, loaded_at)) AS s, min(observed_at) AS first_observed_at,
  max(observed_at) AS last_observed_at, min(loaded_at) AS first_loaded_at,
  max(loaded_at) AS last_loaded_at
FROM arc_staged s GROUP BY arc_id""",
    "arc_daily": f"""
SELECT md5(arc_id || '|' || observed_at::DATE::VARCHAR) AS daily_traffic_id, arc_id,
  observed_at::DATE AS observation_date, count(*) AS observation_count,
  count(flow100) AS vehicle_flow_observation_count, count(occ10) AS occupancy_observation_count,
  {half_up('sum(flow100)', 'count(flow100)')}::BIGINT AS avg_flow100,
  max(flow100) AS max_flow100, {half_up('10 * sum(occ10)', 'count(occ10)')}::BIGINT AS avg_occ100,
  max(occ10) AS max_occ10, {_counters}, min(observed_at) AS first_observed_at,
  max(observed_at) AS last_observed_at, max(loaded_at) AS last_loaded_at
FROM arc_staged GROUP BY ALL""",
    "arc_current": """
SELECT * FROM arc_staged
QUALIFY row_number() OVER (PARTITION BY arc_id ORDER BY observed_at DESC, loaded_at DESC) = 1""",
    "station_raw": """
SELECT *, coalesce(capacity, 0) - num_bikes_available AS num_docks_available,
  last_reported + to_hours((l_orderkey % 5)::INT) AS ingested_at
FROM (SELECT l_orderkey, l_suppkey::VARCHAR AS stationcode, 'station ' || l_suppkey AS name,
  CASE WHEN l_suppkey % 20 = 0 THEN 'NON' ELSE 'OUI' END AS is_installed,
  CASE WHEN l_suppkey % 33 = 0 THEN NULL WHEN l_suppkey % 25 = 0 THEN 0
       ELSE 30 + l_suppkey % 25 END::INT AS capacity,
  l_quantity::INT - 1 AS num_bikes_available,
  CASE WHEN l_partkey % 13 <> 0
       THEN l_quantity::INT - 1 - (l_quantity::INT - 1) % 3 END AS mechanical,
  (l_quantity::INT - 1) % 3 AS ebike,
  CASE l_linenumber WHEN 7 THEN 'NON' WHEN 6 THEN NULL ELSE 'OUI' END AS is_renting,
  CASE WHEN l_returnflag = 'R' THEN 'NON' ELSE 'OUI' END AS is_returning,
  l_shipdate + to_hours((l_linenumber % 2 * 12)::INT) AS last_reported,
  CASE WHEN l_suppkey % 41 = 0 THEN 200::DOUBLE
       WHEN l_suppkey % 17 <> 0 THEN 2::DOUBLE + (l_suppkey % 1000) / 1000::DOUBLE END AS lon,
  CASE WHEN l_suppkey % 17 <> 0 THEN 48::DOUBLE + (l_suppkey % 700) / 1000::DOUBLE END AS lat,
  'commune ' || l_suppkey % 20 AS nom_arrondissement_communes,
  (75000 + l_suppkey % 20)::VARCHAR AS code_insee_commune
  FROM lineitem)""",
    "station_staged": """
SELECT stationcode AS station_id, name AS station_name, is_installed = 'OUI' AS is_installed,
  capacity AS total_capacity, num_docks_available AS docks_available,
  num_bikes_available AS bikes_available, mechanical AS mechanical_bikes, ebike AS electric_bikes,
  coalesce(is_renting, '') = 'OUI' AS is_renting_active, is_returning = 'OUI' AS is_returning_active,
  nom_arrondissement_communes AS commune, code_insee_commune AS insee_code, lon AS longitude,
  lat AS latitude, last_reported AS status_updated_at, ingested_at AS loaded_at
FROM station_raw
QUALIFY row_number() OVER (PARTITION BY stationcode, last_reported
  ORDER BY ingested_at DESC, num_docks_available DESC, num_bikes_available DESC,
    mechanical DESC NULLS LAST, ebike DESC, coalesce(is_renting, '') = 'OUI' DESC,
    is_returning = 'OUI' DESC) = 1""",
    "station_dim": """
SELECT station_id, arg_max(s, (loaded_at, status_updated_at)) AS s,
  min(loaded_at) AS first_seen_at, max(loaded_at) AS last_seen_at
FROM station_staged s GROUP BY station_id""",
    # occ is the occupancy rate in hundredths of a percent
    "station_fact": f"""
SELECT *, {STATUS_CASE} AS station_status
FROM (SELECT *, md5(station_id || '|' || status_updated_at::VARCHAR) AS observation_id,
  CASE WHEN total_capacity > 0
       THEN {half_up('10000 * bikes_available', 'total_capacity')} ELSE 0 END::BIGINT AS occ
  FROM station_staged)""",
    "station_daily": f"""
SELECT md5(station_id || '|' || status_updated_at::DATE::VARCHAR) AS daily_station_id, station_id,
  status_updated_at::DATE AS observation_date, count(*) AS observation_count,
  {two('sum(bikes_available)', 'count(bikes_available)')} AS average_bikes_available,
  min(bikes_available) AS minimum_bikes_available, max(bikes_available) AS maximum_bikes_available,
  {two('sum(docks_available)', 'count(docks_available)')} AS average_docks_available,
  {half_up('sum(occ)', 'count(occ)')}::DOUBLE / 100 AS average_occupancy_rate_percent,
  count(*) FILTER (bikes_available = 0) AS empty_observation_count,
  count(*) FILTER (docks_available = 0) AS no_dock_observation_count,
  count(*) FILTER (station_status = 'Hors service') AS out_of_service_observation_count,
  count(*) FILTER (bikes_available > total_capacity) AS capacity_anomaly_count,
  min(status_updated_at) AS first_observed_at, max(status_updated_at) AS last_observed_at,
  max(loaded_at) AS last_loaded_at
FROM station_fact GROUP BY ALL""",
    "station_current": """
SELECT * FROM station_fact
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY status_updated_at DESC) = 1""",
    # ms is the duration in milliseconds
    "station_runs": f"""
SELECT *, ms::DOUBLE / 1000 AS duration_seconds,
  received - inserted - lost AS duplicates_ignored,
  CASE WHEN ms > 0 THEN {two('1000 * received', 'ms')} ELSE 0.0::DOUBLE END AS records_per_second,
  {pct('received - inserted - lost', 'received')} AS duplicate_rate_percent
FROM (SELECT 'run-' || o_orderkey AS run_id,
  o_orderdate + to_minutes((o_orderkey % 1440)::INT) AS started_at,
  (o_custkey * 37 + o_orderkey) % 9000 AS ms, o_orderstatus <> 'F' AS is_success,
  CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END AS status,
  o_custkey % 3000 // 100 + 1 AS pages_fetched, o_custkey % 3000 AS received,
  CASE WHEN o_orderstatus = 'F' THEN 0
       ELSE (o_custkey % 3000) * (o_orderkey % 4) // 3 END AS inserted,
  CASE WHEN o_orderstatus = 'F' THEN o_custkey % 3000 ELSE 0 END AS lost,
  CASE WHEN o_orderstatus = 'F' THEN 'timeout ' || o_orderpriority END AS error_message
  FROM orders)""",
    "arc_runs": f"""
SELECT *, ms::DOUBLE / 1000 AS duration_seconds, inserted + updated + unchanged AS classified,
  CASE WHEN ms > 0 THEN {two('1000 * received', 'ms')} ELSE 0.0::DOUBLE END AS records_per_second,
  {pct('inserted', 'received')} AS insertion_rate_percent,
  {pct('updated', 'received')} AS update_rate_percent,
  {pct('unchanged', 'received')} AS unchanged_rate_percent
FROM (SELECT 'arcs::' || o_orderkey AS run_key, 'run-' || o_orderkey AS airflow_run_id,
  o_orderdate + to_minutes((o_orderkey % 1440 + 35)::INT) AS started_at,
  (o_custkey * 53 + o_orderkey) % 20000 AS ms, o_orderstatus <> 'F' AS is_success,
  CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END AS status, o_orderkey,
  o_custkey % 9000 // 100 + 1 AS pages_fetched, o_custkey % 9000 AS received,
  CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey % 9000 // 3 END AS inserted,
  CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey % 9000 // 10 END AS updated,
  CASE WHEN o_orderstatus = 'F' THEN 0
       ELSE o_custkey % 9000 - o_custkey % 9000 // 3 - o_custkey % 9000 // 10
         - CASE WHEN o_orderkey % 97 = 0 AND o_custkey % 9000 > 0 THEN 1 ELSE 0 END
       END AS unchanged,
  CASE WHEN o_orderstatus = 'F' THEN 'timeout ' || o_orderpriority END AS error_message
  FROM orders)""",
    "all_runs": """
SELECT 'velib::' || run_id AS pipeline_run_id, 'Vélib' AS pipeline_name,
  run_id AS airflow_run_id, 'stations' AS dag_id, started_at, ms, status, received, inserted,
  0 AS updated, duplicates_ignored AS unchanged, duration_seconds, records_per_second,
  duplicate_rate_percent AS unchanged_rate_percent, error_message, is_success
FROM station_runs
UNION ALL
SELECT 'traffic::' || run_key, 'Trafic routier', airflow_run_id, 'arcs', started_at, ms, status,
  received, inserted, updated, unchanged, duration_seconds, records_per_second,
  unchanged_rate_percent, error_message, is_success
FROM arc_runs""",
}


def build(final: str) -> str:
    """``final`` with the common table expressions it needs, in order."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if re.search(rf"\b{name}\b", sql) and name not in needed and sql is not CTES[name]:
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final
    head = "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    own = final.lstrip()
    return f"{head},\n{own[5:]}" if own.startswith("WITH ") else f"{head}\n{own}"
