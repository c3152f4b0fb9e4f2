"""Registered queries: each operator over whole benchmark tables, with its oracle.

``@query(name, oracle)`` registers ``fn(Inputs) -> DataFrame``; results are made
engine-neutral by ``portable``.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_engine.functions import parsing as p
from obs_engine.functions.keys import day_of, surrogate_key, time_text
from obs_engine.functions.metrics import mean2, weighted_mean
from obs_engine.operators import aggregates as agg
from obs_engine.operators import dedup, joins, lookup, merge, quality, retention, serve, sketches, snapshot
from obs_engine.operators.runs import ARC_RUNS, STATION_RUNS, constraint_report, run_rules
from obs_engine.plans import arcs, checks, dimensions, feed, incremental, jobs, stations
from obs_engine.plans.oracles import (
    ARC_DESCRIPTION,
    ARC_NOW,
    RUN_NOW,
    STATION_NOW,
    TRAFFIC,
    age,
    build,
    half_up,
    pct,
    text,
    two,
)
from obs_engine.plans.stand_ins import ARC_AS_OF, RUN_AS_OF, STATION_AS_OF, Inputs, portable
from obs_engine.schemas import ARC_RECORD
from obs_engine.session import work_path
from obs_engine.sources import pages, windows
from obs_engine.streaming import expiring, flows

Run = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}
_FINAL: dict[str, str] = {}  # oracles before their common table expressions are added


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    def register(fn: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            _FINAL[name] = oracle
            ORACLES[name] = build(oracle)
        return fn

    return register


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Run) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: portable(fn(Inputs(spark, sf_dir)))

    return {name: bind(fn) for name, fn in QUERIES.items()}


# The station stand-in spans seven years with few rows a day: stored by month.
STATION_RAW, STATION_FACT = stations.RAW.monthly(), stations.FACT.monthly()


def _warehouse(x: Inputs, label: str) -> merge.Warehouse:
    """A new warehouse in the shared folder."""
    return merge.Warehouse(x.spark, work_path(x.spark, label))


# -- observation operators on events ------------------------------------------

EVENT_BUCKETS = ("click", "error", "purchase", "signup", "view")


@query(
    "daily_aggregate",
    f"""SELECT md5(user_id || '|' || ts::DATE) AS daily_id, user_id,
  ts::DATE::VARCHAR AS observation_date, count(*) AS observation_count,
  {two('sum(round(value * 100)::BIGINT)', '100 * count(*)')} AS average_value,
  min(value) AS minimum_value, max(value) AS maximum_value,
  {', '.join(f"count(*) FILTER (event_type = '{b}') AS {b}_count" for b in EVENT_BUCKETS)},
  min(ts)::VARCHAR AS first_observed_at, max(ts)::VARCHAR AS last_observed_at
FROM events GROUP BY user_id, ts::DATE""",
)
def daily_aggregate(x: Inputs) -> DataFrame:
    """The flagship query."""
    daily = agg.daily_aggregate(
        x.table("events"),
        "user_id",
        "ts",
        measures={
            "average_value": mean2(F.col("value").cast("decimal(18,2)")),
            "minimum_value": F.min("value"),
            "maximum_value": F.max("value"),
            "first_observed_at": F.min("ts"),
            "last_observed_at": F.max("ts"),
        },
        buckets=agg.status_buckets("event_type", {b: f"{b}_count" for b in EVENT_BUCKETS}),
    )
    return daily.select(surrogate_key("user_id", "observation_date").alias("daily_id"), *daily.columns)


@query(
    "latest_by_observation",
    f"""SELECT user_id, event_id, event_type, value, {text('ts')} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) = 1""",
)
def latest_by_observation(x: Inputs) -> DataFrame:
    """W3, W4"""
    e = x.table("events").select("user_id", "event_id", "event_type", "value", "ts")
    return dedup.latest_per_key(e, ["user_id"], ["ts"], ["event_id"])


@query(
    "latest_by_load",
    f"""SELECT user_id, event_id, event_type, value, {text('ts')} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY ts + to_hours((event_id % 5)::INT) DESC, ts DESC, event_id DESC) = 1""",
)
def latest_by_load(x: Inputs) -> DataFrame:
    """W2"""
    loaded = F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 5).cast("int"))
    e = x.table("events").select("user_id", "event_id", "event_type", "value", "ts")
    latest = dedup.latest_per_key(
        e.withColumn("loaded_at", loaded), ["user_id"], ["loaded_at", "ts"], ["event_id"]
    )
    return latest.drop("loaded_at")


@query(
    "first_last_seen",
    """SELECT user_id, min(ts)::VARCHAR AS first_ts, max(ts)::VARCHAR AS last_ts
FROM events GROUP BY user_id""",
)
def first_last_seen(x: Inputs) -> DataFrame:
    """W5"""
    return dedup.first_last_per_key(x.table("events"), ["user_id"], ["ts"])


_LINE_ORDER = (
    "l_shipdate DESC NULLS FIRST, l_partkey DESC, l_suppkey DESC, l_quantity DESC, "
    "l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"
)


@query(
    "dedup_last_row",
    f"""SELECT * EXCLUDE (l_shipdate), {text('l_shipdate')} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1""",
)
def dedup_last_row(x: Inputs) -> DataFrame:
    """Duplicates of one key, newest wins, ties broken by every column."""
    return dedup.one_row_per_key(
        x.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


@query(
    "raw_repaired",
    f"""SELECT stationcode, {text('last_reported', 'ingested_at')}, num_bikes_available
FROM (SELECT nullif(l_suppkey % 50, 0)::VARCHAR AS stationcode, l_shipdate AS last_reported,
    l_shipdate + to_hours((l_orderkey % 5)::INT) AS ingested_at,
    l_quantity::INT AS num_bikes_available FROM lineitem)
WHERE stationcode IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY stationcode, last_reported
  ORDER BY ingested_at DESC, num_bikes_available DESC) = 1""",
)
def raw_repaired(x: Inputs) -> DataFrame:
    """Rows without a key go, the latest stored duplicate stays."""
    raw = x.table("lineitem").select(
        F.nullif(F.col("l_suppkey") % 50, F.lit(0)).cast("string").alias("stationcode"),
        F.col("l_shipdate").alias("last_reported"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=(F.col("l_orderkey") % 5).cast("int")))
        .alias("ingested_at"),
        F.col("l_quantity").cast("int").alias("num_bikes_available"),
    )
    return dedup.clean_raw(raw, ["stationcode", "last_reported"], ["ingested_at"])


@query(
    "distinct_counts",
    """SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers,
  count(DISTINCT (l_suppkey, CASE WHEN l_linenumber > 1 THEN l_linenumber END)) AS pairs
FROM lineitem GROUP BY l_returnflag""",
)
def distinct_counts(x: Inputs) -> DataFrame:
    """A tuple holding NULL counts."""
    second = F.when(F.col("l_linenumber") > 1, F.col("l_linenumber"))
    return x.table("lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct(F.struct(F.col("l_suppkey"), second.alias("line"))).alias("pairs"),
    )


_USER_DAYS = "d AS (SELECT DISTINCT ts::DATE AS day, user_id FROM events WHERE user_id IS NOT NULL)"


def _sketched(x: Inputs, label: str) -> DataFrame:
    """Sketches of the events' users, stored in three loads, one of them twice."""
    wh = _warehouse(x, label)
    for n in (0, 1, 2, 1):
        load = x.table("events").filter(F.pmod("event_id", F.lit(3)) == n)
        sketches.add_rows(wh, sketches.SEEN, load, "user_id", "ts")
    return wh.read(sketches.SEEN)


@query(
    "sketched_trailing_week",
    f"""WITH {_USER_DAYS}
SELECT t.day::VARCHAR AS observation_date, count(DISTINCT CASE WHEN d.day = t.day THEN user_id END) AS entities,
  count(DISTINCT user_id) AS entities_in_span,
  count(DISTINCT user_id) - count(DISTINCT CASE WHEN d.day = t.day THEN user_id END) AS lost
FROM (SELECT DISTINCT day FROM d) AS t JOIN d ON d.day BETWEEN t.day - 6 AND t.day GROUP BY t.day""",
)
def sketched_trailing_week(x: Inputs) -> DataFrame:
    """Distinct entities of each trailing week and those missing on its last day, from stored sketches."""
    return sketches.trailing(_sketched(x, "week"), 7)


@query(
    "sketched_span",
    "SELECT count(DISTINCT user_id) AS entities FROM events WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
)
def sketched_span(x: Inputs) -> DataFrame:
    """Distinct entities of a span of days, from stored sketches."""
    return sketches.distinct_between(_sketched(x, "span"), date(2024, 1, 5), date(2024, 1, 20))


@query(
    "weighted_daily_mean",
    f"""WITH daily AS (SELECT user_id, ts::DATE AS d, count(*) AS n,
  {half_up('sum(round(value * 100)::BIGINT)', 'count(*)')}::BIGINT AS avg100
  FROM events GROUP BY 1, 2)
SELECT d::VARCHAR AS observation_date,
  (sum(avg100 * n)::DOUBLE / 100) / sum(n) AS weighted_mean,
  (sum(avg100)::DOUBLE / 100) / count(*) AS mean_of_means
FROM daily GROUP BY d""",
)
def weighted_daily_mean(x: Inputs) -> DataFrame:
    """A11, A12"""
    daily = agg.daily_aggregate(
        x.table("events"), "user_id", "ts",
        {"average_value": mean2(F.col("value").cast("decimal(18,2)"))},
    )
    return daily.groupBy("observation_date").agg(
        weighted_mean("average_value", "observation_count").alias("weighted_mean"),
        serve.exact_mean("average_value").alias("mean_of_means"),
    )


@query(
    "minute_series",
    """SELECT date_trunc('minute', ts)::VARCHAR AS ts, event_type, count(*) AS n
FROM events GROUP BY 1, 2""",
)
def minute_series(x: Inputs) -> DataFrame:
    """A19, L6"""
    return agg.series(
        x.table("events"), "ts", "minute", F.count(F.lit(1)), "n", by="event_type"
    )


@query(
    "minute_pivot",
    "SELECT date_trunc('minute', ts)::VARCHAR AS ts, "
    + ", ".join(f"count(*) FILTER (event_type = '{b}') AS {b}" for b in EVENT_BUCKETS)
    + " FROM events GROUP BY 1",
)
def minute_pivot(x: Inputs) -> DataFrame:
    """A21"""
    wide = agg.pivot_series(
        x.table("events"), "ts", "minute", "event_type", EVENT_BUCKETS, F.count(F.lit(1))
    )
    return wide.na.fill(0, list(EVENT_BUCKETS))


@query(
    "type_share",
    """SELECT event_type, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share
FROM events GROUP BY event_type""",
)
def type_share(x: Inputs) -> DataFrame:
    """A20, L4"""
    return agg.share_of_total(x.table("events"), "event_type", F.count(F.lit(1)), "n")


@query(
    "repeated_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""",
)
def repeated_keys(x: Inputs) -> DataFrame:
    """A18, Q2"""
    return agg.duplicate_keys(x.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "latest_100",
    f"SELECT event_id, user_id, {text('ts')}, value FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 100",
)
def latest_100(x: Inputs) -> DataFrame:
    """L3"""
    e = x.table("events").select("event_id", "user_id", "ts", "value")
    return agg.top_k(e, "ts", 100, ["event_id"])


@query(
    "entity_history",
    f"""SELECT observation_id, station_id, bikes_available, station_status,
  {text('status_updated_at')} FROM station_fact WHERE station_id = '7'
ORDER BY station_fact.status_updated_at DESC, observation_id DESC LIMIT 100""",
)
def entity_history(x: Inputs) -> DataFrame:
    """The entity is the parameter of this report."""
    return serve.station_history(x.station_fact, "7").select(
        "observation_id", "station_id", "bikes_available", "station_status", "status_updated_at"
    )


_EVENTS = merge.TableSpec("events_by_day", ("event_id",), merge.by_day("ts"), lookup=("user_id",))


@query("indexed_latest", f"SELECT event_id, user_id, {text('ts')}, value FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 100")
def indexed_latest(x: Inputs) -> DataFrame:
    """L3: the newest 100 rows of a stored table, from its newest partitions."""
    wh = _warehouse(x, "latest")
    wh.rebuild(_EVENTS, x.table("events").select("event_id", "user_id", "ts", "value"))
    return lookup.newest_rows(wh, _EVENTS, 100, ["event_id"])


@query(
    "indexed_history",
    f"""SELECT observation_id, station_id, bikes_available, station_status,
  {text('status_updated_at')} FROM station_fact WHERE station_id = '7'
ORDER BY station_fact.status_updated_at DESC, observation_id DESC LIMIT 100""",
)
def indexed_history(x: Inputs) -> DataFrame:
    """One station's newest rows from the stored fact, by its lookup column."""
    wh = _warehouse(x, "history")
    wh.rebuild(STATION_FACT, x.station_fact)
    found = lookup.entity_history(wh, STATION_FACT, "station_id", "7", 100, ["observation_id"])
    return found.select("observation_id", "station_id", "bikes_available", "station_status", "status_updated_at")


# -- pages and parsing --------------------------------------------------------


def _landed(x: Inputs) -> DataFrame:
    path = work_path(x.spark, "pages")
    x.page_documents().write.text(path)
    return pages.read_pages(x.spark, path, ARC_RECORD, layout="lines")


@query(
    "page_records",
    """SELECT user_id::VARCHAR AS arc_id, 'arc ' || user_id AS arc_label, ts::VARCHAR AS observed_at,
  CASE WHEN event_id % 7 <> 0 THEN value END AS vehicle_flow,
  CASE WHEN event_id % 11 <> 0
       THEN regexp_extract(props, '"k": ([0-9]+)', 1)::DOUBLE END AS occupancy_rate,
  event_type AS traffic_status,
  CASE WHEN user_id % 9 <> 0 THEN user_id::VARCHAR END AS downstream_node_id,
  '2020-01-01' AS source_start_date,
  CASE WHEN user_id % 50 <> 0 THEN (user_id % 90)::DOUBLE END AS longitude,
  CASE WHEN user_id % 50 <> 0 THEN (user_id % 80)::DOUBLE END AS latitude,
  '{"coordinates":[' || user_id % 90 || ',' || user_id % 80 || '],"type":"Point"}' AS geo_shape,
  0 AS rejects
FROM events""",
)
def page_records(x: Inputs) -> DataFrame:
    """Landed pages to typed, unique records."""
    records = pages.records_of(_landed(x))
    parsed = dedup.dedup_last(
        arcs.parse_arcs(records, ARC_AS_OF, "run"), arcs.KEY, pages.LINEAGE
    )
    return parsed.select(
        "arc_id", "arc_label", "observed_at", "vehicle_flow", "occupancy_rate", "traffic_status",
        "downstream_node_id", "source_start_date", "longitude", "latitude", "geo_shape",
        F.size("reject_reasons").alias("rejects"),
    )


@query(
    "page_totals",
    """SELECT date_diff('day', DATE '2024-01-01', ts::DATE) AS chunk_no,
  (count(*) + 99) // 100 AS pages_fetched, count(*) AS reported_total, count(*) AS unique_records
FROM events GROUP BY 1""",
)
def page_totals(x: Inputs) -> DataFrame:
    """S5 per chunk"""
    landed = _landed(x)
    unique = pages.unique_per_chunk(pages.records_of(landed), pages.ARC_REQUIRED)
    return (
        pages.page_totals(landed)
        .join(unique, "chunk_no")
        .select("chunk_no", "pages_fetched", F.col("highest_total").alias("reported_total"),
                "unique_records")
    )


@query(
    "page_figures",
    """SELECT sum((n + 99) // 100)::BIGINT AS pages_fetched, sum(n)::BIGINT AS reported_total,
  sum(n)::BIGINT AS records_received, 0 AS faulty_pages, 0 AS incomplete_records,
  0 AS incomplete_chunks
FROM (SELECT count(*) AS n FROM events GROUP BY ts::DATE)""",
)
def page_figures(x: Inputs) -> DataFrame:
    """Fetch figures next to the number of faults."""
    landed = _landed(x)
    records = pages.records_of(landed)
    incomplete = pages.check_completeness(landed, records, pages.ARC_REQUIRED, False)
    n = F.count(F.lit(1))
    return agg.side_by_side(
        pages.fetch_stats(landed, records, pages.ARC_REQUIRED),
        pages.validate_pages(landed).agg(n.alias("faulty_pages")),
        pages.require_fields(records, pages.ARC_REQUIRED).agg(n.alias("incomplete_records")),
        incomplete.agg(n.alias("incomplete_chunks")),
    )


_FORMS = """CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
  WHEN 1 THEN strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00'
  WHEN 2 THEN strftime(ts - INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:%S') || '-0130' END"""


@query(
    "typed_fields",
    f"""SELECT event_id,
  CASE WHEN event_id % 6 < 3 THEN date_trunc('second', ts)::VARCHAR END AS ts_value,
  event_id % 6 >= 3 AS ts_bad,
  CASE WHEN event_id % 5 < 2 THEN ts::DATE::VARCHAR END AS date_value,
  event_id % 5 = 2 AS date_bad,
  CASE event_id % 7 WHEN 0 THEN value WHEN 1 THEN -value END AS decimal_value,
  event_id % 7 IN (2, 3, 4) AS decimal_bad,
  CASE WHEN user_id % 4 < 2 THEN (user_id % 180)::DOUBLE END AS lon_value,
  CASE WHEN user_id % 4 < 2 THEN (user_id % 90)::DOUBLE END AS lat_value,
  user_id % 4 = 2 AS point_bad,
  CASE WHEN event_id % 4 < 2
       THEN '{{"a":' || user_id || ',"b":[1,"x"],"z":' || event_id || '}}' END AS json_value,
  event_id % 4 = 2 AS json_bad,
  CASE WHEN event_id % 4 < 2 THEN '{{"a":' || user_id || ',"b":[1,"x"],"z":' || event_id || '}}'
       WHEN event_id % 4 = 2 THEN event_type END AS hours_text
FROM events""",
)
def typed_fields(x: Inputs) -> DataFrame:
    """Every parser over good, blank and bad spellings of event fields."""
    n, user, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    iso = "yyyy-MM-dd'T'HH:mm:ss"

    def stamp(minutes: int, suffix: str):
        shifted = ts + F.make_dt_interval(mins=F.lit(minutes))
        return F.concat(F.date_format(shifted, iso), F.lit(suffix))

    when = (
        F.when(n % 6 == 0, stamp(0, "Z"))
        .when(n % 6 == 1, stamp(120, "+02:00"))
        .when(n % 6 == 2, stamp(-90, "-0130"))
        .when(n % 6 == 3, stamp(0, ""))
        .when(n % 6 == 4, "")
        .otherwise("soon")
    )
    day = (
        F.when(n % 5 == 0, F.date_format(ts, iso))
        .when(n % 5 == 1, F.date_format(ts, "yyyy-MM-dd"))
        .when(n % 5 == 2, "2024-13-01")
        .when(n % 5 == 3, "")
    )
    number = (
        F.when(n % 7 == 0, F.col("value").cast("string"))
        .when(n % 7 == 1, F.concat(F.lit("-"), F.col("value").cast("string")))
        .when(n % 7 == 2, "NaN")
        .when(n % 7 == 3, "true")
        .when(n % 7 == 4, "Infinity")
        .when(n % 7 == 5, "")
    )
    lon = F.when(user % 4 < 2, (user % 180).cast("string")).when(user % 4 == 2, "200")
    lat = F.when(user % 4 < 3, (user % 90).cast("string"))
    shape = F.concat(
        F.lit('{ "z": '), n, F.lit(', "b": [1, "x"], "a": '), user, F.lit(" }")
    )
    shape = F.when(n % 4 < 2, shape).when(n % 4 == 2, F.col("event_type"))
    raw = x.table("events").select(
        n, when.alias("w"), day.alias("d"), number.alias("q"), lon.alias("lon"),
        lat.alias("lat"), shape.alias("s"),
    )
    seen, start, flow, geo = (
        p.parse_ts("w"), p.parse_date("d"), p.parse_decimal("q"), p.canonical_json("s")
    )
    x_value, y_value, point_bad = p.parse_point("lon", "lat")
    return raw.select(
        "event_id",
        seen.value.alias("ts_value"), seen.bad.alias("ts_bad"),
        start.value.alias("date_value"), start.bad.alias("date_bad"),
        flow.value.alias("decimal_value"), flow.bad.alias("decimal_bad"),
        x_value.alias("lon_value"), y_value.alias("lat_value"), point_bad.alias("point_bad"),
        geo.value.alias("json_value"), geo.bad.alias("json_bad"),
        p.json_or_text("s").alias("hours_text"),
    )


# -- windows ------------------------------------------------------------------


@query(
    "chunk_row_counts",
    """WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events),
c AS (SELECT i AS chunk_no, lo + to_hours((2 * i)::INT) AS chunk_start,
    least(lo + to_hours((2 * i + 2)::INT), hi) AS chunk_end
  FROM b, range(0, (SELECT greatest((date_diff('hour', lo, hi) + 1) // 2, 1) FROM b)) r(i)),
h AS (SELECT date_trunc('hour', ts) AS ts FROM events)
SELECT chunk_no, chunk_start::VARCHAR AS chunk_start, chunk_end::VARCHAR AS chunk_end,
  (SELECT count(*) FROM h WHERE h.ts BETWEEN chunk_start AND chunk_end) AS n
FROM c""",
)
def chunk_row_counts(x: Inputs) -> DataFrame:
    """Two-hour chunks, closed on both sides, so border rows count twice."""
    hourly = x.table("events").select(F.date_trunc("hour", F.col("ts")).alias("ts"))
    bounds = hourly.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    chunks = windows.chunks_between(bounds, "lo", "hi")
    per_hour = hourly.groupBy("ts").agg(F.count(F.lit(1)).alias("n"))
    low, high = (F.lit(t) for t in bounds.first())  # date_trunc gives instants
    numbers = windows.chunk_numbers(F.col("ts"), low, high)
    counted = (
        per_hour.select(F.explode(numbers).alias("chunk_no"), "n")
        .groupBy("chunk_no")
        .agg(F.sum("n").alias("n"))
    )
    return (
        chunks.join(counted, "chunk_no", "left")
        .select("chunk_no", "chunk_start", "chunk_end", F.coalesce("n", F.lit(0)).alias("n"))
    )


@query(
    "window_rows",
    f"""SELECT event_id, {text('ts')} FROM events
WHERE ts >= date_trunc('second', (SELECT max(ts) FROM events) - INTERVAL 2 HOUR)
  AND ts <= {ARC_NOW}""",
)
def window_rows(x: Inputs) -> DataFrame:
    """What the next run would request again."""
    e = x.table("events").select("event_id", "ts")
    start, end = windows.incremental_window(windows.watermark_of(e, "ts"), ARC_AS_OF)
    seen = e.withColumn("at", F.col("ts").cast("timestamp"))
    return seen.filter(windows.in_window("at", start, end)).drop("at")


# -- merges -------------------------------------------------------------------

_ARC_OUT = """arc_id, observed_at::VARCHAR AS observed_at, flow100::DOUBLE / 100 AS vehicle_flow,
  traffic_status, ingested_at::VARCHAR AS ingested_at, source_run_id"""
_ARC_COLUMNS = (
    "arc_id", "observed_at", "vehicle_flow", "traffic_status", "ingested_at", "source_run_id"
)


@query(
    "insert_ignore_rows",
    f"SELECT {_ARC_OUT} FROM arc_batch ANTI JOIN arc_base USING (arc_id, observed_at)",
)
def insert_ignore_rows(x: Inputs) -> DataFrame:
    """Rows of the second load that are new."""
    return merge.insert_ignore(x.arc_raw, x.arc_batch, arcs.KEY).select(*_ARC_COLUMNS)


@query(
    "upsert_counts",
    """SELECT count(*) AS received, count(*) FILTER (o.arc_id IS NULL) AS inserted,
  count(*) FILTER (o.arc_id IS NOT NULL AND o.flow100 IS DISTINCT FROM b.flow100) AS updated,
  count(*) FILTER (o.arc_id IS NOT NULL AND o.flow100 IS NOT DISTINCT FROM b.flow100) AS unchanged
FROM arc_batch b LEFT JOIN arc_base o USING (arc_id, observed_at)""",
)
def upsert_counts(x: Inputs) -> DataFrame:
    """S10, P27"""
    return merge.action_counts(merge.classify(x.arc_raw, x.arc_batch, arcs.KEY, arcs.COMPARED))


@query("upsert_rows", f"SELECT {_ARC_OUT} FROM arc_upserted")
def upsert_rows(x: Inputs) -> DataFrame:
    """Unchanged rows keep their first load time."""
    return merge.upserted(x.arc_raw, x.arc_batch, arcs.KEY, arcs.COMPARED).select(*_ARC_COLUMNS)


@query("stored_upsert", f"SELECT {_ARC_OUT} FROM arc_upserted")
def stored_upsert(x: Inputs) -> DataFrame:
    """The same through stored partitions, and replayed once."""
    wh = _warehouse(x, "upsert")
    for batch in (x.arc_raw, x.arc_batch, x.arc_batch):
        wh.upsert(arcs.RAW, batch, arcs.COMPARED)
    return wh.read(arcs.RAW).select(*_ARC_COLUMNS)


@query(
    "delete_insert_rows",
    f"""SELECT {_ARC_OUT} FROM arc_base ANTI JOIN arc_batch USING (arc_id, observed_at)
UNION ALL SELECT {_ARC_OUT} FROM arc_batch""",
)
def delete_insert_rows(x: Inputs) -> DataFrame:
    """S11"""
    return merge.delete_inserted(x.arc_raw, x.arc_batch, arcs.KEY).select(*_ARC_COLUMNS)


@query(
    "stored_delete_insert",
    f"""SELECT {_ARC_OUT}, NULL::VARCHAR AS note
FROM arc_base ANTI JOIN arc_batch USING (arc_id, observed_at)
UNION ALL SELECT {_ARC_OUT}, 'late' FROM arc_batch""",
)
def stored_delete_insert(x: Inputs) -> DataFrame:
    """Through stored partitions; the batch adds one column and drops another."""
    wh = _warehouse(x, "delete-insert")
    wh.delete_insert(arcs.RAW, x.arc_raw)
    changed = x.arc_batch.drop("geo_shape").withColumn("note", F.lit("late"))
    wh.delete_insert(arcs.RAW, changed)
    table = wh.read(arcs.RAW)
    if "geo_shape" in table.columns:
        raise AssertionError("a dropped column came back")
    return table.select(*_ARC_COLUMNS, "note")


_DELETE_INSERTED = f"""SELECT {_ARC_OUT}, {{old}} AS note
FROM arc_base ANTI JOIN arc_batch USING (arc_id, observed_at)
UNION ALL SELECT {_ARC_OUT}, {{new}} FROM arc_batch"""


@query("stored_readded_column", _DELETE_INSERTED.format(old="NULL::VARCHAR", new="'new'"))
def stored_readded_column(x: Inputs) -> DataFrame:
    """A column is dropped and comes back; stored rows don't show its old values."""
    wh = _warehouse(x, "readded")
    wh.delete_insert(arcs.RAW, x.arc_raw.withColumn("note", F.lit("old")))
    wh.delete_insert(arcs.RAW, x.arc_batch)
    wh.delete_insert(arcs.RAW, x.arc_batch.withColumn("note", F.lit("new")))
    return wh.read(arcs.RAW).select(*_ARC_COLUMNS, "note")


class _Interrupted(merge.Warehouse):
    """A warehouse whose driver dies before a new version is switched to."""

    def _switch(self, *_) -> None:
        raise InterruptedError


@query("stored_interrupted_rebuild", _DELETE_INSERTED.format(old="'kept'", new="'kept'"))
def stored_interrupted_rebuild(x: Inputs) -> DataFrame:
    """A rebuild that dies leaves the table, and the next merge finds it."""
    wh = _warehouse(x, "interrupted")
    wh.rebuild(arcs.RAW, x.arc_raw)
    try:
        _Interrupted(x.spark, wh.root).rebuild(arcs.RAW, x.arc_batch)
    except InterruptedError:
        pass
    wh.delete_insert(arcs.RAW, x.arc_batch)
    return wh.read(arcs.RAW).select(*_ARC_COLUMNS, F.lit("kept").alias("note"))


@query(
    "full_refresh_guarded",
    """SELECT stationcode, count(*) AS n, true AS refused FROM station_raw GROUP BY stationcode""",
)
def full_refresh_guarded(x: Inputs) -> DataFrame:
    """A protected history is not rebuilt without approval."""
    wh, kept = _warehouse(x, "guarded"), dataclasses.replace(STATION_RAW, protected=True)
    wh.rebuild(kept, x.station_raw)
    refused = False
    try:
        wh.rebuild(kept, x.station_raw.withColumn("stationcode", F.lit("gone")))
    except PermissionError:
        refused = True
    n = F.count(F.lit(1))
    return wh.read(kept).groupBy("stationcode").agg(n.alias("n"), F.lit(refused).alias("refused"))


@query(
    "registered_views",
    """SELECT arc_id, count(*) AS days, sum(observation_count)::BIGINT AS observations
FROM arc_daily GROUP BY arc_id""",
)
def registered_views(x: Inputs) -> DataFrame:
    """Models served to SQL under their names."""
    jobs.register_views({"served_arc_daily": x.arc_daily})
    return x.spark.sql(
        "SELECT arc_id, count(*) AS days, sum(observation_count) AS observations "
        "FROM served_arc_daily GROUP BY arc_id"
    )


def _arc_job(x: Inputs, label: str) -> merge.Warehouse:
    """A complete run over the events as landed pages."""
    path, wh = work_path(x.spark, f"{label}-pages"), _warehouse(x, label)
    x.page_documents().write.text(path)
    jobs.run_arcs(wh, path, "r1", ARC_AS_OF, layout="lines")
    return wh


@query(
    "arc_job_daily",
    """SELECT user_id::VARCHAR AS arc_id, ts::DATE::VARCHAR AS observation_date,
  count(*) AS observation_count, count(*) FILTER (event_id % 7 <> 0) AS vehicle_flow_observation_count
FROM events GROUP BY 1, 2""",
)
def arc_job_daily(x: Inputs) -> DataFrame:
    """From landed pages to the stored daily aggregate."""
    return _arc_job(x, "job").read(arcs.DAILY).select(
        "arc_id", "observation_date", "observation_count", "vehicle_flow_observation_count"
    )


@query(
    "arc_job_log",
    """SELECT 'arcs::r1' AS run_key, 'success' AS status, sum((n + 99) // 100)::BIGINT AS pages_fetched,
  sum(n)::BIGINT AS records_received, sum(n)::BIGINT AS records_inserted, 0 AS records_updated
FROM (SELECT count(*) AS n FROM events GROUP BY ts::DATE)""",
)
def arc_job_log(x: Inputs) -> DataFrame:
    """The run row that the job wrote through ``upsert_run``."""
    return _arc_job(x, "job-log").read(ARC_RUNS).select(
        "run_key", "status", "pages_fetched", "records_received", "records_inserted", "records_updated"
    )


_HALF = "2024-01-16"
_DIM_TIMES = ("first_observed_at", "last_observed_at", "first_loaded_at", "last_loaded_at")


def _dimension_loads(x: Inputs, label: str) -> merge.Warehouse:
    """Half of the arc rows, then the rest, with the dimension refreshed after each."""
    wh = _warehouse(x, label)
    late = F.col("ingested_at") >= F.lit(_HALF).cast("timestamp")
    for part in (x.arc_raw.filter(~late), x.arc_raw.filter(late)):
        wh.upsert(arcs.RAW, part, arcs.COMPARED)
        dimensions.refresh_dimension(wh, dimensions.ARCS)
    return wh


@query("stored_dimension", f"SELECT arc_id, s.arc_label AS arc_label, {text(*_DIM_TIMES)} FROM arc_dim")
def stored_dimension(x: Inputs) -> DataFrame:
    """A dimension after an increment, merged from the new rows alone."""
    return _dimension_loads(x, "dimension").read(arcs.DIM).select("arc_id", "arc_label", *_DIM_TIMES)


@query(
    "stored_dimension_corrected",
    """SELECT arc_id, min(observed_at)::VARCHAR AS first_observed_at, max(observed_at)::VARCHAR AS last_observed_at,
  min(ingested_at)::VARCHAR AS first_loaded_at, max(ingested_at)::VARCHAR AS last_loaded_at
FROM arc_upserted GROUP BY arc_id""",
)
def stored_dimension_corrected(x: Inputs) -> DataFrame:
    """The same after corrections, some of an arc's first load."""
    wh = _dimension_loads(x, "dimension-corrected")
    wh.upsert(arcs.RAW, x.arc_batch, arcs.COMPARED)
    dimensions.refresh_dimension(wh, dimensions.ARCS)
    return wh.read(arcs.DIM).select("arc_id", *_DIM_TIMES)


_SERVED = """served AS (
  SELECT l_suppkey AS s, l_shipdate + to_hours(((l_linenumber % 2) * 12)::INT) AS due, l_quantity::INT - 1 AS bikes,
    CASE WHEN l_suppkey % 33 = 0 THEN NULL WHEN l_suppkey % 25 = 0 THEN 0 ELSE 30 + l_suppkey % 25 END AS capacity
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate, l_linenumber % 2 ORDER BY l_orderkey, l_linenumber) = 1)"""


def _station_job(x: Inputs, label: str) -> merge.Warehouse:
    """A complete station run over landed pages, made twice."""
    path, wh = work_path(x.spark, f"{label}-pages"), _warehouse(x, label)
    x.write_station_pages(path, compression="gzip")
    jobs.run_stations(wh, path, "r1", STATION_AS_OF, layout="lines", monthly=True)
    jobs.run_stations(wh, path, "r2", STATION_AS_OF + timedelta(hours=1), layout="lines", monthly=True)
    return wh


@query(
    "station_job_rows",
    f"""WITH {_SERVED}
SELECT s::VARCHAR AS stationcode, due::VARCHAR AS last_reported, bikes AS num_bikes_available,
  coalesce(capacity, 0) - bikes AS num_docks_available, capacity,
  CASE WHEN s % 17 <> 0 THEN 2 + (s % 90) / 100 END AS lon, CASE WHEN s % 17 <> 0 THEN 48 + (s % 80) / 100 END AS lat,
  ({STATION_NOW})::VARCHAR AS ingested_at FROM served""",
)
def station_job_rows(x: Inputs) -> DataFrame:
    """Typed raw rows of landed station pages, with their load time; a second run changes none."""
    return _station_job(x, "station-rows").read(STATION_RAW).select(
        "stationcode", "last_reported", "num_bikes_available", "num_docks_available", "capacity", "lon", "lat", "ingested_at"
    )


@query(
    "station_job_daily",
    f"""WITH {_SERVED}
SELECT s::VARCHAR AS station_id, due::DATE::VARCHAR AS observation_date, count(*) AS observation_count,
  min(bikes) AS minimum_bikes_available, max(bikes) AS maximum_bikes_available FROM served GROUP BY 1, 2""",
)
def station_job_daily(x: Inputs) -> DataFrame:
    """From landed station pages to the stored daily aggregate."""
    return _station_job(x, "station-daily").read(stations.DAILY.monthly()).select(
        "station_id", "observation_date", "observation_count", "minimum_bikes_available", "maximum_bikes_available"
    )


@query(
    "station_job_log",
    f"""WITH {_SERVED}, months AS (SELECT count(*) AS n FROM served GROUP BY date_trunc('month', due))
SELECT run, 'success' AS status, sum((n + 99) // 100)::BIGINT AS pages_fetched, sum(n)::BIGINT AS reported_total,
  sum(n)::BIGINT AS records_received, (CASE WHEN run = 'r1' THEN sum(n) ELSE 0 END)::BIGINT AS records_inserted,
  (CASE WHEN run = 'r1' THEN 0 ELSE sum(n) END)::BIGINT AS duplicates_ignored
FROM months, (VALUES ('r1'), ('r2')) AS v(run) GROUP BY run""",
)
def station_job_log(x: Inputs) -> DataFrame:
    """Fetch figures of the station feed, in the rows both runs wrote."""
    return _station_job(x, "station-log").read(STATION_RUNS).select(
        F.col("run_id").alias("run"), "status", "pages_fetched", "reported_total", "records_received", "records_inserted", "duplicates_ignored"
    )


@query("table_rebuilt", "SELECT stationcode, count(*) AS n FROM station_raw GROUP BY stationcode")
def table_rebuilt(x: Inputs) -> DataFrame:
    """A full refresh, read back; a second refresh replaces the first."""
    wh = _warehouse(x, "rebuild")
    wh.rebuild(STATION_RAW, x.station_raw)
    table = wh.rebuild(STATION_RAW, wh.read(STATION_RAW))
    return table.groupBy("stationcode").agg(F.count(F.lit(1)).alias("n"))


@query(
    "run_log_upserted",
    """SELECT run_key, CASE WHEN o_orderpriority = '1-URGENT' THEN 'failed' ELSE status END AS status,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE received END AS records_received
FROM arc_runs JOIN orders ON run_key = 'arcs::' || orders.o_orderkey""",
)
def run_log_upserted(x: Inputs) -> DataFrame:
    """Re-runs of urgent orders' runs overwrite their rows."""
    wh = _warehouse(x, "runs")
    wh.delete_insert(ARC_RUNS, x.arc_log)
    urgent = x.table("orders").filter("o_orderpriority = '1-URGENT'").select(
        F.concat(F.lit("arcs::"), "o_orderkey").alias("run_key")
    )
    rerun = x.arc_log.join(urgent, "run_key", "left_semi").withColumns(
        {"status": F.lit("failed"), "records_received": F.lit(0)}
    )
    wh.delete_insert(ARC_RUNS, rerun)
    return wh.read(ARC_RUNS).select("run_key", "status", "records_received")


@query(
    "run_constraints",
    """SELECT 'status is final' AS rule, 0 AS violations
UNION ALL SELECT 'counters are not negative', count(*) FILTER (received - 10 < 0) FROM arc_runs
UNION ALL SELECT 'classified within received', count(*) FILTER (classified > received - 10) FROM arc_runs""",
)
def run_constraints(x: Inputs) -> DataFrame:
    """Rules over a log whose received count was tampered with."""
    tampered = x.arc_log.withColumn("records_received", F.col("records_received") - 10)
    return constraint_report(tampered, run_rules("arcs"))


@query(
    "stored_failures",
    f"""SELECT observation_id, station_id, station_name, bikes_available, total_capacity,
  {text('status_updated_at')} FROM station_fact WHERE bikes_available > total_capacity""",
)
def stored_failures(x: Inputs) -> DataFrame:
    """Failing rows kept in an audit table, read back."""
    root = work_path(x.spark, "audit")
    path = merge.store_failures(quality.over_capacity(x.station_fact), root, "bikes_under_capacity")
    return x.spark.read.parquet(path)


@query("table_statistics", "SELECT count(*) AS n_rows FROM station_raw")
def table_statistics(x: Inputs) -> DataFrame:
    """Optimizer statistics recomputed for a stored table."""
    wh = _warehouse(x, "stats")
    wh.rebuild(STATION_RAW, x.station_raw)
    wh.refresh_stats([STATION_RAW])
    described = x.spark.sql(f"DESCRIBE EXTENDED {wh.database}.{STATION_RAW.name}")
    rows = F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long")
    return described.filter("col_name = 'Statistics'").select(rows.alias("n_rows"))


# -- models -------------------------------------------------------------------

_STATION_COLUMNS = """station_id, station_name, is_installed, total_capacity::DOUBLE AS total_capacity,
  docks_available, bikes_available, mechanical_bikes::DOUBLE AS mechanical_bikes, electric_bikes,
  is_renting_active, is_returning_active, commune, insee_code, longitude, latitude,
  status_updated_at::VARCHAR AS status_updated_at, loaded_at::VARCHAR AS loaded_at"""


def _nullable_counts(df: DataFrame) -> DataFrame:
    """Nullable counters as doubles, as in the oracles."""
    return df.withColumns(
        {c: F.col(c).cast("double") for c in ("total_capacity", "mechanical_bikes") if c in df.columns}
    )


@query("station_staging", f"SELECT {_STATION_COLUMNS} FROM station_staged")
def station_staging(x: Inputs) -> DataFrame:
    """P9, P10, W1"""
    return _nullable_counts(x.station_staged)


@query(
    "station_dim_rows",
    """SELECT station_id, s.station_name AS station_name, s.is_installed AS is_installed,
  s.total_capacity::DOUBLE AS total_capacity, s.commune AS commune, s.insee_code AS insee_code,
  s.longitude AS longitude, s.latitude AS latitude, first_seen_at::VARCHAR AS first_seen_at,
  last_seen_at::VARCHAR AS last_seen_at, s.status_updated_at::VARCHAR AS source_updated_at
FROM station_dim""",
)
def station_dim_rows(x: Inputs) -> DataFrame:
    """W2, W5"""
    return _nullable_counts(x.station_dim)


_FACT_COLUMNS = f"""observation_id, {_STATION_COLUMNS},
  occ::DOUBLE / 100 AS occupancy_rate_percent, station_status"""


@query("station_fact_rows", f"SELECT {_FACT_COLUMNS} FROM station_fact")
def station_fact_rows(x: Inputs) -> DataFrame:
    """P13-P15"""
    return _nullable_counts(x.station_fact)


@query(
    "station_daily_rows",
    f"""SELECT * REPLACE ({text('observation_date', 'first_observed_at', 'last_observed_at', 'last_loaded_at')})
FROM station_daily""",
)
def station_daily_rows(x: Inputs) -> DataFrame:
    """A1"""
    return x.station_daily


@query(
    "station_current_rows",
    f"""SELECT {_FACT_COLUMNS}, {age('loaded_at', STATION_NOW)} AS data_age_minutes,
  loaded_at >= {STATION_NOW} - INTERVAL 2 HOUR AS is_fresh FROM station_current""",
)
def station_current_rows(x: Inputs) -> DataFrame:
    """W4, P16, P17"""
    return _nullable_counts(x.station_current)


_ARC_STAGED = f"""observation_id, arc_id, observed_at::VARCHAR AS observed_at,
  flow100::DOUBLE / 100 AS vehicle_flow, occ10::DOUBLE / 10 AS occupancy_rate, traffic_status,
  arc_status, {ARC_DESCRIPTION}, has_vehicle_flow, has_occupancy_rate, has_traffic_measurement,
  loaded_at::VARCHAR AS loaded_at, source_run_id"""


@query("arc_staging", f"SELECT {_ARC_STAGED} FROM arc_staged")
def arc_staging(x: Inputs) -> DataFrame:
    """P11-P13"""
    return x.arc_staged


_LATEST_DESCRIPTION = ", ".join(
    f"s.{c}{'::VARCHAR' if c.endswith('_date') else ''} AS {c}" for c in arcs.DESCRIPTION
)


@query(
    "arc_dim_rows",
    f"""SELECT arc_id, {_LATEST_DESCRIPTION},
  {text('first_observed_at', 'last_observed_at', 'first_loaded_at', 'last_loaded_at')}
FROM arc_dim""",
)
def arc_dim_rows(x: Inputs) -> DataFrame:
    """W3, W5"""
    return x.arc_dim


@query(
    "arc_daily_rows",
    f"""SELECT daily_traffic_id, arc_id, observation_count, vehicle_flow_observation_count,
  occupancy_observation_count, avg_flow100::DOUBLE / 100 AS average_vehicle_flow,
  max_flow100::DOUBLE / 100 AS maximum_vehicle_flow, avg_occ100::DOUBLE / 100 AS average_occupancy_rate,
  max_occ10::DOUBLE / 10 AS maximum_occupancy_rate, {', '.join(TRAFFIC)},
  {text('observation_date', 'first_observed_at', 'last_observed_at', 'last_loaded_at')}
FROM arc_daily""",
)
def arc_daily_rows(x: Inputs) -> DataFrame:
    """A2"""
    return x.arc_daily


@query(
    "arc_current_rows",
    f"""SELECT {_ARC_STAGED}, {age('loaded_at', ARC_NOW)} AS data_age_minutes,
  loaded_at >= {ARC_NOW} - INTERVAL 2 HOUR AS is_fresh FROM arc_current""",
)
def arc_current_rows(x: Inputs) -> DataFrame:
    """W4, P16, P17"""
    return x.arc_current


_FINISHED = "(started_at + to_milliseconds(ms))::VARCHAR AS finished_at"


@query(
    "station_run_rows",
    f"""SELECT run_id, 'stations' AS dag_id, 'load' AS task_id, {text('started_at')}, {_FINISHED},
  status, pages_fetched, received AS reported_total, received AS records_received,
  inserted AS records_inserted, duplicates_ignored, duration_seconds, error_message,
  records_per_second, duplicate_rate_percent, is_success FROM station_runs""",
)
def station_run_rows(x: Inputs) -> DataFrame:
    """P18, P19"""
    return x.station_runs


@query(
    "arc_run_rows",
    f"""SELECT run_key, airflow_run_id, 'arcs' AS dag_id, 'load' AS task_id, {text('started_at')},
  {_FINISHED}, status, (started_at - INTERVAL 6 HOUR)::VARCHAR AS window_start,
  started_at::VARCHAR AS window_end,
  CASE WHEN o_orderkey % 10 <> 0 THEN (started_at - INTERVAL 4 HOUR)::VARCHAR END AS watermark_before,
  pages_fetched, received AS reported_total, received AS records_received,
  inserted AS records_inserted, updated AS records_updated, unchanged AS records_unchanged,
  duration_seconds, error_message, records_per_second, insertion_rate_percent,
  update_rate_percent, unchanged_rate_percent, classified AS classified_record_count,
  classified = received AS counts_are_consistent, is_success FROM arc_runs""",
)
def arc_run_rows(x: Inputs) -> DataFrame:
    """P18, P19, Q15"""
    return x.arc_runs


_RUN_OUT = """received AS records_received, inserted AS records_inserted,
  updated AS records_updated, unchanged AS records_unchanged"""


@query(
    "all_run_rows",
    f"""SELECT pipeline_run_id, pipeline_name, airflow_run_id, dag_id, 'load' AS task_id,
  {text('started_at')}, {_FINISHED}, status, {_RUN_OUT}, inserted + updated AS changed_record_count,
  duration_seconds, records_per_second, unchanged_rate_percent, error_message, is_success
FROM all_runs""",
)
def all_run_rows(x: Inputs) -> DataFrame:
    """U1, P20, P21"""
    return x.all_runs


# -- incremental --------------------------------------------------------------


@query(
    "increment_rows",
    f"""SELECT {_ARC_OUT} FROM arc_upserted
WHERE ingested_at > (SELECT max(ingested_at) FROM arc_base)""",
)
def increment_rows(x: Inputs) -> DataFrame:
    """What the fact takes from the raw table after the second load."""
    raw = merge.upserted(x.arc_raw, x.arc_batch, arcs.KEY, arcs.COMPARED)
    high = windows.watermark_of(x.arc_raw, "ingested_at")
    return merge.newer_than(raw, "ingested_at", high).select(*_ARC_COLUMNS)


@query(
    "affected_day_pairs",
    f"""SELECT DISTINCT arc_id, observed_at::DATE::VARCHAR AS observation_date FROM arc_upserted
WHERE ingested_at > (SELECT max(ingested_at) FROM arc_base)""",
)
def affected_day_pairs(x: Inputs) -> DataFrame:
    """A15, P22"""
    raw = merge.upserted(x.arc_raw, x.arc_batch, arcs.KEY, arcs.COMPARED)
    high = windows.watermark_of(x.arc_raw, "ingested_at")
    return joins.affected_days(merge.newer_than(raw, "ingested_at", high), "arc_id", "observed_at")


_REBUILT_DAILY = """SELECT arc_id, observed_at::DATE::VARCHAR AS observation_date,
  count(*) AS observation_count, count(flow100) AS vehicle_flow_observation_count,
  {mean} AS average_vehicle_flow, max(ingested_at)::VARCHAR AS last_loaded_at
FROM arc_upserted GROUP BY 1, 2""".format(
    mean=f"{half_up('sum(flow100)', 'count(flow100)')}::DOUBLE / 100"
)
_DAILY_COLUMNS = (
    "arc_id", "observation_date", "observation_count", "vehicle_flow_observation_count",
    "average_vehicle_flow", "last_loaded_at",
)


@query("incremental_daily", _REBUILT_DAILY)
def incremental_daily(x: Inputs) -> DataFrame:
    """One refresh equals a rebuild."""
    raw = merge.upserted(x.arc_raw, x.arc_batch, arcs.KEY, arcs.COMPARED)
    fact = arcs.arc_fact(arcs.stage_arcs(raw))
    return incremental.incremental_daily(
        fact, x.arc_daily, "arc_id", "observed_at", "daily_traffic_id", arcs.arc_daily
    ).select(*_DAILY_COLUMNS)


@query("stored_incremental_daily", _REBUILT_DAILY)
def stored_incremental_daily(x: Inputs) -> DataFrame:
    """Two loads through stored raw, fact and aggregate tables."""
    wh = _warehouse(x, "incremental")
    for batch in (x.arc_raw, x.arc_batch):
        wh.upsert(arcs.RAW, batch, arcs.COMPARED)
        incremental.load_increment(wh, arcs.FACT, arcs.RAW, arcs.stage_arcs)
        incremental.refresh_daily(wh, arcs.FACT, arcs.DAILY, "arc_id", arcs.arc_daily)
    return wh.read(arcs.DAILY).select(*_DAILY_COLUMNS)


@query(
    "replay_counts",
    """SELECT 1 AS load, count(*) AS received, count(*) AS inserted, 0 AS updated, 0 AS unchanged FROM events
UNION ALL SELECT 2, count(*), 0, 0, count(*) FROM events""",
)
def replay_counts(x: Inputs) -> DataFrame:
    """The same load twice."""
    wh = _warehouse(x, "replay")
    results = [wh.upsert(arcs.RAW, x.arc_raw, arcs.COMPARED) for _ in range(2)]
    return x.spark.createDataFrame(
        [(i, r.received, r.inserted, r.updated, r.unchanged) for i, r in enumerate(results, 1)],
        "load INT, received LONG, inserted LONG, updated LONG, unchanged LONG",
    )


@query(
    "source_freshness",
    f"""SELECT 'arcs' AS source, max(ingested_at)::VARCHAR AS newest,
  CASE WHEN {ARC_NOW} - max(ingested_at) > INTERVAL 6 HOUR THEN 'error'
       WHEN {ARC_NOW} - max(ingested_at) > INTERVAL 2 HOUR THEN 'warn' ELSE 'pass' END AS status
FROM arc_base
UNION ALL SELECT 'stations', max(ingested_at)::VARCHAR, 'error' FROM station_raw""",
)
def source_freshness(x: Inputs) -> DataFrame:
    """I8"""
    a = quality.freshness(x.arc_raw, "ingested_at", ARC_AS_OF)
    s = quality.freshness(x.station_raw, "ingested_at", STATION_AS_OF)
    return (
        portable(a.select(F.lit("arcs").alias("source"), "*"))
        .unionByName(portable(s.select(F.lit("stations").alias("source"), "*")))
    )


# -- joins and checks ---------------------------------------------------------


@query(
    "orphan_keys",
    """SELECT o_custkey, count(*) AS n_rows FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1""",
)
def orphan_keys(x: Inputs) -> DataFrame:
    """Orders of customers without any event."""
    parents = x.table("events").select("user_id").distinct()
    return joins.orphans(x.table("orders"), "o_custkey", parents, "user_id")


@query(
    "missing_daily_rows",
    """SELECT arc_id, observed_at::DATE::VARCHAR AS observation_date, count(*) AS n_rows FROM arc_upserted
ANTI JOIN arc_base ON arc_upserted.arc_id = arc_base.arc_id
  AND arc_upserted.observed_at::DATE = arc_base.observed_at::DATE
GROUP BY 1, 2""",
)
def missing_daily_rows(x: Inputs) -> DataFrame:
    """Days of the second load absent from the aggregate of the first."""
    both = merge.upserted(x.arc_raw, x.arc_batch, arcs.KEY, arcs.COMPARED)
    daily = agg.daily_aggregate(x.arc_raw, "arc_id", "observed_at", {})
    return joins.keys_without_parent(
        agg.with_day(both, "observed_at"), daily, ["arc_id", "observation_date"]
    )


@query(
    "reconciled_days",
    """WITH d AS (SELECT arc_id, observed_at::DATE AS observation_date, count(*) AS expected_count,
    count(*) FILTER (flow100 > 5000) AS expected_high FROM arc_upserted GROUP BY 1, 2),
a AS (SELECT arc_id, observed_at::DATE AS observation_date, count(*) AS stored_count,
    count(*) FILTER (flow100 > 5000) AS stored_high FROM arc_base GROUP BY 1, 2)
SELECT arc_id, observation_date::VARCHAR AS observation_date, expected_count::DOUBLE AS expected_count,
  stored_count::DOUBLE AS stored_count, expected_high::DOUBLE AS expected_high,
  stored_high::DOUBLE AS stored_high
FROM d FULL JOIN a USING (arc_id, observation_date)
WHERE expected_count IS DISTINCT FROM stored_count OR expected_high IS DISTINCT FROM stored_high""",
)
def reconciled_days(x: Inputs) -> DataFrame:
    """Day counts after the second load and after the first, compared both ways."""

    def counts(rows: DataFrame, prefix: str) -> DataFrame:
        return agg.with_day(rows, "observed_at").groupBy("arc_id", "observation_date").agg(
            F.count(F.lit(1)).alias(f"{prefix}_count"),
            F.count_if(F.col("vehicle_flow") > 50).alias(f"{prefix}_high"),
        )

    pairs = [("expected_count", "stored_count"), ("expected_high", "stored_high")]
    out = joins.reconcile(
        counts(merge.upserted(x.arc_raw, x.arc_batch, arcs.KEY, arcs.COMPARED), "expected"),
        counts(x.arc_raw, "stored"), ["arc_id", "observation_date"], pairs,
    )
    return out.select(
        "arc_id", "observation_date", *[F.col(c).cast("double").alias(c) for pair in pairs for c in pair]
    )


@query(
    "row_count_mismatch",
    """SELECT (SELECT count(DISTINCT user_id) FROM events) AS expected_count,
  (SELECT count(*) FROM customer) AS current_count
WHERE expected_count <> current_count""",
)
def row_count_mismatch(x: Inputs) -> DataFrame:
    """J4, Q10"""
    return joins.counts_differ(
        x.table("events").agg(F.count_distinct("user_id")),
        x.table("customer").agg(F.count(F.lit(1))),
        ("expected_count", "current_count"),
    )


@query(
    "check_not_null",
    """SELECT 'not_null_raw_' || c AS "check", n AS failures FROM (
  SELECT unnest(['station_id', 'total_capacity', 'mechanical_bikes', 'longitude']) AS c,
    unnest([(SELECT count(*) FROM station_staged WHERE station_id IS NULL),
            (SELECT count(*) FROM station_staged WHERE total_capacity IS NULL),
            (SELECT count(*) FROM station_staged WHERE mechanical_bikes IS NULL),
            (SELECT count(*) FROM station_staged WHERE longitude IS NULL)]) AS n)""",
)
def check_not_null(x: Inputs) -> DataFrame:
    """Q1: all columns of a table in one pass."""
    declared = quality.TableChecks(
        not_null=("station_id", "total_capacity", "mechanical_bikes", "longitude")
    )
    return quality.column_report(x.station_staged, "raw", declared)


@query(
    "check_accepted_values",
    """SELECT event_type, count(*) AS n_rows FROM events
WHERE event_type NOT IN ('click', 'view') GROUP BY 1""",
)
def check_accepted_values(x: Inputs) -> DataFrame:
    """Q3"""
    return quality.unexpected_values(x.table("events"), "event_type", ["click", "view"])


@query(
    "check_breakdown",
    f"""SELECT observation_id, station_id, mechanical_bikes::DOUBLE AS mechanical_bikes,
  electric_bikes, bikes_available, {text('status_updated_at')} FROM station_fact
WHERE coalesce(mechanical_bikes, 0) + electric_bikes <> bikes_available""",
)
def check_breakdown(x: Inputs) -> DataFrame:
    """Q5, P26"""
    return _nullable_counts(quality.breakdown_mismatch(x.station_fact))


@query(
    "check_negative_availability",
    f"""SELECT observation_id, station_id, bikes_available, docks_available,
  total_capacity::DOUBLE AS total_capacity, {text('status_updated_at')} FROM station_fact
WHERE least(bikes_available, docks_available, total_capacity) < 0""",
)
def check_negative_availability(x: Inputs) -> DataFrame:
    """Q7"""
    return _nullable_counts(quality.negative_availability(x.station_fact))


@query(
    "check_coordinates",
    """SELECT station_id, s.longitude AS longitude, s.latitude AS latitude FROM station_dim
WHERE s.longitude NOT BETWEEN -180 AND 180 OR s.latitude NOT BETWEEN -90 AND 90""",
)
def check_coordinates(x: Inputs) -> DataFrame:
    """Q8"""
    return quality.invalid_coordinates(x.station_dim)


@query(
    "check_measurements",
    f"""SELECT observation_id, arc_id, {text('observed_at')}, flow100::DOUBLE / 100 AS vehicle_flow,
  occ10::DOUBLE / 10 AS occupancy_rate FROM arc_staged WHERE flow100 < 0 OR occ10 > 1000""",
)
def check_measurements(x: Inputs) -> DataFrame:
    """Q9"""
    return quality.invalid_measurements(x.arc_fact)


@query(
    "check_station_daily_counts",
    """SELECT station_id, observation_date::VARCHAR AS observation_date,
  observation_count AS expected_observation_count, NULL::DOUBLE AS observation_count
FROM station_daily WHERE maximum_bikes_available < 25""",
)
def check_station_daily_counts(x: Inputs) -> DataFrame:
    """Against an aggregate that lost its low days."""
    partial = x.station_daily.filter("maximum_bikes_available >= 25")
    return quality.station_daily_mismatch(x.station_fact, partial).withColumn(
        "observation_count", F.col("observation_count").cast("double")
    )


@query(
    "check_arc_daily_counts",
    f"""WITH d AS (SELECT * FROM arc_daily WHERE observation_date > '2023-07-31'),
b AS (SELECT arc_id, observed_at::DATE AS observation_date, count(*) AS n, count(flow100) AS f,
    count(occ10) AS o FROM arc_upserted GROUP BY 1, 2)
SELECT arc_id, observation_date::VARCHAR AS observation_date, n::DOUBLE AS expected_observation_count,
  observation_count::DOUBLE AS observation_count, f::DOUBLE AS expected_vehicle_flow_count,
  vehicle_flow_observation_count::DOUBLE AS vehicle_flow_observation_count,
  o::DOUBLE AS expected_occupancy_count,
  occupancy_observation_count::DOUBLE AS occupancy_observation_count
FROM b FULL JOIN d USING (arc_id, observation_date)
WHERE n IS DISTINCT FROM observation_count OR f IS DISTINCT FROM vehicle_flow_observation_count
  OR o IS DISTINCT FROM occupancy_observation_count""",
)
def check_arc_daily_counts(x: Inputs) -> DataFrame:
    """An aggregate that missed the second load."""
    raw = merge.upserted(x.arc_raw, x.arc_batch, arcs.KEY, arcs.COMPARED)
    out = quality.arc_daily_mismatch(arcs.stage_arcs(raw), x.arc_daily, ARC_AS_OF)
    keys = ("arc_id", "observation_date")
    return out.select(*keys, *[F.col(c).cast("double").alias(c) for c in out.columns if c not in keys])


@query(
    "check_station_daily_consistent",
    """SELECT daily_station_id, station_id, observation_count FROM (
  SELECT * REPLACE (observation_count - 1 AS observation_count) FROM station_daily)
WHERE observation_count <= 0 OR empty_observation_count > observation_count
  OR no_dock_observation_count > observation_count
  OR out_of_service_observation_count > observation_count
  OR capacity_anomaly_count > observation_count""",
)
def check_station_daily_consistent(x: Inputs) -> DataFrame:
    """Q13: an aggregate whose row counts are one too low."""
    low = x.station_daily.withColumn("observation_count", F.col("observation_count") - 1)
    return quality.station_daily_inconsistent(low).select(
        "daily_station_id", "station_id", "observation_count"
    )


@query(
    "check_arc_daily_consistent",
    "SELECT daily_traffic_id, arc_id, observation_count FROM arc_daily "
    "WHERE max_occ10 > 1000 OR blocked_observation_count > 0",
)
def check_arc_daily_consistent(x: Inputs) -> DataFrame:
    """Q14: an aggregate that miscounts blocked observations; occupancy above 100 fails too."""
    wrong = x.arc_daily.withColumn(
        "blocked_observation_count", F.col("blocked_observation_count") * 2
    )
    return quality.arc_daily_inconsistent(
        wrong, list(arcs.TRAFFIC_COUNTERS.values()), list(arcs.ARC_COUNTERS.values())
    ).select("daily_traffic_id", "arc_id", "observation_count")


@query(
    "snapshot_consistency",
    """SELECT 'raw_road_traffic' AS "table", count(*) AS n_rows,
  count(DISTINCT (arc_id, observed_at)) AS n_keys, n_rows = n_keys AS valid FROM arc_base
UNION ALL SELECT 'fct_road_traffic', count(*), count(DISTINCT observation_id), count(*) = count(DISTINCT observation_id) FROM arc_staged
UNION ALL SELECT 'dim_road_arcs', count(*), count(DISTINCT arc_id), count(*) = count(DISTINCT arc_id) FROM arc_dim
UNION ALL SELECT 'agg_road_traffic_daily', count(*), count(DISTINCT daily_traffic_id), count(*) = count(DISTINCT daily_traffic_id) FROM arc_daily
UNION ALL SELECT 'lines', count(*), count(DISTINCT (l_orderkey, l_linenumber)), count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""",
)
def snapshot_consistency(x: Inputs) -> DataFrame:
    """Q16, A14, O5"""
    t = x.named()
    tables = {n: (t[n], key) for n, key in snapshot.CONSISTENT.items()}
    tables["lines"] = (x.table("lineitem"), ("l_orderkey", "l_linenumber"))
    return quality.key_consistency(tables)


def _all_checks_oracle() -> str:
    """Every declared and business check, counted over the model oracles."""
    models = {
        "raw_stations": "SELECT stationcode, last_reported, ingested_at FROM station_raw",
        "raw_road_traffic": "SELECT arc_id, observed_at, ingested_at, source_run_id FROM arc_base",
        "ingestion_runs": _FINAL["station_run_rows"],
        "traffic_ingestion_runs": _FINAL["arc_run_rows"],
        "dim_stations": _FINAL["station_dim_rows"],
        "fct_station_status": _FINAL["station_fact_rows"],
        "agg_station_daily": _FINAL["station_daily_rows"],
        "station_current": _FINAL["station_current_rows"],
        "dim_road_arcs": _FINAL["arc_dim_rows"],
        "fct_road_traffic": _FINAL["arc_staging"],
        "agg_road_traffic_daily": _FINAL["arc_daily_rows"],
        "arc_current": _FINAL["arc_current_rows"],
        "station_runs": _FINAL["station_run_rows"],
        "arc_runs": _FINAL["arc_run_rows"],
        "all_runs": _FINAL["all_run_rows"],
    }

    def quoted(values) -> str:
        return ", ".join(str(v).lower() if isinstance(v, bool) else f"'{v}'" for v in values)

    parts: list[str] = []

    def count(name: str, source: str, severity: str = "error") -> None:
        bad = "fail" if severity == "error" else "warn"
        parts.append(
            f"""SELECT '{name}' AS "check", '{severity}' AS severity, count(*) AS failures,
  CASE WHEN count(*) = 0 THEN 'pass' ELSE '{bad}' END AS status FROM ({source})"""
        )

    for table, declared in checks.DECLARED.items():
        for c in declared.not_null:
            count(f"not_null_{table}_{c}", f"SELECT 1 FROM m_{table} WHERE {c} IS NULL")
        for c, values in declared.accepted.items():
            count(f"accepted_values_{table}_{c}",
                  f"SELECT 1 FROM m_{table} WHERE {c} NOT IN ({quoted(values)})")
        for c in declared.unique:
            count(f"unique_{table}_{c}",
                  f"SELECT {c} FROM m_{table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1")
        for c, parent in declared.parents.items():
            count(f"relationships_{table}_{c}",
                  f"SELECT 1 FROM m_{table} WHERE {c} NOT IN (SELECT {c} FROM m_{parent})")
    business = {
        "bike_breakdown_matches_total": _FINAL["check_breakdown"],
        "bikes_under_capacity": _FINAL["stored_failures"],
        "non_negative_availability": _FINAL["check_negative_availability"],
        "valid_station_coordinates": _FINAL["check_coordinates"],
        "valid_traffic_measurements": _FINAL["check_measurements"],
        "arc_daily_consistent": "SELECT 1 FROM arc_daily WHERE max_occ10 > 1000",
        # these compare tables that were derived from each other
        **dict.fromkeys(
            ("station_status_row_count", "arc_status_row_count", "station_daily_matches_fact",
             "arc_daily_matches_fact", "station_daily_consistent"),
            "SELECT 1 WHERE false",
        ),
    }
    for name, source in business.items():
        count(name, source, "warn" if name == "bikes_under_capacity" else "error")
    tables = ",\n".join(f"m_{name} AS ({sql})" for name, sql in models.items())
    return f"WITH {tables}\n" + "\nUNION ALL ".join(parts)


@query("all_checks", _all_checks_oracle())
def all_checks(x: Inputs) -> DataFrame:
    """Q1-Q16: the 183 declared and 11 business checks; 194 result rows."""
    x.keep("station_staged")  # four of the tables are built on it
    return checks.run_all_checks(x.named(), ARC_AS_OF)


# -- dashboards ---------------------------------------------------------------

_OK_PCT = two("100 * count(*) FILTER (is_success)", "count(*)")


@query("serve_success_rate", f"SELECT {_OK_PCT} AS success_rate_percent FROM all_runs")
def serve_success_rate(x: Inputs) -> DataFrame:
    """K1, A10"""
    return serve.success_rate(x.all_runs)


@query("serve_run_count", "SELECT count(*) AS run_count FROM all_runs")
def serve_run_count(x: Inputs) -> DataFrame:
    """K2, A3"""
    return serve.run_count(x.all_runs)


@query(
    "serve_average_duration",
    f"""SELECT {half_up('sum(ms)', '10 * count(*)')}::DOUBLE / 100 AS average_duration_seconds
FROM all_runs""",
)
def serve_average_duration(x: Inputs) -> DataFrame:
    """K3, A6"""
    return serve.average_duration(x.all_runs)


@query(
    "serve_records_received",
    "SELECT sum(received)::BIGINT AS records_received FROM all_runs",
)
def serve_records_received(x: Inputs) -> DataFrame:
    """K4, A8"""
    return serve.records_received(x.all_runs)


@query(
    "serve_duration_series",
    """SELECT date_trunc('minute', started_at)::VARCHAR AS started_at,
  (sum(ms) FILTER (pipeline_name = 'Vélib'))::DOUBLE / 1000
    / count(*) FILTER (pipeline_name = 'Vélib') AS "Vélib",
  (sum(ms) FILTER (pipeline_name = 'Trafic routier'))::DOUBLE / 1000
    / count(*) FILTER (pipeline_name = 'Trafic routier') AS "Trafic routier"
FROM all_runs GROUP BY 1""",
)
def serve_duration_series(x: Inputs) -> DataFrame:
    """Every minute with a run."""
    return serve.duration_series(x.all_runs)


@query(
    "serve_volumes",
    """SELECT pipeline_name, sum(received)::BIGINT AS records_received,
  sum(inserted)::BIGINT AS records_inserted, sum(unchanged)::BIGINT AS records_unchanged
FROM all_runs GROUP BY 1""",
)
def serve_volumes(x: Inputs) -> DataFrame:
    """K6"""
    return serve.volumes(x.all_runs)


@query(
    "serve_latest_runs",
    f"""SELECT pipeline_name, {text('started_at')}, status, {_RUN_OUT}, duration_seconds,
  records_per_second FROM all_runs ORDER BY all_runs.started_at DESC, pipeline_run_id DESC LIMIT 20""",
)
def serve_latest_runs(x: Inputs) -> DataFrame:
    """K7, L1"""
    return serve.latest_runs(x.all_runs)


@query("serve_station_count", "SELECT count(*) AS station_count FROM station_current")
def serve_station_count(x: Inputs) -> DataFrame:
    """K8"""
    return serve.station_count(x.station_current)


@query(
    "serve_bikes_now",
    "SELECT sum(bikes_available)::BIGINT AS bikes_available FROM station_current",
)
def serve_bikes_now(x: Inputs) -> DataFrame:
    """K9"""
    return serve.bikes_now(x.station_current)


@query(
    "serve_docks_now",
    "SELECT sum(docks_available)::BIGINT AS docks_available FROM station_current",
)
def serve_docks_now(x: Inputs) -> DataFrame:
    """K10"""
    return serve.docks_now(x.station_current)


@query(
    "serve_empty_stations",
    "SELECT count(*) FILTER (bikes_available = 0) AS empty_stations FROM station_current",
)
def serve_empty_stations(x: Inputs) -> DataFrame:
    """K11, A9"""
    return serve.empty_stations(x.station_current)


@query(
    "serve_stations_by_status",
    """SELECT station_status, count(*) AS station_count,
  count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM station_current GROUP BY 1""",
)
def serve_stations_by_status(x: Inputs) -> DataFrame:
    """K12, A20, L4"""
    return serve.stations_by_status(x.station_current)


@query(
    "serve_station_points",
    """SELECT station_id, longitude, latitude, station_status, station_name, docks_available,
  bikes_available FROM station_current WHERE longitude IS NOT NULL AND latitude IS NOT NULL
ORDER BY station_id""",
)
def serve_station_points(x: Inputs) -> DataFrame:
    """K13, P25, L5"""
    return serve.station_points(x.station_current)


@query(
    "serve_bikes_per_day",
    f"""SELECT observation_date::TIMESTAMP::VARCHAR AS observation_date,
  (sum({half_up('100 * bikes', 'n')})::DOUBLE / 100) / count(*) AS average_bikes_available
FROM (SELECT station_id, status_updated_at::DATE AS observation_date,
  sum(bikes_available) AS bikes, count(*) AS n FROM station_staged GROUP BY 1, 2)
WHERE observation_date >= '2001-11-01' AND observation_date < '2001-12-01' GROUP BY observation_date""",
)
def serve_bikes_per_day(x: Inputs) -> DataFrame:
    """K14, A12, P24"""
    return serve.bikes_per_day(x.station_daily, STATION_AS_OF)


@query("serve_arc_count", "SELECT count(*) AS arc_count FROM arc_current")
def serve_arc_count(x: Inputs) -> DataFrame:
    """K15"""
    return serve.arc_count(x.arc_current)


@query(
    "serve_mean_flow",
    "SELECT sum(flow100)::DOUBLE / 100 / count(flow100) AS mean_vehicle_flow FROM arc_current",
)
def serve_mean_flow(x: Inputs) -> DataFrame:
    """K16"""
    return serve.mean_flow(x.arc_current)


@query(
    "serve_mean_occupancy",
    "SELECT sum(occ10)::DOUBLE / 10 / count(occ10) AS mean_occupancy_rate FROM arc_current",
)
def serve_mean_occupancy(x: Inputs) -> DataFrame:
    """K17"""
    return serve.mean_occupancy(x.arc_current)


@query(
    "serve_congested_arcs",
    """SELECT count(*) AS congested_arcs FROM arc_current
WHERE traffic_status IN ('Saturé', 'Bloqué')""",
)
def serve_congested_arcs(x: Inputs) -> DataFrame:
    """K18, P23"""
    return serve.congested_arcs(x.arc_current)


@query(
    "serve_arcs_by_status",
    """SELECT traffic_status, count(*) AS arc_count,
  count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM arc_current GROUP BY 1""",
)
def serve_arcs_by_status(x: Inputs) -> DataFrame:
    """K19"""
    return serve.arcs_by_status(x.arc_current)


@query(
    "serve_arc_points",
    """SELECT arc_id, longitude, latitude, traffic_status, arc_label, arc_status,
  flow100::DOUBLE / 100 AS vehicle_flow, occ10::DOUBLE / 10 AS occupancy_rate FROM arc_current
WHERE longitude IS NOT NULL AND latitude IS NOT NULL""",
)
def serve_arc_points(x: Inputs) -> DataFrame:
    """K20"""
    return serve.arc_points(x.arc_current)


@query(
    "serve_flow_per_day",
    """SELECT observation_date::TIMESTAMP::VARCHAR AS observation_date,
  sum(avg_flow100 * vehicle_flow_observation_count)::DOUBLE / 100
    / sum(vehicle_flow_observation_count) AS mean_daily_flow
FROM arc_daily WHERE observation_date > '2023-12-31' AND observation_date <= '2024-01-31'
GROUP BY observation_date""",
)
def serve_flow_per_day(x: Inputs) -> DataFrame:
    """K21, A11, P24"""
    return serve.flow_per_day(x.arc_daily, ARC_AS_OF)


@query(
    "serve_filtered",
    f"""SELECT {_OK_PCT} AS success_rate_percent, count(*) AS run_count,
  sum(received)::BIGINT AS records_received
FROM all_runs WHERE pipeline_name = 'Trafic routier' AND status IN ('success', 'failed')""",
)
def serve_filtered(x: Inputs) -> DataFrame:
    """Dashboard filters; an empty selection means everything."""
    return agg.side_by_side(
        serve.success_rate(x.all_runs, _CHOSEN),
        serve.run_count(x.all_runs, _CHOSEN),
        serve.records_received(x.all_runs, _CHOSEN),
    )


_CHOSEN = {"pipeline_name": ["Trafic routier"], "status": ["success", "failed"], "dag_id": []}
_CHOSEN_SQL = "pipeline_name = 'Trafic routier' AND status IN ('success', 'failed')"


@query(
    "serve_filtered_duration",
    f"""SELECT {half_up('sum(ms)', '10 * count(*)')}::DOUBLE / 100 AS average_duration_seconds
FROM all_runs WHERE {_CHOSEN_SQL}""",
)
def serve_filtered_duration(x: Inputs) -> DataFrame:
    """K22, K3"""
    return serve.average_duration(x.all_runs, _CHOSEN)


@query(
    "serve_filtered_series",
    f"""SELECT date_trunc('minute', started_at)::VARCHAR AS started_at, NULL::DOUBLE AS "Vélib",
  sum(ms)::DOUBLE / 1000 / count(*) AS "Trafic routier"
FROM all_runs WHERE {_CHOSEN_SQL} GROUP BY 1""",
)
def serve_filtered_series(x: Inputs) -> DataFrame:
    """A feed that is not chosen keeps its column, without values."""
    return serve.duration_series(x.all_runs, _CHOSEN)


@query(
    "serve_filtered_volumes",
    f"""SELECT pipeline_name, sum(received)::BIGINT AS records_received,
  sum(inserted)::BIGINT AS records_inserted, sum(unchanged)::BIGINT AS records_unchanged
FROM all_runs WHERE {_CHOSEN_SQL} GROUP BY 1""",
)
def serve_filtered_volumes(x: Inputs) -> DataFrame:
    """K22, K6"""
    return serve.volumes(x.all_runs, _CHOSEN)


@query(
    "serve_filtered_runs",
    f"""SELECT pipeline_name, {text('started_at')}, status, {_RUN_OUT}, duration_seconds,
  records_per_second FROM all_runs WHERE {_CHOSEN_SQL}
ORDER BY all_runs.started_at DESC, pipeline_run_id DESC LIMIT 20""",
)
def serve_filtered_runs(x: Inputs) -> DataFrame:
    """The newest of the chosen runs, not the chosen of the newest."""
    return serve.latest_runs(x.all_runs, _CHOSEN)


@query(
    "serve_failed_runs",
    f"SELECT run_id, {text('started_at')}, error_message FROM station_runs WHERE NOT is_success",
)
def serve_failed_runs(x: Inputs) -> DataFrame:
    """K23, P28"""
    return serve.failed_runs(x.station_runs).select("run_id", "started_at", "error_message")


@query("serve_success_by_cast", f"SELECT {_OK_PCT} AS success_rate_percent FROM station_runs")
def serve_success_by_cast(x: Inputs) -> DataFrame:
    """K23, A10"""
    return serve.success_rate_by_cast(x.station_runs)


# -- maintenance --------------------------------------------------------------

_POLICY = retention.Policy(
    station_raw_days=400, station_fact_months=24, arc_raw_days=7, arc_fact_months=6, run_months=12
)
_CUTS = {
    "station_raw": f"{STATION_NOW} - INTERVAL 400 DAY",
    "station_fact": f"{STATION_NOW} - INTERVAL 24 MONTH",
    "arc_raw": f"{STATION_NOW} - INTERVAL 7 DAY",
    "runs": f"{STATION_NOW} - INTERVAL 12 MONTH",
}


def _retention_tables(x: Inputs) -> dict[str, DataFrame]:
    return {
        "station_raw": x.station_raw,
        "station_fact": x.station_fact,
        "arc_raw": x.arc_raw,
        "arc_fact": x.arc_fact,
        "station_runs": x.station_log,
        "arc_runs": x.arc_log,
        "station_daily": x.station_daily,
        "arc_daily": x.arc_daily,
    }


@query(
    "retention_candidates",
    f"""SELECT
  (SELECT count(*) FROM station_raw WHERE ingested_at < {_CUTS['station_raw']}) AS station_raw_candidates,
  (SELECT count(*) FROM station_fact WHERE status_updated_at < {_CUTS['station_fact']}) AS station_fact_candidates,
  0 AS arc_raw_candidates, 0 AS arc_fact_candidates,
  (SELECT count(*) FROM station_runs WHERE started_at < {_CUTS['runs']}) AS station_runs_candidates,
  (SELECT count(*) FROM arc_runs WHERE started_at < {_CUTS['runs']}) AS arc_runs_candidates,
  (SELECT count(*) FROM station_daily) AS station_daily_preserved,
  (SELECT count(*) FROM arc_daily) AS arc_daily_preserved""",
)
def retention_candidates(x: Inputs) -> DataFrame:
    """O1, A17"""
    return retention.retention_preview(_retention_tables(x), _POLICY, STATION_AS_OF)


@query(
    "retention_unprotected",
    f"""SELECT station_id, observation_date::VARCHAR AS observation_date, count(*) AS n_rows
FROM (SELECT *, status_updated_at::DATE AS observation_date FROM station_fact
  WHERE status_updated_at < {_CUTS['station_fact']})
ANTI JOIN (SELECT * FROM station_daily WHERE maximum_bikes_available >= 25)
  USING (station_id, observation_date)
GROUP BY ALL""",
)
def retention_unprotected(x: Inputs) -> DataFrame:
    """Expired facts that an incomplete aggregate does not preserve."""
    tables = _retention_tables(x)
    tables["station_daily"] = x.station_daily.filter("maximum_bikes_available >= 25")
    return retention.retention_guard(tables, _POLICY, STATION_AS_OF)["station_fact"]


@query(
    "retention_kept_rows",
    f"""SELECT run_id, {text('started_at')} FROM station_runs
WHERE started_at >= {RUN_NOW} - INTERVAL 12 MONTH""",
)
def retention_kept_rows(x: Inputs) -> DataFrame:
    """O3: what a deletion from the stored run log leaves."""
    from obs_engine.operators.runs import STATION_RUNS

    wh = _warehouse(x, "retention")
    wh.rebuild(STATION_RUNS, x.station_log)
    rule = retention.rules(_POLICY, RUN_AS_OF)["station_runs"]
    wh.delete_where(rule.spec, rule.expired())
    return wh.read(rule.spec).select("run_id", "started_at")


@query(
    "retention_purged_days",
    f"""SELECT observation_id, station_id, {text('status_updated_at')} FROM station_fact
WHERE status_updated_at >= {_CUTS['station_fact']}""",
)
def retention_purged_days(x: Inputs) -> DataFrame:
    """Purged facts do not come back with the next increment."""
    wh = _warehouse(x, "purge")
    wh.rebuild(STATION_FACT, x.station_fact)
    rule = retention.rules(_POLICY, STATION_AS_OF)["station_fact"]
    rule = dataclasses.replace(rule, spec=STATION_FACT)
    wh.delete_where(STATION_FACT, rule.expired(), rule.old_partitions())
    incremental.load_increment(wh, STATION_FACT, x.station_raw, stations.fact_of_raw)
    return wh.read(STATION_FACT).select("observation_id", "station_id", "status_updated_at")


@query(
    "snapshot_row_counts",
    """SELECT 'raw_road_traffic' AS "table", count(*) AS n_rows FROM arc_base
UNION ALL SELECT 'agg_road_traffic_daily', count(*) FROM arc_daily
UNION ALL SELECT 'raw_stations', count(*) FROM station_raw""",
)
def snapshot_row_counts(x: Inputs) -> DataFrame:
    """A copied warehouse and its manifest."""
    wh = _warehouse(x, "snapshot")
    wh.rebuild(arcs.RAW, x.arc_raw)
    wh.rebuild(arcs.DAILY, x.arc_daily)
    wh.rebuild(STATION_RAW, x.station_raw)
    manifest = snapshot.snapshot(wh, work_path(x.spark, "copy"))
    return x.spark.createDataFrame(
        [(name, t["n_rows"]) for name, t in manifest.items()], "table STRING, n_rows LONG"
    )


_GUARDED = retention.Policy(
    station_raw_days=8900, station_fact_months=290, arc_raw_days=7, arc_fact_months=1, run_months=282
)
_EXPIRING = ("station_raw", "station_fact", "arc_raw", "arc_fact", "station_runs", "arc_runs")
_GUARDED_CUTS = {
    "station_raw": f"ingested_at < {ARC_NOW} - INTERVAL 8900 DAY",
    "station_fact": f"status_updated_at < {ARC_NOW} - INTERVAL 290 MONTH",
    "arc_upserted": f"ingested_at < {ARC_NOW} - INTERVAL 7 DAY",
    "arc_staged": f"observed_at < {ARC_NOW} - INTERVAL 1 MONTH",
    "station_runs": f"started_at < {ARC_NOW} - INTERVAL 282 MONTH",
    "arc_runs": f"started_at < {ARC_NOW} - INTERVAL 282 MONTH",
}


def _stored_feeds(x: Inputs, label: str) -> merge.Warehouse:
    """The tables of both feeds, the station ones by month.

    What follows from the facts is built on the stored ones, so staging is done once.
    """
    wh = _warehouse(x, label)
    wh.rebuild(STATION_RAW, x.station_raw)
    fact = wh.rebuild(STATION_FACT, x.station_fact)
    wh.rebuild(stations.DIM, stations.station_dim(fact))
    wh.rebuild(stations.DAILY.monthly(), stations.station_daily(fact))
    wh.rebuild(STATION_RUNS, x.station_log)
    wh.rebuild(arcs.RAW, x.arc_raw)
    fact = wh.rebuild(arcs.FACT, x.arc_fact)
    wh.rebuild(arcs.DIM, arcs.arc_dim(fact))
    wh.rebuild(arcs.DAILY, arcs.arc_daily(fact))
    wh.rebuild(ARC_RUNS, x.arc_log)
    return wh


@query(
    "retention_stored_candidates",
    "SELECT "
    + ", ".join(
        f"(SELECT count(*) FROM {t.replace('upserted', 'base')} WHERE {cut}) AS {name}_candidates"
        for name, (t, cut) in zip(_EXPIRING, _GUARDED_CUTS.items())
    )
    + ", (SELECT count(*) FROM station_daily) AS station_daily_preserved,"
    " (SELECT count(*) FROM arc_daily) AS arc_daily_preserved",
)
def retention_stored_candidates(x: Inputs) -> DataFrame:
    """Of stored tables, whole partitions counted from file footers."""
    return retention.stored_preview(_stored_feeds(x, "preview"), _GUARDED, ARC_AS_OF, monthly=True)


@query(
    "retention_guarded_job",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) FILTER ({cut}) AS deleted, "
        f"count(*) FILTER (({cut}) IS NOT TRUE) AS kept, count(*) AS restored FROM {t}"
        for name, (t, cut) in zip(_EXPIRING, _GUARDED_CUTS.items())
    ),
)
def retention_guarded_job(x: Inputs) -> DataFrame:
    """Two snapshots, the second of what a correction changed, both verified; expired
    rows deleted; the rows of before restored from the second."""
    wh = _stored_feeds(x, "guarded")
    first, second = work_path(x.spark, "first"), work_path(x.spark, "second")
    snapshot.snapshot(wh, first)
    snapshot.verify_snapshot(wh, first, ARC_AS_OF)
    wh.upsert(arcs.RAW, x.arc_batch, arcs.COMPARED)
    manifest = snapshot.snapshot(wh, second, base=first)
    snapshot.verify_snapshot(wh, second, ARC_AS_OF)
    deleted = retention.apply_retention(
        wh, _GUARDED, ARC_AS_OF, True, retention.CONFIRMATION, second, monthly=True
    )
    rows = []
    for name, rule in retention.rules(_GUARDED, ARC_AS_OF, monthly=True).items():
        copy = snapshot.read_copy(wh, second, rule.spec.name, manifest)
        kept, restored = wh.counted(rule.spec).withColumnRenamed("n", "kept"), copy.agg(F.count(F.lit(1)).alias("restored"))
        gone = F.lit(deleted[f"{name}_deleted"]).cast("long").alias("deleted")
        rows.append(agg.side_by_side(kept, restored).select(F.lit(name).alias("table"), gone, "kept", "restored"))
    return functools.reduce(DataFrame.unionByName, rows)


@query(
    "snapshot_changed_days",
    f"""WITH u AS (
  SELECT arc_id, observed_at, ingested_at FROM arc_base WHERE observed_at < TIMESTAMP '{_HALF}'
  UNION ALL SELECT arc_id, observed_at, ingested_at FROM arc_upserted WHERE observed_at >= TIMESTAMP '{_HALF}')
SELECT u.observed_at::DATE::VARCHAR AS day, count(*) AS n_rows,
  bool_or(b.arc_id IS NULL OR u.ingested_at IS DISTINCT FROM b.ingested_at) AS copied
FROM u LEFT JOIN arc_base AS b ON u.arc_id = b.arc_id AND u.observed_at = b.observed_at
GROUP BY 1""",
)
def snapshot_changed_days(x: Inputs) -> DataFrame:
    """The second snapshot of a table copies the days that a correction of the newer half touched."""
    wh = _warehouse(x, "changed-days")
    wh.rebuild(arcs.RAW, x.arc_raw)
    first, second = work_path(x.spark, "first"), work_path(x.spark, "second")
    snapshot.snapshot(wh, first, [arcs.RAW])
    snapshot.verify_content(wh, first, ARC_AS_OF)
    late = F.col("observed_at") >= F.lit(_HALF).cast("timestamp")
    wh.upsert(arcs.RAW, x.arc_batch.filter(late), arcs.COMPARED)
    snapshot.snapshot(wh, second, [arcs.RAW], base=first)
    return snapshot.partition_report(wh, second, arcs.RAW.name).select(F.col("partition").alias("day"), "n_rows", "copied")


# -- streaming ----------------------------------------------------------------


def _event_files(x: Inputs) -> str:
    """The events as several files, so that a stream sees several micro-batches."""
    path = work_path(x.spark, "event-files")
    events = x.table("events")
    for low in (0, 1):
        events.filter(F.col("event_id") % 2 == low).write.mode("append").parquet(path)
    return path


def _files(x: Inputs, path: str) -> int:
    return len(x.spark.read.parquet(path).inputFiles())


def _event_stream(x: Inputs) -> DataFrame:
    """Two micro-batches, one for each writing, however many files these took."""
    path = _event_files(x)
    return flows.stream_files(
        x.spark, path, x.table("events").schema, files_per_trigger=-(-_files(x, path) // 2)
    )


def _finish(stream_query) -> None:
    stream_query.awaitTermination()


@query("stream_upsert", f"SELECT {_ARC_OUT} FROM arc_upserted")
def stream_upsert(x: Inputs) -> DataFrame:
    """Both loads as a stream of files equal the batch upsert."""
    wh, path = _warehouse(x, "stream-upsert"), work_path(x.spark, "loads")
    checkpoint = work_path(x.spark, "checkpoint")
    for batch in (x.arc_raw, x.arc_batch):
        batch.write.mode("append").parquet(path)
        # A load is one micro-batch, however many files it took: each rewrites what it changes.
        stream = flows.stream_files(x.spark, path, x.arc_raw.schema, files_per_trigger=_files(x, path))
        _finish(flows.upsert_stream(
            stream, wh, arcs.RAW, arcs.COMPARED, ["ingested_at"], checkpoint
        ))
    return wh.read(arcs.RAW).select(*_ARC_COLUMNS)


_EVENT_DAY = merge.TableSpec(
    "event_days", ("user_id", "observation_date"),
    merge.by_day("observation_date", column="observation_date"),
)
_EVENT_LATEST = merge.TableSpec("event_latest", ("user_id",), merge.by_bucket("user_id"))
_EVENT_FIRST = merge.TableSpec("event_first", ("user_id", "hour"), merge.by_day("hour"))


@query(
    "stream_daily",
    """SELECT user_id, ts::DATE::VARCHAR AS observation_date, count(*) AS observation_count,
  max(value) AS maximum_value FROM events GROUP BY 1, 2""",
)
def stream_daily(x: Inputs) -> DataFrame:
    """One-day windows in update mode, kept in a stored table."""
    wh = _warehouse(x, "stream-daily")
    days = flows.day_window_stream(
        _event_stream(x), "user_id", "ts", {"maximum_value": F.max("value")}, "60 days"
    )
    _finish(flows.keep_table(days, wh, _EVENT_DAY, work_path(x.spark, "checkpoint")))
    return wh.read(_EVENT_DAY)


@query(
    "stream_latest",
    f"""SELECT user_id, event_id, event_type, {text('ts')} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_latest(x: Inputs) -> DataFrame:
    """Latest state per key as a running aggregate."""
    wh = _warehouse(x, "stream-latest")
    state = flows.latest_state_stream(
        _event_stream(x).select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts"]
    )
    _finish(flows.keep_table(state, wh, _EVENT_LATEST, work_path(x.spark, "checkpoint")))
    return wh.read(_EVENT_LATEST)


_ENDS = ("2024-01-11", "2024-01-21", "2024-01-31")
_POLLED = f"""w0 AS (SELECT max(ts) AS m FROM events WHERE ts <= '{_ENDS[0]}' AND event_id % 10 <> 3),
w1 AS (SELECT max(ts) AS m FROM events WHERE ts <= '{_ENDS[1]}'),
seen AS (
  SELECT e.*, event_id % 7 <> 0 AS has_flow, ts <= '{_ENDS[0]}' AND event_id % 10 <> 3 AS p0,
    ts >= date_trunc('second', w0.m - INTERVAL 2 HOUR) AND ts <= '{_ENDS[1]}' AS p1,
    ts >= date_trunc('second', w1.m - INTERVAL 2 HOUR) AND ts <= '{_ENDS[2]}' AS p2
  FROM events e, w0, w1)"""


def _polled(x: Inputs, label: str) -> tuple[merge.Warehouse, list]:
    """Three polls of a feed that corrects and delays records, into one warehouse."""
    wh, checkpoint = _warehouse(x, label), work_path(x.spark, f"{label}-checkpoint")
    path = work_path(x.spark, f"{label}-feed")
    feed.feed_records(x).repartitionByRange("t").sortWithinPartitions("t").write.parquet(path)
    loads = []
    for n, end in enumerate(_ENDS):
        at = datetime.fromisoformat(end).replace(tzinfo=timezone.utc)
        loads += jobs.poll_arcs(
            wh, feed.StoredFeed(path, n), checkpoint, f"poll-{n}", at, initial_hours=264, hours=24
        )
    return wh, loads


@query(
    "polled_arcs",
    f"""WITH {_POLLED}
SELECT user_id::VARCHAR AS arc_id, ts::VARCHAR AS observed_at,
  CASE WHEN has_flow THEN round(value + CASE WHEN event_id % 10 = 0 AND (p1 OR p2) THEN 1
    WHEN event_id % 10 = 5 AND p2 THEN 1 ELSE 0 END, 2) END AS vehicle_flow,
  CASE WHEN has_flow AND event_id % 10 = 5 AND p2 AND (p0 OR p1) THEN '{_ENDS[2]} 00:00:00'
       WHEN has_flow AND event_id % 10 = 0 AND p0 AND p1 THEN '{_ENDS[1]} 00:00:00'
       WHEN p0 THEN '{_ENDS[0]} 00:00:00' WHEN p1 THEN '{_ENDS[1]} 00:00:00' ELSE '{_ENDS[2]} 00:00:00' END AS ingested_at
FROM seen WHERE p0 OR p1 OR p2""",
)
def polled_arcs(x: Inputs) -> DataFrame:
    """Three polled windows with late corrections, and when each row was loaded."""
    wh, _ = _polled(x, "polled")
    return wh.read(arcs.RAW).select("arc_id", "observed_at", "vehicle_flow", "ingested_at")


@query(
    "polled_counts",
    f"""WITH {_POLLED}
SELECT 0 AS poll, count(*) AS received, count(*) AS inserted, 0 AS updated FROM seen WHERE p0
UNION ALL SELECT 1, count(*), count(*) FILTER (NOT p0), count(*) FILTER (p0 AND has_flow AND event_id % 10 = 0) FROM seen WHERE p1
UNION ALL SELECT 2, count(*), count(*) FILTER (NOT (p0 OR p1)),
  count(*) FILTER ((p0 OR p1) AND has_flow AND event_id % 10 = 5) FROM seen WHERE p2""",
)
def polled_counts(x: Inputs) -> DataFrame:
    """What each poll received, inserted and corrected."""
    _, loads = _polled(x, "polled-counts")
    rows = [(n, r.received, r.inserted, r.updated) for n, r in enumerate(loads)]
    return x.spark.createDataFrame(rows, "poll LONG, received LONG, inserted LONG, updated LONG")


_ROUNDS = 4
# Rounds by event number; every fifth row comes one round late.
_DELIVERED = f"""delivered AS (
  SELECT e.*, least(event_id * {_ROUNDS} // (SELECT max(event_id) + 1 FROM events)
    + CASE WHEN event_id % 5 = 3 THEN 1 ELSE 0 END, {_ROUNDS - 1})::BIGINT AS round FROM events e),
marks AS (SELECT round, max(max(epoch_ms(ts))) OVER (ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 7200000 AS mark
  FROM delivered GROUP BY round),
live AS (SELECT d.* FROM delivered d JOIN marks USING (round) WHERE epoch_us(ts) >= coalesce(mark, 0) * 1000)"""


def _in_rounds(x: Inputs, label: str, emitted) -> DataFrame:
    """Events delivered in rounds, some late, to ``emitted(stream)``; all it emits, with the round."""
    source, out = work_path(x.spark, f"{label}-source"), work_path(x.spark, f"{label}-out")
    checkpoint = work_path(x.spark, f"{label}-checkpoint")
    events = x.table("events")
    n = F.lit(events.agg(F.max("event_id")).first()[0] + 1)
    late = F.when(F.col("event_id") % 5 == 3, 1).otherwise(0)
    rounds = F.least(F.floor(F.col("event_id") * _ROUNDS / n) + late, F.lit(_ROUNDS - 1)).cast("long")
    for i in range(_ROUNDS):
        events.withColumn("round", rounds).where(F.col("round") == i).drop("round").write.mode("append").parquet(source)
        stream = flows.stream_files(x.spark, source, events.schema)
        write = lambda batch, _, i=i: batch.withColumn("round", F.lit(i).cast("long")).write.mode("append").parquet(out)
        _finish(flows.each_batch(emitted(stream), write, checkpoint, "update"))
    return x.spark.read.parquet(out)


@query(
    "stream_expiring_latest",
    f"""WITH {_DELIVERED},
best AS (SELECT user_id, round, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM live GROUP BY user_id, round),
runs AS (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM best)
SELECT user_id, event_id, ts::VARCHAR AS ts, round FROM runs WHERE before IS NULL OR ts > before""",
)
def stream_expiring_latest(x: Inputs) -> DataFrame:
    """Each change of a key's latest row; state expires, rows over two hours late are dropped."""
    def latest(stream: DataFrame) -> DataFrame:
        return expiring.expiring_latest(stream.select("user_id", "event_id", "ts"), ["user_id"], "ts", "event_id", "2 hours")

    return _in_rounds(x, "expiring-latest", latest).select("user_id", "event_id", "ts", "round")


@query(
    "stream_expiring_first",
    f"""WITH {_DELIVERED}
SELECT user_id, date_trunc('hour', ts)::VARCHAR AS hour, event_id, round FROM live
QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY round, ts, event_id) = 1""",
)
def stream_expiring_first(x: Inputs) -> DataFrame:
    """The first row of a key to arrive stays; a late one is kept within two hours, else dropped."""
    def first(stream: DataFrame) -> DataFrame:
        hour = F.date_trunc("hour", F.col("ts"))
        rows = stream.select("user_id", hour.alias("hour"), "event_id", "ts", (hour + F.make_dt_interval(hours=F.lit(1))).alias("hour_end"))
        return expiring.expiring_first(rows, ["user_id", "hour"], "ts", "event_id", "2 hours", "hour_end")

    return _in_rounds(x, "expiring-first", first).select("user_id", "hour", "event_id", "round")


@query(
    "stream_first_wins",
    "SELECT user_id, date_trunc('hour', ts)::VARCHAR AS hour, min(ts)::VARCHAR AS ts FROM events GROUP BY 1, 2",
)
def stream_first_wins(x: Inputs) -> DataFrame:
    """The first row per key stays, whatever arrives later in a batch.

    The oracle's first row per hour is the earliest; all files come in one
    micro-batch, where the earliest row is the first.
    """
    wh = _warehouse(x, "stream-first")
    hourly = flows.stream_files(x.spark, _event_files(x), x.table("events").schema).select(
        "user_id", F.date_trunc("hour", F.col("ts")).alias("hour"), "ts"
    )
    _finish(flows.append_new_stream(hourly, wh, _EVENT_FIRST, ["ts"], work_path(x.spark, "checkpoint")))
    return wh.read(_EVENT_FIRST)


@query("stream_unique_keys", "SELECT user_id, ts::VARCHAR AS ts FROM events")
def stream_unique_keys(x: Inputs) -> DataFrame:
    """Every event delivered twice, deduplicated within the watermark."""
    path = work_path(x.spark, "twice")
    e = x.table("events").select("user_id", "ts")
    for _ in range(2):
        e.write.mode("append").parquet(path)
    stream = flows.stream_files(x.spark, path, e.schema, files_per_trigger=1)
    unique = flows.first_wins_stream(stream, ["user_id", "ts"], "ts", "60 days")
    out = work_path(x.spark, "unique")
    _finish(
        unique.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", work_path(x.spark, "checkpoint"))
        .trigger(availableNow=True).start()
    )
    return x.spark.read.parquet(out)
