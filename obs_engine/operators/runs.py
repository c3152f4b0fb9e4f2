"""Run logs: building, checking, deriving rates, uniting."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone
from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_engine.functions.metrics import pct, per_second
from obs_engine.operators.merge import MergeResult, TableSpec, Warehouse, by_bucket
from obs_engine.schemas import (
    ARC_FEED_LABEL,
    ARC_RUN,
    ARC_RUN_PREFIX,
    RUN_STATUSES,
    STATION_FEED_LABEL,
    STATION_RUN,
    STATION_RUN_PREFIX,
)

MAX_MESSAGE = 4000

STATION_RUNS = TableSpec("ingestion_runs", ("run_id",), by_bucket("run_id"))
ARC_RUNS = TableSpec("traffic_ingestion_runs", ("run_key",), by_bucket("run_key"))

RUN_COLUMNS = (
    "airflow_run_id", "dag_id", "task_id", "started_at", "finished_at", "status",
    "records_received", "records_inserted", "records_updated", "records_unchanged",
    "duration_seconds", "records_per_second", "unchanged_rate_percent", "error_message",
    "is_success",
)


class RunError(ValueError):
    """A run row breaks the rules of the run log."""


def _seconds(started_at: datetime, finished_at: datetime) -> Decimal:
    elapsed = Decimal(str((finished_at - started_at).total_seconds()))
    return elapsed.quantize(Decimal("0.001"), ROUND_HALF_EVEN)


def build_run_row(
    feed: str,
    identity: Mapping[str, object],
    started_at: datetime,
    finished_at: datetime | None,
    counts: Mapping[str, int],
    error: BaseException | str | None = None,
    window: Mapping[str, datetime | None] | None = None,
) -> dict:
    """Finalised metrics of one run as a row of its feed's log.

    ``counts`` holds ``pages_fetched, reported_total, records_received`` and the
    classified counts. A run with an ``error`` is logged as failed.
    """
    if finished_at is None:
        raise RunError("the run is not finished")
    negative = [name for name, n in counts.items() if n < 0]
    if negative:
        raise RunError(f"negative counts: {', '.join(negative)}")
    received = counts.get("records_received", 0)
    classified = sum(
        counts.get(f"records_{kind}", 0) for kind in ("inserted", "updated", "unchanged")
    )
    if classified > received:
        raise RunError("more records classified than received")
    row = {
        **identity,
        "started_at": started_at,
        "finished_at": finished_at,
        "status": RUN_STATUSES[1] if error is not None else RUN_STATUSES[0],
        "duration_seconds": _seconds(started_at, finished_at),
        "error_message": None if error is None else str(error)[:MAX_MESSAGE],
        **{k: counts.get(k, 0) for k in ("pages_fetched", "reported_total", "records_received",
                                         "records_inserted")},
    }
    if feed == "stations":
        duplicates = 0 if error is not None else received - row["records_inserted"]
        row.update(duplicates_ignored=duplicates, created_at=datetime.now(timezone.utc))
    elif feed == "arcs":
        row.update(
            {k: counts.get(k, 0) for k in ("records_updated", "records_unchanged")},
            **(window or {}),
        )
    else:
        raise RunError(f"unknown feed {feed}")
    return row


def run_frame(spark: SparkSession, feed: str, rows: list[dict]) -> DataFrame:
    """Run rows with the explicit schema of their log."""
    schema = STATION_RUN if feed == "stations" else ARC_RUN
    return spark.createDataFrame(
        [tuple(r.get(name) for name in schema.fieldNames()) for r in rows], schema
    )


def run_rules(feed: str) -> dict[str, Column]:
    """What every stored run row must satisfy."""
    counters = ["pages_fetched", "reported_total", "records_received", "records_inserted"]
    counters += ["duplicates_ignored"] if feed == "stations" else [
        "records_updated", "records_unchanged"
    ]
    non_negative = F.col("duration_seconds") >= 0 if feed == "stations" else F.lit(True)
    for c in counters:
        non_negative = non_negative & (F.col(c) >= 0)
    rules = {
        "status is final": F.col("status").isin(*RUN_STATUSES),
        "counters are not negative": non_negative,
    }
    if feed == "arcs":
        rules["classified within received"] = (
            F.col("records_inserted") + F.col("records_updated") + F.col("records_unchanged")
            <= F.col("records_received")
        )
    return rules


def constraint_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations per rule in one pass; like a CHECK, a NULL outcome passes."""
    names = list(rules)
    row = df.agg(*[F.count_if(~rules[n]).alias(f"r{i}") for i, n in enumerate(names)])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations"))
          for i, n in enumerate(names)]
    )
    return row.select(F.explode(pairs).alias("x")).select("x.*")


def check_constraints(df: DataFrame, rules: Mapping[str, Column], what: str) -> None:
    broken = constraint_report(df, rules).filter(F.col("violations") > 0).collect()
    if broken:
        raise RunError(
            f"{what}: " + "; ".join(f"{r['rule']} ({r['violations']})" for r in broken)
        )


def upsert_run(warehouse: Warehouse, feed: str, row: dict) -> MergeResult:
    """Write a run row; a re-run of the same id replaces the whole row."""
    frame = run_frame(warehouse.spark, feed, [row])
    check_constraints(frame, run_rules(feed), "run log")
    return warehouse.delete_insert(STATION_RUNS if feed == "stations" else ARC_RUNS, frame)


def station_runs(log: DataFrame) -> DataFrame:
    """Station run log with rates."""
    return log.drop("created_at").withColumns(
        {
            "records_per_second": per_second("records_received", "duration_seconds"),
            "duplicate_rate_percent": pct("duplicates_ignored", "records_received"),
            "is_success": F.col("status") == RUN_STATUSES[0],
        }
    )


def arc_runs(log: DataFrame) -> DataFrame:
    """Arc run log with rates and the classification check."""
    kinds = {"insertion": "inserted", "update": "updated", "unchanged": "unchanged"}
    classified = (
        F.col("records_inserted") + F.col("records_updated") + F.col("records_unchanged")
    )
    return log.withColumns(
        {
            "records_per_second": per_second("records_received", "duration_seconds"),
            **{
                f"{name}_rate_percent": pct(f"records_{kind}", "records_received")
                for name, kind in kinds.items()
            },
            "classified_record_count": classified,
            "counts_are_consistent": classified == F.col("records_received"),
            "is_success": F.col("status") == RUN_STATUSES[0],
        }
    )


def _harmonised(runs: DataFrame, prefix: str, run_id: str, label: str) -> DataFrame:
    return runs.select(
        F.concat(F.lit(prefix), F.col(run_id)).alias("pipeline_run_id"),
        F.lit(label).alias("pipeline_name"),
        *RUN_COLUMNS,
    )


def all_runs(stations: DataFrame, arcs: DataFrame) -> DataFrame:
    """Both run views under one set of columns."""
    station_side = stations.withColumns(
        {
            "airflow_run_id": F.col("run_id"),
            "records_updated": F.lit(0),
            "records_unchanged": F.col("duplicates_ignored"),
            "unchanged_rate_percent": F.col("duplicate_rate_percent"),
        }
    )
    united = _harmonised(
        station_side, STATION_RUN_PREFIX, "run_id", STATION_FEED_LABEL
    ).unionByName(_harmonised(arcs, ARC_RUN_PREFIX, "run_key", ARC_FEED_LABEL))
    changed = F.col("records_inserted") + F.col("records_updated")
    lead = ["pipeline_run_id", "pipeline_name", *RUN_COLUMNS[:10]]
    return united.select(*lead, changed.alias("changed_record_count"), *RUN_COLUMNS[10:])
