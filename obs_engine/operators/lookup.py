"""Reads of few rows from stored tables: one entity's history, the newest rows (L2, L3).

Spark keeps no indexes; what takes their place lies in the files. A table with ``lookup``
columns is written in narrow row groups, sorted by them within each partition, with a
Bloom filter per row group, so that a filter on one value opens the row groups that hold
it. Partitions are days or months of the observation time, so all rows of a later one are
newer: a search goes back from the newest partition, in steps that double, and stops when
it has enough rows. Counts come from the same filtered scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.operators.aggregates import top_k
from obs_engine.operators.merge import NULL_PARTITION, TableSpec, Warehouse


def partitions_of(table: DataFrame, column: str) -> list[str | None]:
    """Partition values, newest first, from the file listing that the plan holds anyway; NULL is first."""
    found = {unquote(m[1]) for f in table.inputFiles() if (m := re.search(rf"/{column}=([^/]+)/", f))}
    dated = sorted(found - {NULL_PARTITION}, reverse=True)
    return ([None] if NULL_PARTITION in found else []) + dated


def newest_rows(
    warehouse: Warehouse, spec: TableSpec, n: int, ties: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """The newest ``n`` rows by the partitioned time, of those where ``where`` holds.

    Reads as many of the newest partitions as hold ``n`` such rows.
    """
    if spec.layout.grain == "bucket":
        raise ValueError(f"{spec.name} is not partitioned by time")
    table = warehouse.read(spec, with_partition=True)
    values = partitions_of(table, spec.partition)
    rows = table if where is None else table.filter(where)
    part, at, step, found = F.col(spec.partition), 0, 1, 0
    while at < len(values) and found < n:
        new = values[at : at + step]
        found += rows.filter(_among(part, new)).count()
        at, step = at + step, step * 2
    kept = rows.filter(_among(part, values[:at])) if values else rows
    out = kept.drop(spec.partition) if spec.partition not in warehouse.read(spec).columns else kept
    return top_k(out, spec.layout.source, n, ties)


def _among(part: Column, values: Sequence[str | None]) -> Column:
    """A range of neighbouring partitions, with the NULL one if it is among them."""
    dated = [v for v in values if v is not None]
    within = part.between(dated[-1], dated[0]) if dated else F.lit(False)
    return within | part.isNull() if len(dated) < len(values) else within


def entity_history(
    warehouse: Warehouse, spec: TableSpec, entity: str, value: str, n: int = 100, ties: Sequence[str] = ()
) -> DataFrame:
    """The newest ``n`` rows of one entity."""
    return newest_rows(warehouse, spec, n, ties, F.col(entity) == value)
