"""Aggregations over observation tables.

The daily aggregates use only counters, decimals and timestamps, so Spark plans
them as hash aggregates with a map-side partial step; nothing in a group is
ever collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.functions.keys import day_of


def with_day(fact: DataFrame, ts: str, day: str = "observation_date") -> DataFrame:
    """Adds the day column unless the table is already partitioned by it."""
    return fact if day in fact.columns else fact.withColumn(day, day_of(ts))


def daily_aggregate(
    fact: DataFrame,
    entity: str,
    ts: str,
    measures: Mapping[str, Column],
    buckets: Mapping[str, Column] | None = None,
    day: str = "observation_date",
) -> DataFrame:
    """One row per ``(entity, day)``: row count, measures, bucket counters."""
    counters = [
        F.count_if(condition).alias(name) for name, condition in (buckets or {}).items()
    ]
    values = [measure.alias(name) for name, measure in measures.items()]
    return (
        with_day(fact, ts, day)
        .groupBy(entity, day)
        .agg(F.count(F.lit(1)).alias("observation_count"), *values, *counters)
    )


def status_buckets(status: str, names: Mapping[str, str], unknown: str | None = None) -> dict:
    """Counters per label; the ``unknown`` counter also takes NULL (A5)."""
    buckets = {}
    for label, name in names.items():
        hit = F.col(status) == label
        buckets[name] = (hit | F.col(status).isNull()) if name == unknown else hit
    return buckets


def case_sum(condition: Column) -> Column:
    """``sum(case when .. then 1 else 0)``: NULL on empty input."""
    return F.sum(F.when(condition, 1).otherwise(0))


def distinct_tuples(df: DataFrame, cols: Sequence[str], name: str = "distinct_rows") -> DataFrame:
    """Distinct tuples, counting those that contain NULL."""
    return df.agg(F.count_distinct(F.struct(*cols)).alias(name))


def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, NULLs ignored."""
    return (
        df.dropna(subset=list(cols))
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def share_of_total(
    df: DataFrame, by: str, metric: Column, name: str, limit: int | None = None
) -> DataFrame:
    """Metric per category with its share of the total, largest first.

    The total is a window over the aggregated result, so ``by`` must be a column of
    few values, such as a status. Shares are of the whole total, with or without ``limit``.
    """
    grouped = df.groupBy(by).agg(metric.alias(name))
    share = F.col(name) / F.sum(name).over(Window.partitionBy())
    out = grouped.select(by, name, share.alias("share")).orderBy(F.desc(name), F.asc_nulls_last(by))
    return out if limit is None else out.limit(limit)


def series(
    df: DataFrame,
    ts: str,
    grain: str,
    metric: Column,
    name: str,
    by: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Metric per time grain and optional category, in time order."""
    bucket = F.date_trunc(grain, F.col(ts)).alias(ts)
    keys = [bucket] if by is None else [bucket, F.col(by)]
    out = df.groupBy(*keys).agg(metric.alias(name))
    out = out.orderBy(ts, *([by] if by else []))
    return out if limit is None else out.limit(limit)


def pivot_series(
    df: DataFrame,
    ts: str,
    grain: str,
    by: str,
    values: Sequence[str],
    metric: Column,
    limit: int | None = None,
) -> DataFrame:
    """Series with one column per category (A21). ``values`` are given, so no extra job runs."""
    out = (
        df.groupBy(F.date_trunc(grain, F.col(ts)).alias(ts))
        .pivot(by, list(values))
        .agg(metric)
        .orderBy(ts)
    )
    return out if limit is None else out.limit(limit)


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row results with different columns as one row: a union, then one maximum each."""
    united = rows[0]
    for row in rows[1:]:
        united = united.unionByName(row, allowMissingColumns=True)
    return united.agg(*[F.max(c).alias(c) for c in united.columns])


def count_preview(counts: Mapping[str, tuple[DataFrame, Column | None]]) -> DataFrame:
    """Several table counts in one row (A17): each table is counted once."""
    rows = []
    for name, (df, condition) in counts.items():
        hits = F.count(F.lit(1)) if condition is None else F.count_if(condition)
        rows.append(df.agg(hits.alias(name)))
    return side_by_side(*rows)


def top_k(df: DataFrame, newest: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` rows, ties broken by further columns (L1-L3)."""
    return df.orderBy(F.desc_nulls_first(newest), *[F.desc(c) for c in ties]).limit(n)
