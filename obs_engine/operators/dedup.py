"""One row per key.

Two plans, both safe for a key holding a third of the table:

* ``latest_per_key``, for few keys with many rows each: the maximum of one
  struct. Each map task sends one row per key; no sort by the order columns.
* ``one_row_per_key``, for keys that are almost unique: ``row_number() = 1``,
  which Spark trims to one row per key *before* the shuffle (window group
  limit), so even a key repeated without end costs its reducer one row per map
  task. Cheaper than the aggregate when nearly every row survives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _others(df: DataFrame, *used: Sequence[str]) -> list[str]:
    taken = {c for group in used for c in group}
    return [c for c in df.columns if c not in taken]


def rank_struct(latest: Sequence[str], rest: Sequence[str]) -> Column:
    """A row as a sortable struct, larger means preferred.

    ``latest`` columns rank like ``ORDER BY c DESC NULLS FIRST``; ``rest`` break
    ties, largest first with NULLs last, so the choice never depends on row
    order. Every column occurs once: the winner is read back from the struct.
    """
    marks = [F.col(c).isNull().alias(f"_null_{c}") for c in latest]
    parts = [p for c, mark in zip(latest, marks) for p in (mark, F.col(c))]
    return F.struct(*parts, *[F.col(c) for c in rest])


def latest_per_key(
    df: DataFrame, key: Sequence[str], latest: Sequence[str], ties: Sequence[str] = ()
) -> DataFrame:
    """The preferred row of each key (W2-W4); further ties fall to the other columns."""
    rest = [*ties, *_others(df, key, latest, ties)]
    best = df.groupBy(*key).agg(F.max(rank_struct(latest, rest)).alias("best"))
    return best.select(*[c if c in key else F.col(f"best.{c}") for c in df.columns])


def one_row_per_key(
    df: DataFrame, key: Sequence[str], latest: Sequence[str], ties: Sequence[str] | None = None
) -> DataFrame:
    """The same choice for nearly unique keys."""
    ties = _others(df, key, latest) if ties is None else ties
    order = [F.desc_nulls_first(c) for c in latest] + [F.desc_nulls_last(c) for c in ties]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedup_last(records: DataFrame, key: Sequence[str], lineage: Sequence[str]) -> DataFrame:
    """The last occurrence of each key in fetch order, which has no ties."""
    return one_row_per_key(records, key, lineage, ties=())


def latest_with_span(
    df: DataFrame,
    key: Sequence[str],
    latest: Sequence[str],
    span: dict[str, tuple[str, str]],
    keep: Sequence[str],
) -> DataFrame:
    """Latest attributes plus first and last value of some columns.

    ``span`` maps a column to the names of its minimum and maximum. Both come
    out of the same aggregation, so the table is shuffled once.
    """
    rest = [c for c in keep if c not in key and c not in latest]
    bounds = [
        agg
        for c, (low, high) in span.items()
        for agg in (F.min(c).alias(low), F.max(c).alias(high))
    ]
    names = [n for pair in span.values() for n in pair]
    best = F.max(rank_struct(latest, rest)).alias("best")
    grouped = df.groupBy(*key).agg(best, *bounds)
    return grouped.select(*[c if c in key else F.col(f"best.{c}") for c in keep], *names)


def first_last_per_key(df: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``first_<c>`` and ``last_<c>`` of each column per key."""
    return df.groupBy(*key).agg(
        *[a for c in cols for a in (F.min(c).alias(f"first_{c}"), F.max(c).alias(f"last_{c}"))]
    )


def clean_raw(raw: DataFrame, key: Sequence[str], load_order: Sequence[str]) -> DataFrame:
    """Repair of a raw table: no NULL keys, the latest stored row per key."""
    return one_row_per_key(raw.dropna(subset=list(key)), key, load_order)
