"""Joins between detail and aggregate tables.

Every detail side is reduced to one row per key before it is shuffled, so a hot
entity costs one row per map task. Broadcasts are left to the planner and AQE,
which check sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.functions.keys import day_of
from obs_engine.operators.aggregates import side_by_side


def affected_days(fact: DataFrame, entity: str, ts: str, day: str = "observation_date") -> DataFrame:
    """Distinct ``(entity, day)`` pairs of some fact rows."""
    day_col = F.col(day) if day in fact.columns else day_of(ts)
    return fact.select(entity, day_col.alias(day)).distinct()


def restrict_to(fact: DataFrame, pairs: DataFrame, on: Sequence[str]) -> DataFrame:
    """Fact rows whose key is in ``pairs`` (J1); ``pairs`` must be distinct."""
    return fact.join(pairs.select(*on), list(on), "left_semi")


def keys_without_parent(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child keys absent from the parent, with their row count in ``n_rows``."""
    counted = child.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(parent.select(*on), list(on), "left_anti")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys that no parent row has, with ``n_rows``."""
    keys = child.filter(F.col(child_key).isNotNull())
    parents = parent.select(F.col(parent_key).alias(child_key))
    return keys_without_parent(keys, parents, [child_key])


def differs(a: Column | str, b: Column | str) -> Column:
    """``IS DISTINCT FROM``."""
    left = F.col(a) if isinstance(a, str) else a
    return ~left.eqNullSafe(F.col(b) if isinstance(b, str) else b)


def reconcile(
    detail: DataFrame, agg: DataFrame, on: Sequence[str], pairs: Sequence[tuple[str, str]]
) -> DataFrame:
    """Full outer comparison of two tables unique on ``on``.

    ``pairs`` lists ``(expected, stored)`` columns; rows where any pair differs
    are returned.
    """
    left = detail.select(*on, *[e for e, _ in pairs])
    right = agg.select(*on, *[s for _, s in pairs])
    both = left.join(right, list(on), "full_outer")
    wrong = F.lit(False)
    for expected, stored in pairs:
        wrong = wrong | differs(expected, stored)
    return both.filter(wrong).select(*on, *[c for pair in pairs for c in pair])


def counts_differ(
    expected: DataFrame, current: DataFrame, names: tuple[str, str]
) -> DataFrame:
    """Compare two one-row, one-column counts; the row is returned when they differ."""
    both = side_by_side(expected.toDF(names[0]), current.toDF(names[1]))
    return both.filter(F.col(names[0]) != F.col(names[1]))
