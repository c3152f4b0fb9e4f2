"""Distinct entities of any span of days, from one stored sketch a day.

A day's entities are kept as a theta sketch of bounded size (8 * 2^lg_k bytes at most), so
the distinct entities of any span are a union of its days' sketches: no fact is read. A union
takes an entity once however often it is given, so a replayed or corrected load changes
nothing. Sketches also subtract: who was seen in one span and not in another.

Up to 2^lg_k entities in a span a count is exact; above, its relative standard error is
1 / sqrt(2^lg_k), 1.6 % at the default. A difference has that error relative to its union.
Entities of deleted rows stay counted: the sketch tells who was *seen*. NULL entities and
rows without a day are not counted.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.functions.keys import day_of
from obs_engine.operators.merge import TableSpec, Warehouse, by_month

LG_K = 12

#: One row a day; a month of them is one partition.
SEEN = TableSpec("seen_daily", ("observation_date",), by_month("observation_date"))


def daily_sketches(df: DataFrame, entity: str, ts: str, lg_k: int = LG_K) -> DataFrame:
    """``observation_date, entities``; the partial sketch of a map task is all that is shuffled."""
    day = day_of(ts).alias("observation_date")
    return (
        df.filter(F.col(entity).isNotNull() & F.col(ts).isNotNull())
        .groupBy(day)
        .agg(F.theta_sketch_agg(entity, lg_k).alias("entities"))
    )


def add_rows(warehouse: Warehouse, spec: TableSpec, rows: DataFrame, entity: str, ts: str, lg_k: int = LG_K) -> None:
    """Unite the sketches of ``rows`` with the stored ones of their days; other days are not read."""
    fresh = daily_sketches(rows, entity, ts, lg_k)
    if not warehouse.exists(spec):
        warehouse.delete_insert(spec, fresh)
        return
    staged = warehouse.stage(fresh.withColumn(spec.partition, spec.layout.value()), f"{spec.name}-fresh")
    stored = warehouse.near(spec, staged).select("observation_date", F.col("entities").alias("_stored"))
    united = F.when(F.col("_stored").isNull(), F.col("entities")).otherwise(
        F.theta_union("entities", "_stored", lg_k)
    )
    warehouse.delete_insert(
        spec, staged.join(stored, "observation_date", "left").select("observation_date", united.alias("entities"))
    )
    warehouse.release(staged)


def distinct_between(sketches: DataFrame, low: date, high: date, lg_k: int = LG_K) -> DataFrame:
    """One row ``entities``: distinct entities of the days ``low`` to ``high``, both included."""
    span = sketches.filter(F.col("observation_date").between(F.lit(low), F.lit(high)))
    return span.agg(_estimate(F.theta_union_agg("entities", lg_k)).alias("entities"))


def trailing(sketches: DataFrame, days: int, lg_k: int = LG_K) -> DataFrame:
    """Per day with a sketch: its entities, those of the ``days`` days up to it, and those of
    the days before it in that span that the day itself lacks (``lost``).

    Each sketch goes to the spans it belongs to, ``days`` small rows a day, and unites there.
    """
    span = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("back")
    dealt = sketches.select("*", span).select(
        F.date_add("observation_date", F.col("back")).alias("observation_date"), "back", "entities"
    )
    today, before = F.col("back") == 0, F.col("back") > 0
    united = dealt.groupBy("observation_date").agg(
        F.theta_union_agg("entities", lg_k).alias("span"),
        F.theta_union_agg(F.when(today, F.col("entities")), lg_k).alias("own"),
        F.theta_union_agg(F.when(before, F.col("entities")), lg_k).alias("earlier"),
        F.max(today).alias("present"),
    )
    return united.filter("present").select(
        "observation_date",
        _estimate(F.col("own")).alias("entities"),
        _estimate(F.col("span")).alias("entities_in_span"),
        _estimate(F.theta_difference("earlier", "own")).alias("lost"),
    )


def _estimate(sketch):
    return F.coalesce(F.theta_sketch_estimate(sketch).cast("long"), F.lit(0).cast("long"))
