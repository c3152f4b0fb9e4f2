"""Distinct entities from stored sketches."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from obs_engine.operators import sketches

ROWS = "entity string, ts timestamp"


def at(day, hour=0):
    return datetime(2026, 3, 1, hour) + timedelta(days=day)


def loaded(spark, warehouse, *batches):
    for rows in batches:
        sketches.add_rows(warehouse, sketches.SEEN, spark.createDataFrame(rows, ROWS), "entity", "ts")
    return warehouse.read(sketches.SEEN)


def test_increments_and_replays_equal_one_load(spark, warehouse):
    first = [("a", at(0)), ("b", at(0)), (None, at(0)), ("c", None), ("a", at(40))]
    late = [("c", at(0, 5)), ("a", at(1)), ("d", at(40))]
    seen = loaded(spark, warehouse, first, late, late)
    got = {r[0]: r[1] for r in seen.select("observation_date", F.theta_sketch_estimate("entities")).collect()}
    assert got == {date(2026, 3, 1): 3, date(2026, 3, 2): 1, date(2026, 4, 10): 2}
    assert sketches.distinct_between(seen, date(2026, 3, 1), date(2026, 3, 2)).first()[0] == 3
    assert sketches.distinct_between(seen, date(2026, 3, 1), date(2026, 4, 10)).first()[0] == 4
    assert sketches.distinct_between(seen, date(2025, 1, 1), date(2025, 1, 2)).first()[0] == 0


def test_trailing_spans_and_losses(spark):
    rows = [("a", at(0)), ("b", at(0)), ("b", at(1)), ("c", at(3)), ("b", at(9))]
    daily = sketches.daily_sketches(spark.createDataFrame(rows, ROWS), "entity", "ts")
    got = {r[0].day: tuple(r[1:]) for r in sketches.trailing(daily, 3).collect()}
    assert got == {1: (2, 2, 0), 2: (1, 2, 1), 4: (1, 2, 1), 10: (1, 1, 0)}


def test_error_above_the_sketch_size(spark):
    """100,000 entities in ten overlapping days: every span within five standard errors."""
    days = spark.range(100_000).select(
        F.concat(F.lit("e"), "id").alias("entity"),
        F.explode(F.array(*[
            F.timestamp_add("DAY", F.pmod(F.col("id") + i, F.lit(10)).cast("int"), F.lit(at(0))) for i in (0, 1)
        ])).alias("ts"),
    )
    daily = sketches.daily_sketches(days, "entity", "ts")
    for n in (1, 3, 9):
        low, high = date(2026, 3, 1), date(2026, 3, 1) + timedelta(days=n - 1)
        exact = days.filter(F.to_date("ts").between(F.lit(low), F.lit(high))).select("entity").distinct().count()
        assert abs(sketches.distinct_between(daily, low, high).first()[0] / exact - 1) < 5 / 64


def test_an_empty_table(spark):
    daily = sketches.daily_sketches(spark.createDataFrame([], ROWS), "entity", "ts")
    assert sketches.trailing(daily, 3).collect() == []
    assert sketches.distinct_between(daily, date(2026, 1, 1), date(2026, 1, 2)).first()[0] == 0
