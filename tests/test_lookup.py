"""Reads of few rows from stored tables, and dimensions kept by their increments."""

from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from obs_engine.operators import lookup, merge
from obs_engine.plans import arcs, dimensions, stations
from obs_engine.schemas import ARC_RAW, STATION_RAW

DAY0 = datetime(2024, 3, 1, tzinfo=timezone.utc)
TABLE = merge.TableSpec("readings", ("id",), merge.by_day("ts"), lookup=("who",))


def scans(df):
    """Rows and files read by the scans of an executed query."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif "FileSourceScan" in kind:
            metrics = node.metrics()
            out.append((metrics.apply("numOutputRows").value(), metrics.apply("numFiles").value()))
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return out


@pytest.fixture
def readings(spark, warehouse, monkeypatch):
    monkeypatch.setattr(merge, "ROW_GROUP_ROWS", 1000)
    n = F.col("id")
    rows = spark.range(40_000).select(
        "id", (n % 2000).cast("string").alias("who"), (F.lit(DAY0) + F.make_dt_interval(days=(n % 8).cast("int"), mins=(n % 1440).cast("int"))).alias("ts")
    )
    warehouse.rebuild(TABLE, rows)
    return rows


def newest(rows, n, who=None):
    kept = rows if who is None else rows.filter(F.col("who") == who)
    return [r.id for r in kept.orderBy(F.desc("ts"), F.desc("id")).limit(n).collect()]


def test_the_newest_rows_come_from_the_newest_partition(readings, warehouse):
    found = lookup.newest_rows(warehouse, TABLE, 100, ["id"])
    assert [r.id for r in found.collect()] == newest(readings, 100)
    ((rows, _),) = scans(found)
    assert rows <= 5000, "one of eight days"


@pytest.mark.parametrize(("n", "who"), [(1, "7"), (3, "8"), (20, "1999"), (500, "7"), (5, "nobody")])
def test_history_of_one_entity(readings, warehouse, n, who):
    found = lookup.entity_history(warehouse, TABLE, "who", who, n, ["id"])
    assert [r.id for r in found.collect()] == newest(readings, n, who)
    for rows, _ in scans(found):
        # Only row groups that may hold the entity are opened.
        assert rows <= 8 * 1000


def test_more_rows_than_there_are_and_empty_tables(spark, readings, warehouse):
    assert lookup.newest_rows(warehouse, TABLE, 10**6).count() == 40_000
    warehouse.rebuild(TABLE, readings.limit(0))
    assert lookup.newest_rows(warehouse, TABLE, 5).count() == 0
    with_null = readings.limit(50).unionByName(spark.createDataFrame([(99, "x", None)], "id long, who string, ts timestamp"))
    warehouse.rebuild(TABLE, with_null)
    assert lookup.newest_rows(warehouse, TABLE, 1).first().id == 99, "rows without time come first, as in a full sort"
    with pytest.raises(ValueError):
        lookup.newest_rows(warehouse, merge.TableSpec("b", ("id",), merge.by_bucket("id")), 1)


def arc_rows(spark, rows):
    """``(arc, hour observed, hour loaded, label)`` as raw rows."""
    at = lambda h: DAY0 + timedelta(hours=h)
    values = {f.name: None for f in ARC_RAW.fields}
    out = [tuple({**values, "arc_id": a, "observed_at": at(o), "ingested_at": at(i), "arc_label": n, "source_run_id": "r"}.values()) for a, o, i, n in rows]
    return spark.createDataFrame(out, ARC_RAW)


def same_as_rebuilt(warehouse, d):
    built = d.build(d.stage(warehouse.read(d.raw)))
    stored = warehouse.read(d.spec).select(*built.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, built.collect()))


def test_an_arc_dimension_follows_corrections(spark, warehouse):
    loads = [
        [("a", 0, 1, "a0"), ("a", 5, 6, "a5"), ("b", 3, 6, "b3")],
        [("a", 4, 8, "older, late"), ("c", 7, 8, "c7")],  # an older row and a new arc
        [("a", 5, 9, "a5 corrected")],  # the newest row again
        [("a", 0, 10, "a0 corrected"), ("b", 3, 10, "b3")],  # the first load; nothing changed
        [("b", 3, 11, "b3 corrected")],  # an arc's only row
    ]
    for rows in loads:
        warehouse.upsert(arcs.RAW, arc_rows(spark, rows), arcs.COMPARED)
        dimensions.refresh_dimension(warehouse, dimensions.ARCS)
        same_as_rebuilt(warehouse, dimensions.ARCS)
    first = {r.arc_id: r.first_loaded_at.hour for r in warehouse.read(arcs.DIM).collect()}
    assert first == {"a": 8, "b": 11, "c": 8}
    assert dimensions.refresh_dimension(warehouse, dimensions.ARCS).received == 0


def test_random_loads_leave_the_rebuilt_dimension(spark, warehouse):
    rng = np.random.default_rng(8)
    for load in range(4):
        end = 10 * (load + 1)
        observed = {(f"arc{rng.integers(0, 9)}", int(rng.integers(max(0, end - 14), end))) for _ in range(25)}
        rows = [(a, o, end, f"{a} {rng.integers(0, 3)}") for a, o in sorted(observed)]
        warehouse.upsert(arcs.RAW, arc_rows(spark, rows), arcs.COMPARED)
        dimensions.refresh_dimension(warehouse, dimensions.ARCS)
    same_as_rebuilt(warehouse, dimensions.ARCS)


def test_a_station_dimension_takes_the_last_loaded_row(spark, warehouse):
    values = {f.name: None for f in STATION_RAW.fields}
    naive = DAY0.replace(tzinfo=None)

    def load(hour, rows):
        made = [tuple({**values, "stationcode": s, "name": n, "last_reported": naive + timedelta(hours=o), "ingested_at": naive + timedelta(hours=hour)}.values()) for s, o, n in rows]
        warehouse.insert_ignore(stations.RAW, spark.createDataFrame(made, STATION_RAW))
        dimensions.refresh_dimension(warehouse, dimensions.STATIONS)
        same_as_rebuilt(warehouse, dimensions.STATIONS)

    load(5, [("s", 4, "old"), ("t", 4, "t")])
    load(6, [("s", 2, "loaded later, observed earlier"), ("u", 5, "u")])
    load(7, [("s", 6, "new")])
    assert {r.station_name for r in warehouse.read(stations.DIM).collect()} == {"new", "t", "u"}
