"""Checks compiled to contributions: bits of failing row checks, sides of keys, shared staging."""

from pyspark.sql import functions as F

from obs_engine.operators.check_plan import EQUAL, CheckPlan, KeySide
from obs_engine.operators.quality import TableChecks
from obs_engine.plans import catalogue
from obs_engine.plans.stand_ins import Inputs


def found(plan, tables):
    return {r["check"]: (r["failures"], r["status"]) for r in plan.results(tables).collect()}


def test_row_checks_of_several_blocks_are_told_apart(spark):
    plan = CheckPlan()
    for i in range(130):
        plan.row_check(f"c{i}", "t", (F.col("n") % (i + 2)) == 0, "warn" if i % 2 else "error")
    df = spark.createDataFrame([(n,) for n in (*range(1, 300), None, 6, 6)], "n INT")
    rows = [*range(1, 300), 6, 6]
    expected = {i: sum(n % (i + 2) == 0 for n in rows) for i in range(130)}
    assert found(plan, {"t": df}) == {
        f"c{i}": (n, ("warn" if i % 2 else "fail") if n else "pass") for i, n in expected.items()
    }


def test_rows_without_faults_contribute_nothing_and_no_row_is_expanded_by_a_lambda(spark):
    plan = CheckPlan()
    plan.declare("t", TableChecks(not_null=("a", "b"), unique=("a",), accepted={"b": ("x",)}))
    df = spark.createDataFrame([("1", "x"), ("1", "y"), (None, "x"), ("2", None)], "a STRING, b STRING")
    said = plan.contributions("t", df)
    assert sorted((r["entry"] < 0, r["key"], r["l"], r["r"]) for r in said.collect()) == [
        (False, "1", 1, 0), (False, "1", 1, 0), (False, "2", 1, 0),
        (True, "1", 1, 0), (True, "2", 1, 0), (True, "4", 1, 0),
    ]
    shown = said._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in shown and "Generate" not in shown and "lambda" not in shown
    assert found(plan, {"t": df}) == {
        "not_null_t_a": (1, "fail"), "not_null_t_b": (1, "fail"), "accepted_values_t_b": (1, "fail"), "unique_t_a": (1, "fail"),
    }


def test_sides_that_differ_in_one_measure_or_miss_a_row_fail(spark):
    plan = CheckPlan()
    left = KeySide("same", (F.col("k"), F.col("d")), measures=(F.col("a"), F.col("b")))
    right = KeySide("same", (F.col("k"), F.col("d")), True, (F.col("a"), F.col("b")))
    plan.key_check("same", EQUAL, [("l", left), ("r", right)])
    schema = "k STRING, d INT, a INT, b INT"
    one = [("p", 1, 2, 3), ("p", 2, 2, 3), ("q", 1, None, 3), ("s", 1, 1, 1), (None, 1, 1, 1)]
    two = [("p", 1, 2, 3), ("p", 2, 2, 4), ("q", 1, 0, 3), ("t", 1, 1, 1), ("u", None, 1, 1)]
    tables = {"l": spark.createDataFrame(one, schema), "r": spark.createDataFrame(two, schema)}
    assert found(plan, tables) == {"same": (3, "fail")}
    empty = {n: df.limit(0) for n, df in tables.items()}
    assert found(plan, empty) == {"same": (0, "pass")}


def small_tables(spark, path):
    """Two order lines of one station and half-day, one of another, one with nulls; an event; an order."""
    line = "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_shipdate TIMESTAMP_NTZ, l_returnflag STRING"
    spark.sql(
        "SELECT * FROM VALUES (1L, 1L, 1L, 1, 5D, timestamp_ntz'1995-03-04', 'N'), (2L, 2L, 1L, 3, 7D, timestamp_ntz'1995-03-04', 'R'),"
        " (3L, 3L, 2L, 2, 9D, timestamp_ntz'1995-04-04', 'N'), (4L, 3L, 3L, 2, NULL, NULL, 'N') AS t("
        + ", ".join(c.split()[0] for c in line.split(", ")) + ")"
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.sql(
        "SELECT 1L AS event_id, 7L AS user_id, timestamp_ntz'2024-01-02 03:04:05' AS ts, 'click' AS event_type, 1.5D AS value, '{\"k\": 3}' AS props"
    ).write.parquet(f"{path}/events.parquet")
    spark.sql(
        "SELECT 1L AS o_orderkey, 2L AS o_custkey, 'O' AS o_orderstatus, timestamp_ntz'1995-03-04' AS o_orderdate, '1-URGENT' AS o_orderpriority"
    ).write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_all_checks_stage_the_stations_once(spark, tmp_path):
    results = catalogue.all_checks(Inputs(spark, small_tables(spark, tmp_path)))
    assert "WindowGroupLimit" not in results._jdf.queryExecution().executedPlan().toString()
    failures = {r["check"]: r["failures"] for r in results.collect()}
    assert len(failures) == 194
    # Lines 1 and 2 are one observation; line 4 has neither an instant nor a day.
    assert failures["not_null_fct_station_status_status_updated_at"] == 1
    assert failures["not_null_agg_station_daily_observation_date"] == 1
    assert failures["unique_fct_station_status_observation_id"] == 0
    assert failures["station_daily_matches_fact"] == failures["station_status_row_count"] == 0
