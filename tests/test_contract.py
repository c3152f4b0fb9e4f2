"""The driver contract: every query runs, matches its oracle and plans well."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as contract
import compare
from obs_engine.plans.stand_ins import Inputs

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
TEXT = set(contract.TEXT_QUERIES)
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no benchmark tables")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, duck, name):
    ok, note = compare.compare(spark, duck, SF, name, QUERIES[name], ORACLES.get(name))
    assert ok, note


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_the_plan(spark, name):
    if name in TEXT:
        pytest.skip("text operators may use Arrow; tests/llm looks at those that may not")
    plan = plan_of(QUERIES[name](spark, SF))
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_daily_aggregate_is_one_hash_shuffle(spark):
    x = Inputs(spark, SF)
    for df in (x.arc_daily, x.table("events").groupBy("user_id").count()):
        plan = plan_of(df)
        assert plan.count("Exchange") == 1 and "SortAggregate" not in plan
        assert "partial_count" in plan


def test_status_view_reads_only_what_it_needs(spark):
    from obs_engine.operators import serve

    plan = plan_of(serve.arc_count(Inputs(spark, SF).arc_current))
    assert "ReadSchema" in plan and "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_all_checks_scan_each_table_once(spark):
    """17 tables, one of them a union of two."""
    plan = plan_of(QUERIES["all_checks"](spark, SF))
    assert plan.count("Scan parquet") <= 18 and "Join" not in plan.replace("BroadcastHashJoin", "", 1).replace("SortMergeJoin", "", 1)
