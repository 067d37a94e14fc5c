"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry_points
from quern.plans.catalog import ORACLES, QUERIES
from quern.plans.check import differences, duck


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    df = QUERIES[name](spark, data)
    plan = executed_plan(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) is None
    elif name != "recommend_unrated":  # no item of the smallest tables has enough ratings
        assert len(df.take(1)) == 1


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).columns == ["word", "n"]


def formatted_plan(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filter_and_columns_reach_the_scan(spark, data):
    plan = formatted_plan(spark, QUERIES["filter_rows"](spark, data))
    assert "EqualTo(event_type,error)" in plan and "GreaterThan(value,50.0)" in plan
    plan = formatted_plan(spark, QUERIES["mean_by_key"](spark, data))
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in plan


def test_groups_are_cut_before_the_shuffle(spark, data):
    assert "WindowGroupLimit" in executed_plan(QUERIES["top_k_per_group"](spark, data))


def test_top_k_does_not_sort_everything(spark, data):
    assert "TakeOrderedAndProject" in executed_plan(QUERIES["top_k_by_count"](spark, data))


def test_texts_are_split_once_and_after_the_shuffle(spark, data):
    plan = executed_plan(QUERIES["term_frequency"](spark, data))
    assert plan.count("split(lower(") == 1
    assert plan.count("Exchange hashpartitioning") == 1
