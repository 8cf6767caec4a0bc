"""Plan guards: data-path queries stay JVM-side (no row-at-a-time Python UDF in the physical plan)."""

import pytest

import __spark_entry__ as E

from small_tables import SF_SMALL


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_no_row_python_udf(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan


def test_projection_prunes_the_view_scan(spark):
    df = E.queries()["select_position"](spark, SF_SMALL)        # id, target_b, target_s
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert schema.startswith("struct<") and set(c.split(":")[0] for c in schema[7:-1].split(",")) == {
        "id", "target_b", "target_s"}


def test_filter_reaches_the_scan(spark):
    df = E.queries()["complete_cases"](spark, SF_SMALL)        # target_d IS NOT NULL
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(target_d)]" in plan
