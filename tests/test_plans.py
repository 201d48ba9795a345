"""Physical-plan guards for every registered query (sf0.001 tables)."""
import pytest

import __spark_entry__ as entry
from sample_tables import SF0001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted({**entry.QUERIES, **entry.PROFILE_QUERIES}))
def test_no_pairwise_joins(spark, name):
    plan = physical(entry.queries()[name](spark, SF0001))
    assert not [op for op in FORBIDDEN if op in plan], plan


def test_bottom_three_limits_before_the_shuffle(spark):
    plan = physical(entry.queries()["worst_suppliers"](spark, SF0001))
    assert plan.count("WindowGroupLimit") >= 2, plan  # partial (map side) and final


def test_monthly_kpis_use_one_expand(spark):
    plan = physical(entry.queries()["supplier_monthly"](spark, SF0001))
    assert "Expand" in plan and "Union" not in plan, plan


def test_staged_reads_push_filters(spark):
    ctx = __import__("otif.plans.registry", fromlist=["context"]).context(spark, SF0001)
    df = ctx.gold.schedule_performance.filter("report_month = DATE'2000-06-01'").select("EBELN", "on_time")
    plan = physical(df)
    assert "PushedFilters: [IsNotNull(report_month), EqualTo(report_month" in plan, plan
    assert "ReadSchema: struct<EBELN:string,report_month:date,on_time:boolean>" in plan, plan
