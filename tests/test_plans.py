"""What the executed plans must contain (test_registered checks what none may contain)."""

import __spark_entry__ as entry


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_staging_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(entry.queries()["stg_customers"](spark, sf_dir))
    assert "StringContains(email,@)" in plan and "IsNotNull(state)" in plan
    assert "loyalty_tier" not in plan


def test_partition_filters_prune(spark, lake):
    from scenarios.feed import CUT

    plan = plan_of(lake.raw_orders.filter(f"ingest_date < date'{CUT}'"))
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_latest_state_is_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(entry.queries()["silver_orders"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2


def test_measures_aggregate_before_the_dimension_join(spark, sf_dir):
    frame = entry.queries()["sales_by_state"](spark, sf_dir)
    plan = plan_of(frame)
    join = min(i for i in (plan.find("SortMergeJoin"), plan.find("BroadcastHashJoin"), plan.find("ShuffledHashJoin")) if i >= 0)
    assert "partial_sum" in plan[join:]


def test_history_needs_one_wide_shuffle(spark, sf_dir):
    """With no hot key the executed plan is the ordinary one: one exchange, one sort, one window."""
    frame = entry.queries()["silver_customers"](spark, sf_dir)
    frame._jdf.collectToPython()
    final = plan_of(frame).split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1
    assert final.count("Window [") == 1
    assert "BroadcastExchange" not in final
