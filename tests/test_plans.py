"""Physical plans: what is pruned, pushed down, combined early and never done."""

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from conftest import SF_DIR, plan_of
from orderlake.functions.dates import days_between
from orderlake.operators import quality
from orderlake.plans import analytics, star
from orderlake.plans.lake import lake

DAY = entry_point.DAY


@pytest.fixture(scope="module")
def lk(spark):
    return lake(spark, SF_DIR)


def test_partition_equality_prunes_directories(lk):
    plan = plan_of(analytics.pruned_single_day(lk.sales, DAY))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(part in filters for part in ("year", "month", "day"))
    assert "ReadSchema: struct<order_total:decimal(12,2)>" in plan


def test_time_range_with_its_implied_partitions(lk):
    ts = F.col("order_date")
    pruned = lk.sales.where(days_between(ts, "2026-08-01", "2026-08-03"))
    plan = plan_of(pruned)
    assert "PartitionFilters: []" not in plan and "GreaterThanOrEqual(order_date" in plan
    plain = lk.sales.where(F.to_date(ts).between("2026-08-01", "2026-08-03"))
    assert pruned.count() == plain.count() > 0


def test_rules_with_uniqueness_scan_the_table_once(lk):
    frame = lk.spark.read.parquet(lk.published.curated)
    rules = (quality.IsComplete("customer_id"), quality.Uniqueness("order_id"))
    assert plan_of(quality.dq_results({"sales": (frame, rules)})).count("FileScan") == 1


def test_derived_predicate_does_not_prune(lk):
    plan = plan_of(analytics.full_scan_same_answer(lk.sales, DAY))
    assert "PartitionFilters: []" in plan


def test_range_reaches_parquet_statistics(lk):
    plan = plan_of(star.range_predicate_day(lk.star, DAY))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(order_date" in pushed and "LessThan(order_date" in pushed


def test_wrapped_predicate_pushes_no_range(lk):
    plan = plan_of(star.wrapped_predicate_day(lk.star, DAY))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "Than" not in pushed


def test_range_skips_row_groups_the_wrapped_predicate_reads(lk, conf, tmp_path):
    """The fact is sorted by time over its files, so most files cannot hold the day."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    star.write_star(lk.sales, str(tmp_path))
    loaded = star.read_star(lk.spark, str(tmp_path))
    conf(spark__sql__adaptive__enabled="false")

    def rows_scanned(frame):
        plan = frame._jdf.queryExecution().executedPlan()
        plan.executeCollectPublic()
        return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()

    every_row = rows_scanned(star.wrapped_predicate_day(loaded, DAY))
    assert every_row == loaded.fact_orders.count()
    assert 0 < rows_scanned(star.range_predicate_day(loaded, DAY)) < every_row / 2


def test_narrow_and_wide_projection_read_what_they_need(lk):
    narrow = plan_of(analytics.single_column_projection(lk.sales))
    assert "ReadSchema: struct<order_total:decimal(12,2)>" in narrow
    wide = plan_of(analytics.many_column_projection(lk.sales))
    read = wide.split("ReadSchema: ")[1].split(">")[0]
    assert "order_id" in read and "price" not in read and "order_total" not in read


def test_rank_is_limited_below_the_shuffle(lk):
    plan = plan_of(analytics.top_customers_by_country(lk.sales))
    assert "WindowGroupLimit [country" in plan
    assert "Partial" in plan[plan.index("Exchange hashpartitioning(country") :]


def test_top_k_keeps_k_rows_per_task(lk):
    assert "TakeOrderedAndProject(limit=20" in plan_of(star.star_join_all_dimensions(lk.star))


def test_large_dimension_meets_a_fact_already_combined_per_key(lk, conf):
    small = plan_of(star.revenue_by_country(lk.star))
    assert "BroadcastHashJoin" in small and "HashAggregate(keys=[customer_id" in small
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for report in (star.revenue_by_country, star.star_join_all_dimensions):
        plan = plan_of(report(lk.star))
        join = plan.index("SortMergeJoin [customer_id")
        assert "HashAggregate(keys=[customer_id" in plan[join:]


def test_governed_view_reads_granted_columns_only(spark):
    plan = plan_of(entry_point.queries()["governed_view"](spark, SF_DIR))
    assert "c_name" not in plan and "email" not in plan


@pytest.mark.parametrize("name", sorted(entry_point._REGISTRY))
def test_no_cross_join_and_no_python_in_any_plan(spark, name):
    if name in ("incremental_orders", "run_history"):
        pytest.skip("reads back what its runs wrote; they are tested as jobs")
    plan = plan_of(entry_point.queries()[name](spark, SF_DIR))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert forbidden not in plan
