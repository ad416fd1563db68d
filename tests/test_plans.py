"""Plans that have to hold at scale."""

import pytest
from helpers import SMALL
from pyspark.sql import functions as F

from millpond.operators import changes, features, forecast, gold, merge
from millpond.plans import all_queries
from millpond.session import materialise
from millpond.sources import retail


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def train(spark):
    return materialise(retail.train(spark, SMALL), "train")


def test_filter_and_columns_reach_the_scan(spark):
    lines = retail.table(spark, SMALL, "lineitem").filter(F.col("l_suppkey") >= 4).select("l_suppkey")
    plan = plan_of(lines)
    assert "GreaterThanOrEqual(l_suppkey,4)" in plan and "ReadSchema: struct<l_suppkey:bigint>" in plan


def test_monthly_sales_is_one_shuffle_with_partial_sums(train):
    plan = plan_of(gold.monthly_sales(train))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan
    assert "Window" not in plan and "SinglePartition" not in plan


def test_lag_windows_share_one_shuffle(train):
    plan = plan_of(forecast.lag_features(forecast.panel(train)))
    assert plan.count("Exchange hashpartitioning") == 2 and "SinglePartition" not in plan


def test_splits_add_no_shuffle_to_the_lags(train):
    frame = forecast.lag_features(forecast.panel(train))
    assert plan_of(forecast.backtest_splits(frame)).count("Exchange hashpartitioning") == 2


def test_newest_date_is_a_scalar_subquery(train):
    plan = plan_of(forecast.training_window(train))
    assert "Subquery" in plan and "Window" not in plan and "NestedLoop" not in plan


def test_a_small_source_is_broadcast_and_the_target_not_shuffled(spark, train):
    """Target rows of an update meet the source in a broadcast join."""
    source = materialise(train.filter("store_nbr = 1 AND family = 'SMALL'"), "source")
    keys = ["date", "store_nbr", "family"]
    merged = merge.merge(train, source, keys, [merge.update({"sales": "s.sales"})])
    plan = plan_of(merged)
    assert "BroadcastHashJoin" in plan and "FullOuter" not in plan
    assert "Exchange hashpartitioning" not in plan and "SortAggregate" not in plan


def test_an_order_by_inside_a_merge_source_is_dropped(spark, train):
    source = train.orderBy("date")
    merged = merge.merge(train, source, ["id"], [merge.update({"sales": "s.sales"})])
    assert "rangepartitioning" not in plan_of(merged)


def test_or_condition_keeps_the_equal_key(spark):
    plan = plan_of(all_queries()["j13_or_condition"](spark, SMALL))
    assert "NestedLoop" not in plan and "HashJoin" in plan


def test_partition_filter_prunes(spark):
    plan = plan_of(all_queries()["k13_partitioned_table"](spark, SMALL))
    assert "PartitionFilters: [isnotnull(locale" in plan


def test_model_input_shuffles_no_sales_row_for_its_dimensions(spark, train):
    """Reduced dimensions are files by the time the joins are planned, and small ones are broadcast."""
    rest = retail.stores(spark, SMALL), retail.oil(spark, SMALL), retail.holidays(spark, SMALL)
    plan = plan_of(features.model_input(train, *rest))
    assert plan.count("BroadcastHashJoin") == 5 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_a_small_target_meets_its_source_once(spark, train):
    """One full outer join: each side is read and shuffled once, nothing is sorted but for the join."""
    source = materialise(train.filter("store_nbr = 1"), "source")
    plan = plan_of(merge.merge(train, source, ["id"], [merge.update_all()], [merge.insert_all()]))
    assert plan.count("FullOuter") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in plan and "NestedLoop" not in plan


def test_a_diff_sorts_no_row_to_find_repeated_keys(spark, train):
    plan = plan_of(changes.diff(train, train.withColumn("sales", F.col("sales") + 1), ["id"]))
    assert "SortAggregate" not in plan and "Window" not in plan and plan.count("HashAggregate") >= 4
