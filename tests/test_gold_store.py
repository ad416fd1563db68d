"""Stored gold summaries: only touched months are read and rewritten."""

import os
import shutil
from datetime import date
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from millpond.operators import changes, gold_store
from millpond.plans import all_queries
from millpond.session import new_folder

TRAIN = "id BIGINT, date DATE, store_nbr INT, family STRING, sales DOUBLE, onpromotion INT"


@pytest.fixture
def tables(spark):
    """Two years of one store's sales, a few rows of another, and their stored summary."""
    data = [(i, date(2016 + i // 12, i % 12 + 1, 5), 1, "A", 10.0 + i, 0) for i in range(24)]
    data += [(100, date(2016, 3, 9), 2, "A", 1.0, 0), (101, date(2016, 3, 9), 2, "B", 2.0, 0), (102, date(2016, 4, 9), 2, None, 3.0, 0)]
    fact, summary = new_folder(spark, "fact"), new_folder(spark, "gold")
    before = spark.createDataFrame(data, TRAIN)
    gold_store.write_months(before, fact)
    gold_store.load(gold_store.SALES, gold_store.read_months(spark, fact), summary, "2024-01-01")
    return before, fact, summary


def files(folder):
    return {os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def refreshed(spark, tables, after):
    before, fact, summary = tables
    log = changes.diff(before, after, ["id"])
    for (month,) in {(r.date.replace(day=1),) for r in before.collect()} - {(r.date.replace(day=1),) for r in after.collect()}:
        shutil.rmtree(f"{fact}/month={month}")
    gold_store.write_months(after, fact)
    months = gold_store.refresh(gold_store.SALES, fact, summary, log, "2024-02-01")
    return months, {tuple(r)[:4]: tuple(r)[4:] for r in gold_store.read_summary(gold_store.SALES, spark, summary).collect()}


def test_only_touched_months_change(spark, tables):
    before, _, summary = tables
    had = files(summary)
    after = before.withColumn("sales", F.when(F.col("id") == 2, 99.0).otherwise(F.col("sales")))
    months, got = refreshed(spark, tables, after)
    assert months == [date(2016, 3, 1)]
    assert got[1, "A", 3, 2016] == (Decimal("99.00"), date(2024, 2, 1))
    assert got[2, "A", 3, 2016] == (Decimal("1.00"), date(2024, 1, 1))  # same month, other group
    assert len(got) == 27
    other = {f for f in had if not f.startswith("year_train_date=2016/month_train_date=3/")}
    assert other <= files(summary)


def test_emptied_groups_and_months_go(spark, tables):
    before, _, summary = tables
    months, got = refreshed(spark, tables, before.filter("id NOT IN (101, 23)"))
    assert months == [date(2016, 3, 1), date(2017, 12, 1)]
    assert (2, "B", 3, 2016) not in got and (1, "A", 12, 2017) not in got and len(got) == 25
    assert not os.path.exists(f"{summary}/year_train_date=2017/month_train_date=12")


def test_new_months_appear_and_a_second_run_changes_nothing(spark, tables):
    before, fact, summary = tables
    after = before.unionByName(spark.createDataFrame([(900, date(2019, 7, 1), 5, "Z", 4.0, 1)], TRAIN))
    log = changes.diff(before, after, ["id"])
    gold_store.write_months(after, fact)
    for _ in range(2):
        gold_store.refresh(gold_store.SALES, fact, summary, log, "2024-02-01")
        found = rows(gold_store.read_summary(gold_store.SALES, spark, summary))
        assert (5, "Z", 7, 2019, Decimal("4.00"), date(2024, 2, 1)) in found and len(found) == 28
    assert gold_store.refresh(gold_store.SALES, fact, summary, log.filter("false"), "2024-03-01") == []


def test_the_fact_is_pruned_to_the_touched_months(spark, tables):
    _, fact, summary = tables
    scan = gold_store.read_months(spark, fact, [date(2016, 3, 1)])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [month" in plan or "PartitionFilters: [cast(month" in plan
    assert scan.count() == 3
    old = gold_store.read_summary(gold_store.SALES, spark, summary).filter(F.make_date("year_train_date", "month_train_date", F.lit(1)).isin([date(2016, 3, 1)]))
    text = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text


def test_a_month_is_written_in_several_files_when_large(spark):
    folder = new_folder(spark, "fact")
    gold_store.write_months(spark.createDataFrame([], TRAIN), folder)
    big = spark.range(20_000).select(F.col("id"), F.lit(date(2016, 1, 1)).alias("date"), F.lit(1).alias("store_nbr"), F.sha2(F.col("id").cast("string"), 256).alias("family"), F.rand(1).alias("sales"), F.lit(0).alias("onpromotion"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        gold_store.write_months(big, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(folder)) > 1 and spark.read.parquet(folder).count() == 20_000


def test_stored_sales_of_stores_whose_numbers_repeat(spark, tmp_path):
    """With store 10,000 the number of a sale equals that of store 0 on the next day."""
    lines = [(1, 10_000, date(1996, 1, 5), 10.0, 0.0), (1, 0, date(1996, 1, 6), 20.0, 0.0), (1, 1, date(1996, 2, 7), 5.0, 0.0)]
    columns = "l_partkey BIGINT, l_suppkey BIGINT, l_shipdate DATE, l_extendedprice DOUBLE, l_discount DOUBLE"
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "SMALL")], "p_partkey BIGINT, p_type STRING").write.parquet(f"{tmp_path}/part.parquet")
    got = all_queries()["f14_stored_sales"](spark, str(tmp_path)).select("store_nbr", "total_sales", F.col("proc_dt").cast("string"))
    assert rows(got) == [(0, 30.0, "2024-02-01"), (1, 5.0, "2024-01-01"), (10_000, 10.0, "2024-01-01")]
