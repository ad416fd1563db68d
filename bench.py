"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder with the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs after one warm-up (default 3; the median counts)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from millpond.operators import forecast, gold, merge
from millpond.plans import all_queries
from millpond.plans.model_jobs import feature_frame
from millpond.session import build_session, materialise
from millpond.sources import retail

HEADLINE = (
    "a8_monthly_sales",
    "a9_monthly_oil",
    "a10_monthly_transactions",
    "a14_city_cluster_month",
    "j1_star_using",
    "w2_detail_with_total",
    "w3_global_max",
    "w4_first_per_date",
    "w5_lags",
    "w7_back_fill",
    "c1_dim_date",
    "f1_diff_train",
    "f4_fact_train",
    "f6_merge_conditional",
    "f10_scd2_stores",
    "f14_refresh_sales",
    "q6_gate_report",
    "m2_model_input",
    "m6_features",
    "m11_model_per_series",
)


# The forms these results are commonly written in, beside ours, on stored input.
def _monthly_window(t):
    """The group total beside every row, then one row per group."""
    rows = t["train"].withColumns({"m": F.month("date"), "y": F.year("date")})
    group = ["store_nbr", "family", "m", "y"]
    total = F.sum("sales").over(Window.partitionBy(*group))
    return rows.select(*group, total.alias("total_sales")).distinct()


def _max_window(t):
    return t["train"].withColumn("max_date", F.max("date").over(Window.orderBy(F.lit(1))))


def _max_scalar(t):
    return t["train"].withColumn("max_date", t["train"].select(F.max("date")).scalar())


def _whole_feed(t):
    """Every group of the fact recomputed, then merged."""
    fresh = _monthly_window(t).withColumnsRenamed({"m": "month_train_date", "y": "year_train_date"})
    keys = ["store_nbr", "family", "month_train_date", "year_train_date"]
    return t["gold"].join(fresh.withColumnRenamed("total_sales", "new_total"), keys, "full_outer")


def _touched_only(t):
    """Changes of one month refresh one month."""
    return gold.refresh(
        t["gold"],
        t["train"],
        t["changes"],
        gold.monthly_sales,
        ("month_train_date", "year_train_date"),
        "2024-02-01",
        by=["store_nbr", "family"],
    )


def _full_outer_merge(t):
    old, new = t["train"].alias("a"), t["batch"].alias("b")
    joined = old.join(new, F.col("a.id") == F.col("b.id"), "full_outer")
    return joined.select([F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in t["train"].columns])


def _merge(t):
    return merge.merge(t["train"], t["batch"], ["id"], [merge.update_all()], [merge.insert_all()])


def _per_series(t):
    return forecast.fit_per_series(t["features"])


# name: (literal form or None, ours)
STORED = {
    "a8_monthly_sales": (_monthly_window, lambda t: gold.monthly_sales(t["train"])),
    "w3_global_max": (_max_window, _max_scalar),
    "f14_refresh_sales": (_whole_feed, _touched_only),
    "f4_merge_one_month": (_full_outer_merge, _merge),
    "m11_per_series": (None, _per_series),
}


def stored_tables(spark, d):
    """The retail tables as a running lakehouse holds them: already in Parquet."""
    train = materialise(retail.train(spark, d), "bench-train")
    last = train.filter("year(date) = 2000 AND month(date) = 6")
    batch = materialise(last.withColumn("sales", F.col("sales") + 1), "bench-batch")
    old = gold.monthly_sales(train).withColumn("proc_dt", F.lit("2024-01-01").cast("date"))
    return {
        "train": train,
        "batch": batch,
        "changes": materialise(batch.withColumn("_change_type", F.lit("update_postimage")), "bench-changes"),
        "gold": materialise(old, "bench-gold"),
        "features": materialise(feature_frame(spark, d), "bench-features"),
    }


def seconds(fn, spark, folder, runs):
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        fn(spark, folder).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", "millpond-bench", spark__sql__shuffle__partitions=cpus)
    queries = all_queries()
    timed = {key: seconds(queries[key], spark, folder, runs) for key in HEADLINE}
    stored = stored_tables(spark, folder)
    compared = {
        name: {
            "literal": seconds(lambda _, t, f=literal: f(t), spark, stored, runs) if literal else None,
            "ours": seconds(lambda _, t, f=ours: f(t), spark, stored, runs),
        }
        for name, (literal, ours) in STORED.items()
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "on_stored_tables": compared,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
