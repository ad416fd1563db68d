"""Aggregation, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millpond.functions.dates import year_month
from millpond.functions.series import back_fill, lags, rolling, with_group_total
from millpond.operators import forecast, gold
from millpond.operators.silver import one_per_key
from millpond.plans.registry import query, sql
from millpond.sources import retail

MONTHLY_SALES = """SELECT store_nbr, family, CAST(MONTH(date) AS INT) AS month_train_date,
CAST(YEAR(date) AS INT) AS year_train_date, CAST(SUM(CAST(sales AS DECIMAL(14,2))) AS DOUBLE) AS total_sales
FROM {t} GROUP BY 1, 2, 3, 4"""
MONTHLY_OIL = """SELECT CAST(MONTH(date) AS INT) AS month_oil_price, CAST(YEAR(date) AS INT) AS year_oil_price,
CAST(CAST(SUM(CAST(dcoilwtico AS DECIMAL(14,2))) / COUNT(dcoilwtico) AS DECIMAL(14,2)) AS DOUBLE) AS oil_price
FROM {t} GROUP BY 1, 2"""
MONTHLY_TRANSACTIONS = """SELECT store_nbr, CAST(MONTH(date) AS INT) AS month_transactions_date,
CAST(YEAR(date) AS INT) AS year_transactions_date, CAST(SUM(transactions) AS BIGINT) AS total_transactions
FROM {t} GROUP BY 1, 2, 3"""


def as_double(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def silver_oil(spark, d):
    return retail.oil(spark, d).withColumnRenamed("dcoilwtico", "oil_price")


@query(
    "a1_count_min",
    sql("SELECT COUNT(*) AS n, MIN(date) AS first_date FROM fx_holidays_events", "holidays_events"),
)
def a1(spark, d):
    return retail.holidays(spark, d).agg(F.count("*").alias("n"), F.min("date").alias("first_date"))


@query(
    "a2_count_by_year_locale",
    sql(
        "SELECT CAST(EXTRACT(YEAR FROM date) AS INT) AS yr, locale, COUNT(*) AS n FROM fx_holidays_events GROUP BY 1, 2",
        "holidays_events",
    ),
)
def a2(spark, d):
    return retail.holidays(spark, d).groupBy(F.year("date").alias("yr"), "locale").agg(F.count("*").alias("n"))


@query(
    "a2_count_by_store",
    sql("SELECT store_nbr, COUNT(*) AS n FROM fx_transactions GROUP BY store_nbr", "transactions"),
)
def a2_store(spark, d):
    return retail.transactions(spark, d).groupBy("store_nbr").agg(F.count("*").alias("n"))


@query(
    "a3_sum_by_year_month",
    sql(
        """SELECT CONCAT(CAST(YEAR(date) AS VARCHAR), '-', LPAD(CAST(MONTH(date) AS VARCHAR), 2, '0')) AS yr_mnt,
        CAST(SUM(transactions) AS BIGINT) AS transactions FROM fx_transactions GROUP BY 1""",
        "transactions",
    ),
)
def a3(spark, d):
    rows = retail.transactions(spark, d)
    return rows.groupBy(year_month("date").alias("yr_mnt")).agg(F.sum("transactions").alias("transactions"))


@query("a4_distinct_years", sql("SELECT CAST(YEAR(date) AS INT) AS yr FROM fx_oil GROUP BY 1", "oil"))
def a4(spark, d):
    return retail.oil(spark, d).select(F.year("date").alias("yr")).distinct()


@query("a5_select_distinct", sql("SELECT DISTINCT store_nbr, family FROM fx_train", "train"))
def a5(spark, d):
    return retail.train(spark, d).select("store_nbr", "family").distinct()


@query(
    "a6_drop_duplicates",
    sql(
        "SELECT DISTINCT date, type, locale, locale_name FROM fx_holidays_events",
        "holidays_events",
    ),
)
def a6(spark, d):
    return retail.holidays(spark, d).select("date", "type", "locale", "locale_name").dropDuplicates()


@query("a7_distinct_values", sql("SELECT DISTINCT type FROM fx_holidays_events", "holidays_events"))
def a7(spark, d):
    return retail.holidays(spark, d).select("type").distinct().orderBy("type")


@query("a8_monthly_sales", sql(MONTHLY_SALES.format(t="fx_train"), "train"))
def a8(spark, d):
    return as_double(gold.monthly_sales(retail.train(spark, d)), "total_sales")


@query("a9_monthly_oil", sql(MONTHLY_OIL.format(t="fx_oil"), "oil"))
def a9(spark, d):
    return as_double(gold.monthly_oil(silver_oil(spark, d)), "oil_price")


@query("a10_monthly_transactions", sql(MONTHLY_TRANSACTIONS.format(t="fx_transactions"), "transactions"))
def a10(spark, d):
    return gold.monthly_transactions(retail.transactions(spark, d))


def _twice(df):
    """The frame with every row loaded a second time, as after a replayed load."""
    return df.unionByName(df)


@query("a11_sales_deduplicated", sql(MONTHLY_SALES.format(t="fx_train"), "train"))
def a11(spark, d):
    rows = _twice(retail.train(spark, d)).select("store_nbr", "family", "date", "sales").distinct()
    return as_double(gold.monthly_sales(rows), "total_sales")


@query("a11_oil_deduplicated", sql(MONTHLY_OIL.format(t="fx_oil"), "oil"))
def a11_oil(spark, d):
    return as_double(gold.monthly_oil(_twice(silver_oil(spark, d)).distinct()), "oil_price")


@query("a11_transactions_deduplicated", sql(MONTHLY_TRANSACTIONS.format(t="fx_transactions"), "transactions"))
def a11_transactions(spark, d):
    return gold.monthly_transactions(_twice(retail.transactions(spark, d)).distinct())


@query(
    "a12_stores_per_city_cluster",
    sql("SELECT city, cluster, COUNT(DISTINCT store_nbr) AS stores FROM fx_stores GROUP BY 1, 2", "stores"),
)
def a12(spark, d):
    return gold.stores_per_city_cluster(retail.stores(spark, d))


@query(
    "a13_products_per_store",
    sql("SELECT store_nbr, COUNT(DISTINCT family) AS products FROM fx_train GROUP BY 1", "train"),
)
def a13(spark, d):
    return gold.products_per_store(retail.train(spark, d))


@query(
    "a14_city_cluster_month",
    sql(
        """SELECT s.city, s.cluster, CAST(x.month AS INT) AS month, CAST(x.year AS INT) AS year,
        CAST(SUM(x.sales) AS DOUBLE) AS total_sales, CAST(SUM(x.transactions) AS BIGINT) AS total_transactions
        FROM x JOIN fx_stores s ON x.store_nbr = s.store_nbr GROUP BY 1, 2, 3, 4""",
        "train",
        "transactions",
        "stores",
        x="""SELECT store_nbr, MONTH(date) AS month, YEAR(date) AS year, CAST(sales AS DECIMAL(14,2)) AS sales,
        NULL AS transactions FROM fx_train UNION ALL
        SELECT store_nbr, MONTH(date), YEAR(date), NULL, transactions FROM fx_transactions""",
    ),
)
def a14(spark, d):
    totals = gold.city_cluster_month(
        retail.train(spark, d), retail.transactions(spark, d), retail.stores(spark, d)
    )
    return as_double(totals, "total_sales")


SCORED = """SELECT * FROM (SELECT store_nbr, family, date AS ds, sales AS y, LAG(sales, 7) OVER (PARTITION BY store_nbr, family
ORDER BY date) AS prediction, MAX(date) OVER (PARTITION BY store_nbr, family) AS last_ds FROM fx_train) q
WHERE DATEDIFF('day', ds, last_ds) < 28"""


def scored(spark, d, windows=4):
    """Held-out rows with the value seven rows earlier as the prediction."""
    frame = forecast.panel(retail.train(spark, d))
    frame = frame.select("*", lags("y", [7], forecast.SERIES, "ds")[0].alias("prediction"))
    return forecast.backtest_splits(frame, 7, windows)


@query(
    "a15_metrics",
    sql(
        """SELECT store_nbr, family, cutoff, ROUND(SQRT(AVG((y - prediction) * (y - prediction))), 5) AS rmse,
        ROUND(AVG(CASE WHEN y <> 0 THEN ABS((y - prediction) / y) END), 5) AS mape FROM (SELECT *,
        last_ds - CAST(7 * (DATEDIFF('day', ds, last_ds) // 7 + 1) AS INT) AS cutoff FROM scored) z GROUP BY 1, 2, 3""",
        "train",
        scored=SCORED,
    ),
)
def a15(spark, d):
    result = forecast.metrics(scored(spark, d))
    return result.withColumns({"rmse": F.round("rmse", 5), "mape": F.round("mape", 5)})


@query(
    "a15_mean_metrics",
    sql(
        """SELECT 'rmse' AS metric, ROUND(AVG(rmse), 4) AS value FROM m UNION ALL
        SELECT 'mape', ROUND(AVG(mape), 4) FROM m""",
        "train",
        scored=SCORED,
        m="""SELECT SQRT(AVG((y - prediction) * (y - prediction))) AS rmse,
        AVG(CASE WHEN y <> 0 THEN ABS((y - prediction) / y) END) AS mape FROM scored
        GROUP BY store_nbr, family, DATEDIFF('day', ds, last_ds) // 7""",
    ),
)
def a15_mean(spark, d):
    result = forecast.mean_metrics(forecast.metrics(scored(spark, d)))
    return result.withColumn("value", F.round("value", 4))


@query(
    "w1_full_partition_total",
    sql(
        """SELECT DISTINCT store_nbr, CAST(EXTRACT(MONTH FROM date) AS INT) AS month_transactions_date,
        CAST(EXTRACT(YEAR FROM date) AS INT) AS year_transactions_date,
        CAST(SUM(transactions) OVER (PARTITION BY store_nbr, date_trunc('month', date)) AS BIGINT) AS total_transactions
        FROM fx_transactions""",
        "transactions",
    ),
)
def w1(spark, d):
    """A full-partition window followed by DISTINCT is a plain aggregate."""
    return gold.monthly_transactions(retail.transactions(spark, d))


@query(
    "w2_detail_with_total",
    sql(
        """SELECT store_nbr, family, date, id, sales, CAST(SUM(CAST(sales AS DECIMAL(14,2))) OVER (PARTITION BY store_nbr,
        family, MONTH(date), YEAR(date)) AS DOUBLE) AS total_sales FROM fx_train""",
        "train",
    ),
)
def w2(spark, d):
    rows = retail.train(spark, d).withColumns(
        {"mon": F.month("date"), "yr": F.year("date"), "amount": F.col("sales").cast("decimal(14,2)")}
    )
    totals = with_group_total(rows, ["store_nbr", "family", "mon", "yr"], "amount", "total_sales")
    return as_double(totals.select("store_nbr", "family", "date", "id", "sales", "total_sales"), "total_sales")


@query(
    "w3_global_max",
    sql(
        "SELECT id, date, MAX(date) OVER () AS max_date FROM fx_train",
        "train",
    ),
)
def w3(spark, d):
    """The largest date beside each row: a scalar subquery, no single-partition window."""
    rows = retail.train(spark, d)
    newest = rows.select(F.max("date")).scalar()
    return rows.select("id", "date", newest.alias("max_date"))


@query(
    "w4_first_per_date",
    sql(
        """SELECT date, type, locale, locale_name, description, transferred FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY date ORDER BY type, locale, locale_name, description, transferred) AS rn FROM fx_holidays_events) q
        WHERE rn = 1""",
        "holidays_events",
    ),
)
def w4(spark, d):
    return one_per_key(retail.holidays(spark, d), ("date",))


@query(
    "w5_lags",
    sql(
        "SELECT store_nbr, family, date AS ds, "
        + ", ".join(f"LAG(sales, {k}) OVER w AS lag{k}" for k in forecast.LAGS)
        + " FROM fx_train WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date)",
        "train",
    ),
)
def w5(spark, d):
    frame = forecast.panel(retail.train(spark, d))
    return frame.select("store_nbr", "family", "ds", *lags("y", forecast.LAGS, forecast.SERIES, "ds"))


ROLLING = ", ".join(
    f"CASE WHEN COUNT(sales) OVER w = 4 THEN {expr} END AS rolling_{name}_lag1_window4"
    for name, expr in (
        ("mean", "ROUND(AVG(sales) OVER w, 4)"),
        ("min", "MIN(sales) OVER w"),
        ("max", "MAX(sales) OVER w"),
    )
)
ROLL_WINDOW = "WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)"


@query(
    "w6_rolling",
    sql(f"SELECT store_nbr, family, date AS ds, {ROLLING} FROM fx_train {ROLL_WINDOW}", "train"),
)
def w6(spark, d):
    frame = forecast.panel(retail.train(spark, d))
    rows = frame.select("store_nbr", "family", "ds", *rolling("y", forecast.ROLL, forecast.SERIES, "ds"))
    mean = "rolling_mean_lag1_window4"
    return rows.withColumn(mean, F.round(mean, 4))


@query(
    "w7_back_fill",
    sql(
        """SELECT date, FIRST_VALUE(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW
        AND UNBOUNDED FOLLOWING) AS dcoilwtico FROM fx_oil""",
        "oil",
    ),
)
def w7(spark, d):
    return back_fill(retail.oil(spark, d), "date", "dcoilwtico")


@query(
    "o1_order_by",
    sql("SELECT DISTINCT CAST(YEAR(date) AS INT) AS yr FROM fx_oil ORDER BY 1 DESC", "oil"),
)
def o1(spark, d):
    return retail.oil(spark, d).select(F.year("date").alias("yr")).distinct().orderBy(F.col("yr").desc())


@query("o3_sort_within_partitions", sql(MONTHLY_SALES.format(t="fx_train"), "train"))
def o3(spark, d):
    keys = ["store_nbr", "family", "month_train_date", "year_train_date"]
    return a8(spark, d).sortWithinPartitions(*keys)


@query(
    "o4_top_sales",
    sql("SELECT id, sales FROM fx_train ORDER BY sales DESC, id LIMIT 10", "train"),
)
def o4(spark, d):
    return retail.train(spark, d).select("id", "sales").orderBy(F.col("sales").desc(), "id").limit(10)


@query(
    "o5_top_store_per_family",
    sql(
        """SELECT family, store_nbr, total FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY family ORDER BY total DESC,
        store_nbr) AS rn FROM (SELECT family, store_nbr, CAST(SUM(CAST(sales AS DECIMAL(14,2))) AS DOUBLE) AS total
        FROM fx_train GROUP BY 1, 2) g) q WHERE rn = 1""",
        "train",
    ),
)
def o5(spark, d):
    """The best row per group as an aggregate; a window would sort a whole group in one task."""
    totals = retail.train(spark, d).groupBy("family", "store_nbr").agg(
        F.sum(F.col("sales").cast("decimal(14,2)")).cast("double").alias("total")
    )
    best = totals.groupBy("family").agg(F.max(F.struct("total", (-F.col("store_nbr")).alias("s"))).alias("b"))
    return best.select("family", (-F.col("b.s")).alias("store_nbr"), "b.total")


@query(
    "u1_concat_frames",
    sql(
        """SELECT date, store_nbr, CAST(transactions AS DOUBLE) AS value FROM fx_transactions UNION ALL
        SELECT date, NULL, dcoilwtico FROM fx_oil""",
        "transactions",
        "oil",
    ),
)
def u1(spark, d):
    visits = retail.transactions(spark, d).select("date", "store_nbr", F.col("transactions").cast("double").alias("value"))
    prices = retail.oil(spark, d).select("date", F.col("dcoilwtico").alias("value"))
    return visits.unionByName(prices, allowMissingColumns=True)
