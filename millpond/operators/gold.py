"""Gold summaries: monthly totals, and their refresh from change rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpond.operators.changes import OPENING
from millpond.operators.scd2 import active
from millpond.session import materialise


def monthly_sales(train: DataFrame) -> DataFrame:
    """Total sales per store, family and month.

    A plain aggregate: partial sums leave each map task, so the shuffle carries
    one row per group and task, not the fact rows.
    """
    return train.groupBy(
        "store_nbr",
        "family",
        F.month("date").alias("month_train_date"),
        F.year("date").alias("year_train_date"),
    ).agg(F.sum(F.col("sales").cast("decimal(14,2)")).alias("total_sales"))


def monthly_oil(oil: DataFrame) -> DataFrame:
    """Average oil price per month, at two decimals rounded half up."""
    return oil.groupBy(
        F.month("date").alias("month_oil_price"), F.year("date").alias("year_oil_price")
    ).agg(F.avg(F.col("oil_price").cast("decimal(14,2)")).cast("decimal(14,2)").alias("oil_price"))


def monthly_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(
        "store_nbr",
        F.month("date").alias("month_transactions_date"),
        F.year("date").alias("year_transactions_date"),
    ).agg(F.sum("transactions").alias("total_transactions"))


def refresh(
    summary: DataFrame,
    fact: DataFrame,
    rows: DataFrame,
    summarise: Callable[[DataFrame], DataFrame],
    month_of: tuple[str, str],
    as_of: str,
    by: Sequence[str] = (),
    update_on: Sequence[str] = ("insert", "update_postimage", "delete"),
) -> DataFrame:
    """Recompute only the groups that change rows touch, and merge them in.

    ``month_of`` names the summary's month and year columns and ``by`` its other
    keys. The touched keys are a small distinct set, written once. The fact is
    semi-joined to them before it is aggregated, so untouched months never reach
    the shuffle, and the summary loses its touched groups in one anti join. A
    group that lost all its rows is thereby removed. ``update_on`` limits which
    kinds of change may refresh a group that is already in the summary.
    """
    month, year = month_of
    keys = [*by, month, year]
    place: list[Column] = [F.month("date").alias(month), F.year("date").alias(year)]
    touched = materialise(
        rows.filter(F.col("_change_type").isin(*OPENING, "delete"))
        .select(*by, *place, F.col("_change_type").isin(*update_on).alias("_may"))
        .groupBy(*keys)
        .agg(F.bool_or("_may").alias("_may")),
        "touched-groups",
    )
    dated = fact.withColumns({month: F.month("date"), year: F.year("date")})
    affected = dated.join(touched, keys, "left_semi").select(*fact.columns)
    fresh = summarise(affected).withColumn("proc_dt", F.lit(as_of).cast("date"))
    replaced = touched.filter("_may")
    kept = summary.join(replaced, keys, "left_anti")
    if set(update_on) >= {*OPENING, "delete"}:
        return kept.unionByName(fresh)
    allowed = fresh.join(replaced, keys, "left_semi")
    new = fresh.join(summary, keys, "left_anti")
    return kept.unionByName(allowed).unionByName(new.join(replaced, keys, "left_anti"))


def store_products(rows: DataFrame, stores: DataFrame) -> DataFrame:
    """Distinct (store, family) pairs of the change feed with the active store row."""
    sold = (
        rows.filter(F.col("_change_type").isin(*OPENING) & F.col("family").isNotNull())
        .select("store_nbr", "family")
        .distinct()
    )
    current = active(stores).select("store_nbr", "city", "state", "type", "cluster").distinct()
    return sold.join(current, "store_nbr", "left")


def stores_per_city_cluster(stores: DataFrame) -> DataFrame:
    return stores.groupBy("city", "cluster").agg(F.countDistinct("store_nbr").alias("stores"))


def products_per_store(train: DataFrame) -> DataFrame:
    return train.groupBy("store_nbr").agg(F.countDistinct("family").alias("products"))


def city_cluster_month(sales: DataFrame, transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales and transactions per city, cluster and month.

    Each fact is reduced to store × month before it meets the store dimension,
    and the two are combined by union and sum, so no sale row ever meets a
    transaction row.
    """
    month = F.month("date").alias("month"), F.year("date").alias("year")
    sold = sales.groupBy("store_nbr", *month).agg(
        F.sum(F.col("sales").cast("decimal(14,2)")).alias("total_sales"),
        F.lit(None).cast("bigint").alias("total_transactions"),
    )
    visits = transactions.groupBy("store_nbr", *month).agg(
        F.lit(None).cast("decimal(24,2)").alias("total_sales"),
        F.sum("transactions").alias("total_transactions"),
    )
    places = stores.select("store_nbr", "city", "cluster")
    return (
        sold.unionByName(visits)
        .join(places, "store_nbr")
        .groupBy("city", "cluster", "month", "year")
        .agg(F.sum("total_sales").alias("total_sales"), F.sum("total_transactions").alias("total_transactions"))
    )
