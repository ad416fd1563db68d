"""The retail tables, derived from the order, part, supplier and customer tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAMILY_CODES = ("STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _family_code() -> Column:
    code = F.lit(len(FAMILY_CODES))
    for i, family in reversed(list(enumerate(FAMILY_CODES))):
        code = F.when(F.col("family") == family, i).otherwise(code)
    return code


def train(spark: SparkSession, folder: str) -> DataFrame:
    """Daily sales per store and family."""
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    daily = lines.groupBy(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").cast("int").alias("store_nbr"),
        F.col("p_type").alias("family"),
    ).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).cast("double").alias("sales"),
        F.max(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("onpromotion"),
    )
    day = (F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date")).cast("bigint")
    key = day * 100000 + F.col("store_nbr") * 10 + _family_code()
    return daily.select(key.alias("id"), "date", "store_nbr", "family", "sales", "onpromotion")


def stores(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, folder, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        key.cast("int").alias("store_nbr"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.substring(F.lit("ABCDE"), (key % 5 + 1).cast("int"), F.lit(1)).alias("type"),
        (key % 17 + 1).cast("int").alias("cluster"),
    )


def oil(spark: SparkSession, folder: str) -> DataFrame:
    """One price per day, unknown on every tenth day of a month."""
    daily = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(14,2)")).alias("total"), F.count("*").alias("n"))
    )
    price = (F.col("total") / F.col("n") / 5000).cast("decimal(14,2)").cast("double")
    return daily.select("date", F.when(F.dayofmonth("date") % 10 != 0, price).alias("dcoilwtico"))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("date"), F.col("l_suppkey").cast("int").alias("store_nbr"))
        .agg(F.countDistinct("l_orderkey").cast("int").alias("transactions"))
    )


def holidays(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    kinds = {"HOUSEHOLD": "Holiday", "MACHINERY": "Event", "FURNITURE": "Transfer", "BUILDING": "Bridge"}
    kind = F.lit("Additional")
    for segment, name in kinds.items():
        kind = F.when(F.col("c_mktsegment") == segment, name).otherwise(kind)

    def by_third(national: Column, regional: Column, local: Column) -> Column:
        return F.when(key % 3 == 0, national).when(key % 3 == 1, regional).otherwise(local)

    rows = table(spark, folder, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.date_add(F.lit("1995-01-01").cast("date"), ((key * 7) % 1200).cast("int")).alias("date"),
        kind.alias("type"),
        by_third(F.lit("National"), F.lit("Regional"), F.lit("Local")).alias("locale"),
        by_third(F.lit("ALL"), F.col("r_name"), F.col("n_name")).alias("locale_name"),
        F.col("c_name").alias("description"),
        (F.col("c_acctbal") < 0).alias("transferred"),
    )


def energy_train(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("row_id"),
            (F.col("o_custkey") % 30).cast("int").alias("data_block_id"),
            F.col("c_nationkey").alias("county"),
            F.col("c_mktsegment").alias("product_type"),
            F.col("o_totalprice").alias("target"),
        )
    )


def energy_client(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "customer")
        .filter(F.col("c_custkey") % 4 != 0)
        .groupBy(
            (F.col("c_custkey") % 30).cast("int").alias("data_block_id"),
            F.col("c_nationkey").alias("county"),
            F.col("c_mktsegment").alias("product_type"),
        )
        .agg(F.count("*").alias("clients"))
    )


# Two states of sales and stores, for merges, change feeds and histories.
def _mix() -> Column:
    return F.dayofmonth("date") + F.month("date") + 3 * F.col("store_nbr")


def train_v1(spark: SparkSession, folder: str) -> DataFrame:
    return train(spark, folder).filter(_mix() % 10 != 0)


def train_v2(spark: SparkSession, folder: str) -> DataFrame:
    changed = F.when(_mix() % 7 == 0, F.col("sales") + 10).otherwise(F.col("sales"))
    return train(spark, folder).withColumn("sales", changed).filter(_mix() % 11 != 0)


def stores_v1(spark: SparkSession, folder: str) -> DataFrame:
    return stores(spark, folder).filter(F.col("store_nbr") % 10 != 9)


def stores_v2(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("store_nbr") % 4 == 0, "E").otherwise(F.col("type"))
    return stores(spark, folder).withColumn("type", kind).filter(F.col("store_nbr") % 11 != 5)
