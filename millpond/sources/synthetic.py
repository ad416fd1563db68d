"""Synthetic sales rows for load tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ranges synthetic sales are drawn from.
FAMILIES = ("HOME CARE", "EGGS", "DAIRY", "MEATS", "BEAUTY", "BABY CARE")
STORES = 54
DAYS = 10
MAX_SALES = 500
SALES_STEP = 0.5
PROMOTED_PERCENT = 5


def draw(id_column: str, name: str, seed: int, size: int) -> Column:
    """A number in 0 … size − 1 that depends only on id, name and seed.

    ``rand`` depends on how rows are partitioned, so a retried task may draw
    other numbers; a hash of the row's own id cannot.
    """
    digest = F.md5(F.concat_ws(":", F.lit(f"{seed}:{name}"), F.col(id_column).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % size


def synthetic_sales(ids: DataFrame, id_column: str, seed: int, start_date: str) -> DataFrame:
    """One sales row per id: date within ten days, store, family, sales, promotion."""
    family = F.element_at(F.array(*map(F.lit, FAMILIES)), (draw(id_column, "family", seed, len(FAMILIES)) + 1).cast("int"))
    steps = int(MAX_SALES / SALES_STEP) + 1
    return ids.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.date_add(F.lit(start_date).cast("date"), draw(id_column, "date", seed, DAYS).cast("int")).alias("date"),
        (draw(id_column, "store", seed, STORES) + 1).cast("int").alias("store_nbr"),
        family.alias("family"),
        (draw(id_column, "sales", seed, steps) * SALES_STEP).cast("double").alias("sales"),
        (draw(id_column, "promo", seed, 100) < PROMOTED_PERCENT).cast("int").alias("onpromotion"),
    )
