"""Bronze → silver: what each silver table takes from its source and how it is merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.operators import calendar_dim
from millpond.operators.merge import Clause, insert, merge, update
from millpond.operators.tables import Lake
from millpond.schemas import SILVER


def oil_prices(bronze: DataFrame) -> DataFrame:
    return bronze.select("date", F.col("dcoilwtico").cast("decimal(14,2)").alias("oil_price"))


def fact_train(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("sales", F.col("sales").cast("decimal(14,2)"))


def fact_sales(bronze: DataFrame, families: DataFrame) -> DataFrame:
    """Sales with the family replaced by its number; unknown families drop out."""
    return fact_train(bronze).join(families, "family").drop("family")


def regional_holidays(bronze: DataFrame) -> DataFrame:
    kept = (F.col("locale") != "National") & ~F.col("transferred")
    return one_per_key(bronze.filter(kept), SILVER["silver_dim_regional_holiday"].keys)


def one_per_key(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The smallest row of each key, by the remaining columns in order.

    An aggregate with map-side combine instead of a numbered window, so a key
    that holds most of the rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def text_to_boolean(column: str) -> F.Column:
    """TRUE / FALSE text to a boolean, anything else to null."""
    return F.when(F.col(column) == "TRUE", True).when(F.col(column) == "FALSE", False)


# the upserts whose source needs preparation; others take the bronze rows as they are
PREPARE = {
    "silver_dim_oil_prices": oil_prices,
    "silver_fact_train": fact_train,
    "silver_dim_regional_holiday": regional_holidays,
    "silver_dim_holidays_events": lambda bronze: bronze.dropDuplicates(),
}


def clauses(table: str) -> tuple[list[Clause], list[Clause]]:
    """Update the value columns of a matched row, insert everything the source has."""
    spec = SILVER[table]
    names = [n for n in spec.schema.names if n != spec.identity]
    return (
        [update({c: f"s.{c}" for c in spec.values})],
        [insert({c: f"s.{c}" for c in names})],
    )


def prepare(table: str, bronze: DataFrame) -> DataFrame:
    return PREPARE.get(table, lambda df: df)(bronze)


def upsert(table: str, target: DataFrame, source: DataFrame, staged: bool = False) -> DataFrame:
    """The silver table after one batch; ``source`` is already prepared."""
    matched, not_matched = clauses(table)
    spec = SILVER[table]
    return merge(target, source, spec.keys, matched, not_matched, identity=spec.identity, staged=staged)


def create_lake(lake: Lake, table: str, as_of: str) -> None:
    """The empty stored table; facts are laid out by month."""
    spec = SILVER[table]
    lake.create(table, spec.schema, as_of, partition_by=spec.partition_by)


def upsert_lake(lake: Lake, table: str, bronze: DataFrame, as_of: str, batch: str | None = None) -> int:
    """Prepare and merge a batch into the stored table; returns the version."""
    matched, not_matched = clauses(table)
    spec = SILVER[table]
    source = prepare(table, bronze)
    return lake.merge(table, source, spec.keys, matched, not_matched, as_of, batch, spec.identity)


def dim_date(days: DataFrame, holidays: DataFrame, **options) -> DataFrame:
    return calendar_dim.build(days, holidays, **options)
