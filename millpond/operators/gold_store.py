"""Gold summaries as stored tables: loaded from a fact once, then refreshed month by month from its change feed.

Facts lie in one folder per month (``month=YYYY-MM-01``), summaries in one per year and month. A
refresh reads and rewrites only the months that change rows touch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpond.operators import gold
from millpond.operators.changes import OPENING
from millpond.operators.tables import conform
from millpond.schemas import GOLD
from millpond.session import materialise

MONTH = "month"


@dataclass(frozen=True)
class Summary:
    """A monthly summary: its table in ``schemas.GOLD``, its month and year columns and its other keys."""

    table: str
    summarise: Callable[[DataFrame], DataFrame]
    month: str
    year: str
    by: tuple[str, ...] = ()

    @property
    def schema(self):
        return GOLD[self.table].schema


SALES = Summary("gold_sales_dtls", gold.monthly_sales, "month_train_date", "year_train_date", ("store_nbr", "family"))
OIL = Summary("gold_oil_price_dtls", gold.monthly_oil, "month_oil_price", "year_oil_price")
TRANSACTIONS = Summary(
    "gold_transactions_dtls", gold.monthly_transactions, "month_transactions_date", "year_transactions_date", ("store_nbr",)
)


def write_months(fact: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Store a fact by the month of its ``date``, replacing the months it holds and no other.

    The rebalance deals rows by month but splits a month that is larger than one file should be.
    With the mode ``append`` the rows are put beside those that the months have.
    """
    dated = fact.withColumn(MONTH, F.trunc("date", "month")).hint("rebalance", MONTH)
    writer = dated.write.mode(mode).partitionBy(MONTH)
    writer.option("partitionOverwriteMode", "dynamic").parquet(folder)


def read_months(spark: SparkSession, folder: str, months: Sequence[date] | None = None) -> DataFrame:
    """The fact, or some months of it: a filter on the folder names, so other months are never listed for reading."""
    fact = spark.read.parquet(folder)
    if months is not None:
        fact = fact.filter(F.col(MONTH).cast("date").isin(list(months)))
    return fact.drop(MONTH)


def read_summary(spec: Summary, spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(spec.schema).parquet(folder).select(*spec.schema.names)


def _write(spec: Summary, rows: DataFrame, folder: str) -> None:
    parts = [spec.year, spec.month]
    writer = conform(rows, spec.schema).hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts)
    writer.option("partitionOverwriteMode", "dynamic").parquet(folder)


def load(spec: Summary, fact: DataFrame, folder: str, as_of: str) -> None:
    """First load: every month of the fact."""
    _write(spec, spec.summarise(fact).withColumn("proc_dt", F.lit(as_of).cast("date")), folder)


def refresh(spec: Summary, fact_folder: str, folder: str, rows: DataFrame, as_of: str) -> list[date]:
    """Bring a stored summary up to date with a fact whose change rows are ``rows``; returns the months rewritten.

    The touched groups are staged. Their months, bounded by the calendar, go to the driver and
    become partition filters of the fact and of the summary; inside them untouched groups keep
    their row and date. New content is staged before it replaces the folders it was read from, and
    a month that lost all its groups loses its folder. Every step is a function of the fact and the
    feed, so a refresh that died is simply run again.
    """
    spark = rows.sparkSession
    keys = [*spec.by, spec.month, spec.year]
    place = {spec.month: F.month("date"), spec.year: F.year("date"), MONTH: F.trunc("date", "month")}
    changed = rows.filter(F.col("_change_type").isin(*OPENING, "update_preimage", "delete")).withColumns(place)
    touched = materialise(changed.select(*keys, MONTH).distinct(), "touched-groups")
    months = sorted(r[MONTH] for r in touched.select(MONTH).distinct().collect())
    if not months:
        return []
    fact = read_months(spark, fact_folder, months)
    if spec.by:
        dated = fact.withColumns({spec.month: F.month("date"), spec.year: F.year("date")})
        fact = dated.join(touched, keys, "left_semi").select(*fact.columns)
    fresh = spec.summarise(fact).withColumn("proc_dt", F.lit(as_of).cast("date"))
    old = read_summary(spec, spark, folder).filter(F.make_date(spec.year, spec.month, F.lit(1)).isin(months))
    kept = old.join(touched, keys, "left_anti")
    staged = materialise(conform(fresh, spec.schema).unionByName(kept), spec.table)
    _write(spec, staged, folder)
    left = {date(r[spec.year], r[spec.month], 1) for r in staged.select(spec.year, spec.month).distinct().collect()}
    for month in months:
        if month not in left:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{spec.year}={month.year}/{spec.month}={month.month}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return months
