"""Functions over ordered series: totals beside rows, back-fill, lags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_group_total(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Every row with the total of its group.

    Same result as SUM OVER (PARTITION BY …) without a frame that holds one
    whole group in a task: totals are aggregated map-side and joined back, and a
    hot group's rows are split by the adaptive skew join.
    """
    totals = df.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.sum(value).alias(name))
    match = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return df.join(totals, match, "left").select(*df.columns, name)


def back_fill(df: DataFrame, order: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Replace a null by the next known value in date order (per key, if given).

    Two levels instead of one global window: months are filled in parallel, and
    a month that ends in nulls takes the first known value of a later month.
    Only one row per month takes part in that second step, so its size is
    bounded by the calendar. Expects one row per key and date.
    """
    month = F.trunc(order, "month")
    dated = df.withColumn("_month", month)
    inside = Window.partitionBy(*keys, "_month").orderBy(order)
    ahead = inside.rowsBetween(0, Window.unboundedFollowing)
    later = Window.partitionBy(*keys).orderBy("_month").rowsBetween(1, Window.unboundedFollowing)
    firsts = dated.groupBy(*keys, "_month").agg(
        F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_first")
    )
    carry = firsts.select(*keys, "_month", F.first("_first", ignorenulls=True).over(later).alias("_next"))
    filled = dated.withColumn(value, F.first(value, ignorenulls=True).over(ahead))
    joined = filled.join(carry, [*keys, "_month"], "left")
    return joined.withColumn(value, F.coalesce(value, "_next")).select(*df.columns)


def lags(column: str, steps: Sequence[int], keys: Sequence[str], order: str) -> list[Column]:
    """``lag<k>`` columns over each series, counted in rows."""
    series = Window.partitionBy(*keys).orderBy(order)
    return [F.lag(column, k).over(series).alias(f"lag{k}") for k in steps]


def rolling(column: str, width: int, keys: Sequence[str], order: str) -> list[Column]:
    """Mean, least and largest of the ``width`` rows before this one.

    Null until that many known values exist.
    """
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(-width, -1)
    full = F.count(column).over(frame) == width
    return [
        F.when(full, fn(column).over(frame)).alias(f"rolling_{label}_lag1_window{width}")
        for label, fn in (("mean", F.avg), ("min", F.min), ("max", F.max))
    ]
