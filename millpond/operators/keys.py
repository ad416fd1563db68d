"""Surrogate keys: consecutive numbers for new dimension rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millpond.session import shared_folder

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def assign(
    new: DataFrame, existing: DataFrame | None, key: str, order_by: Sequence[str], after: int | None = None
) -> DataFrame:
    """Number ``new`` rows in ``order_by`` order, after the largest existing key.

    A caller that keeps the largest number given so far passes it as ``after``; then ``existing``
    is not read at all.

    A ``row_number`` over the whole input would sort it in one task. Here the
    rows are range-partitioned and sorted in parallel, and each partition adds
    the number of rows before it; only one count per partition is gathered. The
    sorted rows are checkpointed first, so counts and numbers see the same
    partitions even when an executor is lost. Rows should be distinct on
    ``order_by``, as the numbering is otherwise open among equals.
    """
    shared_folder(new.sparkSession)
    ordered = new.repartitionByRange(*order_by).sortWithinPartitions(*order_by).checkpoint()
    spot = F.monotonically_increasing_id()
    placed = ordered.select(
        "*",
        F.shiftright(spot, _ROW_BITS).cast("int").alias("_part"),
        spot.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("n"))
        .select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    )
    # one row per partition: the broadcast size follows the partition count, not the data
    numbered = placed.join(F.broadcast(starts), "_part")
    top = F.lit(after or 0)
    if after is None and existing is not None:
        top = F.coalesce(existing.select(F.max(key)).scalar(), F.lit(0))
    number = (top + F.col("_start") + F.col("_row") + 1).cast("long")
    return numbered.select(number.alias(key), *new.columns)


def insert_unseen(dim: DataFrame, source: DataFrame, key: str, on: str) -> DataFrame:
    """The dimension plus one numbered row per source value it does not hold yet.

    Null values are never added, and a null already in the dimension does not
    block the others.
    """
    unseen = (
        source.select(on)
        .filter(F.col(on).isNotNull())
        .distinct()
        .join(dim.select(on), on, "left_anti")
    )
    return dim.unionByName(assign(unseen, dim, key, [on]).select(*dim.columns))
