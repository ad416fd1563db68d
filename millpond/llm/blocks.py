"""Comparing the members of many groups in bounded blocks, and streaming whole groups through a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.session import materialise


def dealt(members: DataFrame, key: str, deal_by: str, block: int) -> DataFrame:
    """``members`` with columns p and q: each row once for every pair of blocks of its group that it is part of.

    A group of up to ``block`` rows is one block, compared with itself (p = q = 0).
    A larger one is dealt into blocks by a hash of ``deal_by``; every two blocks,
    and each block with itself, meet under one (key, p, q), so no task ever holds
    more than two blocks. ``members`` is read twice.
    """
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    large = materialise(sizes.select(key, F.ceil(F.col("n") / block).cast("int").alias("parts")), "large")
    joined = members.join(large, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64(deal_by), F.col("parts")).cast("int")
    out = joined.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = {"p": F.least("own", "other"), "q": F.greatest("own", "other")}
    return out.withColumns(pair).drop("parts", "other")


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], work: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None],
    rows: int = 20_000,
) -> Iterator[pa.RecordBatch]:
    """Calls ``work(table, starts)`` on runs of whole groups of a stream that is sorted by ``keys``.

    ``starts`` holds the first row of each group and the table's length. A call gets about ``rows`` rows or one group.
    """
    held: list[pa.RecordBatch] = []
    count = 0

    def edges(table: pa.Table) -> np.ndarray:
        new = np.zeros(max(table.num_rows - 1, 0), bool)
        for key in keys:
            column = table.column(key).combine_chunks().to_numpy(zero_copy_only=False)
            new |= column[1:] != column[:-1]
        return np.concatenate(([0], np.flatnonzero(new) + 1))

    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            held.append(batch.slice(k, rows))
            count += held[-1].num_rows
            if count < rows:
                continue
            table = pa.Table.from_batches(held)
            starts = edges(table)
            if len(starts) > 1:
                out = work(table.slice(0, int(starts[-1])), starts)
                if out is not None and out.num_rows:
                    yield out
                held = table.slice(int(starts[-1])).to_batches()
                count = sum(b.num_rows for b in held)
    if count:
        table = pa.Table.from_batches(held)
        out = work(table, np.append(edges(table), table.num_rows))
        if out is not None and out.num_rows:
            yield out


def least_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each of n nodes' component under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
