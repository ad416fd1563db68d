"""Folding one payload per partition into a single one, a few payloads per task at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.session import materialise

PART = "part long, payload binary"
_SCHEMA = pa.schema([("part", pa.int64()), ("payload", pa.binary())])


def row(part: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"part": part, "payload": payload}], schema=_SCHEMA)


def folded(parts: DataFrame, fold: Callable[[Sequence[bytes]], bytes], label: str, fan: int = 16) -> bytes | None:
    """``fold`` over the payloads of ``parts`` (``PART``, part numbers from 0), in order, as a tree.

    No task and no driver holds more than ``fan`` payloads: the levels are grouped Arrow functions,
    and only the root's payload is collected. The first level is written, since making payloads is
    the costly part. None for no rows.
    """
    parts = materialise(parts, label)
    most = parts.agg(F.max("part")).first()[0]
    if most is None:
        return None

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        return pa.Table.from_batches([row(key[0].as_py(), fold(rows["payload"].to_pylist()))])

    while most > 0:
        group = F.floor(F.col("part") / fan).cast("long")
        parts = parts.withColumn("g", group).groupBy("g").applyInArrow(lambda k, t: meet(k, t.drop_columns("g")), PART)
        most //= fan
    return bytes(parts.first()["payload"])
