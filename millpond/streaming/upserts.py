"""Micro-batches merged into plain Parquet: one write per batch, safe to run again.

Small tables keep one folder per batch with their whole state; a batch is a function of the state
before it and its rows, so a batch that is run again after a failure writes the same folder again.
Facts are merged month by month in place: a merge applied twice equals one. Months in which a batch
meets no stored row get its rows as further files, so that new rows cost what they are and not what
their months hold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from millpond.operators.gold_store import read_months, write_months
from millpond.operators.merge import Clause, merge
from millpond.session import materialise

Prepare = Callable[[DataFrame], DataFrame]


def _finished(spark: SparkSession, folder: str, below: int | None = None) -> list[int]:
    """Batches whose write ended, those before ``below`` only."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    numbers = sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)
    return [n for n in numbers if below is None or n < below]


def read_state(spark: SparkSession, folder: str, schema: StructType, below: int | None = None) -> DataFrame:
    """The table after its newest finished batch (before ``below``); empty before the first."""
    batches = _finished(spark, folder, below)
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/batch={batches[-1]}")


def _started(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, drain: bool) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if drain else writer).start()
    if drain:
        query.awaitTermination()
    return query


def upsert_state(
    df: DataFrame,
    folder: str,
    schema: StructType,
    on: Sequence[str],
    matched: Sequence[Clause],
    not_matched: Sequence[Clause],
    checkpoint: str,
    prepare: Prepare | None = None,
    identity: str | None = None,
    drain: bool = True,
) -> StreamingQuery:
    """Merge every micro-batch into a table that is written whole, for dimensions.

    Batch n reads the newest finished state before n and writes ``folder/batch=n``. A state belongs
    to one checkpoint; a replay from a new checkpoint takes a new folder. Old states stay until the
    folder's retention removes them.
    """

    def merge_batch(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        state = read_state(batch.sparkSession, folder, schema, number)
        new = merge(state, rows, on, matched, not_matched, identity=identity, staged=True)
        new.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return _started(df, merge_batch, checkpoint, drain)


def _mark(spark: SparkSession, folder: str, below: int) -> int:
    """The largest number given out by batches before ``below``."""
    batches = _finished(spark, folder, below)
    return spark.read.parquet(f"{folder}/batch={batches[-1]}").first()["largest"] if batches else 0


def upsert_months(
    df: DataFrame,
    folder: str,
    schema: StructType,
    on: Sequence[str],
    matched: Sequence[Clause],
    not_matched: Sequence[Clause],
    checkpoint: str,
    prepare: Prepare | None = None,
    identity: str | None = None,
    drain: bool = True,
) -> StreamingQuery:
    """Merge every micro-batch into a fact stored by the month of its ``date``, which must be a merge key.

    Only the months of the batch (bounded by the calendar) are read. Those in which a key of the
    batch is stored already are merged, staged and written back; to the others its rows are added.
    A batch that died while it added rows finds these when it is run again. The largest ``identity`` number is kept beside the table with the batch that gave it, so
    no batch scans the fact for it; numbers found in the months read count too, as a run that died
    may have written them. Rows without a date match nothing: they would be inserted every time,
    so they raise.
    """
    if "date" not in on:
        raise ValueError("a fact by month is merged on its date")

    def merge_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = materialise(prepare(batch) if prepare else batch, "merge-source")
        months = [r["m"] for r in rows.select(F.trunc("date", "month").alias("m")).distinct().collect()]
        if None in months:
            raise ValueError("a row without a date")
        if not months:
            return
        old = _months(spark, folder, schema, months)
        after = None
        if identity:
            after = max(_mark(spark, f"{folder}-marks", number), old.select(F.max(identity)).first()[0] or 0)
        met = old.select(*on).join(rows.select(*on), list(on), "left_semi").select(F.trunc("date", "month").alias("m"))
        meeting = [r["m"] for r in met.distinct().collect()]
        old = _months(spark, folder, schema, meeting)
        new = materialise(merge(old, rows, on, matched, not_matched, identity=identity, identity_after=after), "months")
        stored = F.trunc("date", "month").isin(meeting)
        if meeting:
            write_months(new.filter(stored), folder)
        if len(meeting) < len(months):
            write_months(new.filter(~stored), folder, "append")
        if identity:
            largest = new.select(F.greatest(F.max(identity), F.lit(after)).alias("largest"))
            largest.write.mode("overwrite").parquet(f"{folder}-marks/batch={number}")

    return _started(df, merge_batch, checkpoint, drain)


def _months(spark: SparkSession, folder: str, schema: StructType, months) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return read_months(spark, folder, months).select(*schema.names)
