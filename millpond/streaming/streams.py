"""Streams: files to tables, tables to keyed upserts, change feeds to readers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from millpond.operators.merge import Clause
from millpond.operators.tables import Lake


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    glob: str = "*.csv",
    files_per_batch: int | None = None,
) -> DataFrame:
    """CSV files as they arrive, subfolders included, chosen by file name."""
    reader = (
        spark.readStream.format("csv")
        .option("header", True)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .schema(schema)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def table_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str | None = None,
    files_per_batch: int | None = None,
    most_batches: int | None = None,
) -> DataFrame:
    """Rows appended to a Parquet folder.

    With ``most_batches`` a backlog of more than that many times ``files_per_batch`` files is
    taken in ``most_batches`` larger batches, so that the number of batches does not grow with it.
    """
    reader = spark.readStream.schema(schema or spark.read.parquet(folder).schema)
    if files_per_batch and most_batches:
        waiting = spark.read.schema(schema) if schema else spark.read
        files_per_batch = max(files_per_batch, -(-len(waiting.parquet(folder).inputFiles()) // most_batches))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def changes_stream(lake: Lake, name: str) -> DataFrame:
    """The change rows of a table as a stream; only whole, committed logs are in its folder."""
    return table_stream(lake.spark, f"{lake.root}/{name}/changes")


def _finish(query: StreamingQuery, wait: bool) -> StreamingQuery:
    if wait:
        query.awaitTermination()
    return query


def append_stream(
    df: DataFrame,
    folder: str | None,
    checkpoint: str,
    table: str | None = None,
    load: str = "first",
    drain: bool = True,
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet folder, or to a catalog table.

    ``drain`` processes what is there and stops, otherwise the query keeps
    running and takes new files as soon as it is free, or ``every`` so often. Running the same ``load`` again adds only new files; another load
    name has its own checkpoint, so every file is loaded once more.
    """
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", f"{checkpoint}/{load}")
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    query = writer.start(f"{folder}/{load}") if table is None else writer.toTable(table)
    return _finish(query, drain)


def read_loads(spark: SparkSession, folder: str, loads: Sequence[str] = ("first",)) -> DataFrame:
    """The rows of one or more loads; columns a load lacks are null."""
    frames = [spark.read.parquet(f"{folder}/{load}") for load in loads]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def upsert_stream(
    df: DataFrame,
    lake: Lake,
    name: str,
    on: Sequence[str],
    matched: Sequence[Clause],
    not_matched: Sequence[Clause],
    checkpoint: str,
    as_of: str | Callable[[], str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    identity: str | None = None,
    drain: bool = True,
) -> StreamingQuery:
    """Merge every micro-batch into a table.

    The checkpoint and batch number name the commit, so a batch that is run
    again after a failure changes nothing. ``as_of`` is the day of all commits, or a
    function that gives the day of each, for a query that keeps running.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        day = as_of() if callable(as_of) else as_of
        # staged: the batch is read from its files once, not once per step of the merge
        lake.merge(
            name, rows, on, matched, not_matched, day, f"{checkpoint}#{batch_id}", identity, staged=True
        )

    writer = (
        df.writeStream.foreachBatch(merge_batch).outputMode("update").option("checkpointLocation", checkpoint)
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    return _finish(writer.start(), drain)
