"""Catalog tables, and tables that keep a change feed beside their snapshots."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millpond.operators import changes
from millpond.operators.merge import Clause, merge, merge_changes
from millpond.session import materialise

_COMMIT_DDL = "version BIGINT, committed_at TIMESTAMP, batch STRING, partition_by STRING"
_PART, _VERSION = "_part", "_v"
_NO_PART = "none"  # the partition of rows whose expression is null or empty


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


# -- catalog tables ---------------------------------------------------------
def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def create(
    spark: SparkSession,
    name: str,
    ddl: str,
    replace: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Typed empty Parquet table; VARCHAR lengths and DEFAULTs in the DDL are kept."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{parts}")


def write(df: DataFrame, name: str, mode: str = "error", partition_by: Sequence[str] = ()) -> None:
    """Write a catalog table; ``mode`` is error, append or overwrite."""
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    writer.saveAsTable(name)


def append(df: DataFrame, name: str, merge_schema: bool = False) -> None:
    """Append by column name. With ``merge_schema`` new columns are added to the
    table first (old rows read them as null) and missing ones are filled with null."""
    spark = df.sparkSession
    have = spark.table(name).schema
    if merge_schema:
        added = [f for f in df.schema if f.name not in have.names]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            have = spark.table(name).schema
    conform(df, have).write.insertInto(name)


def conform(df: DataFrame, schema: StructType, defaults: Mapping[str, str] | None = None) -> DataFrame:
    """The frame in the schema's columns, order and types, as INSERT would store it.

    A missing column takes its default expression, else null.
    """
    defaults = defaults or {}
    columns = []
    for f in schema:
        if f.name in df.columns:
            column = F.col(f"`{f.name}`")
        else:
            column = F.expr(defaults.get(f.name, "NULL"))
        columns.append(column.cast(f.dataType).alias(f.name))
    return df.select(columns)


def clone_all(spark: SparkSession, source_db: str, target_db: str, pattern: str = "*") -> list[str]:
    """Copy every table of a database into another, replacing what is there.

    The copy is created like its source in the catalog, so it has the same VARCHAR lengths, column
    defaults, nullability and partitioning; its rows are then inserted.
    """
    names = [t.name for t in spark.catalog.listTables(source_db, pattern) if not t.isTemporary and t.tableType != "VIEW"]
    for name in names:
        source, target = f"{source_db}.`{name}`", f"{target_db}.`{name}`"
        spark.sql(f"DROP TABLE IF EXISTS {target}")
        spark.sql(f"CREATE TABLE {target} LIKE {source}")
        spark.table(source).write.insertInto(target)
    return names


# -- tables with a change feed ----------------------------------------------
def _part(partition_by: str) -> Column:
    """The partition of a row; never null or empty, so that it can name a folder and be joined by."""
    value = F.nullif(F.expr(partition_by).cast("string"), F.lit(""))
    return F.coalesce(value, F.lit(_NO_PART)).alias(_PART)


class Lake:
    """Tables under one folder, each with its states, a change log and a commit list.

    ``<table>/snapshots/v=N`` holds version N, ``<table>/changes/_commit_version=N``
    the rows that led to it, and ``<table>/commits/n=N`` one row that makes the
    version visible. That row is written after all data, so a job that dies halfway
    leaves readers on the previous version, and its batch can run again as if it had
    not run. The log gets its final name once, after that row, so a stream over
    ``changes`` never reads a commit that died; a log whose renaming was cut short is
    named by the next call. One writer per table is assumed, and a file system whose
    rename of a folder is atomic.

    A fact table is created with ``partition_by`` instead, an expression over its
    merge keys such as ``trunc(date, 'month')``. A merge then reads the partitions it
    touches and writes them anew under ``<table>/data/_v=N``; ``<table>/parts/_v=N``
    lists them, those that came out empty included. The newest listed version of a
    partition holds its rows. Partitions it does not touch are not copied.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _at(self, name: str, part: str) -> str:
        return f"{self.root}/{name}/{part}"

    # -- commit list --
    def exists(self, name: str) -> bool:
        return _path_exists(self.spark, self._at(name, "commits"))

    def commits(self, name: str) -> DataFrame:
        return self.spark.read.schema(_COMMIT_DDL).parquet(self._at(name, "commits"))

    def latest(self, name: str) -> int:
        return self.commits(name).agg(F.max("version")).first()[0]

    def _done(self, name: str, batch: str | None) -> bool:
        return batch is not None and not self.commits(name).filter(F.col("batch") == batch).isEmpty()

    def _record(self, name, version, as_of, batch=None, partition_by=None) -> None:
        row = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"),
            F.lit(as_of).cast("timestamp").alias("committed_at"),
            F.lit(batch).cast("string").alias("batch"),
            F.lit(partition_by).cast("string").alias("partition_by"),
        )
        row.coalesce(1).write.mode("overwrite").parquet(self._at(name, f"commits/n={version}"))

    def _publish(self, name: str, version: int) -> None:
        """Give the log of a committed version its final name, unless it has it."""
        staged, fs = _path(self.spark, self._at(name, f"log/_commit_version={version}"))
        if fs.exists(staged):
            final, _ = _path(self.spark, self._at(name, f"changes/_commit_version={version}"))
            if fs.exists(final):  # left by a commit that died, never a committed log: those are gone from log/
                fs.delete(final, True)
            fs.mkdirs(final.getParent())
            if not fs.rename(staged, final):
                raise OSError(f"cannot rename {staged}")

    def _partition(self, name: str) -> str | None:
        return self.commits(name).filter("version = 0").first().partition_by

    # -- reading --
    def create(self, name: str, schema: StructType, as_of: str, partition_by: str | None = None) -> None:
        """Version 0: the empty table."""
        if self.exists(name):
            raise ValueError(f"table {name} exists")
        empty = self.spark.createDataFrame([], schema)
        changes.append(empty.withColumn("_change_type", F.lit("insert")), self._at(name, "log"), 0, as_of)
        if partition_by is None:
            empty.write.mode("overwrite").parquet(self._at(name, "snapshots/v=0"))
        else:
            self._write_partitions(name, 0, empty, empty.select(_part(partition_by)), partition_by)
        self._record(name, 0, as_of, partition_by=partition_by)
        self._publish(name, 0)

    def _write_partitions(
        self, name: str, version: int, after: DataFrame, parts: DataFrame, partition_by: str
    ) -> None:
        """The rows of the listed partitions as of a version, and the list."""
        parts.write.mode("overwrite").parquet(self._at(name, f"parts/{_VERSION}={version}"))
        (
            after.select("*", _part(partition_by))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")  # what a commit that died left goes
            .partitionBy(_PART)
            .parquet(self._at(name, f"data/{_VERSION}={version}"))
        )

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The table at a version; the newest when none is given."""
        version = self.latest(name) if version is None else version
        if self._partition(name) is None:
            return self._typed(name, self._at(name, f"snapshots/v={version}"))
        return self._live(name, version).drop(_PART)

    def _live(self, name: str, version: int) -> DataFrame:
        """The rows of a partitioned table at a version, with their partition.

        Only the folders of live partitions are scanned. Their names, one short string
        each, pass the driver, which plans the scan from the folder listing anyway.
        """
        parts = self.spark.read.schema(f"{_PART} string, {_VERSION} bigint").parquet(self._at(name, "parts"))
        newest = parts.filter(F.col(_VERSION) <= version).groupBy(_PART).agg(F.max(_VERSION).alias(_VERSION))
        live = [(r[_VERSION], r[_PART]) for r in newest.collect()]
        folders = [self._at(name, f"data/{_VERSION}={v}") for v in sorted({v for v, _ in live})]
        rows = self._typed(name, *folders or [self._at(name, f"data/{_VERSION}=0")], partitions=True)
        is_live = F.concat_ws("@", _VERSION, _PART).isin([f"{v}@{p}" for v, p in live])
        return rows.filter(is_live).drop(_VERSION)

    def _typed(self, name: str, *folders: str, partitions: bool = False) -> DataFrame:
        self._publish(name, 0)
        logged = self.spark.read.parquet(self._at(name, "changes/_commit_version=0")).schema
        schema = StructType([f for f in logged if f.name not in changes.META])
        reader = self.spark.read
        if partitions:
            schema = schema.add(_VERSION, "long").add(_PART, "string")
            reader = reader.option("basePath", self._at(name, "data"))
        return reader.schema(schema).parquet(*folders).select(schema.names)

    def changes(self, name: str, start: int, end: int | None = None) -> DataFrame:
        """Change rows of the committed versions start … end, both included."""
        latest = self.latest(name)
        self._publish(name, latest)
        return changes.read(self.spark, self._at(name, "changes"), start, latest if end is None else min(end, latest))

    def history(self, name: str) -> DataFrame:
        return changes.history(self.changes(name, 0))

    # -- writing --
    def commit(
        self, name: str, rows: DataFrame, keys: Sequence[str], as_of: str, batch: str | None = None
    ) -> int:
        """Log the change rows as the next version and derive the new state from them.

        ``keys`` name one row of the table. A batch id that is already in the commit
        list does nothing, which makes a replayed micro-batch harmless.
        """
        if self._done(name, batch):
            return self.latest(name)
        return self._advance(name, rows, lambda before, log: changes.apply(before, log, keys), as_of, batch)

    def merge(
        self,
        name: str,
        source: DataFrame,
        on: Sequence[str],
        matched: Sequence[Clause] = (),
        not_matched: Sequence[Clause] = (),
        as_of: str = "1970-01-01",
        batch: str | None = None,
        identity: str | None = None,
        staged: bool = False,
    ) -> int:
        """MERGE into a table: the change rows come from the touched rows alone.

        The new state is the merge of the rows before, not the log applied by key, so
        rows that share a key keep their number. The source is read again for it;
        ``staged=True`` where reading it twice is costly or may differ.
        """
        if self._done(name, batch):
            return self.latest(name)
        source = materialise(source, "merge-source") if staged else source
        part = self._partition(name)
        if part is None:
            target = self.read(name)
        else:
            target = self._of_partitions(name, self._parts_of(source, part))
        rows = merge_changes(
            target, source, on, matched, not_matched, identity=identity, numbered_after=self.read(name)
        )

        def after(before: DataFrame, log: DataFrame) -> DataFrame:
            kept = merge(before, source, on, matched) if matched else before
            return kept.unionByName(log.filter("_change_type = 'insert'").select(before.columns))

        return self._advance(name, rows, after, as_of, batch)

    def _advance(
        self,
        name: str,
        rows: DataFrame,
        after: Callable[[DataFrame, DataFrame], DataFrame],
        as_of: str,
        batch: str | None,
    ) -> int:
        """Write the log, the state it leads to, the commit row, and name the log."""
        last = self.latest(name)
        self._publish(name, last)
        version = last + 1
        changes.append(rows, self._at(name, "log"), version, as_of)
        logged = self.spark.read.parquet(self._at(name, f"log/_commit_version={version}"))
        part = self._partition(name)
        if part is None:
            state = after(self.read(name), logged)
            state.write.mode("overwrite").parquet(self._at(name, f"snapshots/v={version}"))
        else:
            parts = self._parts_of(logged, part)
            self._write_partitions(name, version, after(self._of_partitions(name, parts), logged), parts, part)
        self._record(name, version, as_of, batch)
        self._publish(name, version)
        return version

    def _parts_of(self, rows: DataFrame, partition_by: str) -> DataFrame:
        """The partitions that rows fall into, staged."""
        return materialise(rows.select(_part(partition_by)).distinct(), "partitions")

    def _of_partitions(self, name: str, parts: DataFrame) -> DataFrame:
        """The table's rows in the listed partitions: a semi join on the partition column."""
        return self._live(name, self.latest(name)).join(parts, _PART, "left_semi").drop(_PART)
