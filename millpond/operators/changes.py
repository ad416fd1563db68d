"""Change rows: derive them, log them, read them back, apply them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

META = ("_change_type", "_commit_version", "_commit_timestamp")
OPENING = ("insert", "update_postimage")
CLOSING = ("update_preimage", "delete")


def _most(df: DataFrame, keys: Sequence[str]) -> Column:
    """Rows of the most frequent key, as a scalar: keys alone, counted in a hash aggregate."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(F.max("n")).scalar()


def _packed(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.select([F.col(k).alias(f"{name}_{k}") for k in keys] + [F.struct("*").alias(name)])


def diff(before: DataFrame, after: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """insert / delete / update_preimage / update_postimage rows between two states.

    Both sides are hashed on the key once. A repeated key raises: keys are counted apart, without
    the rest of their rows, so no row is sorted for the check. ``unique=True`` skips it for states
    that hold one row per key already, such as versions of a merged table. Null keys equal each
    other. Unchanged rows give nothing.
    """
    names = before.columns
    old = _packed(before, keys, "old")
    new = _packed(after.select(*names), keys, "new")
    match = reduce(Column.__and__, [old[f"old_{k}"].eqNullSafe(new[f"new_{k}"]) for k in keys])
    both = old.join(new, match, "full_outer")
    is_new, is_gone = F.col("old").isNull(), F.col("new").isNull()
    same = reduce(Column.__and__, [F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")) for c in names])

    def event(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(row).alias("r"))

    events = (
        F.when(is_new, F.array(event("insert", "new")))
        .when(is_gone, F.array(event("delete", "old")))
        .when(~same, F.array(event("update_preimage", "old"), event("update_postimage", "new")))
    )
    if not unique:
        clash = F.raise_error(F.lit("diff: a state repeats a key"))
        events = F.when((_most(before, keys) > 1) | (_most(after, keys) > 1), clash).otherwise(events)
    return both.select(F.explode(events).alias("e")).select("e.r.*", "e._change_type")


def append(rows: DataFrame, path: str, version: int, committed_at: str) -> None:
    """Write one commit's change rows into its own ``_commit_version`` partition.

    Running the same commit again replaces that partition and no other.
    """
    stamped = rows.withColumn("_commit_timestamp", F.lit(committed_at).cast("timestamp"))
    stamped.write.mode("overwrite").parquet(f"{path}/_commit_version={version}")


def _folders(spark: SparkSession, path: str, start: int, end: int | None) -> list[str]:
    """The commit folders of a version range that exist.

    With an end each version is asked for by name; without one the log's folder is listed once,
    names only. What lies in the folders of other versions is never looked at.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if end is not None:
        names = (f"{path}/_commit_version={v}" for v in range(start, end + 1))
        return [n for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(n))]
    names = (s.getPath().getName() for s in fs.listStatus(root))
    found = (int(n.split("=")[1]) for n in names if n.startswith("_commit_version="))
    return [f"{path}/_commit_version={v}" for v in sorted(found) if v >= start]


def read(
    spark: SparkSession, path: str, start: int, end: int | None = None, schema: StructType | None = None
) -> DataFrame:
    """Change rows of versions start … end, both included; no other version's folder is opened or listed.

    Without a ``schema`` (that of a commit's rows, type and timestamp included) the newest folder of
    the range gives it, or that of the whole log where the range holds no commit.
    """
    folders = _folders(spark, path, start, end)
    if schema is None:
        schema = spark.read.parquet(folders[-1] if folders else path).schema
    fields = [f for f in schema if f.name != "_commit_version"]
    schema = StructType([*fields, StructField("_commit_version", LongType())])
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def apply(state: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after the change rows, which may span several versions.

    A pre-image or delete removes the row of its key; an insert or post-image
    adds one unless a later version removes it again. The removals are reduced
    to one row per key before they are joined.
    """
    if "_commit_version" not in rows.columns:
        rows = rows.withColumn("_commit_version", F.lit(0))
    names = state.columns
    removed = rows.filter(F.col("_change_type").isin(*CLOSING)).groupBy(*keys).agg(
        F.max("_commit_version").alias("_last")
    )
    match = reduce(Column.__and__, [F.col(f"x.`{k}`").eqNullSafe(F.col(f"y.`{k}`")) for k in keys])
    untouched = state.alias("x").join(removed.alias("y"), match, "left_anti")
    added = rows.filter(F.col("_change_type").isin(*OPENING)).alias("x")
    added = added.join(removed.alias("y"), match & (F.col("y._last") > F.col("x._commit_version")), "left_anti")
    return untouched.unionByName(added.select(*names))


def history(log: DataFrame) -> DataFrame:
    """One row per commit with the number of change rows of each kind."""
    kinds = ["insert", "update_preimage", "update_postimage", "delete"]
    counts = log.groupBy("_commit_version").pivot("_change_type", kinds).count()
    return counts.fillna(0, kinds)
