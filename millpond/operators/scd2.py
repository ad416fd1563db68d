"""Full-history (SCD type 2) tables kept from change rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.operators.changes import CLOSING, OPENING
from millpond.operators.merge import merge, update

OPEN_UNTIL = "9999-12-31"
COLUMNS = ("active_ind", "expiry_timestmp", "proc_dt")


def apply(
    gold: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    as_of: str,
    with_stat: bool = False,
) -> DataFrame:
    """Gold history after a feed of change rows that may span several versions.

    A pre-image or delete expires the active row of its key. Every insert or
    post-image opens a row, which is already expired when a later version of
    the same feed closes it. The last closing version per key is a plain
    aggregate, so a key that changed very often needs no window of its own.

    ``with_stat`` also keeps a ``stat`` column: ``update_preimage`` while active,
    ``inactive`` after an update, the date after a delete.
    """
    if "_commit_version" not in rows.columns:
        rows = rows.withColumn("_commit_version", F.lit(0))
    names = [c for c in gold.columns if c not in (*COLUMNS, "stat")]
    closed = (
        rows.filter(F.col("_change_type").isin(*CLOSING))
        .groupBy(*keys)
        .agg(
            F.max("_commit_version").alias("_last_close"),
            F.max_by("_change_type", "_commit_version").alias("_last_type"),
        )
    )
    ended = {"active_ind": "'N'", "expiry_timestmp": f"DATE '{as_of}'", "proc_dt": f"DATE '{as_of}'"}
    if with_stat:
        ended["stat"] = f"CASE WHEN s._last_type = 'delete' THEN '{as_of}' ELSE 'inactive' END"
    expired = merge(gold, closed, keys, matched=[update(ended)], match_target="t.active_ind = 'Y'")

    opened = rows.filter(F.col("_change_type").isin(*OPENING)).select(*names, "_commit_version").distinct()
    opened = opened.join(closed, list(keys), "left")
    gone = F.coalesce(F.col("_last_close") > F.col("_commit_version"), F.lit(False))
    today = F.lit(as_of).cast("date")
    added = opened.select(
        *names,
        F.when(gone, F.lit("N")).otherwise(F.lit("Y")).alias("active_ind"),
        F.when(gone, today).otherwise(F.lit(OPEN_UNTIL).cast("date")).alias("expiry_timestmp"),
        today.alias("proc_dt"),
        *(
            [
                F.when(~gone, F.lit("update_preimage"))
                .when(F.col("_last_type") == "delete", F.lit(as_of))
                .otherwise(F.lit("inactive"))
                .alias("stat")
            ]
            if with_stat
            else []
        ),
    )
    return expired.unionByName(added.select(*gold.columns))


def first_load(rows: DataFrame, keys: Sequence[str], as_of: str, with_stat: bool = False) -> DataFrame:
    """History built from the change feed alone, starting from an empty table."""
    names = [c for c in rows.columns if not c.startswith("_c")]
    extra = "active_ind STRING, expiry_timestmp DATE, proc_dt DATE" + (", stat STRING" if with_stat else "")
    schema = rows.select(*names).schema
    for field in extra.split(", "):
        name, kind = field.split(" ")
        schema = schema.add(name, kind.lower())
    empty = rows.sparkSession.createDataFrame([], schema)
    return apply(empty, rows, keys, as_of, with_stat)


def active(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col("active_ind") == "Y")
