"""Connected components of a link table, by repeated contraction in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.session import materialise


def _ordered(links: DataFrame) -> DataFrame:
    """One row per link between different ids, the smaller id first."""
    a, b = F.least("a", "b"), F.greatest("a", "b")
    return links.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) for every id in ``links`` (a, b); component_id is the smallest id reachable.

    Each round gives every id the neighbour (or itself) of least random score,
    renames both ends of all links by it and drops links that closed up. Scores
    are drawn anew each round, so long chains shrink as fast as stars do: the
    number of rounds grows with the logarithm of the ids. Each round is written
    to the shared folder; only the number of links left reaches the driver.
    Null ids link nothing. No links give no rows.
    """
    live = materialise(_ordered(links), "links")
    names = live.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("root", F.col("id"))
    turn = 0
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        own, other = F.xxhash64("a", F.lit(turn)), F.xxhash64("b", F.lit(turn))
        best = both.groupBy("a").agg(F.min(other).alias("score"), F.min_by("b", other).alias("b"))
        step = materialise(
            best.select(F.col("a").alias("old"), F.when(F.col("score") < own, F.col("b")).otherwise(F.col("a")).alias("new")),
            "step",
        )
        renamed = live.join(step, live["a"] == step["old"]).select(F.col("new").alias("a"), "b")
        renamed = renamed.join(step, renamed["b"] == step["old"]).select("a", F.col("new").alias("b"))
        live = materialise(_ordered(renamed), "links")
        names = names.join(step, names["root"] == step["old"], "left").select(
            "id", F.coalesce("new", "root").alias("root")
        )
        names = materialise(names, "names")
        turn += 1
    least = names.groupBy("root").agg(F.min("id").alias("component_id"))
    return names.join(least, "root").select("id", "component_id")
