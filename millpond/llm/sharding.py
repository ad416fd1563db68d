"""Sharding by balanced label propagation: copies and linked texts move into common shards, sizes stay even."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from millpond.operators import keys
from millpond.session import materialise

SHARDS = 40
#: Rounds after which propagation stops though documents would still move.
ROUNDS = 30
#: Groups of wishes that a shard's free places are dealt out by.
BUCKETS = 512
#: What a row of the same text weighs in a vote against one linked row of weight 1.
SAME = 1000.0


def quotas(rows: int, shards: int = SHARDS) -> list[int]:
    """Rows each shard has to hold: at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _lookup(values: Sequence[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), (index + 1).cast("int")).cast("long")


def _loads(cells: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _votes(cells: DataFrame, links: DataFrame | None) -> DataFrame:
    """(unit, shard, vote, n, total, whole): what speaks for a unit being in a shard, the rows it has there and in all.

    The shards of a unit in several of them are ranked by its own rows first; a unit that is in one
    shard (whole) is drawn by linked units alone. Units that nothing draws are left out.
    """
    own = cells.select("unit", "shard", F.lit(0.0).alias("heard"), "n")
    if links is not None:
        both = links.select("a", "b", "weight").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight"))
        near = both.filter("a <> b").join(cells, F.col("b") == F.col("unit"))
        heard = near.select(F.col("a").alias("unit"), "shard", (F.col("n") * F.col("weight")).alias("heard"), F.lit(0).cast("long").alias("n"))
        own = own.unionByName(heard)
    votes = own.groupBy("unit", "shard").agg(F.sum("heard").alias("heard"), F.sum("n").alias("n"))
    units = votes.groupBy("unit").agg(F.sum("n").alias("total"), (F.count_if(F.col("n") > 0) == 1).alias("whole"), F.max("heard").alias("most"))
    votes = votes.join(units.filter("NOT whole OR most > 0"), "unit")
    vote = F.col("heard") + F.when(F.col("whole"), 0).otherwise(F.col("n") * SAME)
    return votes.select("unit", "shard", vote.alias("vote"), "n", "total", "whole")


def _wishes(votes: DataFrame, free: Sequence[int], turn: int) -> DataFrame:
    """(unit, shard, target, n, whole, bucket): the rows that would rather be in a shard of more votes with places left.

    Equal votes are decided by a hash that stays the same over the rounds, so that the rows of a
    unit never swap their shards for ever; of the units that linked units draw, only half may
    move in a round, for the same reason. A unit with more rows than its best shard has places
    deals them over as many of its next best shards as it needs. Lists hold at most one entry per shard.
    """
    tie = F.xxhash64("unit", "shard", F.lit("tie"))
    rank = F.struct("vote", tie.alias("tie"), "shard", _lookup(free, F.col("shard")).alias("free"))
    ranked = votes.withColumn("rank", rank)
    open_ = ranked.filter(F.col("rank.free") > 0).groupBy("unit").agg(
        F.sort_array(F.collect_list("rank"), asc=False).alias("best"), F.first("total").alias("total")
    )
    places = lambda i: F.aggregate(F.slice("best", 1, i), F.lit(0).cast("long"), lambda acc, r: acc + r["free"])
    needed = F.size(F.filter("best", lambda r, i: (i == 0) | (places(i) < F.col("total"))))
    best = open_.select("unit", F.slice("best", F.lit(1), needed).alias("best"))
    pick = F.element_at("best", (F.pmod(F.xxhash64("unit", "shard", F.lit(turn)), F.size("best")) + 1).cast("int"))
    moving = ranked.filter("n > 0").join(best, "unit").withColumn("to", pick)
    better = F.struct("to.vote", "to.tie") > F.struct("rank.vote", "rank.tie")
    drawn = (F.col("to.vote") > F.col("vote")) & (F.pmod(F.xxhash64("unit", F.lit(turn), F.lit("half")), F.lit(2)) == 0)
    bucket = F.pmod(F.xxhash64("unit", F.lit(turn)), F.lit(BUCKETS)).cast("int")
    wanted = F.when(F.col("whole"), drawn).otherwise(better) & (F.col("to.shard") != F.col("shard"))
    return moving.filter(wanted).select("unit", "shard", F.col("to.shard").alias("target"), "n", "whole", bucket.alias("bucket"))


def _granted(wishes: DataFrame, free: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """(target, bucket, places, wished): what of each bucket's wishes fits into its target shard."""
    sums = wishes.groupBy("target", "bucket").agg(F.sum("n").alias("n")).collect()  # shards x buckets at most
    out, left = [], list(free)
    for target, bucket, n in sorted((r["target"], r["bucket"], r["n"]) for r in sums):
        places = min(n, left[target])
        if places > 0:
            left[target] -= places
            out.append((target, bucket, places, n))
    return out


def propagate(
    cells: DataFrame, quota: Sequence[int], links: DataFrame | None = None, rounds: int = ROUNDS
) -> DataFrame:
    """``cells`` (unit, shard, n) after rounds of label propagation under the shards' quotas.

    A unit is a set of rows that belong together, a cell its rows in one shard. Every round joins
    the cells with the votes of their own unit and, through ``links`` (a, b, weight), of linked
    units, and moves rows to better shards while these have places; a bucket of wishes that fits
    only in part moves that part of each cell, but breaks up no unit that is in one shard. No shard
    gets more than its quota unless it began with more. Each round is written to the shared folder;
    the driver gets sums per shard and bucket. It ends when nothing moves (with links: in three
    rounds, as half of the linked units rest in each), or after ``rounds``.
    """
    spark, shards, idle = cells.sparkSession, len(quota), 0
    for turn in range(rounds):
        free = [q - n for q, n in zip(quota, _loads(cells, shards))]
        wishes = materialise(_wishes(_votes(cells, links), free, turn), "wishes")
        granted = _granted(wishes, free)
        if not granted:
            idle += 1
            if links is None or idle == 3:
                break
            continue
        # shards x buckets rows at most
        table = F.broadcast(spark.createDataFrame(granted, "target int, bucket int, places long, wished long"))
        part = F.when(F.col("whole"), 0).otherwise(F.least("n", F.floor(F.col("n") * (F.col("places") / F.col("wished")))))
        fits = F.when(F.col("places") == F.col("wished"), F.col("n")).otherwise(part).cast("long")
        moved = wishes.join(table, ["target", "bucket"]).withColumn("m", fits).filter("m > 0")
        change = moved.select("unit", F.explode(F.array(
            F.struct(F.col("target").alias("shard"), F.col("m").alias("n")), F.struct("shard", (-F.col("m")).alias("n"))
        )).alias("c")).select("unit", "c.shard", "c.n")
        new = cells.unionByName(change).groupBy("unit", "shard").agg(F.sum("n").alias("n")).filter("n > 0")
        if moved.isEmpty():
            idle += 1
            if links is None or idle == 3:
                break
            continue
        cells, idle = materialise(new, "cells"), 0
    return cells


def _within(cells: DataFrame, quota: Sequence[int]) -> DataFrame:
    """``cells`` without what exceeds a shard's quota, taken off by whole buckets of units as far as possible."""
    if all(n <= q for q, n in zip(quota, _loads(cells, len(quota)))):
        return cells
    bucket = F.pmod(F.xxhash64("unit", F.lit("excess")), F.lit(BUCKETS)).cast("int")
    asked = cells.select("unit", F.col("shard").alias("target"), "n", bucket.alias("bucket"))
    table = F.broadcast(cells.sparkSession.createDataFrame(_granted(asked, quota), "target int, bucket int, places long, wished long"))
    part = F.floor(F.col("n") * (F.col("places") / F.col("wished"))).cast("long")
    kept = asked.join(table, ["target", "bucket"]).withColumn("n", F.when(F.col("places") == F.col("wished"), F.col("n")).otherwise(F.least("n", part)))
    return materialise(kept.filter("n > 0").select("unit", F.col("target").alias("shard"), "n"), "cells")


def _passed(rank: Column, bounds: Sequence[int]) -> Column:
    """How many of the running totals a rank has passed."""
    return F.size(F.filter(F.array(*[F.lit(int(b)).cast("long") for b in bounds]), lambda b: b <= rank)).cast("int")


def place(
    rows: DataFrame, unit: str, order_by: Sequence[str], shards: int = SHARDS, links: DataFrame | None = None, rounds: int = ROUNDS
) -> DataFrame:
    """``rows`` with columns shard and slot (gapless from 0 in each shard); shards differ by one row at most.

    Rows of one ``unit`` value belong together; a null unit links with nothing. ``links`` (a, b,
    weight) may connect units. Linked rows start in shards by hash and move by ``propagate``; rows
    that link with nothing fill the places left. Rows of a unit in several shards are dealt by
    their order. Nothing is gathered per unit: ranks come from range-partitioned runs, so a unit
    may hold any share of the rows. Columns of ``rows`` named shard or slot are replaced; rows that
    are equal in all columns get each a slot of their own; an empty table gives no rows.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    r, o = F.struct(*names).alias("r"), F.struct(*order_by).alias("o")
    rows = materialise(rows.select(r, F.col(unit).alias("unit"), o), "rows")
    quota = quotas(rows.count(), shards)
    known = rows.filter("unit IS NOT NULL")
    hashed = F.pmod(F.xxhash64("o", F.lit("start")), F.lit(shards)).cast("int")
    cells = materialise(known.groupBy("unit", hashed.alias("shard")).agg(F.count(F.lit(1)).alias("n")), "cells")
    totals = cells.groupBy("unit").agg(F.sum("n").alias("total"))
    if links is None:
        totals = totals.filter("total > 1")
    else:
        ends = links.select(F.explode(F.array("a", "b")).alias("unit")).filter("unit IS NOT NULL").distinct()
        totals = totals.join(ends.withColumn("end", F.lit(True)), "unit", "left").filter("total > 1 OR end").drop("end")
    totals = materialise(totals, "totals")
    cells = materialise(cells.join(totals, "unit", "left_semi"), "cells")
    cells = _within(propagate(cells, quota, links, rounds), quota)
    left = [q - n for q, n in zip(quota, _loads(cells, shards))]
    # per unit one entry for each of its shards
    listed = cells.groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("cells"), F.sum("n").alias("held"))
    only = F.when((F.size("cells") == 1) & (F.col("held") == F.col("total")), F.element_at("cells", 1)["shard"])
    plan = materialise(listed.join(totals, "unit").withColumn("only", only).drop("total"), "plan")
    found = materialise(known.join(plan.select("unit", "only", F.lit(True).alias("planned")), "unit", "left"), "found")
    sure = found.filter("only IS NOT NULL").select("r", "o", F.col("only").alias("shard"))
    split = keys.assign(found.filter("planned AND only IS NULL").select("r", "o", "unit"), None, "pos", ["unit", "o"])
    split = materialise(split, "split")
    starts = split.groupBy("unit").agg(F.min("pos").alias("start"))
    spread = materialise(plan.filter("only IS NULL").join(starts, "unit").select("unit", "start", "cells"), "spread")
    rank = F.col("pos") - F.col("start")
    before = lambda i: F.aggregate(F.slice("cells", 1, i + 1), F.lit(0).cast("long"), lambda acc, c: acc + c["n"])
    at = F.size(F.filter("cells", lambda c, i: before(i) <= rank))
    dealt = materialise(split.join(spread, "unit").select("r", "o", F.get("cells", at)["shard"].alias("shard")), "dealt")
    free = rows.filter("unit IS NULL").select("r", "o").unionByName(found.filter("planned IS NULL").select("r", "o"))
    free = free.unionByName(dealt.filter("shard IS NULL").select("r", "o"))
    free = keys.assign(free, None, "pos", ["o"])
    bounds = [sum(left[: s + 1]) for s in range(shards)]
    filled = free.select("r", "o", _passed(F.col("pos") - 1, bounds).alias("shard"))
    everywhere = sure.unionByName(dealt.filter("shard IS NOT NULL")).unionByName(filled)
    numbered = keys.assign(everywhere, None, "pos", ["shard", "o"])
    first = [sum(quota[:s]) for s in range(shards)]
    return numbered.select("r.*", "shard", (F.col("pos") - 1 - _lookup(first, F.col("shard"))).alias("slot"))


def cut_links(placed: DataFrame, unit: str) -> DataFrame:
    """(links, cut): pairs of rows of one unit, and those of them in different shards."""
    cells = placed.filter(F.col(unit).isNotNull()).groupBy(unit, "shard").agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("n"))
    units = cells.groupBy(unit).agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("near"))
    pairs = units.select(((F.col("all") * F.col("all") - F.col("all")) / 2).alias("links"), ((F.col("all") * F.col("all") - F.col("near")) / 2).alias("cut"))
    return pairs.agg(F.sum("links").cast("long").alias("links"), F.sum("cut").cast("long").alias("cut"))


def shard_documents(documents: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, unit) for every document, by the law ``rows``.

    size: UTF-8 bytes of the text plus 16, text_crc32: of those bytes; a null text has no bytes.
    Documents of equal text belong together; a null text equals none. unit: SHA-256 of the text.
    """
    text = F.col("text")
    kept = documents.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.unhex(F.sha2(text, 256)).alias("unit"),
    )
    return place(kept, "unit", ["doc_id", "text_crc32", "size"], shards, rounds=rounds)
