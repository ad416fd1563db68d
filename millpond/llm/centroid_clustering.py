"""Centroid clustering: exact integer k-means whose assignments search a vantage-point tree over the centroids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.session import materialise

CLUSTERS = 8
ROUNDS = 10
WIDTH = 64
#: Steps per unit of a component.
SCALE = 1024
#: Components beyond this have squared distances that no long holds at WIDTH components.
LARGEST = 1 << 27
#: Centroids that a leaf of the tree holds.
LEAF = 4
#: Room for the rounding of square roots, so that pruning never loses a tie.
SLACK = 1e-12
_FAR = np.iinfo(np.int64).max


@dataclass
class Tree:
    """A vantage-point tree: per node its centroids, children and the distances its vantage point has to each child's centroids."""

    centroids: np.ndarray
    members: list[np.ndarray]
    children: list[tuple[int, int] | None]
    reach: list[tuple[tuple[float, float], tuple[float, float]] | None]


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points to integer centres.

    Products run in floating point only while every partial sum is an integer below 2**53.
    """
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(centres).max(initial=0)))
    if 4 * points.shape[1] * most**2 < 1 << 53:
        p, c = points.astype(np.float64), centres.astype(np.float64)
        return ((p * p).sum(1)[:, None] - 2.0 * (p @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((points - c) ** 2).sum(1) for c in centres], axis=1)


def build(centroids: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree over the rows of ``centroids``; a vantage point is the one farthest from the first of its set."""
    tree = Tree(centroids, [], [], [])

    def grow(ids: np.ndarray) -> int:
        at = len(tree.members)
        tree.members.append(ids)
        tree.children.append(None)
        tree.reach.append(None)
        if len(ids) <= leaf:
            return at
        vantage = ids[squared(centroids[ids], centroids[ids[:1]])[:, 0].argmax()]
        rest = ids[ids != vantage]
        away = np.sqrt(squared(centroids[rest], centroids[[vantage]])[:, 0].astype(np.float64))
        order = np.lexsort((rest, away))
        near, far = order[: len(order) // 2], order[len(order) // 2 :]
        tree.members[at] = np.array([vantage])
        tree.reach[at] = tuple((away[part].min(), away[part].max()) for part in (near, far))
        tree.children[at] = (grow(np.sort(rest[near])), grow(np.sort(rest[far])))
        return at

    grow(np.arange(len(centroids)))
    return tree


def nearest(tree: Tree, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each point, the smaller one of equals, and the exact squared distance.

    Each point opens the node of least possible distance first and stops once that bound exceeds
    its best distance; a bound equal to it is still opened, since it may hide an equal of smaller
    number. The points that are about to open the same node do so together.
    """
    n = len(points)
    best, label = np.full(n, _FAR), np.full(n, len(tree.centroids))
    bound = np.full((n, len(tree.members)), np.inf)
    bound[:, 0] = 0.0
    active = np.arange(n)
    while len(active):
        node = bound[active].argmin(1)
        low = bound[active, node]
        open_ = low <= np.sqrt(best[active].astype(np.float64)) * (1 + SLACK)
        active, node = active[open_], node[open_]
        for t in np.unique(node):
            rows, ids = active[node == t], tree.members[t]
            away = squared(points[rows], tree.centroids[ids])
            first = away.argmin(1)
            found, number = away[np.arange(len(rows)), first], ids[first]
            better = (found < best[rows]) | ((found == best[rows]) & (number < label[rows]))
            best[rows[better]], label[rows[better]] = found[better], number[better]
            if tree.children[t] is not None:
                d = np.sqrt(away[:, 0].astype(np.float64))
                for child, (near, far) in zip(tree.children[t], tree.reach[t]):
                    gap = np.maximum(d - far, near - d) - SLACK * (d + far)
                    bound[rows, child] = np.maximum(bound[rows, t], gap)
            bound[rows, t] = np.inf
    return label, best


def kept_vectors(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): vectors of exactly ``width`` components as integers floor(scale * x); others are left out.

    Left out are null vectors, other widths, null or non-finite components, and components whose
    integer exceeds 2**27, as their distances fit no long.
    """
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * scale > LARGEST))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return vectors.filter((F.size("embedding") == width) & ~odd).select("vec_id", whole.alias("v"))


def _points(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("v")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _sums(kept: DataFrame, tree: Tree) -> dict[int, tuple[int, list[int]]]:
    """Per cluster the count and the exact component sums of the vectors nearest to it."""
    shared = kept.sparkSession.sparkContext.broadcast(tree)
    k, width = tree.centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            points = _points(batch)
            label, _ = nearest(shared.value, points)
            counts += np.bincount(label, minlength=k)
            for c in np.unique(label):
                sums[c] += points[label == c].sum(0)
        rows = [{"cluster": c, "at": i, "total": int(x)} for c in np.flatnonzero(counts) for i, x in enumerate([counts[c], *sums[c]])]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("cluster", pa.int32()), ("at", pa.int32()), ("total", pa.int64())]))

    parts = kept.select("v").mapInArrow(add, "cluster int, at int, total long")
    totals = parts.groupBy("cluster", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found: dict[int, dict[int, int]] = {}
    for row in totals.collect():  # clusters x components
        found.setdefault(row["cluster"], {})[row["at"]] = int(row["total"])
    shared.destroy()
    return {c: (t[0], [t[i + 1] for i in range(width)]) for c, t in found.items()}


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, cluster_size long"


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, prefix: str = "3:"
) -> DataFrame:
    """Rows of ``RESULT`` for every vector that ``kept_vectors`` keeps.

    Centroids start as the vectors of least sha256 of prefix + vec_id. Each round rebuilds the tree,
    broadcasts it (``clusters`` times ``width`` numbers, both arguments), assigns every vector and
    moves every centroid that has vectors to the exact floor of their mean; empty ones stay. What
    reaches the driver are sums per cluster and component. Fewer vectors than ``clusters`` give
    fewer centroids; repeated ids and copies count each; null ids are clustered but start a cluster
    only where ids lack; an empty table gives no rows. An inertia too large for a long is null.
    """
    spark = vectors.sparkSession
    kept = materialise(kept_vectors(vectors, width, scale), "whole-vectors")
    digest = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    starts = kept.orderBy(digest.asc_nulls_last(), "v").limit(clusters).select("v").collect()
    if not starts:
        return spark.createDataFrame([], RESULT)
    centroids = np.array([r["v"] for r in starts], np.int64)
    for _ in range(rounds):
        for c, (n, sums) in _sums(kept, build(centroids)).items():
            centroids[c] = [s // n for s in sums]
    tree = build(centroids)
    shared = spark.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                label, away = nearest(shared.value, _points(batch))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(label.astype(np.int32)), pa.array(away)], ["vec_id", "cluster", "distance"])

    placed = materialise(kept.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    found = placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"), F.count(F.lit(1)).alias("n")
    )
    per = {r["cluster"]: (int(r["inertia"]), r["n"]) for r in found.collect()}
    fits = lambda x: x if x <= _FAR else None
    text = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    rows = [(int(c), fits(i), fits(sum(x for x, _ in per.values())), text[c], n) for c, (i, n) in per.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, cluster_size long")
    # one row per cluster, so the broadcast is as large as the arguments say
    joined = placed.join(F.broadcast(facts), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "cluster_size")
