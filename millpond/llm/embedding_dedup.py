"""Near-duplicate embeddings: random projections decoded to points of the E8 lattice."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.llm.blocks import least_labels, whole_groups
from millpond.llm.components import components
from millpond.session import materialise

THRESHOLD = 0.98
#: Independent projections; a pair that one misses is found by another.
TABLES = 5
#: Neighbouring cells that are probed besides a vector's own.
PROBES = 7
#: Lattice steps between the projections of two unit vectors whose cosine is the threshold, in the mean.
REACH = 0.424
#: Vectors of one cell that are compared within one task.
BLOCK = 1024
SEED = 20_240


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: steps from a cell to its neighbours."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _even(points: np.ndarray) -> np.ndarray:
    """Nearest integer points of even sum (the lattice D8)."""
    near = np.rint(points)
    rest = points - near
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    worst = np.abs(rest[odd]).argmax(1)
    near[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode(points: np.ndarray) -> np.ndarray:
    """Nearest points of E8: the closer one of D8 and of D8 shifted by a half."""
    whole, half = _even(points), _even(points - 0.5) + 0.5
    closer = ((points - whole) ** 2).sum(1) <= ((points - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def scale(size: int, threshold: float = THRESHOLD) -> float:
    """Lattice steps per unit length, so that pairs at the threshold lie ``REACH`` apart at every number of components.

    A projection to 8 of ``size`` dimensions keeps sqrt(8 / size) of a distance, in the mean; below 8 it keeps all.
    """
    apart = np.sqrt(2 * max(1 - threshold, 1e-9)) * np.sqrt(min(1.0, 8 / size))
    return REACH / apart


def projections(size: int, tables: int = TABLES, threshold: float = THRESHOLD) -> list[np.ndarray]:
    """Orthonormal random projections to 8 dimensions (fewer inputs are padded by zeros), in lattice steps."""
    random = np.random.default_rng(SEED)
    steps = scale(size, threshold)
    return [np.linalg.qr(random.normal(size=(max(size, 8), 8)))[0][:size] * steps for _ in range(tables)]


def normed(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors of any finite magnitude: rows are brought near 1 by a power of two, which is exact, before they are squared."""
    near = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None])
    return near / np.sqrt((near**2).sum(1))[:, None]


def _keys(cells: np.ndarray, table: int) -> np.ndarray:
    """A cell's hash; cells are whole or half numbers."""
    out = np.full(cells.shape[:-1], table + 1, np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    doubled = np.rint(2 * cells).astype(np.int64).astype(np.uint64)
    for k in range(8):
        out = (out ^ doubled[..., k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def cells(vectors: np.ndarray, projection: np.ndarray, table: int, probes: int = PROBES) -> np.ndarray:
    """Hashes of each vector's own cell, then of the neighbouring cells whose border is nearest."""
    points = vectors @ projection
    home = decode(points)
    nearest = np.argsort(-((points - home) @ ROOTS.T), axis=1, kind="stable")[:, :probes]
    around = home[:, None, :] + ROOTS[nearest]
    return np.concatenate((_keys(home, table)[:, None], _keys(around, table)), 1)


def _units(column: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), "<f8")
    return flat.reshape(len(column), -1)


def _spread(tables: int, probes: int, threshold: float):
    """One row per vector, table and probed cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                rows = batch.slice(k, 512)
                vectors = rows.column("vector").to_pylist()
                sizes = np.array([len(v) for v in vectors])
                for size in np.unique(sizes):  # vectors of different lengths never meet
                    at = np.flatnonzero(sizes == size)
                    part = rows.take(pa.array(at))
                    unit = normed(_units(part.column("vector")))
                    for t, projection in enumerate(projections(unit.shape[1], tables, threshold)):
                        keys = cells(unit, projection, t, probes) ^ np.uint64(size)
                        row = np.repeat(np.arange(len(at)), keys.shape[1])
                        home = np.tile(np.arange(keys.shape[1]) == 0, len(at))
                        columns = [part.column(c).take(pa.array(row)) for c in ("label", "rep", "n", "vector")]
                        yield pa.record_batch(
                            [pa.array(keys.ravel().view(np.int64)), pa.array(np.full(len(row), t, np.int32)), pa.array(home), *columns],
                            ["cell", "tab", "home", "label", "rep", "n", "vector"],
                        )

    return run


def _compare(tables: int, probes: int, threshold: float):
    """Links within each group: how many vectors each one gains, and links that connect them."""

    def links(reps: np.ndarray, unit: np.ndarray, home: np.ndarray, member: np.ndarray, table: int, memo: list) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.flatnonzero(home), np.flatnonzero(member)
        a, b = np.nonzero(unit[left] @ unit[right].T >= threshold - 1e-9)
        a, b = left[a], right[b]
        lower = reps[a] < reps[b]  # one direction only: the smaller id's own cell
        a, b = a[lower], b[lower]
        if not len(a):
            return a, b
        exact = np.concatenate([(unit[a[k : k + 20_000]] * unit[b[k : k + 20_000]]).sum(1) for k in range(0, len(a), 20_000)])
        a, b = a[exact >= threshold], b[exact >= threshold]
        # a pair counts in the first table whose probes lead from b to a's own cell
        for t in range(table):
            if not len(a):
                break
            keys = cells(unit, memo[t], t, probes)
            new = ~(keys[b] == keys[a, :1]).any(1)
            a, b = a[new], b[new]
        return a, b

    def work(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        reps, sizes = table.column("rep").to_numpy(), table.column("n").to_numpy()
        home, member = table.column("home").to_numpy(), table.column("member").to_numpy()
        tab = table.column("tab").to_numpy()
        vectors = table.column("vector").combine_chunks()
        kinds, xs, ys = [], [], []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if e - s < 2 or not home[s:e].any():
                continue
            unit = normed(_units(vectors.slice(s, e - s)))
            known = projections(unit.shape[1], int(tab[s]), threshold)
            a, b = links(reps[s:e], unit, home[s:e], member[s:e], int(tab[s]), known)
            if not len(a):
                continue
            gain = np.bincount(a, sizes[s:e][b], e - s) + np.bincount(b, sizes[s:e][a], e - s)
            who = np.flatnonzero(gain)
            label = least_labels(a, b, e - s)
            moved = np.flatnonzero(label != np.arange(e - s))
            kinds += [np.zeros(len(who), np.int32), np.ones(len(moved), np.int32)]
            xs += [reps[s:e][who], reps[s:e][moved]]
            ys += [gain[who].astype(np.int64), reps[s:e][label[moved]]]
        if not kinds:
            return None
        return pa.record_batch([pa.array(np.concatenate(x)) for x in (kinds, xs, ys)], ["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return whole_groups(batches, ["label", "tab", "cell", "p", "q"], work, 4096)

    return run


def _packed(vectors: DataFrame) -> DataFrame:
    """(id, label, vector): vectors as packed doubles, which can be grouped and joined by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.asarray(v, "<f8").tobytes() for v in batch.column("vector").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("vector"), "vector", pa.array(packed, pa.binary()))

    return vectors.mapInArrow(run, "id long, label long, vector binary")


def near_duplicates(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``embeddings`` (vec_id, embedding, label).

    Two vectors link if their labels are equal and not null and their cosine, in
    double precision, reaches ``threshold``. Candidates share a lattice cell: one
    of the two lies in it, the other lies in it or probes it. Equal vectors are
    one candidate, and count as links of one another. Within a cell all candidates
    are compared, in blocks; what leaves the task are counts per vector and links
    that connect the vectors, not all pairs. Vectors that are null, empty, zero or
    hold null or non-finite values, and rows without vec_id, link with nothing;
    their component is themselves. Repeated rows link with each other.
    """
    rows = embeddings.select(
        "vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector")
    )
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.coalesce(finite & F.exists("vector", lambda x: x != 0) & F.col("label").isNotNull(), F.lit(False))
    rows = rows.withColumn("good", good & F.col("vec_id").isNotNull())
    usable = rows.filter("good").select(F.col("vec_id").cast("long").alias("id"), "label", "vector")
    keyed = _packed(usable)
    # equal vectors of one label once, under the smallest id
    groups = keyed.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    groups = materialise(groups, "vectors")
    schema = "cell long, tab int, home boolean, label long, rep long, n long, vector binary"
    spread = groups.mapInArrow(_spread(tables, probes, threshold), schema)
    # large cells are dealt into blocks: a home row meets every block's members, a member every block's home rows
    sizes = groups.mapInArrow(_spread(tables, probes, threshold), schema).groupBy("label", "cell").agg(F.count(F.lit(1)).alias("m"))
    large = materialise(
        sizes.filter(F.col("m") > block).select("label", "cell", F.ceil(F.col("m") / block).cast("int").alias("parts")), "large"
    )
    dealt = spread.join(large, ["label", "cell"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    as_home = F.transform(
        F.filter(other, lambda j: F.col("home")),
        lambda j: F.struct(F.col("own").alias("p"), j.alias("q"), F.lit(True).alias("home"), (j == F.col("own")).alias("member")),
    )
    as_member = F.transform(
        F.filter(other, lambda j: ~F.col("home") | (j != F.col("own"))),
        lambda j: F.struct(j.alias("p"), F.col("own").alias("q"), F.lit(False).alias("home"), F.lit(True).alias("member")),
    )
    dealt = dealt.withColumn("role", F.explode(F.concat(as_home, as_member)))
    ready = dealt.select("label", "cell", "tab", "rep", "n", "vector", "role.*")
    keys = ["label", "tab", "cell", "p", "q"]
    ready = ready.repartition(*keys).sortWithinPartitions(*keys)
    found = materialise(ready.mapInArrow(_compare(tables, probes, threshold), "kind int, a long, b long"), "links")
    gains = found.filter("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("gain"))
    comps = components(found.filter("kind = 1").select("a", "b"))
    # every row finds its group under the label and vector they share
    own = materialise(
        groups.join(gains, "rep", "left").join(comps, groups["rep"] == comps["id"], "left").select(
            "label", "vector", (F.col("n") - 1 + F.coalesce("gain", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        ),
        "groups",
    )

    linked = keyed.join(own, ["label", "vector"]).select(F.col("id").alias("vec_id"), "n_links", "component_id")
    alone = rows.filter("NOT good").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id")
    )
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
