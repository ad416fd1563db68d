"""SimHash near-duplicates, found by covering the fingerprints with code words as anchors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.llm.arrowtext import slices
from millpond.llm.blocks import dealt, whole_groups
from millpond.llm.components import components
from millpond.session import materialise

SHINGLE = 3
SEED = 42
THRESHOLD = 3
#: Fingerprints of one anchor that are compared within one task.
BLOCK = 4096
#: Up to this size, the members of all groups are compared together.
_SMALL = 24


def _shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, of all words if there are fewer."""
    runs = zip(*(words[i:] for i in range(width)), strict=False) if len(words) > width else [words]
    hashed = map(partial(xxhash.xxh64_intdigest, seed=SEED), map(b" ".join, runs))
    return np.fromiter(hashed, np.uint64)


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """64 bits: each is 1 if more than half of the shingles' hashes set it; 0 for a text without words."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and exactly the six white space bytes
    if not words:
        return 0
    hashes = _shingle_hashes(words, width)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    major = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(major, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) per row; the fingerprint as a signed long. Null texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, text_col):
            prints = np.array([fingerprint(t, width) for t in texts.to_pylist()], np.uint64)
            yield pa.record_batch([rows.column(id_col), pa.array(prints.view(np.int64))], ["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fingerprint long")
    return out.withColumnRenamed("id", id_col)


# The anchors are the words of the perfect Hamming code of length 31, on each half of a fingerprint, with
# the half's last bit free. Every half lies within 1 bit (the covering radius) of exactly one anchor.


def _syndrome(halves: np.ndarray) -> np.ndarray:
    """0 for a word of the code; else 1 + the position of the bit to flip."""
    out = np.zeros(len(halves), np.uint64)
    for i in range(31):
        out ^= np.where(halves >> np.uint64(i) & np.uint64(1), np.uint64(i + 1), np.uint64(0))
    return out


def anchors(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor): every anchor within 2 bits (covering radius plus 1) of each 32-bit half."""
    one, free = np.uint64(1), np.uint64(1) << np.uint64(31)
    syndrome = _syndrome(halves)
    near = np.where(syndrome > 0, one << (np.maximum(syndrome, one) - one), np.uint64(0))
    rows = np.arange(len(halves))
    parts = [(rows, halves ^ near), (rows, halves ^ near ^ free)]
    for i in range(1, 32):  # two flips i < j whose positions add up to the syndrome
        j = syndrome ^ np.uint64(i)
        at = np.flatnonzero((syndrome > 0) & (j > i))
        parts.append((at, halves[at] ^ (one << np.uint64(i - 1)) ^ (one << (j[at] - one))))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 10_000):
            rows = batch.slice(k, 10_000)
            prints = rows.column("fingerprint").to_numpy().view(np.uint64)
            reps = rows.column("rep").to_numpy()
            for half in (0, 1):
                row, anchor = anchors(prints >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF))
                key = anchor.view(np.int64) | np.int64(half << 32)
                columns = [pa.array(key), pa.array(prints.view(np.int64)[row]), pa.array(reps[row])]
                yield pa.record_batch(columns, ["anchor", "fingerprint", "rep"])


def _linked(prints: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all members of each group which lie within the threshold, without listing all pairs."""
    sizes = np.diff(starts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    a, b = [], []
    small = np.flatnonzero((sizes[group] <= _SMALL) & (sizes[group] > 1))
    for shift in range(1, _SMALL):
        left, right = small[:-shift], small[shift:]
        same = group[left] == group[right]
        if not same.any():
            break
        left, right = left[same], right[same]
        close = np.bitwise_count(prints[left] ^ prints[right]) <= THRESHOLD
        a.append(left[close])
        b.append(right[close])
    for g in np.flatnonzero(sizes > _SMALL):
        rest = np.arange(starts[g], starts[g + 1])
        while len(rest) > 1:  # what is linked, step by step, to the first member left
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                x = queue.pop()
                close = np.bitwise_count(prints[rest] ^ prints[x]) <= THRESHOLD
                found = rest[close]
                if len(found):
                    a.append(np.full(len(found), x))
                    b.append(found)
                    queue.extend(found)
                    rest = rest[~close]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(a or none), np.concatenate(b or none)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def work(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        prints = table.column("fingerprint").to_numpy().view(np.uint64)
        reps = table.column("rep").to_numpy()
        a, b = _linked(prints, starts)
        pairs = np.unique(np.stack((np.minimum(reps[a], reps[b]), np.maximum(reps[a], reps[b])), 1), axis=0)
        return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return whole_groups(batches, ["anchor", "p", "q"], work)


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between ids that connect all fingerprints which differ in at most three bits.

    Three differing bits leave at most one in some half. The half's nearest
    anchor then lies within two bits of the other's half, so both fingerprints
    are among that anchor's replicas. Each fingerprint stands once, under the
    smallest of its ids. The links of an anchor connect its members without
    listing every pair of them. Ids are long; rows without one link nothing.
    """
    reps = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")).filter("rep IS NOT NULL")
    replicas = materialise(reps, "prints").mapInArrow(_replicas, "anchor long, fingerprint long, rep long")
    pairs = dealt(replicas, "anchor", "fingerprint", block).select("anchor", "p", "q", "fingerprint", "rep")
    ready = pairs.repartition("anchor", "p", "q").sortWithinPartitions("anchor", "p", "q")
    return ready.mapInArrow(_compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable over fingerprints that differ
    in at most three bits. Null and empty texts have fingerprint 0 and link like
    any other. A row without doc_id keeps its fingerprint and gets the component
    of the rows that share it, null if there are none. Repeated rows stay; an
    empty table gives none; other columns are not read.
    """
    prints = materialise(fingerprints(docs, width), "fingerprints")
    groups = components(links(prints, block))
    reps = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("rep"))
    reps = reps.join(groups, reps["rep"] == groups["id"], "left")
    reps = reps.select("fingerprint", F.coalesce("component_id", "rep").alias("component_id"))
    reps = materialise(reps, "groups")  # so that a crowded fingerprint's side of the join can be split
    return prints.join(reps, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group; rows without doc_id stay.

    Of several rows with that doc_id, equal ones count once and different texts all stay: an id that
    stands for several texts says nothing about which of them are copies.
    """
    found = near_duplicates(docs).filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(found, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))
