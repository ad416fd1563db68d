"""Benchmark decontamination: greedy string tiling of documents with benchmark items."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.llm import arrowtext
from millpond.llm.arrowtext import slices
from millpond.session import materialise

#: Words of a seed, and of the shortest tile.
MIN_MATCH = 5
#: Share of an item's words that tiles must cover.
COVERAGE = 0.6
#: Size of the bit set that sorts out seeds of no item before they are shuffled: 2 MB, whatever the benchmark's size.
FILTER_BITS = 24
_STEP = np.uint64(0x9FB21C651E98DF25)
_PRIME = (1 << 61) - 1

#: Bytes that are part of a word: ASCII letters and digits, and all of every other character.
_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def _seed_hashes(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Row, word number in its row, first and last byte, and hash of every run of ``width`` words."""
    starts, ends, rows = arrowtext.words(data, at, _WORD)
    n = len(starts) - width + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    hashes = arrowtext.range_hashes(arrowtext.prefix_hashes(data), starts, ends)
    seeds = np.zeros(n, np.uint64)
    for k in range(width):
        seeds *= _STEP
        seeds += hashes[k : k + n]
    seeds = arrowtext.mixed(seeds)
    first = np.searchsorted(rows, np.arange(len(at) - 1), "left")
    keep = np.flatnonzero(rows[:n] == rows[width - 1 :])
    return rows[keep], keep - first[rows[keep]], starts[keep], ends[keep + width - 1], seeds[keep]


def _words(data: bytes) -> str:
    """The words of some bytes, with one blank between them."""
    array = np.frombuffer(data, np.uint8)
    starts, ends, _ = arrowtext.words(array, np.array([0, len(array)]), _WORD)
    return " ".join(data[s:e].decode("utf-8", "replace") for s, e in zip(starts, ends, strict=True))


def seeds(texts: DataFrame, id_col: str, text_col: str, width: int, allowed: np.ndarray | None = None) -> DataFrame:
    """(id, position, seed, slot): every run of ``width`` words of each text, lower-cased.

    ``allowed`` is a bit set over slots; runs whose slot is not in it are left out.
    """
    spark = texts.sparkSession
    shipped = spark.sparkContext.broadcast(allowed) if allowed is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, column in slices(batches, text_col):
            data, at = arrowtext.flat(pc.utf8_lower(column))
            row, position, first, last, hashes = _seed_hashes(data, at, width)
            slot = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            if shipped is not None:
                hit = np.flatnonzero(shipped.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                row, position, first, last, slot = (x[hit] for x in (row, position, first, last, slot))
            strings = [_words(data[s:e].tobytes()) for s, e in zip(first, last, strict=True)]
            yield pa.record_batch(
                [rows.column(id_col).take(pa.array(row)), pa.array(position), pa.array(strings, pa.string()), pa.array(slot)],
                ["id", "position", "seed", "slot"],
            )

    kind = texts.schema[id_col].dataType.simpleString()
    return texts.select(id_col, text_col).mapInArrow(run, f"id {kind}, position long, seed string, slot long")


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's words, lower-cased as the seeds are."""
    for rows, column in slices(batches, "text"):
        data, at = arrowtext.flat(pc.utf8_lower(column))
        words = [_words(data[s:e].tobytes()) for s, e in zip(at, at[1:])]
        yield pa.record_batch([rows.column("item_id"), pa.array(words, pa.string())], ["item_id", "item"])


def _filter(item_seeds: DataFrame) -> np.ndarray:
    """Bit set of the slots that items use; its size is fixed, so that it can always be sent."""
    groups = item_seeds.groupBy(F.expr("slot div 64 AS place")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(pmod(slot, 64) AS INT))) AS bits")
    )
    table = groups.toArrow()  # at most 2**FILTER_BITS / 64 rows
    bits = np.zeros((1 << FILTER_BITS) // 64, "<i8")
    bits[table.column("place").to_numpy()] = table.column("bits").to_numpy()
    return bits.view(np.uint8)


def _window_hashes(words: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(start, Karp-Rabin hash) of every run of ``size`` words without a marked one, rolled along."""
    base = 1_000_003
    top = pow(base, size - 1, _PRIME)
    value, have = 0, 0
    for i, word in enumerate(words):
        if not free[i]:
            value, have = 0, 0
            continue
        if have == size:
            value = (value - words[i - size] * top) % _PRIME
            have -= 1
        value = (value * base + word) % _PRIME
        have += 1
        if have == size:
            yield i - size + 1, value


def tiles(doc: list[int], item: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: (doc position, item position, words) of non-overlapping common runs, longest first.

    Words are numbers; negative ones match nothing. Matches of at least ``size``
    words are found by rolling hashes and marked by length (then by position);
    ``size`` starts at the longest match and halves down to ``least``.
    """
    free_doc, free_item = [w >= 0 for w in doc], [w >= 0 for w in item]
    out: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), 4 * least))
    while True:
        table = defaultdict(list)
        for q, h in _window_hashes(item, free_item, size):
            table[h].append(q)
        found: list[tuple[int, int, int]] = []
        longest = 0
        for p, h in _window_hashes(doc, free_doc, size):
            for q in table.get(h, ()):
                k = 0
                while p + k < len(doc) and q + k < len(item) and free_doc[p + k] and free_item[q + k] and doc[p + k] == item[q + k]:
                    k += 1
                if k >= size:
                    found.append((k, p, q))
                    longest = max(longest, k)
        if longest > 2 * size:
            size = longest
            continue
        for k, p, q in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            # what an earlier tile left of the match, from its start
            n = 0
            while n < k and free_doc[p + n] and free_item[q + n]:
                n += 1
            if n < size:
                continue
            out.append((p, q, n))
            free_doc[p : p + n] = [False] * n
            free_item[q : q + n] = [False] * n
        if size <= least:
            return out
        size = max(least, size // 2) if not found else max(least, size - 1 if longest <= size else size // 2)


def _tiled(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, length, hits in zip(*(batch.column(c).to_pylist() for c in ("item", "n_words", "hits")), strict=True):
                at: dict[int, str] = {}
                for hit in hits:
                    for k, word in enumerate(hit["seed"].split(" ")):
                        at[hit["position"] + k] = word
                names = {w: i for i, w in enumerate(dict.fromkeys(item.split(" ")))}
                doc: list[int] = []
                last = None
                for p in sorted(at):  # only words under seeds can be in a tile; a gap matches nothing
                    if last is not None and p > last + 1:
                        doc.append(-1)
                    doc.append(names.get(at[p], -1))
                    last = p
                found = tiles(doc, [names[w] for w in item.split(" ")], least)
                out.append((sum(t[2] for t in found) / length, len(found), max((t[2] for t in found), default=0)))
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.float64(), pa.int64(), pa.int64()))]
            yield pa.record_batch(
                [batch.column("id"), batch.column("item_id"), *columns], ["id", "item_id", "coverage", "n_tiles", "longest"]
            )

    return run


def contaminated(
    docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, least: int = MIN_MATCH, id_col: str = "doc_id"
) -> DataFrame:
    """(doc id, item_id, coverage, n_tiles, longest) for every document and item whose tiles cover enough of the item.

    Words are runs of letters and digits, lower-cased. Tiles are common runs of
    at least ``least`` words, in any order, so that reordered passages count. The
    documents' seeds are sorted out by a bit set of fixed size and then joined
    with the items' seeds, whatever the size of either side; only pairs with a
    common seed are tiled. Items of fewer than ``least`` words, null texts and
    null ids match nothing; repeated rows of one id count as one document; extra
    columns are not read.
    """
    rows = items.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    item_seeds = materialise(seeds(rows, "item_id", "text", least), "item-seeds")
    allowed = _filter(item_seeds)
    found = seeds(docs.filter(F.col(id_col).isNotNull()), id_col, "text", least, allowed).drop("slot")
    own = item_seeds.select(F.col("id").alias("item_id"), "seed").distinct()
    hits = found.join(own, "seed").groupBy("id", "item_id").agg(
        F.collect_set(F.struct("position", "seed")).alias("hits")
    )
    item_kind = items.schema["item_id"].dataType.simpleString()
    words = rows.mapInArrow(_normalised, f"item_id {item_kind}, item string")
    texts = words.groupBy("item_id").agg(F.max("item").alias("item")).withColumn("n_words", F.size(F.split("item", " ")))
    tiled = hits.join(texts, "item_id").select("id", "item_id", "item", "n_words", "hits")
    kind = docs.schema[id_col].dataType.simpleString()
    scored = tiled.mapInArrow(
        _tiled(least), f"id {kind}, item_id {item_kind}, coverage double, n_tiles long, longest long"
    )
    return scored.filter(F.col("coverage") >= coverage).withColumnRenamed("id", id_col)


def without_contaminated(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that leak no item; rows without doc_id stay."""
    found = contaminated(docs, items, coverage).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)
