"""Exact substring dedup by longest-previous-factor arrays over sampled suffixes."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.llm import arrowtext
from millpond.llm.arrowtext import slices
from millpond.llm.blocks import whole_groups
from millpond.session import materialise

#: Bytes of a repeated string.
WIDTH = 400
#: Words of a repeated passage that is reported, and bytes from which on every one is found.
PASSAGE, PASSAGE_BYTES = 50, 250
#: Suffixes of one group that meet in one task.
BLOCK = 4096
_LOW = np.uint64(0xFFFFFFFF)


def sampled(data: np.ndarray, at: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sampled suffixes of flat rows, and the hash of the gram (``gram`` bytes) at each place.

    Of every string of ``width`` bytes, the place of the gram of least hash is
    taken, the first one if there are several. The choice depends on the string
    alone, so both copies of a string are sampled at the same offset.
    """
    grams = arrowtext.window_hashes(data, gram)
    if len(data) < width:
        return np.zeros(0, np.int64), grams
    place = np.arange(len(grams), dtype=np.uint64)
    least = arrowtext.sliding_min(grams & ~_LOW | place, width - gram + 1)
    edge = np.zeros(len(data) + 1, np.int32)
    sizes = np.diff(at)
    whole = sizes >= width
    np.add.at(edge, at[:-1][whole], 1)
    np.add.at(edge, at[1:][whole] - width + 1, -1)
    inside = np.cumsum(edge)[: len(least)] > 0
    chosen = (least[inside] & _LOW).astype(np.int64)
    return chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))] if len(chosen) else chosen, grams


def _anchors(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            data, at = arrowtext.flat(texts)
            places, grams = sampled(data, at, width, gram)
            row = np.searchsorted(at, places, "right") - 1
            yield pa.record_batch(
                [pa.array(grams[places].view(np.int64)), rows.column("unit").take(pa.array(row)), pa.array(places - at[row])],
                ["gram", "unit", "place"],
            )

    return run


def _contexts(width: int, gram: int):
    """Each sampled suffix with the bytes on both sides that a string of ``width`` bytes around its gram can reach."""
    reach = width - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                rows = batch.slice(k, 64)
                out: list[tuple] = []
                for unit, first, text, found in zip(*(rows.column(c).to_pylist() for c in ("unit", "first", "text", "found")), strict=True):
                    data = text.encode()
                    alike: dict[tuple, list[int]] = {}
                    for x in sorted(found, key=lambda x: x["place"]):
                        p = x["place"]
                        middle = blake2b(data[p : p + gram], digest_size=8).digest()
                        sides = (data[max(0, p - reach) : p], data[p + gram : p + gram + reach])
                        key = (x["gram"], x["parts"], int.from_bytes(middle, "little", signed=True), *sides)
                        if x["parts"] == 1:
                            out.append((*key[:3], unit, first, p, *sides, [p]))
                        else:  # equal suffixes of one text go as one
                            alike.setdefault(key, []).append(p)
                    out += [(*key[:3], unit, first, places[0], *key[3:], places) for key, places in alike.items()]
                columns = [pa.array([o[i] for o in out], t) for i, t in enumerate(_CONTEXT_TYPES)]
                yield pa.record_batch(columns, _CONTEXT_NAMES)

    return run


_CONTEXT_NAMES = ["gram", "parts", "check", "unit", "first", "place", "left", "right", "places"]
_CONTEXT_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
_CONTEXT_TYPES.append(pa.list_(pa.int64()))
_CONTEXT = "gram long, parts int, check long, unit binary, first long, place long, left binary, right binary, places array<long>"


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(x.argmax())


def longest_factors(positions: list, lcp: list[int]) -> tuple[list[int], list[int]]:
    """For each suffix in suffix order: the longest match with an earlier one, and with a later one.

    ``lcp[i]`` is the common prefix of suffixes i and i + 1. The earlier suffix
    that matches longest is the nearest one in suffix order, on either side, of
    smaller position (previous and next smaller position); likewise for later ones.
    """
    n = len(positions)
    earlier, later = [0] * n, [0] * n
    for out, smaller in ((earlier, True), (later, False)):
        for order in (range(n), range(n - 1, -1, -1)):
            stack: list[tuple[object, int]] = []  # position, and its match with the suffix above it
            before = None
            for i in order:
                match = lcp[min(i, before)] if before is not None else 0
                before = i
                while stack and (stack[-1][0] > positions[i] if smaller else stack[-1][0] < positions[i]):
                    match = min(match, stack.pop()[1])
                if stack:
                    out[i] = max(out[i], match)
                stack.append((positions[i], match))
    return earlier, later


def covered(members: list[tuple], width: int, keep_first: bool, gram: int, least: int) -> list[tuple[int, ...]]:
    """(member, bytes to the left of its place, bytes to the right) of what repeated strings cover, and of the longest.

    ``members`` are (position, left, right) around one gram, with different
    positions. Sorting by the left sides gives nested sets of members that share
    at least so many bytes to the left; within each set, the neighbours in
    suffix order to the right, or with ``keep_first`` its longest factors, give the
    longest right match. A set and a match
    whose bytes add up to ``width`` or more cover all bytes between their ends,
    and all of a member's strings hold its gram, so the largest ends count. The
    longest repeated string of a member counts from ``least`` bytes on.
    """
    n = len(members)
    if n == 2:  # most groups
        one, other = members
        match = gram + _common(one[2], other[2])
        depth = _common(one[1][::-1], other[1][::-1])
        if depth + match < least:
            return []
        repeats = [int(one[0] < other[0])] if keep_first else [0, 1]
        cover = (depth, match) if depth + match >= width else (0, 0)
        return [(i, *cover, depth, match) for i in repeats]
    by_right = np.array(sorted(range(n), key=lambda i: members[i][2]))
    rank = np.argsort(by_right)
    right = np.array([gram + _common(members[a][2], members[b][2]) for a, b in zip(by_right, by_right[1:])])
    lefts = [m[1][::-1] for m in members]
    by_left = np.array(sorted(range(n), key=lefts.__getitem__))
    left = np.array([_common(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:])])
    best, longest = np.zeros((n, 2), np.int64), np.zeros((n, 2), np.int64)
    # nested sets: intervals of the left order, split at the least common length
    todo = [(0, n)]
    while todo:
        low, high = todo.pop()
        inner = left[low : high - 1]
        depth = int(inner.min())
        ranks = np.sort(rank[by_left[low:high]])
        part = by_right[ranks]
        lcp = np.minimum.reduceat(right[: ranks[-1]], ranks[:-1])
        if keep_first:
            match = np.array(longest_factors([members[i][0] for i in part], lcp.tolist())[0])
        else:  # of all others, a neighbour in suffix order matches longest
            match = np.maximum(np.append(lcp, 0), np.append(0, lcp))
        repeats = (match > 0) & (depth + match >= least)
        part, match = part[repeats], match[repeats]
        more = depth + match > longest[part].sum(axis=1)
        longest[part[more], 0], longest[part[more], 1] = depth, match[more]
        removed = depth + match >= width
        part, match = part[removed], match[removed]
        best[part, 0] = np.maximum(best[part, 0], depth)
        best[part, 1] = np.maximum(best[part, 1], match)
        cuts = np.concatenate(([low], np.flatnonzero(inner == depth) + low + 1, [high]))
        wide = np.flatnonzero(np.diff(cuts) > 1)
        todo.extend(zip(cuts[wide].tolist(), cuts[wide + 1].tolist()))
    found = np.flatnonzero(longest[:, 1])
    return [(i, *ends) for i, ends in zip(found.tolist(), np.hstack((best, longest))[found].tolist())]


def _matched(width: int, keep_first: bool, gram_width: int, least: int):
    """For each suffix that shares a long enough string with another of its group: what it covers on either side."""

    def work(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        names = ["gram", "check", "unit", "first", "place", "left", "right"]
        gram, check, unit, first, place, left, right = (table.column(c).to_pylist() for c in names)
        out: list[tuple[int, bytes, int, int, int, int, int]] = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if b - a < 2:
                continue
            same: dict[int, dict[tuple, tuple]] = {}
            for i in range(a, b):  # a repeated row of one document is the same suffix
                position = (first[i] is None, first[i] or 0, unit[i], place[i])
                same.setdefault(check[i], {})[position] = (position, left[i], right[i])
            for group in same.values():
                members = list(group.values())
                if len(members) > 1:
                    for i, *ends in covered(members, width, keep_first, gram_width, least):
                        out.append((gram[a], *members[i][0][2:], *ends))
        kinds = (pa.int64(), pa.binary(), *[pa.int64()] * 5)
        return pa.record_batch([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], _COVER_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return whole_groups(batches, ["gram", "p", "q"], work, 8192)

    return run


#: What is covered from a place on either side, and how far the longest repeated string reaches there.
_ENDS = ["before", "after", "left_end", "right_end"]
_COVER_NAMES = ["gram", "unit", "place", *_ENDS]
_COVER = "gram long, unit binary, place long, before long, after long, left_end long, right_end long"


def _met(suffixes: DataFrame, *how) -> DataFrame:
    """(gram, unit, place and ends) from suffixes with ``parts``: every two blocks of a gram meet in one task."""
    dealt = suffixes.withColumn("own", F.pmod(F.xxhash64("unit", "place"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")})
    ready = dealt.select("gram", "p", "q", *_CONTEXT_NAMES[2:-1])
    ready = ready.repartition("gram", "p", "q").sortWithinPartitions("gram", "p", "q")
    return ready.mapInArrow(_matched(*how), _COVER)


def _says(data: bytes, strings: list[tuple[int, int]], passage: int) -> bool:
    """Whether one of the (start, end) strings has ``passage`` whole words, parted by ASCII white space."""
    if not any(end - start >= 2 * passage - 1 for start, end in strings):
        return False
    flat = np.frombuffer(data, np.uint8)
    starts, ends, _ = arrowtext.words(flat, np.array([0, len(flat)]), _WORD)
    low, high = np.array(strings).T
    return bool((np.searchsorted(ends, high, "right") - np.searchsorted(starts, low) >= passage).any())


_WORD = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])


def _cut(batches: Iterator[pa.RecordBatch], passage: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        out = []
        columns = (rows.column(c).to_pylist() for c in ("spans", "copied"))
        for text, spans, copied in zip(texts.to_pylist(), *columns, strict=True):
            data = text.encode()
            kept, at, removed, runs = [], 0, 0, 0
            end = -1
            for s in sorted((p - x["before"], p + x["after"]) for x in spans or () if x["before"] + x["after"] for p in x["places"]):
                runs += s[0] > end
                end = max(end, s[1])
                if s[0] > at:
                    kept.append(data[at : s[0]])
                removed += max(0, s[1] - max(at, s[0]))
                at = max(at, s[1])
            strings = [(0, len(data))] * copied + [(p - x["left_end"], p + x["right_end"]) for x in spans or () for p in x["places"]]
            says = bool(passage) and _says(data, strings, passage)
            out.append((b"".join([*kept, data[at:]]), len(data), removed, runs, says))
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        columns = [pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)]
        yield pa.record_batch([rows.column("id"), *columns], ["id", "kept", "n_bytes", "n_removed", "n_spans", "has_passage"])


def repeated_spans(
    units: DataFrame, width: int = WIDTH, block: int = BLOCK, keep_first: bool = False, least: int | None = None
) -> DataFrame:
    """(unit, places, before, after, left_end, right_end): repeated strings cover so many bytes before and from each
    place; they overlap. The last two are the ends of the longest repeated string there, from ``least`` bytes on
    (``width`` by default); before and after are 0 where only such a shorter one repeats.

    ``units`` (unit binary, doc_id, first, text): a text may stand in several rows
    of one unit; ``first`` is the smallest doc_id of the unit. Suffixes are
    sampled, grouped by the hash of their gram and, where the gram repeats, sorted
    with the bytes around it. Of a gram with more than ``block`` suffixes, those
    with the same bytes around them are one class first: one suffix stands for
    all, in blocks of which every two meet in a task of their own, and its result
    goes back to the class.
    """
    # a shorter string is sampled by a shorter gram, out of nearly as many
    least, gram = (width, width // 2) if least is None else (least, least // 3)
    found = units.filter(F.octet_length("text") >= least).select("unit", "text")
    anchors = materialise(found.mapInArrow(_anchors(least, gram), "gram long, unit binary, place long"), "anchors")
    own = F.xxhash64("unit", "place")
    sizes = anchors.groupBy("gram").agg(F.min(own).alias("a"), F.max(own).alias("b"), F.count(F.lit(1)).alias("n"))
    repeated = sizes.filter("a <> b").select("gram", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    repeated = materialise(repeated, "repeated")  # so that a crowded gram's side of the join can be split
    wanted = anchors.join(repeated, "gram").groupBy("unit").agg(
        F.collect_set(F.struct("gram", "parts", "place")).alias("found")
    )
    texts = units.filter("doc_id <=> first").select("unit", "first", "text").join(wanted, "unit")
    around = materialise(texts.mapInArrow(_contexts(width, gram), _CONTEXT), "suffixes")
    how = (width, keep_first, gram, least)
    plain = _met(around.filter("parts = 1"), *how)

    crowded = around.filter("parts > 1").withColumn("class", F.xxhash64("check", "left", "right"))
    at = F.struct(F.col("first").isNull().alias("none"), "first", "unit", "place")
    classes = crowded.groupBy("gram", "class").agg(
        F.min(at).alias("low"), F.max(at).alias("high"), F.max(F.size("places")).alias("most"),
        *[F.first(c).alias(c) for c in ("check", "left", "right")],
    )
    classes = materialise(classes, "classes")
    blocks = classes.groupBy("gram").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    heads = classes.join(materialise(blocks, "blocks"), "gram").select("gram", "class", "low.*", "parts", "check", "left", "right")
    met = _met(heads, *how)
    # one row per suffix, from all blocks that it meets; what it covers there holds its gram, so the largest ends count
    far = F.max_by(F.struct("left_end", "right_end"), F.col("left_end") + F.col("right_end")).alias("far")
    met = met.groupBy("gram", "unit", "place").agg(F.max("before").alias("before"), F.max("after").alias("after"), far)
    met = met.select("gram", "unit", "place", "before", "after", "far.*")
    met = met.join(heads.select("gram", "class", "unit", "place"), ["gram", "unit", "place"])
    # a class of several suffixes repeats as a whole; its first one has no earlier copy there
    before, after = F.octet_length("left").cast("long"), (F.octet_length("right") + gram).cast("long")
    whole = before + after >= width
    alike = classes.filter("low <> high OR most > 1").filter(before + after >= least).select(
        "gram", "class", F.when(whole, before).otherwise(0).alias("before"), F.when(whole, after).otherwise(0).alias("after"),
        before.alias("left_end"), after.alias("right_end"), F.lit(keep_first).alias("later"),
    )
    met = met.select("gram", "class", *_ENDS, F.lit(False).alias("later")).unionByName(alike)
    members = crowded.join(classes.select("gram", "class", "low"), ["gram", "class"]).select(
        "gram", "class", "unit", "places", at.eqNullSafe(F.col("low")).alias("head")
    )
    rest = F.when(F.col("later") & F.col("head"), F.slice("places", 2, F.size("places"))).otherwise(F.col("places"))
    shared = members.join(met, ["gram", "class"]).select("unit", rest.alias("places"), *_ENDS)
    return plain.select("unit", F.array("place").alias("places"), *_ENDS).unionByName(shared)


def without_repeats(
    docs: DataFrame, width: int = WIDTH, block: int = BLOCK, keep_first: bool = False, id_col: str = "doc_id",
    passage: int | None = None, passage_bytes: int = PASSAGE_BYTES,
) -> DataFrame:
    """(id, kept, n_bytes, n_removed, n_spans) per row; kept is the text's remaining bytes (binary).

    With ``passage`` also has_passage: whether the text holds a string of so many
    words or more that also starts anywhere else. Every such string of
    ``passage_bytes`` (at most ``width``) is found, some shorter ones are; around
    each sampled place the longest one is judged. It changes nothing in what is removed.

    A byte is removed if a string of ``width`` bytes that covers it also starts
    anywhere else in the table, same row included; with ``keep_first`` only if it
    also starts earlier, by the smallest id that holds the text, then by place.
    Equal texts (by their md5) are searched once: of two or more, each of at
    least ``width`` bytes, all bytes are repeated. Null and short texts keep all;
    repeated rows are copies; rows without id take part, after all others; other
    columns are not read.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("unit", F.unhex(F.md5("text")))
    units = materialise(
        base.groupBy("unit").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "units"
    )
    copies = units.filter("n > 1").select(F.col("unit").alias("copied"), "first")
    # only units of several rows need a look-up of their first id
    rows = base.join(copies, base["unit"] == copies["copied"], "left").select(
        "unit", "doc_id", "text", F.when(F.col("copied").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("first")
    )
    least = passage_bytes if passage else None
    spans = repeated_spans(rows, width, block, keep_first, least).groupBy("unit").agg(F.collect_set(F.struct("places", *_ENDS)).alias("spans"))
    marks = materialise(spans, "spans").join(units.filter("n > 1"), "unit", "full_outer")
    marked = base.join(marks, "unit", "left")
    copied = F.col("n").isNotNull()
    whole = copied & (F.octet_length("text") >= width)
    if keep_first:
        whole &= ~F.col("doc_id").eqNullSafe(F.col("first"))
    zero, size = F.lit(0).cast("long"), F.octet_length("text").cast("long")
    everything = F.array(F.struct(F.array(zero).alias("places"), *[x.alias(c) for x, c in zip((zero, size) * 2, _ENDS)]))
    ready = marked.select(
        F.col("doc_id").alias("id"), "text", copied.alias("copied"),
        F.when(whole, everything).otherwise(F.col("spans")).alias("spans"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    names = f"id {kind}, kept binary, n_bytes long, n_removed long, n_spans long, has_passage boolean"
    out = ready.mapInArrow(lambda batches: _cut(batches, passage or 0), names).withColumnRenamed("id", id_col)
    return out if passage else out.drop("has_passage")
