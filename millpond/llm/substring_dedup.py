"""Near-duplicate passages by compact windows: min-hashes that many subsequences share."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.llm import arrowtext, blocks
from millpond.llm.arrowtext import slices
from millpond.llm.decontamination import _WORD, _seed_hashes
from millpond.session import materialise

SHINGLE = 5
#: Words of the shortest passage.
PASSAGE = 50
#: Jaccard similarity of two passages' shingles.
SIMILARITY = 0.8
#: Independent min-hashes; passages that share one of them are verified.
HASHES = 6
#: Rounds in which a window of each min-hash meets all others of it at once, before what is left is compared one by one.
HEADS = 8
#: Different windows of one min-hash that are compared within one task.
BLOCK = 1024
#: Different windows of one min-hash up to which all pairs of them go to verification at once.
FEW = 3
_LOW = np.uint64(0xFFFFFFFF)


def nearest_smaller(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value (unsigned) to the left in the same row, -1 if there is none.

    These are the parents and left ends of a Cartesian tree. Whatever lies
    between an index and its candidate is larger, so a candidate that is too
    large hands over its own.
    """
    n = len(values)
    # a zero in front of each row ends every search
    new = np.concatenate(([True], rows[1:] != rows[:-1]))[:n]
    place = np.arange(n) + np.cumsum(new)
    padded = np.zeros(n + int(new.sum()), values.dtype)
    padded[place] = values
    found = np.arange(-1, len(padded) - 1)
    todo = place
    while len(todo):
        at = found[todo]
        larger = padded[at] > padded[todo]
        todo = todo[larger]
        found[todo] = found[at[larger]]
    back = np.full(len(padded), -1)
    back[place] = np.arange(n)
    return back[found[place]]


def minima(shingles: np.ndarray, rows: np.ndarray, seed: int, width: int) -> tuple[np.ndarray, ...]:
    """(index, key, min-hash) of the minimum of every run of ``width`` shingles in one row, each index once, in order.

    Keys are what is compared: a hash's upper half, then the place, so of equal hashes the first one is smaller.
    """
    n = len(shingles)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    hashes = arrowtext.mixed(shingles ^ np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    keys = hashes & ~_LOW | np.arange(n, dtype=np.uint64)
    least = arrowtext.sliding_min(keys, width)
    least = least[rows[: len(least)] == rows[width - 1 :]]
    least = least[np.concatenate(([True], least[1:] != least[:-1]))[: len(least)]]
    index = (least & _LOW).astype(np.int64)
    return index, least, hashes[index]


def compact_windows(shingles: np.ndarray, rows: np.ndarray, seed: int, width: int) -> tuple[np.ndarray, ...]:
    """(index of the minimum, first, last, min-hash): all subsequences of ``width`` shingles or more in one row.

    Every subsequence within [first, last] that contains the index has its
    min-hash there. Equal hashes are told apart by place, the first one smaller.
    """
    index, value, hashes = minima(shingles, rows, seed, width)
    if not len(index):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    # a smaller neighbour of a window's minimum is itself the minimum of a window, or lies beyond the row
    row = rows[index]
    edges = np.concatenate(([0], np.flatnonzero(rows[1:] != rows[:-1]) + 1, [len(rows)]))
    text = np.searchsorted(edges, index, "right")
    start, end = edges[text - 1], edges[text] - 1
    before = nearest_smaller(value, row)
    after = len(value) - 1 - nearest_smaller(value[::-1], row[::-1])[::-1]
    first = np.where(before >= 0, index[np.maximum(before, 0)] + 1, start)
    last = np.where(after < len(value), index[np.minimum(after, len(value) - 1)] - 1, end)
    return index, first, last, hashes


def joined(index: np.ndarray, first: np.ndarray, value: np.ndarray, rows: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that are left when equal minima are joined, and the last minimum of each.

    A window that begins right after an equal minimum lies within that one's
    window. If the two minima are at most ``reach`` apart it goes with it, so that
    n equal shingles in a run, or a phrase said n times, are one window, not n.
    """
    place = np.zeros(int(index.max(initial=0)) + 1, np.int64)
    place[index] = np.arange(len(index))
    at = place[np.maximum(first - 1, 0)]
    tied = (first > 0) & (index[at] == first - 1) & (rows[index[at]] == rows[index]) & (value[at] == value)
    head = np.where(tied & (index - index[at] <= reach), at, np.arange(len(index)))
    while (head != head[head]).any():
        head = head[head]
    final = index.copy()
    np.maximum.at(final, head, index)
    kept = np.flatnonzero(head == np.arange(len(index)))
    return kept, final[kept]


def _around(
    index: np.ndarray, final: np.ndarray, first: np.ndarray, last: np.ndarray, reach: int
) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of what is compared of a window: ``reach`` shingles on either side of its minima."""
    return np.maximum(first, index - reach), np.minimum(last, final + reach) + 1


def _keys(width: int, hashes: int):
    """One row per min-hash of each text, or a few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts_rows, column in slices(batches, "text"):
            data, at = arrowtext.flat(pc.utf8_lower(column))
            rows, _, _, _, shingles = _seed_hashes(data, at, SHINGLE)
            for seed in range(hashes):
                index, _, value = minima(shingles, rows, seed, width)
                row = rows[index]
                # a phrase said again and again has the same minima in a row; what else repeats is left to the aggregate
                new = np.concatenate(([True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])))[: len(row)]
                yield pa.record_batch(
                    [pa.array(value[new].view(np.int64)), texts_rows.column("doc_id").take(pa.array(row[new]))],
                    ["key", "doc_id"],
                )

    return run


def _windows(width: int, hashes: int, reach: int):
    """One row per compact window, equal minima joined; ``like`` is a hash of the shingles around c and the d shingles after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts_rows, column in slices(batches, "text"):
            data, at = arrowtext.flat(pc.utf8_lower(column))
            rows, position, _, _, shingles = _seed_hashes(data, at, SHINGLE)
            prefix = arrowtext.prefix_hashes(shingles)
            for seed in range(hashes):
                index, first, last, value = compact_windows(shingles, rows, seed, width)
                kept, final = joined(index, first, value, rows, reach)
                index, first, last, value = (x[kept] for x in (index, first, last, value))
                like = arrowtext.range_hashes(prefix, *_around(index, final, first, last, reach))
                yield pa.record_batch(
                    [
                        pa.array(value.view(np.int64)),
                        pa.array(like.view(np.int64)),
                        texts_rows.column("doc_id").take(pa.array(rows[index])),
                        pa.array(position[index].astype(np.int32)),
                        pa.array((final - index).astype(np.int32)),
                        *[pa.array(position[x].astype(np.int32)) for x in (first, last)],
                    ],
                    ["key", "like", "doc_id", "c", "d", "l", "r"],
                )

    return run


def _contents(reach: int):
    """The shingles around the minimum of each wanted window of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            text, _, _, _, shingles = _seed_hashes(*arrowtext.flat(pc.utf8_lower(texts)), SHINGLE)
            prefix, short = arrowtext.prefix_hashes(shingles), (shingles & _LOW).astype(np.uint32)
            first = np.searchsorted(text, np.arange(len(texts)))
            count = np.bincount(text, minlength=len(texts))
            wanted = rows.column("wanted")
            at = wanted.offsets.to_numpy()
            row = np.repeat(np.arange(len(texts)), np.diff(at))
            columns = {c: wanted.values.field(c).to_numpy()[at[0] : at[-1]] for c in _WANTED}
            # of several texts under one doc_id, the one that the window is from
            there = np.flatnonzero(columns["r"] < count[row])
            for k in range(0, len(there), 20_000):
                some = there[k : k + 20_000]
                mine = {c: v[some] for c, v in columns.items()}
                c = mine["c"].astype(np.int64)
                low, high = _around(c, c + mine["d"], mine["l"], mine["r"], reach)
                low, high = low + first[row[some]], high + first[row[some]]
                same = np.flatnonzero(arrowtext.range_hashes(prefix, low, high).view(np.int64) == mine["like"])
                low, sizes = low[same], (high - low)[same]
                ends = np.concatenate(([0], np.cumsum(sizes)))
                content = short[np.arange(ends[-1]) + np.repeat(low - ends[:-1], sizes)]
                buffers = [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(content)]
                yield pa.record_batch(
                    [
                        rows.column("doc_id").take(pa.array(row[some[same]])),
                        *[pa.array(mine[c][same]) for c in _WANTED],
                        pa.Array.from_buffers(pa.binary(), len(same), buffers),
                    ],
                    ["doc_id", *_WANTED, "shingles"],
                )

    return run


_WANTED = ["key", "like", "c", "d", "l", "r", "own", "p", "q"]


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def _links(width: int, similarity: float, reach: int):
    """Links (a, b and the windows on both sides) that connect the windows of each min-hash whose passages are alike."""
    least = int(np.ceil(2 * similarity / (1 + similarity) * width))

    def work(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        n = table.num_rows
        data, at = arrowtext.flat(table.column("shingles").combine_chunks())
        flat, at = data.view(np.uint32), at // 4
        docs, own, c, left, right, p, q = (table.column(x).to_numpy() for x in ("doc_id", "own", "c", "l", "r", "p", "q"))
        lengths = np.diff(at)
        member = np.repeat(np.arange(n), lengths)
        group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        coded = pa.array(group[member].astype(np.uint64) << np.uint64(32) | flat).dictionary_encode()
        word, terms = coded.indices.to_numpy(), len(coded.dictionary)

        def several(word: np.ndarray, of: np.ndarray) -> np.ndarray:
            """Whether each word stands beside more than one value of ``of``."""
            one, out = np.zeros(terms, np.int64), np.zeros(terms, bool)
            one[word] = of
            out[word[of != one[word]]] = True
            return out

        alive = np.bincount(member, several(word, member)[word], n) >= least
        # the shingles of each window, once
        here = alive[member]
        each = np.sort(member[here] * terms + word[here])
        of, term = np.divmod(each[np.concatenate(([True], each[1:] != each[:-1]))[: len(each)]], terms)
        # all groups at once: the first windows that are left, each against the others left of its group, as a whole
        label, out, open_ = np.arange(n), [], alive.copy()
        # shingles by their distance from the minimum; 2**32 and more: none
        beside = np.arange(len(flat)) - at[member] + np.maximum(reach - (c - left), 0)[member]
        spread = np.full((n, 2 * reach + 1), 1 << 32, np.int64)
        near = here & (beside < spread.shape[1])  # joined minima reach further
        spread[member[near], beside[near]] = flat[near]
        distinct = np.bincount(of, minlength=n)
        plain = distinct == lengths  # no shingle twice

        def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Whether two windows can be linked. Two blocks: each meets itself elsewhere."""
            return (docs[a] != docs[b]) & ((p[a] == q[a]) | (own[a] != own[b]))

        def in_line(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Whether a passage of ``width`` shingles at the same distance from both minima is alike."""
            mine = spread[a]
            same = (mine == spread[b]) & (mine < 1 << 32)
            sums = np.zeros((len(a), same.shape[1] + 1), np.int16)
            np.cumsum(same, axis=1, out=sums[:, 1:])
            most = (sums[:, width:] - sums[:, :-width]).max(axis=1)
            return (most == width) | plain[a] & plain[b] & (most >= least)

        for _ in range(HEADS):
            rows = np.flatnonzero(open_)
            new = np.concatenate(([True], group[rows[1:]] != group[rows[:-1]]))[: len(rows)]
            head = rows[new][np.cumsum(new) - 1]
            rows, head = rows[rows != head], head[rows != head]
            if not len(rows):
                break
            kept = open_[of]
            of, term = of[kept], term[kept]
            heads, marked = np.zeros(n, bool), np.zeros(terms, bool)
            heads[head] = True
            marked[term[heads[of]]] = True
            both = np.bincount(of, marked[term], n)[rows]
            free = apart(rows, head)
            near = free & (both >= similarity * (distinct[rows] + distinct[head] - both))
            # a passage in line shares its shingles; without repeats these are ``least`` different ones
            rest = np.flatnonzero(free & ~near & (both >= np.where(plain[rows] | plain[head], least, 1)))
            near[rest] = in_line(rows[rest], head[rest])
            label[rows[near]] = head[near]
            out += zip(head[near].tolist(), rows[near].tolist())
            open_ &= ~heads
            open_[rows[near]] = False
        # what is left, one by one, again all groups at once
        row, words, turn = member[here].astype(np.int32), word[here], 0
        rank, size, first = np.zeros(n, np.int64), np.zeros(len(starts) - 1, np.int64), starts[:-1]
        mark, x = np.zeros(terms, bool), np.zeros(len(starts) - 1, np.int64)
        while True:
            if turn & (turn - 1) == 0:  # now and then: only shingles in windows of several labels can link these
                there = several(words, label[row])[words] & (rank >= turn)[row]
                words, row = words[there], row[there]
                met = np.bincount(row, minlength=n)
                if not turn:
                    rows = np.flatnonzero(met)
                    size = np.bincount(group[rows], minlength=len(size))
                    first = np.cumsum(size) - size
                    rank[rows] = np.arange(len(rows)) - first[group[rows]]
                there = (met >= least)[row]  # the later one of a pair has a window with that many
                held, later = words[there], row[there]
                size[np.bincount(group[later], minlength=len(size)) == 0] = 0
            now = np.flatnonzero(size > turn + 1)
            if not len(now):
                break
            x[now] = rows[first[now] + turn]
            ours = _runs(at[x[now]], lengths[x[now]])
            mark[word[ours]] = True
            y = np.flatnonzero(np.bincount(later[mark[held]], minlength=n) >= least)
            mine = x[group[y]]
            free = (rank[y] > turn) & (label[y] != label[mine]) & apart(y, mine)
            y, mine = y[free], mine[free]
            if len(y):
                sums = np.concatenate(([0], np.cumsum(mark[word[_runs(at[y], lengths[y])]])))
                runs = lengths[y] - width + 1
                place = _runs(np.cumsum(lengths[y]) - lengths[y], runs)
                most = np.maximum.reduceat(sums[place + width] - sums[place], np.cumsum(runs) - runs)
                y, mine = y[most >= least], mine[most >= least]
            mark[word[ours]] = False
            for i, j, alike in zip(mine.tolist(), y.tolist(), in_line(y, mine).tolist() if len(y) else []):
                if label[i] != label[j] and (
                    alike or passages(flat[at[i] : at[i + 1]], flat[at[j] : at[j + 1]], width, similarity, True)
                ):
                    same = label[starts[group[i]] : starts[group[i] + 1]]
                    same[same == label[j]] = label[i]
                    out.append((i, j))
            turn += 1
        if not out:
            return None
        a, b = np.array(out).T
        columns = [docs[a], docs[b], left[a], right[a], left[b], right[b]]
        return pa.record_batch([pa.array(x) for x in columns], _LINK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return blocks.whole_groups(batches, ["key", "p", "q"], work)

    return run


_LINK = ["a", "b", "la", "ra", "lb", "rb"]


def candidates(hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(a first, a last, b first, b last), in shingles, of regions that windows have in common.

    ``hits`` (b first, b last, a first, a last) are pairs of windows with a
    passage in common. They are joined by a sweep over b: a pair of windows joins
    all open regions that it overlaps on both sides, and those that the joined one
    then overlaps, into one.
    """
    done: list[list[int]] = []
    live: list[list[int]] = []
    for lb, rb, la, ra in sorted(hits):
        done += [x for x in live if x[3] < lb]
        live = [x for x in live if x[3] >= lb]
        box, met = [la, ra, lb, rb], True
        while met:  # a joined region reaches further on a
            met = [x for x in live if x[0] <= box[1] and box[0] <= x[1]]
            live = [x for x in live if x[0] > box[1] or box[0] > x[1]]
            for x in met:
                box = [min(box[0], x[0]), max(box[1], x[1]), min(box[2], x[2]), max(box[3], x[3])]
        live.append(box)
    return [tuple(x) for x in done + live]


def passages(a: np.ndarray, b: np.ndarray, width: int, similarity: float, once: bool = False) -> list[tuple[int, int, int, int, float]]:
    """(a first, a end, b first, b end, Jaccard) of verified passages between two runs of shingle hashes.

    Windows of ``width`` shingles of b that share enough with a are joined; a
    joined passage counts if its shingles and those of its counterpart in a reach
    ``similarity``, else each window of it is tried alone. ``once``: the first is enough.
    """
    if len(a) == len(b) >= width and (a == b).all():
        return [(0, len(a), 0, len(b), 1.0)]
    least = int(np.ceil(2 * similarity / (1 + similarity) * width))
    # slots of the shingles first: most pairs have too few in common, and more share a slot than a shingle
    slots = np.zeros(1 << 16, bool)
    slots[a & 0xFFFF] = True
    sums = np.concatenate(([0], np.cumsum(slots[b & 0xFFFF], dtype=np.int32)))
    if sums[-1] < least or not (sums[width:] - sums[:-width] >= least).any():
        return []
    place = np.full(len(b), -1)
    if len(a) and len(b):
        order = np.argsort(a, kind="stable")
        ordered = a[order]
        low = np.searchsorted(ordered, b)
        hit = np.flatnonzero(ordered[np.minimum(low, len(a) - 1)] == b)
        place[hit] = order[low[hit]]
        several = hit[ordered[np.minimum(low[hit] + 1, len(a) - 1)] == b[hit]]
        several = several[low[several] + 1 < len(a)]
        if len(several):
            options, chosen, shingle = order.tolist(), place.tolist(), a.tolist()
            ends = np.searchsorted(ordered, b[several], "right")
            # of several, the one that goes on from the last
            done = on = 0
            for j, x, y, own in zip(several.tolist(), low[several].tolist(), ends.tolist(), b[several].tolist()):
                if j < done:
                    continue
                if j and chosen[j - 1] >= 0:
                    wanted = chosen[j - 1] + 1
                    if wanted < len(shingle) and shingle[wanted] == own:
                        chosen[j], on = wanted, on + 1
                        if on > 8:  # a long run goes on as one
                            size = min(len(a) - wanted, len(b) - j, 1024)
                            other = a[wanted : wanted + size] != b[j : j + size]
                            size = int(other.argmax()) if other.any() else size
                            chosen[j : j + size] = range(wanted, wanted + size)
                            done = j + size
                        continue
                    on = 0
                    k = bisect_left(options, wanted, x, y)
                    if k == y or k > x and wanted - options[k - 1] <= options[k] - wanted:
                        k -= 1
                    chosen[j] = options[k]
            place = np.array(chosen)
    sums = np.concatenate(([0], np.cumsum(place >= 0)))
    good = np.flatnonzero(sums[width:] - sums[:-width] >= least) if len(b) >= width else np.zeros(0, np.int64)
    out: list[tuple[int, int, int, int, float]] = []
    if not len(good):
        return out

    def tried(first: int, end: int) -> tuple[int, int, int, int, float] | None:
        matched = place[first:end]
        found = np.flatnonzero(matched >= 0)
        if not len(found):
            return None
        matched = matched[found]
        shift = matched - found
        if len(found) == end - first and (shift == shift[0]).all():  # shingle by shingle the same
            return int(matched[0]), int(matched[-1]) + 1, first, end, 1.0
        ordered = np.sort(shift)
        middle = (ordered[(len(found) - 1) // 2] + ordered[len(found) // 2]) / 2
        near = matched[np.abs(shift - middle) <= width]
        if not len(near):
            return None
        low, high = int(near.min()), int(near.max()) + 1
        mine, other = set(b[first:end].tolist()), set(a[low:high].tolist())
        score = len(mine & other) / len(mine | other)
        return (low, high, first, end, score) if score >= similarity else None

    breaks = [0, *(np.flatnonzero(np.diff(good) > 1) + 1).tolist(), len(good)]
    for run in (good[i:j] for i, j in zip(breaks, breaks[1:])):
        first, end = int(run[0]), int(run[-1]) + width
        while end > first and place[end - 1] < 0:
            end -= 1
        while first < end and place[first] < 0:
            first += 1
        whole = tried(first, end)
        if whole:
            out.append(whole)
            if once:
                break
            continue
        at = -1
        for s in run.tolist():
            if s >= at and (one := tried(s, s + width)):
                out.append(one)
                if once:
                    return out
                at = s + width
    return out


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits = batch.column("hits")
        at = hits.offsets.to_numpy().astype(np.int64)
        fields = hits.values
        lb, rb, la, ra = columns = [fields.field(c).to_numpy().astype(np.int64) for c in ("lb", "rb", "la", "ra")]
        lb, rb, la, ra = (x[at[0] : at[-1]] for x in columns)
        pair = np.repeat(np.arange(batch.num_rows), np.diff(at))
        order = np.lexsort((ra, la, rb, lb, pair))
        lb, rb, la, ra = lb[order], rb[order], la[order], ra[order]
        # running extremes within each pair; its first hit stands alone
        high = lambda x: np.maximum.accumulate(pair << 32 | x) & 0xFFFFFFFF
        top = 0x7FFFFFFF
        so_far = high(rb), high(ra), top - high(top - la)
        broken = (lb[1:] > so_far[0][:-1]) | (la[1:] > so_far[1][:-1]) | (so_far[2][:-1] > ra[1:])
        broken = np.bincount(pair[1:][broken & (pair[1:] == pair[:-1])], minlength=batch.num_rows) > 0
        start, final = at[:-1] - at[0], at[1:] - at[0] - 1
        boxes = np.stack([so_far[2][final], so_far[1][final], lb[start], so_far[0][final]], axis=1).tolist()
        out = []
        columns = [x.tolist() for x in (lb, rb, la, ra)]
        rows = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), broken.tolist(), boxes, start.tolist(), final.tolist())
        for a, b, apart, box, i, j in rows:
            # hits that each meet the region so far are one
            found = candidates(list(zip(*(c[i : j + 1] for c in columns)))) if apart else [box]
            out += [(a, b, k, *box) for k, box in enumerate(found)]
        yield pa.record_batch([pa.array([o[i] for o in out], pa.int64()) for i in range(7)], _REGION)


_REGION = ["a", "b", "k", "a_first", "a_last", "b_first", "b_last"]


def _shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    """Hashes of each text's shingles, 32 bits each: enough to tell those of two passages apart.

    Rows of one text follow one another; such a text is hashed once.
    """
    other = pc.not_equal(texts.slice(1), texts.slice(0, len(texts) - 1)).to_numpy(zero_copy_only=False)
    new = np.concatenate(([True], other))
    some = texts.filter(pa.array(new))
    row, _, _, _, shingles = _seed_hashes(*arrowtext.flat(pc.utf8_lower(some)), SHINGLE)
    short, at = (shingles & _LOW).astype(np.uint32), np.searchsorted(row, np.arange(len(some) + 1))
    return (short[at[k] : at[k + 1]] for k in (np.cumsum(new) - 1).tolist())


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each region's side in a."""
    for rows, texts in slices(batches, "text"):
        ends = (rows.column(c).to_pylist() for c in ("a_first", "a_last"))
        out = [shingles[first : last + 1].tobytes() for shingles, first, last in zip(_shingles(texts), *ends, strict=True)]
        yield rows.drop_columns(["text"]).append_column("shingles", pa.array(out, pa.binary()))


def _verified(width: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("a", "b", "a_first", "b_first", "b_last", "shingles")
        for rows, texts in slices(batches, "text"):
            out = []
            for shingles, a, b, x, y, z, xs in zip(_shingles(texts), *(rows.column(c).to_pylist() for c in names), strict=True):
                left, right = np.frombuffer(xs, np.uint32), shingles[y : z + 1]
                for la, ha, lb, hb, score in passages(left, right, width, similarity):
                    tail = SHINGLE - 1  # from shingles to words
                    out.append((a, b, x + la, x + ha + tail, y + lb, y + hb + tail, score))
            kinds = [pa.int64()] * 6 + [pa.float64()]
            yield pa.record_batch(
                [pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)],
                ["a", "b", "a_start", "a_end", "b_start", "b_end", "similarity"],
            )

    return run


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of words of each text."""
    for rows, texts in slices(batches, "text"):
        data, at = arrowtext.flat(pc.utf8_lower(texts))
        n = np.bincount(arrowtext.words(data, at, _WORD)[2], minlength=rows.num_rows)
        yield rows.drop_columns(["text"]).append_column("n", pa.array(n, pa.int64()))


def _staged(df: DataFrame, label: str) -> DataFrame:
    return materialise(df, label, swept=True)


#: Bits of one row of the marks of copied ids.
_BITS = 8 * 4096


def _without(base: DataFrame, copies: DataFrame) -> DataFrame:
    """The texts that are no copies.

    A bit for a hash of each copy's doc_id, 16 bits a copy in rows of 4 KB, tells most others at
    once, so that however many copies there are only theirs and one text in 16 meet in a join.
    """
    rows = copies.count() * 16 // _BITS + 1
    place = F.pmod(F.xxhash64("doc_id"), F.lit(rows * _BITS))
    spot = {"_row": F.floor(place / _BITS).cast("int"), "_bit": place % _BITS}
    bits = copies.withColumns(spot).groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    bits = _staged(bits, "copied-ids")
    # two bytes a copy, whatever its text
    looked = base.withColumns(spot).join(F.broadcast(bits), "_row", "left")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    marked = F.coalesce(F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1 = 1"), F.lit(False))
    looked = looked.withColumn("_byte", byte).withColumn("_marked", marked)
    doubted = looked.filter("_marked").select("doc_id", "text").withColumn("unit", F.unhex(F.md5("text")))
    kept = doubted.join(copies.select("doc_id", "unit"), ["doc_id", "unit"], "left_anti").select("doc_id", "text")
    return looked.filter("NOT _marked").select("doc_id", "text").unionByName(kept)


def repeated_passages(
    docs: DataFrame,
    passage: int = PASSAGE,
    similarity: float = SIMILARITY,
    hashes: int = HASHES,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, other_id, start, end, other_start, other_end, similarity): passages that repeat across documents.

    Positions are words (runs of letters and digits, lower-cased), end exclusive.
    Windows of one min-hash with equal shingles around it are one class, linked
    with the class's smallest document. Classes of one min-hash are compared with
    one another, large groups in blocks, and those alike are linked until they are
    connected; so a min-hash of n windows gives fewer than n links in each pair of
    blocks, not all pairs. Linked regions are verified on all shingles. Each
    verified link gives a row for either document. Equal texts (by their md5) are
    searched once, under the smallest doc_id, and linked with it whole; other texts
    under one of their doc_ids are searched as any. A key that many documents share
    is aggregated before it is shuffled, and its join can be split. What a step has
    shuffled is removed once its result is written. Texts of fewer than ``passage`` words, null texts and rows without
    doc_id hold no passage; repeated rows of one doc_id are one document; repeats
    within a document are not reported; an empty table gives no rows; other
    columns are not read.
    """
    width = passage - SHINGLE + 1
    base = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = base.select("doc_id", F.unhex(F.md5("text")).alias("unit")).distinct()
    units = marked.groupBy("unit").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("final")).filter("first <> final")
    copies = _staged(marked.join(units, "unit").filter("doc_id <> first").select("doc_id", "unit", "first"), "copies")
    texts = _without(base, copies)
    reach = int(np.ceil(width / similarity))
    kinds = "key long, like long, doc_id long, c int, d int, l int, r int"
    windows = texts.mapInArrow(_windows(width, hashes, reach), kinds)
    # told apart by their text, so that copies need not be taken out, which could shuffle the texts
    ends = base.select(F.xxhash64("text").alias("doc_id"), "text").mapInArrow(_keys(width, hashes), "key long, doc_id long")
    ends = ends.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).filter("a <> z").select("key")
    ends = _staged(ends, "ends")  # so that a crowded key's side of the join can be split
    shared = _staged(windows.join(ends, "key"), "shared")
    # windows that are alike around their minimum, under the first one
    classes = shared.groupBy("key", "like").agg(F.min(F.struct("doc_id", "c", "d", "l", "r")).alias("first"), F.max("doc_id").alias("z"))
    classes = _staged(classes.select("key", "like", "first.*", "z"), "classes")
    first = classes.filter("doc_id <> z").select(
        "key", "like", F.col("doc_id").alias("a"), F.col("l").alias("la"), F.col("r").alias("ra")
    )
    within = shared.join(first, ["key", "like"]).filter("doc_id <> a").select(
        "a", F.col("doc_id").alias("b"), "la", "ra", F.col("l").alias("lb"), F.col("r").alias("rb")
    )
    # classes of one key against one another: a few in all pairs, more by the shingles around them
    several = classes.groupBy("key").agg(F.min("doc_id").alias("y"), F.max("doc_id").alias("v"), F.count(F.lit(1)).alias("n"))
    several = _staged(classes.join(several.filter("y <> v").select("key", "n"), "key").drop("z"), "several")
    few, many = several.filter(F.col("n") <= FEW), several.filter(F.col("n") > FEW).drop("n")
    sides = [few.select("key", F.col("doc_id").alias(x), F.col("l").alias(f"l{x}"), F.col("r").alias(f"r{x}")) for x in "ab"]
    pairs = sides[0].join(sides[1], "key").filter("a < b").select(*_LINK)
    wanted = blocks.dealt(many, "key", "like", block).groupBy("doc_id").agg(F.collect_list(F.struct(*_WANTED)).alias("wanted"))
    members = base.join(wanted, "doc_id").select("doc_id", "wanted", "text").mapInArrow(
        _contents(reach), "doc_id long, key long, like long, c int, d int, l int, r int, own int, p int, q int, shingles binary"
    )
    meet = ["key", "p", "q"]
    members = members.repartition(*meet).sortWithinPartitions(*meet, "doc_id", "c")
    between = _staged(members.mapInArrow(_links(width, similarity, reach), "a long, b long, la int, ra int, lb int, rb int"), "between")
    hits = within.unionByName(pairs).unionByName(between).groupBy("a", "b").agg(
        F.collect_set(F.struct("la", "ra", "lb", "rb")).alias("hits")
    )
    regions = _staged(hits.mapInArrow(_regions, ", ".join(f"{c} long" for c in _REGION)), "regions")
    # the shingles of a's side travel to b's text; a representative of many classes can be split
    parts = regions.join(base, regions["a"] == base["doc_id"]).select(*_REGION, "text").mapInArrow(
        _parts, ", ".join(f"{c} long" for c in _REGION) + ", shingles binary"
    )
    found = _staged(
        parts.join(base, parts["b"] == base["doc_id"]).select(*_REGION, "shingles", "text").mapInArrow(
            _verified(width, similarity),
            "a long, b long, a_start long, a_end long, b_start long, b_end long, similarity double",
        ),
        "passages",
    )
    names = ["doc_id", "other_id", "start", "end", "other_start", "other_end", "similarity"]
    there = found.select("b", "a", "b_start", "b_end", "a_start", "a_end", "similarity").toDF(*names)
    back = found.select("a", "b", "a_start", "a_end", "b_start", "b_end", "similarity").toDF(*names)
    # copies, whole
    united = base.withColumn("unit", F.unhex(F.md5("text")))
    sized = united.join(copies, ["doc_id", "unit"]).select("doc_id", "first", "text").mapInArrow(
        _sizes, "doc_id long, first long, n long"
    )
    sized = sized.distinct().filter(F.col("n") >= passage)
    zero, one = F.lit(0).cast("long"), F.lit(1.0)
    whole = sized.select("doc_id", "first", zero, "n", zero, "n", one).toDF(*names)
    first = sized.select("first", "doc_id", zero, "n", zero, "n", one).toDF(*names)
    return there.unionByName(back).unionByName(whole).unionByName(first).distinct()
