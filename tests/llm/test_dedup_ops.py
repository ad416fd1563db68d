"""Near-duplicates, repeats and benchmark leaks against brute force on small tables."""

import collections
import random
import time
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from millpond.llm import decontamination, embedding_dedup, simhash, substring_dedup, suffix_dedup
from millpond.llm.components import components


def groups_of(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            low = min(label[i], label[j])
            changed |= label[i] != label[j]
            label[i] = label[j] = low
    return label


def test_components(spark):
    random_ = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(random_.randrange(100, 300), random_.randrange(100, 300)) for _ in range(120)] + [(5, 5)]
    frame = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    label = groups_of(301, links)
    got = {r.id: r.component_id for r in components(frame).collect()}
    assert got == {i: label[i] for x in links if x[0] != x[1] for i in x}
    assert components(frame.filter("false")).count() == 0


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text).translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark, docs, monkeypatch):
    random_ = random.Random(4)
    base = [" ".join(random_.choice("abcdefgh") * random_.randint(1, 3) for _ in range(80)) for _ in range(12)]
    texts = [None, "", "  \t", "One", "one two", "\x1cx y\x85z É", *base]
    for _ in range(90):
        words = random_.choice(base).split(" ")
        words[random_.randrange(80)] = "zz"
        texts.append(" ".join(words).upper())
    texts += texts[10:14]
    rows = list(enumerate(texts)) + [(None, base[0])]
    prints = [plain_fingerprint(t or "") for _, t in rows]
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    label = groups_of(len(texts), linked)
    monkeypatch.setattr(simhash, "_SMALL", 3)
    for block in (4096, 6):
        found = simhash.near_duplicates(docs(rows), block=block).collect()
        assert len(found) == len(rows)
        for r in found:
            i = r.doc_id if r.doc_id is not None else len(texts)
            assert r.fingerprint % 2**64 == prints[i]
            assert r.component_id == (label[i] if r.doc_id is not None else label[6])
    assert simhash.near_duplicates(docs([])).count() == 0


def test_every_close_half_meets_at_an_anchor():
    random_ = np.random.default_rng(3)
    halves = random_.integers(0, 1 << 32, 200, dtype=np.uint64)
    for bit in (None, 0, 7, 30, 31):
        other = halves if bit is None else halves ^ np.uint64(1 << bit)
        sets = [collections.defaultdict(set), collections.defaultdict(set)]
        for table, x in zip(sets, (halves, other)):
            for row, anchor in zip(*simhash.anchors(x)):
                table[row].add(anchor)
        assert all(sets[0][i] & sets[1][i] for i in range(200))


def test_one_row_per_group(spark):
    schema = "doc_id long, text string, component_id string"
    rows = [(3, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "y"), (7, "q r s t u v", "z"), (None, "a b c d", "n")]
    kept = simhash.one_per_group(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([rows[1], rows[3], rows[4]], key=repr)


def test_embedding_links_and_components(spark, monkeypatch):
    random_ = np.random.default_rng(6)
    base = random_.normal(size=(25, 16))
    vectors = [v + random_.normal(size=16) * s for v in base for s in (0, 0.02, 0.04, 0.06, 0.08, 0.1, 0.12, 0.0)]
    rows = [(i * 3, [float(x) for x in v], i % 2 if i > 60 else 1) for i, v in enumerate(vectors)]
    rows += [(901, None, 1), (902, [], 1), (903, [0.0] * 16, 1), (904, [float("nan")] * 16, 1), (905, [None] * 16, 1), (906, rows[0][1], None),
             (907, [float("inf")] + [1.0] * 15, 1), (908, rows[0][1][:8], 1), (0, rows[0][1], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    good = [i for i, r in enumerate(rows) if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in good}
    linked = [(i, j) for i in good for j in good if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98]
    degree = collections.Counter(x for pair in linked for x in pair)
    label = groups_of(len(rows), linked)
    least = {}
    for i in range(len(rows)):
        least[label[i]] = min(least.get(label[i], 10**9), rows[i][0])
    want = sorted((rows[i][0], degree[i], least[label[i]], rows[i][0] == least[label[i]]) for i in range(len(rows)))
    for block in (1024, 7):
        found = embedding_dedup.near_duplicates(frame, block=block)
        assert sorted(map(tuple, found.collect())) == want


def plain_tiles_cover(doc, item, least):
    """Words of the item that greedy tiling covers, by trying all pairs of positions."""
    used_doc, used_item = set(), set()
    while True:
        best = (0, 0, 0)
        for p in range(len(doc)):
            for q in range(len(item)):
                k = 0
                while p + k < len(doc) and q + k < len(item) and doc[p + k] == item[q + k] and p + k not in used_doc and q + k not in used_item:
                    k += 1
                if k > best[0]:
                    best = (k, p, q)
        if best[0] < least:
            return len(used_item)
        used_doc |= set(range(best[1], best[1] + best[0]))
        used_item |= set(range(best[2], best[2] + best[0]))


def test_tiling_covers_what_greedy_tiling_covers():
    random_ = random.Random(8)
    for _ in range(60):
        item = [random_.randrange(12) for _ in range(30)]
        doc = item[15:] + [99] + item[:15] if random_.random() < 0.3 else [random_.randrange(12) for _ in range(20)] + item[random_.randrange(20) :][:12]
        found = decontamination.tiles(doc, item, 3)
        assert all(doc[p : p + k] == item[q : q + k] and k >= 3 for p, q, k in found)
        for side in (0, 1):
            spots = [t[side] + i for t in found for i in range(t[2])]
            assert len(spots) == len(set(spots))
        assert abs(sum(t[2] for t in found) - plain_tiles_cover(doc, item, 3)) <= 2  # ties may fall differently


def test_leaks_are_found_in_any_order(spark, docs):
    random_ = random.Random(9)
    words = lambda n: [f"w{random_.randrange(5000)}" for _ in range(n)]
    items = [words(30) for _ in range(5)] + [["too", "short"]]
    rows = [
        (1, " ".join(words(40) + items[0] + words(40))),
        (2, " ".join(items[1][15:] + words(9) + items[1][:15]).upper() + "!"),
        (3, ", ".join(items[2][:12] + words(50))),
        (4, " ".join(words(200))), (5, None), (6, ""), (7, "too short"), (1, " ".join(items[3])), (None, " ".join(items[3])),
    ]
    schema = "item_id long, text string"
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(9, None), (None, "a b c d e f")], schema)
    found = decontamination.contaminated(docs(rows), benchmark)
    assert {(r.doc_id, r.item_id): round(r.coverage, 3) for r in found.collect()} == {(1, 0): 1.0, (2, 1): 1.0, (1, 3): 1.0}
    kept = decontamination.without_contaminated(docs(rows), benchmark).select("doc_id").collect()
    assert sorted((r[0] for r in kept), key=repr) == sorted([3, 4, 5, 6, 7, None], key=repr)
    capitals = "İSTANBUL'DA İYİ BİR GÜN ΟΔΟΣ ΣΟΦΟΣ ΛΟΓΟΣ İZMİR İLE ΚΟΣΜΟΣ ΤΕΛΟΣ ÉCOLE STRASSE"
    item = spark.createDataFrame([(1, capitals)], schema)
    leaked = decontamination.contaminated(docs([(1, f"x y {capitals} z"), (2, "İSTANBUL ΟΔΟΣ")]), item).collect()
    assert [(r.doc_id, r.coverage) for r in leaked] == [(1, 1.0)]
    assert decontamination.contaminated(docs([]), benchmark).count() == 0
    assert decontamination.contaminated(docs(rows), benchmark.filter("false")).count() == 0


def plain_repeats(rows, width, first):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.defaultdict(list)
    for k in sorted(range(len(texts)), key=lambda k: (texts[k][0] is None, texts[k][0] or 0)):
        for p in range(len(texts[k][1]) - width + 1):
            seen[texts[k][1][p : p + width]].append((k, p))
    out = []
    for k, (i, t) in enumerate(texts):
        gone = [0] * len(t)
        for p in range(len(t) - width + 1):
            at = seen[t[p : p + width]]
            if at[0] != (k, p) if first else len(at) > 1:
                gone[p : p + width] = [1] * width
        runs = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, bytes(c for c, g in zip(t, gone) if not g), len(t), sum(gone), runs))
    return sorted(out, key=repr)


def test_exact_repeats_by_brute_force(docs):
    random_ = random.Random(3)
    parts = ["".join(random_.choice("abcdé ") for _ in range(random_.randint(8, 40))) for _ in range(6)]
    text = lambda: "".join(random_.choice(parts) if random_.random() < 0.7 else random_.choice("xyz") * random_.randint(1, 9) for _ in range(random_.randint(0, 20)))
    rows = [(i, text()) for i in range(40)] + [(100, "ab" * 200), (101, "ab" * 150), (102, None), (103, "")]
    more = [*rows, (None, "q" * 90), (None, rows[3][1]), (5, rows[5][1])]
    for width, block, first, table in ((20, 4096, False, more), (33, 3, False, more), (20, 3, True, rows), (33, 4096, True, rows)):
        found = suffix_dedup.without_repeats(docs(table), width, block, first).collect()
        got = sorted(((r[0], bytes(r[1]), *r[2:]) for r in found), key=repr)
        assert got == plain_repeats(table, width, first)
    assert suffix_dedup.without_repeats(docs([])).count() == 0


def test_longest_factors_by_brute_force():
    random_ = random.Random(7)
    for _ in range(20):
        text = "".join(random_.choice("ab") for _ in range(25))
        order = sorted(range(25), key=lambda i: text[i:])
        common = lambda i, j: next((k for k in range(25) if text[i + k : i + k + 1] != text[j + k : j + k + 1] or i + k >= 25 or j + k >= 25), 25)
        earlier, later = suffix_dedup.longest_factors(order, [common(a, b) for a, b in zip(order, order[1:])])
        for r, i in enumerate(order):
            assert earlier[r] == max((common(i, j) for j in range(i)), default=0)
            assert later[r] == max((common(i, j) for j in range(i + 1, 25)), default=0)


def test_compact_windows_hold_every_subsequence():
    random_ = np.random.default_rng(2)
    values = random_.integers(0, 30, 60, dtype=np.uint64)
    rows = np.repeat([0, 1, 2], [30, 25, 5])
    index, first, last, value = substring_dedup.compact_windows(values, rows, 1, 6)
    seen = collections.Counter()
    hashes = {}
    for c, low, high, v in zip(index, first, last, value):
        for a in range(low, c + 1):
            for b in range(max(c, a + 5), high + 1):
                seen[a, b] += 1
                hashes[a, b] = v
    every = [(a, b) for a in range(60) for b in range(a + 5, 60) if rows[a] == rows[b]]
    assert set(seen) == set(every) and set(seen.values()) == {1}
    of = lambda x: substring_dedup.compact_windows(np.array([x] * 6, np.uint64), np.zeros(6, np.int64), 1, 6)[3][0]
    table = {int(x): of(x) for x in np.unique(values)}
    assert all(hashes[a, b] >> np.uint64(32) == min(table[int(x)] for x in values[a : b + 1]) >> np.uint64(32) for a, b in every)


def test_passages_are_found_and_clean_texts_left(docs):
    random_ = random.Random(5)
    words = lambda n: [f"w{random_.randrange(40000)}" for _ in range(n)]
    passage, whole = words(70), words(200)
    edited = [*passage[:35], "changed", *passage[36:]]
    rows = [(i, " ".join(words(50) + passage + words(50))) for i in range(5)]
    rows += [(10, " ".join(words(30) + edited)), (11, " ".join(whole)), (12, " ".join(whole)), (12, " ".join(whole)), (13, " ".join(words(300))),
             (14, " ".join(words(60) + passage[:20] + words(60))), (15, None), (16, ""), (17, "a b"), (18, "a b"), (None, " ".join(whole))]
    # a passage that repeats within one document only
    rows.append((19, " ".join((x := words(80)) + ["and"] + x)))
    found = substring_dedup.repeated_passages(docs(rows)).collect()
    assert {r.doc_id for r in found} == {0, 1, 2, 3, 4, 10, 11, 12}
    spans = {(r.doc_id, r.other_id): r for r in found}
    assert abs(spans[3, 0].start - 50) <= 3 and abs(spans[3, 0].end - 120) <= 3 and spans[3, 0].similarity >= 0.8
    assert (10, 0) in spans and spans[12, 11].similarity == 1.0 and spans[12, 11].end == 200
    assert all((r.other_id, r.doc_id) in spans for r in found)
    assert substring_dedup.repeated_passages(docs([])).count() == 0


def test_passages_are_found_beside_a_smaller_document_with_their_minimum(docs):
    random_ = random.Random(12)
    words = lambda n: [f"w{random_.randrange(40000)}" for _ in range(n)]
    passages = [words(70) for _ in range(3)]
    # smaller documents quote every few words of the passages between words of their own
    quotes = [" ".join(sum((words(60) + p[k : k + 12] for k in range(i, 70, 8)), words(60))) for i in (0, 4) for p in passages]
    rows = list(enumerate(quotes))
    rows += [(100 * k + i, " ".join(words(40) + p + words(40))) for k, p in enumerate(passages, 5) for i in (0, 1, 2)]
    want = {(100 * k + i, 100 * k + j) for k in (5, 6, 7) for i in (0, 1, 2) for j in (0, 1, 2) if i != j}
    for block in (1024, 2):
        found = {(r.doc_id, r.other_id) for r in substring_dedup.repeated_passages(docs(rows), block=block).collect()}
        assert found <= want and {x for pair in found for x in pair} == {x for pair in want for x in pair}
        label = groups_of(800, found)
        assert all(label[i] == label[j] for i, j in want)


def test_a_pair_of_windows_joins_all_regions_it_overlaps():
    # (b first, b last, a first, a last); the third lies over the first two, the fourth apart on a
    hits = [(0, 60, 0, 60), (10, 70, 100, 160), (20, 90, 50, 110), (30, 80, 300, 350), (200, 260, 0, 60)]
    assert sorted(substring_dedup.candidates(hits)) == [(0, 60, 200, 260), (0, 160, 0, 90), (300, 350, 30, 80)]


def test_a_similar_passage_is_rarely_missed():
    # every shared min-hash leads to verification: a pair is missed if none of them agrees
    assert (1 - substring_dedup.SIMILARITY) ** substring_dedup.HASHES < 1e-4


def test_embedding_recall_at_every_width_and_magnitude(spark):
    """Pairs just above the threshold are found at 3 to 256 components, however long the vectors are."""
    random_ = np.random.default_rng(9)
    rows, pairs = [], []
    for k, (size, length) in enumerate([(3, 1.0), (8, 1.0), (16, 1e-200), (16, 1.0), (64, 1e200), (64, 1.0), (256, 1.0)]):
        for i in range(120):
            a = random_.normal(size=size)
            a /= np.linalg.norm(a)
            side = random_.normal(size=size)
            side -= (side @ a) * a
            b = 0.9805 * a + np.sqrt(1 - 0.9805**2) * side / np.linalg.norm(side)
            at = 10_000 * k + 2 * i
            label = 1000 * k + i if size < 16 else k  # few directions lie near others by chance
            rows += [(at, (a * length).tolist(), label), (at + 1, (b * length).tolist(), label)]
            pairs.append((k, at))
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    hit = collections.Counter(k for k, at in pairs if found[at + 1].component_id == found[at].component_id)
    assert len(hit) == 7 and min(hit.values()) >= 0.95 * 120
    assert max(r.n_links for r in found.values()) == 1


def test_ids_of_several_texts_keep_them(spark):
    rows = [(1, "a b c d e f g"), (1, "q r s t u v w"), (1, "a b c d e f g"), (2, "a b c d e f g")]
    kept = simhash.one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == sorted(rows[:2])


def best_jaccard(a, b, width):
    """Largest similarity of two runs of ``width`` shingles, by trying all."""
    runs = lambda x: [set(x[k : k + width]) for k in range(len(x) - width + 1)]
    return max((len(x & y) / len(x | y) for x in runs(a) for y in runs(b)), default=0.0)


def test_passages_recall_by_brute_force(docs):
    random_ = random.Random(21)
    words = lambda n: [f"w{random_.randrange(40000)}" for _ in range(n)]
    rows = []
    for k in range(40):
        passage = words(random_.randint(50, 70))
        for _ in range(2):
            edited = list(passage)
            for at in random_.sample(range(3, len(edited) - 3), random_.randint(0, 1)):
                edited[at : at + 1] = words(random_.randint(0, 2))
            rows.append((len(rows), " ".join(words(20) + edited + words(20))))
    shingles = [[tuple(x[k : k + 5]) for k in range(len(x) - 4)] for x in (t.split() for _, t in rows)]
    shared = {(i, j): len(set(shingles[i]) & set(shingles[j])) for i in range(len(rows)) for j in range(i)}
    best = {(i, j): best_jaccard(shingles[i], shingles[j], 46) if n > 30 else 0.0 for (i, j), n in shared.items()}
    want = {pair for pair, score in best.items() if score >= 0.8}
    found = {(r.doc_id, r.other_id) for r in substring_dedup.repeated_passages(docs(rows)).collect() if r.doc_id > r.other_id}
    assert len(want) > 25 and len(found & want) >= 0.9 * len(want)
    assert all(shared[pair] > 30 for pair in found)


def test_windows_of_one_minimum_are_connected_as_by_all_pairs():
    random_ = np.random.default_rng(8)
    width, reach = 46, 58
    for repeats in (False, True):
        base = [random_.integers(0, 4 if repeats else 1 << 30, 117).astype(np.uint32) for _ in range(12)]
        contents = []
        for k in range(60):
            x = base[k % 12].copy()
            x[random_.integers(0, 117, random_.integers(0, 9))] = 2_000_000_000 + k
            x = np.delete(x, random_.integers(0, 117, random_.integers(0, 2))) if k % 3 else x
            contents.append(x[: random_.integers(90, 118)])
        n = len(contents)
        zero = pa.array([0] * n)
        table = pa.record_batch(
            [zero, zero, zero, zero, pa.array(range(n)), pa.array([reach] * n), zero, zero,
             pa.array([x.tobytes() for x in contents], pa.binary())],
            ["key", "p", "q", "own", "doc_id", "c", "l", "r", "shingles"],
        )
        links = [(r["a"], r["b"]) for b in substring_dedup._links(width, 0.8, reach)(iter([table])) for r in b.to_pylist()]
        alike = [(i, j) for i in range(n) for j in range(i) if substring_dedup.passages(contents[j], contents[i], width, 0.8)]
        assert 0 < len(links) < n
        label = groups_of(n, links)
        assert all(label[i] == label[j] for i, j in alike)
        whole = lambda i, j: len(set(contents[i]) & set(contents[j])) / len(set(contents[i]) | set(contents[j]))
        sure = lambda i, j: whole(i, j) >= 0.8 or best_jaccard(contents[i].tolist(), contents[j].tolist(), width) >= 0.8
        assert all((j, i) in set(alike) or sure(i, j) for i, j in links)


def test_a_run_of_equal_words_is_one_window(docs):
    text = lambda n: pa.record_batch([pa.array([7]), pa.array(["of " * n])], ["doc_id", "text"])
    for n in (60, 300):
        rows = pa.Table.from_batches(substring_dedup._windows(46, 6, 58)(iter([text(n)]))).to_pylist()
        assert len(rows) == 6 and all((r["c"], r["d"], r["l"], r["r"]) == (0, r["d"], 0, n - 5) for r in rows)
        assert all(n - 51 <= r["d"] <= n - 5 for r in rows)
    values = np.random.default_rng(4).integers(0, 9, 400, dtype=np.uint64)
    row = np.repeat([0, 1, 2], [200, 150, 50])
    index, first, last, value = substring_dedup.compact_windows(values, row, 1, 6)
    kept, final = substring_dedup.joined(index, first, value, row, 20)
    assert len(kept) < len(index) / 2
    windows = list(zip(first[kept], last[kept], index[kept], final, value[kept]))
    for c, low, high, v in zip(index, first, last, value):
        assert any(a <= low and high <= b and x <= c <= y and v == w for a, b, x, y, w in windows)
    # passages that hold such runs are found, few and many texts to a min-hash
    random_ = random.Random(31)
    words = lambda n: [f"w{random_.randrange(40000)}" for _ in range(n)]
    for copies in (2, 3, 9):
        passages = [words(20) + ["of"] * 25 + words(20), ["de", "la"] * 30, ["the"] * 70]
        rows = [(100 * k + i, " ".join(words(40) + p + words(40))) for k, p in enumerate(passages, 1) for i in range(copies)]
        found = {(r.doc_id, r.other_id) for r in substring_dedup.repeated_passages(docs(rows)).collect()}
        label = groups_of(400, found)
        assert all(label[a] == label[a // 100 * 100] for a, _ in rows)
        assert all(a // 100 == b // 100 for a, b in found)


def test_repeated_passages_shorter_than_what_is_removed_are_reported(docs):
    random_ = random.Random(14)
    words = lambda n: ["".join(random_.choice("abcdefgh") for _ in range(random_.randint(3, 7))) for _ in range(n)]
    rows, want = [], set()
    for k, n in enumerate((40, 49, 52, 55, 60, 80) * 3):
        passage = words(n)
        for _ in range(2):
            want |= {len(rows)} if n > 50 else set()
            rows.append((len(rows), " ".join(words(random_.randint(0, 60)) + passage + words(random_.randint(0, 60)))))
    rows += [(i, " ".join(words(300))) for i in range(100, 110)] + [(110, None), (111, "")]
    copy = " ".join(words(55))
    rows += [(120, copy), (121, copy), (122, "a b"), (123, "a b")]
    assert any(len(t) < 400 for i, t in rows if i in want)
    plain = sorted(((r[0], bytes(r[1]), *r[2:]) for r in suffix_dedup.without_repeats(docs(rows)).collect()), key=repr)
    assert plain == plain_repeats(rows, 400, False)
    for block in (4096, 1):
        found = suffix_dedup.without_repeats(docs(rows), 400, block, passage=50).collect()
        assert {r.doc_id for r in found if r.has_passage} == want | {120, 121}
        assert sorted(((r[0], bytes(r[1]), *r[2:5]) for r in found), key=repr) == plain


def test_windows_of_many_min_hashes_are_linked_all_at_once():
    rng = np.random.default_rng(11)
    width, reach, groups, size = 20, 25, 150, 14
    rows = []
    for key in range(groups):
        base = rng.integers(0, 1 << 32, 2 * reach + 1, dtype=np.uint32)
        for i in range(size):
            content = np.where(rng.random(len(base)) < 0.3, rng.integers(0, 1 << 32, len(base), dtype=np.uint32), base)
            rows.append((key, key * size + i, content))
    n = len(rows)
    columns = {"key": [k for k, _, _ in rows], "doc_id": [d for _, d, _ in rows], "shingles": [x.tobytes() for _, _, x in rows]}
    columns |= {c: [v] * n for c, v in (("own", 0), ("p", 0), ("q", 0), ("c", reach), ("l", 0), ("r", 2 * reach))}
    batch = pa.table(columns).combine_chunks().to_batches()[0]
    run = substring_dedup._links(width, 0.8, reach)
    calls = collections.Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        links = [(r["a"], r["b"]) for b in run(iter([batch])) for r in b.to_pylist()]
    finally:
        sys.setprofile(None)
    assert calls["c_call"] < groups * size * 8  # no steps of its own for each window
    label = groups_of(n, links)
    alike = [
        (i, j) for k in range(groups) for i in range(k * size, k * size + size) for j in range(k * size, i)
        if substring_dedup.passages(rows[j][2], rows[i][2], width, 0.8)
    ]
    assert alike and all(label[i] == label[j] for i, j in alike)
    assert all(i // size == j // size for i, j in links) and len(links) < n


def test_regions_of_one_chain_need_no_sweep(monkeypatch):
    rng = np.random.default_rng(12)
    sweep, swept = substring_dedup.candidates, []
    monkeypatch.setattr(substring_dedup, "candidates", lambda hits: swept.append(hits) or sweep(hits))
    kind = pa.list_(pa.struct([(c, pa.int32()) for c in ("la", "ra", "lb", "rb")]))

    def regions(hits):
        rows = [[dict(zip(("lb", "rb", "la", "ra"), map(int, x), strict=True)) for x in pair] for pair in hits]
        ids = pa.array(range(len(rows)), pa.int64())
        batch = pa.record_batch([ids, ids, pa.array(rows, kind)], ["a", "b", "hits"])
        out = collections.defaultdict(list)
        for r in pa.Table.from_batches(substring_dedup._regions(iter([batch]))).to_pylist():
            out[r["a"]].append(tuple(r[c] for c in ("a_first", "a_last", "b_first", "b_last")))
        return [out[i] for i in range(len(rows))]

    chains = [[(s, s + 50, s + k, s + k + 50) for s in range(0, 40 * k + 1, 20)] for k in range(1, 30)]
    assert regions(chains) == [sweep(pair) for pair in chains] and not swept
    pairs = [[(b, b + 9, a, a + 9) for a, b in rng.integers(0, 60, (int(n), 2))] for n in rng.integers(1, 9, 300)]
    assert regions(pairs) == [sweep([tuple(map(int, x)) for x in pair]) for pair in pairs] and swept


def test_other_texts_of_a_copys_id_are_searched(docs):
    """Document 2 has a text that document 1 has too, and one of its own that document 3 quotes."""
    random_ = random.Random(31)
    words = lambda n: [f"w{random_.randrange(40000)}" for _ in range(n)]
    copied, own = words(90), words(120)
    rows = [(1, " ".join(copied)), (2, " ".join(copied)), (2, " ".join(own)), (3, " ".join(words(40) + own[10:100] + words(40)))]
    found = {(r.doc_id, r.other_id): r for r in substring_dedup.repeated_passages(docs(rows)).collect()}
    assert found.keys() == {(1, 2), (2, 1), (2, 3), (3, 2)}
    assert found[2, 1].end == found[2, 1].other_end == 90
    assert abs(found[2, 3].start - 10) <= 3 and abs(found[3, 2].start - 40) <= 3


def test_a_staged_step_leaves_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, manager = spark.conf.get(name), spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def files():
        blocks = manager.getAllBlocks()
        return {b for b in (blocks.apply(i).toString() for i in range(blocks.size())) if b.startswith("shuffle_")}

    had = files()
    substring_dedup._staged(spark.range(100_000).repartition(3, "id"), "steps")
    for _ in range(100):  # they are removed in the background
        if not files() - had:
            break
        time.sleep(0.1)
    assert not files() - had and spark.conf.get(name) == before


def test_texts_that_are_no_copies_are_kept_without_a_join_of_all(spark):
    """The marks of copied ids leave exactly what an anti join would."""
    base = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 15_000).alias("text"))
    other = spark.createDataFrame([(17_000, "own")], "doc_id long, text string")
    base = base.unionByName(other).withColumn("unit", F.unhex(F.md5("text")))
    copies = base.filter("doc_id >= 15000 AND text <> 'own'").withColumn("first", F.col("doc_id") - 15_000)
    copies = substring_dedup.materialise(copies.select("doc_id", "unit", "first"), "copies")
    left = substring_dedup._without(base.select("doc_id", "text"), copies)
    assert sorted(tuple(r) for r in left.collect()) == sorted([(i, f"t{i}") for i in range(15_000)] + [(17_000, "own")])
    assert substring_dedup._without(base.select("doc_id", "text"), copies.filter("false")).count() == 20_001
