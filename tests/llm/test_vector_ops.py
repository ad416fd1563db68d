"""Whitening, centroid clustering and sharding against plain versions on small tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millpond.llm import centroid_clustering, folding, sharding, whitening

VECTORS = "vec_id long, embedding array<float>, label int, x string, v string, part int"


@pytest.fixture
def vectors(spark):
    def make(pairs):
        return spark.createDataFrame([(i, None if e is None else [None if c is None else float(c) for c in e], 1, "x", "v", 0) for i, e in pairs], VECTORS)

    return make


def test_payloads_fold_in_order_and_in_levels(spark):
    parts = spark.createDataFrame([(i, b"%d," % i) for i in range(23)], folding.PART)
    assert folding.folded(parts, b"".join, "parts", fan=3) == b"".join(b"%d," % i for i in range(23))
    assert folding.folded(parts.filter("false"), b"".join, "parts") is None


@pytest.mark.parametrize("case", ["plain", "narrow", "dependent", "copies"])
def test_rank_one_updates_keep_the_spectrum(case):
    random_ = np.random.default_rng(5)
    x = np.rint(random_.normal(size=(70, 12)) * np.exp(random_.normal(size=12) * 2) * 20)
    if case == "narrow":
        x[:, 4:] = np.rint(x[:, 4:] / 60)
    if case == "dependent":
        x[:, 3], x[:, 4] = x[:, 2], 7
    if case == "copies":
        x[10:60] = x[0]
    x = x.astype(np.int64)
    one, two = whitening.Spectrum(12), whitening.Spectrum(12)
    one.add(x[:40])
    two.add(x[40:])
    one.meet(two)
    centred = x - x.mean(0)
    scatter = centred.T @ centred
    size = np.abs(scatter).max()
    assert one.n == 70 and one.sums == x.sum(0).tolist()
    assert np.abs(one.values - np.linalg.eigvalsh(scatter)).max() < 1e-12 * size
    assert np.abs(one.basis @ np.diag(one.values) @ one.basis.T - scatter).max() < 1e-12 * size
    assert np.abs(one.basis.T @ one.basis - np.eye(12)).max() < 1e-12


def plain_whitening(pairs, k):
    whole = [(i, np.floor(64 * np.float32(e).astype(float)).astype(np.int64) + 1_000_000) for i, e in pairs]
    fit = np.unique([x for _, x in whole], axis=0)
    n, s = len(fit), fit.sum(0)
    y = (n * fit - s) / n
    values, basis = np.linalg.eigh(y.T @ y / n)
    values, basis = values[::-1], basis[:, ::-1]
    out = [(i, [sum((n * c - t) ** 2 for c, t in zip(x.tolist(), s.tolist()))] + list(((n * x - s) / n) @ basis[:, :k] / np.sqrt(values[:k]))) for i, x in whole]
    return n, values[:k] / values.sum(), out


def test_whitening_equals_a_plain_eigendecomposition(vectors):
    random_ = np.random.default_rng(8)
    good = [(i, random_.normal(size=6) * [1, 0.5, 2, 0.1, 1, 1]) for i in range(80)]
    good += [(100 + i, good[0][1]) for i in range(40)] + [(100, good[3][1]), (None, good[4][1])]
    bad = [(200, None), (201, []), (202, [None] * 6), (203, [np.nan] * 6), (204, [np.inf] * 6), (205, [1.0]), (206, [1e30] * 6)]
    got = whitening.whiten(vectors(good + bad), components=4)
    assert got.schema.simpleString() == "struct<vec_id:bigint,component:int,n:bigint,deviation:bigint,whitened:double,explained:double,identity_error:double>"
    rows = got.collect()
    n, explained, wanted = plain_whitening(good, 4)
    assert len(rows) == 4 * len(good) and {r.n for r in rows} == {n} and {r.component for r in rows} == {1, 2, 3, 4}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    seen = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.vec_id is None, r.vec_id, r.deviation, r.component)):
        seen[r.vec_id, r.deviation].append(r.whitened)
        assert r.explained == pytest.approx(explained[r.component - 1])
    plain = defaultdict(list)
    for i, (deviation, *white) in wanted:
        plain[i, deviation] += white
    assert seen.keys() == plain.keys()
    keys = list(plain)
    a, b = (np.array([m[k][:4] for k in keys]) for m in (seen, plain))
    assert np.abs(a * np.sign((a * b).sum(0)) - b).max() < 1e-9


def test_whitening_without_variance(vectors):
    assert whitening.whiten(vectors([])).count() == 0
    assert whitening.whiten(vectors([(1, None)])).count() == 0
    assert whitening.whiten(vectors([(1, [1, 2]), (2, [1, 2])])).count() == 0
    line = whitening.whiten(vectors([(i, [i, 2 * i, 5]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1)


def test_a_deviation_beyond_a_long_is_null(vectors):
    got = whitening.whiten(vectors([(1, [3e7, 1]), (2, [-3e7, 2]), (3, [2, 5])]), components=1)
    assert {r.vec_id: r.deviation for r in got.collect()}[3] is not None
    assert {r.vec_id: r.deviation for r in got.collect()}[1] is None


def plain_clusters(pairs, k, rounds, width):
    kept = [(i, [int(np.floor(1024 * float(np.float32(c)))) for c in e]) for i, e in pairs]
    digest = lambda p: (p[0] is None, hashlib.sha256(f"3:{p[0]}".encode()).hexdigest(), p[1])
    centres = [v for _, v in sorted(kept, key=digest)[:k]]
    away = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for turn in range(rounds + 1):
        label = [min((away(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        if turn < rounds:
            for j in range(len(centres)):
                own = [v for (_, v), (_, at) in zip(kept, label) if at == j]
                if own:
                    centres[j] = [sum(x) // len(own) for x in zip(*own)]
    inertia = Counter()
    for d, j in label:
        inertia[j] += d
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), text[j]) for (i, _), (d, j) in zip(kept, label))


def test_clusters_equal_plain_rounds(vectors):
    random_ = np.random.default_rng(2)
    centres = random_.normal(size=(9, 5))
    good = [(i, centres[i % 9] + random_.normal(size=5) * 0.05) for i in range(150)]
    good += [(150 + i, good[7][1]) for i in range(60)] + [(3, good[9][1]), (None, good[4][1])]
    good += [(300 + i, np.array([a, b, 0, 0, 0]) / 4) for i, (a, b) in enumerate(np.ndindex(5, 5))]  # many ties
    bad = [(400, None), (401, []), (402, [1] * 4), (403, [np.nan] * 5), (404, [np.inf] * 5), (405, [None] * 5), (406, [1e9] * 5)]
    for k in (1, 8, 23):
        got = centroid_clustering.cluster(vectors(good + bad), clusters=k, rounds=4, width=5)
        assert Counter(tuple(r)[:6] for r in got.collect()) == plain_clusters(good, k, 4, 5)
    few = [(1, [1, 2, 3, 4, 5]), (None, [1, 2, 3, 4, 5])]
    assert Counter(tuple(r)[:6] for r in centroid_clustering.cluster(vectors(few), width=5).collect()) == plain_clusters(few, 8, 10, 5)
    assert centroid_clustering.cluster(vectors(bad), width=5).count() == 0
    assert centroid_clustering.cluster(vectors([]), width=5).count() == 0


def test_the_tree_finds_the_smallest_of_equally_near_centroids():
    random_ = np.random.default_rng(1)
    for spread in (2, 50, 1 << 26):
        centres = random_.integers(-spread, spread + 1, (60, 3))
        points = random_.integers(-spread, spread + 1, (500, 3))
        tree = centroid_clustering.build(centres)
        assert max(len(m) for m in tree.members) <= centroid_clustering.LEAF
        away = ((points[:, None].astype(object) - centres.astype(object)) ** 2).sum(2)
        label, best = centroid_clustering.nearest(tree, points)
        assert best.tolist() == away.min(1).tolist()
        assert label.tolist() == [row.index(min(row)) for row in away.tolist()]


def test_the_search_leaves_far_centroids_out(monkeypatch):
    """Most distances are never computed where the centroids lie apart."""
    grid = np.array(list(np.ndindex(8, 8))) * 1000
    tree, seen = centroid_clustering.build(grid), []
    plain = centroid_clustering.squared
    monkeypatch.setattr(centroid_clustering, "squared", lambda p, c: seen.append(len(p) * len(c)) or plain(p, c))
    centroid_clustering.nearest(tree, grid + 3)
    assert sum(seen) < 0.4 * len(grid) ** 2


DOCS = "doc_id long, text string, shard string, slot string, unit string, r string, n int"


def shards_of(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "s", "t", "u", "r", 1) for i, t in texts], DOCS)
    return sharding.shard_documents(docs, **options)


def lawful(rows, texts, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert sum(sizes) == len(texts) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_are_even_and_keep_copies_together(spark):
    texts = [(i, f"text {i}") for i in range(60)] + [(100 + i, f"copy {i // 3}") for i in range(60)]
    texts += [(200, None), (201, None), (202, ""), (203, ""), (None, "é" * 30_000), (5, "text 5"), (5, "text 5"), (5, "other")]
    rows = shards_of(spark, texts, shards=7).collect()
    lawful(rows, texts, 7)
    where = defaultdict(set)
    for r in rows:
        where[r.unit].add(r.shard)
    assert max(len(v) for k, v in where.items() if k is not None) == 1


def test_a_group_larger_than_a_shard_takes_few(spark):
    texts = [(i, "hot") for i in range(70)] + [(100 + i, f"text {i}") for i in range(80)] + [(300 + i, f"copy {i // 2}") for i in range(30)]
    placed = shards_of(spark, texts, shards=9).cache()
    rows = placed.collect()
    lawful(rows, texts, 9)
    hot = Counter(r.shard for r in rows if r.doc_id < 70)
    assert len(hot) <= 5  # 20 rows a shard; by hash it would be all nine
    found = sharding.cut_links(placed, "unit").first()
    near = sum(n * (n - 1) // 2 for n in hot.values())
    split = sum(len({r.shard for r in rows if r.doc_id in (300 + i, 301 + i)}) > 1 for i in range(0, 30, 2))
    assert found.links == 70 * 69 // 2 + 15 and found.cut == 70 * 69 // 2 - near + split


def test_all_rows_of_one_group_and_few_rows(spark):
    for texts in ([(i, "same") for i in range(50)], [(1, "a")], [(i, f"c {i // 2}") for i in range(120)]):
        lawful(shards_of(spark, texts, shards=8).collect(), texts, 8)
    assert shards_of(spark, []).count() == 0


def test_linked_units_move_together(spark):
    rows = spark.createDataFrame([(i, f"u{i}") for i in range(40)] + [(i, None) for i in range(40, 80)], "id long, unit string")
    links = spark.createDataFrame([(f"u{i}", f"u{i + 1}", 1.0) for i in range(40) if i % 4 < 3] + [("u1", "u1", 1.0), (None, "u2", 1.0)], "a string, b string, weight double")
    placed = sharding.place(rows, "unit", ["id"], shards=8, links=links)
    where = {r.id: r.shard for r in placed.collect()}
    assert sorted(Counter(where.values()).values()) == [10] * 8
    near = sum(where[i] == where[i + 1] for i in range(39) if i % 4 < 3)
    apart = sum(where[i] == where[i + 1] for i in range(39) if i % 4 == 3)
    assert near >= 20 and apart < near / 2
    assert placed.select(F.max("slot")).first()[0] == 9
