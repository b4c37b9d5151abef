"""Fast similarity sketches, and near duplicates against brute force."""

import random
import re

import numpy as np
import pytest

from clicklens.llm import minhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, node string, key long, n_shingles int"


def shingle_set(text, k):
    w = [x for x in re.split("[ \t-\r]+", (text or "").translate(LOWER)) if x]
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows, k=2, percent=80):
    """doc_id, set size, component, kept of every row, sorted."""
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = low.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, c is None if d is None or c is None else d == c))
    return sorted(out, key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame([(d, t, "clash", 3, 9) for d, t in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, minhash.near_duplicates(df, **more).collect()), key=str)


def varied(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    sizes, sims = [1, 2, 3, 7, 50, 400, 1000], [0.0, 0.3, 0.6, 0.8, 0.95, 1.0]
    key = np.concatenate([base[:s] for s in sizes])
    got = minhash.sketch(key, np.repeat(np.arange(len(sizes)), sizes), len(sizes))
    assert (got != np.uint64(2**64 - 1)).all()
    for n in (40, 1000):
        for s in sims:
            same = round(n * 2 * s / (1 + s))
            other = rng.integers(0, 2**63, n).astype(np.uint64)
            both = np.concatenate([base[:n], base[:same], other[same:]])
            x, y = minhash.sketch(both, np.repeat([0, 1], n), 2)
            truth = same / (2 * n - same)
            assert abs((x == y).mean() - truth) < 6 * np.sqrt(max(truth * (1 - truth), 0) / minhash.BINS) + 1e-9
    empty = minhash.sketch(np.zeros(0, np.uint64), np.zeros(0, np.int64), 2)
    assert (empty == np.uint64(2**64 - 1)).all()


def test_edges(spark):
    a = " ".join(f"w{i}" for i in range(60))
    rows = [(0, None), (1, ""), (2, " \n"), (3, "a"), (4, "A"), (5, "a b"), (6, a), (7, a.upper()), (7, a + " x"), (7, "other words here"),
            (8, a), (8, a), (None, a + " y"), (None, "only null"), (None, "only null"), (None, None), (9, "x" * 50_000), (10, "b c " * 9000)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, rows[:3]) == brute(rows[:3])


@pytest.mark.parametrize("k,percent", [(2, 80), (5, 80)])
def test_random_families_match_brute_force(spark, k, percent):
    """Families from copies to half-similar texts, chains, and shared passages."""
    rng, rows = random.Random(k), []
    for f in range(25):
        base = [f"f{f}w{rng.randrange(400)}" for _ in range(rng.choice([2, 8, 30, 120]))]
        words = base
        for _ in range(rng.choice([1, 3, 12])):
            rows.append((len(rows), varied(rng, words, rng.choice([0, 0, 1, len(base) // 12, len(base) // 9, len(base) // 5]))))
            if f % 3 == 0:
                words = rows[-1][1].split()  # each differs from the one before
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(len(rows) + i, passage + " " + " ".join(f"s{i}x{j}" for j in range(rng.choice([5, 20, 60])))) for i in range(80)]
    assert run(spark, rows, k=k, percent=percent) == brute(rows, k, percent)


def test_a_third_of_the_rows_in_one_family(spark, monkeypatch):
    """Many cells and leader slots; links outside the leader's reach are kept."""
    for name in ("LEADER_ROWS", "CELL_ROWS"):
        monkeypatch.setattr(minhash, name, 8)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(50)]
    rows = [(i, varied(rng, base, rng.choice([1, 2, 3, 4, 5]))) for i in range(150)] + [(1000 + i, f"lone text {i} of few words") for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_cells_emit_a_forest():
    texts = [" ".join(f"w{i}" for i in range(40)) + f" {t}" for t in "abcdefgh"]
    links = list(minhash.cell_links(texts, np.arange(8), np.zeros(8, bool), 2, 80))
    assert len(links) == 7
    assert list(minhash.cell_links(texts, np.arange(8), np.arange(8) < 7, 2, 80)) == [(7, 0)] + [(7, i) for i in range(1, 7)]
    assert list(minhash.cell_links(texts, np.zeros(8, int), np.zeros(8, bool), 2, 80)) == []


def test_links_of_many_bands_cost_one_edge(spark):
    """Pairs that many bands share meet once, and families merge by one edge."""
    bands = [(key, node, node % 4) for key in range(1000, 1040) for node in range(1, 13) if node != key % 12 + 2]
    rest = minhash.open_bands(spark.createDataFrame([b[:2] for b in bands], "key long, node long"),
                              spark.createDataFrame([(n, n % 4) for n in range(1, 13)], "node long, family long"))
    assert {r.lo for r in rest.collect()} == {1} and rest.select("key").distinct().count() == 12
    met = minhash.overlapping(rest).collect()
    assert sorted((r.key, r.node, r.family) for r in met) == [(1, n, n % 4) for n in range(1, 13)]
    apart = [(k, 1 if n == 0 else 10 * k + n) for k in (5, 6, 7, 8) for n in range(3)]
    rest = minhash.open_bands(spark.createDataFrame(apart, "key long, node long"),
                              spark.createDataFrame(sorted({(n, n) for _, n in apart}), "node long, family long"))
    assert {r.key for r in minhash.overlapping(rest).collect()} == {5, 6, 7, 8}
    families = spark.createDataFrame([(n, n // 10) for n in range(40)], "node long, family long")
    links = spark.createDataFrame([(a, b) for a in range(10) for b in range(10, 20)], "a long, b long")
    kept, seen = minhash.components, []
    try:
        minhash.components = lambda e: seen.append(e.count()) or kept(e)
        got = {r.node: r.family for r in minhash.absorb(families, links).collect()}
    finally:
        minhash.components = kept
    assert seen == [1] and got == {n: 0 if n < 20 else n // 10 for n in range(40)}
