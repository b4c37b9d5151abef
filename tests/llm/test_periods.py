"""Periodic runs against a scan of every lag, and the edge cases."""

import hashlib
import random
import re
import zlib

import pytest

from clicklens.llm import periods, queries

SF = "/root/testdata/sf0.001"


def split(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def looped(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def brute(words):
    """(start, length, period) of all runs, lag by lag."""
    best, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, length, q) for (s, length), q in best.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def compare(df):
    text = {(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()}
    want = {}
    for d, t in text:
        words = split(t)
        runs = brute(words)
        want[d] = (len(words), [tuple(x) for x in runs], collapsed(words, runs))
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periods.find_runs(df).collect()}
    assert got == want
    return got


def test_random_words_over_small_alphabets(spark):
    """Nested, overlapping and adjoining runs of every period up to 300."""
    rng, texts = random.Random(11), []
    for k in range(150):
        words = []
        while len(words) < 700:
            unit = [rng.choice("abcd"[: 1 + k % 4]) + ("é" if k % 5 == 0 else "") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 12, 16, 17, 31, 33, 64, 65, 90]))]
            if rng.random() < 0.3:
                unit = unit * rng.randint(2, 6) + [rng.choice("abcd")]
            words += (unit * rng.randint(1, 6))[: rng.randint(1, 400)]
            words += [rng.choice("abcdxyz") for _ in range(rng.randint(0, 4))]
        texts.append((k, "\n ".join(words)))
    got = compare(spark.createDataFrame(texts, "doc_id long, text string"))
    assert sum(q > 16 for _, runs, _ in got.values() for _, _, q in runs) > 50


def test_edges(spark):
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "a"), (4, "a " * 6), (5, "a " * 5), (6, "a b " * 4), (7, "a b " * 3 + "a"),
            (8, "A a " * 9), (9, "x" * 300_000 + " y" * 9), (10, "w " * 50_000), (11, "é \x00 ü " * 40), (None, "n " * 8),
            (13, " ".join(f"w{i % 5000}" for i in range(20_000))), (14, " ".join(f"w{i % 5001}" for i in range(20_000)))]
    df = spark.createDataFrame([(d, t, 1, "clash", None) for d, t in rows], "doc_id long, text string, start int, runs string, period long")
    got = {r.doc_id: r for r in periods.find_runs(df.repartition(2)).collect()}
    runs = {d: [tuple(x) for x in r.runs] for d, r in got.items()}
    assert runs[0] == runs[1] == runs[2] == runs[3] == runs[5] == runs[7] == [] and got[0].collapsed == got[2].collapsed == ""
    assert runs[4] == [(0, 6, 1)] and got[4].collapsed == "a" and runs[6] == [(0, 8, 2)] and runs[8] == [(0, 18, 2)]
    assert runs[9] == [(1, 9, 1)] and runs[10] == [(0, 50_000, 1)] and runs[11] == [(0, 120, 3)] and runs[None] == [(0, 8, 1)]
    assert runs[13] == [(0, 20_000, 5000)] and len(got[13].collapsed.split()) == 5000 and runs[14] == []
    twice = periods.find_runs(df.where("doc_id = 4").unionByName(df.where("doc_id = 4"))).collect()
    assert len(twice) == 2 and twice[0] == twice[1]


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(rows)
    long = 0
    for d, t in rows:
        words = looped(d, split(t))
        if len(words) > 1500:
            long += 1
            continue  # checked below with the faster scan
        runs = brute(words)
        r = got[d]
        assert r.n_runs == len(runs) and r.n_words == len(words)
        top = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert (r.start, r.length, r.period) == (top or (None,) * 3)
        assert r.exponent_milli == (top and 1000 * top[1] // top[2])
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(collapsed(words, runs))
    assert long < len(rows) and sum(r.n_runs for r in got.values()) > 5


@pytest.mark.parametrize("least", [1500])
def test_long_documents_match_a_lag_scan(spark, least):
    """Documents of more words, every lag by numpy."""
    import numpy as np

    rows = [(r.doc_id, looped(r.doc_id, split(r.text))) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [(d, w) for d, w in rows if len(w) > least]
    rows += [(10**6 + k, (["a"] * 7 + [str(i) for i in range(p)]) * 5 + ["end"]) for k, p in enumerate((50, 121, 500, 505, 1000))]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periods.find_runs(df).collect()}
    for d, words in rows:
        code, best = np.unique(words, return_inverse=True)[1], {}
        for q in range(1, len(words) // 4 + 1):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], (code[q:] == code[:-q]).astype(np.int8), [0]])))
            for s, e in zip(edge[::2], edge[1::2]):
                if e - s + q >= max(6, 4 * q):
                    best.setdefault((int(s), int(e - s + q)), q)
        assert got[d] == sorted((s, n, q) for (s, n), q in best.items()), d
