"""Quality rules: document statistics, fixed base rules and gradient-boosted
trees with monotonic constraints.

``statistics`` derives per-document numbers from whole texts in one vectorised
pass. ``fit`` trains the trees on a bounded sample of labelled documents
(``max_rows``, by hash order of the id), and the trees are flattened into numpy
node arrays that ``judge`` walks for whole batches at once.

Defined cases: a null or empty text has zero words and fails the base rule;
repeated rows each get their own (equal) row; an empty table gives no rows;
other columns are ignored. Without labelled rows of both classes the verdict
is the base rule alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm import textbytes as tb
from clicklens.llm.exchange import ready

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_chars", "n_lines", "n_distinct_words", "n_ends"]
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
ENDS = np.zeros(256, dtype=bool)
ENDS[np.frombuffer(b".!?", dtype=np.uint8)] = True
NOT_NEWLINE = np.ones(256, dtype=bool)
NOT_NEWLINE[10] = False

# features of the trees, with the direction in which quality may move
FEATURES = {
    "words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1,
    "distinct": 0, "line_words": 0, "ends": 0,
}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SAMPLE_ROWS = 20_000


def chunk_statistics(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All counts for the documents of one chunk."""
    n = len(offsets) - 1
    start, end, doc = tb.words(buf, offsets, ~tb.IS_SPACE)
    at = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # code points before each byte
    syms = np.concatenate([[0], np.cumsum(SYMBOLS[buf])])
    rng = tb.RangeHash(buf)
    out = {"n_words": tb.per_doc(doc, n), "word_chars": tb.per_doc(doc, n, at[end] - at[start])}
    out["n_symbols"] = syms[offsets[1:]] - syms[offsets[:-1]]
    out["n_chars"] = at[offsets[1:]] - at[offsets[:-1]]
    out["n_ends"] = tb.per_doc(doc, n, ENDS[buf[end - 1]]) if len(end) else np.zeros(n, np.int64)
    salt = tb.mix(np.arange(1, n + 1, dtype=np.uint64))

    ls, le, ld = tb.words(buf, offsets, NOT_NEWLINE)
    worded = np.searchsorted(start, le) > np.searchsorted(start, ls)
    ls, le, ld = ls[worded], le[worded], ld[worded]
    out["n_lines"] = tb.per_doc(ld, n)
    out["n_dup_lines"] = out["n_lines"] - _distinct(rng(ls, le) ^ salt[ld], ld, n)

    word = rng(start, end)
    out["n_distinct_words"] = _distinct(word ^ salt[doc], doc, n)
    marked = np.zeros(len(word) + 2, dtype=bool)
    if len(word) > 2:
        same = np.flatnonzero(doc[2:] == doc[:-2])
        key = tb.mix(word[same] + tb.mix(word[same + 1] + tb.mix(word[same + 2] + salt[doc[same]])))
        order = np.argsort(key, kind="stable")
        key = key[order]
        equal = key[1:] == key[:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        at3 = same[order[twice]]
        for k in range(3):
            marked[at3 + k] = True
    out["n_repeat_words"] = tb.per_doc(doc[marked[: len(word)]], n)
    return {k: v.astype(np.int64) for k, v in out.items()}


def _distinct(key: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    order = np.argsort(key, kind="stable")
    return tb.per_doc(doc[order[tb.runs(key[order])]], n)


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    words = np.maximum(s["n_words"], 1).astype(float)
    lines = np.maximum(s["n_lines"], 1).astype(float)
    return np.column_stack([
        np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / np.maximum(s["n_chars"], 1),
        s["n_dup_lines"] / lines, s["n_repeat_words"] / words, s["n_distinct_words"] / words,
        np.log1p(s["n_words"] / lines), s["n_ends"] / words,
    ])


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and all counts per row of ``docs``."""
    ready(docs.sparkSession)
    names = [*COUNTS, *EXTRA]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                s = chunk_statistics(buf, offsets)
                ids = batch.column(0).slice(at, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(s[k]) for k in names)], names=["doc_id", *names])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{k} long" for k in names))


def base_failed(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


@dataclass(frozen=True)
class Trees:
    """Flattened trees: node arrays, a root per tree; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        node = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            right = x[rows, self.feature[node]] > self.threshold[node]
            node = np.where(right, self.right[node], self.left[node])
        return 1 / (1 + np.exp(-(self.bias + self.value[node].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64,
              min_rows: int = 20, ridge: float = 1.0) -> Trees:
    """Histogram gradient boosting of the logistic loss. A split on a feature
    with a direction must order its children's values that way, and the values
    below stay on their side of the split's middle."""
    directions = list(FEATURES.values())
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(p0 / (1 - p0)))
    raw = np.full(len(y), bias)
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

    def add(value: float) -> int:
        k = len(nodes["value"])
        for name, v in (("feature", 0), ("threshold", np.inf), ("left", k), ("right", k), ("value", value)):
            nodes[name].append(v)
        return k

    def grow(rows, g, h, low, high, level) -> int:
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
        me = add(rate * value)
        if level == depth or len(rows) < 2 * min_rows:
            raw[rows] += rate * value
            return me
        total_g, total_h, best = g[rows].sum(), h[rows].sum(), None
        parent = total_g**2 / (total_h + ridge)
        for j, e in enumerate(edges):
            if not len(e):
                continue
            c = code[rows, j]
            gl = np.cumsum(np.bincount(c, g[rows], len(e) + 1))[:-1]
            hl = np.cumsum(np.bincount(c, h[rows], len(e) + 1))[:-1]
            nl = np.cumsum(np.bincount(c, minlength=len(e) + 1))[:-1]
            vl, vr = -gl / (hl + ridge), -(total_g - gl) / (total_h - hl + ridge)
            gain = gl**2 / (hl + ridge) + (total_g - gl) ** 2 / (total_h - hl + ridge) - parent
            ok = (nl >= min_rows) & (len(rows) - nl >= min_rows)
            if directions[j]:
                ok &= directions[j] * (vr - vl) >= 0
            gain = np.where(ok, gain, 0)
            k = int(gain.argmax())
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = (gain[k], j, k, vl[k], vr[k])
        if best is None:
            raw[rows] += rate * value
            return me
        _, j, k, vl, vr = best
        middle = float(np.clip((vl + vr) / 2, low, high))
        below, above = (low, high), (low, high)
        if directions[j] > 0:
            below, above = (low, middle), (middle, high)
        elif directions[j] < 0:
            below, above = (middle, high), (low, middle)
        goes = code[rows, j] > k
        left = grow(rows[~goes], g, h, *below, level + 1)
        right = grow(rows[goes], g, h, *above, level + 1)
        for name, v in (("feature", j), ("threshold", float(edges[j][k])), ("left", left), ("right", right)):
            nodes[name][me] = v
        return me

    roots, everyone = [], np.arange(len(y))
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-raw))
        roots.append(grow(everyone, p - y, np.maximum(p * (1 - p), 1e-6), -4.0, 4.0, 0))
    return Trees(np.array(nodes["feature"]), np.array(nodes["threshold"]), np.array(nodes["left"]),
                 np.array(nodes["right"]), np.array(nodes["value"]), np.array(roots), depth, bias)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> Trees | None:
    """Train on at most ``max_rows`` labelled documents, the first by hash of
    their id; the sampled ids are broadcast under that bound."""
    sample = (labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
              .where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = statistics(docs.select(F.col("doc_id").cast("long"), "text").join(
        F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")).join(F.broadcast(sample), "doc_id").orderBy(
        F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(max_rows).toPandas()
    if rows["quality"].nunique() < 2:
        return None
    return fit_trees(features({k: rows[k].to_numpy() for k in [*COUNTS, *EXTRA]}), rows["quality"].to_numpy(float))


def judge(docs: DataFrame, trees: Trees | None, threshold: float = 0.5) -> DataFrame:
    """Counts, ``base_failed``, ``score`` and ``kept`` per row of ``docs``."""
    ready(docs.sparkSession)
    names = ["doc_id", *COUNTS, "base_failed", "kept", "score"]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                s = chunk_statistics(buf, offsets)
                failed = base_failed(s["n_words"], s["n_repeat_words"])
                score = np.where(failed, 0.0, 1.0) if trees is None else trees.score(features(s))
                ids = batch.column(0).slice(at, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(s[k]) for k in COUNTS), pa.array(failed), pa.array(~failed & (score >= threshold)),
                     pa.array(score)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{k} long" for k in COUNTS) + ", base_failed boolean, kept boolean, score double")
