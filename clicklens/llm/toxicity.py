"""Toxicity by weak supervision.

1. ``induce``: on a bounded sample of labelled training rows (``LABELLED``, by
   hash order of the id) words and word beginnings are counted by class in
   Spark; the ones with the highest log-odds join a fixed seed list. Terms are
   dealt by rank over ``VOTERS`` voters; a voter votes when one of its terms
   occurs. Further voters are patterns (share of hits among the words).
2. ``vote_table``: the votes of *all* rows, counted by vote pattern (at most
   ``2 ** voters`` rows, whatever the corpus size).
3. ``label_model``: expectation-maximisation estimates each voter's rates under
   both classes and, from the class-conditional correlations of the voters'
   errors, how much of each vote is new; that gives a posterior per pattern.
4. ``train``: logistic regression on the terms' counts, fitted to posterior
   labels of a bounded sample of training rows (a known label is one more,
   nearly certain voter), scores whole texts in vectorised batches.

Labels, language, source and id are never inputs of a score.

Defined cases: null and empty texts have no hits and get the intercept's
score, texts with equal hits score alike (no ties to break); repeated rows score
alike, and of the rows of one doc_id one is trained on, the first by its text's
hash; a null doc_id is held out; without labels of
both classes the seed list alone votes; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm import textbytes as tb
from clicklens.llm.exchange import first_by_hash, ready
from clicklens.llm.lm import with_fold

LABELLED, TRAINED, TERMS, VOTERS = 8_000, 20_000, 192, 8
PREFIXES = (5, 6, 7, 8)
# fixed value: common English insults, the voters' seed
SEEDS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "worthless", "pathetic", "disgusting", "clown", "dumb")


def terms(buf: np.ndarray, offsets: np.ndarray):
    """``(hash, doc)`` of all words and word beginnings of each text."""
    lower = tb.ASCII_LOWER[buf]
    start, end, doc = tb.words(lower, offsets, tb.IS_ALNUM)
    rng = tb.RangeHash(lower)
    keys, docs = [rng(start, end)], [doc]
    for n in PREFIXES:
        long = end - start > n
        keys.append(rng(start[long], start[long] + n) ^ np.uint64(0x5EED))
        docs.append(doc[long])
    return np.concatenate(keys), np.concatenate(docs), np.bincount(doc, minlength=len(offsets) - 1)


def _seed_hashes() -> np.ndarray:
    raw = "".join(SEEDS).encode()
    stop = np.cumsum([len(s) for s in SEEDS])
    return tb.RangeHash(np.frombuffer(raw, np.uint8))(np.concatenate([[0], stop[:-1]]), stop)


def induce(sample: DataFrame) -> np.ndarray:
    """Hashes of the voters' terms from labelled rows ``(text, toxic)``."""

    def count(batches):
        held = []
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for at, buf, offsets in tb.text_chunks(batch.column(0)):
                key, doc, _ = terms(buf, offsets)
                pair = np.unique(np.rec.fromarrays([doc, key]))
                held.append((pair.f1, toxic[at + pair.f0]))
        if held:
            key, toxic = (np.concatenate(x) for x in zip(*held))
            distinct, place = np.unique(key, return_inverse=True)
            yes = np.bincount(place, weights=toxic == 1, minlength=len(distinct)).astype(np.int64)
            both = np.bincount(place, minlength=len(distinct))
            keep = yes > 0
            yield pa.RecordBatch.from_arrays([pa.array(distinct[keep].view(np.int64)), pa.array(yes[keep])], names=["term", "yes"])
            no = both - yes
            keep = no > 0
            yield pa.RecordBatch.from_arrays([pa.array(distinct[keep].view(np.int64)), pa.array(-no[keep])], names=["term", "yes"])

    n_yes, n_no = sample.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not n_yes or not n_no:
        return _seed_hashes()
    counted = sample.select("text", "toxic").mapInArrow(count, "term long, yes long").groupBy("term").agg(
        F.sum(F.greatest("yes", F.lit(0))).alias("yes"), F.sum(F.greatest(-F.col("yes"), F.lit(0))).alias("no"))
    odds = F.log((F.col("yes") + 0.5) / (n_yes + 1)) - F.log((F.col("no") + 0.5) / (n_no + 1))
    best = counted.where(F.col("yes") >= max(3, n_yes // 200)).withColumn("odds", odds).where("odds >= 3").orderBy(
        (F.col("odds") * F.sqrt("yes")).desc(), "term").limit(TERMS).select("term").toPandas()["term"]
    found = best.to_numpy(dtype=np.int64).view(np.uint64)
    seeds = _seed_hashes()
    return np.concatenate([seeds, found[~np.isin(found, seeds)]])


class Hits:
    """Occurrences of known terms in texts."""

    def __init__(self, vocabulary: np.ndarray):
        self.order = np.argsort(vocabulary, kind="stable")
        self.sorted = vocabulary[self.order]

    def __call__(self, buf: np.ndarray, offsets: np.ndarray):
        """Counts per document and term, and words per document."""
        key, doc, n_words = terms(buf, offsets)
        at = np.minimum(np.searchsorted(self.sorted, key), len(self.sorted) - 1)
        hit = self.sorted[at] == key
        counts = np.zeros((len(offsets) - 1, len(self.sorted)), dtype=np.float32)
        np.add.at(counts, (doc[hit], self.order[at[hit]]), 1)
        return counts, n_words


def votes(counts: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Bit mask of the voters of each document."""
    hit = counts > 0
    voter = np.where(np.arange(counts.shape[1]) < len(SEEDS), 0, 1 + np.arange(counts.shape[1]) % (VOTERS - 1))
    share = counts.sum(axis=1) / np.maximum(n_words, 1)
    columns = [hit[:, voter == v].any(axis=1) for v in range(VOTERS)] + [hit.sum(axis=1) >= 2, share >= 0.01]
    return sum(c.astype(np.int64) << k for k, c in enumerate(columns))


N_VOTES = VOTERS + 2


def vote_table(texts: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Rows per vote pattern over the whole corpus."""

    def run(batches):
        hits, table = Hits(vocabulary), np.zeros(1 << N_VOTES, dtype=np.int64)
        for batch in batches:
            for _, buf, offsets in tb.text_chunks(batch.column(0)):
                table += np.bincount(votes(*hits(buf, offsets)), minlength=len(table))
        some = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(table[some])], names=["mask", "n"])

    found = texts.select("text").mapInArrow(run, "mask long, n long").groupBy("mask").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(1 << N_VOTES)
    table[found["mask"].to_numpy(np.int64)] = found["n"]
    return table


def label_model(table: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of the toxic class per vote pattern."""
    vote = (np.arange(len(table))[:, None] >> np.arange(N_VOTES)) & 1
    n = table.sum()
    if not n:
        return np.zeros(len(table))
    post = np.where(vote.sum(axis=1) >= 2, 0.95, np.where(vote.any(axis=1), 0.4, 0.02))
    weight = np.ones(N_VOTES)
    for _ in range(rounds):
        yes, no = (table * post)[:, None], (table * (1 - post))[:, None]
        prior = np.clip(yes.sum() / n, 1e-4, 0.5)
        a = np.clip(((yes * vote).sum(0) + 1) / (yes.sum() + 2), 1e-4, 1 - 1e-4)
        b = np.clip(((no * vote).sum(0) + 0.1) / (no.sum() + 2), 1e-5, 1 - 1e-4)
        a = np.maximum(a, b)
        # correlations inside the classes: a vote counts by its own part
        dev = yes * (vote - a) / np.sqrt(a * (1 - a))
        rho = (dev.T @ ((vote - a) / np.sqrt(a * (1 - a)))) / max(yes.sum(), 1e-9)
        weight = 1 / (1 + np.clip(rho - np.eye(N_VOTES), 0, 1).sum(axis=1) / 2)
        logit = np.log(prior / (1 - prior)) + (weight * np.where(vote == 1, np.log(a / b), np.log((1 - a) / (1 - b)))).sum(axis=1)
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return post


@dataclass(frozen=True)
class Classifier:
    vocabulary: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(np.log1p(counts) @ self.weight + self.bias)))


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5) -> Classifier:
    """Fit on rows outside fold 0 (votes and samples alike)."""
    ready(docs.sparkSession)
    texts = with_fold(docs, modulus)
    gold = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    first = first_by_hash(gold.where(fold != 0), ["doc_id"], LABELLED)
    rows_of = lambda ids: texts.where("train").join(F.broadcast(ids), "doc_id").groupBy(*ids.columns).agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))  # one row per id, however often it is repeated
    known = rows_of(first)
    vocabulary = induce(known)
    posterior = label_model(vote_table(texts.where("train"), vocabulary))
    others = first_by_hash(texts.where("train and doc_id is not null").select("doc_id"), ["doc_id"], TRAINED - LABELLED, distinct=True)
    fresh = others.join(F.broadcast(first.select("doc_id")), "doc_id", "left_anti")
    sample = known.select("doc_id", "text", "toxic").unionByName(rows_of(fresh).withColumn("toxic", F.lit(-1)))

    def run(batches):
        hits = Hits(vocabulary)
        for batch in batches:
            toxic = batch.column(2).to_numpy(zero_copy_only=False)
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                counts, n_words = hits(buf, offsets)
                mask = votes(counts, n_words)
                rows = [(int(mask[i]), int(toxic[at + i]), np.flatnonzero(c).tolist(), c[c > 0].tolist()) for i, c in enumerate(counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float32())))],
                    names=["mask", "toxic", "term", "n"])

    rows = sample.select("doc_id", "text", "toxic").mapInArrow(run, "mask long, toxic int, term array<int>, n array<float>").toPandas()
    x = np.zeros((len(rows), len(vocabulary)), dtype=np.float32)
    for i, (t, n) in enumerate(zip(rows["term"], rows["n"])):
        x[i, np.asarray(t, dtype=np.int64)] = n
    y = posterior[rows["mask"].to_numpy(np.int64)] if len(rows) else np.zeros(0)
    y = np.where(rows["toxic"] == 1, 0.98, np.where(rows["toxic"] == 0, 0.02, y)) if len(rows) else y
    return Classifier(vocabulary, *_logistic(np.log1p(x), y))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 400, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    w, b = np.zeros(x.shape[1]), 0.0
    if not len(x):
        return np.where(np.arange(x.shape[1]) < len(SEEDS), 4.0, 0.0), -2.0
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, steps + 1):
        g = 1 / (1 + np.exp(-(x @ w + b))) - y
        grad = np.append(x.T @ g / len(y) + ridge * w / 10, g.mean())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def score(docs: DataFrame, model: Classifier, modulus: int = 5) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``."""
    ready(docs.sparkSession)

    def run(batches):
        hits = Hits(model.vocabulary)
        for batch in batches:
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                s = model.score(hits(buf, offsets)[0])
                n = len(s)
                held = pc.invert(batch.column(2).slice(at, n))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), held, pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                                 names=["doc_id", "held_out", "score", "predicted"])

    return with_fold(docs, modulus).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` without the rows the model rejects; all columns stay."""
    ready(docs.sparkSession)
    names = docs.columns

    def run(batches):
        hits = Hits(model.vocabulary)
        at_text = names.index("text")
        for batch in batches:
            keep = [model.score(hits(buf, offsets)[0]) < 0.5 for _, buf, offsets in tb.text_chunks(batch.column(at_text))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
