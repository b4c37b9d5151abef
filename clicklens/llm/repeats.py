"""Suffix-array deduplication of byte strings across documents.

All suffixes of a corpus do not fit one sorted array, so the array is cut into
buckets that are closed under equality of ``LENGTH``-byte strings: every
``LENGTH``-byte window belongs to the leftmost smallest-hash ``GRAM``-byte gram
inside it (its anchor), and equal windows have equal anchors. Per anchor
occurrence, the windows it owns form one short string (its stretch, at most
``2 * LENGTH - GRAM`` bytes).

1. ``anchors``: stretches of every document, vectorised. Occurrences meet by
   gram hash (packed shuffle). Equal stretches are settled at once: those
   outside the smallest document are repeats, first within each task, then
   globally, so copies cost one entry per task. A window shared by two different
   stretches around a gram reaches ``HALF`` bytes or more beyond it on one side in
   both, so each entry carries a hash of the gram with ``HALF`` bytes before it and
   one with ``HALF`` bytes behind it; a stretch that shares neither with a
   stretch of another document ends here (most do: short strings are common).
2. The remaining stretches, one class each with its first document, get their
   text, meet by gram, and ``maximal_repeats`` builds the enhanced suffix array
   (suffixes, common prefixes) of each bucket, scans the interval tree with a
   stack, keeps the left-diverse intervals of ``LENGTH`` bytes or more and
   reports all their occurrences: the maximal repeat groups.
3. Occurrences outside a group's smallest document are removed.

Defined cases: null and empty texts have no bytes; texts shorter than
``LENGTH`` lose nothing; a string repeated inside one document is no repeat;
repeated rows of one doc_id are one document; rows without a doc_id take no
part; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm import textbytes as tb
from clicklens.llm.exchange import buckets, packed_shuffle, partitions, ready, stored
from clicklens.llm.spans import SPAN, cut, with_spans

LENGTH, GRAM = 50, 16
STRETCH = 2 * LENGTH - GRAM
HALF = (LENGTH - GRAM + 1) // 2
FLUSH = 2_000_000  # anchors held by a task before they are sent
SUFFIXES = 300_000  # suffixes of whole buckets sorted at a time
DTYPES = (np.uint64, np.uint64, np.uint32, np.uint32, np.int64, np.int32, np.uint8)
_LOW = np.uint64(0xFFFFFFFF)
_SETTLED = np.uint64(0)


def anchors(buf: np.ndarray, offsets: np.ndarray):
    """``(gram hash, stretch hash, left, right, doc, start, length)`` of all stretches.
    left: hash of the gram and ``HALF`` bytes before it, right: of it and those
    behind it, 0 where the stretch ends earlier."""
    n, w = len(buf), LENGTH - GRAM + 1
    empty = np.zeros(0, dtype=np.int64)
    if n < LENGTH:
        return *(empty.astype(t) for t in DTYPES[:4]), empty, empty, empty
    rng = tb.RangeHash(buf)
    gram = rng.fixed(GRAM) if n > GRAM else np.zeros(0, np.uint64)
    gram = np.append(gram, rng(np.array([n - GRAM]), np.array([n])))
    low = (gram & ~_LOW) | np.arange(len(gram), dtype=np.uint64)
    width = 1
    while 2 * width <= w:  # minimum over the w grams of each window, by doubling
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (w - width)], low[w - width :])
    long_docs = offsets[1:] - offsets[:-1] >= LENGTH
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, offsets[:-1][long_docs], 1)
    np.add.at(edge, offsets[1:][long_docs] - LENGTH + 1, -1)
    window = np.flatnonzero(np.cumsum(edge[:n]) > 0)
    owner = (low[window] & _LOW).astype(np.int64)
    first = tb.runs(owner)
    last = np.append(first[1:], len(owner)) - 1
    start, stop = window[first], window[last] + LENGTH
    doc = np.searchsorted(offsets, start, side="right") - 1
    # a stretch is told by its bytes and by where the anchor stands in it
    at = owner[first]
    stretch = tb.mix(rng(start, stop) ^ (at - start).astype(np.uint64))

    def side(a, b):
        inside = (a >= start) & (b <= stop)
        return np.where(inside, (rng(np.where(inside, a, 0), np.where(inside, b, 0)) >> np.uint64(32)) | np.uint64(1), 0).astype(np.uint32)

    return (gram[at] | np.uint64(1), stretch, side(at - HALF, at + GRAM), side(at, at + GRAM + HALF), doc, start, stop - start)


def settle(gram, stretch, left, right, doc, start, length):
    """Group by (gram, stretch); tell occurrences in a class's smallest
    document from the others. Returns sorted arrays and that mask."""
    order = np.lexsort((start, doc, stretch, gram))
    sorted_ = [x[order] for x in (gram, stretch, left, right, doc, start, length)]
    gram, stretch, doc = sorted_[0], sorted_[1], sorted_[4]
    heads = tb.runs(gram ^ tb.mix(stretch))
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(gram))))
    return *sorted_, doc == doc[heads][group]


def in_several(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether several documents have an entry's key."""
    if not len(key):
        return np.zeros(0, bool)
    order = np.argsort(key, kind="stable")
    heads = tb.runs(key[order])
    several = np.minimum.reduceat(doc[order], heads) != np.maximum.reduceat(doc[order], heads)
    out = np.empty(len(key), bool)
    out[order] = np.repeat(several, np.diff(np.append(heads, len(key))))
    return out


def may_share(gram, left, right, doc) -> np.ndarray:
    """Whether a stretch can share a window with one of another document. One
    entry's document is its class's smallest, so different documents are different
    stretches."""
    open_ = np.flatnonzero(in_several(gram, doc))
    out = np.zeros(len(gram), bool)
    for side in (left, right):
        at = open_[side[open_] != 0]
        out[at] |= in_several(gram[at] ^ tb.mix(side[at].astype(np.uint64)), doc[at])
    return out


def gram_classes(docs: DataFrame) -> DataFrame:
    """``(gram, doc_id, start, stop)``: gram 0 for settled repeats, otherwise
    a stretch (in its class's smallest document) that may share a window with a
    different one of another document."""
    spark = docs.sparkSession
    ready(spark)
    n = buckets(spark)

    def flush(held):
        parts = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        gram, stretch, left, right, doc, start, length, own = settle(*parts)
        del parts
        left[~own] = right[~own] = 0
        yield from tb.by_bucket(gram, n, np.where(own, gram, _SETTLED), stretch, left, right, doc, start, length)

    def send(batches):
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                *hashes, d, s, length = anchors(buf, offsets)
                if len(d):
                    held.append((*hashes, ids[at + d].astype(np.int64), (s - offsets[d]).astype(np.int32),
                                 length.astype(np.uint8)))
                    size += len(d)
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    def meet(blobs):
        parts = [np.concatenate(x) for x in zip(*(tb.unpack(b, *DTYPES) for b in blobs))]
        done = parts[0] == _SETTLED
        gram, _, left, right, doc, start, length, own = settle(*(x[~done] for x in parts))
        keep = ~own
        keep[own] = may_share(gram[own], left[own], right[own], doc[own])
        out = (np.concatenate([np.zeros(done.sum(), np.uint64), np.where(own, gram, _SETTLED)[keep]]),
               *(np.concatenate([x[done], y[keep]]) for x, y in zip(parts[4:], (doc, start, length))))
        if len(out[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0].view(np.int64)), pa.array(out[1]), pa.array(out[2]),
                 pa.array(out[2] + out[3].astype(np.int32))], names=["gram", "doc_id", "start", "stop"])

    return packed_shuffle(docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text"), send, meet,
                          "gram long, doc_id long, start int, stop int")


def suffix_array(texts: list[bytes]):
    """Sorted suffixes of at least ``LENGTH`` bytes of all texts:
    ``(text, offset, length)`` in order, the common prefix with the suffix
    before, and the byte before each (-1 at the start of its text)."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.frombuffer(b"".join(texts) + bytes(STRETCH), dtype=np.uint8)
    count = np.maximum(lengths - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(texts)), count)
    offset = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at, size = begins[text] + offset, lengths[text] - offset
    rows = np.lib.stride_tricks.sliding_window_view(flat, STRETCH)[at]
    rows[np.arange(STRETCH) >= size[:, None]] = 0
    order = np.argsort(rows.view(f"S{STRETCH}").ravel(), kind="stable")
    rows, text, offset, size = rows[order], text[order], offset[order], size[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), STRETCH)
    common = np.concatenate([[0], np.minimum(common, np.minimum(size[1:], size[:-1]))])
    before = np.where(offset > 0, flat[np.maximum(begins[text] + offset - 1, 0)].astype(np.int64), -1)
    return text, offset, common, before


def intervals(common: np.ndarray):
    """Stack scan of the common prefixes: ``(first, last, depth)`` of all
    intervals of the tree that are at least ``LENGTH`` deep."""
    deep = common >= LENGTH
    pos = np.flatnonzero(deep)
    stack: list[tuple[int, int]] = []  # (depth, first)
    previous = -2
    for i in pos.tolist():
        depth = int(common[i])
        if i != previous + 1:
            while stack:
                d, first = stack.pop()
                yield first, previous, d
        first = i - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield first, previous, d
        if not stack or stack[-1][0] < depth:
            stack.append((depth, first))
        previous = i
    while stack:
        d, first = stack.pop()
        yield first, previous, d


def maximal_repeats(texts: list[bytes], docs: np.ndarray):
    """``(depth, text indices, offsets)`` of each maximal repeat group that
    spans several documents: left-diverse intervals, all occurrences. A suffix
    at the start of its text counts as diverse, because what precedes it is
    another bucket's."""
    text, offset, common, before = suffix_array(texts)
    owner = docs[text]
    for first, last, depth in intervals(common):
        part = slice(first, last + 1)
        b = before[part]
        if (b[0] != -1 and (b == b[0]).all()) or (owner[part] == owner[first]).all():
            continue
        yield depth, text[part], offset[part]


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, stop)``: byte ranges covered by ``LENGTH``-byte
    strings that also start in a document with a smaller doc_id."""
    spark = docs.sparkSession
    met = stored(gram_classes(docs), "grams", free=True)
    settled = met.where("gram = 0").select("doc_id", "start", "stop")
    wanted = met.where("gram <> 0").groupBy("doc_id").agg(F.collect_list(F.struct("gram", "start", "stop")).alias("at"))
    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")

    def fetch(batches):
        for batch in batches:
            ids, at = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row, buf, offsets in tb.text_chunks(batch.column(1)):
                out = []
                for k in range(len(offsets) - 1):
                    raw = buf[offsets[k] : offsets[k + 1]].tobytes()
                    out += [(x["gram"], ids[row + k], x["start"], raw[x["start"] : x["stop"]]) for x in at[row + k]]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                        names=["gram", "doc_id", "start", "stretch"])

    def spans(rows):
        texts = [x[3] for x in rows]
        ids = np.array([x[1] for x in rows], dtype=np.int64)
        begin = np.array([x[2] for x in rows], dtype=np.int64)
        found = [[], [], []]
        for depth, text, offset in maximal_repeats(texts, ids):
            gone = ids[text] != ids[text].min()
            found[0].append(ids[text[gone]])
            found[1].append(begin[text[gone]] + offset[gone])
            found[2].append(begin[text[gone]] + offset[gone] + depth)
        if found[0]:
            a, b, c = (np.concatenate(x) for x in found)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.int32()), pa.array(c, pa.int32())], schema=SPAN)

    def scan(batches):
        held, size, gram = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if row[0] != gram and size >= SUFFIXES:
                    yield from spans(held)
                    held, size = [], 0
                gram = row[0]
                held.append(row)
                size += len(row[3]) - LENGTH + 1
        if held:
            yield from spans(held)

    stretches = source.join(wanted, "doc_id").select("doc_id", "text", "at").mapInArrow(
        fetch, "gram long, doc_id long, start int, stretch binary")
    found = stretches.repartition(partitions(spark), "gram").sortWithinPartitions("gram").mapInArrow(
        scan, "doc_id long, start int, stop int")
    return settled.unionByName(found)


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, byte counts, the removed runs and the kept
    bytes' SHA-256."""
    types = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                       ("kept_sha256", pa.string()), ("removed", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            ids, spans = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                rows = []
                for k in range(len(offsets) - 1):
                    raw = buf[offsets[k] : offsets[k + 1]].tobytes()
                    merged, left = cut(raw, [(x["start"], x["stop"]) for x in spans[at + k] or ()])
                    rows.append((ids[at + k], len(raw), len(raw) - len(left), len(merged),
                                 hashlib.sha256(left).hexdigest(), [v for x in merged for v in x]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)

    keyed = with_spans(docs.where("doc_id is not null"), repeated_bytes(docs))
    no_id = docs.where("doc_id is null").select(F.col("doc_id").cast("long"), "text",
                                                F.lit(None).cast(keyed.schema["spans"].dataType).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<int>"
    # joined after the cut: so the texts shuffled for the stretches serve the spans too (ReusedExchange)
    return keyed.select("doc_id", "text", "spans").mapInArrow(run, schema).unionByName(no_id.mapInArrow(run, schema))
