"""Sentence-span deduplication.

A text is cut into sentences (after ``.``, ``!``, ``?`` before white space, and
at line ends). A span is any run of consecutive sentences with at least
``min_sentences`` sentences and ``min_words`` words; the first occurrence
(smallest doc_id, then position) of each stays, and every sentence covered by
another occurrence is removed. Hashed as byte ranges are only the shortest span
from every sentence and, with ``whole``, the shortest span up to every
sentence. The spans inside a later occurrence are later occurrences too, and
these two kinds cover it: what lies beyond the shortest span from its first
sentence ends a shortest span that starts no earlier. Without ``whole``
sentences at the end of a repeated run can stay.

Each task first settles equal spans among its own documents and sends one
first occurrence per hash, so a passage that a third of all rows share costs
one entry per task. What is sent is packed binary (``exchange``).

Defined cases: null and empty texts have no sentences and stay as they are;
texts without a full span lose nothing; repeated rows of one doc_id are one
document (their spans are no repeats of each other); rows without a doc_id
take no part; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm import textbytes as tb
from clicklens.llm.exchange import buckets, packed_shuffle, ready

MIN_SENTENCES, MIN_WORDS = 2, 20
FLUSH = 1_500_000  # spans held by a task before they are sent
SPAN = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
DTYPES = (np.uint64, np.int64, np.int32, np.int32)
_ENDS = np.zeros(256, dtype=bool)
_ENDS[np.frombuffer(b".!?", dtype=np.uint8)] = True


def sentences(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, doc, words)`` per sentence, surrounding space left out."""
    ws, we, wd = tb.words(buf, offsets, ~tb.IS_SPACE)
    if not len(ws):
        return ws, we, wd, ws
    newlines = np.concatenate([[0], np.cumsum(buf == 10)])
    last = np.ones(len(ws), dtype=bool)
    last[:-1] = _ENDS[buf[we[:-1] - 1]] | (wd[1:] != wd[:-1]) | (newlines[ws[1:]] > newlines[we[:-1]])
    ends = np.flatnonzero(last)
    begins = np.concatenate([[0], ends[:-1] + 1])
    return ws[begins], we[ends], wd[begins], ends - begins + 1


def span_runs(start, end, doc, n_words, min_sentences: int, min_words: int):
    """First and last sentence of the span from each sentence that has one."""
    total = np.concatenate([[0], np.cumsum(n_words)])
    first = np.arange(len(start))
    last = np.maximum(first + min_sentences - 1, np.searchsorted(total, total[:-1] + min_words, side="left") - 1)
    ok = last < len(start)
    first, last = first[ok], last[ok]
    ok = doc[first] == doc[last]
    return first[ok], last[ok]


def span_runs_up_to(start, end, doc, n_words, min_sentences: int, min_words: int):
    """First and last sentence of the span up to each sentence that has one."""
    total = np.concatenate([[0], np.cumsum(n_words)])
    last = np.arange(len(start))
    first = np.minimum(last - min_sentences + 1, np.searchsorted(total, total[1:] - min_words, side="right") - 1)
    ok = first >= 0
    first, last = first[ok], last[ok]
    ok = doc[first] == doc[last]
    return first[ok], last[ok]


def _settle(key, doc, start, stop):
    """Sort occurrences by hash, document and place; tell the first of each
    hash from the others (a place met twice is the same occurrence)."""
    order = np.lexsort((start, doc, key))
    key, doc, start, stop = key[order], doc[order], start[order], stop[order]
    heads = tb.runs(key)
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(key))))
    first = (doc == doc[heads][group]) & (start == start[heads][group])
    return key, doc, start, stop, first, heads


def repeated_spans(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
                   whole: bool = False) -> DataFrame:
    """``(doc_id, start, stop)``: byte ranges of non-first repeated spans that,
    with ``whole``, cover all of them."""
    spark = docs.sparkSession
    ready(spark)
    n = buckets(spark)

    def flush(held):
        key, doc, start, stop, first, heads = _settle(*(np.concatenate(x) for x in zip(*held)))
        yield from tb.by_bucket(key[heads], n, key[heads], doc[heads], start[heads], stop[heads])
        if not first.all():  # settled here; passed on as they are
            rest = ~first
            yield from tb.by_bucket(key[rest], n, np.zeros(rest.sum(), np.uint64), doc[rest], start[rest], stop[rest])

    def send(batches):
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                s, e, d, w = sentences(buf, offsets)
                i, j = span_runs(s, e, d, w, min_sentences, min_words)
                if whole:
                    i2, j2 = span_runs_up_to(s, e, d, w, min_sentences, min_words)
                    both = np.unique(np.concatenate([i * len(s) + j, i2 * len(s) + j2]))
                    i, j = both // max(len(s), 1), both % max(len(s), 1)
                if not len(i):
                    continue
                key = tb.RangeHash(buf)(s[i], e[j]) | np.uint64(1)
                held.append((key, ids[at + d[i]].astype(np.int64), (s[i] - offsets[d[i]]).astype(np.int32),
                             (e[j] - offsets[d[i]]).astype(np.int32)))
                size += len(i)
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    def meet(blobs):
        key, doc, start, stop = (np.concatenate(x) for x in zip(*(tb.unpack(b, *DTYPES) for b in blobs)))
        done = key == 0
        _, doc2, start2, stop2, first, _ = _settle(key[~done], doc[~done], start[~done], stop[~done])
        doc, start, stop = (np.concatenate([a[done], b[~first]]) for a, b in ((doc, doc2), (start, start2), (stop, stop2)))
        if len(doc):
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(stop)], schema=SPAN)

    return packed_shuffle(docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text"), send, meet,
                          "doc_id long, start int, stop int")


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """Merge byte spans and take them out of the text."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    at, kept = 0, []
    for a, b in merged:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return [(a, b) for a, b in merged], b"".join(kept)


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Documents with the list of their spans (null: none). Both sides meet by
    doc_id; a list is bounded by its document's length."""
    lists = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return docs.select(F.col("doc_id").cast("long"), "text").join(lists, "doc_id", "left")


def dedup_spans(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
                whole: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, kept text, sentence counts and the removed
    byte ranges of whole sentences."""
    joined = with_spans(docs, repeated_spans(docs, min_sentences, min_words, whole))
    schema = "doc_id long, kept_text string, n_sentences long, n_removed long, removed array<struct<start:int,stop:int>>"
    types = pa.schema([("doc_id", pa.int64()), ("kept_text", pa.string()), ("n_sentences", pa.int64()),
                       ("n_removed", pa.int64()),
                       ("removed", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            spans = batch.column(2).to_pylist()
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                s, e, d, _ = sentences(buf, offsets)
                lo = np.searchsorted(d, np.arange(len(offsets) - 1))
                hi = np.searchsorted(d, np.arange(len(offsets) - 1), side="right")
                rows = []
                for k in range(len(offsets) - 1):
                    text = buf[offsets[k] : offsets[k + 1]].tobytes()
                    merged, left = cut(text, [(x["start"], x["stop"]) for x in spans[at + k] or ()])
                    a, b = s[lo[k] : hi[k]] - offsets[k], e[lo[k] : hi[k]] - offsets[k]
                    gone = sum(int(((a >= x) & (b <= y)).sum()) for x, y in merged)
                    rows.append((ids[at + k], left.decode("utf-8", "replace"), len(a), gone,
                                 [{"start": x, "stop": y} for x, y in merged]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)

    return joined.select("doc_id", "text", "spans").mapInArrow(run, schema)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
