"""Periodic runs of words, found by minimizers at several scales.

A run is a longest stretch of words with smallest period ``q`` that is at least
``EXPONENT`` periods and ``LEAST`` words long. Two searches find all of them:

* Periods up to ``DIRECT`` are scanned lag by lag: stretches of words equal to
  the word ``q`` further on.
* A scale ``w`` (a power of two) covers the periods ``w / 2 < q <= w``. Every
  ``w`` consecutive words have a hash, and the hashes that are least in some
  window of ``w / 2`` neighbours are the scale's minimizers. In a run they repeat
  at distance ``q``; and as ``w >= q``, no equal one lies between (a period that
  met itself earlier would not be the smallest). A run of four periods holds ``q``
  windows more than one window's width, so it has such a pair. Each pair of
  neighbouring equal minimizers ``w / 2`` to ``w`` apart is a seed, which is
  extended word by word both ways.

Only words repeating over at least two periods give a seed, so plain prose costs
the minimizers alone. Work is map-only: a document is one row, its arrays are a
few times its words. Words are compared by 64-bit hashes.

Defined cases: null and empty texts have no words and no runs; a null doc_id is
treated like any other row; rows of one doc_id are taken one by one (repeated
rows give repeated results); of two runs over the same words only the smallest
period counts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm import textbytes as tb
from clicklens.llm.exchange import ready

EXPONENT, LEAST = 4, 6
DIRECT = 8  # a power of two; the first scale is twice this
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every window of ``width`` (a power of two) values."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def lag_runs(code: np.ndarray, doc: np.ndarray, q: int):
    """``(start, stop)`` of all stretches with period ``q``, long enough."""
    same = np.zeros(max(len(code) - q, 0) + 2, np.int8)
    same[1:-1] = (code[q:] == code[:-q]) & (doc[q:] == doc[:-q])
    edge = np.flatnonzero(np.diff(same))
    start, stop = edge[::2], edge[1::2] + q
    long = stop - start >= max(LEAST, EXPONENT * q)
    return start[long], stop[long]


def seeds(code: np.ndarray, doc: np.ndarray, w: int):
    """``(place, distance)`` of neighbouring equal minimizers of scale ``w``."""
    n, half = len(code) - w + 1, w // 2
    if n < half:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = tb.radix_powers(len(code) + 1)
    prefix = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(code * up[: len(code)], out=prefix[1:])
    value = tb.mix((prefix[w:] - prefix[:n]) * down[:n])
    inside = doc[w - 1 :] == doc[:n]
    value[~inside] = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = np.zeros(n + half - 1, np.uint64)  # of the window from each place, and of none before the first
    least[half - 1 : n] = slide(value, half, np.minimum)
    place = np.flatnonzero((slide(least, half, np.maximum) == value) & inside)
    order = np.lexsort((place, value[place], doc[place]))
    place = place[order]
    far = place[1:] - place[:-1]
    pair = (value[place[1:]] == value[place[:-1]]) & (doc[place[1:]] == doc[place[:-1]]) & (far > half) & (far <= w)
    return place[:-1][pair], far[pair]


def matching(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix of two equal-long arrays, by growing pieces."""
    at, step = 0, 64
    while at < len(a):
        differ = np.flatnonzero(a[at : at + step] != b[at : at + step])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 2
    return len(a)


def seeded_runs(code: np.ndarray, doc: np.ndarray, count: np.ndarray):
    """``(start, stop, period)`` of the runs with a period over ``DIRECT``."""
    first = np.cumsum(count) - count
    found, w = [], 2 * DIRECT
    while len(count) and EXPONENT * (w // 2 + 1) <= count.max():
        use = np.flatnonzero((count >= EXPONENT * (w // 2 + 1))[doc])
        place, far = seeds(code[use], doc[use], w)
        place = use[place]
        order = np.lexsort((place, far))
        known, at = 0, (-1, -1)  # the last run of the same distance ends here
        for m, q in zip(place[order].tolist(), far[order].tolist()):
            if at[0] == q and m < known:
                continue
            low = int(first[doc[m]])
            high = low + int(count[doc[m]])
            stop = m + q + matching(code[m : high - q], code[m + q : high])
            start = m - matching(code[low:m][::-1], code[low + q : m + q][::-1])
            known, at = stop - q, (q, start)
            if stop - start >= max(LEAST, EXPONENT * q):
                found.append((start, stop, q))
        w *= 2
    return found


def runs_of(code: np.ndarray, doc: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All runs as rows ``(start, stop, period)``, by start, then period."""
    found = [np.array(seeded_runs(code, doc, count), np.int64).reshape(-1, 3)]
    for q in range(1, DIRECT + 1):
        start, stop = lag_runs(code, doc, q)
        found.append(np.stack([start, stop, np.full(len(start), q)], axis=1))
    found = np.concatenate(found)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)  # a multiple of the period covers the same words
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def joined(buf: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, n: int) -> pa.Array:
    """The words of every document, joined by one space."""
    size = end - start + 1
    last = np.ones(len(doc), bool)
    last[:-1] = doc[1:] != doc[:-1]
    size[last] -= 1
    at = np.concatenate([[0], np.cumsum(size)])
    offsets = at[np.searchsorted(doc, np.arange(n + 1))].astype(np.int32)
    source = np.repeat(start - at[:-1], size) + np.arange(at[-1])
    out = buf[np.minimum(source, max(len(buf) - 1, 0))]
    out[(at[1:] - 1)[~last]] = 0x20
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes()))


def find_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, runs`` (structs of ``start, length,
    period`` in words, by start, then period) and ``collapsed``: the words without
    those that a run repeats after its first period, joined by one space."""
    ready(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for row, buf, offsets in tb.text_chunks(batch.column(1)):
                n = len(offsets) - 1
                start, end, doc = tb.words(buf, offsets, ~tb.IS_SPACE)
                code = tb.RangeHash(buf)(start, end) if len(start) else np.zeros(0, np.uint64)
                count = np.bincount(doc, minlength=n)
                first = np.cumsum(count) - count
                found = runs_of(code, doc, count)
                owner = doc[found[:, 0]] if len(found) else np.zeros(0, np.int64)
                mark = np.zeros(len(doc) + 1, np.int64)
                np.add.at(mark, found[:, 0] + found[:, 2], 1)
                np.add.at(mark, found[:, 1], -1)
                kept = np.cumsum(mark)[:-1] == 0
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(x) for x in (
                        found[:, 0] - first[owner], found[:, 1] - found[:, 0], found[:, 2])], fields=list(RUN)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(count.astype(np.int64)), lists,
                     joined(buf, start[kept], end[kept], doc[kept], n)],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def with_loops(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a loop in every tenth document: with ``h`` the crc32 of
    the decimal doc_id, ``g = h div 10`` and ``n`` words, where ``h % 10 = 0`` every
    word ``i >= a`` becomes word ``a + (i - a) % p`` (``a = g % n``,
    ``p = 1 + (n - a) div (3 + g % 8)``), words joined by one space. Other rows, and
    those without words or doc_id, keep their text."""
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all(
        "text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))).withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int")).withColumn(
        "p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    loop = F.expr("array_join(transform(sequence(0, n - 1), i -> w[if(i < a, i, a + (i - a) % p)]), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, loop).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the longest run and hashes of ``find_runs``."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(F.encode(listed, "utf-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "utf-8"), 256).alias("collapsed_sha256"), "n_words")
