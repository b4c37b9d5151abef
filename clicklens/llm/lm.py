"""Hashed maximum-entropy language model with a class-factored softmax.

``P(token | context) = P(class | context) * P(token | class, context)``. Both
factors have hashed features of the context: the previous token, the one before
it (skip) and both together (n-gram). The class of a token is a hash of its last
two bytes (the end of a text has its own class).

The class distribution is a softmax over ``ROWS`` hashed rows of each feature.
Its weights are trained by distributed gradient updates: in each round every task
runs mini-batch updates over all training texts it reads, from the weights of
the round before, and the results are averaged by tokens.

Inside a class the softmax is factored on, down a binary tree of the class's
tokens (Shannon's code of their frequencies), and every branch has the features of
the context. Tokens go by class and hash of the previous token to ``group``s of
about ``GROUP`` tokens (a frequent previous token is spread by the one before
it), so groups grow in number with the input, and each fits and keeps the weights
of its own contexts: a table whose rows follow the branches counted in it. Weights
are fitted feature by feature, by Newton steps on the penalised likelihood of the
group's training tokens. Tokens of the class that the group's training texts lack
share one leaf, in which each has its smoothed relative frequency
``(c + 0.1) / (N_class + 0.1 * (V_class + 1))``; so the probabilities sum to one.

Token counts are over all training texts. Every task cuts its texts into
flushes of about ``FLUSH`` tokens and asks for each flush's distinct tokens
once (a request per hash bucket, with the flush's own counts); buckets add up
the counts and answer each flush, which sends its tokens on to the groups. So no
vocabulary and no weight inside a class is broadcast, a token that is in every
text costs one entry per flush, and scoring is vectorised. Only the class totals
and the weights between classes, of fixed size, reach the driver.

Defined cases: a null or empty text is one token (the end); repeated rows are
repeated texts and count each; a null doc_id is held out; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm import textbytes as tb
from clicklens.llm.exchange import buckets, partitions, ready, stored, stored_by

CLASSES, ROWS = 16, 2048  # classes; hashed rows of each of the three features
ROUNDS, BATCH, RATE = 2, 16_384, 0.3
PARTS = 16  # parts of the weights between classes, for the shuffle
FLUSH = 5_000_000
GROUP, BUCKET = 250_000, 1_500_000  # tokens fitted together inside a class; tokens of a bucket of groups
PENALTY = 0.25  # weight of the squared weights
PART = 1 << 16  # branches worked on at a time: they stay in the processor's cache
ALPHA = 0.1
END = np.uint64(0x5851F42D4C957F2D)
BEGIN = np.uint64(0x14057B7EF767814F)
_CLASS_OF = (tb.mix(np.arange(1 << 16)) % np.uint64(CLASSES - 1) + np.uint64(1)).astype(np.uint8)  # by a token's last two bytes
_KIND_SEED = [np.uint64(x) for x in (0x9E37, 0x79B9, 0x7F4A)]


def tokens(buf: np.ndarray, offsets: np.ndarray):
    """``(hash, class, doc)`` of all tokens, each text closed by its end."""
    start, end, doc = tb.words(buf, offsets, ~tb.IS_SPACE)
    lower = np.frombuffer(buf.tobytes().translate(tb.ASCII_LOWER.tobytes()), dtype=np.uint8)
    n = len(offsets) - 1
    at = np.arange(len(start)) + doc
    close = np.searchsorted(doc, np.arange(n), side="right") + np.arange(n)
    key = np.full(len(start) + n, END, dtype=np.uint64)
    kind = np.zeros(len(start) + n, dtype=np.uint8)
    owner = np.empty(len(start) + n, dtype=np.int64)
    owner[at], owner[close] = doc, np.arange(n)
    if len(start):
        key[at] = tb.RangeHash(lower)(start, end)
        tail = lower[end - 1].astype(np.uint16) * np.uint16(256) + lower[np.maximum(end - 2, start)]
        kind[at] = _CLASS_OF[tail]
    return key, kind, owner


def before(key: np.ndarray, owner: np.ndarray, begin=BEGIN) -> tuple[np.ndarray, np.ndarray]:
    """The previous token and the one before it, for every token."""
    one, two = np.full_like(key, begin), np.full_like(key, begin)
    same = owner[1:] == owner[:-1]
    one[1:][same] = key[:-1][same]
    same = owner[2:] == owner[:-2]
    two[2:][same] = key[:-2][same]
    return one, two


def pair(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Previous token, skip and n-gram."""
    return one, two, one + tb.mix(two)


def context(key: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Rows of the three feature tables of the class softmax for every token."""
    parts = pair(*before(key, owner))
    return [(tb.mix(p + seed) & np.uint64(ROWS - 1)).astype(np.uint16) for p, seed in zip(parts, _KIND_SEED)]


def log_classes(weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Natural log class probabilities, tokens by classes."""
    z = weights[0].take(rows[0], axis=0, mode="clip")
    for w, r in zip(weights[1:], rows[1:]):
        z += w.take(r, axis=0, mode="clip")
    most = z
    while most.shape[1] > 1:  # halves of the columns: faster than a maximum over short rows
        half = most.shape[1] // 2
        most = np.maximum(most[:, :half], most[:, half:])
    z -= most
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def _update(weights, squares, rows, kind) -> None:
    """One AdaGrad step on a batch; sparse rows summed by sorted runs."""
    g = log_classes(weights, rows)
    np.exp(g, out=g)
    g[np.arange(len(kind)), kind] -= 1
    for k, r in enumerate(rows):
        order = np.argsort(r, kind="stable")
        r = r[order]
        heads = tb.runs(r)
        step = np.add.reduceat(g.take(order, axis=0, mode="clip"), heads, axis=0)
        hit = r[heads]
        squares[k][hit] += step**2
        weights[k][hit] -= RATE * step / np.sqrt(squares[k][hit] + 1)


def train(texts: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weights ``(3, ROWS, CLASSES)`` from the rows with ``train``."""
    ready(texts.sparkSession)
    weights = np.zeros((3, ROWS, CLASSES), dtype=np.float32)
    only = texts.where("train").select("text")
    for _ in range(rounds):
        begin = weights

        def run(batches):
            own, squares, n = begin.copy(), np.zeros_like(begin), 0
            for batch in batches:
                for _, buf, offsets in tb.text_chunks(batch.column(0)):
                    key, kind, owner = tokens(buf, offsets)
                    rows = context(key, owner)
                    for a in range(0, len(key), BATCH):
                        _update(own, squares, [r[a : a + BATCH] for r in rows], kind[a : a + BATCH])
                    n += len(key)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(PARTS), pa.int32()), pa.array([TaskContext.get().partitionId()] * PARTS, pa.int64()),
                     pa.array([squeeze(part) for part in own.reshape(PARTS, -1)], pa.binary()), pa.array([float(n)] * PARTS)],
                    names=["part", "flush", "blob", "n"])

        def mean(rows):
            total = sum(expand(blob, np.float32)[0].astype(np.float64) * n for _, _, blob, n in rows)
            total /= sum(n for *_, n in rows)
            yield pa.RecordBatch.from_arrays([pa.array([rows[0][0]], pa.int32()), pa.array([total.astype(np.float32).tobytes()])],
                                             names=["part", "blob"])

        own = only.mapInArrow(run, "part int, flush long, blob binary, n double")
        weights = np.zeros((PARTS, weights.size // PARTS), dtype=np.float32)
        for part, blob in by_key(own, "part", min(PARTS, partitions(texts.sparkSession)), mean, "part int, blob binary").collect():
            weights[part] = np.frombuffer(blob, dtype=np.float32)
        weights = weights.reshape(3, ROWS, CLASSES)
    return weights


def squeezed(blob: bytes) -> bytes:
    return len(blob).to_bytes(8, "little") + pa.compress(blob, codec="zstd", asbytes=True)


def squeeze(*arrays: np.ndarray) -> bytes:
    """The arrays as one compressed blob."""
    return squeezed(tb.pack(*arrays))


def numbered(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and the number of each entry among them; entries are below ``n``."""
    if n > 16 * len(x):
        return np.unique(x, return_inverse=True)
    seen = np.zeros(n, dtype=bool)
    seen[x] = True
    value = np.flatnonzero(seen)
    number = np.empty(n, dtype=np.uint32)
    number[value] = np.arange(len(value), dtype=np.uint32)
    return value, number[x]


def steps(x: np.ndarray) -> np.ndarray:
    """The first value and the steps between neighbours; ``np.cumsum`` of them, in the type of ``x``, is ``x``."""
    return np.diff(x, prepend=x.dtype.type(0))


def table(x: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of ``x`` and the number of each entry among them. Values go by the bits of their
    count, the most frequent first, then by hash: so both numbers and steps between hashes compress."""
    value, number = numbered(x, len(hashes))
    _, bits = np.frexp(np.bincount(number, minlength=len(value)))
    key = hashes[value].astype(np.uint64)
    key >>= np.uint64(6 if hashes.itemsize == 8 else 0)
    key |= (np.uint64(63) - bits.astype(np.uint64)) << np.uint64(58)
    order = np.argsort(key)
    place = np.empty(len(value), dtype=np.uint32)
    place[order] = np.arange(len(value), dtype=np.uint32)
    return value[order], place[number]


def by_count(count: np.ndarray) -> np.ndarray:
    """A flush's distinct tokens (ascending by hash) by their training count in it, the most frequent
    first: their numbers are small, so sequences of them compress."""
    return np.argsort(-count.astype(np.int64), kind="stable")


def expand(blob: bytes, *dtypes) -> list[np.ndarray]:
    plain = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    return tb.unpack(plain, *dtypes)


ASK = (np.uint64, np.uint32, np.uint8)  # step to the token hash, training count in the flush, class
DOC = (np.int64, np.uint8, np.uint8, np.uint32, np.float64)  # id, id is null, held out, tokens, class log10


def requests(texts: DataFrame, weights: np.ndarray) -> DataFrame:
    """Per flush: requests by bucket (``bucket >= 0``), which are all its distinct tokens, and one
    row of its documents and its token sequence, by places in ``by_count`` (``bucket = -1``)."""
    n_buckets = buckets(texts.sparkSession)
    schema = pa.schema([("flush", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary()), ("docs", pa.binary())])

    def flush(number, held):
        key, kind, trained = (np.concatenate([h[k] for h in held]) for k in range(3))
        first = np.cumsum([0] + [len(h[0]) for h in held])
        distinct, place = np.unique(key, return_inverse=True)
        count = np.bincount(place, weights=trained, minlength=len(distinct)).astype(np.uint32)
        kinds = np.empty(len(distinct), dtype=np.uint8)
        kinds[place] = kind
        bucket = (distinct >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)  # rises with the hash
        heads = tb.runs(bucket)
        rows = [(number, int(bucket[a]), squeeze(steps(distinct[a:b]), count[a:b], kinds[a:b]), b"")
                for a, b in zip(heads, np.append(heads[1:], len(distinct)))]
        docs = tb.pack(*(np.concatenate([h[4][k] for h in held]).astype(t) for k, t in enumerate(DOC)))
        rank = np.empty(len(distinct), dtype=np.uint32)
        rank[by_count(count)] = np.arange(len(distinct), dtype=np.uint32)
        place = rank[place]
        rows.append((number, -1, squeeze(np.concatenate([place[a + h[3]] for a, h in zip(first, held)])), docs))
        for a in range(0, len(rows), 128):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 128]), schema.types)],
                                             schema=schema)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            trains = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                key, kind, owner = tokens(buf, offsets)
                rows = context(key, owner)
                n = len(offsets) - 1
                logp = np.empty(len(key))
                for a in range(0, len(key), BATCH):
                    part = log_classes(weights, [r[a : a + BATCH] for r in rows])
                    logp[a : a + BATCH] = part[np.arange(len(part)), kind[a : a + BATCH]]
                here = slice(at, at + n)
                docs = (ids[here], null[here], ~trains[here], np.bincount(owner, minlength=n),
                        np.bincount(owner, weights=logp, minlength=n) / np.log(10))
                distinct, first, place = np.unique(key, return_index=True, return_inverse=True)
                trained = np.bincount(place, weights=trains[here][owner], minlength=len(distinct))
                held.append((distinct, kind[first], trained, place.astype(np.uint32), docs))
                size += len(key)
                if size >= FLUSH:
                    yield from flush(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield from flush(number, held)

    return texts.select("doc_id", "text", "train").mapInArrow(
        run, "flush long, bucket int, blob binary, docs binary")


def answers(asked: DataFrame) -> DataFrame:
    """Per flush and bucket the corpus counts of its tokens in the order of the request, and per bucket a
    row (``flush`` null) with the training tokens and distinct training tokens
    of each class."""
    n = partitions(asked.sparkSession)
    schema = pa.schema([("flush", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary()), ("n", pa.list_(pa.int64())),
                        ("v", pa.list_(pa.int64()))])

    def bucket(number, rows):
        parts = [expand(blob, *ASK) for _, blob in rows]
        sizes = [len(p[0]) for p in parts]
        step, count, kind = zip(*parts)
        key, count, kind = np.concatenate([np.cumsum(x) for x in step]), np.concatenate(count), np.concatenate(kind)
        distinct, first, group = np.unique(key, return_index=True, return_inverse=True)
        total = np.bincount(group, weights=count, minlength=len(distinct)).astype(np.int64)
        known = total > 0
        k = kind[first][known]
        out = [(None, number, b"", np.bincount(k, weights=total[known], minlength=CLASSES).astype(np.int64).tolist(),
                np.bincount(k, minlength=CLASSES).tolist())]
        at = np.concatenate([[0], np.cumsum(sizes)])
        for (flush, _), a, b in zip(rows, at[:-1], at[1:]):
            out.append((flush, number, squeeze(total[group[a:b]]), None, None))
        for a in range(0, len(out), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[a : a + 256]), schema.types)],
                                             schema=schema)

    def run(batches):
        current, held = None, []
        for batch in batches:
            for b, flush, blob in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if b != current and held:
                    yield from bucket(current, held)
                    held = []
                current = b
                held.append((flush, blob))
        if held:
            yield from bucket(current, held)

    asks = asked.where("bucket >= 0").select("bucket", "flush", "blob")
    return asks.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(
        run, "flush long, bucket int, blob binary, n array<long>, v array<long>")


def by_key(rows: DataFrame, key: str, n: int, per_key, schema: str) -> DataFrame:
    """Rows ``(key, ...)`` of one key meet in one task, key after key, in the order of
    ``flush``: ``per_key(list of rows)`` yields record batches of ``schema``."""

    def run(batches):
        current, held = None, []
        for batch in batches:
            for cells in zip(*batch.columns):
                row = [x.as_py() for x in cells]  # a batch may hold several keys' blobs: one key's are copied
                if row[0] != current and held:
                    yield from per_key(held)
                    held = []
                current = row[0]
                held.append(row)
        if held:
            yield from per_key(held)

    order = [key] if key == "flush" else [key, "flush"]
    return rows.repartition(n, key).sortWithinPartitions(*order).mapInArrow(run, schema)


WORD = (np.uint64, np.uint8, np.int64)  # step to the token hash, class, training count
EVENT = (np.uint32, np.uint32, np.uint32, np.uint32)  # word, previous, skip, steps between doc numbers
RUN = (np.uint32, np.uint32)  # group, tokens
BASE = (np.int64, np.float64)  # known tokens, sum of log10(c + 0.1)


def routed(asked: DataFrame, answered: DataFrame, n_class: np.ndarray) -> DataFrame:
    """Per flush one row of its documents with their base counts (``bucket < 0``) and its tokens
    with their contexts by bucket of groups. Neighbouring groups, mostly of one class, share a bucket,
    and a blob is in the order of groups and documents: so it has few words and compresses. Only the
    answers are shuffled if ``asked`` is bucketed by flush."""
    spark = asked.sparkSession
    split = np.maximum(1, -(-n_class.astype(np.int64) // GROUP)).astype(np.uint64)
    first_group = np.concatenate([[0], np.cumsum(split)[:-1]]).astype(np.uint64)
    n_groups = int(split.sum())
    width = max(1, n_groups // max(partitions(spark), int(n_class.sum()) // BUCKET))  # groups of a bucket
    schema = pa.schema([("flush", pa.int64()), ("bucket", pa.int64()), ("words", pa.list_(pa.binary())), ("blob", pa.binary()),
                        ("base", pa.binary())])

    def send(sent, got):
        number = sent["flush"][0].as_py()
        blobs = dict(zip(sent["bucket"].to_pylist(), zip(sent["blob"].to_pylist(), sent["docs"].to_pylist())))
        totals = dict(zip(got["bucket"].to_pylist(), got["blob"].to_pylist()))
        blob, doc_blob = blobs.pop(-1)
        (place,) = expand(blob, np.uint32)
        docs = tb.unpack(doc_blob, *DOC)
        n_tokens = docs[3]
        step, here, kind = zip(*(expand(blobs[b][0], *ASK) for b in sorted(blobs)))
        key, here, kind = np.concatenate([np.cumsum(x) for x in step]), np.concatenate(here), np.concatenate(kind)
        count = np.concatenate([expand(totals[b], np.int64)[0] for b in sorted(blobs)])
        del blob, blobs, totals
        order = by_count(here)
        key, kind, count = key[order], kind[order], count[order]
        doc = np.repeat(np.arange(len(n_tokens), dtype=np.uint32), n_tokens)
        known = np.bincount(doc, weights=(count > 0)[place], minlength=len(n_tokens)).astype(np.int64)
        free = np.bincount(doc, weights=np.log10(count + ALPHA)[place], minlength=len(n_tokens))
        out = [(number, -1 - number, [], doc_blob, tb.pack(known, free))]
        one, two = before(place, doc, np.uint32(len(key)))  # by place; the begin of a text is behind all
        hashed = np.append(key, BEGIN)
        short = (hashed >> np.uint64(32)).astype(np.uint32)
        often = np.append(count > GROUP, False)
        at = np.empty(len(place), dtype=np.uint64)
        for a in range(0, len(at), 1 << 20):
            part = slice(a, a + (1 << 20))
            share = hashed[one[part]]
            spread = np.flatnonzero(often[one[part]])
            share[spread] += tb.mix(hashed)[two[part][spread]]
            c = kind[place[part]]
            at[part] = first_group[c] + tb.mix(share) % split[c]
        at <<= np.uint64(32)
        at |= np.arange(len(place), dtype=np.uint64)
        at.sort()  # by group, in a group by place in the flush
        group = (at >> np.uint64(32)).astype(np.uint32)
        at &= np.uint64(0xFFFFFFFF)
        at = at.astype(np.uint32)
        trains = docs[2] == 0
        heads = tb.runs(group // np.uint32(width))
        for a, b in zip(heads, np.append(heads[1:], len(group))):
            here, own = at[a:b], group[a:b]
            first = tb.runs(own)
            used, word = table(place[here], hashed)
            (before_one, at_one), (before_two, at_two) = (table(x[here], short) for x in (one, two))
            words = (squeeze(steps(key[used]), kind[used], count[used]), squeeze(steps(short[before_one])),
                     squeeze(steps(short[before_two])),
                     squeeze(own[first], np.diff(np.append(first, b - a)).astype(np.uint32)), squeeze(np.packbits(trains[doc[here]])))
            out.append((number, int(own[0]) // width, words, squeeze(word, at_one, at_two, steps(doc[here])), b""))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), schema.types)], schema=schema)

    got = answered.where("flush is not null").select("flush", "bucket", "blob")
    return asked.groupBy("flush").cogroup(got.groupBy("flush")).applyInArrow(
        send, "flush long, bucket long, words array<binary>, blob binary, base binary")


def tree(mass: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shannon's code of leaves with these masses: per leaf (from ``at``) its branches and
    turns, and per branch the log odds of turn 1."""
    order = np.argsort(-mass, kind="stable")
    share = mass[order] / mass.sum()
    length = np.maximum(1, np.ceil(-np.log2(share) - 1e-9)).astype(np.int64)
    length = np.maximum.accumulate(length)
    units = np.int64(1) << (length.max() - length)
    code = (np.cumsum(units) - units) >> (length.max() - length)
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(len(order))
    sorted_length, sorted_code = length, code
    length, code = length[back], code[back]
    leaf = np.repeat(np.arange(len(mass)), length)
    depth = np.arange(len(leaf)) - np.repeat(np.cumsum(length) - length, length)
    rest = length[leaf] - depth
    turn = (code[leaf] >> (rest - 1)) & 1
    branch, first, n = np.empty(len(leaf), dtype=np.int64), np.cumsum(length) - length, 0
    for d in range(int(sorted_length[-1])):  # codes rise, so a depth's branches are runs of equal beginnings
        deep = np.searchsorted(sorted_length, d, side="right")
        begin = sorted_code[deep:] >> (sorted_length[deep:] - d)
        number = np.cumsum(np.append(False, begin[1:] != begin[:-1]))
        branch[first[order[deep:]] + d] = n + number
        n += int(number[-1]) + 1
    right = np.bincount(branch, weights=mass[leaf] * turn)
    left = np.bincount(branch, weights=mass[leaf] * (1 - turn))
    real = (right > 0) & (left > 0)  # the other branches have one way only
    odds = np.log(right[real] / left[real])
    keep = real[branch]
    renumber = np.cumsum(real) - 1
    at = np.concatenate([[0], np.cumsum(np.bincount(leaf[keep], minlength=len(mass)))])
    return at, renumber[branch[keep]], turn[keep], odds


def inside(word: np.ndarray, one: np.ndarray, two: np.ndarray, trains: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Natural log of ``P(token | class, context)`` of a group's tokens. ``word`` numbers
    them, ``share`` is each word's smoothed relative frequency in the class."""
    count = np.bincount(word[trains], minlength=len(share))
    leaves = np.flatnonzero(count)
    other = max(1.0 - share[leaves].sum(), 1e-12)
    mass = np.append(count[leaves] + len(leaves) * share[leaves], max(len(leaves), 1) * other)
    at, branch, turn, odds = tree(mass)
    leaf = np.full(len(share), len(leaves))
    leaf[leaves] = np.arange(len(leaves))
    extra = np.where(count > 0, 0.0, np.log(share / other))
    one, two = one.astype(np.uint64), two.astype(np.uint64)
    order = np.argsort(one << np.uint64(32) | tb.mix(two << np.uint64(32) | word.astype(np.uint64)) >> np.uint64(32))
    word, one, two = word[order], one[order], two[order]
    new = np.ones(len(word), dtype=bool)
    new[1:] = (word[1:] != word[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    heads = np.flatnonzero(new)  # equal tokens of equal contexts are fitted once, by their number
    word, one, two = word[heads], one[heads], two[heads]
    seen = np.add.reduceat(trains[order].astype(np.float64), heads)
    size = np.diff(at)[leaf[word]]
    bits = max(1, int(seen @ size).bit_length())  # a row or more for each branch passed in training
    token = np.repeat(np.arange(len(word), dtype=np.uint32), size)  # of every branch passed
    start = at[leaf[word]] - np.cumsum(size) + size
    node, bit, z = np.empty(len(token), dtype=np.uint32), np.empty(len(token), dtype=bool), np.empty(len(token))
    parts = [slice(a, min(a + PART, len(token))) for a in range(0, len(token), PART)]
    for part in parts:
        step = start.take(token[part].astype(np.intp), mode="clip")
        step += np.arange(part.start, part.stop)
        node[part], bit[part] = branch.take(step, mode="clip"), turn.take(step, mode="clip")
        z[part] = odds.take(node[part].astype(np.intp), mode="clip")
    down = tb.mix(np.arange(len(odds), dtype=np.uint64) + END)
    row = np.empty(len(token), dtype=np.uint32)
    sums = np.empty(1 << bits, dtype=np.complex128)  # slopes and curvatures of a row lie side by side
    for c, seed in zip(pair(one, two), _KIND_SEED):  # a Newton step for each feature
        hashes = tb.mix(c + seed)
        sums[:] = 0
        for part in parts:
            owner = token[part].astype(np.intp)
            r = hashes.take(owner, mode="clip")
            r += down.take(node[part].astype(np.intp), mode="clip")
            r *= np.uint64(0x9E3779B97F4A7C15)
            r >>= np.uint64(64 - bits)
            row[part] = r
            number = seen.take(owner, mode="clip")
            p = np.exp(-z[part])
            p += 1
            np.reciprocal(p, out=p)
            both = np.empty(len(p), dtype=np.complex128)
            both.real = (bit[part] - p) * number
            p *= 1 - p
            both.imag = p * number
            np.add.at(sums, r.view(np.int64), both)
        for part in parts:
            both = sums.take(row[part].astype(np.intp), mode="clip")
            z[part] += np.clip(both.real / (both.imag + PENALTY), -4, 4)
    cost = np.zeros(len(word))
    for part in parts:
        p = np.exp(z[part] * (1 - 2.0 * bit[part]))
        p += 1
        np.add.at(cost, token[part].astype(np.intp), np.log(p, out=p))
    logp = extra[word] - cost
    out = np.empty(len(order))
    out[order] = np.repeat(logp, np.diff(np.append(heads, len(order))))
    return out


def inner(events: DataFrame, n_class: np.ndarray, v_class: np.ndarray) -> DataFrame:
    """Per flush and bucket of groups the log10 probabilities of tokens inside their
    class, summed by document; the rows of documents pass."""
    below = n_class + ALPHA * (v_class + 1)
    schema = pa.schema([("flush", pa.int64()), ("blob", pa.binary()), ("base", pa.binary())])

    def bucket(rows):
        if rows[0][0] < 0:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*((r[1], r[3], r[4]) for r in rows)), schema.types)],
                                             schema=schema)
            return
        known = [expand(r[2][0], *WORD) for r in rows]
        first_word = np.cumsum([0] + [len(x[0]) for x in known])
        step, kind, count = zip(*known)
        key, kind, count = np.concatenate([np.cumsum(x) for x in step]), np.concatenate(kind), np.concatenate(count)
        parts = [expand(r[3], *EVENT) for r in rows]
        size = [len(p[0]) for p in parts]
        one, two = (np.concatenate([np.cumsum(expand(r[2][k], np.uint32)[0], dtype=np.uint32)[p[k]] for r, p in zip(rows, parts)])
                    for k in (1, 2))
        doc = [np.cumsum(p[3], dtype=np.uint32) for p in parts]
        group = np.concatenate([np.repeat(*expand(r[2][3], *RUN)) for r in rows])
        trains = np.concatenate([np.unpackbits(expand(r[2][4], np.uint8)[0], count=n) for r, n in zip(rows, size)]).astype(bool)
        _, first, same = np.unique(key, return_index=True, return_inverse=True)
        share = (count[first] + ALPHA) / below[kind[first]]
        same = same.astype(np.uint32)
        word = np.concatenate([same[a + p[0]] for a, p in zip(first_word, parts)])
        del parts, known, step
        order = np.argsort(group - group.min(), kind="stable")
        heads = tb.runs(group[order])
        logp = np.empty(len(word))
        for a, b in zip(heads, np.append(heads[1:], len(order))):
            here = order[a:b]
            used, local = numbered(word[here], len(share))
            logp[here] = inside(local, one[here], two[here], trains[here], share[used])
        at = np.concatenate([[0], np.cumsum(size)])
        out = []
        for r, d, a, b in zip(rows, doc, at[:-1], at[1:]):
            docs = np.flatnonzero(np.bincount(d))
            total = np.bincount(d, weights=logp[a:b])[docs] / np.log(10)
            out.append((r[1], squeeze(steps(docs.astype(np.uint32)), total.astype(np.float32)), b""))
        for a in range(0, len(out), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[a : a + 256]), schema.types)], schema=schema)

    return by_key(events.select("bucket", "flush", "words", "blob", "base"), "bucket", partitions(events.sparkSession), bucket,
                  "flush long, blob binary, base binary")


def scores(found: DataFrame, n_class: np.ndarray, v_class: np.ndarray) -> DataFrame:
    total, distinct = int(n_class.sum()), int(v_class.sum())
    base = np.log10(total + ALPHA * (distinct + 1))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def judge(rows):
        sent = next(r for r in rows if r[2])
        ids, null, held_out, n_tokens, class_log = tb.unpack(sent[1], *DOC)
        known, free = tb.unpack(sent[2], *BASE)
        logs = np.array(class_log)
        parts = [expand(r[1], np.uint32, np.float32) for r in rows if not r[2]]
        doc, part = np.concatenate([np.cumsum(p[0]) for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.lexsort((part, doc))  # one order of summing, whatever order the parts come in
        logs = logs + np.bincount(doc[order], weights=part[order], minlength=len(ids))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=null.astype(bool)), pa.array(held_out.astype(bool)), pa.array(n_tokens.astype(np.int64)),
             pa.array(known), pa.array(np.full(len(ids), total)), pa.array(free - n_tokens * base), pa.array(logs)], names=names)

    return by_key(found, "flush", partitions(found.sparkSession), judge,
                  "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def with_fold(docs: DataFrame, modulus: int) -> DataFrame:
    """``doc_id``, ``text`` and ``train``: crc32 of the id as text, modulo
    ``modulus``, is not 0."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus
    return docs.select(F.col("doc_id").cast("long"), "text", (fold != 0).alias("train"))


def score_documents(docs: DataFrame, modulus: int = 10, rounds: int = ROUNDS) -> DataFrame:
    """Train on the rows outside fold 0 and score every row."""
    texts = with_fold(docs, modulus)
    asked = stored_by(requests(texts, train(texts, rounds)), "lm-requests", "flush")
    answered = stored(answers(asked), "lm-answers")
    totals = (answered.where("flush is null").select(F.posexplode(F.arrays_zip("n", "v")).alias("k", "x"))
              .groupBy("k").agg(F.sum("x.n").alias("n"), F.sum("x.v").alias("v")).toPandas())
    n_class, v_class = np.zeros(CLASSES), np.zeros(CLASSES)
    n_class[totals["k"]], v_class[totals["k"]] = totals["n"], totals["v"]
    return scores(inner(routed(asked, answered, n_class), n_class, v_class), n_class, v_class)
