"""N-gram Jaccard join as a blocked sparse product of the document by n-gram
incidence matrix.

Rows are distinct shingle sets (documents with equal sets are one row, so exact
copies cost nothing further); columns are shingles. The product ``A A^T`` holds
the overlap counts; only cells above the size-derived bound
``overlap >= t / (1 + t) * (n_a + n_b)`` are wanted. Two steps keep the
rest from being computed:

* Sizes. Linked sets have sizes within a factor ``t``, so rows fall into size
  classes and only equal or neighbouring classes meet.
* Column blocks. For a class pair the bound allows at most ``D`` differing
  shingles. The columns are hashed into ``D + 1 + E`` blocks, so a wanted pair
  agrees wholly in more than ``E`` of them. Rows meet by the hash of their
  content in a block (empty blocks too when a row has more than ``E``).

Rows that agree with the smallest row of a block in ``STRONG`` blocks or more
form families. Inside a family the product is accumulated exactly, in row
blocks of at most ``BLOCK_ROWS`` rows and about ``BLOCK_SHINGLES`` shingles: a task
holds two row blocks, adds up their overlap counts over slices of the shingles
both have, drops cells below the bound, and emits a spanning forest of what is
left. So all pairs of a group of near copies are compared and none is emitted,
and a family of any size is spread over its block pairs.

Rows of one block that are in different families (they share a passage, say)
are the other cells that can be above the bound. Parity sketches of the sets
prune them: the sketches differ in at most as many bits as the sets differ in
shingles, so a pair that differs in more bits than the bound allows is out. The
sketches of a block are compared inside tasks, in row blocks too, and a pair
that stays merges its families (a spanning forest is emitted, no pairs). So every
link is inside a merged family, where the exact product finds it.

Defined cases: null and empty texts have no shingles and link with nothing;
a text with fewer words than a shingle has one shingle, its word sequence;
repeated rows share a component; rows of one doc_id with different texts are rows
of their own; a null doc_id has a null component and never links, unless rows
without doc_id are asked to take part (``unnamed``): then they link like others and
get the component of the rows they resemble; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm import textbytes as tb
from clicklens.llm.exchange import buckets, components, packed_shuffle, partitions, ready, stored

WORDS, PERCENT = 3, 90
FLUSH = 1_500_000  # block hashes held by a task before they are sent
BLOCK_ROWS, BLOCK_SHINGLES, COLUMNS = 512, 400_000, 2048
STRONG = 2
SKETCH_BITS = (64, 4096)
CELL = (np.uint64, np.uint64, np.uint8)
ALONE, MATES, SETTLED = 0, 1, 2


def shingles(buf: np.ndarray, offsets: np.ndarray, k: int):
    """Distinct shingles of every text: ``(hash, doc)`` sorted by both."""
    lower = tb.ASCII_LOWER[buf]
    start, end, doc = tb.words(buf, offsets, ~tb.IS_SPACE)
    word = tb.RangeHash(lower)(start, end)
    n = len(offsets) - 1
    count = np.bincount(doc, minlength=n)
    full = np.flatnonzero(doc[k - 1 :] == doc[: len(doc) - k + 1]) if len(doc) >= k else np.zeros(0, np.int64)
    key = np.full(len(full), np.uint64(k))
    for i in range(k):
        key = tb.mix(word[full + i] + tb.mix(key))
    first = np.cumsum(count) - count
    short = np.flatnonzero((count > 0) & (count < k))
    extra = count[short].astype(np.uint64)
    for i in range(k - 1):
        more = count[short] > i
        extra[more] = tb.mix(word[first[short[more]] + i] + tb.mix(extra[more]))
    key, owner = np.concatenate([key, extra]), np.concatenate([doc[full], short])
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return key[new], owner[new]


def set_ids(key: np.ndarray, owner: np.ndarray, n: int):
    """Size and two 64-bit hashes of every document's set."""
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    np.add.at(one, owner, tb.mix(key ^ np.uint64(0x71)))
    np.add.at(two, owner, tb.mix(key ^ np.uint64(0x9D)))
    return np.bincount(owner, minlength=n), tb.mix(one), tb.mix(two)


def sketches(key: np.ndarray, owner: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Parity of the shingles per bit, bits a power of two near the size; a
    longer sketch folds to a shorter one by exclusive or of its halves."""
    bits = np.clip(1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64), *SKETCH_BITS)
    at = np.concatenate([[0], np.cumsum(bits)])
    bit = at[owner] + (tb.mix(key ^ np.uint64(0xB7)) % bits[owner].astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(bit, minlength=at[-1]) & 1).astype(bool)).tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(at[:-1], at[1:])]


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch folded to ``size`` bytes (a power of two part of its length)."""
    x = np.frombuffer(sketch, np.uint8)
    while len(x) > size:
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return x


@lru_cache(maxsize=8)
def size_classes(percent: int, largest: int = 1 << 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First size of every class, and per class pair (c with c or c + 1) the
    blocks and the empty blocks allowed."""
    first, at = [], 1
    while at < largest:
        first.append(at)
        at = at * 100 // percent + 1
    top = np.array([*first[1:], at]) - 1
    differ = (100 - percent) * (top + top * 100 // percent) // (100 + percent)
    empty = 2 + differ // 16
    return np.array(first), np.where(differ > 0, differ + 1 + empty, 0), empty


def block_hashes(key: np.ndarray, owner: np.ndarray, size: np.ndarray, percent: int):
    """``(block hash, doc)`` for both class pairs of every document."""
    first, blocks, empty = size_classes(percent)
    own = np.searchsorted(first, size, side="right") - 1
    out = []
    for pair in (own, own - 1):
        live = (size > 0) & (pair >= 0) & (blocks[pair] > 0)
        n = np.where(live, blocks[pair], 0)
        base = np.cumsum(n) - n
        use = live[owner]
        k, o = key[use], owner[use]
        salted = tb.mix(k + pair[o].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        block = ((salted >> np.uint64(32)) * n[o].astype(np.uint64)) >> np.uint64(32)
        cell = base[o] + block.astype(np.int64)
        total = int(n.sum())
        content = np.zeros(total, np.uint64)
        np.add.at(content, cell, tb.mix(k ^ np.uint64(0xC3)))
        filled = np.zeros(total, bool)
        filled[cell] = True
        doc = np.repeat(np.arange(len(size)), n)
        place = np.arange(total) - base[doc] + (pair[doc] << 32)
        n_empty = np.bincount(doc[~filled], minlength=len(size))
        wanted = filled | (n_empty[doc] > empty[pair[doc]])
        out.append((tb.mix(content[wanted] + tb.mix(place[wanted].astype(np.uint64))), doc[wanted]))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_id, set_id2, sketch`` per row."""
    ready(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for at, buf, offsets in tb.text_chunks(batch.column(2)):
                n = len(offsets) - 1
                key, owner = shingles(buf, offsets, k)
                size, one, two = set_ids(key, owner, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(size.astype(np.int64)),
                     pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(sketches(key, owner, size), pa.binary())],
                    names=["doc_id", "text_key", "n_shingles", "set_id", "set_id2", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, set_id long, set_id2 long, sketch binary")


def block_members(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``(block, set_id)`` of all blocks that several sets share. A task sends
    one set per block and flush; further sets of the block go on as settled."""
    spark = docs.sparkSession
    ready(spark)
    n_buckets = buckets(spark)

    def flush(held):
        block, ids = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((ids, block))
        block, ids = block[order], ids[order]
        new = np.ones(len(block), bool)
        new[1:] = (block[1:] != block[:-1]) | (ids[1:] != ids[:-1])
        block, ids = block[new], ids[new]
        heads = tb.runs(block)
        mates = np.diff(np.append(heads, len(block))) > 1
        rest = np.ones(len(block), bool)
        rest[heads] = False
        yield from tb.by_bucket(block[heads], n_buckets, block[heads], ids[heads], np.where(mates, MATES, ALONE).astype(np.uint8))
        if rest.any():  # bucketed by set, so that no block's members meet
            yield from tb.by_bucket(ids[rest], n_buckets, block[rest], ids[rest], np.full(rest.sum(), SETTLED, np.uint8))

    def send(batches):
        held, count = [], 0
        for batch in batches:
            for _, buf, offsets in tb.text_chunks(batch.column(0)):
                key, owner = shingles(buf, offsets, k)
                size, one, _ = set_ids(key, owner, len(offsets) - 1)
                block, doc = block_hashes(key, owner, size, percent)
                held.append((block, one[doc]))
                count += len(block)
                if count >= FLUSH:
                    yield from flush(held)
                    held, count = [], 0
        if count:
            yield from flush(held)

    def meet(blobs):
        block, ids, state = (np.concatenate(x) for x in zip(*(tb.unpack(b, *CELL) for b in blobs)))
        settled = state == SETTLED
        b, i, s = block[~settled], ids[~settled], state[~settled]
        order = np.lexsort((i, b))
        b, i, s = b[order], i[order], s[order]
        heads = tb.runs(b)
        if len(heads):
            size = np.diff(np.append(heads, len(b)))
            several = (i[heads] != i[heads + size - 1]) | (np.maximum.reduceat(s, heads) == MATES)
            keep = np.repeat(several, size)
            new = np.ones(len(b), bool)
            new[1:] = (b[1:] != b[:-1]) | (i[1:] != i[:-1])
            b, i = b[keep & new], i[keep & new]
        b, i = np.concatenate([b, block[settled]]), np.concatenate([i, ids[settled]])
        if len(b):
            yield pa.RecordBatch.from_arrays([pa.array(b.view(np.int64)), pa.array(i.view(np.int64))],
                                             names=["block", "set_id"])

    return packed_shuffle(docs.select("text"), send, meet, "block long, set_id long")


def forest(link: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each index of a symmetric link matrix."""
    label = np.arange(len(link))
    link = link | np.eye(len(link), dtype=bool)
    while True:
        low = np.where(link, label[None, :], len(link)).min(axis=1)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def product_links(key: np.ndarray, row: np.ndarray, n: int, percent: int) -> np.ndarray:
    """Link matrix of ``n`` rows given by ``(shingle, row)``: overlap counts by
    slices of the columns that at least two rows have."""
    size = np.bincount(row, minlength=n)
    column, place, count = np.unique(key, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[place]
    place, row = number[place[use]], row[use]
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    overlap = np.zeros((n, n), dtype=np.float32)
    for a in range(0, int(shared.sum()), COLUMNS):
        lo, hi = np.searchsorted(place, [a, a + COLUMNS])
        part = np.zeros((n, min(COLUMNS, int(shared.sum()) - a)), dtype=np.float32)
        part[row[lo:hi], place[lo:hi] - a] = 1
        overlap += part @ part.T
    both = size[:, None] + size[None, :]
    return (overlap > 0) & ((100 + percent) * overlap.astype(np.float64) >= percent * both)


def family_links(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Spanning links ``(a, b)`` of all similar rows of every family, the same ones in
    whatever order rows come. ``members``: ``row, n_shingles, family``; ``texts``: ``row, text``."""
    spark = texts.sparkSession
    size = members.groupBy("family").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = members.join(size.where("blocks > 0"), "family").withColumn(
        "own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    with_text = placed.join(texts, "row")
    spread = with_text.select("family", "row", "text", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = spread.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "row", "text")

    def links(held):
        ids = np.array([x[0] for x in held], dtype=np.int64)
        keys, rows, at = [], [], 0
        for _, buf, offsets in tb.text_chunks(pa.array([x[1] for x in held], pa.large_string())):
            key, owner = shingles(buf, offsets, k)
            keys.append(key)
            rows.append(owner + at)
            at += len(offsets) - 1
        label = forest(product_links(np.concatenate(keys), np.concatenate(rows), len(ids), percent))
        moved = np.flatnonzero(label != np.arange(len(ids)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(ids[label[moved]]), pa.array(ids[moved])], names=["a", "b"])

    def run(batches):
        current, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(5)]
            for family, i, j, row, text in zip(*columns):
                if (family, i, j) != current and held:
                    yield from links(held)
                    held = []
                current = (family, i, j)
                held.append((row, text))
        if held:
            yield from links(held)

    return cells.repartition(partitions(spark), "family", "i", "j").sortWithinPartitions("family", "i", "j", "row").mapInArrow(
        run, "a long, b long")


def open_blocks(placed: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of blocks with several families, with ``blocks``, the row blocks of their block.
    ``placed``: ``block, row, family``. Families and rows of a block are counted in one pass and
    joined once, a row to a block, so a block of n rows gives n."""
    mixed = placed.groupBy("block").agg(F.min("family").alias("lo"), F.max("family").alias("hi"), F.ceil(
        F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")).where("lo < hi").select("block", "blocks")
    return placed.join(mixed, "block").join(rows.select("row", "n_shingles", "sketch"), "row")


def family_merges(members: DataFrame, percent: int) -> DataFrame:
    """Spanning links ``(a, b)`` of families that hold rows of one block whose
    sketches do not rule out a link. ``members``: ``block, row, family,
    n_shingles, sketch, blocks``."""
    spark = members.sparkSession
    placed = members.withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = spread.select("block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                          "family", "n_shingles", "sketch")

    def merges(held):
        family, n = (np.array([x[c] for x in held], dtype=np.int64) for c in (0, 1))
        least = min(len(x[2]) for x in held)
        bits = np.stack([folded(x[2], least) for x in held])
        near = (family[:, None] != family) & (100 * np.minimum.outer(n, n) >= percent * np.maximum.outer(n, n))
        for i in np.flatnonzero(near.any(axis=1)):
            far = np.bitwise_count(bits ^ bits[i]).sum(axis=1, dtype=np.int64)
            near[i] &= far <= (100 - percent) * (n + n[i]) // (100 + percent)
        label = forest(near)
        moved = np.flatnonzero(label != np.arange(len(n)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(family[label[moved]]), pa.array(family[moved])], names=["a", "b"])

    def run(batches):
        current, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(6)]
            for block, i, j, *row in zip(*columns):
                if (block, i, j) != current and held:
                    yield from merges(held)
                    held = []
                current = (block, i, j)
                held.append(row)
        if held:
            yield from merges(held)

    return cells.repartition(partitions(spark), "block", "i", "j").sortWithinPartitions("block", "i", "j", "family").mapInArrow(
        run, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, unnamed: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id`` (the smallest
    doc_id reachable by links of similarity ``percent`` / 100). ``unnamed``: rows
    without doc_id link too."""
    same = ["set_id", "set_id2", "n_shingles"]
    sets = stored(shingle_sets(docs, k), "sets")
    takes_part = "n_shingles > 0" if unnamed else "n_shingles > 0 and doc_id is not null"
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    rows = stored(sets.where(takes_part).groupBy(*same).agg(first, F.first("sketch").alias("sketch")).select(
        *same, "sketch", "first.doc_id", "first.text_key").withColumn("row", F.monotonically_increasing_id()), "rows")
    named_docs = docs if unnamed else docs.where("doc_id is not null")
    members = stored(block_members(named_docs, k, percent).join(rows.select("set_id", "row"), "set_id")
                     .select("block", "row").distinct(), "blocks")

    low = members.groupBy("block").agg(F.min("row").alias("a"))
    strong = members.join(low, "block").where("row <> a").groupBy("a", F.col("row").alias("b")).agg(
        F.count("*").alias("n")).where(F.col("n") >= STRONG)
    families = stored(components(strong).select(F.col("id").alias("row"), F.col("component").alias("family")), "families")
    placed = members.join(families, "row", "left").select("block", "row", F.coalesce("family", "row").alias("family"))
    merged = components(family_merges(open_blocks(placed, rows), percent)).select(F.col("id").alias("family"), F.col("component").alias("into"))
    known = families.unionByName(merged.select(F.col("family").alias("row"), "family")).distinct()
    whole = stored(known.join(merged, "family", "left").select("row", F.coalesce("into", "family").alias("family")).distinct(), "whole")
    wanted = whole.select("row").distinct().join(rows.select("row", F.col("doc_id").alias("id"), F.col("text_key").alias("t")), "row")
    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key")).join(
        wanted, (F.col("text_key") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("id"))).groupBy("row").agg(F.first("text").alias("text"))
    found = components(family_links(whole.join(rows.select("row", "n_shingles"), "row"), texts, k, percent))
    placed = rows.join(found.select(F.col("id").alias("row"), "component"), "row", "left").withColumn(
        "component", F.coalesce("component", "row"))
    lowest = placed.groupBy("component").agg(F.min("doc_id").alias("lowest"))
    named = sets.select("doc_id", *same).join(placed.join(lowest, "component").select(*same, "lowest"), same, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    if not unnamed:
        component = F.when(F.col("doc_id").isNotNull(), component)
    return named.select("doc_id", "n_shingles", component.alias("component_id"))
