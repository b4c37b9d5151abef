"""MinHash near-duplicates by fast similarity sketching.

A sketch has ``BINS`` coordinates, filled in rounds: in round ``i`` every shingle of
the set falls into a hashed bin and leaves ``(i, hash)`` there if that is less than
what the bin holds. A set is done when all its bins are full, so a large set takes a
round or two and a small one some more; from round ``BINS`` on, round ``BINS + b``
puts all shingles into bin ``b``, which fills every coordinate of any set. Two sets
agree in a coordinate with probability their similarity, and the number of agreeing
coordinates is concentrated at least as if coordinates were drawn one by one.

``ROWS`` coordinates make a band; sets that share a band meet. At similarity 0.8 a
pair shares none of the 60 bands with probability ``(1 - 0.8^6)^60``, about 1e-8.

Bands never yield all their pairs. Equal sets are one node. First every node is
compared with one leader, the smallest node it meets, on full sets; most groups of
copies become one component by that. Only bands that still hold several components
go on. ``PASSES`` times the smallest node of such a band is compared with the band's
other components, each pair once for all bands, and leaves the band; components merge.
In the bands that are open after that (overlapping ones taken as one) all pairs of different components are compared
on full sets, in cells of at most ``CELL_ROWS`` rows a side, the largest component
never with itself, and a cell emits a spanning forest of its links. Links count once
per pair of components, so a band's many links cost one edge.

Defined cases: null and empty texts have no shingles and link with nothing; a text
with fewer words than a shingle has one, its word sequence; rows without doc_id link
like others, get the component of the rows that they resemble, and are kept only
where no row with an id resembles them; rows of one doc_id with different texts are
nodes of their own; repeated rows share their component, and all rows with the
component's id are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm import textbytes as tb
from clicklens.llm.exchange import components, emit, partitions, ready, stored
from clicklens.llm.jaccard import set_ids, shingles

WORDS, PERCENT = 2, 80
BINS, ROWS = 360, 6
PASSES = 1  # times that the smallest node of an open band is compared with the band
LEADER_ROWS = 512  # rows of one leader that a task compares
CELL_ROWS, CELL_SHINGLES = 256, 400_000
LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def sketch(key: np.ndarray, owner: np.ndarray, n: int, bins: int = BINS) -> np.ndarray:
    """Coordinates of ``n`` sets given by ``(shingle, set)`` sorted by set; sets
    without shingles keep the largest value throughout."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * bins, full)
    for i in range(2 * bins):
        if not len(key):
            break
        h = tb.mix(key + tb.mix(np.array([i + 1], np.uint64))[0])
        place = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32) if i < bins else np.uint64(i - bins)
        np.minimum.at(out, owner * bins + np.asarray(place).astype(np.int64), (np.uint64(i) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF)))
        live = np.unique(owner)
        short = live[(out.reshape(n, bins)[live] == full).any(axis=1)]
        if len(short) < len(live):
            more = np.zeros(n, bool)
            more[short] = True
            use = more[owner]
            key, owner = key[use], owner[use]
    return out.reshape(n, bins)


def band_keys(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band of ``rows`` coordinates."""
    n, bins = coordinates.shape
    parts = coordinates.reshape(n, bins // rows, rows)
    key = np.broadcast_to(np.arange(1, bins // rows + 1, dtype=np.uint64), parts.shape[:2])
    for r in range(rows):
        key = tb.mix(parts[:, :, r] + tb.mix(key))
    return key


def sketched(docs: DataFrame, k: int) -> DataFrame:
    """Per row: ``doc_id, text_key, n_shingles, set_id, set_id2, bands``."""
    ready(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for at, buf, offsets in tb.text_chunks(batch.column(2)):
                n = len(offsets) - 1
                key, owner = shingles(buf, offsets, k)
                size, one, two = set_ids(key, owner, n)
                some = np.flatnonzero(size)
                number = np.cumsum(size > 0) - 1
                bands = band_keys(sketch(key, number[owner], len(some)))
                ends = np.concatenate([[0], np.cumsum(size > 0)]) * bands.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(size.astype(np.int64)),
                     pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(bands.reshape(-1).view(np.int64)))],
                    names=["doc_id", "text_key", "n_shingles", "set_id", "set_id2", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, set_id long, set_id2 long, bands array<long>")


def sets_of(texts: list[str], k: int):
    """``(shingle, row)`` of the texts, and the sizes."""
    keys, rows, at = [], [], 0
    for _, buf, offsets in tb.text_chunks(pa.array(texts, pa.large_string())):
        key, owner = shingles(buf, offsets, k)
        keys.append(key)
        rows.append(owner + at)
        at += len(offsets) - 1
    key, row = np.concatenate(keys), np.concatenate(rows)
    return key, row, np.bincount(row, minlength=at)


def linked(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return (overlap > 0) & ((100 + percent) * overlap >= percent * (a + b))


def leader_links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """``(a, b)`` of the pairs ``(lead, node)`` that are similar on full sets. The
    nodes of a leader are dealt over as many tasks as they need; each gets one copy
    of the leader's text."""
    spark = texts.sparkSession
    need = pairs.groupBy("lead").agg(F.ceil(F.count("*") / LEADER_ROWS).cast("int").alias("slots"))
    dealt = pairs.join(need, "lead").select("lead", "node", F.pmod(F.xxhash64("node"), F.col("slots")).cast("int").alias("slot"))
    leaders = need.select("lead", F.col("lead").alias("node"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
    rows = dealt.unionByName(leaders).join(texts, "node").select("lead", "slot", (F.col("node") != F.col("lead")).alias("member"), "node", "text")

    def run(batches):
        lead, base, base_size = None, None, 0
        for batch in batches:
            leads, slots, member, node, text = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(node):
                if not member[at]:
                    lead, (base, _, size) = node[at], sets_of([text[at]], k)
                    base_size, at = size[0], at + 1
                    continue
                end = at
                while end < len(node) and member[end] and leads[end] == lead:
                    end += 1
                key, row, size = sets_of(text[at:end], k)
                spot = np.minimum(np.searchsorted(base, key), len(base) - 1)
                overlap = np.bincount(row[base[spot] == key], minlength=end - at)
                for i in np.flatnonzero(linked(overlap, size, base_size, percent)):
                    yield lead, node[at + i]
                at = end

    return rows.repartition(partitions(spark), "lead", "slot").sortWithinPartitions("lead", "slot", "member").mapInArrow(
        lambda b: emit(run(b), LINK), "a long, b long")


def cell_links(texts: list[str], label: np.ndarray, skip: np.ndarray, k: int, percent: int):
    """Spanning links, as index pairs, between rows of different labels; rows that
    ``skip`` marks are not compared with each other."""
    key, row, size = sets_of(texts, k)
    column = np.unique(key, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    holder, first = row[order], np.concatenate([[0], np.cumsum(np.bincount(column))])
    own_at = np.concatenate([[0], np.cumsum(size)])  # rows of sets_of are in order
    label = np.unique(label, return_inverse=True)[1]
    for u in np.flatnonzero(~skip):
        other = (label != label[u]) & (100 * np.minimum(size, size[u]) >= percent * np.maximum(size, size[u])) & (
            skip | (np.arange(len(size)) > u))
        if not other.any():
            continue
        own = column[own_at[u] : own_at[u + 1]]
        count = first[own + 1] - first[own]
        at = np.repeat(first[own] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        overlap = np.bincount(holder[at], minlength=len(size))
        for v in np.flatnonzero(other & linked(overlap, size, size[u], percent)):
            if label[v] != label[u]:
                yield u, v
                label[label == label[v]] = label[u]


def open_bands(members: DataFrame, families: DataFrame) -> DataFrame:
    """``key, lo, node, family`` of the bands ``members(key, node)`` that hold several
    families, ``lo`` their smallest node; of bands with the same members, one."""
    placed = members.join(families, "node")
    state = placed.groupBy("key").agg(
        F.min("family").alias("f1"), F.max("family").alias("f2"), F.count("*").alias("n"), F.min("node").alias("lo"),
        F.max("node").alias("hi"), F.bit_xor(F.xxhash64("node")).alias("x"))
    state = state.where("f1 < f2").groupBy("n", "lo", "hi", "x").agg(F.min("key").alias("key"))
    return placed.join(state.select("key", "lo"), "key").select("key", "lo", "node", "family")


def overlapping(rest: DataFrame) -> DataFrame:
    """``key, node, family`` of open bands, where bands of one smallest node are taken as
    one, so that pairs they share meet once; not where that is more than twice as many
    nodes as the largest of them has."""
    bands = rest.groupBy("lo", "key").agg(F.count("*").alias("n"))
    whole = rest.select("lo", "node").distinct().groupBy("lo").agg(F.count("*").alias("n"))
    one = bands.groupBy("lo").agg(F.max("n").alias("most")).join(whole, "lo").select("lo", (F.col("n") <= 2 * F.col("most")).alias("one"))
    # by band, as a smallest node's rows are those of all its bands
    return rest.join(bands.select("key", "lo").join(one, "lo").drop("lo"), "key").select(F.when(F.col("one"), F.col("lo")).otherwise(F.col("key")).alias("key"), "node", "family").distinct()


def absorb(families: DataFrame, links: DataFrame) -> DataFrame:
    """``families(node, family)`` after ``links(a, b)`` between nodes: only links between
    different families count, each pair of families once."""
    side = lambda c: families.select(F.col("node").alias(c), F.col("family").alias(f"f{c}"))
    edges = links.distinct().join(side("a"), "a").join(side("b"), "b").where("fa <> fb").select(
        F.least("fa", "fb").alias("a"), F.greatest("fa", "fb").alias("b")).distinct()
    into = components(edges).select(F.col("id").alias("family"), "component")
    return stored(families.join(into, "family", "left").select("node", F.coalesce("component", "family").alias("family")), "families")


def band_links(rows: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Spanning links ``(a, b)`` of all similar rows of different families of a band.
    A band's largest family is dealt to its own slots, which never meet each other."""
    spark = texts.sparkSession
    slots = lambda n, s: F.greatest(F.ceil(n / CELL_ROWS), F.ceil(s / CELL_SHINGLES)).cast("int")
    parts = rows.groupBy("key", "family").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    most = parts.groupBy("key").agg(F.max(F.struct("n", "family", "s")).alias("top"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    plan = most.select("key", F.col("top.family").alias("big"), slots(F.col("top.n"), F.col("top.s")).alias("bigs"),
                       slots(F.col("n") - F.col("top.n"), F.col("s") - F.col("top.s")).alias("smalls"))
    dealt = rows.join(plan, "key").withColumn("skip", F.col("family") == F.col("big")).withColumn(
        "own", F.when(F.col("skip"), F.pmod(F.xxhash64("node"), F.col("bigs"))).otherwise(
            F.col("bigs") + F.pmod(F.xxhash64("node"), F.col("smalls"))).cast("int"))
    spread = dealt.withColumn("other", F.explode(F.sequence(F.when(F.col("skip"), F.col("bigs")).otherwise(F.lit(0)),
                                                            F.col("bigs") + F.col("smalls") - 1)))
    cells = spread.join(texts, "node").select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                                              "node", "family", "skip", "text")

    def links(held):
        node, family, skip, text = zip(*held)
        for u, v in cell_links(list(text), np.array(family), np.array(skip), k, percent):
            yield node[u], node[v]

    def run(batches):
        current, held = None, []
        for batch in batches:
            for key, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, i, j) != current and held:
                    yield from links(held)
                    held = []
                current = (key, i, j)
                held.append(row)
        if held:
            yield from links(held)

    return cells.repartition(partitions(spark), "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        lambda b: emit(run(b), LINK), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id`` (the smallest doc_id
    reachable by links of similarity ``percent`` / 100) and ``kept``."""
    same = ["set_id", "set_id2", "n_shingles"]
    sets = stored(sketched(docs, k), "sets")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    nodes = stored(sets.where("n_shingles > 0").groupBy(*same).agg(first, F.first("bands").alias("bands")).select(
        *same, "bands", "first.doc_id", "first.text_key").withColumn("node", F.monotonically_increasing_id()), "nodes")
    bands = nodes.select("node", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key", "lo")
    met = stored(bands.join(shared, "key"), "bands")
    leads = stored(met.groupBy("node").agg(F.min("lo").alias("lead")), "leads")
    wanted = leads.select("node").join(nodes.select("node", F.col("doc_id").alias("id"), F.col("text_key").alias("t")), "node")
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    texts = stored(rows.join(wanted, (F.col("text_key") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("id")))
                   .groupBy("node").agg(F.first("text").alias("text")), "texts")

    pairs = done = leads.where("lead < node")
    families = absorb(leads.select("node", F.col("node").alias("family")), stored(leader_links(pairs, texts, k, percent), "links"))
    members = met.select("key", "node")
    for _ in range(PASSES):
        # written, so that the joins of a hot band's rows start from it and can be split
        rest = stored(open_bands(members, families), "open")
        own = rest.where("node = lo").select("key", F.col("family").alias("own"))
        pairs = stored(rest.join(own, "key").where("family <> own").select(F.col("lo").alias("lead"), "node").distinct()
                       .join(done, ["lead", "node"], "left_anti"), "pairs")
        families = absorb(families, stored(leader_links(pairs, texts, k, percent), "links"))
        members, done = rest.where("node <> lo").select("key", "node"), done.unionByName(pairs)
    rest = overlapping(stored(open_bands(members, families), "open"))
    rest = stored(rest.join(nodes.select("node", "n_shingles"), "node"), "open")
    families = absorb(families, stored(band_links(rest, texts, k, percent), "links"))
    named = nodes.select("node", *same, F.col("doc_id").alias("low")).join(families, "node", "left").withColumn(
        "component", F.coalesce("family", "node"))
    lowest = named.groupBy("component").agg(F.min("low").alias("lowest"))
    placed = named.join(lowest, "component").select(*same, "lowest")
    out = sets.select("doc_id", *same).join(placed, same, "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("lowest")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
