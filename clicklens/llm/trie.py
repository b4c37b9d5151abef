"""Prefix trie of conversations by composable fingerprints.

A conversation can be rebuilt from another one's first turns and its own later
ones. The rebuilt texts are never made: a sequence of turns has the fingerprint
``sum of t_i * B^i mod p`` (``t_i`` the hash of turn ``i``; three lanes of 31 bits),
and fingerprints form a monoid, ``F(xy) = F(x) + B^|x| * F(y)``. So the fingerprint of
any rebuilt prefix follows from prefix products of the stored turns: the base's up
to the head's end, then the difference of two own ones, moved to its new place.
The same monoid joins the pieces of a conversation that was cut: turns are ranged by
(conversation, turn), so that a conversation of any length is spread over tasks.

A node is a depth and a fingerprint. Members carry a reference to the stored turn
that is their last, and groups are verified through these: all members have one
parent fingerprint, and where a group holds several references, their stored roles
and texts are equal. If a check fails, the hashes are drawn again.

Subtree figures need no walk: a node's value sits on its smallest member, every
member adds up its values from its end towards the root (suffix sums per piece, then
over the pieces), and each node sums its members.

Defined cases: null role or text is empty; turns are ordered by ``turn``, null first,
ties by role, then text (repeated rows are repeated turns); rows without conv_id
belong to no conversation; a conversation of no turns at all is no row and so no
member, one whose rebuilt form is empty ends at the root; ``%`` keeps the sign of a
negative conv_id; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.exchange import emit, partitions, ready, stored

PRIME = (1 << 31) - 1
LANES = 3
MOST = 5  # turns of a base that are ever taken
CHUNK_IDS = 4096
KEY = ["depth", *(f"k{i}" for i in range(LANES))]


def lanes(name: str) -> list[str]:
    return [f"{name}{i}" for i in range(LANES)]


def powers(base: int, exponent: np.ndarray, prime: int) -> np.ndarray:
    """``base ** exponent mod prime``, elementwise."""
    out, square, left = np.ones(len(exponent), np.int64), base % prime, exponent.copy()
    while left.any():
        out = np.where(left & 1, out * square % prime, out)
        square, left = square * square % prime, left >> 1
    return out


def prefix_products(bases: list[int], prime: int):
    """Rows sorted by conversation to the same with their place ``k`` in the
    conversation's piece, products up to (``f``) and before (``e``) them, the weight
    ``w = B^k``, a reference and whether they are the piece's last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, at = TaskContext.get().partitionId(), 0
        conv, place, product = None, 0, [0] * LANES
        held = None
        for batch in batches:
            ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
            n = len(ids)
            if not n:
                continue
            if held:
                yield finish(held, bool(ids[0] != conv))
            new = np.ones(n, bool)
            new[1:] = ids[1:] != ids[:-1]
            new[0] = ids[0] != conv
            first = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            k = np.where(first < 0, place + 1 + np.arange(n), np.arange(n) - first + 1)
            columns = {"k": k, "ref": (np.int64(piece) << 40) + at + np.arange(n)}
            for i, base in enumerate(bases):
                w = powers(base, k, prime)
                value = batch.column(f"t{i}").to_numpy(zero_copy_only=False) * w % prime
                total = np.cumsum(value)
                before = np.where(first > 0, total[np.maximum(first, 1) - 1], 0)
                f = (total - before + np.where(first < 0, product[i], 0)) % prime
                columns |= {f"f{i}": f, f"e{i}": (f - value) % prime, f"w{i}": w}
            conv, place, product, at = ids[-1], int(k[-1]), [int(columns[f"f{i}"][-1]) for i in range(LANES)], at + n
            last = np.append(new[1:], False)
            held = (batch, columns, last, piece)
        if held:
            yield finish(held, True)

    def finish(held, last_row: bool) -> pa.RecordBatch:
        batch, columns, last, piece = held
        last[-1] = last_row
        out = {c: batch.column(c) for c in ("conv_id", "role", "text", "n_chars")} | {c: pa.array(x) for c, x in columns.items()}
        out |= {"last": pa.array(last), "piece": pa.array(np.full(len(last), piece, np.int64))}
        return pa.RecordBatch.from_arrays([out[c] for c in TURN], names=TURN)

    return run


TURN = ["conv_id", "role", "text", "n_chars", "k", "ref", "last", "piece", *lanes("f"), *lanes("e"), *lanes("w")]
TURN_SCHEMA = ", ".join(f"{c} {dict(role='string', text='string', last='boolean').get(c, 'long')}" for c in TURN)


def stored_turns(convs: DataFrame, bases: list[int], seed: int, prime: int) -> DataFrame:
    """The turns in order, with the products of their pieces, as a table."""
    spark = convs.sparkSession
    rows = convs.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.concat("role", F.lit("\0"), "text")).withColumn(
        "n_chars", F.char_length("text").cast("long")).withColumns({
            f"t{i}": F.pmod(F.xxhash64(F.lit(seed * LANES + i), "role", "text"), F.lit(prime - 1)) + 1 for i in range(LANES)})
    ranged = rows.repartitionByRange(partitions(spark), "conv_id", "turn", F.substring("tie", 1, 64)).sortWithinPartitions(
        "conv_id", "turn", "tie").drop("tie", "turn")
    return stored(ranged.mapInArrow(prefix_products(bases, prime), TURN_SCHEMA), "turns")


def cut_offsets(turns: DataFrame, prime: int) -> DataFrame:
    """For the pieces of conversations that lie in several tasks' ranges: the turns
    before the piece and their product. A range boundary cuts at most one
    conversation, so these are at most two rows a partition."""
    pieces = turns.where("last").select("conv_id", "piece", F.col("k").alias("n"), *lanes("f"), *lanes("w"))
    many = pieces.groupBy("conv_id").agg(F.count("*").alias("pieces")).where("pieces > 1").select("conv_id")

    def stitch(group: pd.DataFrame) -> pd.DataFrame:
        rows, offset, product, weight = [], 0, [0] * LANES, [1] * LANES
        for p in group.sort_values("piece").to_dict("records"):
            rows.append((p["conv_id"], p["piece"], offset, *product, *weight))
            offset += p["n"]
            product = [(product[i] + weight[i] * p[f"f{i}"]) % prime for i in range(LANES)]
            weight = [weight[i] * p[f"w{i}"] % prime for i in range(LANES)]
        return pd.DataFrame(rows, columns=["conv_id", "piece", "offset", *lanes("pf"), *lanes("pw")])

    names = ["conv_id", "piece", "offset", *lanes("pf"), *lanes("pw")]
    return stored(pieces.join(many, "conv_id").groupBy("conv_id").applyInPandas(
        stitch, ", ".join(f"{c} long" for c in names)), "offsets")


def whole_turns(turns: DataFrame, offsets: DataFrame, prime: int) -> DataFrame:
    """Turns with their place ``idx`` and products in the whole conversation."""
    own = turns.drop("role", "text", "last").join(F.broadcast(offsets), ["conv_id", "piece"], "left")

    def composed(c: str) -> Column:
        i = c[-1]
        return F.expr(f"(coalesce(pf{i}, 0L) + coalesce(pw{i}, 1L) * {c}) % {prime}L").alias(c)

    return own.select("conv_id", "piece", "ref", "n_chars", F.expr("k + coalesce(offset, 0L)").alias("idx"),
                      *(composed(c) for c in (*lanes("f"), *lanes("e"))))


def members(whole: DataFrame, base: Column, taken: Column, bases: list[int], prime: int) -> DataFrame:
    """A row per conversation and depth of its rebuilt form: the node's key, the
    parent's fingerprint, the last turn's reference, and the rebuilt length."""
    spot = F.struct("idx", "ref", "n_chars", *lanes("f"), *lanes("e"))
    wanted = whole.where("idx = 1").select(base.alias("base")).distinct()
    heads = whole.where(F.col("idx") <= MOST).withColumn("base", F.col("conv_id")).join(wanted, "base", "left_semi").groupBy(
        "base").agg(F.array_sort(F.collect_list(spot)).alias("head"))  # MOST entries at most
    convs = whole.withColumn("h", taken).groupBy("conv_id").agg(
        F.count("*").alias("n"), F.max("h").alias("h"), F.min("piece").alias("first_piece"),
        *(F.max(F.when(F.col("idx") == F.col("h"), F.col(f"f{i}"))).alias(f"at{i}") for i in range(LANES)))
    info = convs.withColumn("base", base).join(heads, "base", "left").withColumn(
        "h2", F.when(F.col("head").isNull(), 0).otherwise(F.least("h", F.size("head"))))
    info = info.withColumn("length", F.col("h2") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).withColumns({
        f"hf{i}": F.when(F.col("h2") > 0, F.expr(f"try_element_at(head, int(h2)).f{i}")).otherwise(F.lit(0).cast("long"))
        for i in range(LANES)})
    info = stored(info, "conversations")
    shape = lambda key, parent, **more: [
        "conv_id", "length", *(F.expr(x).cast("long").alias(n) for n, x in more.items()),
        *(F.expr(key.format(i=i)).alias(f"k{i}") for i in range(LANES)), *(F.expr(parent.format(i=i)).alias(f"p{i}") for i in range(LANES))]
    root = info.select(*shape("0L", "cast(null as long)", depth="0", ref="null", n_chars="0", piece="first_piece"))
    head = info.where("h2 > 0").withColumn("x", F.explode(F.expr("slice(head, 1, int(h2))"))).select(*shape(
        "x.f{i}", "x.e{i}", depth="x.idx", ref="x.ref", n_chars="x.n_chars", piece="first_piece"))
    back = {i: [pow(b, -s, prime) for s in range(MOST + 1)] for i, b in enumerate(bases)}
    own = whole.join(info.select("conv_id", "h", "h2", "length", *lanes("at"), *lanes("hf")), "conv_id").where("idx > h")
    own = own.withColumns({f"back{i}": F.element_at(F.array(*(F.lit(x).cast("long") for x in back[i])),
                                                    (F.col("h") - F.col("h2") + 1).cast("int")) for i in range(LANES)})
    moved = "(hf{{i}} + pmod({0}{{i}} - coalesce(at{{i}}, 0L), %dL) * back{{i}}) %% %dL" % (prime, prime)
    own = own.select(*shape(moved.format("f"), moved.format("e"), depth="idx - h + h2", ref="ref", n_chars="n_chars", piece="piece"))
    return stored(root.unionByName(head).unionByName(own), "members")


def unequal(rows: DataFrame, nodes: DataFrame, turns: DataFrame) -> int:
    """1 if a group's members differ in their parent, or if the stored turns that a
    group refers to are not all equal; else 0."""
    if nodes.where(" or ".join(f"p{i} <> high{i}" for i in range(LANES))).limit(1).count():
        return 1
    several = nodes.where("ref < last_ref").select(*KEY, F.col("ref").alias("first_ref"))
    pairs = rows.select(*KEY, "ref").distinct().join(several, KEY).select("first_ref", "ref").distinct()
    texts = turns.select("ref", "role", "text").join(pairs, "ref")
    spread = texts.groupBy("first_ref").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("role", "text")))
    return spread.where("min_role <> max_role or min_text <> max_text").limit(1).count()


def ends_hash(rows: DataFrame) -> DataFrame:
    """Per node with members that end there: the SHA-256 of their ids in ascending
    order. Ids are ranged over tasks, written out in chunks there, and the chunks of
    a node are hashed one after the other, never held together."""
    names = pa.schema([*((c, pa.int64()) for c in KEY), ("first", pa.int64()), ("ids", pa.string())])

    def chunks(batches):
        key, ids = None, []
        for batch in batches:
            *node, conv = (c.to_pylist() for c in batch.columns)
            for now, c in zip(zip(*node), conv):
                if ids and (now != key or len(ids) == CHUNK_IDS):
                    yield *key, ids[0], ",".join(map(str, ids))
                    ids = []
                key = now
                ids.append(c)
        if ids:
            yield *key, ids[0], ",".join(map(str, ids))

    def hashes(batches):
        key, digest = None, None
        for batch in batches:
            *node, _, text = (c.to_pylist() for c in batch.columns)
            for now, ids in zip(zip(*node), text):
                if now != key:
                    if digest:
                        yield *key, digest.hexdigest()
                    key, digest = now, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if digest:
            yield *key, digest.hexdigest()

    n = partitions(rows.sparkSession)
    order = [*KEY, "conv_id"]
    packed = rows.where("depth = length").select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        lambda b: emit(chunks(b), names, 64), ", ".join(f"{f.name} {'string' if f.name == 'ids' else 'long'}" for f in names))
    out = pa.schema([*((c, pa.int64()) for c in KEY), ("ends_sha256", pa.string())])
    return packed.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(
        lambda b: emit(hashes(b), out), ", ".join(f"{c} long" for c in KEY) + ", ends_sha256 string")


def subtree_sums(rows: DataFrame, nodes: DataFrame, offsets: DataFrame) -> DataFrame:
    """Per node: leaves and saved code points of its subtree."""
    values = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"),
                          F.col("is_leaf").cast("long").alias("leaf")).where("saved > 0 or leaf > 0")
    valued = lambda r: r.join(values, ["conv_id", "depth"], "left").fillna(0, ["saved", "leaf"])
    cut = rows.join(F.broadcast(offsets.select("conv_id").distinct()), "conv_id", "left_semi")
    after = Window.partitionBy("conv_id").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    later = valued(cut).groupBy("conv_id", "piece").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf")).select(
        "conv_id", "piece", F.sum("saved").over(after).alias("later_saved"), F.sum("leaf").over(after).alias("later_leaf"))
    down = Window.partitionBy("conv_id", "piece").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    summed = valued(rows).select(*KEY, "conv_id", "piece", F.sum("saved").over(down).alias("saved"), F.sum("leaf").over(down).alias("leaf"))
    whole = summed.join(F.broadcast(later), ["conv_id", "piece"], "left").fillna(0, ["later_saved", "later_leaf"])
    return whole.groupBy(*KEY).agg(F.sum(F.col("saved") + F.col("later_saved")).alias("saved_tokens"),
                                   F.sum(F.col("leaf") + F.col("later_leaf")).alias("n_leaves"))


def prefix_trie(convs: DataFrame, base: Column | None = None, taken: Column | None = None, prime: int = PRIME) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, n_chars`` (of the last
    text). ``base`` and ``taken``, columns over conv_id, name the conversation whose
    first turns a conversation takes and how many (``MOST`` at most); by default
    ``conv_id - conv_id % 100`` and the crc32 of the decimal conv_id modulo 6."""
    ready(convs.sparkSession)
    base = F.expr("conv_id - conv_id % 100") if base is None else base
    taken = F.expr("crc32(cast(cast(conv_id as string) as binary)) % 6") if taken is None else taken
    for seed in count():
        draw = random.Random(seed)
        bases = [draw.randrange(2, prime) for _ in range(LANES)]
        turns = stored_turns(convs, bases, seed, prime)
        offsets = cut_offsets(turns, prime)
        rows = members(whole_turns(turns, offsets, prime), base, taken, bases, prime)
        nodes = stored(rows.groupBy(*KEY).agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("ref").alias("ref"), F.max("ref").alias("last_ref"),
            F.max("n_chars").alias("n_chars"), (F.max("length") == F.col("depth")).alias("is_leaf"),
            *(F.min(f"p{i}").alias(f"p{i}") for i in range(LANES)), *(F.max(f"p{i}").alias(f"high{i}") for i in range(LANES))), "nodes")
        if not unequal(rows, nodes, turns):
            break
        prime = PRIME
    above = [(F.col("depth") - 1).alias("depth"), *(F.col(f"p{i}").alias(f"k{i}") for i in range(LANES))]
    children = nodes.where("depth > 0").select(*above).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    parents = nodes.where("depth > 0").select("conv_id", "depth", *(F.col(f"k{i}").alias(f"own{i}") for i in range(LANES)), *lanes("p")).select(
        F.col("depth").alias("own_depth"), *lanes("own"), *above).join(
            nodes.select(*KEY, F.col("conv_id").alias("parent_conv_id")), KEY).select(
                F.col("own_depth").alias("depth"), *(F.col(f"own{i}").alias(f"k{i}") for i in range(LANES)), "parent_conv_id")
    out = nodes.join(subtree_sums(rows, nodes, offsets), KEY, "left").join(children, KEY, "left").join(
        parents, KEY, "left").join(ends_hash(rows), KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"), "n_chars")
