"""The prefix trie against tries of rebuilt turns, and the edge cases."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from clicklens.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k0 string"


def remainder(c, n):
    return c % n if c >= 0 else -(-c % n)


def brute(rows, base=lambda c: c - remainder(c, 100), taken=lambda c: zlib.crc32(str(c).encode()) % 6):
    own = {}
    for conv, turn, role, text in sorted((c, t if t is not None else -(10**9), r or "", x or "") for c, t, r, x in rows if c is not None):
        own.setdefault(conv, []).append((role, text))
    member, ends = {}, {}
    for c, turns in own.items():
        h = taken(c)
        built = tuple(own.get(base(c), [])[:h] + turns[h:])
        for d in range(len(built) + 1):
            member.setdefault(built[:d], set()).add(c)
        ends.setdefault(built, set()).add(c)
    leaves, saved, kids = dict.fromkeys(member, 0), dict.fromkeys(member, 0), dict.fromkeys(member, 0)
    for node in member:
        if node:
            kids[node[:-1]] += 1
    for node, convs in member.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    return sorted((min(convs), len(node), min(member[node[:-1]]) if node else None, len(convs), kids[node], leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(node, ())))).encode()).hexdigest()) for node, convs in member.items())


def built(spark, rows, parts=3, **more):
    df = spark.createDataFrame([(*r, 7, "clash") for r in rows], SCHEMA).repartition(parts)
    out = trie.prefix_trie(df, **more)
    assert len(out.collect()) == out.select(*out.columns).count()
    return sorted(map(tuple, out.drop("n_chars").collect()), key=lambda r: (r[0], r[1]))


def random_rows(n, seed):
    rng, rows = random.Random(seed), []
    for c in [*range(n), *range(1000, 1000 + n, 7), *range(-n, 0, 3)]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 8])):
            rows.append((c, rng.choice([t, t, t, None, 2]), rng.choice(["user", "assistant", None, ""]), rng.choice(["hi", "é\U0001F600", "", None, "hi", "long " * 9])))
    return rows


@pytest.mark.parametrize("prime", [trie.PRIME, 13])
def test_random_conversations(spark, prime):
    """Also with hashes that collide at once: the check draws others."""
    rows = random_rows(150, 4) + [(None, 1, "user", "lost"), (100, 0, "user", "hi"), (100, 0, "user", "hi")]
    assert built(spark, rows, prime=prime) == brute(rows)


def test_one_conversation_cut_over_all_tasks(spark):
    """A third of all rows in one conversation, an equal copy, and its rebuilt kin."""
    rows = [(c, t, "user", f"turn {t % 50}") for c in (200, 201, 777) for t in range(900)] + [(c, t, "a", "x") for c in range(202, 260) for t in range(7)]
    turns = trie.stored_turns(spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA), [3, 5, 7], 0, trie.PRIME)
    offsets = trie.cut_offsets(turns, trie.PRIME)
    assert offsets.where("conv_id = 201").count() > 1 and offsets.count() <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert built(spark, rows) == brute(rows)


def test_ends_of_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 16)
    rows = [(c * 100, 0, "user", "same") for c in range(500)]
    assert built(spark, rows) == brute(rows)


def test_other_heads_and_empty(spark):
    rows = random_rows(60, 9)
    got = built(spark, rows, base=F.expr("conv_id - 1"), taken=F.lit(2))
    assert got == brute(rows, lambda c: c - 1, lambda c: 2)
    assert built(spark, []) == [] and built(spark, [(None, 0, "user", "x")]) == []
    assert built(spark, [(5, None, None, None)]) == brute([(5, None, None, None)])


def test_collisions_are_found(spark):
    """Equal fingerprints of unequal turns do not pass the reference check."""
    df = spark.createDataFrame([(c * 100 + 7, t, "user", f"{c} {t}", 0, "") for c in range(40) for t in range(8)], SCHEMA)
    turns = trie.stored_turns(df, [3, 3, 3], 0, 5)
    rows = trie.members(trie.whole_turns(turns, trie.cut_offsets(turns, 5), 5), F.lit(-1), F.lit(0), [3, 3, 3], 5)
    nodes = rows.groupBy(*trie.KEY).agg(F.min("ref").alias("ref"), F.max("ref").alias("last_ref"),
                                        *(F.min(f"p{i}").alias(f"p{i}") for i in range(3)), *(F.max(f"p{i}").alias(f"high{i}") for i in range(3)))
    assert trie.unequal(rows, nodes, turns) == 1
    assert trie.unequal(rows, nodes.withColumns({f"high{i}": F.col(f"p{i}") for i in range(3)}), turns) == 1
