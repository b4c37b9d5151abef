"""Tables published by manifests: switches in one step, stops between the steps,
merge rules, bytes written per batch."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.operators import cache
from clicklens.sinks.snapshots import ADD, GROUPS, INSERT, SET, Manifest, MergeTable, ResultStore

ROW = T.StructType([T.StructField("date", T.StringType()), T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def store_with(spark, root):
    store = ResultStore(spark, root)
    store.publish("job", 1, {"a": spark.range(3), "b": spark.range(2)})
    store.publish("job", 2, {"a": spark.range(5), "b": spark.range(1)})
    return store


def test_a_rerun_replaces_its_task_only(spark, scratch):
    store = store_with(spark, f"{scratch}/results")
    store.publish("job", 1, {"a": spark.range(0), "b": spark.range(7)})
    assert store.read("job", "a", 1).count() == 0 and store.read("job", "a").count() == 5 and store.read("job", "b").count() == 8
    assert store.tasks("job") == [1, 2]
    store.truncate("job")
    with pytest.raises(KeyError):
        store.read("job", "a")
    store.publish("job", 1, {"a": spark.range(4)})
    assert store.read("job", "a").count() == 4


def test_a_stop_between_data_and_manifest_leaves_the_old_results(spark, scratch, monkeypatch):
    store = store_with(spark, f"{scratch}/results")
    slow_reader = store.read("job", "a", 1)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(Manifest, "publish", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            store.publish("job", 1, {"a": spark.range(100), "b": spark.range(100)})
    assert (store.read("job", "a", 1).count(), store.read("job", "b", 1).count()) == (3, 2)
    with pytest.raises(Exception):  # a plan that fails after the first result was written
        store.publish("job", 1, {"a": spark.range(9), "b": spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))})
    assert (store.read("job", "a", 1).count(), store.read("job", "b", 1).count()) == (3, 2)
    # the left-overs go by vacuum, what is named stays
    assert store.vacuum(3600) == 0
    assert store.vacuum(0) == 4 and store.read("job", "a").count() == 8 and slow_reader.count() == 3


def test_two_writers_cannot_have_the_same_state(spark, scratch):
    manifest = Manifest(spark, f"{scratch}/m")
    manifest.publish(0, {"x": 1})
    with pytest.raises(RuntimeError, match="another writer"):
        manifest.publish(0, {"x": 2})
    assert manifest.latest() == (0, {"x": 1})
    assert not [n for n in os.listdir(f"{scratch}/m") if n.startswith("_draft")]


def merged(rule, batches):
    """The rules in plain Python."""
    out = {}
    for batch in batches:
        if rule == GROUPS:
            groups = {r[0] for r in batch}
            out = {key: v for key, v in out.items() if key[0] not in groups}
        for date, k, v in batch:
            if rule == ADD:
                out[date, k] = out.get((date, k), 0) + v
            elif rule == INSERT:
                out.setdefault((date, k), None)
            else:
                out[date, k] = v
    return sorted((d, k) if rule == INSERT else (d, k, v) for (d, k), v in out.items())


@pytest.mark.parametrize("rule", [ADD, SET, GROUPS, INSERT])
def test_merge_rules_over_many_batches(spark, scratch, rule, monkeypatch):
    monkeypatch.setattr(MergeTable, "FAN", 3)
    rng = random.Random(1)
    keys = ["date"] if rule == GROUPS else ["date", "k"]
    schema = T.StructType(ROW.fields[:2]) if rule == INSERT else ROW
    table = MergeTable(spark, f"{scratch}/t", schema, rule, keys, measure="v", part_col="date")
    assert rows_of(table.read()) == [] and table.last_batch() == -1
    batches = []
    for b in range(11):
        batch = {(f"2024-01-0{rng.randint(1, 4)}", rng.randint(0, 5)): rng.randint(1, 9) for _ in range(rng.choice([0, 1, 4]))}
        batches.append([(d, k, v) for (d, k), v in batch.items()])
        df = spark.createDataFrame(batches[-1], ROW)
        assert table.commit(df.select(*schema.names), b) and not table.commit(df.select(*schema.names), b)
        assert rows_of(table.read(before_batch=b)) == merged(rule, batches[:-1])
    assert rows_of(table.read()) == merged(rule, batches)
    assert len(table.segments()) <= 6 and max(s["level"] for s in table.segments()) >= 2
    day = [r for r in merged(rule, batches) if r[0] == "2024-01-02"]
    assert rows_of(table.read(parts=["2024-01-02"])) == day
    some = spark.createDataFrame([r[:2] for r in day[:1]], "date string, k long")
    assert rows_of(table.read(keys=some)) == [r for r in day if rule == GROUPS or r[:2] == day[0][:2]]
    before = rows_of(table.read())
    assert table.vacuum(0) > 0 and rows_of(table.read()) == before


def test_a_stopped_commit_is_repeated_whole(spark, scratch, monkeypatch):
    table = MergeTable(spark, f"{scratch}/t", ROW, ADD, ["date", "k"], measure="v", part_col="date")
    df = spark.createDataFrame([("d", 1, 5)], ROW)
    table.commit(df, 0)
    with monkeypatch.context() as m:
        m.setattr(Manifest, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.commit(df, 1)
    assert rows_of(table.read()) == [("d", 1, 5)] and table.last_batch() == 0
    assert table.commit(df, 1) and rows_of(table.read()) == [("d", 1, 10)]
    with pytest.raises(ValueError):
        table.read(before_batch=0)


def test_what_a_batch_writes_does_not_grow_within_a_day(spark, scratch):
    """Equal batches of new keys of one day: the folder a batch appends stays as small
    as the first one's, and all that was ever written is a few times the data."""
    table = MergeTable(spark, f"{scratch}/t", ROW, ADD, ["date", "k"], measure="v", part_col="date")
    size, total, known = [], 0, set()

    def bytes_of(folder):
        return sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet"))

    for b in range(20):
        table.commit(spark.range(b * 500, b * 500 + 500, 1, 1).select(F.lit("2024-01-01").alias("date"), F.col("id").alias("k"), F.lit(1).cast("long").alias("v")), b)
        for name in set(os.listdir(f"{scratch}/t/segments")) - known:
            known.add(name)
            total += bytes_of(f"{scratch}/t/segments/{name}")
            if name.startswith("segment=b"):
                size.append(bytes_of(f"{scratch}/t/segments/{name}"))
    assert len(size) == 20 and max(size) < 1.2 * size[0]
    assert total < 2.5 * sum(size) and table.read().count() == 10_000


def test_shared_tables_go_with_their_scope(spark):
    root = cache.folder(spark)
    with pytest.raises(RuntimeError):
        with cache.scope(spark):
            inside = cache.share(spark.range(3))
            name = inside.inputFiles()[0].split("/shared/")[1].split("/")[1]
            assert os.path.isdir(f"{root.removeprefix('file:')}/{name}")
            raise RuntimeError
    assert not os.path.isdir(f"{root.removeprefix('file:')}/{name}")
    kept = cache.share(spark.range(3))
    assert kept.count() == 3
