"""Ad log parsing, batch ad statistics, write rules and the ad stream."""

import os
import time

import pytest
from pyspark.sql import functions as F

from clicklens.operators import ads, upserts
from clicklens.sinks.snapshots import Manifest
from clicklens.streaming import ad_stream

T0 = 1704067200000  # 2024-01-01 00:00:00 UTC in ms


def _lines(spark, items):
    return spark.createDataFrame([(x,) for x in items], "value string")


def line(ms, prov, city, user, ad):
    return f"{T0 + ms} {prov} {city} {user} {ad}"


def test_parse_drops_malformed_lines(spark):
    df = _lines(spark, [line(0, "P", "C", 1, 2), "", "   ", "1 2 3", "x P C 1 2", line(5, "P", "C", "u", 2),
                        line(61000, "P", "C", 3, 4) + " extra", None])
    got = ads.parse_ad_log(df).collect()
    assert [(r.province, r.city, r.user_id, r.ad_id) for r in got] == [("P", "C", 1, 2)]
    assert got[0].ts is not None


def test_counts_blacklist_stat_trend(spark):
    df = ads.parse_ad_log(_lines(spark, [
        line(0, "P", "C", 1, 7), line(1000, "P", "C", 1, 7),  # same key twice in one batch
        line(2000, "P", "D", 2, 7), line(61000, "Q", "E", 3, 8),
    ]))
    counts = {(r.user_id, r.ad_id): r.click_count for r in ads.ad_user_click_count(df).collect()}
    assert counts == {(1, 7): 2, (2, 7): 1, (3, 8): 1}
    bl = [r.user_id for r in ads.ad_blacklist(ads.ad_user_click_count(df), 2).collect()]
    assert bl == [1]
    allowed = ads.drop_blacklisted(df, spark.createDataFrame([(1,)], "user_id long"))
    stat = sorted(tuple(r) for r in ads.ad_stat(allowed).collect())
    assert stat == [("2024-01-01", "P", "D", 7, 1), ("2024-01-01", "Q", "E", 8, 1)]
    trend = sorted(tuple(r) for r in ads.ad_click_trend(df).collect())
    assert trend == [("2024-01-01", "00", "00", 7, 3), ("2024-01-01", "00", "01", 8, 1)]


def test_province_top3_ties_by_ad(spark):
    stat = spark.createDataFrame(
        [("d", "P", "C1", a, c) for a, c in [(1, 5), (2, 5), (3, 5), (4, 5), (5, 9)]] + [("d", "P", "C2", 4, 1)],
        "date string, province string, city string, ad_id long, click_count long",
    )
    got = [(r.ad_id, r.click_count) for r in ads.ad_province_top3(stat).orderBy(F.desc("click_count"), "ad_id").collect()]
    assert got == [(5, 9), (4, 6), (1, 5)]


def test_write_rules(spark):
    old = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v long")
    new = spark.createDataFrame([("k2", 10), ("k3", 3)], "k string, v long")
    assert sorted(tuple(r) for r in upserts.upsert_add(old, new, ["k"], "v").collect()) == [("k1", 1), ("k2", 12), ("k3", 3)]
    assert sorted(tuple(r) for r in upserts.upsert_replace(old, new, ["k"]).collect()) == [("k1", 1), ("k2", 10), ("k3", 3)]
    g_old = spark.createDataFrame([("d", "P", 1), ("d", "P", 2), ("d", "Q", 3)], "date string, province string, ad long")
    g_new = spark.createDataFrame([("d", "P", 9)], "date string, province string, ad long")
    got = sorted(tuple(r) for r in upserts.replace_groups(g_old, g_new, ["date", "province"]).collect())
    assert got == [("d", "P", 9), ("d", "Q", 3)]
    b_old = spark.createDataFrame([(1,), (2,)], "user_id long")
    b_new = spark.createDataFrame([(2,), (3,), (3,)], "user_id long")
    assert sorted(r.user_id for r in upserts.append_new(b_old, b_new, ["user_id"]).collect()) == [1, 2, 3]


def _batch_twin(spark, batches, threshold):
    """Apply the per-batch rule with plain batch operators in a loop."""
    counts = blacklist = stat = trend = None
    for lines in batches:
        clicks = ads.parse_ad_log(_lines(spark, lines))
        bl = blacklist if blacklist is not None else spark.createDataFrame([], "user_id long")
        allowed = ads.drop_blacklisted(clicks, bl)
        delta = ads.ad_user_click_count(allowed)
        counts = delta if counts is None else upserts.upsert_add(counts, delta, ad_stream.COUNT_KEYS, "click_count")
        blacklist = upserts.append_new(bl, ads.ad_blacklist(counts, threshold), ["user_id"])
        s = ads.ad_stat(allowed)
        stat = s if stat is None else upserts.upsert_add(stat, s, ad_stream.STAT_KEYS, "click_count")
        tr = ads.ad_click_trend(allowed)
        trend = tr if trend is None else upserts.upsert_add(trend, tr, ad_stream.TREND_KEYS, "click_count")
        counts, blacklist, stat, trend = [spark.createDataFrame(x.collect(), x.schema)
                                         for x in (counts, blacklist, stat, trend)]
    return counts, blacklist, stat, trend


BATCHES = [
    [line(0, "P", "C", 1, 7), line(1000, "P", "C", 1, 7), line(2000, "P", "D", 2, 7), "bad line"],
    [line(60000, "P", "C", 1, 7), line(61000, "P", "D", 2, 7), line(62000, "Q", "E", 3, 8)],
    [line(120000, "P", "D", 2, 7), line(121000, "Q", "E", 3, 8), line(122000, "Q", "E", 3, 8)],
]


def _same(a, b):
    cols = sorted(a.columns)
    return sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))


def _stage(folder, lines, name, at):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(os.path.join(folder, name), (at, at))


def test_process_batch_matches_batch_twin_and_replays(spark, scratch):
    root = os.path.join(scratch, "out")
    tables = ad_stream.AdTables.at(spark, root)
    for bid, lines in enumerate(BATCHES):
        ad_stream.process_batch(_lines(spark, lines), bid, tables, threshold=2)
    # a replayed batch changes nothing
    ad_stream.process_batch(_lines(spark, BATCHES[1]), 1, tables, threshold=2)
    counts, blacklist, _, _ = _batch_twin(spark, BATCHES, 2)
    assert _same(tables.counts.read(), counts)
    assert _same(tables.blacklist.read(), blacklist)
    # user 1 reaches the threshold inside batch 0 (both clicks counted there,
    # later clicks blocked); user 2 reaches it in batch 1, user 3 in batch 2
    assert sorted(r.user_id for r in tables.blacklist.read().collect()) == [1, 2, 3]
    c = {(r.user_id, r.ad_id): r.click_count for r in tables.counts.read().collect()}
    assert c[(1, 7)] == 2 and c[(2, 7)] == 2 and c[(3, 8)] == 3
    # line counts per batch are kept, and the bad lines themselves
    assert sorted(map(tuple, tables.batches.read().collect())) == [(0, 4, 3, 0, 1), (1, 3, 2, 1, 0), (2, 3, 2, 1, 0)]
    assert [tuple(r) for r in tables.log.bad_lines().collect()] == [(0, "bad line")]


@pytest.mark.parametrize("stop_after", range(4))
def test_a_batch_stopped_at_any_step_is_finished_by_its_replay(spark, scratch, monkeypatch, stop_after):
    """Stops after the log, the counts or the blacklist, or before the last commit."""
    tables = ad_stream.AdTables.at(spark, os.path.join(scratch, f"out{stop_after}"))
    ad_stream.process_batch(_lines(spark, BATCHES[0]), 0, tables, threshold=2)
    left, publish = [stop_after], Manifest.publish

    def stopping(self, number, content):
        if not left[0]:
            raise RuntimeError("stopped")
        left[0] -= 1
        publish(self, number, content)

    with monkeypatch.context() as m:
        m.setattr(Manifest, "publish", stopping)
        try:
            ad_stream.process_batch(_lines(spark, BATCHES[1]), 1, tables, threshold=2)
        except RuntimeError:
            pass
    for bid in (1, 2):
        ad_stream.process_batch(_lines(spark, BATCHES[bid]), bid, tables, threshold=2)
    counts, blacklist, _, _ = _batch_twin(spark, BATCHES, 2)
    assert _same(tables.counts.read(), counts) and _same(tables.blacklist.read(), blacklist)
    assert tables.log.lines().count() == sum(map(len, BATCHES))


def test_only_changed_keys_are_totalled(spark, scratch):
    """The crossing check merges the rows of the batch's own keys."""
    tables = ad_stream.AdTables.at(spark, os.path.join(scratch, "out"))
    ad_stream.process_batch(_lines(spark, [line(i, "P", "C", u, 7) for i in range(2) for u in range(50)]), 0, tables, threshold=3)
    delta = ads.ad_user_click_count(ads.parse_ad_log(_lines(spark, [line(9, "P", "C", 4, 7)])))
    tables.counts.commit(delta, 1)
    assert tables.counts.read(parts=["2024-01-01"], keys=delta).count() == 1
    assert [r.user_id for r in ad_stream.crossed(delta, tables.counts, 3).collect()] == [4]


def test_stream_end_to_end_with_restarts(spark, scratch):
    """Two deliveries; intake and rollups resume from their checkpoints, with the
    running totals in their state."""
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    now = time.time() - 100
    for i in range(2):
        _stage(src, BATCHES[i], f"part-{i}.txt", now + i)
    source = lambda: ad_stream.read_ad_log(spark, src, max_files_per_trigger=1)
    tables = ad_stream.run_available(spark, source(), out, 2)
    assert tables.batches.last_batch() == 1 and tables.stat.last_batch() == 0
    ad_stream.run_available(spark, source(), out, 2)  # nothing new
    assert tables.stat.last_batch() == 0
    _stage(src, BATCHES[2], "part-2.txt", now + 2)
    ad_stream.run_available(spark, source(), out, 2)
    counts, blacklist, stat, trend = _batch_twin(spark, BATCHES, 2)
    assert _same(tables.counts.read(), counts) and _same(tables.blacklist.read(), blacklist)
    assert _same(tables.stat.read(), stat) and _same(tables.trend.read(), trend)
    assert _same(tables.top3.read(), ads.ad_province_top3(stat))
    # the rollups' second batch held changed keys only
    assert tables.stat.last_batch() == 1
    newest = tables.stat._rows(tables.stat.segments()).where("seq = 1")
    assert sorted(tuple(r) for r in newest.select("city", "ad_id", "click_count").collect()) == [("E", 8, 3)]


def test_top3_is_kept_from_changed_totals(spark, scratch):
    """Random running totals: old tops and changed ads are enough, ties included."""
    import random

    rng, table = random.Random(3), ad_stream.AdTables.at(spark, os.path.join(scratch, "top")).top3
    totals = {}
    schema = "date string, province string, ad_id long, click_count long"
    for batch in range(8):
        changed = {}
        for _ in range(12):
            key = (f"d{rng.randint(1, 2)}", rng.choice("PQ"), rng.randint(1, 6))
            totals[key] = changed[key] = totals.get(key, 0) + rng.randint(1, 3)
        df = spark.createDataFrame([(*k, v) for k, v in changed.items()], schema)
        ad_stream.update_top(df, batch, table)
        ad_stream.update_top(df, batch, table)  # replay
        want = ads.top_per_province(spark.createDataFrame([(*k, v) for k, v in totals.items()], schema))
        assert _same(table.read(), want)
    touched = spark.createDataFrame([("d1", "P", 1, 10**6)], schema)
    ad_stream.update_top(touched, 8, table)
    newest = {(r.date, r.province) for r in table._rows(table.segments()).where("seq = 8").collect()}
    assert newest == {("d1", "P")}  # no other group is written


def test_late_clicks_are_left_out_and_state_is_dropped(spark, scratch):
    src, out, now = os.path.join(scratch, "in"), os.path.join(scratch, "out"), time.time() - 100
    hour = 3_600_000
    for i, batch in enumerate([[line(0, "P", "C", 1, 7)], [line(3 * hour, "P", "C", 1, 7)], [line(3 * hour + 1, "P", "C", 1, 8)],
                               [line(1, "P", "C", 2, 7), line(3 * hour + 2, "P", "C", 2, 7)]]):
        _stage(src, batch, f"{i}.txt", now + i)
    clicks = ads.parse_ad_log(ad_stream.read_ad_log(spark, src, max_files_per_trigger=1))
    q = ad_stream.start_trend_stream(spark, clicks, out, "1 hour")
    q.awaitTermination()
    got = sorted(tuple(r) for r in ad_stream.AdTables.at(spark, out).trend.read().collect())
    assert got == [("2024-01-01", "00", "00", 7, 1), ("2024-01-01", "03", "00", 7, 2), ("2024-01-01", "03", "00", 8, 1)]
    state = [p["stateOperators"][0] for p in map(lambda p: p if isinstance(p, dict) else __import__("json").loads(p.json), q.recentProgress)
             if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 1 and sum(s["numRowsRemoved"] for s in state) >= 1
    assert state[-1]["numRowsTotal"] == 2


def test_sliding_window_trend_stream(spark, scratch):
    src = os.path.join(scratch, "win")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join([line(0, "P", "C", 1, 7), line(30000, "P", "C", 2, 7), line(90000, "P", "C", 3, 8)]) + "\n")
    stream = ad_stream.click_trend_stream(ad_stream.read_ad_log(spark, src), "2 minutes", "1 minute", "1 minute")
    q = stream.writeStream.outputMode("update").format("memory").queryName("trend_t").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.sql("SELECT ad_id, sum(click_count) n FROM trend_t GROUP BY ad_id ORDER BY ad_id").collect()
    # every click falls in two sliding windows
    assert [(r.ad_id, r.n) for r in got] == [(7, 4), (8, 2)]


def test_restart_with_default_checkpoint_resumes(spark, scratch):
    src = os.path.join(scratch, "in2")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(BATCHES[0]) + "\n")
    out = os.path.join(scratch, "out2")
    for _ in range(2):
        q = ad_stream.start_ad_stream(spark, ad_stream.read_ad_log(spark, src), out, 2)
        q.awaitTermination(120)
    tables = ad_stream.AdTables.at(spark, out)
    assert tables.counts.last_batch() == 0
    got = {(r.user_id, r.ad_id): r.click_count for r in tables.counts.read().collect()}
    assert got == {(1, 7): 2, (2, 7): 1}


def test_sliding_window_batch_equals_spark_window(spark):
    lines = [line(i * 7919 % 7200000, "P", "C", i % 5, i % 3) for i in range(400)]
    clicks = ads.parse_ad_log(_lines(spark, lines))
    for length, slide in (("1 hour", "1 minute"), ("10 minutes", "5 minutes"), ("7 minutes", "3 minutes")):
        mine = ads.ad_click_trend_window(clicks, length, slide)
        w = F.window("ts", length, slide)
        ref = clicks.groupBy(w.alias("w"), "ad_id").agg(F.count(F.lit(1)).alias("click_count")).select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "ad_id", "click_count")
        assert mine.exceptAll(ref).count() == 0 and ref.exceptAll(mine).count() == 0, (length, slide)


def test_batch_of_only_bad_lines_changes_nothing(spark, scratch):
    tables = ad_stream.AdTables.at(spark, os.path.join(scratch, "out3"))
    ad_stream.process_batch(_lines(spark, BATCHES[0]), 0, tables, threshold=2)
    before = [sorted(tuple(r) for r in t.read().collect()) for t in (tables.counts, tables.blacklist)]
    ad_stream.process_batch(_lines(spark, ["", "x y", "1 2 3 4 five"]), 1, tables, threshold=2)
    ad_stream.process_batch(_lines(spark, []), 2, tables, threshold=2)
    assert before == [sorted(tuple(r) for r in t.read().collect()) for t in (tables.counts, tables.blacklist)]
    assert sorted(map(tuple, tables.batches.read().collect()))[1:] == [(1, 3, 0, 0, 3), (2, 0, 0, 0, 0)]


def test_trend_windows_of_other_units(spark):
    clicks = ads.parse_ad_log(_lines(spark, [line(0, "P", "C", 1, 7)]))
    assert ads.ad_click_trend_window(clicks, "1500 milliseconds").count() == 1
    assert ads.ad_click_trend_window(clicks, "1 hour 30 minutes", "30 minutes").count() == 3


def test_overlong_epoch_is_a_counted_bad_line(spark):
    from clicklens.operators import ads

    lines = spark.createDataFrame(
        [("1704067200000 P C 1 2",), ("9999999999999999999 P C 1 2",), ("9223372036854775807 P C 1 2",), ("x",), (None,)],
        "value string")
    assert ads.parse_ad_log(lines).count() == 1
    assert tuple(ads.ad_line_counts(lines).first()) == (5, 1, 4)


def test_fresh_checkpoint_on_old_tables_raises(spark, scratch):
    from clicklens.streaming import ad_stream

    spark.createDataFrame([("1704067200000 P C 1 2",)], "value string").coalesce(1).write.text(f"{scratch}/in/a")
    source = ad_stream.read_ad_log(spark, f"{scratch}/in/*")
    ad_stream.start_ad_stream(spark, source, f"{scratch}/out", 100).awaitTermination()
    with pytest.raises(RuntimeError, match="not the checkpoint"):
        ad_stream.start_ad_stream(spark, source, f"{scratch}/out", 100, f"{scratch}/other")
    spark.createDataFrame([("1704067200001 P C 1 2",)] * 3, "value string").coalesce(1).write.text(f"{scratch}/in/b")
    ad_stream.start_ad_stream(spark, source, f"{scratch}/out", 100).awaitTermination()
    assert ad_stream.AdTables.at(spark, f"{scratch}/out").counts.read().first()["click_count"] == 4


def test_stream_joins_broadcast_nothing_that_grows(spark, tmp_path):
    """Events, blacklist, keys and changed totals never pass the driver, however small
    their files look; only the cities that a remainder by 25 can name do."""
    import datetime

    from clicklens.sinks.snapshots import ADD, GROUPS, MergeTable
    from clicklens.sources import fixtures
    from clicklens.streaming import ad_stream

    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at, i % 60, "click", 1.0, f"k{i}") for i in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    nations = [(i, f"N {i}", i % 5) for i in range(30)]
    spark.createDataFrame(nations, "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(i, f"R {i}") for i in range(5)], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    clicks = fixtures.ad_clicks(spark, str(tmp_path))
    join = clicks._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]
    assert "rightHint=(strategy=broadcast)" in join
    assert sorted((r.user_id, r.city) for r in clicks.collect()) == sorted((i % 60, f"N_{i % 60 % 25}") for i in range(200))

    lines = spark.createDataFrame([("1704067200000 p c 1 2",), ("1704067200000 p c 2 2",), ("bad",)], "value string")
    listed = spark.createDataFrame([(1,)], "user_id long")
    marked = ad_stream.marked_lines(lines, listed)
    assert "BroadcastHashJoin" not in marked._jdf.queryExecution().sparkPlan().toString()
    assert sorted(r.kind for r in marked.collect()) == ["bad", "blocked", "click"]
    for rule, keys, more in ((ADD, ["date", "user_id", "ad_id"], {"measure": "click_count"}), (GROUPS, ["date"], {})):
        table = MergeTable(spark, f"{tmp_path}/{rule}", ad_stream.SCHEMAS["ad_user_click_count"], rule, keys, part_col="date", **more)
        batch = spark.createDataFrame([("2024-01-01", 1, 2, 3)], ad_stream.SCHEMAS["ad_user_click_count"])
        table.commit(batch, 0)
        read = table.read(keys=batch)
        assert "BroadcastHashJoin" not in read._jdf.queryExecution().sparkPlan().toString()
        assert [tuple(r) for r in read.collect()] == [("2024-01-01", 1, 2, 3)]
