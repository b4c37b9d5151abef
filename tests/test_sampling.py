"""Time-proportional sampling: quotas and properties."""

import math

from pyspark.sql import functions as F

from clicklens.operators import sampling


def _sessions(spark, n_days=3, per_hour=lambda d, h: (d * 7 + h * 3) % 11):
    rows = []
    for d in range(n_days):
        for h in range(24):
            for i in range(per_hour(d, h)):
                rows.append((f"d{d}h{h}s{i}", f"2024-01-{d + 1:02d} {h:02d}:{i % 60:02d}:00"))
    df = spark.createDataFrame(rows, "session_id string, start string")
    return df.select("session_id", F.to_timestamp("start").alias("start_ts"), F.lit("").alias("start_time"),
                     F.lit("").alias("search_keywords"), F.lit("").alias("click_category_ids"))


def _python_quota(spark, s, n):
    hours = {}
    for r in sampling.with_date_hour(s).collect():
        hours[(r.date, r.hour)] = hours.get((r.date, r.hour), 0) + 1
    days = {}
    for (d, _), c in hours.items():
        days[d] = days.get(d, 0) + c
    per_day = n // len(days)
    return {k: min(c, math.floor(c / days[k[0]] * per_day)) for k, c in hours.items()}


def test_quota_matches_reference_rule(spark):
    s = _sessions(spark)
    want = _python_quota(spark, s, 100)
    got = {(r.date, r.hour): r.quota for r in sampling.sample_quota(s, 100).collect()}
    assert got == want


def test_sample_takes_exactly_quota_per_hour_under_any_partitioning(spark):
    s = _sessions(spark)
    want = _python_quota(spark, s, 200)
    picks = []
    for parts in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = sampling.sample_sessions(s.repartition(parts), 200, "seed")
        rows = got.collect()
        per = {}
        for r in rows:
            per[(r.date, r.hour)] = per.get((r.date, r.hour), 0) + 1
        assert {k: v for k, v in want.items() if v} == per
        picks.append(sorted(r.session_id for r in rows))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert picks[0] == picks[1] == picks[2]


def test_more_days_than_sample_size_gives_nothing(spark):
    s = _sessions(spark, n_days=5)
    assert sampling.sample_sessions(s, 4).count() == 0


def test_no_sessions_gives_empty_sample(spark):
    s = _sessions(spark, n_days=0)
    assert sampling.sample_sessions(s, 100).count() == 0
    assert sampling.sample_quota(s, 100).count() == 0


def test_seed_changes_pick(spark):
    s = _sessions(spark)
    a = {r.session_id for r in sampling.sample_sessions(s, 300, "a").collect()}
    b = {r.session_id for r in sampling.sample_sessions(s, 300, "b").collect()}
    assert len(a) == len(b) and a != b


def test_sessions_without_a_time_are_counted_and_never_drawn(spark):
    s = _sessions(spark)
    lost = spark.createDataFrame([("lost", None)], "session_id string, start_ts timestamp").selectExpr(
        "session_id", "start_ts", "'' start_time", "'' search_keywords", "'' click_category_ids")
    both = s.unionByName(lost)
    assert [r.hour_count for r in sampling.sessions_per_hour(both).where("date is null").collect()] == [1]
    assert sampling.sample_sessions(both, 10_000).where("session_id = 'lost'").count() == 0


def test_a_sample_beyond_the_limit_of_partial_ranks_is_refused(spark):
    import pytest

    with pytest.raises(ValueError, match="windowGroupLimitThreshold"):
        sampling.sample_sessions(_sessions(spark), 200_000)
