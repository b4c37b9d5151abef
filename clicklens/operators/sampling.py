"""Time-proportional session sampling.

A target of ``n`` sessions is split evenly over the days that have sessions
(``n div days``); each hour of a day gets ``min(count, floor(count /
day_total * per_day))`` of them. Within an hour the sessions with the
smallest ``md5(seed || session_id)`` are taken: random-looking, repeatable
and the same on any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.operators.joins import broadcast_bounded

DEFAULT_SAMPLE_SIZE = 100
DEFAULT_SEED = "clicklens"
SALTS = 64  # parts that an hour's sessions are ranked in first


def with_date_hour(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("date", F.date_format("start_ts", "yyyy-MM-dd")).withColumn(
        "hour", F.date_format("start_ts", "HH")
    )


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour) of their start time."""
    return with_date_hour(sessions).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("hour_count"))


def sessions_per_day(per_hour: DataFrame) -> DataFrame:
    """Per date: the sum of its hours, and the number of dates.

    ``per_hour`` has at most 24 rows per day, so the unpartitioned window
    that counts dates runs over a small, bounded table.
    """
    days = per_hour.groupBy("date").agg(F.sum("hour_count").cast("bigint").alias("day_total"))
    return days.withColumn("num_days", F.count(F.lit(1)).over(Window.partitionBy()))


def sample_quota(sessions: DataFrame, n: int = DEFAULT_SAMPLE_SIZE) -> DataFrame:
    """(date, hour, hour_count, day_total, quota) for a target of ``n``."""
    per_hour = sessions_per_hour(sessions).where("date is not null")
    per_day = sessions_per_day(per_hour)
    q = per_hour.join(per_day, "date")
    per_day_target = F.floor(F.lit(n) / F.col("num_days")).cast("bigint")
    share = F.floor(F.col("hour_count").cast("double") / F.col("day_total").cast("double") * per_day_target.cast("double"))
    return q.select(
        "date",
        "hour",
        "hour_count",
        "day_total",
        F.least(F.col("hour_count"), share.cast("bigint")).alias("quota"),
    )


def sample_sessions(sessions: DataFrame, n: int = DEFAULT_SAMPLE_SIZE, seed: str = DEFAULT_SEED) -> DataFrame:
    """The sampled sessions (all session columns kept).

    An hour's quota never exceeds ``n``, so the first ``n`` sessions of every hour are
    ranked before any quota is known: within a salted part of the hour, then among
    the parts' firsts. The literal bound becomes a WindowGroupLimit before each
    shuffle, and only these at most ``n`` sessions an hour meet the quotas. Sessions
    without a time belong to no hour (``sessions_per_hour`` counts them under a null
    one) and are never drawn. A sample beyond Spark's bound for such limits is refused:
    without them a hot hour would meet in one task.
    """
    limit = int(sessions.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > limit:
        raise ValueError(f"for a sample of {n}, set spark.sql.optimizer.windowGroupLimitThreshold (now {limit}) to as much")
    order = (F.md5(F.concat(F.lit(seed), F.col("session_id"))), F.col("session_id"))
    s = with_date_hour(sessions).where("date is not null").withColumn("salt", F.pmod(F.xxhash64("session_id"), F.lit(SALTS)))
    for keys in (("date", "hour", "salt"), ("date", "hour")):
        s = s.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rn") <= n)
    quota = sample_quota(sessions, n).select("date", "hour", "quota")
    return s.join(quota, ["date", "hour"]).where(F.col("rn") <= F.col("quota")).drop("quota", "salt", "rn")


def sampled_ids(kept: DataFrame, n: int = DEFAULT_SAMPLE_SIZE, seed: str = DEFAULT_SEED) -> DataFrame:
    """The ids of the sample, at most ``n``, ready to be broadcast: only ids and times of
    the kept sessions are ranked, and the other columns fetched for the winners."""
    return broadcast_bounded(sample_sessions(kept.select("session_id", "start_ts"), n, seed).select("session_id"), n)


def random_extract_rows(sampled: DataFrame, task_id: int) -> DataFrame:
    """The 5 columns of the sample sink."""
    return sampled.select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        "session_id",
        "start_time",
        "search_keywords",
        "click_category_ids",
    )
