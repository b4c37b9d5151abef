"""A session holding most of the log: AQE splits it in the detail join."""

from pyspark.sql import functions as F

from clicklens.operators import sessions
from clicklens.params import TaskParams
from clicklens.sources.tables import read_actions

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
}


def test_hot_session_is_split_in_detail_join(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        # 90% of the rows in one session; a hashed payload keeps the rows from
        # compressing away (AQE sizes partitions by compressed shuffle bytes)
        log = spark.range(0, 200000, numPartitions=8).select(
            F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(
                F.concat(F.lit("s"), (F.col("id") % 997).cast("string"))).alias("session_id"),
            F.when(F.col("id") % 10 < 9, F.lit(1)).otherwise(F.col("id") % 997 + 2).alias("user_id"),
            (F.col("id") % 7).alias("page_id"),
            F.date_format(F.timestamp_seconds(F.col("id")), "yyyy-MM-dd H:mm:ss").alias("action_time"),
            F.sha2(F.col("id").cast("string"), 256).alias("search_keyword"),
            F.lit(None).cast("bigint").alias("click_category_id"),
            F.col("id").alias("event_id"),
        )
        acts = read_actions(spark, log)
        users = spark.range(0, 1100).select(F.col("id").alias("user_id"), F.lit(30).alias("age"),
                                            F.lit("p").alias("professional"), F.lit("c").alias("city"),
                                            F.lit("male").alias("sex"))
        kept = sessions.kept_sessions(acts, users, TaskParams(start_age=20, end_age=50))
        detail = sessions.session_detail(acts, kept)
        assert len(detail.collect()) == 200000
        final = detail._jdf.queryExecution().executedPlan().toString()
        assert "skewed" in final, final[:3000]  # AQEShuffleRead ... skewed: the hot partition is split
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_user_is_split_in_user_join(spark):
    # a skewed partition is cut along map outputs; keep the (tiny) session
    # aggregate from being coalesced into one map task, as it never is at scale
    conf = {**SKEW_CONF, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        # one user owns 90% of the sessions
        log = spark.range(0, 100000, numPartitions=8).select(
            F.concat(F.lit("s"), F.col("id").cast("string")).alias("session_id"),
            F.when(F.col("id") % 10 < 9, F.lit(1)).otherwise(F.col("id") % 997 + 2).alias("user_id"),
            (F.col("id") % 7).alias("page_id"),
            F.date_format(F.timestamp_seconds(F.col("id")), "yyyy-MM-dd H:mm:ss").alias("action_time"),
            F.sha2(F.col("id").cast("string"), 256).alias("search_keyword"),
            F.lit(None).cast("bigint").alias("click_category_id"),
            F.col("id").alias("event_id"),
        )
        users = spark.range(0, 1100).select(F.col("id").alias("user_id"), F.lit(30).alias("age"),
                                            F.lit("p").alias("professional"), F.lit("c").alias("city"),
                                            F.lit("male").alias("sex"))
        joined = sessions.session_user_join(sessions.session_aggregate(read_actions(spark, log)), users)
        assert len(joined.select("session_id", "age").collect()) == 100000
        q = joined.select("session_id", "age")
        q.collect()
        final = q._jdf.queryExecution().executedPlan().toString()
        assert "skewed" in final, final[:3000]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
