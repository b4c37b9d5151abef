"""The action log stored by date and bucketed by session.

Date folders make a task's date range a partition filter. Inside a date the rows are
hashed to buckets by ``session_id``, and Spark knows it: aggregates and joins per
session start from the files, without shuffling the log. Rows are dealt to the
writing tasks by (date, bucket) through a rebalance, which splits what is too large
for one task, so a hot session makes several files of its bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_action_log(actions: DataFrame, table: str, path: str, buckets: int) -> None:
    """Store ``actions`` as ``table`` at ``path``. ``buckets`` is the number of tasks a
    scan by session gets; choose it so that a bucket of the usual date range fits a task."""
    bucket = F.pmod(F.hash("session_id"), F.lit(buckets))
    dealt = actions.withColumn("_bucket", bucket).hint("rebalance", "session_date", "_bucket")
    dealt.select(*actions.columns).write.partitionBy("session_date").bucketBy(buckets, "session_id").sortBy("session_id").option(
        "path", path).mode("overwrite").saveAsTable(table)


def attach_action_log(spark: SparkSession, schema: str, table: str, path: str, buckets: int) -> None:
    """Make a stored log known to another session's catalog."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet PARTITIONED BY (session_date) "
              f"CLUSTERED BY (session_id) SORTED BY (session_id) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
