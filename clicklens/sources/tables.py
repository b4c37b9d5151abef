"""Readers for the model's tables.

A source may be a DataFrame, a catalog table name or a parquet path, so the
same job runs on Hive tables on a cluster and on files in tests. Readers
only project and filter; Catalyst pushes both into the scan (``PushedFilters``
and a pruned ``ReadSchema``), and a log stored ``partitionBy(session_date)``
gets partition pruning from the same date predicate.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Union

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.functions.columns import parse_time
from clicklens.params import TaskParams

@dataclass(frozen=True)
class JdbcTable:
    """A table of a database. With ``column`` (a number), ``lower``, ``upper`` and ``parts``
    it is read in that many ranges at once, else by one task."""

    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    column: str | None = None
    lower: int | None = None
    upper: int | None = None
    parts: int | None = None


Source = Union[DataFrame, str, JdbcTable]


def load(spark: SparkSession, src: Source) -> DataFrame:
    """DataFrame as is; a database table by JDBC (filters are pushed into its query);
    a name with a path separator as parquet; else a table."""
    if isinstance(src, DataFrame):
        return src
    if isinstance(src, JdbcTable):
        return spark.read.jdbc(src.url, src.table, column=src.column, lowerBound=src.lower, upperBound=src.upper,
                               numPartitions=src.parts, properties=src.properties)
    if "/" in src or src.endswith(".parquet"):
        return spark.read.parquet(src)
    return spark.table(src)


def normalize_actions(actions: DataFrame) -> DataFrame:
    """Add typed ``action_ts`` (from text ``action_time`` if needed) and the
    ``tie`` column that orders equal times (``event_id`` if present, else
    ``page_id``)."""
    fields = {f.name: f.dataType for f in actions.schema.fields}
    cols = [F.col(c) for c in actions.columns if c not in ("action_ts", "tie")]
    if "action_ts" in fields:
        ts = F.col("action_ts")
    elif isinstance(fields.get("action_time"), (T.TimestampType, T.TimestampNTZType)):
        ts = F.col("action_time").cast("timestamp")
    else:
        ts = parse_time("action_time")
    tie = F.col("event_id") if "event_id" in fields else F.col("page_id")
    return actions.select(*cols, ts.alias("action_ts"), tie.cast("bigint").alias("tie"))


def read_actions(spark: SparkSession, src: Source, start: str | None = None, end: str | None = None) -> DataFrame:
    """Actions whose ``session_date`` lies in ``[start, end]`` (both inclusive,
    text compare of ``yyyy-MM-dd``); an open bound does not filter."""
    df = load(spark, src)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("session_date") >= F.lit(start))
    if end is not None:
        cond = cond & (F.col("session_date") <= F.lit(end))
    return normalize_actions(df.where(cond))


def read_actions_for(spark: SparkSession, src: Source, params: TaskParams) -> DataFrame:
    return read_actions(spark, src, params.start_date, params.end_date)


def read_users(spark: SparkSession, src: Source) -> DataFrame:
    """User dimension, only the columns the session filters use."""
    return load(spark, src).select("user_id", "age", "professional", "city", "sex")


def read_products(spark: SparkSession, src: Source) -> DataFrame:
    """Product dimension with ``product_status`` read from the JSON column."""
    return load(spark, src).select(
        "product_id",
        "product_name",
        F.get_json_object("extend_info", "$.product_status").alias("product_status"),
    )


def read_click_products(actions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """``city_id, product_id`` of click actions in the date range."""
    cond = F.col("click_product_id").isNotNull()
    if start is not None:
        cond = cond & (F.col("session_date") >= F.lit(start))
    if end is not None:
        cond = cond & (F.col("session_date") <= F.lit(end))
    return actions.where(cond).select("city_id", F.col("click_product_id").alias("product_id"))


def read_blacklist(spark: SparkSession, src: Source) -> DataFrame:
    """All blacklisted user ids, each once."""
    return load(spark, src).select("user_id").distinct()


def load_task(spark: SparkSession, src: Source, task_id: int) -> TaskParams:
    """Read one task row and decode its parameters.

    ``task_param`` is JSON whose values are arrays; the first element of each
    is used. An unknown id raises (it is never silently an empty task).
    """
    df = load(spark, src)
    params = F.from_json("task_param", "map<string,array<string>>")
    firsts = F.transform_values(params, lambda _k, v: F.try_element_at(v, F.lit(1)))
    row = df.where(F.col("task_id") == F.lit(task_id)).select(firsts.alias("p")).first()
    if row is None:
        raise KeyError(f"no task with task_id={task_id}")
    return TaskParams.from_param_map(task_id, dict(row["p"] or {}))


def ad_click_lookup(counts: DataFrame, keys: DataFrame) -> DataFrame:
    """Click count of each (date, user_id, ad_id) key, 0 when absent (a bulk
    left join instead of one lookup per key)."""
    k = ["date", "user_id", "ad_id"]
    return keys.select(*k).join(counts.select(*k, "click_count"), k, "left").select(
        *k, F.coalesce("click_count", F.lit(0).cast("bigint")).alias("click_count")
    )
