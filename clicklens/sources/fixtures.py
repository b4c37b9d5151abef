"""Input tables of the clickstream model, derived from the raw testdata.

The raw ``events`` table has no session or page, so they are derived: a
session is a user-day, the page is ``k % 10`` where ``k`` is the number in
``props``, and the clock is compressed (second of day / 40, shifted by
``user_id % 24`` hours) so visits span every length band. Dimension tables
come from ``customer``/``nation``/``region``/``part``.

Everything here is a lazy projection of the given parquet files; nothing is
materialised, so the derived inputs grow with the raw ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = raw(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("bigint")
    epoch_s = F.unix_timestamp(F.col("ts").cast("timestamp"))
    sec = (F.col("user_id") % 24) * 3600 + F.floor((epoch_s % 86400) / 40).cast("bigint")
    return ev.select(
        "event_id",
        "user_id",
        "event_type",
        k.alias("k"),
        F.date_format("ts", "yyyy-MM-dd").alias("session_date"),
        sec.alias("sec"),
        (epoch_s - epoch_s % 86400).alias("day_start"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def user_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log: 13 columns of the model plus ``event_id`` (tie key)
    and ``action_ts``.

    ``action_time`` is text ``yyyy-MM-dd H:mm:ss`` with an unpadded hour, as
    the model's producers write it; ``action_ts`` is the same instant as a
    timestamp, as a typed store would keep it (readers parse the text only
    when no typed column exists).
    """
    b = _events_base(spark, sf_dir)
    k, et, sec = F.col("k"), F.col("event_type"), F.col("sec")
    hms = F.concat(
        (sec / 3600).cast("bigint").cast("string"),
        F.lit(":"),
        F.lpad(((sec % 3600) / 60).cast("bigint").cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((sec % 60).cast("string"), 2, "0"),
    )
    pair = lambda a, step, mod: F.concat((a % mod).cast("string"), F.lit(","), ((a + step) % mod).cast("string"))
    return b.select(
        "session_date",
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.col("session_date")).alias("session_id"),
        (k % 10).alias("page_id"),
        F.concat(F.col("session_date"), F.lit(" "), hms).alias("action_time"),
        F.when(et == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(et == "click", k % 20).alias("click_category_id"),
        F.when(et == "click", k).alias("click_product_id"),
        F.when(et == "signup", pair(k, 7, 20)).alias("order_category_ids"),
        F.when(et == "signup", pair(k, 7, 100)).alias("order_product_ids"),
        F.when(et == "purchase", pair(k, 3, 20)).alias("pay_category_ids"),
        F.when(et == "purchase", pair(k, 3, 100)).alias("pay_product_ids"),
        (F.col("user_id") % 25).alias("city_id"),
        "event_id",
        F.timestamp_seconds(F.col("day_start") + sec).alias("action_ts"),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = raw(spark, sf_dir, "customer")
    n = raw(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(18) + F.col("c_custkey") % 43).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = raw(spark, sf_dir, "nation")
    r = raw(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = raw(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_size") % 2).cast("string"), F.lit("}")).alias("extend_info"),
    )


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed ad clicks: ``ts, province, city, user_id, ad_id``.

    Clicks are the ``click`` events; the city is the nation of
    ``user_id % 25`` and the province its region (blanks in names become
    ``_`` so that the space separated log line stays five fields). Only cities that a
    remainder by 25 can name take part, so they are broadcast; by the sizes that the
    planner estimates it would broadcast the events.
    """
    b = _events_base(spark, sf_dir).where(F.col("event_type") == "click")
    cities = city_info(spark, sf_dir).where(F.col("city_id").between(-24, 24))
    return b.join(F.broadcast(cities), (F.col("user_id") % 25) == cities.city_id).select(
        F.col("ts"),
        F.regexp_replace("area", " ", "_").alias("province"),
        F.regexp_replace("city_name", " ", "_").alias("city"),
        F.col("user_id"),
        (F.col("k") % 10).alias("ad_id"),
    )


def ad_non_click_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, user_id, ad_id) keys of the non-click events: lookup probes."""
    b = _events_base(spark, sf_dir).where(F.col("event_type") != "click")
    return b.select(
        F.col("session_date").alias("date"),
        "user_id",
        (F.col("k") % 10).alias("ad_id"),
    )


def ad_log_lines(spark: SparkSession, sf_dir: str, with_date: bool = False) -> DataFrame:
    """The ad log as text: ``epoch_ms province city user_id ad_id`` (plus the
    click's ``date`` when asked, for staging one file per day)."""
    a = ad_clicks(spark, sf_dir)
    extra = [F.date_format("ts", "yyyy-MM-dd").alias("date")] if with_date else []
    return a.select(
        *extra,
        F.concat_ws(
            " ",
            F.unix_millis("ts").cast("string"),
            "province",
            "city",
            F.col("user_id").cast("string"),
            F.col("ad_id").cast("string"),
        ).alias("value")
    )


def ad_stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ad stream, ``day`` (of the event) and ``value``: the ad log and, for every
    ``error`` event, a line that is malformed in one of three ways (a field missing,
    a user id that is no number, a time that is no number)."""
    b = _events_base(spark, sf_dir).where("event_type = 'error'")
    ms, k = F.unix_millis("ts").cast("string"), F.col("k") % 3
    user, ad = F.col("user_id").cast("string"), (F.col("k") % 10).cast("string")
    bad = F.when(k == 0, F.concat_ws(" ", ms, F.lit("P"), F.lit("C"), user)).when(
        k == 1, F.concat_ws(" ", ms, F.lit("P"), F.lit("C"), F.concat(F.lit("u"), user), ad)).otherwise(
        F.concat_ws(" ", F.concat(ms, F.lit("x")), F.lit("P"), F.lit("C"), user, ad))
    days = b.select(F.date_format("ts", "yyyy-MM-dd").alias("date"), bad.alias("value"))
    return ad_log_lines(spark, sf_dir, with_date=True).unionByName(days)


def late_ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ad log, ``date``, ``late`` and ``value``: every fifth click (by its
    millisecond) arrives late."""
    lines = ad_log_lines(spark, sf_dir, with_date=True)
    return lines.withColumn("late", F.split("value", " ")[0].cast("bigint") % 5 == 0)


def model_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log as its producers write it: the 13 text and number columns of
    the model and ``event_id``, no typed time."""
    return user_visit_action(spark, sf_dir).drop("action_ts")


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Register the model's tables as temporary views for ``spark.sql``."""
    views = {
        "user_visit_action": user_visit_action(spark, sf_dir),
        "user_info": user_info(spark, sf_dir),
        "product_info": product_info(spark, sf_dir),
        "city_info": city_info(spark, sf_dir),
        "ad_log": ad_log_lines(spark, sf_dir),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
