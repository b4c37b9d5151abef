"""Hand-row builders for tests."""

from __future__ import annotations

from pyspark.sql import types as T

ACTION_SCHEMA = T.StructType(
    [
        T.StructField("session_date", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.StringType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
    ]
)

USER_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("sex", T.StringType()),
    ]
)


def action(session_id, user_id, time, page=0, keyword=None, click=None, product=None, orders=None, pays=None,
           city=0, event_id=0, date=None):
    """One action row; ``time`` is ``H:mm:ss`` on ``date`` (default 2024-01-01)."""
    date = date or "2024-01-01"
    return (date, user_id, session_id, page, f"{date} {time}", keyword, click, product, orders, None, pays, None,
            city, event_id)


def actions_df(spark, rows):
    return spark.createDataFrame(rows, ACTION_SCHEMA)


def users_df(spark, rows):
    """rows: (user_id, age, professional, city, sex)"""
    full = [(u, f"u{u}", f"name{u}", a, p, c, s) for (u, a, p, c, s) in rows]
    return spark.createDataFrame(full, USER_SCHEMA)


def session_with_length(session_id, user_id, visit_seconds, steps=2, date=None):
    """A session whose first and last actions are ``visit_seconds`` apart."""
    rows = []
    for i in range(steps):
        sec = 0 if i == 0 else (visit_seconds if i == steps - 1 else min(i, visit_seconds))
        h, m, s = sec // 3600, (sec % 3600) // 60, sec % 60
        rows.append(action(session_id, user_id, f"{h}:{m:02d}:{s:02d}", page=i % 10, event_id=i, date=date))
    return rows
