"""Category counts, top-k categories and the most active sessions per category.

All category work starts from one long form: each action contributes its
clicked category and every id of its order and pay lists, tagged by kind.
It is built in a single pass (no union of three scans) and reduced
per (session, category) with partial aggregation, so everything downstream
joins and groups pre-aggregated rows instead of raw actions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.operators.joins import broadcast_bounded

KINDS = ("click", "order", "pay")


def category_events(actions: DataFrame) -> DataFrame:
    """Long form ``session_id, category_id, clicks, orders, pays`` (one row per
    category occurrence, the counters are 0/1).

    An action makes one row per kind it has, whose id list is then split and
    exploded: generators and string built-ins only, all inside codegen. (Lambda-based
    array functions run interpreted and were several times slower on the same rows.)
    """
    kinds = F.expr("stack(3, 0, cast(click_category_id as string), 1, order_category_ids, 2, pay_category_ids) as (kind, ids)")
    lists = actions.select("session_id", kinds).where("ids is not null")
    items = lists.select("session_id", "kind", F.explode(F.split("ids", ",")).alias("item"))
    parsed = items.select(
        "session_id",
        F.trim("item").try_cast("bigint").alias("category_id"),
        *((F.col("kind") == k).cast("int").alias(name) for k, name in enumerate(("clicks", "orders", "pays"))),
    )
    return parsed.where(F.col("category_id").isNotNull())


def session_category_counts(actions: DataFrame) -> DataFrame:
    """Per (session, category): click, order and pay counts."""
    return category_events(actions).groupBy("session_id", "category_id").agg(
        F.sum("clicks").cast("bigint").alias("click_count"),
        F.sum("orders").cast("bigint").alias("order_count"),
        F.sum("pays").cast("bigint").alias("pay_count"),
    )


def for_sessions(per_session: DataFrame, sessions: DataFrame) -> DataFrame:
    """Restrict per-session rows to the given (kept) sessions."""
    return per_session.join(sessions.select("session_id"), "session_id", "left_semi")


def category_counts(per_session: DataFrame, visited: tuple[str, ...] = KINDS) -> DataFrame:
    """Per category: click, order and pay counts (0 when missing), over the
    categories visited by one of the ``visited`` kinds.

    The default counts a category as visited when it was clicked, ordered
    or paid; ``visited=("click", "order")`` drops pay-only categories.
    """
    counts = per_session.groupBy("category_id").agg(
        F.sum("click_count").cast("bigint").alias("click_count"),
        F.sum("order_count").cast("bigint").alias("order_count"),
        F.sum("pay_count").cast("bigint").alias("pay_count"),
    )
    cond = F.lit(False)
    for kind in visited:
        cond = cond | (F.col(f"{kind}_count") > 0)
    return counts.where(cond)


def visited_categories(per_session: DataFrame, visited: tuple[str, ...] = KINDS) -> DataFrame:
    """Distinct categories visited by one of the ``visited`` kinds."""
    cond = F.lit(False)
    for kind in visited:
        cond = cond | (F.col(f"{kind}_count") > 0)
    return per_session.where(cond).select("category_id").distinct()


def kind_count(actions: DataFrame, kind: str) -> DataFrame:
    """Count of one kind per category straight from actions (click rows, or
    the split order/pay lists)."""
    ev = category_events(actions)
    col = {"click": "clicks", "order": "orders", "pay": "pays"}[kind]
    return ev.where(F.col(col) == 1).groupBy("category_id").agg(F.count(F.lit(1)).alias(f"{kind}_count"))


def top_categories(counts: DataFrame, k: int = 10, task_id: int | None = None) -> DataFrame:
    """The ``k`` categories ordered by clicks, orders, pays (all descending),
    ties by category id. ``orderBy + limit`` plans as TakeOrderedAndProject:
    a per-partition top-k and one small merge."""
    top = counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")
    ).limit(k)
    cols = ["category_id", "click_count", "order_count", "pay_count"]
    if task_id is not None:
        return top.select(F.lit(task_id).cast("bigint").alias("task_id"), *cols)
    return top.select(*cols)


def top_sessions_per_category(per_session: DataFrame, top: DataFrame, n: int = 10, k: int = 10,
                              task_id: int | None = None) -> DataFrame:
    """For each top category, the ``n`` sessions with most clicks on it (ties
    by session id).

    The top list has at most ``k`` rows, so it is broadcast. The row_number
    filter with a literal bound becomes a WindowGroupLimit that keeps ``n``
    rows per category in every map task before the shuffle, so a hot
    category never gathers all of its sessions in one task.
    """
    clicked = per_session.where(F.col("click_count") > 0).select("category_id", "session_id", "click_count")
    picked = clicked.join(broadcast_bounded(top.select("category_id"), k), "category_id", "left_semi")
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    ranked = picked.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop("rn")
    if task_id is not None:
        return ranked.select(F.lit(task_id).cast("bigint").alias("task_id"), "category_id", "session_id", "click_count")
    return ranked
