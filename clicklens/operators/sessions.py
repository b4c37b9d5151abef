"""Session aggregate, user enrichment, session filters and session detail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.functions.columns import elapsed_seconds, format_time, is_not_empty, sorted_join
from clicklens.operators.joins import broadcast_bounded
from clicklens.params import TaskParams

SESSION_COLUMNS = [
    "session_id",
    "user_id",
    "search_keywords",
    "click_category_ids",
    "visit_length",
    "step_length",
    "start_time",
]


def session_aggregate(actions: DataFrame, p: TaskParams | None = None) -> DataFrame:
    """One row per session from normalized actions.

    user id (``min``: a session has one user), distinct search keywords and
    clicked categories (true distinct; a missing click is no category),
    first/last action time, ``visit_length`` in whole seconds,
    ``step_length`` = number of actions. Every aggregate is partial-mergeable,
    so a hot session is pre-aggregated per map task before the shuffle.

    With task parameters, the keyword and category conditions are also
    computed here as boolean aggregates (``keyword_match``,
    ``category_match``): a session's pass/fail needs constant memory, and
    the distinct lists are only built when a result outputs them (Catalyst
    drops unused aggregates).
    """
    keyword = F.when(is_not_empty("search_keyword"), F.col("search_keyword"))
    flags = []
    if p is not None and p.keywords:
        flags.append(F.coalesce(F.bool_or(F.col("search_keyword").isin(list(p.keywords))), F.lit(False)).alias("keyword_match"))
    if p is not None and p.category_ids:
        flags.append(
            F.coalesce(F.bool_or(F.col("click_category_id").isin([int(c) for c in p.category_ids])), F.lit(False)).alias(
                "category_match"
            )
        )
    agg = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.array_sort(F.collect_set(keyword)).alias("keyword_list"),
        F.array_sort(F.collect_set("click_category_id")).alias("category_list"),
        F.min("action_ts").alias("start_ts"),
        F.max("action_ts").alias("end_ts"),
        F.count(F.lit(1)).alias("step_length"),
        *flags,
    )
    return agg.select(
        "session_id",
        "user_id",
        F.array_join("keyword_list", ",").alias("search_keywords"),
        sorted_join("category_list").alias("click_category_ids"),
        elapsed_seconds("start_ts", "end_ts").alias("visit_length"),
        "step_length",
        format_time("start_ts").alias("start_time"),
        "keyword_list",
        "category_list",
        "start_ts",
        *[c for c in ("keyword_match", "category_match") if c in agg.columns],
    )


def session_user_join(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with the user's age, professional, city and sex; inner join,
    so sessions of unknown users are dropped."""
    u = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(u, "user_id", "inner")


# ---- filters -----------------------------------------------------------------


def age_predicate(p: TaskParams) -> Column | None:
    """``start <= age <= end``; no condition unless both bounds are given; a
    missing age fails the condition."""
    if p.start_age is None or p.end_age is None:
        return None
    return F.col("age").between(p.start_age, p.end_age)


def in_predicate(column: str, values: list | None) -> Column | None:
    """Value is one of ``values``; no condition when ``values`` is None."""
    if not values:
        return None
    return F.col(column).isin(list(values))


def overlap_predicate(array_column: str, values: list | None, element_type: str) -> Column | None:
    """Some element of the session's list is in ``values``; an empty list fails."""
    if not values:
        return None
    wanted = F.array(*[F.lit(v).cast(element_type) for v in values])
    return F.arrays_overlap(F.col(array_column), wanted)


def equal_predicate(column: str, value) -> Column | None:
    """Exact equality; no condition when ``value`` is None."""
    if value is None:
        return None
    return F.col(column) == F.lit(value)


def session_predicates(p: TaskParams, columns: list[str] | None = None) -> list[Column]:
    """The six session conditions in order: age, professional, city, sex,
    keywords, categories. Absent parameters add no condition.

    The predicates are plain comparisons (a NULL rejects the row in a
    filter), so the user-column ones translate into Parquet pushed filters.
    """
    cols = set(columns or [])
    keywords = (
        F.col("keyword_match") if p.keywords and "keyword_match" in cols
        else overlap_predicate("keyword_list", p.keywords, "string")
    )
    cats = (
        F.col("category_match") if p.category_ids and "category_match" in cols
        else overlap_predicate("category_list", p.category_ids, "bigint")
    )
    preds = [
        age_predicate(p),
        in_predicate("professional", p.professionals),
        in_predicate("city", p.cities),
        in_predicate("sex", p.sex),
        keywords,
        cats,
    ]
    return [c for c in preds if c is not None]


def filter_sessions(enriched: DataFrame, p: TaskParams) -> DataFrame:
    """AND of all given conditions; Catalyst pushes the user-column parts
    below the join into the user scan."""
    preds = session_predicates(p, enriched.columns)
    if not preds:
        return enriched
    return enriched.where(reduce(lambda a, b: a & b, preds))


def kept_sessions(actions: DataFrame, users: DataFrame, p: TaskParams) -> DataFrame:
    """Aggregate, enrich, filter: the sessions a task keeps."""
    return filter_sessions(session_user_join(session_aggregate(actions, p), users), p)


def session_detail(actions: DataFrame, sessions: DataFrame, max_sessions: int | None = None) -> DataFrame:
    """Actions of the given sessions (left semi join: each action once).

    With ``max_sessions`` (a proven bound: a sample of n, a top k x n) the
    session list is broadcast and the action log is filtered where it is
    read, without being shuffled. Otherwise the join is a sort-merge join
    over two shuffles on ``session_id``, in which AQE splits a hot session's
    partition (tested with the kept sessions of a task, which arrive
    partitioned by user).
    """
    ids = broadcast_bounded(sessions.select("session_id"), max_sessions)
    return actions.join(ids, "session_id", "left_semi")


def detail_with_multiplicity(actions: DataFrame, picks: DataFrame, max_picks: int | None = None) -> DataFrame:
    """Actions joined to every pick row of their session (a session picked
    for k categories yields its actions k times)."""
    return actions.join(broadcast_bounded(picks.select("session_id"), max_picks), "session_id", "inner")


DETAIL_COLUMNS = [
    "user_id",
    "session_id",
    "page_id",
    "action_time",
    "search_keyword",
    "click_category_id",
    "click_product_id",
    "order_category_ids",
    "order_product_ids",
    "pay_category_ids",
    "pay_product_ids",
]


def detail_rows(detail: DataFrame, task_id: int) -> DataFrame:
    """The 12 columns of the detail sink (NULL clicks stay NULL)."""
    return detail.select(F.lit(task_id).cast("bigint").alias("task_id"), *DETAIL_COLUMNS)
