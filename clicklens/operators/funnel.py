"""Page flow: consecutive page pairs within sessions and step conversion rates.

Pairs need the actions of a session in time order. A window over
``partitionBy(session_id)`` would put a hot session (say a third of all rows) into
one task, so sessions of more than ``HOT_ROWS`` actions are cut by the minute: the
window runs over (session, minute) pieces, and only for these sessions the pieces'
sizes and first pages are counted beside it and joined back. The cut follows from
the rows alone, so both sides agree without a written table, and all other sessions
are one piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.functions.columns import half_up_ratio
from clicklens.operators.joins import broadcast_bounded

HOT_ROWS = 1_000_000  # actions of one session that a task orders


def flow_steps(spark: SparkSession, flow: list[int]) -> DataFrame:
    """Steps of a target flow: ``step`` (1-based), ``from_page``, ``to_page``,
    ``page_split`` = "from_to". A one-page flow has no steps."""
    rows = [(i, int(flow[i - 1]), int(flow[i]), f"{flow[i - 1]}_{flow[i]}") for i in range(1, len(flow))]
    schema = T.StructType(
        [
            T.StructField("step", T.IntegerType(), False),
            T.StructField("from_page", T.LongType(), False),
            T.StructField("to_page", T.LongType(), False),
            T.StructField("page_split", T.StringType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)


def _ordered_columns(actions: DataFrame) -> DataFrame:
    """The ordering columns, with ``key``: the session id, or a stand-in that joins for
    the rows without one."""
    return actions.select(F.coalesce("session_id", F.lit(_NO_SESSION)).alias("key"), "session_id", "page_id", "action_ts", "tie")


_NO_SESSION = "\0"
_FIRST_PIECE = -(2**62)


def hot_sessions(rows: DataFrame, hot_rows: int) -> DataFrame:
    """Sessions of more than ``hot_rows`` actions: at most ``rows / hot_rows`` of them,
    a million in a log of 10^12 actions."""
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > hot_rows).select("key", F.lit(True).alias("hot"))


def _cut(actions: DataFrame, hot_rows: int) -> DataFrame:
    """The ordering columns and each row's ``piece``: 0, or in hot sessions the
    minute of its time (times that are missing come first, as in the order)."""
    rows = _ordered_columns(actions)
    minute = F.coalesce(F.floor(F.unix_seconds("action_ts") / 60), F.lit(_FIRST_PIECE)).cast("bigint")
    return rows.join(F.broadcast(hot_sessions(rows, hot_rows)), "key", "left").withColumn(
        "piece", F.when(F.col("hot"), minute).otherwise(F.lit(0)))


def _hot_pieces(cut: DataFrame) -> DataFrame:
    """Per piece of the hot sessions: the rows before it and the first page after it."""
    pieces = cut.where("hot").groupBy("key", "piece").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("page_id", F.struct("action_ts", "tie")).alias("first_page"))
    order = Window.partitionBy("key").orderBy("piece")
    return pieces.select("key", "piece", F.lead("first_page").over(order).alias("following_page"),
                         F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("offset"))


def _in_piece() -> WindowSpec:
    return Window.partitionBy("key", "piece").orderBy("action_ts", "tie")


def page_transitions(actions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every consecutive pair ``(session_id, page_id, next_page_id)`` of a
    session ordered by (action_ts, tie)."""
    cut = _cut(actions, hot_rows)
    rows = cut.select("key", "piece", "session_id", "page_id", F.lead("page_id").over(_in_piece()).alias("inside"),
                      F.lead(F.lit(True)).over(_in_piece()).alias("goes_on"))
    return rows.join(_hot_pieces(cut), ["key", "piece"], "left").select(
        "session_id", "page_id", F.when(F.col("goes_on"), F.col("inside")).otherwise(F.col("following_page")).alias("next_page_id")
    ).where(F.col("next_page_id").isNotNull())


def session_positions(actions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Actions with ``step_index`` (1-based position within the session in
    (action_ts, tie) order): the position in the piece plus, in hot sessions, the rows
    of the earlier pieces."""
    cut = _cut(actions, hot_rows)
    rows = cut.select("key", "piece", "session_id", "page_id", "action_ts", "tie", F.row_number().over(_in_piece()).alias("local"))
    return rows.join(_hot_pieces(cut), ["key", "piece"], "left").select(
        "session_id", "page_id", "action_ts", "tie",
        (F.coalesce("offset", F.lit(0)) + F.col("local")).cast("bigint").alias("step_index"))


def matched_splits(transitions: DataFrame, steps: DataFrame, flow_len: int) -> DataFrame:
    """Pairs equal to some step of the flow, as ``page_split`` text. The
    steps table has ``len(flow) - 1`` rows and is broadcast."""
    s = broadcast_bounded(steps.select("from_page", "to_page", "page_split").distinct(), flow_len)
    return transitions.join(
        s, (transitions.page_id == s.from_page) & (transitions.next_page_id == s.to_page), "inner"
    ).select("session_id", "page_split")


def page_split_pv(transitions: DataFrame, steps: DataFrame, flow_len: int) -> DataFrame:
    """Count of each matched page split."""
    return matched_splits(transitions, steps, flow_len).groupBy("page_split").agg(
        F.count(F.lit(1)).alias("split_pv")
    )


def start_page_pv(actions: DataFrame, flow: list[int]) -> DataFrame:
    """Number of actions on the flow's first page, at any position."""
    return actions.where(F.col("page_id") == F.lit(int(flow[0]))).agg(F.count(F.lit(1)).alias("start_page_pv"))


def page_convert_rate(actions: DataFrame, flow: list[int], task_id: int | None = None,
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per flow step: ``step, page_split, split_pv, convert_rate``.

    Step 1 divides by the first page's views, step i by the pv of step i-1;
    a split with no hit has pv 0, a zero denominator gives a NULL rate; a
    pair repeated in the flow keeps one row per step. Rates are rounded
    half-up to two decimals on integers.
    """
    spark = actions.sparkSession
    steps = flow_steps(spark, flow)
    pv = page_split_pv(page_transitions(actions, hot_rows), steps, len(flow))
    start = start_page_pv(actions, flow)
    per_step = steps.join(broadcast_bounded(pv, len(flow)), "page_split", "left").select(
        "step", "page_split", F.coalesce("split_pv", F.lit(0).cast("bigint")).alias("split_pv")
    )
    # Step 0 carries the first page's views, so the previous pv of every
    # step is a lag over at most len(flow) rows (no join needed).
    step0 = start.select(
        F.lit(0).alias("step"), F.lit(None).cast("string").alias("page_split"), F.col("start_page_pv").alias("split_pv")
    )
    prev = F.lag("split_pv").over(Window.orderBy("step"))
    out = (
        per_step.unionByName(step0)
        .select("step", "page_split", "split_pv", half_up_ratio(F.col("split_pv"), prev).alias("convert_rate"))
        .where(F.col("step") >= 1)
    )
    if task_id is not None:
        out = out.select(F.lit(task_id).cast("bigint").alias("task_id"), *out.columns)
    return out


def render_convert_rate(rates: DataFrame, task_id: int) -> DataFrame:
    """The page-split sink row: ``(task_id, "1_2=0.5|2_3=0.1")`` in step order."""
    item = F.struct("step", F.concat(F.col("page_split"), F.lit("="), F.coalesce(F.col("convert_rate").cast("string"), F.lit("null"))).alias("txt"))
    agg = rates.agg(F.array_sort(F.collect_list(item)).alias("items"))
    return agg.select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        F.array_join(F.transform("items", lambda s: s["txt"]), "|").alias("convert_rate"),
    )
