"""Join helpers with an explicit size policy.

A broadcast hint is applied only where the row count of the small side is
bounded by construction (a top-k, a literal list, a per-day-hour table of a
bounded date range) and that bound is below ``MAX_BROADCAST_ROWS``. Every
other join is left to Catalyst's statistics and to AQE, which converts a
shuffle join into a broadcast join only after measuring the real size of
the finished stage (``spark.sql.adaptive.autoBroadcastJoinThreshold``) and
otherwise keeps the sort-merge join, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000


def broadcast_bounded(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast ``df`` when its proven row bound is small; otherwise leave
    the strategy to the planner (sort-merge, or AQE's runtime broadcast)."""
    if max_rows is not None and max_rows <= MAX_BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast: for sides that grow with the
    input, whose packed files or estimates look small. They do not pass the driver."""
    return df.hint("merge")
