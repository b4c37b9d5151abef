"""Visit-length and step-length bands of kept sessions, and their ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.functions.columns import half_up_ratio

# Band names and inclusive limits (None = open). Visit lengths
# are in seconds. A length of 0 falls in no band.
VISIT_BANDS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 29),
    ("30s_60s", 30, 59),
    ("1m_3m", 60, 179),
    ("3m_10m", 180, 599),
    ("10m_30m", 600, 1799),
    ("30m", 1800, None),
]
STEP_BANDS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 29),
    ("30_60", 30, 59),
    ("60", 60, None),
]


def _in_band(column: str, lo: int, hi: int | None):
    c = F.col(column)
    return (c >= lo) if hi is None else c.between(lo, hi)


Band = tuple[str, int, "int | None"]


def band_count_columns(visit_bands: list[Band] = VISIT_BANDS, step_bands: list[Band] = STEP_BANDS) -> list[str]:
    return [f"visit_length_{n}" for n, _, _ in visit_bands] + [f"step_length_{n}" for n, _, _ in step_bands]


def session_band_counts(sessions: DataFrame, visit_bands: list[Band] = VISIT_BANDS,
                        step_bands: list[Band] = STEP_BANDS) -> DataFrame:
    """One row: ``session_count`` and one count per band, in one pass
    (partial counts per task, one final merge). Bands are (name, low, high)
    with inclusive limits, ``None`` for an open end."""
    aggs = [F.count(F.lit(1)).alias("session_count")]
    aggs += [F.count_if(_in_band("visit_length", lo, hi)).alias(f"visit_length_{n}") for n, lo, hi in visit_bands]
    aggs += [F.count_if(_in_band("step_length", lo, hi)).alias(f"step_length_{n}") for n, lo, hi in step_bands]
    return sessions.agg(*aggs)


def session_band_ratios(counts: DataFrame, task_id: int, visit_bands: list[Band] = VISIT_BANDS,
                        step_bands: list[Band] = STEP_BANDS) -> DataFrame:
    """The ``session_aggr_stat`` row: each band / session count, two decimals
    half-up (exact on integers); NULL when there is no session."""
    n = F.col("session_count")
    ratios = [half_up_ratio(c, n).alias(f"{c}_ratio") for c in band_count_columns(visit_bands, step_bands)]
    return counts.select(F.lit(task_id).cast("bigint").alias("task_id"), n, *ratios)
