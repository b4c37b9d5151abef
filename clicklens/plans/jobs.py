"""The three batch jobs: session analysis, page flow, area top-3.

``run_*`` returns one DataFrame per result table; frames that several results
share are written to the shared folder first (see :mod:`clicklens.operators.cache`).
``execute_*`` publishes all results of a run in one step
(:class:`~clicklens.sinks.snapshots.ResultStore`); a rerun replaces its own task's
results only, and the shared tables of a run are removed with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.operators import areas, bands, cache, categories, funnel, sampling, sessions
from clicklens.params import TaskParams
from clicklens.sinks.snapshots import ResultStore
from clicklens.sources.tables import Source, load, read_actions_for, read_click_products, read_products, read_users


@dataclass
class SessionSources:
    actions: Source
    users: Source


def run_session(spark: SparkSession, params: TaskParams, src: SessionSources, sample_size: int = 100,
                top_k: int = 10, top_n_sessions: int = 10, visited: tuple[str, ...] = categories.KINDS,
                detail_duplicates: bool = False, seed: str = sampling.DEFAULT_SEED,
                kept: DataFrame | None = None, visit_bands: list = bands.VISIT_BANDS,
                step_bands: list = bands.STEP_BANDS) -> dict[str, DataFrame]:
    """Session analysis: band ratios, time-proportional sample, top
    categories, their most active sessions, and the details of the sampled
    and top sessions. ``kept`` gives the kept sessions as a written table."""
    tid = params.task_id
    acts = read_actions_for(spark, src.actions, params)
    stored = kept is not None
    if kept is None:
        kept = sessions.kept_sessions(acts, read_users(spark, src.users), params)
    stat = bands.session_band_ratios(bands.session_band_counts(kept, visit_bands, step_bands), tid, visit_bands,
                                     step_bands)
    # intermediates read by several results are computed once (all are far
    # smaller than the log: one row per session and category, at most
    # sample_size sessions, at most top_k categories)
    winners = sampling.sampled_ids(kept, sample_size, seed)
    sampled = cache.share(kept.join(winners, "session_id", "left_semi") if stored
                          else sessions.session_aggregate(acts.join(winners, "session_id", "left_semi")))
    per_session = cache.share(categories.for_sessions(categories.session_category_counts(acts), kept))
    top = cache.share(categories.top_categories(categories.category_counts(per_session, visited), top_k))
    top_sessions = categories.top_sessions_per_category(per_session, top, top_n_sessions, top_k, tid)
    # one pass over the log for both details: a session that is sampled and top is
    # picked twice, one that is top in k categories once, or k times when asked
    picked = top_sessions.select("session_id")
    picks = sampled.select("session_id").unionByName(picked if detail_duplicates else picked.distinct())
    detail = sessions.detail_rows(sessions.detail_with_multiplicity(acts, picks, sample_size + top_k * top_n_sessions), tid)
    return {
        "session_aggr_stat": stat,
        "session_random_extract": sampling.random_extract_rows(sampled, tid),
        "session_detail": detail,
        "top10_category": top.select(F.lit(tid).cast("bigint").alias("task_id"), *top.columns),
        "top10_category_session": top_sessions,
    }


def run_page_flow(spark: SparkSession, params: TaskParams, actions: Source) -> dict[str, DataFrame]:
    """Page one-step conversion rates of the task's target flow."""
    if not params.target_page_flow:
        raise ValueError("task has no targetPageFlow")
    acts = read_actions_for(spark, actions, params)
    rates = funnel.page_convert_rate(acts, params.target_page_flow, params.task_id)
    return {
        "page_convert_rate": rates,
        "page_split_convert_rate": funnel.render_convert_rate(rates.drop("task_id"), params.task_id),
    }


def run_area_top3(spark: SparkSession, params: TaskParams, actions: Source, cities: Source, products: Source,
                  n: int = 3, area_levels: dict[str, str] | None = None,
                  status_text: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Top products per area over the task's date range."""
    clicks = read_click_products(load(spark, actions), params.start_date, params.end_date)
    top = areas.area_top3_product(
        clicks, load(spark, cities), read_products(spark, products), params.task_id, n, area_levels, status_text
    )
    return {"area_top3_product": top}


SESSION_JOB, PAGE_FLOW_JOB, AREA_JOB = "session", "page_flow", "area_top3"


def execute_session_job(spark: SparkSession, params: TaskParams, src: SessionSources, out_root: str,
                        **options) -> None:
    """Run and publish the session job. The kept sessions feed four results,
    so they are written once."""
    with cache.scope(spark):
        acts = read_actions_for(spark, src.actions, params)
        kept = cache.share(sessions.kept_sessions(acts, read_users(spark, src.users), params))
        ResultStore(spark, out_root).publish(SESSION_JOB, params.task_id, run_session(spark, params, src, kept=kept, **options))


def execute_page_flow(spark: SparkSession, params: TaskParams, actions: Source, out_root: str) -> None:
    with cache.scope(spark):
        ResultStore(spark, out_root).publish(PAGE_FLOW_JOB, params.task_id, run_page_flow(spark, params, actions))


def execute_area_top3(spark: SparkSession, params: TaskParams, actions: Source, cities: Source, products: Source,
                      out_root: str, **options) -> None:
    with cache.scope(spark):
        ResultStore(spark, out_root).publish(AREA_JOB, params.task_id,
                                             run_area_top3(spark, params, actions, cities, products, **options))


def run_ad_stream(spark: SparkSession, source, out_root: str, threshold: int, **options):
    """The real-time ad job: start the intake on a streaming
    source (see :mod:`clicklens.streaming.ad_stream`); returns the query."""
    from clicklens.streaming.ad_stream import start_ad_stream

    return start_ad_stream(spark, source, out_root, threshold, **options)


def run_ad_rollups(spark: SparkSession, out_root: str, **options):
    """The rollup streams over the accepted clicks of a running or finished intake."""
    from clicklens.streaming.ad_stream import start_ad_rollups

    return start_ad_rollups(spark, out_root, **options)
