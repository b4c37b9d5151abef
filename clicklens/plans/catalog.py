"""Registry of named queries over the testdata.

Each entry is ``(spark, sf_dir) -> DataFrame`` and runs over the whole
derived tables (the task's date range spans all of the data); the task
parameters below are the conditions of the demonstration task, not row caps.
"""

from __future__ import annotations

import dataclasses
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.operators import ads, areas, bands, cache, categories, funnel, sampling, sessions
from clicklens.operators.joins import broadcast_bounded
from clicklens.params import TaskParams
from clicklens.sinks import action_log
from clicklens.sinks.files import Folder
from clicklens.sinks.snapshots import MergeTable, ResultStore
from clicklens.sources import fixtures, tables
from clicklens.spark import ensure_checkpoint_dir
from clicklens.streaming import ad_stream

# Fixed values of the demonstration tasks (mirrored in oracle/sql.py).
SESSION_TASK = TaskParams(
    task_id=1,
    start_date="2024-01-01",
    end_date="2024-01-30",
    start_age=20,
    end_age=50,
    target_page_flow=[1, 2, 3, 4],
)
FILTER_ALL_TASK = TaskParams(
    task_id=2, start_date="2024-01-01", end_date="2024-01-30", start_age=20, end_age=50,
    sex=["male"], category_ids=[1, 2, 3, 4, 5, 6, 7, 8],
)
FILTER_TASKS = {
    "filter_age": TaskParams(start_age=20, end_age=50),
    "filter_professional": TaskParams(professionals=["BUILDING", "MACHINERY"]),
    "filter_city": TaskParams(cities=["NATION_1", "NATION_7", "NATION_13"]),
    "filter_sex": TaskParams(sex=["female"]),
    "filter_keywords": TaskParams(keywords=["kw1", "kw3"]),
    "filter_categories": TaskParams(category_ids=[1, 2, 3, 4, 5, 6, 7, 8]),
}
FILTER_EQUAL = ("professional", "AUTOMOBILE")
SAMPLE_SIZE = 2000
SAMPLE_SEED = "clicklens"
TOP_CATEGORIES = 10
TOP_SESSIONS = 10
TOP_PRODUCTS = 3
AD_BLACKLIST_THRESHOLD = 2
# two overlapping ad batches for the write-rule queries
AD_OLD_LAST_DAY = "2024-01-15"
AD_NEW_FIRST_DAY = "2024-01-10"
# sliding trend window
TREND_WINDOW, TREND_SLIDE = "1 hour", "1 minute"
# the ad stream reads the log in micro-batches of this many days
AD_STREAM_ORIGIN = "2024-01-01"
AD_STREAM_DAYS_PER_BATCH = 5
# the second delivery begins with this batch; files that a rollup takes at once
AD_STREAM_SECOND_DELIVERY, AD_ROLLUP_FILES = 4, 6
# late clicks come this many batches after their own; the trend's watermark
AD_LATE_BATCHES, AD_WATERMARK = 3, "7 days"
# a date range inside the data, and the buckets of the stored log
STORED_START, STORED_END, STORED_BUCKETS = "2024-01-08", "2024-01-14", 8

Query = Callable[[SparkSession, str], DataFrame]
TASK = SESSION_TASK


# ---- inputs ------------------------------------------------------------------


def actions(spark: SparkSession, sf: str, p: TaskParams = TASK) -> DataFrame:
    return tables.read_actions(spark, fixtures.user_visit_action(spark, sf), p.start_date, p.end_date)


def users(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_users(spark, fixtures.user_info(spark, sf))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.session_user_join(sessions.session_aggregate(actions(spark, sf)), users(spark, sf))


def kept(spark: SparkSession, sf: str, p: TaskParams = TASK) -> DataFrame:
    return sessions.kept_sessions(actions(spark, sf, p), users(spark, sf), p)


def kept_category_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Per (session, category) counts of the kept sessions."""
    return categories.for_sessions(categories.session_category_counts(actions(spark, sf)), kept(spark, sf))


def top10(counts: DataFrame) -> DataFrame:
    return categories.top_categories(categories.category_counts(counts), TOP_CATEGORIES)


def top_sessions(spark: SparkSession, sf: str) -> DataFrame:
    counts = cache.share(kept_category_counts(spark, sf))
    return categories.top_sessions_per_category(counts, top10(counts), TOP_SESSIONS, TOP_CATEGORIES, TASK.task_id)


def clicks_on_top(spark: SparkSession, sf: str) -> DataFrame:
    counts = cache.share(kept_category_counts(spark, sf))
    top = broadcast_bounded(top10(counts).select("category_id"), TOP_CATEGORIES)
    return counts.where(F.col("click_count") > 0).join(top, "category_id", "left_semi").select(
        "category_id", "session_id", "click_count"
    )


def sampled(spark: SparkSession, sf: str) -> DataFrame:
    winners = sampling.sampled_ids(kept(spark, sf), SAMPLE_SIZE, SAMPLE_SEED)
    return sessions.session_aggregate(actions(spark, sf).join(winners, "session_id", "left_semi"))


def sample_index(spark: SparkSession, sf: str) -> DataFrame:
    sessions_ = kept(spark, sf).select("session_id", "start_ts")
    quota = sampling.sample_quota(sessions_, SAMPLE_SIZE).select("date", "hour", "quota")
    return sampling.with_date_hour(sessions_).join(quota, ["date", "hour"]).select("session_id", "date", "hour", "quota")


def transitions(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.page_transitions(actions(spark, sf))


def steps(spark: SparkSession) -> DataFrame:
    return funnel.flow_steps(spark, TASK.target_page_flow)


def clicks_scan(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.normalize_actions(fixtures.user_visit_action(spark, sf))
    return tables.read_click_products(raw, TASK.start_date, TASK.end_date)


def cities(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.city_info(spark, sf)


def products(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_products(spark, fixtures.product_info(spark, sf))


def ad_log(spark: SparkSession, sf: str) -> DataFrame:
    return ads.parse_ad_log(fixtures.ad_log_lines(spark, sf))


def ad_counts(spark: SparkSession, sf: str, clicks: DataFrame | None = None) -> DataFrame:
    return ads.ad_user_click_count(clicks if clicks is not None else ad_log(spark, sf))


def ad_blacklist(spark: SparkSession, sf: str, clicks: DataFrame | None = None) -> DataFrame:
    return ads.ad_blacklist(ad_counts(spark, sf, clicks), AD_BLACKLIST_THRESHOLD)


def ad_allowed(spark: SparkSession, sf: str, clicks: DataFrame | None = None) -> DataFrame:
    c = clicks if clicks is not None else ad_log(spark, sf)
    return ads.drop_blacklisted(c, ad_blacklist(spark, sf, c))


def ad_batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    log = ads.with_time_keys(ad_log(spark, sf))
    old = log.where(F.col("date") <= AD_OLD_LAST_DAY).drop("date", "hour", "minute")
    new = log.where(F.col("date") >= AD_NEW_FIRST_DAY).drop("date", "hour", "minute")
    return old, new


ACTION_COLUMNS = sessions.DETAIL_COLUMNS
ENRICHED_COLUMNS = sessions.SESSION_COLUMNS + ["age", "professional", "city", "sex"]


def ad_click_columns() -> list:
    return [F.unix_millis("ts").alias("epoch_ms"), "province", "city", "user_id", "ad_id"]


def _filter(key: str) -> Query:
    def run(spark, sf):
        return sessions.kept_sessions(actions(spark, sf), users(spark, sf), FILTER_TASKS[key]).select(
            *sessions.SESSION_COLUMNS
        )

    return run


def _kind_count(kind: str) -> Query:
    """Count of one kind per category over the kept sessions' actions, read
    from the pre-aggregated (session, category) counts (no raw detail join)."""
    def run(spark, sf):
        counts = kept_category_counts(spark, sf).groupBy("category_id").agg(
            F.sum(f"{kind}_count").cast("bigint").alias(f"{kind}_count")
        )
        return counts.where(F.col(f"{kind}_count") > 0)

    return run


def _only(column: str) -> Query:
    def run(spark, sf):
        return actions(spark, sf).where(F.col(column).isNotNull()).select(*ACTION_COLUMNS)

    return run


_MADE: dict[tuple, object] = {}


def _once(spark: SparkSession, sf: str, what: str, make: Callable[[str], object]):
    """What several keys of one session read, made once: ``make`` gets a folder of its
    own under the shared checkpoint folder."""
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _MADE:
        _MADE[key] = make(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}")
    return _MADE[key]


def stage_lines(lines: DataFrame, batch: Column, path: str, first_time: float) -> None:
    """Text files of ``value`` under ``path``, one per ``batch`` (a number), with times in
    the order of the batches, so that a stream of one file a trigger reads them so."""
    lines.select(batch.alias("batch"), "value").repartition("batch").write.partitionBy("batch").text(path)
    folder = Folder(lines.sparkSession, path)
    for name in folder.names():
        if name.startswith("batch="):
            for file in folder.names(name):
                folder.set_time(f"{name}/{file}", first_time + int(name[6:]))


def batch_of(date: str = "date") -> Column:
    return F.floor(F.datediff(F.col(date), F.lit(AD_STREAM_ORIGIN)) / AD_STREAM_DAYS_PER_BATCH).cast("int")


def streamed_ad_tables(spark: SparkSession, sf: str) -> ad_stream.AdTables:
    """The tables after the ad stream has read the whole raw log, bad lines included,
    in micro-batches of ``AD_STREAM_DAYS_PER_BATCH`` days in time order. The log comes in
    two deliveries, and all queries are restarted from their checkpoints for the
    second."""
    def make(base: str) -> ad_stream.AdTables:
        lines = fixtures.ad_stream_lines(spark, sf).withColumn("n", batch_of())
        for delivery, part in enumerate((F.col("n") < AD_STREAM_SECOND_DELIVERY, F.col("n") >= AD_STREAM_SECOND_DELIVERY)):
            stage_lines(lines.where(part), F.col("n"), f"{base}/in/delivery={delivery}", time.time() - 1000)
            source = ad_stream.read_ad_log(spark, f"{base}/in", max_files_per_trigger=1)
            ad_stream.run_available(spark, source, f"{base}/out", AD_BLACKLIST_THRESHOLD, max_files_per_trigger=AD_ROLLUP_FILES)
        return ad_stream.AdTables.at(spark, f"{base}/out")

    return _once(spark, sf, "ad-stream", make)


def late_trend(spark: SparkSession, sf: str) -> DataFrame:
    """The trend of a log whose late clicks come ``AD_LATE_BATCHES`` batches after their
    day's: those of minutes that the watermark has passed are left out."""
    def make(base: str) -> ad_stream.AdTables:
        lines = fixtures.late_ad_lines(spark, sf)
        batch = batch_of() + F.when(F.col("late"), AD_LATE_BATCHES).otherwise(0)
        stage_lines(lines, batch, f"{base}/in", time.time() - 1000)
        clicks = ads.parse_ad_log(ad_stream.read_ad_log(spark, f"{base}/in", max_files_per_trigger=1))
        ad_stream.start_trend_stream(spark, clicks, f"{base}/out", AD_WATERMARK).awaitTermination()
        return ad_stream.AdTables.at(spark, f"{base}/out")

    return _once(spark, sf, "late-trend", make).trend.read()


def published(spark: SparkSession, sf: str, job: str) -> ResultStore:
    """The store after a job has run for two tasks, the first one's twice (the first
    run with other results, which the second replaces)."""
    from clicklens.plans import jobs

    log = fixtures.user_visit_action(spark, sf)

    def make(root: str) -> ResultStore:
        for task in (dataclasses.replace(TASK, start_date=STORED_START, end_date=STORED_END), TASK,
                     dataclasses.replace(TASK, task_id=TASK.task_id + 1)):
            if job == jobs.SESSION_JOB:
                jobs.execute_session_job(spark, task, jobs.SessionSources(log, fixtures.user_info(spark, sf)), root,
                                         sample_size=SAMPLE_SIZE, top_k=TOP_CATEGORIES, top_n_sessions=TOP_SESSIONS, seed=SAMPLE_SEED)
            elif job == jobs.PAGE_FLOW_JOB:
                jobs.execute_page_flow(spark, task, log, root)
            else:
                jobs.execute_area_top3(spark, task, log, fixtures.city_info(spark, sf), fixtures.product_info(spark, sf), root, n=TOP_PRODUCTS)
        return ResultStore(spark, root)

    return _once(spark, sf, f"results-{job}", make)


def _result(job: str, name: str) -> Query:
    """A task's rows as they stand in the result table."""
    return lambda s, sf: published(s, sf, job).read(job, name, TASK.task_id)


def _upserted(name: str, table: Callable[[SparkSession, str], MergeTable], rows: Callable[[DataFrame], DataFrame]) -> Query:
    """A keyed table after the rows of two overlapping batches were committed to it,
    the second one twice."""
    def run(spark, sf):
        def make(root: str) -> MergeTable:
            made = table(spark, root)
            for batch, clicks in enumerate(ad_batches(spark, sf)):
                made.commit(rows(clicks), batch)
            made.commit(rows(ad_batches(spark, sf)[1]), 1)
            return made

        return _once(spark, sf, f"table-{name}", make).read()

    return run


def stored_log(spark: SparkSession, sf: str) -> str:
    """The name of the action log's table, by date and bucketed by session, in the text
    form of its producers (no typed time)."""
    def make(path: str) -> str:
        name = f"actions_{uuid.uuid4().hex}"
        action_log.write_action_log(fixtures.model_actions(spark, sf), name, path, STORED_BUCKETS)
        return name

    return _once(spark, sf, "action-log", make)


def stored_actions(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_actions(spark, stored_log(spark, sf), STORED_START, STORED_END)


def stored_kept(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.kept_sessions(stored_actions(spark, sf), users(spark, sf), TASK)


# ---- the registry ------------------------------------------------------------


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}

    # sources
    q["actions_by_date"] = lambda s, sf: actions(s, sf).select(
        "session_date", "user_id", "session_id", "page_id", "action_time", "search_keyword", "click_category_id",
        "click_product_id", "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids", "city_id",
    )
    q["user_info"] = users
    q["product_info"] = products
    q["area_click_scan"] = clicks_scan
    q["ad_click_lookup"] = lambda s, sf: tables.ad_click_lookup(
        ad_counts(s, sf), fixtures.ad_non_click_keys(s, sf).distinct()
    )

    # projections / filters
    for key in FILTER_TASKS:
        q[key] = _filter(key)
    q["filter_equal"] = lambda s, sf: enriched(s, sf).where(
        sessions.equal_predicate(*FILTER_EQUAL)
    ).select(*sessions.SESSION_COLUMNS)
    q["filter_all"] = lambda s, sf: sessions.kept_sessions(actions(s, sf), users(s, sf), FILTER_ALL_TASK).select(
        *sessions.SESSION_COLUMNS
    )
    q["clicks_only"] = _only("click_category_id")
    q["orders_only"] = _only("order_category_ids")
    q["pays_only"] = _only("pay_category_ids")
    q["start_page_only"] = lambda s, sf: actions(s, sf).where(
        F.col("page_id") == TASK.target_page_flow[0]
    ).select(*ACTION_COLUMNS)
    q["flow_match"] = lambda s, sf: funnel.matched_splits(transitions(s, sf), steps(s), len(TASK.target_page_flow))

    # joins
    q["session_user_join"] = lambda s, sf: enriched(s, sf).select(*ENRICHED_COLUMNS)
    q["session_detail"] = lambda s, sf: sessions.detail_rows(
        sessions.session_detail(actions(s, sf), kept(s, sf)), TASK.task_id
    )
    q["category_counts"] = lambda s, sf: categories.category_counts(kept_category_counts(s, sf))
    q["top_category_session_join"] = clicks_on_top
    q["top10_session_detail"] = lambda s, sf: sessions.detail_rows(
        sessions.session_detail(actions(s, sf), top_sessions(s, sf), TOP_CATEGORIES * TOP_SESSIONS), TASK.task_id
    )
    q["sample_session_detail"] = lambda s, sf: sessions.detail_rows(
        sessions.session_detail(actions(s, sf), sampled(s, sf), SAMPLE_SIZE), TASK.task_id
    )
    q["sample_index_lookup"] = sample_index
    q["flow_broadcast"] = lambda s, sf: transitions(s, sf).join(
        F.broadcast(steps(s)),
        (F.col("page_id") == F.col("from_page")) & (F.col("next_page_id") == F.col("to_page")),
    ).select("session_id", "page_id", "next_page_id", "step")
    q["area_city_join"] = lambda s, sf: areas.area_city_join(clicks_scan(s, sf), cities(s, sf)).select(
        "city_id", "product_id", "city_name", "area"
    )
    q["area_product_join"] = lambda s, sf: areas.area_product_join(
        areas.top_clicked(clicks_scan(s, sf), cities(s, sf), TOP_PRODUCTS),
        products(s, sf),
    ).select("area", "product_id", "click_count", "city_infos", "product_name", "product_status")
    q["ad_blacklist_filter"] = lambda s, sf: ad_allowed(s, sf).select(*ad_click_columns())

    # aggregations
    q["session_aggregate"] = lambda s, sf: sessions.session_aggregate(actions(s, sf)).select(*sessions.SESSION_COLUMNS)
    q["session_band_counts"] = lambda s, sf: bands.session_band_counts(kept(s, sf))
    q["session_band_ratios"] = lambda s, sf: bands.session_band_ratios(
        bands.session_band_counts(kept(s, sf)), TASK.task_id
    )
    # a session's detail rows are its steps: no join with the log needed (rows
    # without a session have no detail)
    q["total_detail_count"] = lambda s, sf: kept(s, sf).where("session_id is not null").agg(
        F.coalesce(F.sum("step_length"), F.lit(0)).cast("bigint").alias("detail_count")
    )
    q["visited_categories"] = lambda s, sf: categories.visited_categories(kept_category_counts(s, sf))
    q["category_click_count"] = _kind_count("click")
    q["category_order_count"] = _kind_count("order")
    q["category_pay_count"] = _kind_count("pay")
    q["sessions_per_hour"] = lambda s, sf: sampling.sessions_per_hour(kept(s, sf))
    q["sessions_per_day"] = lambda s, sf: sampling.sessions_per_day(sampling.sessions_per_hour(kept(s, sf)))
    q["category_session_clicks"] = lambda s, sf: kept_category_counts(s, sf).where(
        F.col("click_count") > 0
    ).select("category_id", "session_id", "click_count")
    q["page_split_pv"] = lambda s, sf: funnel.page_split_pv(transitions(s, sf), steps(s), len(TASK.target_page_flow))
    q["start_page_pv"] = lambda s, sf: funnel.start_page_pv(actions(s, sf), TASK.target_page_flow)
    q["area_product_clicks"] = lambda s, sf: areas.area_product_clicks(
        areas.area_city_join(clicks_scan(s, sf), cities(s, sf))
    )
    q["ad_user_click_count"] = ad_counts
    q["ad_blacklist"] = ad_blacklist
    q["ad_stat"] = lambda s, sf: ads.ad_stat(ad_allowed(s, sf))
    q["ad_click_trend"] = lambda s, sf: ads.ad_click_trend(ad_allowed(s, sf))
    q["ad_click_trend_window"] = lambda s, sf: ads.ad_click_trend_window(
        ad_allowed(s, sf), TREND_WINDOW, TREND_SLIDE
    ).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        "ad_id",
        "click_count",
    )

    # per-group operators
    q["top10_session"] = top_sessions
    q["sample_quota"] = lambda s, sf: sampling.sample_quota(kept(s, sf), SAMPLE_SIZE)
    q["sample_sessions"] = lambda s, sf: sampling.random_extract_rows(sampled(s, sf), TASK.task_id)
    q["page_splits"] = transitions
    q["page_convert_rate"] = lambda s, sf: funnel.page_convert_rate(actions(s, sf), TASK.target_page_flow, TASK.task_id)
    q["area_top3_product"] = lambda s, sf: areas.area_top3_product(
        clicks_scan(s, sf), cities(s, sf), products(s, sf), TASK.task_id, TOP_PRODUCTS
    )
    q["ad_province_top3"] = lambda s, sf: ads.ad_province_top3(ads.ad_stat(ad_allowed(s, sf)))

    # sorts / top-k
    q["top10_category"] = lambda s, sf: categories.top_categories(
        categories.category_counts(kept_category_counts(s, sf)), TOP_CATEGORIES, TASK.task_id
    )
    q["session_time_sort"] = lambda s, sf: funnel.session_positions(actions(s, sf)).select(
        "session_id", "step_index", "page_id", F.col("tie").alias("event_id")
    )

    # result tables: written by the jobs, read back through their manifests
    from clicklens.plans import jobs

    q["sink_session_aggr_stat"] = _result(jobs.SESSION_JOB, "session_aggr_stat")
    q["sink_session_random_extract"] = _result(jobs.SESSION_JOB, "session_random_extract")
    q["sink_session_detail"] = _result(jobs.SESSION_JOB, "session_detail")
    q["sink_top10_category"] = _result(jobs.SESSION_JOB, "top10_category")
    q["sink_top10_session"] = _result(jobs.SESSION_JOB, "top10_category_session")
    q["sink_page_split_convert_rate"] = _result(jobs.PAGE_FLOW_JOB, "page_split_convert_rate")
    q["sink_area_top3_product"] = _result(jobs.AREA_JOB, "area_top3_product")

    # keyed tables: two batches committed and merged when read
    at = lambda field: lambda s, root: getattr(ad_stream.AdTables.at(s, root), field)
    q["sink_ad_user_click_count"] = _upserted("counts", at("counts"), ads.ad_user_click_count)
    q["sink_ad_stat"] = _upserted("stat", at("stat"), ads.ad_stat)
    q["sink_ad_click_trend"] = _upserted("trend", at("trend"), ads.ad_click_trend)
    q["sink_ad_province_top3"] = _upserted("top3", at("top3"), lambda c: ads.ad_province_top3(ads.ad_stat(c)))
    q["sink_ad_blacklist"] = _upserted(
        "blacklist", at("blacklist"), lambda c: ads.ad_blacklist(ads.ad_user_click_count(c), AD_BLACKLIST_THRESHOLD))

    # the stored log: a date range inside the data, times parsed from text
    q["stored_actions_by_date"] = lambda s, sf: stored_actions(s, sf).select(
        "session_date", *ACTION_COLUMNS, "city_id", F.date_format("action_ts", "yyyy-MM-dd HH:mm:ss").alias("parsed_time"))
    q["stored_session_aggregate"] = lambda s, sf: sessions.session_aggregate(stored_actions(s, sf)).select(*sessions.SESSION_COLUMNS)
    q["stored_session_detail"] = lambda s, sf: sessions.detail_rows(
        sessions.session_detail(stored_actions(s, sf), stored_kept(s, sf)), TASK.task_id)

    # optional forms
    q["top10_session_detail_each"] = lambda s, sf: sessions.detail_rows(
        sessions.detail_with_multiplicity(actions(s, sf), top_sessions(s, sf), TOP_CATEGORIES * TOP_SESSIONS), TASK.task_id)
    q["category_counts_click_order"] = lambda s, sf: categories.category_counts(kept_category_counts(s, sf), ("click", "order"))

    # streaming: the batch twin of parsing, and the stream's own tables
    q["parse_ad_log"] = lambda s, sf: ad_log(s, sf).select(*ad_click_columns())
    q["ad_user_counts_stream"] = lambda s, sf: streamed_ad_tables(s, sf).counts.read()
    q["blacklist_update"] = lambda s, sf: streamed_ad_tables(s, sf).blacklist.read()
    q["blacklist_scan"] = lambda s, sf: tables.read_blacklist(s, streamed_ad_tables(s, sf).blacklist.read())
    q["ad_stat_stream"] = lambda s, sf: streamed_ad_tables(s, sf).stat.read()
    q["ad_province_top3_stream"] = lambda s, sf: streamed_ad_tables(s, sf).top3.read()
    q["ad_click_trend_stream"] = lambda s, sf: streamed_ad_tables(s, sf).trend.read()
    q["ad_click_trend_late"] = late_trend
    q["ad_stream_batches"] = lambda s, sf: streamed_ad_tables(s, sf).batches.read()
    q["ad_bad_lines"] = lambda s, sf: streamed_ad_tables(s, sf).log.bad_lines().select(F.col("b").alias("batch"), "value")
    q["ad_line_counts"] = lambda s, sf: ads.ad_line_counts(fixtures.ad_stream_lines(s, sf))
    return q
