"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row is produced,
nothing is collected to the driver). Before timing, the same queries run once
on smaller testdata (``$BENCH_WARMUP_DIR``; default sf0.01, or sf0.001 when
the bench itself runs on sf0.01) to warm the
JVM, the JIT and the codegen cache, so the timings measure execution on the
bench data rather than one-off compilation. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "session_aggregate",
    "session_band_ratios",
    "session_detail",
    "sample_sessions",
    "top10_category",
    "top10_session",
    "page_convert_rate",
    "session_time_sort",
    "area_top3_product",
    "ad_user_click_count",
    "ad_stat",
    "ad_province_top3",
    "ad_click_trend",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from clicklens.plans import catalog
    from clicklens.spark import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(int(cpus), 1) if cpus != "*" else 8, app="clicklens-bench")
    reg = catalog.registry()
    default_warm = "/root/testdata/sf0.01"
    if os.path.abspath(default_warm) == os.path.abspath(sf_dir):
        default_warm = "/root/testdata/sf0.001"
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", default_warm)
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in HEADLINE:
            reg[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    def session_job(d: str) -> None:
        """The whole session job: all five results, kept sessions shared."""
        from clicklens.operators import cache, sessions
        from clicklens.plans import jobs
        from clicklens.sources import fixtures

        p = catalog.TASK
        acts = catalog.actions(spark, d)
        kept = cache.share(sessions.kept_sessions(acts, catalog.users(spark, d), p))
        src = jobs.SessionSources(fixtures.user_visit_action(spark, d), fixtures.user_info(spark, d))
        for df in jobs.run_session(spark, p, src, sample_size=catalog.SAMPLE_SIZE, kept=kept).values():
            df.write.format("noop").mode("overwrite").save()

    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        session_job(warm_dir)

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        reg[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    session_job(sf_dir)
    times["session_job_all_results"] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
