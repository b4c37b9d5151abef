"""clicklens: e-commerce clickstream analytics written as Spark DataFrame plans.

Batch jobs (session analysis, page funnel, area top-3) and the ad-click
stream are composed from built-in Spark operators only; every result is a
lazy DataFrame that Catalyst plans and AQE re-plans at run time.

Entry points: :func:`clicklens.plans.jobs.run_session`,
:func:`~clicklens.plans.jobs.run_page_flow`,
:func:`~clicklens.plans.jobs.run_area_top3`,
:func:`~clicklens.plans.jobs.run_ad_stream` (and the ``execute_*`` writers).
"""

from clicklens.params import TaskParams

__all__ = ["TaskParams", "jobs"]


def __getattr__(name):  # lazy: importing the package does not need a session
    if name == "jobs":
        from clicklens.plans import jobs

        return jobs
    raise AttributeError(name)
