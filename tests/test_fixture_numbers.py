"""The derived inputs reproduce the counts FIXTURES.md documents for sf0.01."""

from pyspark.sql import functions as F

from clicklens.operators import bands, funnel, sessions
from clicklens.params import TaskParams
from clicklens.plans import catalog
from conftest import SF_CHECK


def test_documented_counts(spark):
    acts = catalog.actions(spark, SF_CHECK)
    s = sessions.session_aggregate(acts)
    c = bands.session_band_counts(s).first().asDict()
    assert c["session_count"] == 4006
    assert s.where(F.col("visit_length") == 0).count() == 1109
    want = {"1s_3s": 6, "4s_6s": 2, "7s_9s": 2, "10s_30s": 26, "30s_60s": 35, "1m_3m": 139, "3m_10m": 533,
            "10m_30m": 1928, "30m": 226}
    assert {k: c[f"visit_length_{k}"] for k in want} == want
    steps = s.agg(F.min("step_length"), F.max("step_length")).first()
    assert (steps[0], steps[1]) == (1, 10)
    pv = {r.page_split: r.split_pv for r in funnel.page_split_pv(
        funnel.page_transitions(acts), funnel.flow_steps(spark, [1, 2, 3, 4]), 4).collect()}
    assert pv == {"1_2": 63, "2_3": 49, "3_4": 56}
    kept = sessions.kept_sessions(acts, catalog.users(spark, SF_CHECK),
                                  TaskParams(start_age=20, end_age=50, sex=["male"], category_ids=list(range(1, 9))))
    assert kept.count() == 285
