"""The stored log: date folders prune, buckets replace the shuffles."""

import uuid

from clicklens.operators import sessions
from clicklens.params import TaskParams
from clicklens.plans import catalog
from clicklens.sinks import action_log
from clicklens.sources import fixtures, tables
from conftest import SF_SMALL
from test_jobs_plans import plan


def test_dates_prune_and_sessions_need_no_exchange(spark):
    acts = catalog.stored_actions(spark, SF_SMALL)
    p = plan(sessions.session_aggregate(acts))
    assert "PartitionFilters: [isnotnull(session_date" in p and "SelectedBucketsCount: 8 out of 8" in p
    assert "Exchange" not in p
    # the details: only the ids are exchanged, to the log's buckets
    q = catalog.registry()["stored_session_detail"](spark, SF_SMALL)
    before = q._jdf.queryExecution().sparkPlan().toString()
    assert "Exchange" not in before
    p = q._jdf.queryExecution().executedPlan().toString()
    join = p[p.index("SortMergeJoin") if "SortMergeJoin" in p else p.index("LeftSemi"):]
    log_side = join.split("\n")[1:4]
    assert not any("Exchange hashpartitioning(session_id" in x for x in log_side), p


def test_breaking_the_range_changes_the_result(spark):
    """The range lies inside the data, so the filter matters."""
    all_days = tables.read_actions(spark, catalog.stored_log(spark, SF_SMALL))
    inside = catalog.stored_actions(spark, SF_SMALL)
    assert 0 < inside.count() < all_days.count()
    # text times, hours unpadded, are what the table holds
    assert inside.where("action_time rlike ' [0-9]:'").count() > 0 and inside.where("action_ts is null").count() == 0


def test_another_catalog_reads_the_log(spark, scratch):
    name = f"log_{uuid.uuid4().hex}"
    log = fixtures.model_actions(spark, SF_SMALL)
    action_log.write_action_log(log, name, f"{scratch}/log", 4)
    stored = spark.table(name)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema.fields)
    spark.sql(f"DROP TABLE {name}")
    action_log.attach_action_log(spark, schema, name, f"{scratch}/log", 4)
    again = spark.table(name).select(log.columns)
    assert again.exceptAll(log).count() == 0 and again.count() == log.count()
    kept = sessions.kept_sessions(tables.read_actions(spark, name), fixtures.user_info(spark, SF_SMALL), TaskParams(start_age=20, end_age=50))
    assert kept.count() > 0
    spark.sql(f"DROP TABLE {name}")
