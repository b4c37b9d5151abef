"""Session aggregate, user join, filters and bands on hand rows."""

from pyspark.sql import functions as F

from clicklens.functions.columns import half_up_ratio
from clicklens.operators import bands, sessions
from clicklens.params import TaskParams
from clicklens.sources.tables import read_actions
from helpers import action, actions_df, session_with_length, users_df

VISIT_EDGES = [0, 1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60, 179, 180, 599, 600, 1799, 1800]
STEP_EDGES = [1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60]


def _band_of(value, table):
    for name, lo, hi in table:
        if value >= lo and (hi is None or value <= hi):
            return name
    return None


def test_visit_length_band_edges(spark):
    rows = []
    for i, v in enumerate(VISIT_EDGES):
        rows += session_with_length(f"s{i}", 1, v, steps=2)
    acts = read_actions(spark, actions_df(spark, rows))
    s = sessions.session_aggregate(acts)
    got = {r.session_id: r.visit_length for r in s.collect()}
    assert got == {f"s{i}": v for i, v in enumerate(VISIT_EDGES)}
    counts = bands.session_band_counts(s).first().asDict()
    assert counts["session_count"] == len(VISIT_EDGES)
    for name, _, _ in bands.VISIT_BANDS:
        want = sum(1 for v in VISIT_EDGES if _band_of(v, bands.VISIT_BANDS) == name)
        assert counts[f"visit_length_{name}"] == want, name
    # length 0 is in no band
    assert sum(counts[f"visit_length_{n}"] for n, _, _ in bands.VISIT_BANDS) == len(VISIT_EDGES) - 1


def test_step_length_band_edges(spark):
    rows = []
    for i, n in enumerate(STEP_EDGES):
        rows += [action(f"s{i}", 1, f"0:00:{j % 60:02d}", event_id=j) for j in range(n)]
    s = sessions.session_aggregate(read_actions(spark, actions_df(spark, rows)))
    counts = bands.session_band_counts(s).first().asDict()
    for name, _, _ in bands.STEP_BANDS:
        want = sum(1 for n in STEP_EDGES if _band_of(n, bands.STEP_BANDS) == name)
        assert counts[f"step_length_{name}"] == want, name


def test_aggregate_distinct_lists_and_unpadded_hour(spark):
    rows = [
        action("a", 7, "3:05:06", keyword="新辣道鱼火锅", click=12, event_id=1),
        action("a", 7, "3:05:07", keyword="火锅", click=1, event_id=2),
        action("a", 7, "13:05:06", keyword="火锅", click=12, event_id=3),
        action("b", 8, "0:00:00", event_id=4),
    ]
    s = {r.session_id: r for r in sessions.session_aggregate(read_actions(spark, actions_df(spark, rows))).collect()}
    a = s["a"]
    assert a.search_keywords == ",".join(sorted(["新辣道鱼火锅", "火锅"]))
    assert a.click_category_ids == "1,12"
    assert a.step_length == 3
    assert a.visit_length == 10 * 3600
    assert a.start_time == "2024-01-01 03:05:06"
    b = s["b"]
    assert b.search_keywords == "" and b.click_category_ids == "" and b.category_list == []


def test_equal_action_times_give_zero_length(spark):
    rows = [action("a", 1, "1:00:00", event_id=i) for i in range(3)]
    s = sessions.session_aggregate(read_actions(spark, actions_df(spark, rows))).first()
    assert s.visit_length == 0 and s.step_length == 3


def test_unknown_user_is_dropped_by_join(spark):
    rows = [action("a", 1, "0:00:00"), action("b", 99, "0:00:00")]
    users = users_df(spark, [(1, 30, "p", "c", "male")])
    joined = sessions.session_user_join(sessions.session_aggregate(read_actions(spark, actions_df(spark, rows))), users)
    assert [r.session_id for r in joined.collect()] == ["a"]


def _enriched(spark):
    rows = [
        action("a", 1, "0:00:00", keyword="kw1", click=1),
        action("b", 2, "0:00:00", keyword="kw2", click=12),
        action("c", 3, "0:00:00"),
        action("d", 4, "0:00:00", keyword="kw1"),
    ]
    users = users_df(spark, [(1, 20, "BUILDING", "X", "male"), (2, 50, "MACHINERY", "Y", "female"),
                             (3, 35, "BUILDING", "Y", "male"), (4, None, "BUILDING", "X", "male")])
    return sessions.session_user_join(sessions.session_aggregate(read_actions(spark, actions_df(spark, rows))), users)


def _ids(df):
    return sorted(r.session_id for r in df.collect())


def test_filter_without_params_is_identity(spark):
    e = _enriched(spark)
    assert _ids(sessions.filter_sessions(e, TaskParams())) == ["a", "b", "c", "d"]


def test_age_filter_needs_both_bounds_and_rejects_missing_age(spark):
    e = _enriched(spark)
    assert _ids(sessions.filter_sessions(e, TaskParams(start_age=21))) == ["a", "b", "c", "d"]
    assert _ids(sessions.filter_sessions(e, TaskParams(start_age=20, end_age=35))) == ["a", "c"]


def test_list_filters(spark):
    e = _enriched(spark)
    assert _ids(sessions.filter_sessions(e, TaskParams(professionals=["MACHINERY"]))) == ["b"]
    assert _ids(sessions.filter_sessions(e, TaskParams(cities=["X"]))) == ["a", "d"]
    assert _ids(sessions.filter_sessions(e, TaskParams(sex=["female"]))) == ["b"]
    # keyword / category lists: overlap, an empty session list rejects, 1 is not 12
    assert _ids(sessions.filter_sessions(e, TaskParams(keywords=["kw1"]))) == ["a", "d"]
    assert _ids(sessions.filter_sessions(e, TaskParams(category_ids=[1]))) == ["a"]
    assert _ids(sessions.filter_sessions(e, TaskParams(category_ids=[12, 5]))) == ["b"]
    assert _ids(e.where(sessions.equal_predicate("city", "Y"))) == ["b", "c"]
    all_ = TaskParams(start_age=20, end_age=50, sex=["male"], keywords=["kw1"], category_ids=[1])
    assert _ids(sessions.filter_sessions(e, all_)) == ["a"]


def test_half_up_ratio_exact(spark):
    cases = [(1, 8, 0.13), (1, 3, 0.33), (2, 3, 0.67), (0, 5, 0.0), (5, 5, 1.0), (1, 200, 0.01), (1, 400, 0.0),
             (3, 400, 0.01), (1, 0, None)]
    df = spark.createDataFrame([(x, n) for x, n, _ in cases], "x long, n long")
    got = [r.r for r in df.select(half_up_ratio("x", "n").alias("r")).collect()]
    assert got == [c[2] for c in cases]


def test_band_ratios_row_shape(spark):
    rows = session_with_length("a", 1, 5) + session_with_length("b", 1, 100)
    s = sessions.session_aggregate(read_actions(spark, actions_df(spark, rows)))
    r = bands.session_band_ratios(bands.session_band_counts(s), 7).first().asDict()
    assert len(r) == 17 and r["task_id"] == 7 and r["session_count"] == 2
    assert r["visit_length_4s_6s_ratio"] == 0.5 and r["visit_length_1m_3m_ratio"] == 0.5
    assert r["step_length_1_3_ratio"] == 1.0


def test_no_sessions_gives_null_ratios(spark):
    s = sessions.session_aggregate(read_actions(spark, actions_df(spark, [])))
    r = bands.session_band_ratios(bands.session_band_counts(s), 1).first()
    assert r.session_count == 0 and r.visit_length_1s_3s_ratio is None


def test_date_range_is_inclusive(spark):
    rows = [action(f"s{d}", 1, "0:00:00", date=f"2024-01-0{d}") for d in range(1, 6)]
    acts = read_actions(spark, actions_df(spark, rows), "2024-01-02", "2024-01-04")
    assert sorted(r.session_date for r in acts.collect()) == ["2024-01-02", "2024-01-03", "2024-01-04"]


def test_detail_keeps_null_clicks_and_semi_join(spark):
    rows = [action("a", 1, "0:00:00"), action("a", 1, "0:00:01", click=3), action("b", 2, "0:00:00")]
    acts = read_actions(spark, actions_df(spark, rows))
    kept = spark.createDataFrame([("a",), ("a",)], "session_id string")
    d = sessions.detail_rows(sessions.session_detail(acts, kept), 5).orderBy("action_time").collect()
    assert [r.click_category_id for r in d] == [None, 3]
    assert all(r.task_id == 5 for r in d)
    dup = sessions.detail_with_multiplicity(acts, kept).count()
    assert dup == 4
    assert acts.where(F.col("session_id") == "a").count() == 2


def test_flags_replace_lists_in_filters(spark):
    rows = [
        action("a", 1, "0:00:00", keyword="kw1", click=1),
        action("b", 2, "0:00:00", keyword="kw2", click=12),
        action("c", 3, "0:00:00"),
    ]
    users = users_df(spark, [(1, 20, "B", "X", "male"), (2, 50, "M", "Y", "female"), (3, 35, "B", "Y", "male")])
    acts = read_actions(spark, actions_df(spark, rows))
    p = TaskParams(keywords=["kw2"], category_ids=[12])
    kept = sessions.kept_sessions(acts, users, p)
    assert _ids(kept) == ["b"]
    # counting kept sessions never builds the distinct lists
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        bands.session_band_counts(kept).explain()
    text = buf.getvalue()
    assert "collect_set" not in text and "max((search_keyword" in text  # bool_or plans as max


def test_custom_bands(spark):
    rows = session_with_length("a", 1, 5) + session_with_length("b", 1, 100)
    s = sessions.session_aggregate(read_actions(spark, actions_df(spark, rows)))
    vb, sb = [("short", 0, 59), ("long", 60, None)], [("any", 1, None)]
    r = bands.session_band_ratios(bands.session_band_counts(s, vb, sb), 1, vb, sb).first().asDict()
    assert (r["visit_length_short_ratio"], r["visit_length_long_ratio"], r["step_length_any_ratio"]) == (0.5, 0.5, 1.0)
