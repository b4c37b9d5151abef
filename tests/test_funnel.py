"""Page transitions (hot sessions cut by the minute) against a Python twin, and rates."""

import random

from clicklens.operators import funnel
from clicklens.sources.tables import read_actions
from helpers import action, actions_df


def _rows(hot_rows=600, seed=3):
    rnd = random.Random(seed)
    rows, eid = [], 0
    for s in range(40):
        for _ in range(rnd.randint(1, 8)):
            rows.append(action(f"s{s:02d}", s, f"{rnd.randint(0, 2)}:{rnd.randint(0, 59):02d}:{rnd.randint(0, 59):02d}",
                               page=rnd.randint(0, 5), event_id=eid))
            eid += 1
    for _ in range(hot_rows):  # one hot session, many equal times
        rows.append(action("hot", 999, f"5:{rnd.randint(0, 3):02d}:{rnd.randint(0, 59):02d}", page=rnd.randint(0, 5),
                           event_id=eid))
        eid += 1
    return rows


def _python_pairs(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    out = []
    for sid, rs in by.items():
        rs.sort(key=lambda r: (r[4].split(" ")[1].zfill(8), r[13]))
        for a, b in zip(rs, rs[1:]):
            out.append((sid, a[3], b[3]))
    return sorted(out)


def _python_positions(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    out = []
    for sid, rs in by.items():
        rs.sort(key=lambda r: (r[4].split(" ")[1].zfill(8), r[13]))
        out += [(sid, i + 1, r[13]) for i, r in enumerate(rs)]
    return sorted(out)


def test_transitions_equal_python_twin_for_any_hot_bound(spark):
    rows = _rows()
    acts = read_actions(spark, actions_df(spark, rows))
    want = _python_pairs(rows)
    for n in (0, 1, 3, 100, 10**6):
        got = sorted(tuple(r) for r in funnel.page_transitions(acts, n).collect())
        assert got == want, n


def test_positions_equal_python_twin(spark):
    rows = _rows(hot_rows=300)
    acts = read_actions(spark, actions_df(spark, rows))
    want = _python_positions(rows)
    for n in (0, 5, 100, 10**6):
        got = sorted((r.session_id, r.step_index, r.tie) for r in funnel.session_positions(acts, n).collect())
        assert got == want, n


def test_only_hot_sessions_are_cut(spark):
    acts = read_actions(spark, actions_df(spark, _rows(hot_rows=2000)))
    pieces = {(r.key, r.piece) for r in funnel._cut(acts, 100).select("key", "piece").distinct().collect()}
    assert len([p for p in pieces if p[0] == "hot"]) == 4  # four minutes
    assert all(p == 0 for k, p in pieces if k != "hot")
    assert {r.key for r in funnel._hot_pieces(funnel._cut(acts, 100)).collect()} == {"hot"}


def test_rows_without_session_or_time(spark):
    """Rows without a session are one more sequence; missing times come first."""
    rows = [action(None, 1, f"0:{i:02d}:00", page=i, event_id=i) for i in range(5)]
    rows += [action("s", 1, t, page=p, event_id=p) for p, t in ((1, "bad"), (2, "0:01:00"), (3, "0:09:00"), (4, "worse"))]
    acts = read_actions(spark, actions_df(spark, rows))
    for hot in (0, 2, 10**6):
        got = sorted((tuple(r) for r in funnel.page_transitions(acts, hot).collect()), key=str)
        assert got == sorted([(None, i, i + 1) for i in range(4)] + [("s", 1, 4), ("s", 4, 2), ("s", 2, 3)], key=str)
        assert {(r.session_id, r.tie): r.step_index for r in funnel.session_positions(acts, hot).collect()}[("s", 2)] == 3


def _rates(spark, rows, flow):
    acts = read_actions(spark, actions_df(spark, rows))
    out = [tuple(r) for r in funnel.page_convert_rate(acts, flow).orderBy("step").collect()]
    return out


def test_convert_rate_rules(spark):
    # pages of one session in time order: 1 2 3 1 2 ; plus a lone page-1 view
    seq = [1, 2, 3, 1, 2]
    rows = [action("a", 1, f"0:00:{i:02d}", page=p, event_id=i) for i, p in enumerate(seq)]
    rows.append(action("b", 2, "0:00:00", page=1, event_id=99))
    # start pv = 3 views of page 1; 1_2 twice; 2_3 once; 3_4 never; 4_5 then has a zero denominator
    got = _rates(spark, rows, [1, 2, 3, 4, 5])
    assert got == [(1, "1_2", 2, 0.67), (2, "2_3", 1, 0.5), (3, "3_4", 0, 0.0), (4, "4_5", 0, None)]


def test_repeated_pair_in_flow_keeps_one_row_per_step(spark):
    seq = [1, 2, 1, 2]
    rows = [action("a", 1, f"0:00:{i:02d}", page=p, event_id=i) for i, p in enumerate(seq)]
    got = _rates(spark, rows, [1, 2, 1, 2])
    assert got == [(1, "1_2", 2, 1.0), (2, "2_1", 1, 0.5), (3, "1_2", 2, 2.0)]


def test_one_page_flow_has_no_steps(spark):
    rows = [action("a", 1, "0:00:00", page=1)]
    assert _rates(spark, rows, [1]) == []


def test_equal_times_ordered_by_tie(spark):
    rows = [action("a", 1, "0:00:00", page=p, event_id=e) for p, e in [(3, 2), (1, 0), (2, 1)]]
    acts = read_actions(spark, actions_df(spark, rows))
    got = sorted(tuple(r) for r in funnel.page_transitions(acts).collect())
    assert got == [("a", 1, 2), ("a", 2, 3)]


def test_rendered_rate_string(spark):
    seq = [1, 2, 3]
    rows = [action("a", 1, f"0:00:{i:02d}", page=p, event_id=i) for i, p in enumerate(seq)]
    acts = read_actions(spark, actions_df(spark, rows))
    r = funnel.render_convert_rate(funnel.page_convert_rate(acts, [1, 2, 3, 9]), 4).first()
    assert (r.task_id, r.convert_rate) == (4, "1_2=1.0|2_3=1.0|3_9=0.0")
