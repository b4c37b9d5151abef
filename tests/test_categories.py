"""Category counts, top categories and top sessions on hand rows."""

from pyspark.sql import functions as F

from clicklens.operators import categories
from clicklens.sources.tables import read_actions
from helpers import action, actions_df


def _acts(spark, rows):
    return read_actions(spark, actions_df(spark, rows))


def test_long_form_counts_every_list_item(spark):
    rows = [
        action("a", 1, "0:00:00", click=1),
        action("a", 1, "0:00:01", click=12),
        action("a", 1, "0:00:02", orders="1,12"),
        action("b", 2, "0:00:00", pays="7, 7"),
        action("b", 2, "0:00:01", orders=" ,x,3"),
    ]
    per = {(r.session_id, r.category_id): (r.click_count, r.order_count, r.pay_count)
           for r in categories.session_category_counts(_acts(spark, rows)).collect()}
    assert per == {("a", 1): (1, 1, 0), ("a", 12): (1, 1, 0), ("b", 7): (0, 0, 2), ("b", 3): (0, 1, 0)}


def test_pay_only_category_visited_by_default(spark):
    rows = [action("a", 1, "0:00:00", click=1), action("a", 1, "0:00:01", pays="9")]
    per = categories.session_category_counts(_acts(spark, rows))
    assert sorted(r.category_id for r in categories.category_counts(per).collect()) == [1, 9]
    code_like = categories.category_counts(per, visited=("click", "order"))
    assert [r.category_id for r in code_like.collect()] == [1]
    assert sorted(r.category_id for r in categories.visited_categories(per, ("click", "order")).collect()) == [1]


def test_join_twin_equals_long_form(spark):
    """Counts from the long form equal the three left joins of separate
    click / order / pay counts onto the visited categories."""
    rows = [action("s%d" % (i % 7), i % 3, "0:00:%02d" % (i % 60), click=(i % 5) if i % 2 else None,
                   orders=f"{i % 4},{(i + 1) % 4}" if i % 3 == 0 else None,
                   pays=str(i % 6) if i % 5 == 0 else None, event_id=i) for i in range(120)]
    acts = _acts(spark, rows)
    per = categories.session_category_counts(acts)
    long_form = {tuple(r) for r in categories.category_counts(per).collect()}
    visited = categories.visited_categories(per)
    twin = visited
    for kind in categories.KINDS:
        twin = twin.join(categories.kind_count(acts, kind), "category_id", "left")
    twin = twin.select("category_id", *[F.coalesce(f"{k}_count", F.lit(0)).alias(f"{k}_count") for k in categories.KINDS])
    assert {tuple(r) for r in twin.collect()} == long_form


def test_top_categories_order_and_ties(spark):
    counts = spark.createDataFrame(
        [(5, 3, 1, 1), (2, 3, 1, 1), (9, 3, 2, 0), (1, 4, 0, 0), (7, 3, 1, 2)],
        "category_id long, click_count long, order_count long, pay_count long",
    )
    top = [r.category_id for r in categories.top_categories(counts, 4).collect()]
    assert top == [1, 9, 7, 2]


def test_top_sessions_ties_by_session_id(spark):
    per = spark.createDataFrame(
        [("s%02d" % i, 1, 2 if i < 12 else 1, 0, 0) for i in range(15)] + [("x", 2, 5, 0, 0), ("y", 3, 0, 1, 0)],
        "session_id string, category_id long, click_count long, order_count long, pay_count long",
    )
    top = spark.createDataFrame([(1,), (3,)], "category_id long")
    got = categories.top_sessions_per_category(per, top, n=10, k=2).collect()
    assert [r.session_id for r in got if r.category_id == 1] == ["s%02d" % i for i in range(10)]
    assert all(r.category_id != 2 for r in got)
    assert all(r.category_id != 3 for r in got)  # no clicks on 3


def test_long_form_of_odd_lists(spark):
    """Blanks, empty items and words in the lists are no categories."""
    rows = [action("s", 1, "0:00:00", click=3, orders="1,,2, 4 ,x", pays="", event_id=1), action("s", 1, "0:00:01", pays="7,7", event_id=2)]
    got = sorted(tuple(r) for r in categories.category_events(read_actions(spark, actions_df(spark, rows))).collect())
    assert got == [("s", 1, 0, 1, 0), ("s", 2, 0, 1, 0), ("s", 3, 1, 0, 0), ("s", 4, 0, 1, 0), ("s", 7, 0, 0, 1), ("s", 7, 0, 0, 1)]
