"""Task parameters, task loading and scalar column helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clicklens.functions import columns as C
from clicklens.params import TaskParams
from clicklens.sources.tables import load_task, read_blacklist, read_products, ad_click_lookup


def test_params_from_json_first_element_and_lists():
    p = TaskParams.from_json(3, '{"startDate":["2024-01-01","x"],"endDate":["2024-01-02"],"startAge":["20"],'
                                '"endAge":["50"],"sex":["male"],"categoryIds":["1,2, 3"],"targetPageFlow":["1,2,3,4"],'
                                '"cities":[""]}')
    assert (p.task_id, p.start_date, p.end_date, p.start_age, p.end_age) == (3, "2024-01-01", "2024-01-02", 20, 50)
    assert p.sex == ["male"] and p.category_ids == [1, 2, 3] and p.target_page_flow == [1, 2, 3, 4]
    assert p.cities is None and p.keywords is None and p.professionals is None
    assert TaskParams.from_json(3, p.to_json()) == p
    assert p.num_days() == 2


def test_load_task(spark):
    tasks = spark.createDataFrame(
        [(1, "t1", '{"startDate":["2024-01-01"],"endDate":["2024-01-03"],"keywords":["a,b"]}'),
         (2, "t2", "{}")],
        "task_id long, task_name string, task_param string",
    )
    p = load_task(spark, tasks, 1)
    assert p.start_date == "2024-01-01" and p.keywords == ["a", "b"] and p.num_days() == 3
    assert load_task(spark, tasks, 2) == TaskParams(task_id=2)
    with pytest.raises(KeyError):
        load_task(spark, tasks, 9)


def test_dimension_readers(spark):
    prods = spark.createDataFrame([(1, "a", '{"product_status": 1}'), (2, "b", "{}")],
                                  "product_id long, product_name string, extend_info string")
    got = sorted(tuple(r) for r in read_products(spark, prods).collect())
    assert got == [(1, "a", "1"), (2, "b", None)]
    bl = spark.createDataFrame([(1,), (1,), (2,)], "user_id long")
    assert sorted(r.user_id for r in read_blacklist(spark, bl).collect()) == [1, 2]
    counts = spark.createDataFrame([("d", 1, 2, 5)], "date string, user_id long, ad_id long, click_count long")
    keys = spark.createDataFrame([("d", 1, 2), ("d", 1, 3)], "date string, user_id long, ad_id long")
    assert sorted(tuple(r) for r in ad_click_lookup(counts, keys).collect()) == [("d", 1, 2, 5), ("d", 1, 3, 0)]


def test_column_helpers(spark):
    df = spark.createDataFrame(
        [("2024-01-02 3:05:06", "2024-01-02 13:05:07", ",a,b,", "7", "1,x, 3,,", "k1=v1|k2=v2")],
        "a string, b string, lst string, one string, ids string, rec string",
    )
    r = df.select(
        C.parse_time("a").alias("ta"),
        C.parse_time("b").alias("tb"),
        C.parse_time(F.lit("bad")).alias("bad"),
        C.date_hour(C.parse_time("a")).alias("dh"),
        C.format_date_key(C.parse_time("a")).alias("dk"),
        C.format_time_minute(C.parse_time("b")).alias("tm"),
        C.minus_seconds(C.parse_time("b"), C.parse_time("a")).alias("diff"),
        C.minus_seconds(C.parse_time("a"), C.parse_time("b")).alias("neg"),
        C.minus_seconds(C.parse_time(F.lit("bad")), C.parse_time("a")).alias("zero"),
        C.before(C.parse_time("a"), C.parse_time("b")).alias("before"),
        C.after(C.parse_time("a"), C.parse_time("b")).alias("after"),
        C.before(C.parse_time(F.lit("bad")), C.parse_time("b")).alias("before_bad"),
        C.trim_comma("lst").alias("trimmed"),
        C.fulfill("one").alias("f1"),
        C.fulfill(F.lit("12")).alias("f2"),
        C.fulfill(F.lit("123")).alias("f3"),
        C.split_ids("ids").alias("ids"),
        C.is_empty(F.lit("")).alias("e1"),
        C.is_not_empty(F.lit(None).cast("string")).alias("e2"),
        C.get_field("rec", "k2").alias("g"),
        C.set_field("rec", "k1", "z").alias("s"),
        C.parse_date_key(F.lit("20240102")).alias("pdk"),
    ).first()
    assert r.ta == dt.datetime(2024, 1, 2, 3, 5, 6) and r.tb == dt.datetime(2024, 1, 2, 13, 5, 7)
    assert r.bad is None
    assert (r.dh, r.dk, r.tm) == ("2024-01-02_03", "20240102", "202401021305")
    assert (r.diff, r.neg, r.zero) == (36001, -36001, 0)
    assert (r.before, r.after, r.before_bad) == (True, False, False)
    assert r.trimmed == "a,b"
    assert (r.f1, r.f2, r.f3) == ("07", "12", "0123")
    assert r.ids == [1, 3]
    assert (r.e1, r.e2) == (True, False)
    assert (r.g, r.s) == ("v2", "k1=z|k2=v2")
    assert r.pdk == dt.datetime(2024, 1, 2)


def test_sql_views(spark):
    from clicklens.sources.fixtures import register_views

    names = register_views(spark, "/root/testdata/sf0.001")
    assert "user_visit_action" in names
    n = spark.sql("SELECT count(DISTINCT session_id) AS n FROM user_visit_action WHERE session_date BETWEEN "
                  "'2024-01-01' AND '2024-01-30'").first().n
    assert n > 0


def test_checkpoint_dir_must_be_shared_on_a_cluster():
    from clicklens.spark import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

        def setCheckpointDir(self, path):
            raise AssertionError("must not pick a local folder")

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_jdbc_source_reads_by_ranges(spark, monkeypatch):
    """No database runs here: what reaches Spark's reader."""
    from pyspark.sql import DataFrameReader

    from clicklens.sources import tables

    seen = {}
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **more: seen.update(url=url, table=table, **more) or spark.range(1))
    tables.load(spark, tables.JdbcTable("jdbc:x", "task", {"user": "u"}, "task_id", 1, 100, 4))
    assert seen == {"url": "jdbc:x", "table": "task", "column": "task_id", "lowerBound": 1, "upperBound": 100, "numPartitions": 4,
                    "properties": {"user": "u"}}
