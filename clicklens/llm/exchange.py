"""Spark plumbing shared by the text operators: scratch tables in the shared
checkpoint folder, packed shuffles and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.spark import ensure_checkpoint_dir

BUCKETS_PER_PARTITION = 8
ROWS_PER_BATCH = 512
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write the frame to the shared folder and read it back: lineage is cut
    and a lost executor costs no recomputation of earlier stages. With ``free`` the
    write's shuffle files go when it is done, not when the driver collects its garbage."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(FREE, None)
    if free:
        spark.conf.set(FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.unset(FREE) if before is None else spark.conf.set(FREE, before)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``stored``, bucketed by ``key``: grouping by it needs no shuffle of the stored rows.
    The catalog's entry goes at once, the files stay in the shared folder like ``stored``'s."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    table = f"stored_{uuid.uuid4().hex}"
    df.write.bucketBy(partitions(spark), key).option("path", path).saveAsTable(table, format="parquet")
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets(spark: SparkSession) -> int:
    """Hash buckets of a packed shuffle: several to a partition, so that one
    bucket at a time is held in memory; they grow with the partitions."""
    return BUCKETS_PER_PARTITION * partitions(spark)


def first_by_hash(df: DataFrame, columns: list[str], n: int, distinct: bool = False) -> DataFrame:
    """At most ``n`` rows, the first by hash order of ``columns`` (with ``distinct``
    each row once). A hash bound from the count of all rows (of about all different
    ones) leaves some ``2 n`` for the last task to sort, whatever the input's size."""
    order = F.xxhash64(*columns)
    rows = df.agg(F.approx_count_distinct(order)).first()[0] if distinct else df.count()
    share = (2 * n + 1000) / max(rows, 1)
    kept = df.where(order < F.lit(int(share * 2.0**64) - 2**63)) if share < 0.99 else df
    return (kept.distinct() if distinct else kept).orderBy(order, *columns).limit(n)


_shipped: set[str] = set()


def ready(spark: SparkSession) -> None:
    """Make the Python workers ready: Arrow batches of few rows (long texts
    keep them at a few MB), and this package on every executor's path, as
    ``--py-files`` would put it there."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="clicklens-py-"), "clicklens.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def emit(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows to record batches of bounded length."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


BLOB_SCHEMA = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])


def packed_shuffle(df: DataFrame, to_blobs: Callable, from_bucket: Callable, schema: str) -> DataFrame:
    """``to_blobs(batches)`` yields ``(bucket, blob)`` per input partition;
    the blobs of one bucket meet in one task, bucket after bucket:
    ``from_bucket(list_of_blobs)`` yields record batches of ``schema``."""

    def write(batches):
        yield from emit(to_blobs(batches), BLOB_SCHEMA, 64)

    def read(batches):
        current, held = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != current and held:
                    yield from from_bucket(held)
                    held = []
                current = bucket
                held.append(blob)
        if held:
            yield from from_bucket(held)

    n = partitions(df.sparkSession)
    blobs = df.mapInArrow(write, "bucket int, blob binary")
    return blobs.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(read, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): ``(id, component)``
    for every id on an edge, component its smallest reachable id.

    Each round every id takes the smallest label its neighbours' labels have,
    and hands it to its own label too (hooking), so whole clusters move at
    once; then labels jump to their own label. Rounds grow with the logarithm
    of the longest path; labels only ever fall, so the loop ends without a cap.
    Neighbours are only ever reduced by ``min``, never collected. Each round is
    two tables in the shared folder; the driver reads one number from them:
    whether a label moved.

    Both directions of an edge come from one row of ``edges``, which is computed
    once: computed twice, a spanning forest can have other edges each time (its tasks
    get their rows in another order), and a label without an edge of its own
    would lose its whole component in the joins.
    """
    there, back = F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = stored(edges.where("a <> b").select(F.explode(F.array(there, back)).alias("e")).select("e.a", "e.b").distinct(), "edges")
    now = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("c")).select("id", F.least("id", "c").alias("c"))
    now = stored(now, "labels")
    while True:
        now = stored(now.join(now.select(F.col("id").alias("c"), F.col("c").alias("far")), "c"), "labels")
        near = both.join(now.select(F.col("id").alias("b"), "far"), "b").groupBy(F.col("a").alias("id")).agg(
            F.min("far").alias("n"))
        step = now.join(near, "id").select("id", "c", F.least("c", "far", "n").alias("n"))
        hook = step.groupBy(F.col("c").alias("id")).agg(F.min("n").alias("h"))
        moved = stored(step.join(hook, "id", "left").select("id", F.least("n", "h").alias("to"), "c")
                       .select("id", F.col("to").alias("c"), (F.col("to") < F.col("c")).alias("moved")), "labels")
        now = moved.select("id", "c")
        if not moved.where("moved").limit(1).count():
            return now.select("id", F.col("c").alias("component"))
