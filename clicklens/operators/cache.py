"""Frames that several branches of one plan must share.

A shared frame is written once, as Parquet, to a folder of its own under the
shared checkpoint folder and read back: every branch sees the same rows, whatever
other jobs of the driver do, and a lost executor costs no recomputation. Tables shared
inside a :func:`scope` are removed at its end (the jobs do so once their results are
written); others stay until the checkpoint folder is cleared, like Spark's own
checkpoints. They are grouped by application id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from clicklens.sinks.files import Folder
from clicklens.spark import ensure_checkpoint_dir

_shared: ContextVar[list[str] | None] = ContextVar("shared", default=None)


def folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/shared/{spark.sparkContext.applicationId}"


def share(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    name = uuid.uuid4().hex
    path = f"{folder(spark)}/{name}"
    if (held := _shared.get()) is not None:
        held.append(name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove what is shared inside when the block ends, however it ends."""
    token = _shared.set([])
    try:
        yield
    finally:
        names = _shared.get()
        _shared.reset(token)
        for name in names:
            Folder(spark, folder(spark)).delete(name)
