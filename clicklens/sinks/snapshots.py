"""Tables published by manifests.

Data go to folders that are written once and never change. A manifest, a small
numbered JSON file, names the folders that make up the table; the one with the
highest number counts. It appears by a rename, in one step, so a reader sees the old
state or the new one, whole, and a writer that fails leaves the old one. Two writers
that want the same number cannot both have it. What no manifest of a while names is
removed by ``vacuum`` only, so slow readers keep their files.

* :class:`ResultStore` holds the results of tasks: all results of a job's run switch
  together, and a rerun replaces its own task's only.
* :class:`MergeTable` is a keyed table whose batches append their changed keys. Rows
  of one key are merged when the table is read. Full levels of segments are merged
  into one of the next level, so a row is rewritten a logarithmic number of times and
  what a batch writes does not follow the table's size.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.operators.joins import by_shuffle
from clicklens.sinks.files import Folder


class Manifest:
    """The numbered states of one table."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.folder.names() if n.endswith(".json") and n[0] != "_"]

    def latest(self) -> tuple[int, dict]:
        """Number and content of the newest state; ``(-1, {})`` before the first."""
        known = self.numbers()
        return (known[-1], self.read(known[-1])) if known else (-1, {})

    def read(self, number: int) -> dict:
        return json.loads(self.folder.read(f"{number:012d}.json"))

    def publish(self, number: int, content: dict) -> None:
        if not self.folder.write_new(f"{number:012d}.json", json.dumps(content)):
            raise RuntimeError(f"state {number} of {self.folder.path} was published by another writer")

    def forget(self, before: int) -> None:
        """Remove older states than ``before``."""
        for n in self.numbers():
            if n < before:
                self.folder.delete(f"{n:012d}.json")


class ResultStore:
    """Results of tasks under one root: ``data/<result>/<token>`` and
    ``manifests/<job>/task_id=<id>/<number>.json``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = Folder(spark, self.root)

    def _manifest(self, job: str, task_id: int) -> Manifest:
        return Manifest(self.spark, f"{self.root}/manifests/{job}/task_id={int(task_id)}")

    def publish(self, job: str, task_id: int, results: dict[str, DataFrame]) -> None:
        """Write all results of a run, then switch the task to them."""
        token, content = uuid.uuid4().hex, {}
        for name, df in results.items():
            df.write.parquet(f"{self.root}/data/{name}/{token}")
            content[name] = {"folder": f"data/{name}/{token}", "schema": df.schema.jsonValue()}
        manifest = self._manifest(job, task_id)
        manifest.publish(manifest.latest()[0] + 1, content)

    def truncate(self, job: str) -> None:
        """Empty the results of every task of a job."""
        for task_id in self.tasks(job):
            manifest = self._manifest(job, task_id)
            manifest.publish(manifest.latest()[0] + 1, {})

    def tasks(self, job: str) -> list[int]:
        return [int(n.split("=")[1]) for n in self.folder.names(f"manifests/{job}")]

    def read(self, job: str, name: str, task_id: int | None = None) -> DataFrame:
        """A result of one task, or of all tasks of the job."""
        found = [self._manifest(job, t).latest()[1].get(name) for t in ([task_id] if task_id is not None else self.tasks(job))]
        found = [x for x in found if x]
        if not found:
            raise KeyError(f"no {name} of job {job} in {self.root}")
        schema = T.StructType.fromJson(found[-1]["schema"])
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{x['folder']}" for x in found))

    def vacuum(self, older_than_seconds: float) -> int:
        """Remove data folders of that age that no task's present state names, and
        past states; the number of folders removed."""
        named, gone = set(), 0
        for job in self.folder.names("manifests"):
            for task_id in self.tasks(job):
                manifest = self._manifest(job, task_id)
                number, content = manifest.latest()
                named |= {x["folder"] for x in content.values()}
                manifest.forget(number)
        for name in self.folder.names("data"):
            for token in self.folder.names(f"data/{name}"):
                path = f"data/{name}/{token}"
                if path not in named and self.folder.age(path) >= older_than_seconds:
                    self.folder.delete(path)
                    gone += 1
        return gone


ADD, SET, GROUPS, INSERT = "add", "set", "groups", "insert"


class MergeTable:
    """A keyed table made of segments, merged when read.

    ``rule`` says what rows of one key in several segments mean: ``add`` sums
    ``measure``; ``set`` keeps the newest row of a key; ``groups`` keeps the rows of the
    newest batch that wrote the group (``keys`` are the group's); ``insert`` keeps
    each key once. ``part_col`` partitions the segments, so that readers of some
    partitions list and read no others. A batch id is applied once: a replay of an
    applied batch changes nothing.
    """

    FAN = 8  # segments of a level that are merged into one of the next

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, rule: str, keys: list[str],
                 measure: str | None = None, part_col: str | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.rule, self.keys, self.measure, self.part_col = rule, keys, measure, part_col
        self.columns = [f.name for f in schema.fields]
        self.folder = Folder(spark, self.root)
        self.manifest = Manifest(spark, f"{self.root}/manifest")

    # -- reading -----------------------------------------------------------------
    def last_batch(self) -> int:
        return self.manifest.latest()[1].get("batch", -1)

    def segments(self) -> list[dict]:
        return self.manifest.latest()[1].get("segments", [])

    def _rows(self, segments: list[dict], parts: Iterable | None = None) -> DataFrame:
        """The segments' rows as written, with the batch that wrote them."""
        schema = T.StructType([*self.schema.fields, T.StructField("seq", T.LongType())])
        paths = [f"{self.root}/{s['folder']}" for s in segments]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/segments").parquet(*paths).select(*schema.names)
        return rows if parts is None else rows.where(F.col(self.part_col).isin(list(parts)))

    def merged(self, rows: DataFrame) -> DataFrame:
        """One row per key (per group the newest batch's rows), with ``seq``."""
        if self.rule == ADD:
            return rows.groupBy(*self.keys).agg(F.sum(self.measure).cast("bigint").alias(self.measure), F.max("seq").alias("seq"))
        if self.rule == INSERT:
            return rows.groupBy(*self.keys).agg(F.min("seq").alias("seq"))
        if self.rule == SET:
            rest = [c for c in self.columns if c not in self.keys]
            return rows.groupBy(*self.keys).agg(*(F.max_by(c, "seq").alias(c) for c in rest), F.max("seq").alias("seq"))
        newest = rows.groupBy(*self.keys).agg(F.max("seq").alias("seq"))
        return rows.join(by_shuffle(newest), [*self.keys, "seq"], "left_semi")

    def read(self, parts: Iterable | None = None, before_batch: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The table, of some partitions, or of some keys only (``keys`` reach the
        segments' rows before they are merged), or as it was before a batch: the newest
        one or one to come (merged segments hold no past states), for ``insert`` any."""
        rows = self._rows(self.segments(), parts)
        if before_batch is not None:
            if self.rule != INSERT and before_batch < self.last_batch():
                raise ValueError(f"{self.root} is past batch {before_batch}")
            rows = rows.where(F.col("seq") < before_batch)
        if keys is not None:
            rows = rows.join(by_shuffle(keys.select(*self.keys)), self.keys, "left_semi")
        return self.merged(rows).select(*self.columns)

    # -- writing -----------------------------------------------------------------
    def _write(self, rows: DataFrame, name: str) -> str:
        folder = f"segments/segment={name}-{uuid.uuid4().hex}"
        writer = rows.select(*self.columns, "seq").write
        if self.part_col:
            writer = writer.partitionBy(self.part_col)
        writer.parquet(f"{self.root}/{folder}")
        return folder

    def commit(self, changed: DataFrame, batch_id: int) -> bool:
        """Append a batch's changed rows; False when the batch is applied already.
        Full levels are merged before, so that the newest batch stays apart."""
        if self.last_batch() >= batch_id:
            return False
        self.compact()
        number, content = self.manifest.latest()
        folder = self._write(changed.withColumn("seq", F.lit(batch_id).cast("long")), f"b{batch_id}")
        segments = content.get("segments", []) + [{"folder": folder, "level": 0}]
        self.manifest.publish(number + 1, {"batch": batch_id, "segments": segments})
        return True

    def compact(self) -> None:
        """Merge each full level into one segment of the next level."""
        while True:
            number, content = self.manifest.latest()
            segments = content.get("segments", [])
            level = next((v for v in sorted({s["level"] for s in segments})
                          if sum(s["level"] == v for s in segments) >= self.FAN), None)
            if level is None:
                return
            old = [s for s in segments if s["level"] == level]
            folder = self._write(self.merged(self._rows(old)), f"m{level + 1}")
            kept = [s for s in segments if s["level"] != level]
            self.manifest.publish(number + 1, {**content, "segments": kept + [{"folder": folder, "level": level + 1}]})

    def vacuum(self, older_than_seconds: float) -> int:
        """Remove past states, and segments of that age that the table does not name."""
        number, content = self.manifest.latest()
        self.manifest.forget(number)
        named = {s["folder"] for s in content.get("segments", [])}
        gone = [f"segments/{n}" for n in self.folder.names("segments") if f"segments/{n}" not in named]
        gone = [p for p in gone if self.folder.age(p) >= older_than_seconds]
        for path in gone:
            self.folder.delete(path)
        return len(gone)
