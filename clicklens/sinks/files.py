"""Small-file access through Spark's own filesystem layer, so that the same code
works on HDFS, object stores and local folders."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder that every node can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._p("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _p(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._p(name))

    def names(self, name: str = "") -> list[str]:
        """Names in the folder, sorted; none if there is no such folder."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._p(name)))

    def age(self, name: str) -> float:
        """Seconds since the last change."""
        return time.time() - self._fs.getFileStatus(self._p(name)).getModificationTime() / 1000

    def set_time(self, name: str, seconds: float) -> None:
        self._fs.setTimes(self._p(name), int(seconds * 1000), -1)

    def delete(self, name: str) -> None:
        self._fs.delete(self._p(name), True)

    def publish(self, source: str, target: str) -> bool:
        """Give ``source`` its final name in one step; False when another writer
        took the name first."""
        self._fs.mkdirs(self._p(target).getParent())
        if self.exists(target):
            return False
        return self._fs.rename(self._p(source), self._p(target))

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self._fs.open(self._p(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._p(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """A file that appears whole or not at all; False when it is there already."""
        draft = f"_draft-{uuid.uuid4().hex}"
        self.write(draft, text)
        if self.publish(draft, name):
            return True
        self.delete(draft)
        return False
