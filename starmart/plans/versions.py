"""Versioned Parquet tables with a commit log (I-12, atomic publish).

Plain Parquet has no transactions, so a table is a folder of immutable
versions ``v=00000001/ …`` plus a commit log ``_commits/00000001.json``. A
version becomes visible only when its commit file exists; creating one small
file is atomic on HDFS and object stores. Readers take the highest commit.
A crash after the data is written but before the commit leaves an invisible
version that the next run simply replaces. Nothing is ever overwritten in
place, so a job may read version N while it writes N+1.

The commit can carry a streaming ``batch_id``: a micro-batch whose id is
already committed is skipped, which makes ``foreachBatch`` effectively
exactly-once.

All file access goes through Spark's Hadoop FileSystem, so the same code
works on a local disk, HDFS or an object store.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class _FS:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.jvm = jvm
        self.path = jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def child(self, *names: str):
        p = self.path
        for n in names:
            p = self.jvm.org.apache.hadoop.fs.Path(p, n)
        return p

    def exists(self, p) -> bool:
        return self.fs.exists(p)

    def list_names(self, p) -> list[str]:
        if not self.fs.exists(p):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(p)]

    def read_text(self, p) -> str:
        stream = self.fs.open(p)
        reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        reader.close()
        return "\n".join(lines)

    def create_text(self, p, text: str) -> None:
        """Write a temporary file, then rename it: no reader sees a part of it."""
        part = self.jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
        out = self.fs.create(part, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if self.fs.exists(p) or not self.fs.rename(part, p):
            self.fs.delete(part, False)
            raise FileExistsError(f"{p} is there already: another writer committed this version")


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._fs = _FS(spark, self.path)

    def _commits(self) -> list[int]:
        names = self._fs.list_names(self._fs.child("_commits"))
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _written(self) -> list[int]:
        return [int(n[2:]) for n in self._fs.list_names(self._fs.path) if n.startswith("v=")]

    def current_version(self) -> int | None:
        """The last version whose commit can be read; a broken one is no commit."""
        return next((v for v in reversed(self._commits()) if self._info(v) is not None), None)

    def _info(self, v: int) -> dict | None:
        try:
            return json.loads(self._fs.read_text(self._fs.child("_commits", f"{v:08d}.json")))
        except json.JSONDecodeError:
            return None

    def commit_info(self, version: int | None = None) -> dict | None:
        v = version if version is not None else self.current_version()
        if v is None:
            return None
        return self._info(v)

    def version_path(self, v: int) -> str:
        return f"{self.path}/v={v:08d}"

    def read(self, version: int | None = None) -> DataFrame | None:
        v = version if version is not None else self.current_version()
        if v is None:
            return None
        return self.spark.read.parquet(self.version_path(v))

    def last_batch_id(self, query_id: str | None = None) -> int | None:
        """The batch of the last commit, or of the last one by a stream query."""
        for v in reversed(self._commits()):
            info = self._info(v)
            if info is not None and (query_id is None or info.get("query_id") == query_id):
                return info.get("batch_id")
        return None

    def exists(self, sub: str) -> bool:
        return self._fs.exists(self._fs.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{sub}"))

    def committed(self) -> list[int]:
        return self._commits()

    def write(self, df: DataFrame, batch_id: int | None = None, extra: dict | None = None,
              commit: bool = True, partition_by: list[str] | None = None) -> int:
        """Write ``df`` as the next version; commit unless told not to."""
        v = max([0] + self._commits() + self._written()) + 1
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.version_path(v))
        if commit:
            self.commit(v, batch_id, extra)
        return v

    def commit(self, v: int, batch_id: int | None = None, extra: dict | None = None) -> None:
        info = {"version": v, "batch_id": batch_id}
        info.update(extra or {})
        self._fs.create_text(self._fs.child("_commits", f"{v:08d}.json"), json.dumps(info))
