"""Folders whose state is a numbered manifest: what no manifest names isn't there."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Manifests:
    """Versions of a folder. Data are written to folders of their own first, then a manifest that names them, whose number can be
    taken once only."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        if not self._fs.exists(self._at("manifests")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at("manifests"))]
        return sorted(int(n[2:-5]) for n in names if n.startswith("v=") and n.endswith(".json"))

    def version(self) -> int:
        return max(self.versions(), default=-1)

    def _nothing(self) -> dict:
        return {"version": -1, "schema": None}

    def manifest(self, version: int | None = None) -> dict:
        v = self.version() if version is None else version
        if v < 0:
            return self._nothing()
        stream = self._fs.open(self._at(f"manifests/v={v}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _commit(self, body: dict) -> int:
        n = body["version"]
        mine = uuid.uuid4().hex
        to, hidden = self._at(f"manifests/v={n}.json"), self._at(f"manifests/.{mine}")
        out = self._fs.create(hidden, False)
        out.write(bytearray(json.dumps({**body, "writer": mine}).encode()))
        out.close()
        if self._fs.exists(to) or not self._fs.rename(hidden, to) or self.manifest(n)["writer"] != mine:
            raise OSError(f"version {n} of {self.path} is another writer's")
        return n

    def _folders(self, m: dict) -> set[str]:
        """The data folders that a manifest names."""
        raise NotImplementedError

    def vacuum(self, keep: int = 2) -> None:
        """Remove the manifests of all but the newest versions, and the folders that none of these names. Not while others write:
        a folder whose manifest isn't there yet goes too."""
        live = self.versions()[-keep:]
        used = {f for n in live for f in self._folders(self.manifest(n))}
        for n in self.versions():
            if n not in live:
                self._fs.delete(self._at(f"manifests/v={n}.json"), False)
        for s in self._fs.listStatus(self._at("data")) if self._fs.exists(self._at("data")) else []:
            if s.getPath().getName() not in used:
                self._fs.delete(s.getPath(), True)


class LoadedTable(Manifests):
    """A table that grows by incremental loads; each load's rows and its source's watermark are one manifest.

    So a load that breaks off anywhere has neither written rows nor moved the mark, and is done again whole."""

    def _nothing(self) -> dict:
        return {"version": -1, "schema": None, "loads": [], "marks": {}}

    def _folders(self, m: dict) -> set[str]:
        return {f["at"] for f in m["loads"]}

    def watermark(self, source: str) -> str | None:
        """The source's newest time so far, as text."""
        return self.manifest()["marks"].get(source)

    def newer(self, rows: DataFrame, source: str, ts_col: str) -> DataFrame:
        """The source's rows after its watermark, all at first: a constant in the plan, by which a scan skips files and row groups."""
        mark = self.watermark(source)
        return rows if mark is None else rows.where(F.col(ts_col) > F.lit(mark).cast(rows.schema[ts_col].dataType))

    def load(self, rows: DataFrame, source: str, ts_col: str) -> int:
        """Append the source's rows after its watermark and move that to their newest; how many they were. Rows of null times
        come with the first load only, as they are after no watermark."""
        m, at, seen = self.manifest(), uuid.uuid4().hex, Observation()
        new = self.newer(rows, source, ts_col)
        if m["schema"] is None:
            m["schema"] = rows.schema.jsonValue()
        names = StructType.fromJson(m["schema"]).names
        new = new.select(*names).observe(seen, F.count(F.lit(1)).alias("n"), F.max(ts_col).cast("string").alias("mark"))
        new.write.parquet(f"{self.path}/data/{at}")
        n, mark = seen.get["n"], seen.get["mark"]
        if n:
            self._commit({**m, "version": m["version"] + 1, "loads": [*m["loads"], {"at": at, "source": source, "rows": n}], "marks": {**m["marks"], **({source: mark} if mark else {})}})
        return n

    def read(self, version: int | None = None) -> DataFrame:
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError(f"{self.path} has no version yet")
        return self.spark.read.schema(StructType.fromJson(m["schema"])).parquet(*[f"{self.path}/data/{f['at']}" for f in m["loads"]])
