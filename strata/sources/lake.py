"""Layered Parquet lake (SNK-01..07, DQ-06).

``Lake(root)`` routes ``bronze``/``silver``/``gold`` tables to folders. A table
is published as an immutable version folder plus a commit record, so a job can
rebuild a table from itself (read old version, write new one) without ever
overwriting the path it reads (safe replace, SNK-03). Commit records are only
added, never replaced: the current version is that of the highest record, and
at every moment of a publication either the old or the new one is current."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..functions.core import rows_counted

LAYERS = ("bronze", "silver", "gold")


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        """SNK-05: layer routing."""
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.root}/{layer}/{name}"

    def _commits_path(self, layer: str, name: str) -> str:
        return self.path(layer, name) + "/commits"

    def _path_exists(self, path: str) -> bool | None:
        """Existence through the Hadoop FileSystem of the path (no failing read,
        so no error is logged); ``None`` when the JVM gateway is unavailable."""
        try:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            return bool(p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
        except Exception:  # noqa: BLE001 - e.g. Spark Connect: fall back to reading
            return None

    def commits(self, layer: str, name: str) -> list[dict]:
        """Commit records, oldest first (a few short files). Only a folder that is not
        there means a table without commits; any other failure is raised."""
        path = self._commits_path(layer, name)
        if self._path_exists(path) is False:
            return []
        try:
            rows = self.spark.read.schema("value string").option("recursiveFileLookup", "true").text(path).collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted((json.loads(r[0]) for r in rows), key=lambda x: x["seq"])

    def current_version(self, layer: str, name: str) -> str | None:
        done = self.commits(layer, name)
        return done[-1]["version"] if done else None

    def _commit(self, layer: str, name: str, version: str) -> None:
        done = self.commits(layer, name)
        seq = done[-1]["seq"] + 1 if done else 0
        record = json.dumps({"seq": seq, "version": version})
        # mode "error": of two writers that publish at once one fails instead of being lost
        self.spark.createDataFrame([(record,)], "v string").coalesce(1).write.mode("error").text(
            f"{self._commits_path(layer, name)}/c={seq:012d}")

    def vacuum(self, layer: str, name: str, keep: int = 2) -> list[str]:
        """Remove the version folders of all but the last ``keep`` commits; returns what was removed."""
        done = self.commits(layer, name)
        kept = {x["version"] for x in done[-keep:]}
        jvm = self.spark.sparkContext._jvm
        gone = []
        for v in dict.fromkeys(x["version"] for x in done[:-keep]):
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path(layer, name)}/{v}")
            fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            if v not in kept and fs.exists(p):
                fs.delete(p, True)
                gone.append(v)
        return gone

    def exists(self, layer: str, name: str) -> bool:
        return self.current_version(layer, name) is not None

    def read(self, layer: str, name: str) -> DataFrame:
        v = self.current_version(layer, name)
        if v is None:
            raise FileNotFoundError(self.path(layer, name))
        return self.spark.read.parquet(f"{self.path(layer, name)}/{v}")

    def save(self, df: DataFrame, layer: str, name: str, compression: str = "snappy",
             partition_by: list[str] | None = None, max_records_per_file: int | None = None,
             skip_empty: bool = True, audit: bool = False) -> dict:
        """SNK-01/02/03/04/07: write a new version folder, then add its commit record.

        The input is computed once (by the write). An empty result does not
        replace the current table (``skip_empty``): emptiness is checked on the
        written files, so the upstream plan is never run twice; the unused
        version folder stays unreferenced. ``audit`` gives the rows that Spark
        counted while it wrote them (DQ-06)."""
        saved = Observation(f"saved_{name}") if audit else None
        if saved:
            df = df.observe(saved, F.count(F.lit(1)).alias("n"))
        version = f"v={int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
        out = f"{self.path(layer, name)}/{version}"
        w = df.write.mode("error").option("compression", compression)
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", max_records_per_file)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(out)
        if skip_empty and self.spark.read.parquet(out).isEmpty():
            return {"table": name, "written": False, "reason": "empty"}
        self._commit(layer, name, version)
        res = {"table": name, "written": True, "version": version, "path": out}
        if audit:
            res["rows"] = rows_counted(saved)
        return res


def write_report(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> list[str]:
    """SNK-06: a named multi-table report, one directory per table (Parquet or
    CSV with header) instead of one workbook with sheets."""
    paths = []
    for name, df in tables.items():
        p = f"{folder.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(p)
        else:
            w.parquet(p)
        paths.append(p)
    return paths


def audited_write(before: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, table: str) -> DataFrame:
    """DQ-02 / DQ-06: write ``transform(before)`` and return (tabla, filas_leidas, filas_eliminadas, filas_guardadas).
    One job reads, writes and counts: both counts are metrics that Spark observes while the rows pass."""
    read, saved = Observation(f"read_{table}"), Observation(f"saved_{table}")
    n = F.count(F.lit(1)).alias("n")
    transform(before.observe(read, n)).observe(saved, n).write.mode("overwrite").parquet(path)
    r, s = rows_counted(read), rows_counted(saved)
    return before.sparkSession.createDataFrame([(table, r, r - s, s)], "tabla string, filas_leidas long, filas_eliminadas long, filas_guardadas long")
