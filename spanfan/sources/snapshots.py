"""Snapshots from a stored base: a change log by version, and compacted states of it.

Layout under ``root``::

    log/_commit_version=N/part-*.parquet      one folder a commit (late files of a commit land in it too)
    base/version=N/part-*.parquet             the whole state as of N

``as_of`` takes the newest base at or below the wanted version and replays the commits after it
only: these folders are named to the reader, so older ones are neither listed nor read.
``compact`` writes a base when the last one is ``every`` commits old. A base counts once Spark has put its ``_SUCCESS`` file; it is never
changed. A commit that arrives for a version at or below a base would be missed, so ``append`` removes the bases it outdates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RANGE
from .changes import ADDING, CHANGE_TYPE, META, REMOVING, VERSION


class SnapshotLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log_path, self.base_path = f"{self.root}/log", f"{self.root}/base"

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _numbers(self, pattern: str) -> list[int]:
        fs, p = self._fs(pattern)
        return sorted(int(s.getPath().toString().split("=")[-1].split("/")[0]) for s in fs.globStatus(p) or [])

    def versions(self) -> list[int]:
        return self._numbers(f"{self.log_path}/{VERSION}=*")

    def bases(self) -> list[int]:
        return self._numbers(f"{self.base_path}/version=*/_SUCCESS")

    def append(self, commit: DataFrame) -> None:
        """Add a commit (rows with the log columns); bases that it outdates are removed first."""
        first = commit.agg(F.min(VERSION)).first()[0]
        if first is None:
            return
        for n in self.bases():
            if n >= first:
                fs, p = self._fs(f"{self.base_path}/version={n}")
                fs.delete(p, True)
        commit.write.mode("append").partitionBy(VERSION).parquet(self.log_path)

    def log(self) -> DataFrame:
        """All commits, with the version as the folder says."""
        rows = self.spark.read.parquet(self.log_path)
        data = [c for c in rows.columns if c not in META]
        return rows.withColumn(VERSION, F.col(VERSION).cast("bigint")).select(*data, *META)

    def as_of(self, version: int, keys: DataFrame | None = None, key: str = RANGE.key) -> DataFrame:
        """The table as of ``version`` (its rows for ``keys`` only, if given)."""
        base = max((n for n in self.bases() if n <= version), default=None)
        after = [n for n in self.versions() if n <= version and (base is None or n > base)]
        if base is None and not after:
            raise ValueError(f"the log has no commit up to version {version}")
        read = self.spark.read
        state = read.parquet(f"{self.base_path}/version={base}") if base is not None else None
        if not after:
            return state if keys is None else state.join(keys.select(key).distinct(), key, "left_semi").select(*state.columns)
        tail = read.option("basePath", self.log_path).parquet(*[f"{self.log_path}/{VERSION}={n}" for n in after])
        data = [c for c in tail.columns if c not in META]
        state = None if state is None else state.select(*data)
        if keys is not None:
            wanted = keys.select(key).distinct()
            tail = tail.join(wanted, key, "left_semi")
            state = None if state is None else state.join(wanted, key, "left_semi").select(*data)
        plus = tail.filter(F.col(CHANGE_TYPE).isin(*ADDING)).select(*data)
        minus = tail.filter(F.col(CHANGE_TYPE).isin(*REMOVING)).select(*data)
        return (plus if state is None else state.unionByName(plus)).exceptAll(minus)

    def compact(self, every: int = 10) -> int | None:
        """Write the newest state as a base if the newest base is at least ``every`` commits behind (or there
        is none and the log has as many). Returns its version."""
        versions, bases = self.versions(), self.bases()
        behind = [v for v in versions if not bases or v > bases[-1]]
        if len(behind) < every:
            return None
        self.as_of(versions[-1]).write.mode("overwrite").parquet(f"{self.base_path}/version={versions[-1]}")
        return versions[-1]
