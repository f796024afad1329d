"""Versioned snapshots of a table with atomic commits.

Layout under a table's folder::

    versions/<date_col>=<day>/version=<id>/   data, written once and never changed
    commits/<number>.json                     which version of which day is the published one

A write goes to a version folder of its own, which nobody reads.  The commit is one file, written beside and moved to its place by one rename,
that names the published version of every day; the commit of highest number is the table.  So a reader sees the state before or after a
commit, never part of one: a run that fails while writing, or between writing and commit, leaves the table as it was.  Publishing a day
again replaces its version and leaves the other days alone.  Two writers who commit at once get the same number, and the second raises.

What the last ``KEEP`` commits name stays on disk, so a reader who has resolved the commit before can finish; older versions are
removed after a commit, folders of failed writes once they are ``ORPHAN_HOURS`` old.
"""
from __future__ import annotations

import datetime as _dt
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEEP = 2
ORPHAN_HOURS = 24


class CommitConflict(RuntimeError):
    """Another writer committed first."""


class Store:
    def __init__(self, spark: SparkSession, base: str, date_col: str = "processing_date"):
        self.spark, self.base, self.date_col = spark, base.rstrip("/"), date_col
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ reading

    def manifest(self) -> dict:
        """The last commit: its number (-1: none) and the published version of every day."""
        numbers = self._commits()
        return self._read(numbers[-1]) if numbers else {"number": -1, "days": {}}

    def days(self) -> list[_dt.date]:
        return sorted(_dt.date.fromisoformat(d) for d in self.manifest()["days"])

    def last_day(self) -> _dt.date | None:
        return max(self.days(), default=None)

    def read(self, day: _dt.date) -> DataFrame:
        """One day's snapshot, with its date column."""
        version = self.manifest()["days"][day.isoformat()]
        return self.spark.read.parquet(self._version(day, version)).withColumn(self.date_col, F.lit(day))

    def current(self) -> DataFrame:
        """The snapshot of the latest day."""
        return self.read(self._needed(self.last_day()))

    def as_of(self, day: _dt.date) -> DataFrame | None:
        """The latest snapshot up to ``day``, None if there is none."""
        upto = [d for d in self.days() if d <= day]
        return self.read(upto[-1]) if upto else None

    def before(self, day: _dt.date) -> DataFrame | None:
        return self.as_of(day - _dt.timedelta(days=1))

    def history(self) -> DataFrame:
        """All days' snapshots, with their date column (a partition column: filters on it choose folders)."""
        days = self.manifest()["days"]
        self._needed(days or None)
        paths = [self._version(_dt.date.fromisoformat(d), v) for d, v in sorted(days.items())]
        return self.spark.read.option("basePath", f"{self.base}/versions").parquet(*paths).drop("version")

    # ------------------------------------------------------------ writing

    def stage(self, df: DataFrame, day: _dt.date) -> str:
        """Write a version of a day, which no reader sees yet; returns its id."""
        version = uuid.uuid4().hex
        df.drop(self.date_col).write.mode("errorifexists").parquet(self._version(day, version))
        return version

    def commit(self, day: _dt.date, version: str) -> int:
        """Make a staged version the published one of its day."""
        last = self.manifest()
        number = last["number"] + 1
        text = json.dumps({"number": number, "days": {**last["days"], day.isoformat(): version}})
        beside, place = self._path(f"commits/.{version}.tmp"), self._path(f"commits/{number:010d}.json")
        out = self._fs.create(beside, False)
        out.writeBytes(text)
        out.close()
        if self._fs.exists(place) or not self._fs.rename(beside, place):
            self._fs.delete(beside, False)
            raise CommitConflict(f"{self.base}: commit {number} exists")
        return number

    def publish(self, df: DataFrame, day: _dt.date) -> int:
        number = self.commit(day, self.stage(df, day))
        self.prune()
        return number

    def prune(self, keep: int = KEEP) -> None:
        """Remove what only commits before the last ``keep`` name, and old folders that no commit names."""
        numbers = self._commits()
        commits = [self._read(n) for n in numbers]
        wanted = {(d, v) for c in commits[-keep:] for d, v in c["days"].items()}
        for number, c in list(zip(numbers, commits))[:-keep]:
            for d, v in set(c["days"].items()) - wanted:
                self._fs.delete(self._path(f"versions/{self.date_col}={d}/version={v}"), True)
            self._fs.delete(self._path(f"commits/{number:010d}.json"), False)
        limit = (time.time() - ORPHAN_HOURS * 3600) * 1000
        for day in self._list("versions"):
            for version in self._fs.listStatus(day.getPath()):
                name = version.getPath().getName().removeprefix("version="), day.getPath().getName().split("=", 1)[-1]
                if name[::-1] not in wanted and version.getModificationTime() < limit:
                    self._fs.delete(version.getPath(), True)

    # ------------------------------------------------------------ files

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def _version(self, day: _dt.date, version: str) -> str:
        return f"{self.base}/versions/{self.date_col}={day.isoformat()}/version={version}"

    def _list(self, name: str):
        path = self._path(name)
        return self._fs.listStatus(path) if self._fs.exists(path) else []

    def _commits(self) -> list[int]:
        names = [s.getPath().getName() for s in self._list("commits")]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def _read(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"commits/{number:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _needed(self, found):
        if found is None:
            raise FileNotFoundError(f"nothing is published at {self.base}")
        return found
