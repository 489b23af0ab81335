"""The control log: one watermark per job, moved forward by compare-and-set, safe for several writers.

A job's log is a folder of numbered version files, each one JSON line. To move the watermark a writer creates the
version after the one it has read. The content is written aside first and then given its name in one step that fails
if the name is taken, so of two writers that read the same version one is refused, and no reader sees half a file.
Local files are named by a hard link; elsewhere a rename is used that does not replace files, as on HDFS. An object
store without such a rename needs a committer that has one.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import uuid
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.operators.incremental import FIRST_WATERMARK
from loadcast.schemas import WATERMARK

VERSION = re.compile(r"v(\d{10})\.json$")


class Conflict(RuntimeError):
    """The watermark has moved since it was read, or would not move forward."""


@dataclass(frozen=True)
class Watermark:
    job: str
    day: dt.date
    version: int


class ControlLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, job: str, first: dt.date = FIRST_WATERMARK) -> Watermark:
        """The job's latest watermark; `first` for one that has never run."""
        version = max(self._versions(job), default=0)
        if not version:
            return Watermark(job, first, 0)
        stored = self.spark.read.schema(WATERMARK).json(self._file(job, version)).first()
        return Watermark(job, stored.last_processed, version)

    def advance(self, seen: Watermark, day: dt.date, now: dt.datetime) -> Watermark:
        """The watermark after `seen`, or `Conflict` if the job has another by now."""
        if seen.version and day <= seen.day:
            raise Conflict(f"watermark not advanced: {seen.job}")
        entry = {"job_name": seen.job, "last_processed": day.isoformat(), "updated_at": now.isoformat()}
        if not self._create(seen.job, seen.version + 1, json.dumps(entry) + "\n"):
            raise Conflict(f"watermark moved by another writer: {seen.job}")
        return Watermark(seen.job, day, seen.version + 1)

    def table(self) -> DataFrame:
        """`(job_name, last_processed, updated_at)` of every job."""
        entries = self.spark.read.schema(WATERMARK).option("recursiveFileLookup", "true").json(self.path)
        latest = entries.groupBy("job_name").agg(F.max(F.struct("last_processed", "updated_at")).alias("latest"))
        return latest.select("job_name", "latest.*")

    def _folder(self, job: str) -> str:
        return f"{self.path}/{quote(job, safe='')}"

    def _file(self, job: str, version: int) -> str:
        return f"{self._folder(job)}/v{version:010d}.json"

    def _local(self) -> bool:
        return re.match(r"[a-z][a-z0-9+.-]*:", self.path) is None or self.path.startswith("file:")

    def _hadoop(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _versions(self, job: str) -> list[int]:
        store, folder = self._hadoop(self._folder(job))
        names = [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []
        return [int(m[1]) for m in map(VERSION.search, names) if m]

    def _create(self, job: str, version: int, text: str) -> bool:
        """Whether the version file is new; an existing one stays as it is."""
        name = f".{uuid.uuid4().hex}"
        if self._local():
            folder = Path(self._folder(job).removeprefix("file://").removeprefix("file:"))
            folder.mkdir(parents=True, exist_ok=True)
            (folder / name).write_text(text, encoding="utf-8")
            try:
                os.link(folder / name, folder / Path(self._file(job, version)).name)
                return True
            except FileExistsError:
                return False
            finally:
                (folder / name).unlink()
        store, aside = self._hadoop(f"{self._folder(job)}/{name}")
        sink = store.create(aside)
        sink.write(bytearray(text.encode()))
        sink.close()
        created = store.rename(aside, self._hadoop(self._file(job, version))[1])
        if not created:
            store.delete(aside, False)
        return created
