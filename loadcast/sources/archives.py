"""ZIP archives read by byte ranges, so that one archive feeds many tasks.

The central directory at an archive's end names every member and where it begins. An archive is cut into ranges of
`RANGE_BYTES`, and a task seeks to and opens the members that begin in its range. Nothing but names and lengths is
listed beforehand, and no archive is held whole. `read_zip_members` is a batch data source of its own; `zip_members`
does the same for listed archives, streamed ones included. Both return `(archive, member, content, error)`: a broken
archive is one row with an error, and so is a member that cannot be read.

Archives are opened through `pyarrow.fs`, which knows local files, HDFS and the common object stores. For a store that
only Spark's readers can open, `files.explode_zip` takes whole contents.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loadcast.functions.dates import date_from_filename

MEMBERS = "archive string, member string, content binary, error string"
RANGE_BYTES = 64 << 20
# Contents that are handed on together; a longer member goes alone.
FLUSH_BYTES = 32 << 20


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in that file system."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:")
    store, base = fs.FileSystem.from_uri(f"{parts.scheme}://{parts.netloc}")
    return store, f"{base.rstrip('/')}/{path.split(parts.netloc, 1)[1].lstrip('/')}"


def _members(path: str, start: int, end: int, suffix: str) -> Iterator[tuple[str | None, bytes | None, str | None]]:
    store, name = locate(path)
    try:
        with store.open_input_file(name) as source, zipfile.ZipFile(source) as archive:
            for member in archive.infolist():
                if not start <= member.header_offset < end or member.is_dir() or not member.filename.endswith(suffix):
                    continue
                try:
                    yield member.filename, archive.read(member), None
                except Exception as broken:
                    yield member.filename, None, f"unreadable member: {type(broken).__name__}"
    except (zipfile.BadZipFile, pa.ArrowInvalid):
        # A file too short to seek in is the second kind.
        if start == 0:
            yield None, None, "not a ZIP archive"


def member_names(archives: DataFrame, suffix: str = ".csv") -> DataFrame:
    """`(archive, member, dt, error)` of listed archives: the central directory alone, no content is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = locate(path)
                try:
                    with store.open_input_file(name) as source, zipfile.ZipFile(source) as archive:
                        rows = [
                            (path, m.filename, None, None)
                            for m in archive.infolist() if not m.is_dir() and m.filename.endswith(suffix)
                        ]
                except (zipfile.BadZipFile, pa.ArrowInvalid):
                    rows = [(path, None, None, "not a ZIP archive")]
                if rows:
                    yield _batch(rows)

    return _dated(archives.select("path").mapInArrow(run, MEMBERS)).drop("content")


def read_members(named: DataFrame) -> DataFrame:
    """Contents of named members, `(archive, member, dt)`; a task opens an archive once for all it reads from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, source, archive = None, None, None
        for batch in batches:
            rows, held = [], 0
            for name, member in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != path:
                    if source is not None:
                        source.close()
                    store, where = locate(name)
                    source = store.open_input_file(where)
                    path, archive = name, zipfile.ZipFile(source)
                try:
                    rows.append((name, member, archive.read(member), None))
                    held += len(rows[-1][2])
                except Exception as broken:
                    rows.append((name, member, None, f"unreadable member: {type(broken).__name__}"))
                if held > FLUSH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)
        if source is not None:
            source.close()

    # Members of one archive go to as many tasks as there are, each task's in the order of archives.
    dealt = named.select("archive", "member").repartition("archive", "member").sortWithinPartitions("archive")
    return _dated(dealt.mapInArrow(run, MEMBERS))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.binary(), pa.string())
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["archive", "member", "content", "error"])


def range_batches(path: str, start: int, end: int, suffix: str) -> Iterator[pa.RecordBatch]:
    """The members that begin in a range of an archive, in batches of bounded size."""
    rows: list[tuple] = []
    held = 0
    for name, content, error in _members(path, start, end, suffix):
        rows.append((path, name, content, error))
        held += len(content or b"")
        if held > FLUSH_BYTES:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.size = int(options.get("rangeBytes", RANGE_BYTES))
        self.suffix = options.get("suffix", "")

    def partitions(self) -> list[Range]:
        store, base = locate(self.path)
        prefix = self.path[: len(self.path) - len(base)]
        found = store.get_file_info(fs.FileSelector(base, recursive=True))
        return [
            Range(f"{prefix}{info.path}", start, start + self.size)
            for info in sorted(found, key=lambda info: info.path)
            if info.is_file and info.path.endswith(".zip")
            for start in range(0, max(info.size, 1), self.size)
        ]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from range_batches(partition.path, partition.start, partition.end, self.suffix)


class ZipMembers(DataSource):
    """`spark.read.format("zip_members")`: the members of every `.zip` below a folder, a partition for each range."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema: object) -> ZipReader:
        return ZipReader(self.options)


def _dated(members: DataFrame) -> DataFrame:
    name = F.element_at(F.split("member", "/"), -1)
    return members.select("archive", "member", date_from_filename(name).alias("dt"), "content", "error")


def read_zip_members(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, suffix: str = ".csv"
) -> DataFrame:
    """One row per member below a folder, with the day of its name."""
    spark.dataSource.register(ZipMembers)
    reader = spark.read.format("zip_members").option("rangeBytes", range_bytes).option("suffix", suffix)
    return _dated(reader.load(path))


def zip_members(archives: DataFrame, range_bytes: int = RANGE_BYTES, suffix: str = ".csv") -> DataFrame:
    """The same for `(path, length)` rows; ranges are dealt to tasks before anything is opened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from range_batches(path, start, start + range_bytes, suffix)

    last = F.greatest(F.col("length") - 1, F.lit(0))
    ranges = archives.select("path", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(range_bytes))).alias("start"))
    return _dated(ranges.repartition("path", "start").mapInArrow(run, MEMBERS))
