"""Records of Shift-JIS CSV files of any size; a quoted field may hold line ends, also across the border of a split.

Files are read in splits. A split cannot tell whether its first line stands inside a quoted field of the split before,
so each split of a cut file is first run through for both cases: what it ends in if it begins outside, and if it begins
inside, and which lines at its borders then belong to records of several splits. A split thereby keeps, flips or sets
the state, and a running combination in file order gives every split's true beginning, and with it the pieces that are
put together by their order in the file. The second run cuts the other records. Files that are not cut need no first
run.

Quotes count at the beginning of a field and, doubled, inside a quoted one; anywhere else they are plain characters. No
Shift-JIS character holds a quote, comma or line-end byte, so lines are cut before they are decoded. Line ends inside a
field become one line feed. A field that is never closed gives an error row, and so does a record of more than
`RECORD_BYTES`, whose text is not kept.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadcast.session import BROADCAST_ROWS, materialize

ENCODING = "shift_jis"
RECORD_BYTES = 1 << 20
TAIL, THROUGH, OPEN = 0, 1, 2
UNCLOSED, TOO_LONG = "unclosed quote", "record too long"


def ends_inside(line: bytes, inside: bool, skip_space: bool = False) -> bool:
    """Whether a quoted field is open at the end of a line that began inside one, or at a field's beginning."""
    if not inside and b'"' not in line:
        return False
    at = 0
    while True:
        if inside:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1:at + 2] == b'"':
                at += 2
                continue
            inside = False
            at += 1
        else:
            while skip_space and line[at:at + 1] == b" ":
                at += 1
            if line[at:at + 1] == b'"':
                inside = True
                at += 1
                continue
        at = line.find(b",", at)
        if at < 0:
            return False
        at += 1


def cut_fields(text: str, skip_space: bool = False) -> list[str]:
    if '"' in text:
        return next(csv.reader([text], skipinitialspace=skip_space), [])
    fields = text.split(",")
    return [f.lstrip(" ") for f in fields] if skip_space else fields


def _cut_all(texts: list[str], skip_space: bool) -> list[list[str]]:
    """`cut_fields` of every text; one reader takes all texts with quotes, each of which is a whole record."""
    quoted = [text for text in texts if '"' in text]
    rows = list(csv.reader(quoted, skipinitialspace=skip_space))
    if skip_space or len(rows) < len(quoted):
        return [cut_fields(text, skip_space) for text in texts]
    found = iter(rows)
    return [next(found) if '"' in text else text.split(",") for text in texts]


def decode_fields(records: list[bytes], skip_space: bool = False) -> tuple[list[list[str] | None], list[str | None]]:
    """Fields and errors per record; a batch is decoded at once unless one of its records is broken."""
    try:
        # No record holds this separator of two line ends.
        texts = b"\n\r\n".join(records).decode(ENCODING).split("\n\r\n") if records else []
        return _cut_all(texts, skip_space), [None] * len(texts)
    except UnicodeDecodeError:
        fields, errors = [], []
        for record in records:
            try:
                fields.append(cut_fields(record.decode(ENCODING), skip_space))
                errors.append(None)
            except UnicodeDecodeError:
                fields.append(None)
                errors.append("undecodable text")
        return fields, errors


def cut_records(lines: list[bytes], skip_space: bool = False) -> tuple[list[tuple[int, bytes]], bool]:
    """Records of a whole content with the number of their first line, and whether the last one is open."""
    records: list[tuple[int, bytes]] = []
    inside = False
    for number, line in enumerate(lines):
        if inside:
            records[-1] = (records[-1][0], records[-1][1] + b"\n" + line)
        else:
            records.append((number, line))
        inside = ends_inside(line, inside, skip_space)
    return records, inside


@dataclass(frozen=True)
class Layout:
    """Where a file's header stands, which lines are no data, and the wanted columns by their key."""

    columns: dict[str, str]
    header_line: int
    skip: tuple[int, ...]

    @property
    def schema(self) -> str:
        texts = ", ".join(f"_{key} string" for key in self.columns)
        return f"source string, line_no long, {texts}, _absent boolean, error string"

    def spots(self, header: list[str] | None) -> str:
        """Positions of the columns; of repeated names the first counts. Empty if one is absent."""
        names = header or []
        found = [names.index(name) if name in names else None for name in self.columns.values()]
        return "" if None in found else ",".join(map(str, found))

    def rows(self, source: str, numbers: list[int | None] | None, records: list[bytes], spots: str) -> pa.RecordBatch:
        """Wanted columns of records, whose numbers may be unknown; blank ones are left out."""
        fields, errors = decode_fields(records)
        blank = [i for i, f in enumerate(fields) if f == [""]]
        if blank:
            gone = set(blank)
            kept = [i for i in range(len(fields)) if i not in gone]
            fields, errors = [fields[i] for i in kept], [errors[i] for i in kept]
            numbers = numbers and [numbers[i] for i in kept]
        arrays = [
            pa.repeat(pa.scalar(source, pa.string()), len(fields)),
            pa.array(numbers, pa.int64()) if numbers else pa.nulls(len(fields), pa.int64()),
            *(pa.array(c, pa.string()) for c in self._picked(fields, [int(s) for s in spots.split(",")] if spots else [])),
            pa.repeat(pa.scalar(not spots), len(fields)), pa.array(errors, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["source", "line_no", *(f"_{k}" for k in self.columns), "_absent", "error"])

    def _picked(self, fields: list[list[str] | None], places: list[int]) -> list[Sequence[str | None]]:
        """The wanted columns; a field that a record does not have is null."""
        if not places or not fields:
            return [[None] * len(fields) for _ in self.columns]
        try:
            picked = list(map(itemgetter(*places), fields))
            return list(zip(*picked)) if len(places) > 1 else [picked]
        except (IndexError, TypeError):
            return [[f[place] if f is not None and place < len(f) else None for f in fields] for place in places]

    def broken(self, source: str, number: int | None, error: str) -> pa.RecordBatch:
        row = {"source": source, "line_no": number, **{f"_{k}": None for k in self.columns}, "_absent": False, "error": error}
        kinds = [pa.string(), pa.int64(), *[pa.string()] * len(self.columns), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], list(row))


class _Block:
    """A run through one split: the rows of the records that stand wholly in it."""

    def __init__(self, layout: Layout, source: str, start: int, whole: bool, inside: bool, spots: str | None):
        self.layout, self.source, self.whole = layout, source, whole
        self.inside, self.spots = inside, spots
        # Lines have numbers in the first split only.
        self.line_no = 0 if start == 0 else None
        # The record that is open: whether an earlier split opened it, its first line, its lines and their bytes.
        self.inherited, self.since, self.lines, self.size = inside, None, [], 0
        self.numbers: list[int] = []
        self.records: list[bytes] = []

    def take(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        quoted = pc.match_substring(lines, '"')
        texts = lines.to_pylist()
        opening = self._opening(len(texts))
        plain = not opening and not self.inside and not pc.any(quoted).as_py()
        if not plain and max(map(len, texts), default=0) >= RECORD_BYTES:
            opening = len(texts)
        for text in texts[:opening]:
            yield from self._line(text)
        yield from self._lines(texts[opening:], np.flatnonzero(quoted.to_numpy(zero_copy_only=False)[opening:]).tolist())
        if self.records:
            yield self.layout.rows(self.source, self.numbers or None, self.records, self.spots or "")
            self.numbers, self.records = [], []

    def _opening(self, n: int) -> int:
        """How many of the next lines may be the header or lines that are no data."""
        last = max(self.layout.header_line, *self.layout.skip)
        return 0 if self.line_no is None else min(max(last + 1 - self.line_no, 0), n)

    def _lines(self, texts: list[bytes], quoted: list[int]) -> Iterator[pa.RecordBatch]:
        """Lines below the header, none of them too long: only those with quotes are looked at one by one."""
        done, base = 0, self.line_no
        for i in quoted:
            if self.inside:
                if not ends_inside(texts[i], True):
                    self._grow(texts[done:i + 1])
                    yield from self._close()
                    done = i + 1
            elif ends_inside(texts[i], False):
                self._keep(texts[done:i], done, base)
                self._open(None if base is None else base + i)
                done = i
        if self.inside:
            self._grow(texts[done:])
        else:
            self._keep(texts[done:], done, base)
        if base is not None:
            self.line_no = base + len(texts)

    def _line(self, line: bytes) -> Iterator[pa.RecordBatch]:
        inside = ends_inside(line, self.inside)
        if not self.inside:
            self._open(self.line_no)
        self.inside = inside
        self._grow([line])
        if self.line_no is not None:
            self.line_no += 1
        if not self.inside:
            yield from self._close()

    def _keep(self, records: list[bytes], first: int, base: int | None) -> None:
        self.records += records
        if base is not None:
            self.numbers += range(base + first, base + first + len(records))

    def _open(self, number: int | None) -> None:
        self.inside, self.inherited, self.since, self.lines, self.size = True, False, number, [], 0

    def _grow(self, lines: list[bytes]) -> None:
        self.size += sum(map(len, lines)) + len(lines)
        if self.size <= RECORD_BYTES:
            self.lines += lines

    def _close(self) -> Iterator[pa.RecordBatch]:
        self.inside = False
        if self.inherited:
            return
        if self.size > RECORD_BYTES:
            yield self.layout.broken(self.source, self.since, TOO_LONG)
        elif self.since is not None and self.since == self.layout.header_line:
            self.spots = self.layout.spots(decode_fields([b"\n".join(self.lines)])[0][0])
        elif self.since is None or self.since not in self.layout.skip:
            self._keep([b"\n".join(self.lines)], 0, self.since)

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.inside and self.whole:
            yield self.layout.broken(self.source, self.since, UNCLOSED)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, pa.Array]]:
    """Runs of lines of one split: its key (source, start and more), whether it is a new one, and the lines."""
    current = None
    for batch in batches:
        width, rows = batch.num_columns - 1, batch.num_rows
        changed = [pc.not_equal(c.slice(1), c.slice(0, max(rows - 1, 0))) for c in batch.columns[:2]]
        heads = np.flatnonzero(pc.or_(*changed).to_numpy(zero_copy_only=False)) + 1
        edges = [0, *heads.tolist(), rows] if rows else []
        for a, b in zip(edges, edges[1:]):
            key = tuple(batch.column(i)[a].as_py() for i in range(width))
            yield key, key[:2] != current, batch.column(width).slice(a, b - a)
            current = key[:2]


class _Side:
    """A split as seen from one of its two beginnings: its state, the piece that closes the record of an earlier split,
    and the piece of a record that is open."""

    def __init__(self, inside: bool):
        self.inside = self.inherited = inside
        self.head: bytes | None = None
        self.since, self.lines, self.size = None, [], 0

    def take(self, lines: pa.Array, quoted: list[int], texts: list[bytes], number: int, other: list[bool] | None = None):
        """The states after each line with quotes. Ends early where the other side is outside as well: from there on
        both are the same."""
        states, begin = [], 0
        for i, text in zip(quoted, texts):
            before, self.inside = self.inside, ends_inside(text, self.inside)
            if before and not self.inside and self.inherited:
                self._grow(lines.slice(begin, i + 1 - begin))
                self.head, self.inherited = self.piece(), False
            elif self.inside and not before:
                begin, self.since, self.lines, self.size = i, number + i, [], 0
            states.append(self.inside)
            if other is not None and not self.inside and not other[len(states) - 1]:
                return None
        if self.inside:
            self._grow(lines.slice(begin))
        return states

    def _grow(self, lines: pa.Array) -> None:
        self.size += (pc.sum(pc.binary_length(lines)).as_py() or 0) + len(lines)
        if self.size <= RECORD_BYTES:
            self.lines += lines.to_pylist()

    def piece(self) -> bytes | None:
        return b"\n".join(self.lines) if self.size <= RECORD_BYTES else None


SCOUTED = (
    "source string, start long, outside boolean, inside boolean, spots string, own string, line_no long, closed boolean, "
    "head binary, open_outside binary, open_inside binary"
)


class _Scout:
    """A run through one split from both beginnings at once."""

    KINDS = (
        pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.binary(),
        pa.binary(), pa.binary(),
    )

    def __init__(self, layout: Layout, source: str, start: int):
        self.layout, self.key, self.line_no = layout, (source, start), 0
        self.outside, self.inside, self.merged = _Side(False), _Side(True), False
        # Positions by the header's line, and by the whole record that begins with it, which is searched from line 0.
        self.spots, self.own = None, None
        self.searched, self.seen, self.began, self.record, self.open = start == 0, 0, 0, b"", False

    def take(self, lines: pa.Array) -> None:
        if self.searched:
            self._header(lines)
        quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        texts = lines.take(pa.array(quoted)).to_pylist()
        states = self.outside.take(lines, quoted.tolist(), texts, self.line_no)
        if not self.merged:
            self.merged = self.inside.take(lines, quoted.tolist(), texts, self.line_no, states) is None
        self.line_no += len(lines)

    def _header(self, lines: pa.Array) -> None:
        at = self.layout.header_line
        if self.line_no <= at < self.line_no + len(lines):
            self.spots = self.layout.spots(decode_fields([lines[at - self.line_no].as_py()])[0][0])
        for line in (scalar.as_py() for scalar in lines):
            self.began, self.record = (self.began, self.record + b"\n" + line) if self.open else (self.seen, line)
            self.open = ends_inside(line, self.open)
            self.seen += 1
            if self.seen <= at:
                continue
            whole = self.began == at and len(self.record) < RECORD_BYTES
            if whole and self.open:
                continue
            if whole:
                self.own = self.layout.spots(decode_fields([self.record])[0][0])
            self.searched = False
            return

    def result(self) -> pa.RecordBatch:
        a, b = self.outside, self.outside if self.merged else self.inside
        values = (
            *self.key, a.inside, b.inside, self.spots, self.own, a.since if self.key[1] == 0 else None,
            not self.inside.inherited, self.inside.piece() if self.inside.inherited else self.inside.head, a.piece(), b.piece(),
        )
        names = [part.split()[0] for part in SCOUTED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, self.KINDS)], names)


def _scout(cut: DataFrame, layout: Layout) -> DataFrame:
    """For every split and either beginning what it ends in and the pieces at its borders, and the columns' positions in
    the first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scout = None
        for key, fresh, lines in _runs(batches):
            if fresh:
                if scout is not None:
                    yield scout.result()
                scout = _Scout(layout, *key)
            scout.take(lines)
        if scout is not None:
            yield scout.result()

    return cut.select("source", "start", "raw").mapInArrow(run, SCOUTED)


def _beginnings(scouted: DataFrame) -> DataFrame:
    """`(source, start, begins_inside, spots, torn)` of every split of a cut file.

    A split that ends alike from both beginnings sets the state, one that ends in the opposite flips it. So the state
    is what the last setting split left, flipped as often as splits since then flip. A file is torn if a record crosses
    a border, or is open at its end.
    """
    order = Window.partitionBy("source").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("source")
    sets, flips = F.col("outside") == F.col("inside"), F.col("outside") & ~F.col("inside")
    counted = scouted.withColumn("_flips", F.coalesce(F.sum(flips.cast("int")).over(before), F.lit(0)))
    last = F.last(F.when(sets, F.struct("outside", "_flips")), ignorenulls=True).over(before)
    set_by = counted.withColumn("_last", last)
    odd = (F.col("_flips") - F.coalesce(F.col("_last._flips"), F.lit(0))) % 2 == 1
    begun = set_by.withColumn("begins_inside", F.coalesce(F.col("_last.outside"), F.lit(False)) != odd)
    ends = F.when(F.col("begins_inside"), F.col("inside")).otherwise(F.col("outside"))
    return begun.select(
        "source", "start", "begins_inside", F.max("spots").over(file).alias("spots"), F.bool_or(ends).over(file).alias("torn")
    )


def _pieces(scouted: DataFrame, marks: DataFrame) -> DataFrame:
    """`(source, start, role, line_no, piece, spots)` of the records that cross borders, as the true beginnings tell."""
    torn = marks.filter("torn").select("source", "start", "begins_inside", F.col("spots").alias("_spots"))
    placed = scouted.join(torn, ["source", "start"])
    begun, none = F.col("begins_inside"), F.lit(None).cast("long")

    def piece(role: Column, line_no: Column, text: str) -> Column:
        return F.struct(role.alias("role"), line_no.alias("line_no"), F.col(text).alias("piece"))

    listed = F.array(
        F.when(begun, piece(F.when(F.col("closed"), TAIL).otherwise(THROUGH), none, "head")),
        F.when(begun & F.col("closed") & F.col("inside"), piece(F.lit(OPEN), none, "open_inside")),
        F.when(~begun & F.col("outside"), piece(F.lit(OPEN), F.col("line_no"), "open_outside")),
    )
    spots = F.coalesce("own", "_spots", F.lit(""))
    return placed.select("source", "start", spots.alias("spots"), F.inline(F.filter(listed, lambda p: p.isNotNull())))


def _put_together(pieces: DataFrame, layout: Layout) -> DataFrame:
    """Records that cross borders: an opening piece, whole splits, and the piece that closes it."""
    order = Window.partitionBy("source").orderBy("start", "role")
    numbered = pieces.withColumn("_record", F.sum((F.col("role") == OPEN).cast("int")).over(order))
    listed = F.array_sort(F.collect_list(F.struct("start", "role", F.col("piece").cast("string").alias("text"))))
    text = F.array_join(F.transform(listed, lambda p: p["text"]), "\n").cast("binary")
    too_long = (F.count("*") > F.count("piece")) | (F.sum(F.length("piece") + 1) > RECORD_BYTES)
    error = F.when(too_long, TOO_LONG).when(F.min("role") != TAIL, UNCLOSED)
    records = numbered.groupBy("source", "_record").agg(
        F.max("line_no").alias("line_no"), F.max("spots").alias("spots"), error.alias("error"), text.alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, number, spots, error, record in zip(*(c.to_pylist() for c in batch.columns)):
                if error is None:
                    yield layout.rows(source, [number], [record], spots)
                else:
                    yield layout.broken(source, number, error)

    return records.select("source", "line_no", "spots", "error", "text").mapInArrow(run, layout.schema)


def _cut(raw: DataFrame, layout: Layout) -> DataFrame:
    """The rows of records within splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for (source, start, whole, inside, spots), fresh, lines in _runs(batches):
            if fresh:
                if block is not None:
                    yield from block.finish()
                block = _Block(layout, source, start, whole, bool(inside), spots)
            yield from block.take(lines)
        if block is not None:
            yield from block.finish()

    columns = raw.select("source", "start", "whole", "begins_inside", "spots", "raw")
    return columns.mapInArrow(run, layout.schema)


def read_records(spark: SparkSession, path: str, layout: Layout, pattern: str = "*.csv") -> DataFrame:
    """`(source, line_no, _column…, _absent, error)`: the wanted columns of all records below a folder.

    Lines are numbered in the first split of a file, where the preamble lies. Files that are read whole pass once.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    lengths = listing.load(path).select("length")
    raw = (
        spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path)
        .select(
            F.col("_metadata.file_path").alias("source"),
            F.col("_metadata.file_block_start").alias("start"),
            (F.col("_metadata.file_block_length") == F.col("_metadata.file_size")).alias("whole"),
            F.col("value").cast("binary").alias("raw"),
        )
    )
    unmarked = {"begins_inside": F.lit(False), "spots": F.lit(None).cast("string")}
    if lengths.filter(F.col("length") > _least_cut(spark)).isEmpty():
        return _cut(raw.withColumns(unmarked), layout)
    scouted = materialize(_scout(raw.filter("NOT whole"), layout))
    marks = materialize(_beginnings(scouted.select("source", "start", "outside", "inside", "spots")))
    parts = -(-marks.count() // BROADCAST_ROWS)
    if not parts:
        return _cut(raw.withColumns(unmarked), layout)
    # Lines must not be shuffled, so marks are broadcast; of very many, in parts of whole files.
    found = []
    for part in range(parts):
        def mine(df: DataFrame, part: int = part) -> DataFrame:
            return df.filter(F.pmod(F.xxhash64("source"), F.lit(parts)) == part) if parts > 1 else df

        marked = mine(raw).join(F.broadcast(mine(marks)), ["source", "start"], "left")
        found.append(_cut(marked, layout))
    if not marks.filter("torn").isEmpty():
        found.append(_put_together(_pieces(scouted, marks), layout))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _least_cut(spark: SparkSession) -> int:
    """Shorter files are never cut."""
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    jvm = spark._jvm.org.apache.spark.network.util.JavaUtils
    return min(jvm.byteStringAsBytes(spark.conf.get(size)) for size in sizes)


def records_of(files: DataFrame, layout: Layout) -> DataFrame:
    """The same from `(source, content)` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block = _Block(layout, source, 0, True, False, None)
                yield from block.take(pa.array(content.splitlines(), pa.binary()))
                yield from block.finish()

    return files.select("source", "content").mapInArrow(run, layout.schema)
