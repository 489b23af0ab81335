"""Removal of repeated byte strings through column-wise suffix sorting of many short strings.

A window is a string of `MATCH` bytes. A byte goes if a window that also starts earlier (in a smaller document, or
earlier in the same one) covers it. All texts are judged as they came in.

Equal windows have to meet. Each window has an anchor: its `ANCHOR`-byte string of smallest hash, the leftmost among
equals. Neighbouring windows with one anchor form a segment, and equal windows share their anchor's string. So

1. anchors whose string occurs once are dropped: nothing there repeats;
2. equal segments are one, with their first occurrence; windows of later occurrences repeat;
3. anchors with several different segments are gathered into buckets, and a bucket's segments are suffix-sorted
   together: in each round every segment hands over one more symbol from its end, the collection's Burrows-Wheeler
   transform gives the place of the longer suffix, and the common prefix with its new neighbours is updated. Buckets
   of `BUCKET_BYTES` stay in memory; beyond `IN_MEMORY` entries, which they do not near, transform and prefixes are
   kept in files that are read and written in sequence;
4. runs of suffixes that share `MATCH` bytes are equal windows; all but the first of each run repeat.

An anchor with very many different segments (the edge of a passage that a large part of all documents share) would be
one large group. Its windows are grouped by their digest instead, which aggregates before it shuffles.

Equal texts are one: the copy with the smallest doc_id is judged, the others repeat from it as a whole. Null text is
empty. A null doc_id comes after all others. Rows that agree in doc_id and text are one document, whose rows get the
same result; rows that agree in doc_id only are ordered by a hash of their text. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import prefix_hash, release_memory, sliding_hash, span_hash, store, text_chunks, tidily
from loadcast.session import materialize

MATCH, ANCHOR = 100, 48
# A byte that no UTF-8 text holds: the symbol before a suffix that is not known yet.
UNKNOWN = 0xFF
# Bytes of segments per bucket, entries of the transform per step, and entries beyond which it is kept in files.
BUCKET_BYTES, STEP, IN_MEMORY = 2 << 20, 1 << 21, 1 << 25
# Different segments of one anchor beyond which its windows are grouped by digest.
MANY_SEGMENTS = 5_000
# Key rows that are broadcast at most; 16 bytes each, and more are joined by shuffling.
BROADCAST_KEYS = 1_500_000
LAST_ID = 2**63 - 1


def _checked(keys: DataFrame, rows: int) -> DataFrame:
    """Broadcast stored key columns if their counted rows allow it."""
    return F.broadcast(keys) if keys.limit(rows + 1).count() <= rows else keys


# Anchors


def segments_of(data: np.ndarray, match: int = MATCH, anchor: int = ANCHOR):
    """Anchor hash, segment hash, first window and number of windows of every segment of one text."""
    running = prefix_hash(data)
    value = sliding_hash(running, anchor)
    index = np.arange(len(value), dtype=np.int32)
    span, width = match - anchor + 1, 1
    while width * 2 <= span:
        value, index = _leftmost(value, index, width)
        width *= 2
    if width < span:
        value, index = _leftmost(value, index, span - width)
    first = np.flatnonzero(np.concatenate(([True], index[1:] != index[:-1])))
    count = np.diff(np.append(first, len(index)))
    return value[first], span_hash(running, first, first + count - 1 + match), first, count


def _leftmost(value: np.ndarray, index: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The smaller of each value and the one `shift` places on, the left one if equal."""
    right = value[shift:] < value[:-shift]
    return np.where(right, value[shift:], value[:-shift]), np.where(right, index[shift:], index[:-shift])


SEGMENTS = "hash long, segment long, doc long, tie long, start int, windows int"


def segment_table(texts: DataFrame, match: int) -> DataFrame:
    """All segments of `(doc, tie, text)`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(2)):
                parts, sizes = [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    if b - a >= match:
                        parts.append(segments_of(data[a:b], match))
                    sizes.append(len(parts[-1][0]) if b - a >= match else 0)
                if not parts:
                    continue
                hashes, segments, starts, counts = (np.concatenate(c) for c in zip(*parts))
                rows = pa.array(np.repeat(np.arange(first, end), sizes))
                yield pa.RecordBatch.from_arrays([
                    pa.array(hashes.view(np.int64)), pa.array(segments.view(np.int64)), batch.column(0).take(rows),
                    batch.column(1).take(rows), pa.array(starts.astype(np.int32)), pa.array(counts.astype(np.int32)),
                ], names=["hash", "segment", "doc", "tie", "start", "windows"])

    return texts.select("doc", "tie", "text").mapInArrow(tidily(run), SEGMENTS)


# Column-wise suffix sorting


class Columns:
    """The growing arrays of one collection, in memory or, beyond `IN_MEMORY` entries, in files of one folder."""

    KINDS = {"symbol": np.uint8, "start": np.int32, "common": np.uint8}

    def __init__(self, total: int, limit: int = IN_MEMORY):
        self.folder = tempfile.TemporaryDirectory(prefix="columns-") if total > limit else None
        self.turn = 0

    def new(self, size: int, names: Sequence[str]) -> dict[str, np.ndarray]:
        """Arrays for one round; the files of the round before the last are written over."""
        self.turn ^= 1
        if self.folder is None:
            return {name: np.empty(size, self.KINDS[name]) for name in names}
        return {
            name: np.memmap(os.path.join(self.folder.name, f"{name}-{self.turn}"), self.KINDS[name], "w+", shape=size)
            for name in names
        }

    def close(self) -> None:
        if self.folder is not None:
            self.folder.cleanup()


def _ranks(symbol: np.ndarray, places: np.ndarray, step: int) -> np.ndarray:
    """For each place, which are in order, the entries with a smaller symbol, or an equal one before it."""
    within = np.empty(len(places), np.int64)
    total = np.zeros(256, np.int64)
    for a in range(0, len(symbol), step):
        part = np.asarray(symbol[a:a + step])
        order = np.argsort(part, kind="stable")
        counts = np.bincount(part, minlength=256)
        heads = np.cumsum(counts) - counts
        low, high = np.searchsorted(places, [a, a + len(part)])
        own = places[low:high] - a
        which = part[own]
        by_symbol = np.argsort(which, kind="stable")
        edges = np.searchsorted(which[by_symbol], np.arange(257))
        for c in np.flatnonzero(np.diff(edges)).tolist():
            mine = by_symbol[edges[c]:edges[c + 1]]
            before = np.searchsorted(order[heads[c]:heads[c] + counts[c]], own[mine])
            within[low + mine] = total[c] + before
        total += counts
    return within + (np.cumsum(total) - total)[np.asarray(symbol[places])]


def sort_columns(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, match: int = MATCH, step: int = STEP,
    limit: int = IN_MEMORY,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffix-sort a collection of strings that stand one after the other in `data`. Gives its suffixes in order, by
    steps and without the empty ones: the place in `data` where each starts, and its common prefix with the one
    before, up to `match`. Suffixes shorter than `match` count as having none."""
    sizes = ends - starts
    count, longest = len(sizes), int(sizes.max(initial=0))
    columns = Columns(int(sizes.sum()) + count, limit)
    try:
        now = columns.new(count, ("symbol", "start"))
        now["symbol"][:], now["start"][:] = UNKNOWN, ends
        place = np.arange(count, dtype=np.int64)
        for turn in range(1, longest + 1):
            active = np.flatnonzero(sizes >= turn)
            active = active[np.argsort(place[active], kind="stable")]
            at = place[active]
            now["symbol"][at] = data[ends[active] - turn]
            fresh = count + _ranks(now["symbol"], at, step)
            by_place = np.argsort(fresh, kind="stable")
            # Shorter suffixes have no common prefix that counts.
            now = _insert(columns, now, fresh[by_place], ends[active[by_place]] - turn, turn >= match, step)
            place[active] = fresh
            if turn >= match:
                _update_common(now, np.sort(fresh), data, ends, match)
        for a in range(count, len(now["start"]), step):
            part = np.array(now["start"][a:a + step])
            yield part, np.array(now["common"][a:a + step]) if "common" in now else np.zeros(len(part), np.uint8)
    finally:
        columns.close()


def _insert(
    columns: Columns, old: dict[str, np.ndarray], fresh: np.ndarray, starts: np.ndarray, prefixes: bool, step: int
) -> dict[str, np.ndarray]:
    """The arrays with the suffixes that start at `starts` put in at the sorted places `fresh`; one pass over both."""
    size = len(old["start"]) + len(fresh)
    new = columns.new(size, ("symbol", "start", "common") if prefixes else ("symbol", "start"))
    values = {"symbol": UNKNOWN, "start": starts, "common": 0}
    used = 0
    for a in range(0, size, step):
        b = min(a + step, size)
        low, high = np.searchsorted(fresh, [a, b])
        kept = np.ones(b - a, bool)
        kept[fresh[low:high] - a] = False
        take = b - a - (high - low)
        for name in new:
            part = np.empty(b - a, new[name].dtype)
            part[kept] = old[name][used:used + take] if name in old else 0
            part[fresh[low:high] - a] = values[name][low:high] if name == "start" else values[name]
            new[name][a:b] = part
        used += take
    return new


def _update_common(
    now: dict[str, np.ndarray], fresh: np.ndarray, data: np.ndarray, ends: np.ndarray, match: int
) -> None:
    """Common prefixes of the new suffixes with the ones before them, and of the ones behind with them."""
    at = np.unique(np.concatenate((fresh, fresh + 1)))
    at = at[(at > len(ends)) & (at < len(now["start"]))]
    for part in np.array_split(at, max(1, len(at) // 65536)):
        here, before = now["start"][part].astype(np.int64), now["start"][part - 1].astype(np.int64)
        long = (_left(ends, here) >= match) & (_left(ends, before) >= match)
        now["common"][part[~long]] = 0
        reach = np.arange(match)
        differs = data[here[long][:, None] + reach] != data[before[long][:, None] + reach]
        now["common"][part[long]] = np.where(differs.any(1), differs.argmax(1), match)


def _left(ends: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Symbols from a place to the end of its string."""
    return ends[np.searchsorted(ends, place, "right")] - place


def repeated_windows(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, match: int = MATCH, **options
) -> tuple[np.ndarray, np.ndarray]:
    """String and window (0 is the first) of every window that equals an earlier one. `first` orders the windows: a
    number per string to which the window's number is added."""
    steps = list(zip(*sort_columns(data, starts, ends, match, **options)))
    if not steps:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, common = (np.concatenate(c) for c in steps)
    owner = np.searchsorted(ends, place, "right")
    long = ends[owner] - place >= match
    head = (common < match)[long]
    owner = owner[long]
    window = place[long] - starts[owner]
    if not len(owner):
        return owner, window
    heads = np.flatnonzero(head)
    heads = np.unique(np.append(0, heads))
    key = first[owner] + window
    least = np.repeat(np.minimum.reduceat(key, heads), np.diff(np.append(heads, len(key))))
    again = key > least
    return owner[again], window[again]


# The job


RANGES = "doc long, tie long, first int, last int"


def _sort_bucket(group: pa.Table, match: int) -> pa.Table:
    """Ranges of repeated windows, as first and last byte, of one bucket of segments."""
    text = group.column("bytes").combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8)
    doc, tie, start = (group.column(c).to_numpy() for c in ("doc", "tie", "start"))
    order = np.lexsort((tie, doc))
    changed = (np.diff(doc[order]) != 0) | (np.diff(tie[order]) != 0)
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(changed)))
    owner, window = repeated_windows(data, offsets[:-1], offsets[1:], (rank << 32) + start, match)
    order = np.lexsort((window, owner))
    owner, window = owner[order], window[order]
    head = np.ones(len(owner), bool)
    head[1:] = (owner[1:] != owner[:-1]) | (window[1:] != window[:-1] + 1)
    heads = np.flatnonzero(head)
    last = np.append(heads[1:], len(owner)) - 1
    own = owner[heads]
    return pa.table({
        "doc": doc[own], "tie": tie[own], "first": (start[own] + window[heads]).astype(np.int32),
        "last": (start[own] + window[last] + match - 1).astype(np.int32),
    }) if len(heads) else pa.table({
        "doc": pa.array([], pa.int64()), "tie": pa.array([], pa.int64()), "first": pa.array([], pa.int32()),
        "last": pa.array([], pa.int32()),
    })


def _many_windows(sliced: DataFrame, match: int) -> DataFrame:
    """Repeated windows of anchors with very many segments, by digest of the window."""
    offset = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - match))
    windows = sliced.select("doc", "tie", "start", "bytes", offset.alias("offset")).select(
        F.md5(F.substr("bytes", F.col("offset") + 1, F.lit(match))).alias("digest"),
        "doc", "tie", (F.col("start") + F.col("offset")).cast("int").alias("first"),
    )
    windows = store(windows, "windows")
    earliest = windows.groupBy("digest").agg(F.min(F.struct("doc", "tie", "first")).alias("earliest"))
    again = windows.join(earliest, "digest").filter(F.struct("doc", "tie", "first") != F.col("earliest"))
    return again.select("doc", "tie", "first", (F.col("first") + match - 1).cast("int").alias("last"))


def _slices(texts: DataFrame, wanted: DataFrame, match: int) -> DataFrame:
    """The bytes of the wanted segments `(doc, tie, start, windows, bucket)`."""
    lists = wanted.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "windows", "bucket")).alias("cuts"))
    cut = texts.join(lists, ["doc", "tie"]).select(
        "doc", "tie", F.col("text").cast("binary").alias("raw"), F.explode("cuts").alias("cut")
    )
    return cut.select(
        "doc", "tie", "cut.start", "cut.bucket",
        F.substr("raw", F.col("cut.start") + 1, F.col("cut.windows") + F.lit(match - 1)).alias("bytes"),
    )


def _keyed(df: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    return df.select(doc.alias("doc"), F.xxhash64(text).alias("tie"), text.alias("text"))


def repeated_ranges(df: DataFrame, match: int = MATCH) -> tuple[DataFrame, DataFrame]:
    """Two tables: `(doc, tie, n_bytes, sha, copy)` per distinct document, `copy` if its text has a smaller doc_id;
    and `(doc, tie, first, last)`, byte ranges that repeat in documents that are no copies. `doc` and `tie` are the
    id and a hash of the text, as `_keyed` gives them."""
    texts = _keyed(df)
    rows = texts.select(
        "doc", "tie", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")
    )
    rows = store(rows.distinct(), "texts")
    least = rows.groupBy("sha").agg(F.min("doc").alias("least"), F.count("*").alias("n"))
    least = least.filter("n > 1").select("sha", "least")
    base = store(rows.join(least, "sha", "left").select(
        "doc", "tie", "n_bytes", "sha", (F.col("doc") > F.coalesce("least", "doc")).alias("copy")
    ), "base")
    copies = _checked(materialize(base.filter("copy").select("doc", "tie")), BROADCAST_KEYS)
    judged = texts.filter(F.octet_length("text") >= match).join(copies, ["doc", "tie"], "left_anti")
    found = segment_table(judged, match)
    shared = store(found.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "shared")
    # Always a shuffled join, as these keys grow with the texts: one plan at every size, with skew handling.
    segments = store(found.join(shared.hint("merge"), "hash", "left_semi"), "segments")

    place = F.struct("doc", "tie", "start")
    distinct = store(
        segments.groupBy("hash", "segment", "windows").agg(F.min(place).alias("at"), F.count("*").alias("n")), "distinct"
    )
    later = segments.join(distinct.filter("n > 1").select("hash", "segment", "windows", "at"),
                          ["hash", "segment", "windows"]).filter(place != F.col("at"))
    ranges = later.select(
        "doc", "tie", F.col("start").alias("first"), (F.col("start") + F.col("windows") + match - 2).alias("last")
    )

    several = distinct.groupBy("hash").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    differing = store(distinct.join(several, "hash").select("hash", "kinds", "windows", "at.*"), "differing")
    size = differing.agg(F.sum(F.col("windows") + match - 1)).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    many = F.col("kinds") > MANY_SEGMENTS
    wanted = differing.select(
        "doc", "tie", "start", "windows",
        F.when(many, -1).otherwise(F.pmod(F.xxhash64("hash"), F.lit(buckets))).cast("int").alias("bucket"),
    )
    sliced = store(_slices(judged, wanted, match), "sliced")

    def sort(group: pa.Table) -> pa.Table:
        found = _sort_bucket(group, match)
        release_memory()
        return found

    sorted_ = sliced.filter("bucket >= 0").groupBy("bucket").applyInArrow(sort, RANGES)
    ranges = ranges.unionByName(sorted_).unionByName(_many_windows(sliced.filter("bucket < 0"), match))
    return base, ranges


def merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs, as start and end, of bytes that the inclusive ranges cover."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    head = np.ones(len(first), bool)
    head[1:] = first[1:] > reach[:-1] + 1
    heads = np.flatnonzero(head)
    return first[heads], reach[np.append(heads[1:], len(first)) - 1] + 1


def without(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    parts, place = [], 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        parts.append(raw[place:a])
        place = b
    return b"".join([*parts, raw[place:]])


def _map_cut(joined: DataFrame, schema: str, make: Callable) -> DataFrame:
    """`make(raw, starts, ends)` for every row of `(doc, tie, text, ranges)`, after doc and tie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists, offsets = batch.column(3).values, batch.column(3).offsets.to_numpy()
            first, last = (lists.field(i).to_numpy() for i in range(2))
            for i in range(batch.num_rows):
                own = slice(offsets[i], offsets[i + 1])
                out.append(make(batch.column(2)[i].as_py().encode(), *merged(first[own], last[own])))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *map(pa.array, zip(*out))], names=["doc", "tie", *names]
                )

    names = [part.split()[0] for part in schema.split(", ")]
    return joined.select("doc", "tie", "text", "ranges").mapInArrow(tidily(run), f"doc long, tie long, {schema}")


def _listed(ranges: DataFrame) -> DataFrame:
    """One list per document: no longer than its text."""
    return ranges.groupBy("doc", "tie").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def digests(df: DataFrame, match: int = MATCH) -> DataFrame:
    """`(doc_id, n_bytes, n_removed, n_spans, kept_sha256)` per row."""
    base, ranges = repeated_ranges(df, match)
    lists = store(_listed(ranges), "ranges")
    touched = _checked(lists.select("doc", "tie"), BROADCAST_KEYS)
    texts = _keyed(df).join(touched, ["doc", "tie"], "left_semi").dropDuplicates(["doc", "tie"])

    def make(raw: bytes, starts: np.ndarray, ends: np.ndarray):
        return int((ends - starts).sum()), len(starts), hashlib.sha256(without(raw, starts, ends)).hexdigest()

    cut = _map_cut(texts.join(lists, ["doc", "tie"]), "cut_bytes long, cut_spans long, cut_sha string", make)
    judged = base.join(cut, ["doc", "tie"], "left")
    gone = F.col("copy") & (F.col("n_bytes") >= match)
    empty = hashlib.sha256(b"").hexdigest()
    result = judged.select(
        "doc", "tie", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("cut_bytes", F.lit(0))).alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("cut_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, empty).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
    )
    keys = df.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("tie"),
    )
    return keys.join(result, ["doc", "tie"]).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def whole_characters(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The text without the runs, except that a character cut by the edge of a run stays whole."""
    data = np.frombuffer(raw, np.uint8)
    begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    starts = begins[np.searchsorted(begins, starts, "left")]
    ends = begins[np.searchsorted(begins, ends, "right") - 1]
    kept = starts < ends
    return without(raw, starts[kept], ends[kept])


def cut_documents(df: DataFrame, match: int = MATCH) -> DataFrame:
    """`df` with the repeated runs cut out of `text`. Documents of which no word is left are dropped, if words went."""
    base, ranges = repeated_ranges(df, match)
    lists = store(_listed(ranges), "ranges")
    cut = _map_cut(
        _keyed(df).join(lists, ["doc", "tie"]).dropDuplicates(["doc", "tie"]), "cut_text string",
        lambda raw, starts, ends: (whole_characters(raw, starts, ends).decode(),),
    )
    changed = store(base.filter(F.col("copy") & (F.col("n_bytes") >= match)).select(
        "doc", "tie", F.lit("").alias("cut_text")
    ).unionByName(cut), "cut")
    keyed = df.withColumns({
        "_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)),
        "_tie": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))),
    })
    joined = keyed.join(changed.toDF("_doc", "_tie", "_cut"), ["_doc", "_tie"], "left")
    joined = joined.filter(F.col("_cut").isNull() | (F.regexp_count("_cut", F.lit(r"[^ \t-\r]")) > 0))
    return joined.withColumn("text", F.coalesce("_cut", "text")).select(*df.columns)
