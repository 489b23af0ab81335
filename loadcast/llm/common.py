"""Shared helpers: tables, stored intermediates, text chunks as byte arrays, word spans and hashes, components."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.session import materialize, scratch_path

# Bytes of text that one vectorised step takes; a longer document is a step of its own.
CHUNK_BYTES = 1 << 20

# Odd multiplier of the polynomial word hash and its inverse modulo 2**64.
HASH_BASE = 0x9E3779B97F4A7C13
HASH_INVERSE = pow(HASH_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write `df` below the shared scratch folder and read it back: lineage ends in files that outlive executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give freed memory of this Python worker back to the system. Workers are reused from stage to stage, and what
    their allocators keep would add to the memory of the executor."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def tidily(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """`run` for `mapInArrow`, with freed memory given back before it and after its last batch is gone."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        yield from run(batches)
        release_memory()

    return tidy


# Text columns as byte arrays


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets of its rows; a null row is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about `limit` bytes: first row, end row, their bytes, and offsets from 0."""
    data, offsets = byte_column(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags that is true within the inclusive byte ranges."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low:high + 1] = True
    return flags


# Words are runs of bytes other than ASCII white space.
WORD_BYTES = ~byte_set((0x20, 0x20), (0x09, 0x0D))
# Lower case for A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n + 1 offsets of each row's words. No word leaves its row."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = inside[data]
    before = np.empty(len(word), bool)
    before[0], before[1:] = False, word[:-1]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    after = np.empty(len(word), bool)
    after[-1], after[:-1] = False, word[1:]
    after[offsets[offsets > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        # A worker keeps them, so no more than the next power of two.
        size = max(1 << n.bit_length(), 1 << 17)
        for name, base in (("up", HASH_BASE), ("down", HASH_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


# Spans beyond this many bytes are hashed one by one, so that the others take few steps.
LONG_SPAN = 256


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes; equal for equal bytes. Eight bytes at a time go through a scramble that is not
    linear in them, so no regular pair of strings collides, as it can under a polynomial modulo a power of two."""
    lengths = (ends - starts).astype(np.int64)
    state = mix(lengths.astype(np.uint64) + np.uint64(HASH_BASE))
    padded = np.concatenate((np.ascontiguousarray(data), np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.as_strided(padded, (len(padded) - 7, 8), (1, 1))
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    spans = np.flatnonzero(lengths <= LONG_SPAN)
    at, left = starts[spans], lengths[spans]
    while len(spans):
        piece = eight[at].view("<u8")[:, 0] & masks[np.minimum(left, 8)]
        state[spans] = mix((state[spans] ^ mix(piece)) * np.uint64(HASH_BASE))
        more = left > 8
        spans, at, left = spans[more], at[more] + 8, left[more] - 8
    for span in np.flatnonzero(lengths > LONG_SPAN).tolist():
        digest = hashlib.blake2b(data[starts[span]:ends[span]].tobytes(), digest_size=8).digest()
        state[span] = np.uint64(int.from_bytes(digest, "little"))
    return state


def same_bytes(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, others: np.ndarray, other_data: np.ndarray | None = None
) -> np.ndarray:
    """Whether each span holds the bytes of the span of its length that begins at its `others`."""
    before = np.cumsum(lengths) - lengths
    step = np.arange(int(lengths.sum()))
    here = data[step + np.repeat(starts - before, lengths)]
    there = (data if other_data is None else other_data)[step + np.repeat(others - before, lengths)]
    differs = np.concatenate(([0], np.cumsum(here != there)))
    return differs[before + lengths] == differs[before]


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Running sums of symbol times power: any span's hash is a difference, see `span_hash`."""
    up, _ = _powers(len(symbols) + 1)
    running = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[:-1], out=running[1:])
    return running


def span_hash(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal for equal symbols wherever they stand."""
    _, down = _powers(len(running))
    return mix((running[ends] - running[starts]) * down[starts])


def sliding_hash(running: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all spans of one width, from left to right."""
    _, down = _powers(len(running))
    values = running[width:] - running[:-width]
    values *= down[:len(values)]
    values ^= values >> np.uint64(32)
    values *= np.uint64(0x94D049BB133111EB)
    return values


@lru_cache(maxsize=1)
def _lines() -> np.ndarray:
    return ~byte_set((0x0A, 0x0A))


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-empty lines, as `word_spans` gives words."""
    return word_spans(data, offsets, _lines())


# Components of a graph


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """`(node, root)` for every node of an edge: the smallest node of its component.

    Each round first ties the larger neighbours of a node to its smallest one (large star), then the smaller ones
    (small star), until a round changes nothing. Nodes with many edges are only aggregated, never gathered, and
    every round ends in a reliable checkpoint. An empty edge table gives an empty result.
    """
    links = edges.select(
        F.greatest(left, right).alias("node"), F.least(left, right).alias("low")
    ).filter("node <> low").distinct()
    links = materialize(links)
    while True:
        both = links.union(links.select(F.col("low").alias("node"), F.col("node").alias("low")))
        lowest = both.groupBy("node").agg(F.min("low").alias("least"))
        lowest = lowest.select("node", F.least("node", "least").alias("least"))
        large = both.filter("low > node").join(lowest, "node").select(
            F.col("low").alias("node"), F.col("least").alias("low")
        ).distinct()
        lowest = large.groupBy("node").agg(F.min("low").alias("least"))
        small = large.join(lowest, "node").select(
            F.greatest("low", "least").alias("a"), F.least("low", "least").alias("b")
        ).union(lowest.select(F.col("node").alias("a"), F.col("least").alias("b")))
        after = materialize(small.filter("a <> b").distinct().select(F.col("a").alias("node"), F.col("b").alias("low")))
        # A star forest is a fixed point: no node is both a member and a centre, and each member has one centre.
        members, centres = after.groupBy("node").count(), after.select(F.col("low").alias("node")).distinct()
        unsettled = members.filter("count > 1").select("node").union(centres.join(members.select("node"), "node"))
        links = after
        if unsettled.isEmpty():
            break
    roots = links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return links.select("node", F.col("low").alias("root")).union(roots)
