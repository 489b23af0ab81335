"""Periodic runs of words: maximal stretches that repeat a block of words at least four times.

A run's smallest period is the length of its Lyndon root, and every Lyndon root of a run is the longest Lyndon word at
its first word under one of the two word orders. So the longest Lyndon words of both orders are the only candidates;
each is extended to both sides by longest common extensions. Those are lowest common ancestors in the suffix trees of
the words and of their reversal: Ukkonen's algorithm builds a tree, an Euler tour turns an ancestor into a range
minimum, and the minima of all candidates are looked up level by level, so one level of the table is held at a time.

Trees are built where a run can be: in a run of at least `REPEATS` periods and `LEAST` words every three words in a row
occur three times, so a stretch is cut wherever three words are rarer in it, until no cut is left. That test uses
hashes, which can only keep too much; the trees themselves know words by their bytes.

Words are cut at ASCII white space. Null and empty texts have no words and no runs. A repeated row is judged by itself,
a null `doc_id` stays null, an empty table gives an empty result, and other columns are left aside. Texts are processed
whole: a stretch that can hold runs takes about 0.5 KB of memory a word while its tree is built, other text takes a few
bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import WORD_BYTES, mix, prefix_hash, span_hash, text_chunks, word_spans

REPEATS = 4
LEAST = 6

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


class SuffixTree:
    """The suffix tree of a list of positive numbers, closed by a 0 of its own."""

    def __init__(self, symbols: list[int]):
        self.text = [*symbols, 0]
        self.width = max(self.text) + 1
        self._build()

    def _build(self) -> None:
        """Ukkonen's algorithm. An edge is known by its node times `width` plus its first symbol."""
        text, width, n = self.text, self.width, len(self.text)
        first, end, link, leaf_of = [0], [0], [0], []
        edges: dict[int, int] = {}
        node = at = length = waiting = 0
        for i, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    at = i
                key = node * width + text[at]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(first)
                    leaf_of.append(len(first))
                    first.append(i)
                    end.append(n)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    begin = first[child]
                    span = end[child] - begin
                    if length >= span:
                        node = child
                        at += span
                        length -= span
                        continue
                    after = text[begin + length]
                    if after == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    split = len(first)
                    edges[key] = split
                    edges[split * width + symbol] = split + 1
                    edges[split * width + after] = child
                    leaf_of.append(split + 1)
                    first += (begin, i)
                    end += (begin + length, n)
                    link += (0, 0)
                    first[child] = begin + length
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - waiting + 1
        self.spans = np.array(end) - np.array(first)
        self.suffix_of = np.full(len(first), -1)
        self.suffix_of[leaf_of] = np.arange(n)
        self.keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.children = np.fromiter(edges.values(), np.int64, len(edges))

    def tour(self, descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the suffixes, and the text depth to which an Euler tour returns between two leaves.

        The closing symbol comes first in either order.
        """
        node, symbol = np.divmod(self.keys, self.width)
        if descending:
            symbol = np.where(symbol > 0, self.width - symbol, 0)
        # Children are pushed last first.
        order = np.argsort(node * self.width - symbol)
        bounds = np.searchsorted(node[order], np.arange(len(self.spans) + 1)).tolist()
        children = self.children[order].tolist()
        spans, suffix_of = self.spans.tolist(), self.suffix_of.tolist()
        depth = [0] * len(spans)
        leaves, returns, stack = [], [], [0]
        while stack:
            at = stack.pop()
            if at < 0:
                returns.append(~at)
                continue
            low, high = bounds[at], bounds[at + 1]
            if low == high:
                leaves.append(suffix_of[at])
                continue
            here = depth[at]
            for child in children[low:high]:
                depth[child] = here + spans[child]
                stack.append(child)
                stack.append(~here)
            stack.pop()
        rank = np.empty(len(leaves), np.int64)
        rank[leaves] = np.arange(len(leaves))
        return rank, np.array(returns, np.int64)


def common_extensions(rank: np.ndarray, returns: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common prefixes of the suffixes `a` and `b`, which differ pairwise."""
    low, high = np.minimum(rank[a], rank[b]), np.maximum(rank[a], rank[b])
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    found = np.zeros(len(a), np.int64)
    table = returns
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            step = 1 << (k - 1)
            table = np.minimum(table[:-step], table[step:])
        now = np.flatnonzero(level == k)
        found[now] = np.minimum(table[low[now]], table[high[now] - (1 << k)])
    return found


def next_smaller(rank: np.ndarray, n: int) -> np.ndarray:
    """For each of the first `n` suffixes the next one that is smaller, or `n`: the end of its longest Lyndon word."""
    ranks, found, stack = rank.tolist(), [n] * n, []
    for i in range(n - 1, -1, -1):
        while stack and ranks[stack[-1]] > ranks[i]:
            stack.pop()
        if stack:
            found[i] = stack[-1]
        stack.append(i)
    return np.array(found, np.int64)


def runs_of(symbols: list[int], repeats: int = REPEATS, least: int = LEAST) -> Runs:
    """Starts, lengths and smallest periods of all runs with at least `repeats` periods (two at least)."""
    n = len(symbols)
    tree = SuffixTree(symbols)
    rank, returns = tree.tour()
    ends = np.concatenate([next_smaller(rank, n), next_smaller(tree.tour(descending=True)[0], n)])
    del tree
    begins = np.tile(np.arange(n), 2)
    periods = ends - begins
    right, left = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int64)
    inner = ends < n
    right[inner] = common_extensions(rank, returns, begins[inner], ends[inner])
    rank, returns = SuffixTree(symbols[::-1]).tour()
    inner = begins > 0
    left[inner] = common_extensions(rank, returns, n - begins[inner], n - ends[inner])
    starts, lengths = begins - left, periods + left + right
    kept = (lengths >= repeats * periods) & (lengths >= least)
    found = np.unique(np.stack([starts[kept], periods[kept], lengths[kept]], 1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def stretches(hashes: np.ndarray, words_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of words that can hold runs; none leaves its row."""
    starts, lengths = words_at[:-1], np.diff(words_at)
    total = -1
    while len(starts) and total != (total := int(lengths.sum())):
        words = _ranges(starts, lengths)
        part = np.repeat(np.arange(len(starts)), lengths)
        inside = np.flatnonzero(part[2:] == part[:-2]) if len(part) > 2 else np.zeros(0, np.int64)
        h = hashes[words]
        keys = mix(mix(mix(h[inside]) + h[inside + 1]) + h[inside + 2])
        keys = mix(keys + part[inside].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
        frequent = inside[counts[place] >= 3]
        breaks = np.flatnonzero((np.diff(frequent) > 1) | (np.diff(part[frequent]) > 0))
        low = frequent[np.concatenate(([0], breaks + 1))] if len(frequent) else frequent
        high = frequent[np.concatenate((breaks, [len(frequent) - 1]))] if len(frequent) else frequent
        long = high - low + 3 >= LEAST
        starts, lengths = words[low[long]], (high - low + 3)[long]
    return starts, starts + lengths


def chunk_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of a chunk by row, start and period, the n + 1 offsets of each row's runs, and the rows' words without
    repeats, joined by one space, with their offsets."""
    starts, ends, words_at = word_spans(data, offsets, WORD_BYTES)
    low, high = stretches(span_hash(prefix_hash(data), starts, ends), words_at)
    found = [np.zeros((0, 3), np.int64)]
    for a, b in zip(low.tolist(), high.tolist()):
        base = int(starts[a])
        raw = data[base:ends[b - 1]].tobytes()
        numbers: dict[bytes, int] = {}
        symbols = [
            numbers.setdefault(raw[s:e], len(numbers) + 1)
            for s, e in zip((starts[a:b] - base).tolist(), (ends[a:b] - base).tolist())
        ]
        begin, length, period = runs_of(symbols)
        found.append(np.stack([begin + a, period, length], 1))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    begin, period, length = runs.T
    runs_at = np.searchsorted(begin, words_at)

    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, begin + period, 1)
    np.add.at(edge, begin + length, -1)
    kept = np.cumsum(edge[:-1]) == 0
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(words_at))
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts[kept]] = 1
    inside[ends[kept]] -= 1
    mask = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    # The white space after a kept word that another one of its row follows becomes the joining space.
    kept_rows = row_of[kept]
    joins = ends[kept][:-1][kept_rows[1:] == kept_rows[:-1]]
    spaced = data.copy()
    spaced[joins] = 0x20
    mask[joins] = True
    text_at = np.concatenate(([0], np.cumsum(mask)))[offsets]
    first_word = words_at[:-1][np.repeat(np.arange(len(offsets) - 1), np.diff(runs_at))]
    return (begin - first_word, length, period), runs_at, spaced[mask], text_at


def word_runs(docs: DataFrame) -> DataFrame:
    """`doc_id`, `runs` (start, length and period, by start, then period) and `collapsed`: the text's words without
    those that a run repeats, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1)):
                found, runs_at, text, text_at = chunk_runs(data, offsets)
                runs = pa.ListArray.from_arrays(
                    pa.array(runs_at, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in found], ["start", "length", "period"]),
                )
                collapsed = pa.Array.from_buffers(
                    pa.binary(), end - first,
                    [None, pa.py_buffer(text_at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(text))],
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), runs, collapsed], ["doc_id", "runs", "collapsed"]
                )

    schema = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def longest_run() -> F.Column:
    """The run of `runs` with the greatest length; ties go to the smaller start, then the smaller period."""
    return F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"),
    )))


def run_digests(docs: DataFrame) -> DataFrame:
    """`word_runs` as counts, the longest run and digests."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("best")
    return word_runs(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest_run().alias("best"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", (-best["start"]).alias("start"), best["length"].alias("length"),
        (-best["period"]).alias("period"),
        F.expr("1000 * best.length DIV -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def cycled(docs: DataFrame) -> DataFrame:
    """`documents` in which one in ten texts, by a checksum of its id, cycles through a part of its own words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    cut = chosen.withColumns({"n": F.size("words"), "g": F.expr("h DIV 10")})
    cut = cut.withColumn("a", F.expr("IF(n > 0, g % n, 0)"))
    cut = cut.withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    text = F.expr(
        "array_join(transform(sequence(0L, CAST(n AS LONG) - 1),"
        " i -> element_at(words, CAST(1 + IF(i < a, i, a + (i - a) % p) AS INT))), ' ')"
    )
    return cut.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))
