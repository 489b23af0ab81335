"""Quality rules: fixed rules first, then boosted trees over document statistics.

The trees are fitted here, on labelled documents, by histograms of feature values; along chosen features a score may
only fall. They are flattened into arrays of nodes, and a batch of documents walks them level by level in numpy.

Words are cut at ASCII white space. Null and empty texts have no words and fail the base rule. Equal rows are judged
alike. If no labels are given, or all are equal, the base rule alone decides. A document that is labelled twice counts
twice in the fit; null labels are left out. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import (
    WORD_BYTES, byte_set, line_spans, mix, text_chunks, tidily, word_hash, word_spans,
)

# Labelled documents that the trees are fitted on, chosen by a hash of the id; the bound does not grow with the data.
FIT_ROWS = 20_000
MIN_WORDS = 50
THRESHOLD = 0.5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "line_words", "distinct_share",
    "upper_share", "digit_share", "mark_share", "long_share", "wide_share", "top_share",
)
# A document with more of these is never better.
FALLING = ("symbol_share", "dup_line_share", "repeat_share")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _DIGIT = byte_set((65, 90)), byte_set((48, 57))
_MARK = byte_set((33, 47), (58, 64), (91, 96), (123, 126))


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of flags between the offsets."""
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[offsets])


def _groups(hashes: np.ndarray, row_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every item how often its row holds it; the row of each distinct item, and its count."""
    keys = mix(hashes + row_of.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    _, first, place, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return counts[place], row_of[first], counts


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The base counts and the features of every row, as columns of two matrices."""
    rows = len(offsets) - 1
    starts, ends, words_at = word_spans(data, offsets, WORD_BYTES)
    n_words = np.diff(words_at)
    row_of = np.repeat(np.arange(rows), n_words)
    word = WORD_BYTES[data] if len(data) else np.zeros(0, bool)
    leading = (data & 0xC0) != 0x80
    word_chars = _per_row(word & leading, offsets)
    n_symbols = _per_row(_SYMBOL[data], offsets)

    first, last, lines_at = line_spans(data, offsets)
    spoken = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    line_row = np.repeat(np.arange(rows), np.diff(lines_at))[spoken]
    n_lines = np.bincount(line_row, minlength=rows)
    _, distinct_row, _ = _groups(word_hash(data, first[spoken], last[spoken]), line_row)
    n_dup_lines = n_lines - np.bincount(distinct_row, minlength=rows)

    hashes = word_hash(data, starts, ends)
    covered = np.zeros(len(hashes), bool)
    if len(hashes) > 2:
        inside = row_of[2:] == row_of[:-2]
        triple = mix(mix(mix(hashes[:-2]) + hashes[1:-1]) + hashes[2:])[inside]
        at = np.flatnonzero(inside)
        again = at[_groups(triple, row_of[at])[0] > 1]
        for k in range(3):
            covered[again + k] = True
    n_repeat = _per_row(covered, words_at)
    _, word_row, word_count = _groups(hashes, row_of)
    n_distinct = np.bincount(word_row, minlength=rows)
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, word_row, word_count)

    base = np.stack([n_words, word_chars, n_symbols, n_dup_lines, n_repeat], 1).astype(np.int64)
    chars, count = np.maximum(word_chars, 1), np.maximum(n_words, 1)
    features = np.stack([
        np.log1p(n_words), word_chars / count, n_symbols / chars, n_dup_lines / np.maximum(n_lines, 1),
        n_repeat / count, n_words / np.maximum(n_lines, 1), n_distinct / count,
        _per_row(_UPPER[data], offsets) / chars, _per_row(_DIGIT[data], offsets) / chars,
        _per_row(_MARK[data], offsets) / chars, _per_row(ends - starts > 20, words_at) / count,
        _per_row(leading & (data >= 0x80), offsets) / chars, most / count,
    ], 1)
    return base, features


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees in arrays; a leaf names itself as both children."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, features: np.ndarray) -> np.ndarray:
        """The probability of good quality of every row."""
        at = np.broadcast_to(self.roots, (len(features), len(self.roots))).copy()
        rows = np.arange(len(features))[:, None]
        for _ in range(self.depth):
            go_left = features[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(go_left, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(1))))


def fit_trees(
    features: np.ndarray, labels: np.ndarray, falling: tuple[int, ...], trees: int = 60, depth: int = 4,
    rate: float = 0.2, bins: int = 64, least: float = 2.0,
) -> Trees | None:
    """Boosted trees on logistic loss, or None if the labels do not differ."""
    if not len(labels) or labels.min() == labels.max():
        return None
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in features.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, features.T)], 1)
    share = labels.mean()
    start = float(np.log(share / (1 - share)))
    logit = np.full(len(labels), start)
    nodes: list[list] = []
    roots = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        gradient, weight = labels - p, p * (1 - p)

        def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
            g, h = gradient[rows].sum(), weight[rows].sum()
            value = float(np.clip(g / (h + 1), low, high))
            number = len(nodes)
            nodes.append([0, np.inf, number, number, value * rate])
            best = (1e-6, None)
            if level < depth:
                for f, edge in enumerate(edges):
                    if not len(edge):
                        continue
                    gs = np.cumsum(np.bincount(binned[rows, f], gradient[rows], len(edge) + 1))[:-1]
                    hs = np.cumsum(np.bincount(binned[rows, f], weight[rows], len(edge) + 1))[:-1]
                    a, b = np.clip(gs / (hs + 1), low, high), np.clip((g - gs) / (h - hs + 1), low, high)
                    gain = (
                        2 * gs * a - (hs + 1) * a * a + 2 * (g - gs) * b - (h - hs + 1) * b * b
                        - (2 * g * value - (h + 1) * value * value)
                    )
                    gain[(hs < least) | (h - hs < least)] = -np.inf
                    if f in falling:
                        gain[a < b] = -np.inf
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (gain[k], (f, k, a[k], b[k]))
            if best[1] is None:
                logit[rows] += value * rate
                return number
            f, k, a, b = best[1]
            middle = (a + b) / 2
            # Below a split on a falling feature the two sides stay apart.
            left_low, right_high = (max(low, middle), min(high, middle)) if f in falling else (low, high)
            goes_left = binned[rows, f] <= k
            left = grow(rows[goes_left], level + 1, left_low, high)
            right = grow(rows[~goes_left], level + 1, low, right_high)
            nodes[number][:4] = [f, edges[f][k], left, right]
            return number

        roots.append(grow(np.arange(len(labels)), 0, -8.0, 8.0))
    feature, threshold, left, right, value = map(np.array, zip(*nodes))
    return Trees(feature, threshold, left, right, value, np.array(roots), depth, start)


def _measure(df: DataFrame, keep: list[str], schema: str, make) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(len(keep))):
                kept = [batch.column(i).slice(first, end - first) for i in range(len(keep))]
                names, columns = make(*statistics(data, offsets))
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, columns)], names=[*keep, *names])

    return df.select(*keep, "text").mapInArrow(tidily(run), schema)


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Trees | None:
    """Trees fitted on at most `rows` labelled documents; only their statistics come to the driver."""
    chosen = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "quality"
    ).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    schema = "doc_id long, quality integer, " + ", ".join(f"{f} double" for f in FEATURES)
    measured = _measure(
        labelled.select("doc_id", F.col("quality").cast("int").alias("quality"), "text"), ["doc_id", "quality"],
        schema, lambda base, features: (FEATURES, features.T),
    )
    # Documents that share an id could be more than were chosen.
    table = measured.limit(2 * rows).toPandas().sort_values(["doc_id", "quality", *FEATURES], kind="stable")
    return fit_trees(
        table[list(FEATURES)].to_numpy(np.float64), (table["quality"].to_numpy() > 0).astype(float),
        tuple(FEATURES.index(f) for f in FALLING),
    )


def judge(docs: DataFrame, trees: Trees | None, threshold: float = THRESHOLD) -> DataFrame:
    """Base counts, `base_failed`, `kept` and the trees' `quality_score` per row."""

    def make(base: np.ndarray, features: np.ndarray):
        n_words, repeat = base[:, 0], base[:, 4]
        failed = (n_words < MIN_WORDS) | (100 * repeat > 50 * n_words)
        score = trees.score(features) if trees is not None else np.ones(len(base))
        return [*BASE, "base_failed", "kept", "quality_score"], [*base.T, failed, ~failed & (score >= threshold), score]

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE)
    schema += ", base_failed boolean, kept boolean, quality_score double"
    return _measure(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], schema, make)


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return judge(docs, fit_quality(docs, labels), threshold)


def keep_good(docs: DataFrame, trees: Trees | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that pass the base rule and the trees, with all their columns."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(names.index("text"))):
                base, features = statistics(data, offsets)
                good = (base[:, 0] >= MIN_WORDS) & (100 * base[:, 4] <= 50 * base[:, 0])
                if trees is not None:
                    good &= trees.score(features) >= threshold
                yield batch.slice(first, end - first).filter(pa.array(good))

    return docs.mapInArrow(tidily(run), docs.schema)
