"""Ranked lexical search: each item's best documents, by accumulator-limited term-at-a-time scoring.

One pass over the texts writes an index of blocks: for a run of documents, the postings (document, count) of every term
that some item asks for, sorted by term. Statistics of the collection come from the same rows. A second pass reads the
blocks. For one block and item the terms are taken rarest first; a term's postings add to one accumulator a document.
As soon as the bounds of the terms still to come cannot lift a new document to the kth partial score, no further
accumulator is made, and later terms only update the survivors. The kth best of a task's earlier blocks counts as a
partial score too. A document without an accumulator scores less than k others, so the result is exact.

Terms are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z in lower case, and are known by
their bytes. Null and empty texts hold no terms and are no documents of the collection. Equal scores go by ascending
`doc_id`, a null one last; rows that share an id are documents of their own. Equal rows of the item table count once; an
`item_id` with several texts gets one ranking a text. Items without terms, or without a match, give no rows. Empty
tables give an empty result, and other columns are left aside.

Items are taken in parts of at most `PART_BYTES` of text (or one longer item), so what is sent to the tasks stays
bounded; each part has an index of its own terms. A block is never longer than an Arrow batch of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadcast.llm.common import LOWER, byte_set, mix, prefix_hash, span_hash, store, text_chunks, word_spans

TERM_BYTES = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
# Text of the items that are searched together, and postings of a block; a longer batch of documents is several blocks.
PART_BYTES = 4 << 20
BLOCK_POSTINGS = 2_000_000

SCALE, PER_COUNT, PER_LENGTH = 1_000_000_000, 1000, 12
FLAT, SLOPE = 75, 25


@dataclass(frozen=True)
class Items:
    """Items of one part: their terms as positions in a sorted vocabulary, and how often each item holds them."""

    numbers: list[int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    spelling: list[bytes]

    @staticmethod
    def of(rows: list[tuple[int, str]]) -> Items:
        vocabulary: dict[bytes, int] = {}
        terms, repeats = [], []
        for _, text in rows:
            raw = LOWER[np.frombuffer(text.encode(), np.uint8)]
            starts, ends, _ = word_spans(raw, np.array([0, len(raw)]), TERM_BYTES)
            whole = raw.tobytes()
            found = [
                vocabulary.setdefault(whole[s:e], len(vocabulary)) for s, e in zip(starts.tolist(), ends.tolist())
            ]
            distinct, count = np.unique(np.array(found, np.int64), return_counts=True)
            terms.append(distinct)
            repeats.append(count)
        return Items([n for n, _ in rows], terms, repeats, list(vocabulary))


class Matcher:
    """Finds the terms of a vocabulary in bytes: a hash proposes a term, its bytes confirm it."""

    def __init__(self, spelling: list[bytes]):
        self.data = np.frombuffer(b"".join(spelling), np.uint8)
        ends = np.cumsum([len(s) for s in spelling], dtype=np.int64)
        starts = ends - np.array([len(s) for s in spelling], np.int64)
        hashes = span_hash(prefix_hash(self.data), starts, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts, self.ends = hashes[self.order], starts[self.order], ends[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each span's term, or -1."""
        found = np.full(len(starts), -1, np.int64)
        if not len(self.hashes) or not len(starts):
            return found
        hashes = span_hash(prefix_hash(data), starts, ends)
        low = np.searchsorted(self.hashes, hashes, "left")
        open_spans = np.flatnonzero(self.hashes[np.minimum(low, len(self.hashes) - 1)] == hashes)
        # Terms of one hash follow each other; a span tries them in turn.
        at = low[open_spans]
        while len(open_spans):
            same = self._equal(data, starts[open_spans], ends[open_spans], at)
            found[open_spans[same]] = self.order[at[same]]
            at, open_spans = at[~same] + 1, open_spans[~same]
            more = at < len(self.hashes)
            at, open_spans = at[more], open_spans[more]
            more = self.hashes[at] == hashes[open_spans]
            at, open_spans = at[more], open_spans[more]
        return found

    def _equal(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
        lengths = ends - starts
        same = lengths == self.ends[at] - self.starts[at]
        rows = np.flatnonzero(same)
        size = lengths[rows]
        before = np.cumsum(size) - size
        step = np.arange(int(size.sum()))
        here = step + np.repeat(starts[rows] - before, size)
        there = step + np.repeat(self.starts[at[rows]] - before, size)
        differs = np.add.reduceat(data[here] != self.data[there], before) if len(rows) else np.zeros(0, np.int64)
        same[rows] = differs == 0
        return same


INDEX = "doc_ids array<long>, lengths binary, terms binary, bounds binary, places binary, counts binary, n_terms long"


def _blocks(docs: DataFrame, spelling: list[bytes]) -> DataFrame:
    """The index: one row a block. `places` and `counts` are postings by term, `bounds` their borders."""

    def block(ids: list, lengths: list, keys: list) -> pa.RecordBatch:
        doc_ids, n = pa.chunked_array(ids).combine_chunks(), np.concatenate(lengths)
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        term, place = np.divmod(key, np.int64(1 << 32))
        terms, bounds = np.unique(term, return_index=True)
        bounds = np.append(bounds, len(term))
        columns = [n.astype("<i8"), terms.astype("<i4"), bounds.astype("<i4"), place.astype("<i4"), count.astype("<i8")]
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                *(pa.array([c.tobytes()], pa.binary()) for c in columns), pa.array([int(n.sum())], pa.int64()),
            ],
            ["doc_ids", "lengths", "terms", "bounds", "places", "counts", "n_terms"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(spelling)
        for batch in batches:
            ids, lengths, keys, rows, held = [], [], [], 0, 0
            for first, end, data, offsets in text_chunks(batch.column(1)):
                data = LOWER[data]
                starts, ends, words_at = word_spans(data, offsets, TERM_BYTES)
                n = np.diff(words_at)
                spoken = n > 0
                # Documents without a term are left out of the block.
                number = np.cumsum(spoken) - 1 + rows
                term = matcher.find(data, starts, ends)
                hit = term >= 0
                keys.append((term[hit] << 32) + np.repeat(number, n)[hit])
                ids.append(batch.column(0).slice(first, end - first).filter(pa.array(spoken)))
                lengths.append(n[spoken])
                rows += int(spoken.sum())
                held += len(keys[-1])
                if held >= BLOCK_POSTINGS:
                    yield block(ids, lengths, keys)
                    ids, lengths, keys, rows, held = [], [], [], 0, 0
            if rows:
                yield block(ids, lengths, keys)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)


def _statistics(index: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents, their terms, and the document frequency of each of the part's terms."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, bounds in zip(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(terms.as_py(), "<i4").astype(np.int64)),
                    pa.array(np.diff(np.frombuffer(bounds.as_py(), "<i4")).astype(np.int64)),
                ], ["term", "df"])

    sizes = index.agg(F.sum(F.size("doc_ids")).alias("n"), F.sum("n_terms").alias("l")).first()
    df = index.select("terms", "bounds").mapInArrow(frequencies, "term long, df long")
    return sizes.n or 0, sizes.l or 0, {r.term: r.df for r in df.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def weight_of(n_documents: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_documents + 2) / (2 * df + 1))).astype(np.int64)


def best_of_block(
    terms: list[tuple[int, np.ndarray, np.ndarray]], rows: int, k: int, floor: int,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and exact scores of a block's documents that can be among the best `k`, and the accumulators made.

    `terms` are (bound, places, gains), rarest first; `floor` is a score that k other documents reach already.
    """
    scores = np.zeros(rows, np.int64)
    live = np.zeros(rows, bool)
    rest = sum(bound for bound, _, _ in terms)
    made, growing = 0, True
    for bound, places, gains in terms:
        if growing:
            kth = floor
            if made >= k:
                partial = scores[live]
                kth = max(kth, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
            # Equal scores can still win by their id.
            growing = rest >= kth
        if growing:
            live[places] = True
            made = int(np.count_nonzero(live))
        else:
            survives = live[places]
            places, gains = places[survives], gains[survives]
        scores[places] += gains
        rest -= bound
    found = np.flatnonzero(live & (scores > 0) & (scores >= floor))
    return found, scores[found], made


def _ranked(index: DataFrame, items: Items, n_documents: int, n_terms: int, df: dict[int, int], k: int) -> DataFrame:
    """The best `k` documents of every item in each task: `item`, `doc_id`, `score`."""
    frequency = np.array([df.get(t, 0) for t in range(len(items.spelling))], np.int64)
    weights = weight_of(n_documents, frequency)
    # Rarest first; terms that no document holds add nothing.
    orders = []
    for terms, repeats in zip(items.terms, items.repeats):
        kept = terms[frequency[terms] > 0]
        order = np.lexsort((kept, frequency[kept]))
        orders.append((kept[order], (weights[terms] * repeats)[frequency[terms] > 0][order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per item its best documents so far: scores, ids, and whether an id is null.
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * len(orders)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column(0)[row].values
                n, terms, bounds, places, counts = (
                    np.frombuffer(batch.column(c)[row].as_buffer(), kind)
                    for c, kind in zip(range(1, 6), ("<i8", "<i4", "<i4", "<i4", "<i8"))
                )
                none = np.asarray(ids.is_null())
                ids = np.asarray(ids.fill_null(0))
                m = FLAT + SLOPE * n * n_documents // n_terms
                gain = SCALE * counts // (PER_COUNT * counts + PER_LENGTH * m[places])
                most = np.maximum.reduceat(gain, bounds[:-1]) if len(terms) else gain
                for item, (wanted, weight) in enumerate(orders):
                    at = np.searchsorted(terms, wanted)
                    here = np.flatnonzero(terms[np.minimum(at, len(terms) - 1)] == wanted) if len(terms) else []
                    lists = []
                    for j in here:
                        low, high = bounds[at[j]], bounds[at[j] + 1]
                        lists.append((int(weight[j] * most[at[j]]), places[low:high], weight[j] * gain[low:high]))
                    old = best[item]
                    floor = int(old[0][k - 1]) if len(old[0]) >= k else 0
                    found, scores, _ = best_of_block(lists, len(n), k, floor)
                    if len(found):
                        new = [np.concatenate(pair) for pair in zip(old, (scores, ids[found], none[found]))]
                        order = np.lexsort((new[1], new[2], -new[0]))[:k]
                        best[item] = tuple(c[order] for c in new)
        for item, (scores, ids, none) in enumerate(best):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(scores), item)), pa.array(ids, mask=none), pa.array(scores),
            ], ["item", "doc_id", "score"])

    return index.select("doc_ids", "lengths", "terms", "bounds", "places", "counts").mapInArrow(
        run, "item long, doc_id long, score long"
    )


def _parts(spark: SparkSession, items: DataFrame, part_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Distinct items in parts of at most `part_bytes` of text, or of one longer item."""
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows: list[tuple[int, str]] = []
    size = 0
    for r in wanted.distinct().orderBy("item_id", "text").toLocalIterator():
        length = len(r.text.encode())
        if rows and size + length > part_bytes:
            yield rows
            rows, size = [], 0
        rows.append((r.item_id, r.text))
        size += length
    if rows:
        yield rows


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, part_bytes: int = PART_BYTES) -> DataFrame:
    """`item_id`, `rank`, `doc_id`, `score`: the `k` documents with the highest scores above 0 of every item."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for rows in _parts(spark, items, part_bytes):
        part = Items.of(rows)
        index = store(_blocks(docs, part.spelling), "lexical-index")
        n_documents, n_terms, df = _statistics(index)
        if not n_documents:
            continue
        local = _ranked(index, part, n_documents, n_terms, df, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(part.numbers)), "item long, item_id long")
        best = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = found.unionByName(store(best, "ranked"))
    return found
