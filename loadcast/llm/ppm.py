"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to `ORDER` bytes with the symbols that followed them in the training texts.
A symbol that a context has not seen escapes to the context without its first byte; the escape takes as many parts as
the context has distinct symbols (method C), and symbols seen by the longer context are left out below it. Below the
empty context all remaining symbols are equally likely. Texts begin after, and end with, byte 0xFF, which no UTF-8
text holds.

Probabilities depend on a context and its symbol only, so each distinct pair is scored once: counts are gathered over
all documents, and contexts that end in the same three bytes are scored in one task together with others, so that the
pairs of a task stay near a stated number. Three bytes leave 256 ** 3 pairs at most, which bounds the largest task too.
What follows the two last bytes comes along as a table, the shorter contexts, at most 65,792 rows, with the code.
Documents are scored in blocks. A block asks for the pairs and words that it holds, and gets just their values, so no
task needs the whole model.

The base score is a word model with one added to every count: words are cut at ASCII white space, A-Z is lower-cased,
and one end follows every text. Null text is empty, with the end as its only token. A null doc_id has no checksum
and is for training. Equal rows are counted and scored each. Words and sets are told apart by 64-bit hashes. Without
training rows, symbols are equally likely and the base sees an end alone. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import LOWER, WORD_BYTES, release_memory, store, text_chunks, word_hash, word_spans

ORDER = 5
EDGE = 0xFF
SYMBOLS = 256
# Keys of words are negative, keys of contexts with their symbols are not.
TOKEN_BIT = np.uint64(1 << 63)
# Key that stands for the end of a text among the words.
END_TOKEN = -1
# Text bytes per block, keys that a task holds before it hands them on, and keys scored together on average.
BLOCK_BYTES, HELD_KEYS, SCORED_KEYS = 32 << 20, 3_000_000, 500_000


def grams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Context and symbol at every place of every lower-cased text, packed with the symbol in the lowest byte, and the
    n + 1 offsets of the rows. The end of each text is a place of its own."""
    rows = len(offsets) - 1
    pad = order + 1
    symbols = np.full(len(data) + rows * pad, EDGE, np.uint8)
    row_of = np.repeat(np.arange(rows), np.diff(offsets))
    symbols[np.arange(len(data)) + row_of * pad + order] = LOWER[data]
    packed = np.zeros(len(symbols), np.int64)
    for k in range(order + 1):
        packed[k:] |= symbols[:len(symbols) - k].astype(np.int64) << (8 * k)
    place = np.ones(len(symbols), bool)
    heads = offsets[:-1] + np.arange(rows) * pad
    for k in range(order):
        place[heads + k] = False
    return packed[place], offsets + np.arange(rows + 1)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all lower-cased words, and the n + 1 offsets of the rows; the ends are not among them."""
    low = LOWER[data]
    starts, ends, rows = word_spans(low, offsets, WORD_BYTES)
    return (word_hash(low, starts, ends) | TOKEN_BIT).view(np.int64), rows


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts, with three arrays of the keys' length at most."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    del order
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[heads], np.add.reduceat(counts, heads)


def _counted(column: pa.Array, trained: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys and their counts in training rows, for chunks of rows."""
    for first, end, data, offsets in text_chunks(column):
        use = trained[first:end]
        packed, places = grams(data, offsets)
        yield _summed(packed, np.repeat(use, np.diff(places)))
        words, rows = tokens(data, offsets)
        yield _summed(words, np.repeat(use, np.diff(rows)))


def count_keys(rows: DataFrame) -> DataFrame:
    """`(block, key, n)`: every context with its symbol and every word of a block, and how often training texts hold
    it. `rows` has block, trained and text; a task keeps one block's keys at a time where its rows stand together."""

    def out(block: int, parts: list) -> pa.RecordBatch:
        keys, counts = _summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))
        block = np.full(len(keys), block, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(block), pa.array(keys), pa.array(counts)], ["block", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            trained = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for block in np.unique(blocks).tolist():
                at = np.flatnonzero(blocks == block)
                column = batch.column(2) if len(at) == len(blocks) else batch.column(2).take(pa.array(at))
                parts = held.setdefault(block, [])
                for part in _counted(column, trained[at]):
                    parts.append(part)
                    if sum(len(k) for k, _ in parts) > HELD_KEYS:
                        merged = _summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))
                        parts[:] = [merged]
                        if len(merged[0]) > HELD_KEYS * 3 // 4:
                            yield out(block, parts)
                            parts.clear()
            for block in [b for b in held if b != blocks[-1]]:
                parts = held.pop(block)
                if parts:
                    yield out(block, parts)
        while held:
            block, parts = held.popitem()
            if parts:
                batch = out(block, parts)
                del parts
                yield batch
        batch = None
        release_memory()

    return rows.select("block", "trained", "text").mapInArrow(run, "block int, key long, n long")


class Contexts:
    """Sums of one order over sorted distinct (context, symbol) pairs: totals and distinct symbols by context."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray):
        seen = counts > 0
        self.pairs, self.counts = pairs[seen], counts[seen]
        contexts = self.pairs >> 8
        heads = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1]))) if len(contexts) else \
            np.zeros(0, np.int64)
        self.contexts = contexts[heads]
        self.totals = np.add.reduceat(self.counts, heads) if len(heads) else heads
        self.kinds = np.diff(np.append(heads, len(contexts)))

    @staticmethod
    def _find(sorted_keys: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not len(sorted_keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        return np.where(sorted_keys[at] == keys, values[at], 0)

    def count(self, pairs: np.ndarray) -> np.ndarray:
        return self._find(self.pairs, self.counts, pairs)

    def total(self, contexts: np.ndarray) -> np.ndarray:
        return self._find(self.contexts, self.totals, contexts)

    def kind_count(self, contexts: np.ndarray) -> np.ndarray:
        return self._find(self.contexts, self.kinds, contexts)


def shorter(pairs: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs with contexts of `order` bytes, and their summed counts."""
    return _summed(pairs & ((1 << 8 * (order + 1)) - 1), counts)


def log_probabilities(pairs: np.ndarray, levels: list[Contexts]) -> np.ndarray:
    """log10 of each symbol after its context. `levels` holds the contexts from the empty one to the longest."""
    result = np.zeros(len(pairs))
    waiting = np.arange(len(pairs))
    above: Contexts | None = None
    for order in range(len(levels) - 1, -1, -1):
        level = levels[order]
        own = pairs[waiting] & ((1 << 8 * (order + 1)) - 1)
        contexts = own >> 8
        total, kinds = level.total(contexts), level.kind_count(contexts)
        if above is not None:
            # What the longer context has seen is left out here.
            longer = (pairs[waiting] & ((1 << 8 * (order + 2)) - 1)) >> 8
            out = level.count(above.pairs & ((1 << 8 * (order + 1)) - 1))
            heads = np.searchsorted(above.pairs >> 8, above.contexts)
            left_out = np.add.reduceat(out, heads) if len(heads) else heads
            total = total - Contexts._find(above.contexts, left_out, longer)
            kinds = kinds - above.kind_count(longer)
        count = level.count(own)
        found = count > 0
        parts = total + kinds
        usable = parts > 0
        result[waiting[found]] += np.log10(count[found] / parts[found])
        fled = ~found & usable
        result[waiting[fled]] += np.log10(kinds[fled] / parts[fled])
        waiting, above = waiting[~found], level
    remaining = SYMBOLS - len(levels[0].pairs)
    result[waiting] -= math.log10(max(remaining, 1))
    return result


def gram_scores(counts: DataFrame) -> DataFrame:
    """`(key, value)`: log10 of the symbol after its context, for every gram of `(key, n)`, each of which is one row."""
    low = counts.groupBy(F.col("key").bitwiseAND(0xFFFF).alias("key")).agg(F.sum("n").alias("n"))
    rows = low.collect()
    pairs = np.array([r.key for r in rows], np.int64)
    shared_pairs, shared_counts = _summed(pairs, np.array([r.n for r in rows], np.int64))

    def run(group: pa.Table, seconds: pa.Table) -> pa.Table:
        keys, n = _summed(group.column("key").to_numpy(), group.column("n").to_numpy())
        levels = [Contexts(*shorter(shared_pairs, shared_counts, k)) for k in range(2)]
        levels.append(Contexts(*_summed(seconds.column("pair").to_numpy(), seconds.column("n").to_numpy())))
        levels += [Contexts(*shorter(keys, n, k)) for k in range(3, ORDER + 1)]
        scored = pa.table({"key": keys, "value": log_probabilities(keys, levels)})
        del levels, n
        release_memory()
        return scored

    parts = max(1, math.ceil(counts.count() / SCORED_KEYS))
    pair = F.col("key").bitwiseAND(0xFFFFFF)
    third = F.shiftright("key", 8).bitwiseAND(0xFFFFFF)
    grouped = counts.select("key", "n", F.pmod(F.xxhash64(third), F.lit(parts)).alias("part"))
    seconds = counts.groupBy(pair.alias("pair")).agg(F.sum("n").alias("n"))
    seconds = seconds.withColumn("near", F.shiftright("pair", 8))
    wanted = grouped.select("part", F.shiftright("key", 8).bitwiseAND(0xFFFF).alias("near")).distinct()
    seconds = wanted.join(seconds, "near").select(F.col("part").alias("place"), "pair", "n")
    return grouped.groupBy("part").cogroup(seconds.groupBy("place")).applyInArrow(run, "key long, value double")


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score_block(docs: pa.Table, values: pa.Table, total: int, kinds: int) -> pa.Table:
    key = values.column("key").to_numpy()
    order = np.argsort(key)
    key, value = key[order], values.column("value").to_numpy()[order]
    del values, order
    words_end = int(np.searchsorted(key, 0))
    word_keys, word_counts, gram_keys, gram_logs = key[:words_end], value[:words_end], key[words_end:], value[words_end:]
    end_count = float(word_counts[-1]) if words_end and word_keys[-1] == END_TOKEN else 0.0
    scale = math.log10(total + kinds + 1)
    columns = {c: [] for c in ("n_tokens", "n_known", "base_score", "score")}
    for text in docs.column("text").chunks:
        for _, _, data, offsets in text_chunks(text):
            packed, places = grams(data, offsets)
            logs = gram_logs[np.searchsorted(gram_keys, packed)]
            columns["score"].append(np.add.reduceat(logs, places[:-1]))
            words, rows = tokens(data, offsets)
            counts = word_counts[np.searchsorted(word_keys, words)] if len(words) else np.zeros(0)
            # Ends are put in as one more token per row.
            counts = np.insert(counts, rows[1:], end_count)
            heads = rows[:-1] + np.arange(len(rows) - 1)
            columns["base_score"].append(np.add.reduceat(np.log10(counts + 1) - scale, heads))
            columns["n_known"].append(np.add.reduceat((counts > 0).astype(np.int64), heads))
            columns["n_tokens"].append(np.diff(rows) + 1)
    merged = {c: np.concatenate(v) if v else np.zeros(0) for c, v in columns.items()}
    del key, value, word_keys, word_counts, gram_keys, gram_logs
    release_memory()
    return pa.table([
        docs.column("doc_id"), docs.column("held_out"), pa.array(merged["n_tokens"], pa.int64()),
        pa.array(merged["n_known"], pa.int64()), pa.array(merged["base_score"], pa.float64()),
        pa.array(merged["score"], pa.float64()),
    ], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Fold 2 of 7 by the checksum of the id's digits."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def file_blocks(df: DataFrame, block_bytes: int = BLOCK_BYTES) -> Column:
    """Blocks of rows that stand together in the files of a table read from files, of about `block_bytes` text."""
    size = df.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    rows = max(1, round(block_bytes * size.n / max(size.b or 1, 1)))
    return F.hash("_metadata.file_path", F.floor(F.col("_metadata.row_index") / rows))


def score_documents(df: DataFrame, block: Column, out_of_fold: Column) -> DataFrame:
    """`SCORES` and `train_tokens` per row of `df` (doc_id, text). `block` must give a row the same value whenever it
    is read."""
    docs = df.select(
        block.cast("int").alias("block"), F.col("doc_id").cast("long").alias("doc_id"), out_of_fold.alias("held_out"),
        "text",
    )
    keys = store(count_keys(docs.select("block", (~F.col("held_out")).alias("trained"), "text")), "keys")
    counts = store(keys.groupBy("key").agg(F.sum("n").alias("n")), "counts")
    ends = docs.agg(F.count_if(~F.col("held_out"))).first()[0]
    words = counts.filter((F.col("key") < 0) & (F.col("n") > 0)).agg(F.sum("n"), F.count("*")).first()
    total, kinds = (words[0] or 0) + ends, words[1] + (1 if ends else 0)
    values = gram_scores(counts.filter(F.col("key") >= 0)).union(
        counts.filter(F.col("key") < 0).select("key", F.col("n").cast("double"))
    )
    # A key can come from a block more than once if several tasks read the block.
    asked = keys.select("block", "key").join(values, "key").select("block", "key", "value")
    last = docs.select("block").distinct().select(
        "block", F.lit(END_TOKEN).cast("long").alias("key"), F.lit(float(ends)).alias("value")
    )
    asked = asked.union(last)
    result = docs.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        lambda left, right: _score_block(left, right, total, kinds), SCORES
    )
    return result.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score",
        "score",
    )
