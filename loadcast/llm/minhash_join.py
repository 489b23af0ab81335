"""Near-duplicate documents: MinHash signatures joined by a multi-index search under Hamming distance.

Every document is the set of its distinct word shingles. A signature holds `CHUNKS * WIDTH` symbols of `BITS` bits. Two
signatures that differ in at most `2 * CHUNKS - 1` symbols have, by the pigeonhole principle, a chunk with at most one
differing symbol, so listing each chunk with any one symbol left open finds every such pair. More distant pairs are
found too unless all chunks differ twice: at a similarity of 0.8 one pair in 40,000 is missed. A pair becomes a link
only after comparing the full sets.

Documents with equal sets are one class and enter the search once. Small buckets are compared pair by pair; a large
bucket is compared with its most central member, the pivot, first. Classes that are in one component by then need no
comparison. The others meet through what sets them apart: the shingles that only one of a class and its pivot holds.
Two linked classes of which one is not linked with the pivot must share such a shingle, and one among their rarest.
Where many share one, they are compared with one of them first, again and again as long as that joins them, so a group
of thousands of near copies never turns into all its pairs.

Words are cut at ASCII white space and A-Z is lower-cased. A document with fewer words than a shingle has one shingle,
its whole text; one without words, or with null text, has none and is linked with nothing. Equal rows are one class.
Rows without a doc_id take part; the group's id is its smallest doc_id, or null if it has none. Sets are told apart by
64-bit hashes of shingles and of sets. Extra columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import (
    LOWER, WORD_BYTES, components, mix, store, text_chunks, tidily, word_hash, word_spans,
)
from loadcast.session import lookup, materialize

CHUNKS, WIDTH, BITS = 8, 5, 16
SYMBOLS = CHUNKS * WIDTH
# Buckets up to this size are compared pair by pair at once; larger ones first with one central member.
SMALL_BUCKET = 8
# Rows that share a shingle of their deltas, per part that meets them all in one task.
PART_ROWS = 5_000

_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(0, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHAIN = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(
    words: np.ndarray, counts: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, row after row and with repeats, and the n + 1 offsets of the rows."""
    each = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    offsets = np.concatenate(([0], np.cumsum(each)))
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    starts = np.repeat(first - offsets[:-1], each) + np.arange(offsets[-1])
    length = np.repeat(np.minimum(counts, size), each)
    total = np.zeros(len(starts), np.uint64)
    for j in range(size):
        inside = length > j
        if inside.all():
            total += words[starts + j] * _CHAIN[j]
        else:
            total[inside] += words[starts[inside] + j] * _CHAIN[j]
    return mix(total + length.astype(np.uint64)), offsets


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = LOWER[data]
    starts, ends, rows = word_spans(low, offsets, WORD_BYTES)
    return word_hash(low, starts, ends), np.diff(rows)


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of symbols per non-empty document: low bits of the scrambled minimum under each permutation."""
    heads = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(heads), SYMBOLS), np.int32)
    for k, factor in enumerate(_FACTORS):
        lowest = np.minimum.reduceat(hashes * factor, heads)
        out[:, k] = (mix(lowest) & np.uint64((1 << BITS) - 1)).astype(np.int32)
    return out


SIGNED = "doc_id long, text_key long, n_shingles long, node long, signature array<int>"


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def sign_table(df: DataFrame, shingle: int) -> DataFrame:
    """Set size, set hash and signature of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(2)):
                hashes, places = shingle_hashes(*_word_hashes(data, offsets), shingle)
                sizes, nodes = [], []
                for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
                    distinct = np.unique(hashes[a:b])
                    sizes.append(len(distinct))
                    digest = hashlib.blake2b(distinct.tobytes(), digest_size=8).digest()
                    nodes.append(int.from_bytes(digest, "little", signed=True) if b > a else None)
                full = np.diff(places) > 0
                symbols = signatures(hashes, places) if full.any() else np.zeros((0, SYMBOLS), np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first),
                    pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                    _lists(symbols.ravel(), np.concatenate(([0], np.cumsum(full * SYMBOLS))), pa.int32()),
                ], names=["doc_id", "text_key", "n_shingles", "node", "signature"])

    rows = df.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(tidily(run), SIGNED)


def _chunk_keys(classes: DataFrame) -> DataFrame:
    """Every chunk of a signature with any one of its symbols left open, as `(key, spot, node)`; `spot` is the place
    of the open symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64))
        for batch in batches:
            if not batch.num_rows:
                continue
            symbols = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, SYMBOLS).astype(np.uint64)
            keys = np.empty(symbols.shape, np.uint64)
            for c in range(CHUNKS):
                chunk = symbols[:, c * WIDTH:(c + 1) * WIDTH]
                for j in range(WIDTH):
                    total = np.full(len(chunk), salt[c * WIDTH + j], np.uint64)
                    for i in range(WIDTH):
                        if i != j:
                            total += (chunk[:, i] + np.uint64(1)) * _CHAIN[i]
                    keys[:, c * WIDTH + j] = mix(total)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys.ravel().view(np.int64)),
                pa.array(np.tile(np.arange(SYMBOLS, dtype=np.int32), len(keys))),
                pa.array(np.repeat(batch.column(0).to_numpy(), SYMBOLS)),
            ], names=["key", "spot", "node"])

    return classes.select("node", "signature").mapInArrow(tidily(run), "key long, spot int, node long")


def shingle_sets(df: DataFrame, shingle: int) -> DataFrame:
    """`(node, shingles)`: the distinct shingle hashes of each row that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                hashes, places = shingle_hashes(*_word_hashes(data, offsets), shingle)
                sets = [np.unique(hashes[a:b]) for a, b in zip(places[:-1], places[1:]) if b > a]
                nodes = [
                    int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                    for s in sets
                ]
                flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), _lists(flat, ends, pa.int64())], names=["node", "shingles"]
                )

    return df.select("text").mapInArrow(tidily(run), "node long, shingles array<long>")


def _compared(
    pairs: DataFrame, classes: DataFrame, df: DataFrame, shingle: int, deltas: bool = False
) -> DataFrame:
    """`(a, b, n_a, n_b, common)`: the pairs with the sizes of their full sets and of what both hold, stored. With
    `deltas`, also `delta`, what one of the two holds and the other does not."""
    pairs = store(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    need = lookup(classes.join(nodes, "node", "left_semi").select("text_key", "first_id"))
    texts = df.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    texts = texts.join(
        need, (texts["text_key"] == need["text_key"]) & texts["doc_id"].eqNullSafe(need["first_id"]), "left_semi"
    )
    sets = store(shingle_sets(texts, shingle), "sets").dropDuplicates(["node"])
    # Pairs are narrow but costly to compare, so they are spread by a stated number.
    pairs = pairs.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    counts = both.select(
        "a", "b", F.size("set_a").alias("n_a"), F.size("set_b").alias("n_b"),
        F.size(F.array_intersect("set_a", "set_b")).alias("common"),
        *([F.concat(F.array_except("set_a", "set_b"), F.array_except("set_b", "set_a")).alias("delta")]
          if deltas else []),
    )
    return store(counts, "compared")


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    linked = F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent
    return compared.filter(linked).select("a", "b")


def _candidate(percent: int) -> Column:
    """Whether a pair of bucket rows, `x` and `y`, can be a link and meets here first: no earlier chunk has one symbol
    at most that differs, and of a chunk without differences only the first key counts."""
    def differs(place) -> Column:
        return (F.get("x.signature", place) != F.get("y.signature", place)).cast("int")

    chunk, spot = F.col("x.spot") / WIDTH, F.col("x.spot")
    per_chunk = [sum((differs(F.lit(c * WIDTH + j)) for j in range(1, WIDTH)), differs(F.lit(c * WIDTH)))
                 for c in range(CHUNKS)]
    first = (spot % WIDTH == 0) | (differs(spot) == 1)
    for c in range(CHUNKS - 1):
        first = first & ((F.floor(chunk) <= c) | (per_chunk[c] > 1))
    sizes = F.least("x.n_shingles", "y.n_shingles") * 100 >= F.greatest("x.n_shingles", "y.n_shingles") * percent
    return sizes & first


def _small_bucket_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """All candidates among buckets of a few rows, each pair once."""
    x, y = rows.alias("x"), rows.toDF(*rows.columns).alias("y")
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & _candidate(percent)
    return x.join(y, met).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _can_be_first(percent: int) -> Column:
    """Whether the shingle of an index row can be the rarest that the row shares with one it is linked with: as many
    as any link must share are still to come.

    Linked rows x and y differ in `d_x + d_y - 2 * shared <= rate * (n_x + n_y)` shingles, the rate being
    `(100 - percent) / (100 + percent)`. As `shared <= d_y` and `n_y <= n_x * 100 / percent`, x must share
    `d_x - n_x * (100 - percent) / percent` at least. One of the two stands apart, so its delta is beyond
    `rate * (n + n_pivot)`; any delta is no smaller than the sizes differ. So a row that stands apart must share
    `(d - rate * (n + n_pivot)) / 2` at least, and one that does not `(d - rate * (n - n_pivot)) / 2`."""
    beside = F.when(F.col("apart"), F.col("n") + F.col("n_pivot")).otherwise(F.col("n") - F.col("n_pivot"))
    by_size = F.col("n_delta") * percent - F.col("n") * (100 - percent)
    by_pivot = F.col("n_delta") * (100 + percent) - beside * (100 - percent)
    return (F.col("ahead") * percent >= by_size) & (F.col("ahead") * (2 * (100 + percent)) >= by_pivot)


def _delta_index(placed: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """`(pivot, shingle, node, n, n_delta, ahead, apart, held)`: the deltas of rows to their pivot, opened, where one
    row at least stands apart from the pivot. `ahead` counts the row's shared shingles from this one on, the rarest
    being first; those that come too late to be the first shared with a linked row are left out. `held` rows of the
    pivot are in the index under the shingle, two at least, one of them apart.

    A link has `common >= percent / (100 + percent) * (n_a + n_b)`, so at most `(100 - percent) / (100 + percent)` of
    `n_a + n_b` shingles are in one of the two only. A row that is not linked with the pivot has a delta beyond that,
    which a second row can undo only by sharing a part of it."""
    open_ = placed.filter("apart").select("pivot").distinct()
    rows = stars.select(
        F.col("b").alias("pivot"), F.col("a").alias("node"), F.col("n_a").cast("long").alias("n"),
        F.col("n_b").cast("long").alias("n_pivot"), "delta",
    )
    rows = rows.join(open_, "pivot", "left_semi").join(placed.select("pivot", "node", "apart"), ["pivot", "node"])
    opened = store(rows.select(
        "pivot", "node", "n", "n_pivot", "apart", F.size("delta").cast("long").alias("n_delta"),
        F.explode("delta").alias("shingle"),
    ), "deltas")
    order = F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("order")
    shared = opened.join(_held(opened), ["pivot", "shingle"]).groupBy(
        "pivot", "node", "n", "n_pivot", "n_delta", "apart"
    ).agg(order)
    first = store(
        shared.select("*", F.size("order").alias("n_shared"), F.posexplode("order").alias("place", "one")).select(
            "pivot", "one.shingle", "node", "n", "n_pivot", "n_delta",
            (F.col("n_shared") - F.col("place")).cast("long").alias("ahead"), "apart",
        ).filter(_can_be_first(percent)).drop("n_pivot"), "first",
    )
    return store(first.join(_held(first), ["pivot", "shingle"]), "index")


def _held(rows: DataFrame) -> DataFrame:
    """How many rows of a pivot hold a shingle, if two at least and one of them apart."""
    return rows.groupBy("pivot", "shingle").agg(
        F.count("*").alias("held"), F.max("apart").alias("any_apart")
    ).filter("held > 1 and any_apart").drop("any_apart")


def _may_link(percent: int) -> Column:
    """Whether index rows `x` and `y` of one shingle can be a link that meets here first: as many shingles as both
    deltas must share are still to come in both."""
    sizes = F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent
    deltas, both = F.col("x.n_delta") + F.col("y.n_delta"), F.col("x.n") + F.col("y.n")
    need = deltas * (100 + percent) - both * (100 - percent)
    reach = F.least("x.ahead", "y.ahead") * (2 * (100 + percent)) >= need
    return (F.col("x.root") != F.col("y.root")) & (F.col("x.apart") | F.col("y.apart")) & sizes & reach


def _ends() -> tuple[Column, Column]:
    return F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")


def _centre_pairs(index: DataFrame, percent: int) -> DataFrame:
    """Rows that share a shingle with others, each with the one of them that has most such shingles."""
    busy = index.groupBy("pivot", "node").agg(F.count("*").alias("busy"))
    centre = index.join(busy, ["pivot", "node"]).groupBy("pivot", "shingle").agg(
        F.max(F.struct("busy", "node", "n", "n_delta", "ahead", "apart", "root")).alias("y")
    ).select("pivot", "shingle", "y.*").alias("y")
    x = index.alias("x")
    met = (F.col("x.pivot") == F.col("y.pivot")) & (F.col("x.shingle") == F.col("y.shingle"))
    return x.join(centre, met & _may_link(percent)).select(*_ends()).distinct()


def _index_pairs(index: DataFrame, percent: int) -> DataFrame:
    """All pairs of rows that share a shingle and can be a link. The rows that stand apart are dealt over the parts of
    their shingle, and every part meets all its rows, so a shingle with any number of rows is spread over tasks."""
    index = index.withColumn("parts", F.ceil(F.col("held") / PART_ROWS).cast("int"))
    mine = index.filter("apart").withColumn("part", F.expr("pmod(xxhash64(node), parts)").cast("int"))
    theirs = index.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    # A stated number: the rows are few, their pairs are not, and the planner would merge them into few tasks.
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = mine.repartition(tasks, "pivot", "shingle", "part").alias("x")
    y = theirs.repartition(tasks, "pivot", "shingle", "part").alias("y")
    met = F.lit(True)
    for name in ("pivot", "shingle", "part"):
        met = met & (F.col(f"x.{name}") == F.col(f"y.{name}"))
    once = ~F.col("y.apart") | (F.col("x.node") < F.col("y.node"))
    return x.join(y, met & once & _may_link(percent)).select(*_ends()).distinct()


def _rooted(index: DataFrame, roots: DataFrame) -> DataFrame:
    """The index rows whose shingle still joins different components, with their roots."""
    rows = store(
        index.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted"
    )
    keys = rows.groupBy("pivot", "shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rows.join(keys.filter("low <> high").select("pivot", "shingle"), ["pivot", "shingle"], "left_semi")


def near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """`(doc_id, n_shingles, component_id, kept, text_key)` per row, `text_key` being the hash of the text; links have
    `100 * common >= percent * union`."""
    signed = store(sign_table(df, shingle), "signed")
    classes = store(
        signed.filter("n_shingles > 0").groupBy("node", "n_shingles").agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("text_key", F.col("doc_id").alias("first_id"), "signature")).alias("row"),
        ).select("node", "n_shingles", "least_id", "row.text_key", "row.first_id", "row.signature"),
        "classes",
    )
    keys = _chunk_keys(classes)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = store(keys.join(shared, "key"), "buckets")
    sides = classes.select("node", "n_shingles", "signature")
    few = buckets.filter(F.col("n") <= SMALL_BUCKET).select("key", "spot", "node").join(sides, "node")
    compared = _compared(_small_bucket_pairs(few, percent), classes, df, shingle)

    # The pivot of a large bucket is the row that meets most others over all large buckets.
    large = buckets.filter(F.col("n") > SMALL_BUCKET)
    central = large.groupBy("node").agg(F.sum("n").alias("met"))
    pivots = large.join(central, "node").groupBy("key").agg(F.max(F.struct("met", "node")).alias("pivot"))
    large = store(large.join(pivots.select("key", F.col("pivot.node").alias("pivot")), "key"), "large")
    stars = _compared(
        large.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(),
        classes, df, shingle, deltas=True,
    )
    links = store(_linked(compared, percent).union(_linked(stars, percent)), "links")
    roots = materialize(components(links))
    placed = stars.select(F.col("a").alias("node"), F.col("b").alias("pivot")).join(roots, "node", "left").select(
        "node", "pivot", F.coalesce("root", "node").alias("root")
    ).join(roots.toDF("pivot", "pivot_root"), "pivot", "left").select(
        "node", "pivot", (F.col("root") != F.coalesce("pivot_root", "pivot")).alias("apart")
    )
    index = _delta_index(placed, stars, percent)
    met = None
    while True:
        index = _rooted(index.drop("root"), roots)
        crowded = store(index.filter(F.col("held") > SMALL_BUCKET), "crowded")
        before, met = met, crowded.count()
        # A round that leaves more than half of the rows would be followed by others like it.
        if not met or before is not None and 2 * met > before:
            break
        links = links.union(_linked(_compared(_centre_pairs(crowded, percent), classes, df, shingle), percent))
        roots = materialize(components(links))
    links = links.union(_linked(_compared(_index_pairs(index, percent), classes, df, shingle), percent))
    roots = materialize(components(links))
    rooted = classes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least_id")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("node", "component_id")
    out = signed.select("doc_id", "n_shingles", "text_key", "node").join(named, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_key",
    )


def keep_one(df: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `df` without those whose group has a document with a smaller id. Rows that share an id are one
    document and stay or go together with others of their text."""
    gone = lookup(
        near_duplicates(df, shingle, percent).filter(~F.col("kept")).select(
            F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text")
        ).distinct()
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_text"))
    return df.join(gone, same, "left_anti")
