"""Best-fit packing of token pieces into sequences by bin completion.

Documents are encoded, closed with an end id and cut only where longer than a sequence. Pieces of full length are
sequences of their own. The others go to blocks of a few thousand, each packed in one task; what stands in sequences
with room left is packed again in fewer blocks, until one block is left or another round would not help.

In a block, a best-fit solution is the first incumbent. If it uses more sequences than the lower bound, a depth-first
search takes the largest piece left, tries fillings around it, and gives up a branch when its waste can no longer lead
to a better solution. A first search tries a few greedy fillings at each step, least waste first; if it ends above the
bound, a second one goes through every filling that no other dominates. Each ends at the lower bound or after a stated
number of steps, so a block's packing is a minimum only if the bound is met or the second search comes to its end; the
incumbent holds in any case.

Null and empty texts are pieces of one id. Every input row gives its own pieces, also when rows are equal. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.bpe import TOKENIZER, map_encoded
from loadcast.llm.common import store

CAPACITY = 4096
END_ID = 1
# Tokens per block: about a thousand sequences, so at most one in a thousand is left open by a block.
BLOCK_TOKENS = 1 << 22
# Steps of the first search per block, and greedy fillings tried at each; the second search has so many times the steps.
SEARCH_STEPS = 4000
FILLINGS = 6
SECOND_STEPS = 10
# Sequences with at most this many free places are closed for good.
CLOSED_WASTE = 8

PIECES = "doc_id long, piece integer, start long, length long, ids_crc32 long"


def cut_pieces(df: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece of every document, with the checksum of its ids."""

    def make(kept, ids, offsets, bpe):
        rows = []
        for doc, a, b in zip(kept.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            own = np.append(ids[a:b], end_id).astype("<u4")
            for number, start in enumerate(range(0, len(own), capacity)):
                part = own[start:start + capacity]
                rows.append((doc, number, start, len(part), zlib.crc32(part.tobytes())))
        return list(zip(*rows)) if rows else [[]] * 5

    return map_encoded(df, ["doc_id"], PIECES, make, tokenizer=tokenizer)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Largest first, each into the fullest sequence with room."""
    room: list[int] = []
    open_at: dict[int, list[int]] = {}
    bins: list[list[int]] = []
    for length in sorted(lengths, reverse=True):
        at = bisect_left(room, length)
        if at == len(room):
            bins.append([length])
            left, number = capacity - length, len(bins) - 1
        else:
            space = room.pop(at)
            number = open_at[space].pop()
            bins[number].append(length)
            left = space - length
        if left:
            insort(room, left)
            open_at.setdefault(left, []).append(number)
    return bins


def lower_bound(lengths: list[int], capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by pieces too large to share with others."""
    ordered = np.sort(np.array(lengths, np.int64))
    best = -(-int(ordered.sum()) // capacity)
    running = np.concatenate(([0], np.cumsum(ordered)))
    halves = len(ordered) - int(np.searchsorted(ordered, capacity // 2, "right"))
    for small in np.unique(ordered[ordered <= capacity // 2]).tolist():
        low = np.searchsorted(ordered, small, "left")
        half = np.searchsorted(ordered, capacity // 2, "right")
        big = np.searchsorted(ordered, capacity - small, "right")
        free = (big - half) * capacity - (running[big] - running[half])
        rest = running[half] - running[low] - free
        best = max(best, len(ordered) - int(half) + max(0, -(-int(rest) // capacity)))
    return max(best, halves)


class _Left:
    """The pieces not yet placed: counts by length."""

    def __init__(self, lengths: list[int]):
        self.counts = Counter(lengths)
        self.sizes = sorted(self.counts)

    def take(self, length: int) -> None:
        self.counts[length] -= 1
        if not self.counts[length]:
            self.sizes.pop(bisect_left(self.sizes, length))

    def give(self, length: int) -> None:
        if not self.counts[length]:
            insort(self.sizes, length)
        self.counts[length] += 1

    def largest_upto(self, limit: int, used: int = 0) -> int:
        """The largest length left within `limit`, if one piece of length `used` is gone already; else 0."""
        at = bisect_right(self.sizes, limit) - 1
        if at >= 0 and self.sizes[at] == used and self.counts[used] < 2:
            at -= 1
        return self.sizes[at] if at >= 0 else 0


def fillings(left: _Left, space: int, most: int) -> list[tuple[int, ...]]:
    """Greedy sets of pieces for the free space, least waste first: the largest single piece, and after each first piece
    the largest that fits each time."""
    single = left.largest_upto(space)
    if not single:
        return [()]
    found = {(single,): space - single}
    for at in range(bisect_right(left.sizes, space) - 1, -1, -1):
        first = left.sizes[at]
        if found and min(found.values()) == 0 and len(found) >= most:
            break
        chosen, room, last = [first], space - first, first
        left.take(first)
        while True:
            nxt = left.largest_upto(min(room, last))
            if not nxt:
                break
            left.take(nxt)
            chosen.append(nxt)
            room, last = room - nxt, nxt
        for length in chosen:
            left.give(length)
        if space - room > single:
            found[tuple(chosen)] = room
        if first < space // 4 and len(found) >= most:
            break
    return sorted(found, key=lambda f: (found[f], len(f), f))[:most]


def _spread(sums: int, most: int) -> int:
    """The bits of `sums`, each moved up by every number from 1 to `most`."""
    if not most:
        return 0
    out, reached = sums << 1, 1
    while reached < most:
        step = min(reached, most - reached)
        out |= out << step
        reached += step
    return out


def every_filling(sizes: list[int], counts: list[int], space: int, waste: int) -> Iterator[tuple[int, ...] | None]:
    """Every undominated set of pieces that leaves at most `waste` of the free space; None after other steps.

    A set is dominated if one more piece fits, or if a piece outside can take the place of pieces that are together
    smaller, or of several that are together equal. `sizes` rise and are at most `space`.
    """
    counts, totals = list(counts), list(accumulate(s * c for s, c in zip(sizes, counts)))
    everything = sum(1 << s for s in sizes)
    picked: list[int] = []
    room, at = space, len(sizes) - 1
    while True:
        at = min(at, bisect_right(sizes, room) - 1)
        while at >= 0 and not counts[at]:
            at -= 1
        if at >= 0 and totals[at] >= room - waste:
            yield None
            picked.append(at)
            counts[at] -= 1
            room -= sizes[at]
            continue
        if room <= waste and not any(counts[:bisect_right(sizes, room)]):
            outside = everything - sum(1 << sizes[i] for i in set(picked) if not counts[i])
            sums = several = 0
            for i in picked:
                several |= sums << sizes[i]
                sums |= sums << sizes[i] | 1 << sizes[i]
            if not (several | _spread(sums, room)) & outside:
                yield tuple(sizes[i] for i in picked)
        if not picked:
            return
        at = picked.pop()
        counts[at] += 1
        room += sizes[at]
        at -= 1


def _greedy(left: _Left, space: int, waste: int) -> Iterator[tuple[int, ...] | None]:
    return iter([f for f in fillings(left, space, FILLINGS) if space - sum(f) <= waste])


def _every(left: _Left, space: int, waste: int) -> Iterator[tuple[int, ...] | None]:
    sizes = left.sizes[:bisect_right(left.sizes, space)]
    return every_filling(sizes, [left.counts[s] for s in sizes], space, waste)


def _search(
    lengths: list[int], capacity: int, best: list[list[int]], bound: int, steps: int,
    listed: Callable[[_Left, int, int], Iterator[tuple[int, ...] | None]],
) -> list[list[int]]:
    """A packing better than `best` if the search finds one."""
    left, path, waste, total = _Left(lengths), [], 0, sum(lengths)
    # One entry per open level: its first piece, and the fillings still to try around it.
    choices: list[tuple[int, Iterator[tuple[int, ...] | None]]] = []
    limit = (len(best) - 1) * capacity - total

    def undo() -> int:
        gone = path.pop()
        for length in gone:
            left.give(length)
        return capacity - sum(gone)

    while steps > 0:
        if not left.sizes:
            if len(path) < len(best):
                best = [list(p) for p in path]
                limit = (len(best) - 1) * capacity - total
            if len(best) <= bound:
                break
            waste -= undo()
        elif len(choices) == len(path):
            top = left.sizes[-1]
            left.take(top)
            choices.append((top, listed(left, capacity - top, limit - waste)))
            left.give(top)
        top, options = choices[-1]
        filling = next(options, False)
        if filling is False:
            choices.pop()
            if not path:
                break
            waste -= undo()
            continue
        steps -= 1
        if filling is None or waste + capacity - top - sum(filling) > limit:
            continue
        chosen = (top, *filling)
        for length in chosen:
            left.take(length)
        path.append(chosen)
        waste += capacity - sum(chosen)
    return best


def complete_bins(lengths: list[int], capacity: int, steps: int = SEARCH_STEPS) -> list[list[int]]:
    """The packing of one block: best fit, improved by bin completion if it is above the lower bound."""
    best, bound = best_fit(lengths, capacity), lower_bound(lengths, capacity)
    for listed, most in ((_greedy, steps), (_every, SECOND_STEPS * steps)):
        if len(best) > bound:
            best = _search(lengths, capacity, best, bound, most, listed)
    return best


def pack_block(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence number of each piece in its block, and its place there."""
    where: dict[int, list[int]] = {}
    for i, length in enumerate(lengths.tolist()):
        where.setdefault(length, []).append(i)
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, members in enumerate(complete_bins(lengths.tolist(), capacity)):
        place = 0
        for length in members:
            i = where[length].pop()
            number[i], offset[i] = k, place
            place += length
    return number, offset


def _pack_blocks(pieces: DataFrame, blocks: int, level: int, capacity: int) -> DataFrame:
    """Every piece with its sequence, its place and the sequence's free places."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        number, offset = pack_block(group["length"].to_numpy(), capacity)
        filled = np.bincount(number, weights=group["length"].to_numpy()).astype(np.int64)
        out = group.drop(columns="block")
        out["sequence_id"] = (level << 56) + (group["block"].to_numpy().astype(np.int64) << 24) + number
        out["offset"] = offset
        out["free"] = capacity - filled[number]
        return out

    # The pieces are read from files, so the row numbers repeat if a task runs again.
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    schema = f"{PIECES}, sequence_id long, offset long, free long"
    return pieces.withColumn("block", block).groupBy("block").applyInPandas(pack, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """`sequence_id` and `offset` for every piece; sequences are gapless from 0. `pieces` must be a stored table."""
    full = pieces.filter(F.col("length") >= capacity).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )
    parts, rest, level, before = [full], pieces.filter(F.col("length") < capacity), 1, None
    while True:
        tokens = rest.agg(F.sum("length")).first()[0] or 0
        blocks = max(1, -(-tokens // block_tokens))
        packed = store(_pack_blocks(rest, blocks, level, capacity), "packed")
        last = blocks == 1 or before is not None and tokens > before // 2
        closed = packed if last else packed.filter(F.col("free") <= CLOSED_WASTE)
        parts.append(closed.drop("free"))
        if last:
            break
        rest = packed.filter(F.col("free") > CLOSED_WASTE).select(*pieces.columns)
        before, level = tokens, level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(df: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """All documents as pieces in sequences."""
    return pack(store(cut_pieces(df, capacity, tokenizer=tokenizer), "pieces"), capacity)
