"""BPE encoding and decoding by forced boundaries.

A pair of neighbouring byte symbols that stands inside no vocabulary token can never be bridged by a merge, so a cut
there is certain. Texts are normalised and cut into words as the tokenizer file says, words are cut further at such
pairs, each distinct fragment is merged once, and the pieces are put together again. A fragment's last byte of a word
is a symbol of its own, because the vocabulary marks word ends.

Null text is empty and gives no ids; texts of any length are processed whole; equal rows are encoded alike; extra
columns stay untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from loadcast.llm.common import same_bytes, tidily, word_hash

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# Distinct fragments that a worker keeps; the cache starts anew beyond them.
CACHE_FRAGMENTS = 1 << 18
# Characters that are encoded at once; a longer text is a step of its own. A step takes about 70 bytes for each.
RUN_CHARACTERS = 1 << 18
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)
NO_MERGE = np.int32(2**31 - 1)
# Below this code point no character combines with another, so composing a text changes nothing.
FIRST_COMBINING = 0x300
# The tokenizer's contractions, by the letters after the apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1 characters
    stand for themselves, the other bytes for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all spans, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _highest(text: str) -> int:
    return int(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).max())


class ForcedBoundaryBPE:
    """An encoder for one tokenizer file of byte-level BPE with word ends and lower case."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or spec["truncation"] or spec["padding"]:
            raise ValueError(f"{path} is no byte-level BPE with word ends")
        self.library = Tokenizer.from_file(path)
        vocab: dict[str, int] = model["vocab"]
        characters = byte_characters()
        byte_of = {c: b for b, c in enumerate(characters)}
        self.base = np.array(
            [vocab[c] for c in characters] + [vocab[f"{c}</w>"] for c in characters], np.int32
        )
        joined = np.zeros((512, 512), bool)
        for token in vocab:
            symbols = [byte_of[c] for c in token.removesuffix("</w>")]
            if token.endswith("</w>"):
                symbols[-1] += 256
            joined[symbols[:-1], symbols[1:]] = True
        self.parted = ~joined.ravel()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pairs, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)[order]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = added
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        size = max([*vocab.values(), *added.values()]) + 1
        self.strings = np.empty(size, object)
        for token, number in [*vocab.items(), *added.items()]:
            self.strings[number] = token
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.first = np.zeros(1, np.int64)

    def _class_of(self, code: int) -> int:
        """What the tokenizer's own splitting does with a character after a letter and after a punctuation mark."""
        if 0xD800 <= code < 0xE000:
            return OTHER
        split = self.library.pre_tokenizer.pre_tokenize_str
        if split("a" + chr(code))[0][1][1] > 1:
            return LETTER
        after_mark = split("!" + chr(code))
        if after_mark[0][1][1] > 1:
            return OTHER
        return NUMBER if len(after_mark) > 1 else SPACE

    def _normal(self, rows: Sequence[str]) -> tuple[str, np.ndarray]:
        """All rows in normal form, joined by single spaces, and the n + 1 starts of the rows in it."""
        joined = " ".join(rows)
        if "İ" in joined or not joined.isascii() and _highest(joined) >= FIRST_COMBINING:
            rows = [
                r.lower() if r.isascii() else self.library.normalizer.normalize_str(r) for r in rows
            ]
            joined = " ".join(rows)
        else:
            joined = joined.lower()
        starts = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(r) + 1 for r in rows], out=starts[1:])
        starts[-1] = len(joined)
        return joined, starts

    def _fragments(self, rows: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The byte symbols of all words, the starts of their fragments, and the symbol offsets of the rows."""
        joined, row_starts = self._normal(rows)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.classes[codes]
        if (kind == UNKNOWN).any():
            for code in np.unique(codes[kind == UNKNOWN]).tolist():
                self.classes[code] = self._class_of(code)
            kind = self.classes[codes]
        start = np.ones(len(codes), bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        self._contract(codes, kind, start)
        kept = kind != SPACE
        offsets = np.concatenate(([0], np.cumsum(kept)))[row_starts]
        codes, start = codes[kept], start[kept]
        symbols = np.frombuffer(codes.tobytes().decode("utf-32-le").encode(), np.uint8).astype(np.uint16)
        if len(symbols) != len(codes):
            width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
            place = np.concatenate(([0], np.cumsum(width)))
            offsets = place[offsets]
            words = place[:-1][start]
        else:
            words = np.flatnonzero(start)
        if not len(symbols):
            return symbols, np.zeros(0, np.int64), offsets
        cut = np.zeros(len(symbols), bool)
        cut[words] = True
        symbols[np.append(words[1:], len(symbols)) - 1] += 256
        cut[1:] |= self.parted.take((symbols[:-1].astype(np.int32) << 9) + symbols[1:])
        return symbols, np.flatnonzero(cut), offsets

    @staticmethod
    def _contract(codes: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
        """A lone apostrophe takes the letters of a contraction with it."""
        marks = np.flatnonzero((codes[:-1] == ord("'")) & start[:-1] & (kind[1:] == LETTER))
        for i in marks.tolist():
            for tail in CONTRACTIONS:
                if codes[i + 1:i + 1 + len(tail)].tolist() == [ord(c) for c in tail]:
                    start[i + 1] = False
                    after = i + 1 + len(tail)
                    if after < len(start):
                        start[after] = True
                    break

    def _merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all fragments, one after the other, and how many each has. All fragments merge in step: the pair
        of lowest rank in each, everywhere it stands, from the left."""
        ids, owner = self.base[symbols], np.repeat(np.arange(len(lengths)), lengths)
        done_ids, done_owner = [], []
        while len(ids):
            rank = np.full(len(ids), NO_MERGE, np.int32)
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            keys = ids[inner].astype(np.int64) << 20 | ids[inner + 1]
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            known = self.pairs[at] == keys
            rank[inner[known]] = self.ranks[at[known]]
            result = np.zeros(len(ids), np.int32)
            result[inner[known]] = self.merged[at[known]]
            heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(ids))))
            over = best == NO_MERGE
            done_ids.append(ids[over])
            done_owner.append(owner[over])
            take = (rank == best) & ~over
            if (take[1:] & take[:-1]).any():
                runs = np.maximum.accumulate(np.where(take, 0, np.arange(1, len(take) + 1)))
                take &= (np.arange(len(take)) - runs) % 2 == 0
            keep = ~over
            keep[1:] &= ~take[:-1]
            ids = np.where(take, result, ids)[keep]
            owner = owner[keep]
        ids, owner = np.concatenate([np.zeros(0, np.int32), *done_ids]), np.concatenate([np.zeros(0, int), *done_owner])
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(lengths))

    def _rows_of(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Each fragment's place in the store of merged fragments, after merging the new ones.

        The store knows fragments by their symbols. Within a chunk a hash brings equal ones together and their symbols
        confirm it.
        """
        ends = np.append(starts[1:], len(symbols))
        raw = symbols.astype("<u2", copy=False).view(np.uint8)
        _, first, place = np.unique(word_hash(raw, 2 * starts, 2 * ends), return_index=True, return_inverse=True)
        lengths = 2 * (ends - starts)
        held = lengths == lengths[first][place]
        held[held] = same_bytes(raw, 2 * starts[held], lengths[held], 2 * starts[first][place][held])
        whole = raw.tobytes()
        if not held.all():
            numbers: dict[bytes, int] = {}
            cut = [whole[a:b] for a, b in zip((2 * starts).tolist(), (2 * ends).tolist())]
            place = np.array([numbers.setdefault(c, len(numbers)) for c in cut])
            first = np.unique(place, return_index=True)[1]
        keys = [whole[a:b] for a, b in zip((2 * starts[first]).tolist(), (2 * ends[first]).tolist())]
        if len(self.rows) + len(keys) > CACHE_FRAGMENTS:
            self._forget()
        rows = list(map(self.rows.get, keys))
        new = np.array([i for i, row in enumerate(rows) if row is None], np.int64)
        if len(new):
            begin = starts[first[new]]
            lengths = ends[first[new]] - begin
            ids, counts = self._merge(symbols[ragged(begin, lengths)], lengths)
            base = len(self.first) - 1
            self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(counts)))
            self.flat = np.concatenate((self.flat, ids))
            self.rows.update(zip([keys[i] for i in new.tolist()], range(base, base + len(new))))
            for k, i in enumerate(new.tolist()):
                rows[i] = base + k
        return np.array(rows, np.int64)[place]

    def _encode_plain(self, rows: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        symbols, starts, offsets = self._fragments(rows)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(rows) + 1, np.int64)
        place = self._rows_of(symbols, starts)
        begin, counts = self.first[place], self.first[place + 1] - self.first[place]
        ids = self.flat[ragged(begin, counts)]
        totals = np.concatenate(([0], np.cumsum(counts)))
        return ids, totals[np.searchsorted(starts, offsets)]

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the n + 1 offsets of the texts in them."""
        texts = [t or "" for t in texts]
        if not any(s in t for t in texts for s in self.special):
            return self._encode_plain(texts)
        parts = [self.special_cut.split(t) for t in texts]
        plain = [p for row in parts for p in row[::2]]
        ids, offsets = self._encode_plain(plain)
        out, sizes, k = [], [0], 0
        for row in parts:
            before = len(out)
            for j, part in enumerate(row):
                if j % 2:
                    out.append(np.array([self.special[part]], np.int32))
                else:
                    out.append(ids[offsets[k]:offsets[k + 1]])
                    k += 1
            sizes.append(sizes[-1] + sum(map(len, out[before:])))
        return np.concatenate(out), np.array(sizes, np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by spaces: the file names no decoder."""
        return " ".join(self.strings[ids].tolist())


@lru_cache(maxsize=2)
def encoder(path: str) -> ForcedBoundaryBPE:
    return ForcedBoundaryBPE(path)


def encoded_runs(column: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, ids and offsets of runs of rows that hold about `RUN_CHARACTERS` each. Only a run's texts become
    Python strings at a time."""
    bpe, first, size = encoder(path), 0, 0
    for row, length in enumerate(pc.utf8_length(column).to_pylist()):
        size += length or 0
        if size >= RUN_CHARACTERS or row + 1 == len(column):
            yield first, *bpe.encode(column.slice(first, row + 1 - first).to_pylist())
            first, size = row + 1, 0


def map_encoded(
    df: DataFrame, keep: Sequence[str], schema: str, make: Callable, text: str = "text", tokenizer: str = TOKENIZER
) -> DataFrame:
    """Encode the text column in Arrow batches. `make` gets the kept columns of a run of rows as a table, with the ids
    and offsets of its texts, and the encoder; it returns the columns of the output rows."""
    out = pa.schema([(f.name, _ARROW[f.dataType.typeName()]) for f in _struct(schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.select(list(range(len(keep))))
            for first, ids, offsets in encoded_runs(batch.column(len(keep)), tokenizer):
                columns = make(kept.slice(first, len(offsets) - 1), ids, offsets, encoder(tokenizer))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return df.select(*keep, text).mapInArrow(tidily(run), schema)


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "integer": pa.int32(), "double": pa.float64()}


def _struct(schema: str):
    from pyspark.sql import types as T

    return T.StructType.fromDDL(schema)


def encode_table(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER
) -> DataFrame:
    """`(doc_id, n_tokens, ids, decoded)` per row: `ids` as little-endian unsigned 32-bit numbers, and the text that
    the ids decode to."""

    def make(kept, ids, offsets, bpe):
        cut = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        return (
            kept.column(0), np.diff(offsets), [c.astype("<u4").tobytes() for c in cut], [bpe.decode(c) for c in cut],
        )

    return map_encoded(df, [doc_id], f"{doc_id} long, n_tokens long, ids binary, decoded string", make, text, tokenizer)


def encode_digests(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER
) -> DataFrame:
    """`(doc_id, n_tokens, ids_sha256, decoded_sha256)` per row, so that ids and texts stay in the task."""

    def make(kept, ids, offsets, bpe):
        cut = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        return (
            kept.column(0), np.diff(offsets),
            [hashlib.sha256(c.astype("<u4").tobytes()).hexdigest() for c in cut],
            [hashlib.sha256(bpe.decode(c).encode()).hexdigest() for c in cut],
        )

    schema = f"{doc_id} long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_encoded(df, [doc_id], schema, make, text, tokenizer)


def count_table(
    df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", tokenizer: str = TOKENIZER
) -> DataFrame:
    """The kept columns, which are numbers or strings, and `n_tokens` per row."""
    kinds = {f.name: f.dataType.typeName() for f in df.select(*keep).schema}
    schema = ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", n_tokens long"
    return map_encoded(
        df, keep, schema, lambda kept, ids, offsets, bpe: (*kept.columns, np.diff(offsets)), text, tokenizer
    )
