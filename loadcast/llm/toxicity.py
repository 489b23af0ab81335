"""Toxicity: a linear-chain conditional random field tags toxic words; its marginals become spans and document scores.

Labels are given for documents. Word labels for the field are derived from them: a feature (a word, or its beginning or
end) that is far more frequent among toxic than among clean documents is a cue; words of toxic documents that carry a
cue are labelled toxic, all other words clean. The field has one weight a feature, one for the tag itself, for the first
tag of a text, and for each change of tags. It is fitted by gradients of its likelihood on windows of words. Forward and
backward passes over whole texts give every word's probability; a logistic model of their largest value, sums and share
turns them into the document's score, and neighbouring words above one half become a span.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z in lower case. Null and empty texts have no
spans and get the score of a text without evidence. Equal rows are scored alike. A document that is labelled twice
counts twice in the fit; null labels are left out. Without labels of both kinds every score is the share of toxic labels
(0 without any). Empty tables give an empty result, and other columns are never read. The fit uses at most `FIT_ROWS`
labelled documents, chosen by a hash of the id, at most `FEATURES` features and `WINDOWS` windows a document; scoring
covers every word of every text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import (
    LOWER, byte_set, mix, prefix_hash, span_hash, store, text_chunks, word_spans,
)

FIT_ROWS = 20_000
FEATURES = 50_000
WINDOW = 16
WINDOWS = 3
# A cue is this many times (as a logarithm) more frequent in toxic documents, and in this many of them.
CUE_ODDS = 2.0
CUE_DOCUMENTS = 5
# Lanes of the forward and backward passes.
LANES = 2048
THRESHOLD = 0.7

TOKEN_BYTES = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
BEGINNINGS = (3, 4, 5, 6, 7, 8, 10)
ENDINGS = (3, 4, 5)
EVIDENCE = ("most", "log_sum", "log_flagged", "share", "log_words")


@dataclass(frozen=True)
class Tokens:
    """Words of a chunk: spans, borders of rows, and for each word its place among the distinct words' features."""

    starts: np.ndarray
    ends: np.ndarray
    words_at: np.ndarray
    word: np.ndarray
    # Feature hashes of the distinct words, 0 where a word is too short.
    features: np.ndarray


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    data = LOWER[data]
    starts, ends, words_at = word_spans(data, offsets, TOKEN_BYTES)
    running = prefix_hash(data)
    hashes = span_hash(running, starts, ends)
    distinct, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    s, e = starts[first], ends[first]
    columns = [distinct]
    for kind, size in [*((0, b) for b in BEGINNINGS), *((1, b) for b in ENDINGS)]:
        longer = e - s > size
        a, b = (s, s + size) if kind == 0 else (e - size, e)
        part = np.zeros(len(s), np.uint64)
        part[longer] = mix(span_hash(running, a[longer], b[longer]) + np.uint64(2 * size + kind + 1))
        columns.append(part)
    return Tokens(starts, ends, words_at, word, np.stack(columns, 1))


@dataclass(frozen=True)
class Dictionary:
    """Sorted feature hashes with a weight each."""

    hashes: np.ndarray
    weights: np.ndarray

    def find(self, features: np.ndarray) -> np.ndarray:
        """Positions of features, -1 where unknown."""
        if not len(self.hashes):
            return np.full(features.shape, -1)
        at = np.minimum(np.searchsorted(self.hashes, features), len(self.hashes) - 1)
        return np.where(self.hashes[at] == features, at, -1)

    def sums(self, features: np.ndarray) -> np.ndarray:
        return np.append(self.weights, 0.0)[self.find(features)].sum(1)

    def most(self, features: np.ndarray) -> np.ndarray:
        return np.append(self.weights, -np.inf)[self.find(features)].max(1)


@dataclass(frozen=True)
class Field:
    """The fitted field: `begin` is added at a text's first word, `change` holds the score of tag pairs (old, new)."""

    dictionary: Dictionary
    bias: float
    begin: float
    change: np.ndarray

    def marginals(self, tokens: Tokens) -> np.ndarray:
        """Every word's probability of the toxic tag, by exact forward and backward passes over whole rows."""
        score = (self.bias + self.dictionary.sums(tokens.features))[tokens.word]
        return chain_marginals(np.clip(score, -40, 40), tokens.words_at, self.begin, self.change)


def _scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Values of r after each step r -> (a r + b) / (c r + d), from 1. Lanes of steps are composed side by side first,
    so each lane's entry value is known when the lanes are walked through."""
    n = len(a)
    lanes = max(1, min(LANES, n // 8))
    depth = -(-n // lanes)
    pad = depth * lanes - n
    a, b, c, d = (
        np.concatenate([x, np.full(pad, fill)]).reshape(lanes, depth).T
        for x, fill in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0))
    )
    p, q, r, s = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for k in range(depth):
        p, q, r, s = a[k] * p + b[k] * r, a[k] * q + b[k] * s, c[k] * p + d[k] * r, c[k] * q + d[k] * s
        size = np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p / size, q / size, r / size, s / size
    entry, value = np.empty(lanes), 1.0
    for lane, (pp, qq, rr, ss) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        entry[lane] = value
        value = (pp * value + qq) / (rr * value + ss)
    out, value = np.empty((depth, lanes)), entry
    for k in range(depth):
        value = (a[k] * value + b[k]) / (c[k] * value + d[k])
        out[k] = value
    return out.T.reshape(-1)[:n]


def chain_marginals(score: np.ndarray, words_at: np.ndarray, begin: float, change: np.ndarray) -> np.ndarray:
    """Probabilities of tag 1; `score` is a word's score of tag 1 over tag 0, rows are cut at `words_at`."""
    if not len(score):
        return score
    potential, t = np.exp(score), np.exp(change)
    opens = np.zeros(len(score), bool)
    opens[words_at[:-1][np.diff(words_at) > 0]] = True
    closes = np.append(opens[1:], True)
    # Ratios of tag 1 to tag 0. Forward: r' = e (t01 + t11 r) / (t00 + t10 r), or e times the opening weight.
    forward = _scan(
        np.where(opens, 0, potential * t[1, 1]), np.where(opens, potential * math.exp(begin), potential * t[0, 1]),
        np.where(opens, 0, t[1, 0]), np.where(opens, 1, t[0, 0]),
    )
    # Backward over what follows: b = (t10 + t11 e' b') / (t00 + t01 e' b'), or 1 at the last word.
    after = np.append(potential[1:], 1.0)
    backward = _scan(
        np.where(closes, 0, t[1, 1] * after)[::-1], np.where(closes, 1, t[1, 0])[::-1],
        np.where(closes, 0, t[0, 1] * after)[::-1], np.where(closes, 1, t[0, 0])[::-1],
    )[::-1]
    odds = forward * backward
    return odds / (1 + odds)


def fit_field(
    labels: np.ndarray, real: np.ndarray, hit_row: np.ndarray, hit_feature: np.ndarray, hashes: np.ndarray,
    rounds: int = 60, rate: float = 0.3, ridge: float = 1e-5,
) -> Field:
    """Fit on windows, a row each: tags, which places hold a word, and the features found at (flat) places.

    Full-batch gradients with Adam steps: a feature's gradient is its labelled minus its expected number.
    """
    rows, width = labels.shape
    weights = np.zeros(len(hashes) + 6)
    n = len(hashes)
    weights[n] = -3.0
    moment, square = np.zeros_like(weights), np.zeros_like(weights)
    flat_labels = (labels * real).reshape(-1)
    old, new = labels[:, :-1], labels[:, 1:]
    pair_real = real[:, 1:]
    given = np.zeros(len(weights))
    given[:n] = np.bincount(hit_feature, flat_labels[hit_row], n)
    given[n] = flat_labels.sum()
    given[n + 1] = labels[:, 0].sum()
    for k, (i, j) in enumerate(((0, 1), (1, 0), (1, 1))):
        given[n + 2 + k] = ((old == i) & (new == j) & pair_real).sum()
    for step in range(1, rounds + 1):
        score = weights[n] + np.bincount(hit_row, weights[hit_feature], rows * width).reshape(rows, width)
        e1 = np.exp(np.clip(score, -40, 40))
        t = np.exp(np.array([[0.0, weights[n + 2]], [weights[n + 3], weights[n + 4]]]))
        ahead = np.empty((width, rows, 2))
        value = np.stack([np.ones(rows), e1[:, 0] * math.exp(weights[n + 1])], 1)
        ahead[0] = value / value.sum(1, keepdims=True)
        for k in range(1, width):
            value = ahead[k - 1] @ t
            value[:, 1] *= e1[:, k]
            value /= value.sum(1, keepdims=True)
            ahead[k] = np.where(real[:, k, None], value, ahead[k - 1])
        back = np.ones((rows, 2))
        expected = np.zeros(len(weights))
        p = np.zeros((rows, width))
        for k in range(width - 1, -1, -1):
            both = ahead[k] * back
            p[:, k] = both[:, 1] / both.sum(1) * real[:, k]
            if k:
                following = np.stack([back[:, 0], back[:, 1] * e1[:, k]], 1)
                joint = ahead[k - 1][:, :, None] * t[None] * following[:, None, :]
                joint *= (real[:, k] / joint.sum((1, 2)))[:, None, None]
                whole = joint.sum(0)
                expected[n + 2:n + 5] += whole[0, 1], whole[1, 0], whole[1, 1]
                before = following @ t.T
                back = np.where(real[:, k, None], before / before.sum(1, keepdims=True), back)
        expected[:n] = np.bincount(hit_feature, p.reshape(-1)[hit_row], n)
        expected[n] = p.sum()
        expected[n + 1] = p[:, 0].sum()
        gradient = (given - expected) / rows - ridge * weights
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient * gradient
        weights += rate * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    kept = np.abs(weights[:n]) > 0.01
    return Field(
        Dictionary(hashes[kept], weights[:n][kept]), float(weights[n]), float(weights[n + 1]),
        np.array([[0.0, weights[n + 2]], [weights[n + 3], weights[n + 4]]]),
    )


@dataclass(frozen=True)
class Model:
    """A field and the logistic model over a document's evidence; without a field every score is `constant`."""

    field: Field | None
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    constant: float

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.field is None:
            return np.full(len(evidence), self.constant)
        z = self.weights[0] + (evidence - self.centre) / self.scale @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def evidence_of(p: np.ndarray, words_at: np.ndarray) -> np.ndarray:
    """What a document's word probabilities amount to, a column for each of `EVIDENCE`."""
    rows, n = len(words_at) - 1, np.diff(words_at)
    row_of = np.repeat(np.arange(rows), n)
    most = np.zeros(rows)
    if len(p):
        most[n > 0] = np.maximum.reduceat(p, words_at[:-1][n > 0])
    total = np.bincount(row_of, p, rows)
    flagged = np.bincount(row_of, p * (p > 0.5), rows)
    return np.stack([most, np.log1p(total), np.log1p(flagged), total / np.maximum(n, 1), np.log1p(n)], 1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights (the intercept first) of a logistic model, by Newton steps."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - centre) / scale])
    w = np.zeros(z.shape[1])
    w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    penalty = np.diag([0.0] + [ridge] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) - penalty @ w
        bend = (z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-6 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        # Short steps keep far starts from overshooting.
        w += step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
    return centre, scale, w


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from all learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, Tokens]]:
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch.column(column)):
            yield batch.slice(first, end - first), tokens_of(data, offsets)


def _count_features(texts: DataFrame) -> DataFrame:
    """How many documents hold each feature: `feature`, `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens in _chunks(batches, 0):
            row_of = np.repeat(np.arange(len(tokens.words_at) - 1), np.diff(tokens.words_at))
            pairs = np.unique(row_of * len(tokens.features) + tokens.word)
            features = []
            for row in np.split(pairs, np.flatnonzero(np.diff(pairs // max(len(tokens.features), 1))) + 1):
                features.append(np.unique(tokens.features[row % max(len(tokens.features), 1)]))
            found, docs = np.unique(np.concatenate(features), return_counts=True)
            known = found > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[known].view(np.int64)), pa.array(docs[known].astype(np.int64))], ["feature", "docs"]
            )

    return texts.select("text").mapInArrow(run, "feature long, docs long").groupBy("feature").agg(
        F.sum("docs").alias("docs")
    )


def _count_known(texts: DataFrame, dictionary: Dictionary) -> np.ndarray:
    """How many documents hold each feature of the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(dictionary.hashes), np.int64)
        for _, tokens in _chunks(batches, 0):
            found = dictionary.find(tokens.features)
            for a, b in zip(tokens.words_at[:-1], tokens.words_at[1:]):
                held = np.unique(found[np.unique(tokens.word[a:b])])
                total[held[held >= 0]] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["place", "docs"])

    counted = texts.select("text").mapInArrow(run, "place long, docs long").groupBy("place").agg(F.sum("docs"))
    total = np.zeros(len(dictionary.hashes), np.int64)
    for place, docs in counted.collect():
        total[place] = docs
    return total


def _windows(sample: DataFrame, cues: Dictionary, windows: int = WINDOWS) -> DataFrame:
    """At most `windows` windows a document, those with the strongest cues first, then the earliest by a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens in _chunks(batches, 1):
            toxic = np.asarray(batch.column(0)) > 0
            found = cues.find(tokens.features)
            odds = cues.most(tokens.features)[tokens.word]
            labels, hits, features = [], [], []
            for row, (a, b) in enumerate(zip(tokens.words_at[:-1].tolist(), tokens.words_at[1:].tolist())):
                parts = np.arange(a, b, WINDOW)
                if not len(parts):
                    continue
                strength = np.maximum(np.maximum.reduceat(odds[:b], parts), 0.0)
                order = np.lexsort((mix(parts.astype(np.uint64) - np.uint64(a)), -strength))[:windows]
                for start in parts[order].tolist():
                    end = min(start + WINDOW, b)
                    labels.append(((odds[start:end] >= CUE_ODDS) & toxic[row]).astype(np.int8).tobytes())
                    here = found[tokens.word[start:end]]
                    place, column = np.nonzero(here >= 0)
                    hits.append(place.astype("<i4").tobytes())
                    features.append(here[place, column].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary()) for c in (labels, hits, features)], ["labels", "hits", "features"]
            )

    return sample.select("toxic", "text").mapInArrow(run, "labels binary, hits binary, features binary")


def _evidence(sample: DataFrame, field: Field) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens in _chunks(batches, 1):
            evidence = evidence_of(field.marginals(tokens), tokens.words_at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in evidence.T)], ["toxic", *EVIDENCE]
            )

    return sample.select("toxic", "text").mapInArrow(run, "toxic int, " + ", ".join(f"{e} double" for e in EVIDENCE))


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model fitted on at most `rows` labels of documents that are not held out."""
    none = np.zeros(len(EVIDENCE))
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = chosen.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    sample = store(sample.repartition(16, "doc_id", "toxic"), "toxicity-sample")
    sizes = sample.agg(F.count("*").alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("toxic")).first()
    n_toxic, n_clean = sizes.toxic or 0, sizes.n - (sizes.toxic or 0)
    empty = Model(None, none, none + 1, np.zeros(len(EVIDENCE) + 1), n_toxic / sizes.n if sizes.n else 0.0)
    if not n_toxic or not n_clean:
        return empty

    least = max(2, min(CUE_DOCUMENTS, n_toxic // 10), n_toxic // 1000)
    frequent = _count_features(sample.filter("toxic > 0")).filter(F.col("docs") >= least)
    frequent = frequent.orderBy(F.desc("docs"), "feature").limit(FEATURES).toPandas()
    hashes = frequent["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, toxic = hashes[order], frequent["docs"].to_numpy()[order]
    if not len(hashes):
        return empty
    clean = _count_known(sample.filter("toxic <= 0"), Dictionary(hashes, np.zeros(len(hashes))))
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))

    windows = _windows(sample, Dictionary(hashes, odds)).toPandas()
    sizes = np.array([len(x) for x in windows["labels"]], np.int64)
    place = np.arange(WINDOW)[None, :] < sizes[:, None]
    tags = np.zeros(place.shape, np.int8)
    tags[place] = np.frombuffer(b"".join(windows["labels"]), np.int8)
    hits = [np.frombuffer(x, "<i4") for x in windows["hits"]]
    at = np.concatenate(hits) + np.repeat(np.arange(len(hits)) * WINDOW, [len(h) for h in hits])
    features = np.frombuffer(b"".join(windows["features"]), "<i4")
    field = fit_field(tags, place, at, features, hashes)

    table = _evidence(sample, field).toPandas().sort_values(["toxic", *EVIDENCE], kind="stable")
    fitted = fit_logistic(table[list(EVIDENCE)].to_numpy(), (table["toxic"].to_numpy() > 0).astype(float))
    return Model(field, *fitted, 0.0)


def tag_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `score` and `spans`: character offsets of toxic stretches and their largest probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1)):
                tokens = tokens_of(data, offsets)
                words = len(tokens.word)
                p = model.field.marginals(tokens) if model.field is not None else np.zeros(words)
                score = model.score(evidence_of(p, tokens.words_at))
                row_of = np.repeat(np.arange(end - first), np.diff(tokens.words_at))
                bad = np.flatnonzero(p > 0.5)
                fresh = np.ones(len(bad), bool)
                fresh[1:] = (np.diff(bad) > 1) | (np.diff(row_of[bad]) > 0)
                opens = np.flatnonzero(fresh)
                closes = np.append(opens[1:], len(bad)) - 1 if len(bad) else opens
                characters = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                row = row_of[bad[opens]] if len(bad) else opens
                base = characters[offsets[:-1]][row]
                spans = pa.StructArray.from_arrays([
                    pa.array(characters[tokens.starts[bad[opens]]] - base if len(bad) else opens),
                    pa.array(characters[tokens.ends[bad[closes]]] - base if len(bad) else opens),
                    pa.array(np.maximum.reduceat(p[bad], opens) if len(bad) else np.zeros(0)),
                ], ["start", "end", "probability"])
                at = np.searchsorted(row, np.arange(end - first + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, end - first), pa.array(score),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans),
                ], ["doc_id", "score", "spans"])

    schema = "doc_id long, score double, spans array<struct<start: long, end: long, probability: double>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`tag_toxic` by a model fitted here, with `held_out`, `predicted` and the number of spans."""
    tagged = tag_toxic(docs, fit_toxicity(docs, labels))
    return tagged.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"), F.get("spans", F.lit(0))["start"].alias("first_start"),
    )
