"""Words that a polynomial hash cannot tell apart, vectors at the ends of the range of doubles, contexts in many parts,
counts beyond single precision, and token totals."""

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadcast.llm import bpe, collision_knn, common, minhash_join, ppm, quality, rollups
from loadcast.llm.common import same_bytes, table, word_hash
from loadcast.llm.queries import op2_token_counts

FIRST = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
SECOND = FIRST.translate(str.maketrans("ab", "ba"))


def test_word_hash():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 5000).astype(np.uint8)
    starts = np.concatenate([rng.integers(0, 4000, 3000), np.array([0, 10, 4990])])
    ends = starts + np.concatenate([rng.integers(0, 20, 3000), np.array([1000, 600, 10])])
    hashes = word_hash(data, starts, ends)
    raw = data.tobytes()
    words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    assert len(set(hashes.tolist())) == len(set(words)) == len(set(zip(hashes.tolist(), words)))
    both = np.frombuffer((FIRST + SECOND).encode(), np.uint8)
    assert len(set(word_hash(both, np.array([0, 1024]), np.array([1024, 2048])).tolist())) == 2
    assert same_bytes(both, np.array([0, 0, 5]), np.array([1024, 1024, 0]), np.array([1024, 0, 9])).tolist() == [False, True, True]
    assert word_hash(data[:0], starts[:0], ends[:0]).tolist() == []


def test_mirrored_words_are_different(spark):
    docs = spark.createDataFrame([(1, FIRST), (2, SECOND), (3, FIRST + " " + SECOND)], "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_join.near_duplicates(docs, shingle=2).collect()}
    assert found == {1: (1, 1), 2: (1, 2), 3: (1, 3)}
    library = Tokenizer.from_file(bpe.TOKENIZER)
    for r in bpe.encode_digests(docs).collect():
        ids = library.encode({1: FIRST, 2: SECOND, 3: f"{FIRST} {SECOND}"}[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    data = np.frombuffer(f"{FIRST} {SECOND}\n{FIRST} {SECOND}\n{SECOND} x".encode(), np.uint8)
    base, _ = quality.statistics(data, np.array([0, len(data)]))
    assert base[0].tolist()[0] == 6 and base[0].tolist()[3] == 1
    assert ppm.word_hash is word_hash


def test_fragments_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(bpe, "word_hash", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    own, library = bpe.ForcedBoundaryBPE(bpe.TOKENIZER), Tokenizer.from_file(bpe.TOKENIZER)
    for text in ("some words, and some more words", FIRST + " " + SECOND):
        ids, _ = own.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def plain_nearest(vectors, k):
    found = {}
    for q, x in vectors.items():
        if q % 2 == 0:
            scores = [(-float(np.dot(x, y)), i) for i, y in vectors.items() if i != q]
            found[q] = [i for _, i in sorted(scores)[:k]]
    return found


def test_vectors_at_the_ends_of_the_range(spark):
    rng = np.random.default_rng(3)
    for unit in (1e-200, 1e150, 1.0):
        vectors = {i: rng.normal(size=3) * unit for i in range(60)}
        df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")
        rows = collision_knn.nearest(df, F.col("vec_id") % 2 == 0, 60).orderBy("query_id", "rank").collect()
        got = {q: [r.vec_id for r in rows if r.query_id == q] for q in vectors if q % 2 == 0}
        for q, wanted in plain_nearest(vectors, 60).items():
            assert sorted(got[q]) == sorted(wanted)
            if unit != 1e-200:
                assert got[q] == wanted
    df = spark.createDataFrame([(2, [1e200, 0.0]), (1, [2e200, 1e200]), (0, [1.0, 1.0])], "vec_id long, embedding array<double>")
    rows = collision_knn.nearest(df, F.col("vec_id") >= 0, 20).collect()
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows} == {
        (0, 1): (1, 3e200), (0, 2): (2, 1e200), (1, 1): (2, float("inf")), (1, 2): (0, 3e200),
        (2, 1): (1, float("inf")), (2, 2): (0, 1e200),
    }


def test_contexts_in_many_parts_give_the_same_scores(spark, sf_dir, monkeypatch):
    docs = table(spark, sf_dir, "documents").filter("doc_id < 60")
    found = []
    for keys in (1 << 40, 200):
        monkeypatch.setattr(ppm, "SCORED_KEYS", keys)
        rows = ppm.score_documents(docs, F.col("doc_id") % 3, ppm.held_out()).orderBy("doc_id").collect()
        found.append([tuple(r) for r in rows])
    assert len(found[0]) == 60
    for a, b in zip(*found, strict=True):
        assert a[:-1] == b[:-1] and a[-1] == pytest.approx(b[-1], rel=1e-12)


def test_word_counts_beyond_single_precision():
    n = (1 << 24) + 1
    data = np.frombuffer(b"w", np.uint8)
    (word,), _ = ppm.tokens(data, np.array([0, 1]))
    grams, _ = ppm.grams(data, np.array([0, 1]))
    docs = pa.table({"doc_id": [1], "held_out": [True], "text": ["w"]})
    keys = [int(word), ppm.END_TOKEN, *grams.tolist()]
    values = pa.table({"key": keys, "value": [float(n), 0.0, *[-0.1] * len(grams)]})
    row = ppm._score_block(docs, values, n, 1).to_pylist()[0]
    assert row["base_score"] == math.log10(n + 1) - 2 * math.log10(n + 2)
    assert row["score"] == -0.2 and row["n_known"] == 1 and row["n_tokens"] == 2


def test_token_totals(spark, sf_dir):
    library = Tokenizer.from_file(bpe.TOKENIZER)
    pieces = rollups.byte_encoding("byte_bpe_50k.tiktoken")
    assert isinstance(pieces, tiktoken.Encoding)
    wanted = Counter()
    for r in table(spark, sf_dir, "documents").collect():
        text = r.text or ""
        for name, n in (
            ("word_bpe_49k", len(library.encode(text, add_special_tokens=False).ids)),
            ("byte_bpe_50k", len(pieces.encode_ordinary(text))),
        ):
            wanted[r.source, r.lang, name, "docs"] += 1
            wanted[r.source, r.lang, name, "tokens"] += n
    got = {}
    for r in op2_token_counts(spark, sf_dir).collect():
        got[r.source, r.lang, r.tokenizer, "docs"], got[r.source, r.lang, r.tokenizer, "tokens"] = r.n_docs, r.n_tokens
    assert got == dict(wanted)


def test_texts_are_encoded_by_short_runs(monkeypatch):
    """A batch's texts become Python strings run by run, and a run holds little more than its limit."""
    sizes = []
    bpe_encoder = bpe.encoder(bpe.TOKENIZER)
    whole = bpe_encoder.encode
    monkeypatch.setattr(bpe_encoder, "encode", lambda texts: sizes.append(sum(len(t or "") for t in texts)) or whole(texts))
    texts = ["some words " * 2000, None, "", "é other words " * 3000] * 40
    runs = list(bpe.encoded_runs(pa.array(texts), bpe.TOKENIZER))
    assert max(sizes) <= 1 << 19 and sum(sizes) == sum(len(t or "") for t in texts)
    assert [first for first, _, _ in runs][0] == 0 and sum(len(offsets) - 1 for _, _, offsets in runs) == len(texts)
    ids = np.concatenate([ids for _, ids, _ in runs])
    assert ids.tolist() == whole(texts)[0].tolist()


def test_workers_give_memory_back(monkeypatch):
    said = []
    monkeypatch.setattr(common, "release_memory", lambda: said.append("released"))
    run = common.tidily(lambda batches: (said.append(b) or b for b in batches))
    assert list(run(iter([1, 2]))) == [1, 2] and said == ["released", 1, 2, "released"]


def test_powers_of_a_short_text_are_few(monkeypatch):
    monkeypatch.setattr(common, "_POWERS", {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    common.prefix_hash(np.arange(200_000) % 7)
    assert 200_001 <= len(common._POWERS["up"]) <= 1 << 18
