"""Word runs, toxic spans and ranked search against plain versions, and on odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.llm import ranked_search, toxicity, word_runs
from loadcast.llm.common import store, table
from loadcast.llm.queries import op11_word_runs, op12_toxicity
from tests.llm.test_corpus import SCHEMA, TEXTS, WORD, lower, rows_of


@pytest.fixture(scope="module")
def odd(spark):
    rows = rows_of(TEXTS.items())
    rows += [rows[0], (None, "no id here", None, None, None, None, None, None), (20, "x y " * 30000, *rows[0][2:])]
    rows += [(30, None, None, None, None, None, None, None), (31, "a " * 5 + "\x0b" + "b c " * 4 + "d", *rows[0][2:])]
    return store(spark.createDataFrame(rows, SCHEMA).repartition(3), "odd-runs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# Runs


def plain_runs(words):
    """Every maximal stretch of smallest period q with at least 4 periods and 6 words."""
    numbers = {}
    a = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    found = {}
    for q in range(1, len(a) // 4 + 1):
        same = np.diff(np.concatenate(([0], (a[q:] == a[:-q]).astype(int), [0])))
        for i, j in zip(np.flatnonzero(same == 1), np.flatnonzero(same == -1)):
            if j - i + q >= max(6, 4 * q):
                found.setdefault((int(i), int(j - i + q)), q)
    return sorted(((i, n, q) for (i, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_digest(words):
    runs = plain_runs(words)
    dropped = {k for i, n, q in runs for k in range(i + q, i + n)}
    start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    return (
        len(runs), start, length, period, 1000 * length // period if runs else None,
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in dropped).encode()).hexdigest(),
    )


def cycled(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_runs_of_random_words():
    random.seed(7)
    for _ in range(800):
        words = []
        while len(words) < random.randint(0, 50):
            block = [random.choice("abc"[: random.randint(1, 3)]) for _ in range(random.randint(1, 5))]
            words += block * random.randint(1, 7)
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        (start, length, period), _, _, _ = word_runs.chunk_runs(data, np.array([0, len(data)]))
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == plain_runs(words), words


def test_common_extensions():
    random.seed(3)
    symbols = [random.randint(1, 2) for _ in range(200)]
    rank, returns = word_runs.SuffixTree(symbols).tour()
    a, b = np.array(list(itertools.combinations(range(200), 2))).T
    plain = [next((k for k in range(200 - j) if symbols[i + k] != symbols[j + k]), 200 - j) for i, j in zip(a, b)]
    assert word_runs.common_extensions(rank, returns, a, b).tolist() == plain


def test_words_that_hash_alike_are_told_apart():
    """Thue-Morse words and their mirrors have one polynomial hash, so the cut keeps them, but they are no run."""
    a = "".join("xy"[bin(i).count("1") % 2] for i in range(1024))
    b = a.translate(str.maketrans("xy", "yx"))
    for words in ([a, b] * 6, [a, b, b, a, b, a, a, b] * 2, [a] * 7 + [b] * 3):
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        (start, length, period), _, _, _ = word_runs.chunk_runs(data, np.array([0, len(data)]))
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == plain_runs(words)


def test_run_digests(spark, odd, empty, sf_dir):
    wanted = Counter()
    for r in odd.collect():
        wanted[(r.doc_id, *plain_digest(re.findall(WORD, r.text or "")))] += 1
    assert Counter(map(tuple, word_runs.run_digests(odd).collect())) == wanted
    assert word_runs.run_digests(empty).isEmpty()
    whole = {r.doc_id: r for r in word_runs.word_runs(odd).collect()}
    assert whole[20].collapsed == "x y" and [tuple(r) for r in whole[20].runs] == [(0, 60000, 2)]
    assert whole[31].collapsed == "a a a a a b c d" and whole[30].runs == []


def test_run_query(spark, sf_dir):
    wanted = {
        (r.doc_id, *plain_digest(cycled(r.doc_id, re.findall(WORD, r.text or ""))))
        for r in table(spark, sf_dir, "documents").collect()
    }
    assert set(map(tuple, op11_word_runs(spark, sf_dir).collect())) == wanted


def test_cycled_odd_rows(odd, empty):
    wanted = Counter()
    for r in odd.collect():
        wanted[r.doc_id, tuple(cycled(r.doc_id, re.findall(WORD, r.text or "")))] += 1
    got = Counter((r.doc_id, tuple(re.findall(WORD, r.text or ""))) for r in word_runs.cycled(odd).collect())
    assert got == wanted and word_runs.cycled(empty).isEmpty()


# Toxicity


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(100):
        n = int(rng.integers(1, 8))
        score, change, begin = rng.normal(0, 2, n), rng.normal(0, 1, (2, 2)), rng.normal()
        change[0, 0] = 0
        total, of_word = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=n):
            value = begin * tags[0] + score @ np.array(tags)
            value = math.exp(value + sum(change[a, b] for a, b in zip(tags, tags[1:])))
            total, of_word = total + value, of_word + value * np.array(tags)
        found = toxicity.chain_marginals(np.append([0.5, -1], score), np.array([0, 2, 2, 2 + n]), begin, change)
        assert np.allclose(found[2:], of_word / total)


def test_lanes_do_not_change_marginals(monkeypatch):
    rng = np.random.default_rng(2)
    score, change = rng.normal(0, 3, 5000), np.array([[0, 0.3], [-0.2, 1.1]])
    borders = np.array([0, 1, 1, 700, 5000])
    whole = toxicity.chain_marginals(score, borders, 0.4, change)
    monkeypatch.setattr(toxicity, "LANES", 3)
    assert np.allclose(whole, toxicity.chain_marginals(score, borders, 0.4, change))


def test_field_learns_transitions():
    """A word without features is toxic between toxic words only."""
    tags = np.tile(np.array([[0, 1, 1, 1, 0, 0]], np.int8), (200, 1))
    hit_row = np.concatenate([np.arange(200) * 6 + 1, np.arange(200) * 6 + 3])
    field = toxicity.fit_field(tags, np.ones(tags.shape, bool), hit_row, np.zeros(400, np.int64),
                               np.array([5], np.uint64), rounds=200)
    score = field.bias + np.array([0, 1, 0, 1, 0, 0]) * field.dictionary.weights[0]
    p = toxicity.chain_marginals(score, np.array([0, 6]), field.begin, field.change)
    assert (p > 0.5).tolist() == [False, True, True, True, False, False]


def test_held_out_toxicity(spark, sf_dir):
    # The smallest tables hold eight toxic documents to learn from.
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    result = op12_toxicity(spark, sf_dir)
    rows = result.join(labels, "doc_id").collect()
    assert result.count() == documents.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in rows if r.held_out and r.toxic is not None]
    assert sum(r.predicted for r in held if r.toxic) >= 0.7 * sum(r.toxic for r in held)
    assert sum(r.predicted for r in held if not r.toxic) <= 0.03 * len(held)


def test_toxic_spans(spark, odd, empty):
    rng = random.Random(4)
    plain = "the of and river stone cloud light paper table window".split()
    texts, marks = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(30)]
        if i % 4 == 0:
            words[rng.randrange(30)] = "Vile" + rng.choice(["", "ness", "r"])
        texts.append((i, " ".join(words) + " é", "", "", 0, "", 0, None))
        marks.append((i, 1 if i % 4 == 0 else 0))
    marks += [(None, 1), (3, None)]
    docs = spark.createDataFrame(texts, SCHEMA)
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    for r in toxicity.tag_toxic(docs, model).collect():
        text = texts[r.doc_id][1]
        assert [text[s.start:s.end].startswith("Vile") for s in r.spans] == [True] * len(re.findall("Vile", text))
        assert (r.score >= 0.7) == (r.doc_id % 4 == 0)
    strange = toxicity.tag_toxic(odd, model)
    assert Counter(r.doc_id for r in strange.collect()) == Counter(r.doc_id for r in odd.collect())
    by_id = {r.doc_id: r.score for r in strange.collect()}
    assert by_id[4] == by_id[5] == by_id[11] and 0 <= by_id[4] < 0.7
    assert toxicity.tag_toxic(empty, model).isEmpty()


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(odd, none).collect()} == {0.0}
    alike = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(odd, alike).collect()} == {1.0}


# Ranked search

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_ranking(docs, items, k):
    counts = [(doc_id, Counter(re.findall(TERM, lower(text)))) for doc_id, text in docs]
    counts = [(doc_id, c) for doc_id, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = Counter()
    for item_id, text in set(items):
        scored = []
        for doc_id, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t in re.findall(TERM, lower(text)) if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            found[item_id, rank, doc_id, -score] += 1
    return found


@pytest.mark.parametrize("k", [1, 3, 20])
def test_ranking(spark, odd, empty, k, monkeypatch):
    items = [
        (1, "the quick fox under the MIT license"), (2, "word word word"), (3, ""), (4, None), (5, "zzz unknown"),
        (6, "no id here one two"), (1, "the quick fox under the MIT license"), (7, "x y a b cc"), (2, "é tail b"),
    ]
    wanted = plain_ranking([(r.doc_id, r.text) for r in odd.collect()], [(i, t or "") for i, t in items], k)
    given = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, doc_id int, rank int")
    for part_bytes in (1 << 20, 20):
        assert Counter(map(tuple, ranked_search.rank_documents(odd, given, k, part_bytes).collect())) == wanted
    assert ranked_search.rank_documents(empty, given, k).isEmpty()
    assert ranked_search.rank_documents(odd, given.limit(0), k).isEmpty()


def test_accumulators_are_limited_and_results_exact():
    rng = np.random.default_rng(6)
    for _ in range(200):
        rows, k = 300, int(rng.integers(1, 6))
        terms = []
        for weight in sorted(rng.integers(1, 5000, 8).tolist(), reverse=True):
            places = np.sort(rng.choice(rows, int(rng.integers(1, rows)), replace=False))
            gains = weight * rng.integers(1, 50, len(places))
            terms.append((int(gains.max()), places, gains))
        exact = np.zeros(rows, np.int64)
        for _, places, gains in terms:
            exact[places] += gains
        found, scores, made = ranked_search.best_of_block(terms, rows, k, 0)
        assert (scores == exact[found]).all()
        best = sorted(range(rows), key=lambda i: (-exact[i], i))[:k]
        assert sorted(found.tolist(), key=lambda i: (-exact[i], i))[:k] == best
    # One rare term decides: the frequent ones make no accumulators.
    frequent = [(3, np.arange(300), np.full(300, 3))] * 4
    found, _, made = ranked_search.best_of_block([(1000, np.array([7, 9]), np.array([900, 1000])), *frequent], 300, 2, 0)
    assert made == 2 and found.tolist() == [7, 9]


def test_terms_of_one_hash_are_told_apart(spark):
    a = "".join("xy"[bin(i).count("1") % 2] for i in range(1024))
    b = a.translate(str.maketrans("xy", "yx"))
    docs = spark.createDataFrame([(1, a), (2, b), (3, a + " " + b), (4, "c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, a), (2, b + " " + a)], "item_id long, text string")
    wanted = plain_ranking([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()], 20)
    assert Counter(map(tuple, ranked_search.rank_documents(docs, items).collect())) == wanted
