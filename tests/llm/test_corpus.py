"""Every operator against a plain version, and on nulls, empty and repeated rows, empty tables and clashing columns."""

import datetime as dt
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadcast.llm import (
    bpe, collision_knn, html_text, license_scan, minhash_join, packing, ppm, quality, rollups, suffix_dedup,
)
from loadcast.llm.common import components, store, table

# Names that operators use inside, as extra columns.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, key int, block date"
WORD = r"[^\x20\x09-\x0D]+"
PASSAGE = "the quick brown fox jumps over the lazy dog while " * 3
TEXTS = {
    1: PASSAGE + "one", 2: PASSAGE + "one", 3: "Other start. " + PASSAGE + "two", 4: "", 5: None, 6: "word",
    7: "a b\nc", 8: "é" * 130 + " tail", 9: "ab" * 200, 10: "It's Under the MIT License, <|endoftext|> ÀÉ 12 İ",
    11: " \t\n ", 12: "cc by nc cc by nc", 13: "word",
}


def rows_of(texts):
    return [(i, t, "en", "s", len(t or ""), "x", 1, dt.date(2024, 1, 1)) for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows: nulls in every column, a repeated row, and one very long text."""
    rows = rows_of(TEXTS.items())
    rows += [rows[0], (None, "no id here", None, None, None, None, None, None), (20, "x y " * 60000, *rows[0][2:])]
    return store(spark.createDataFrame(rows, SCHEMA).repartition(3), "odd")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return store(table(spark, sf_dir, "documents"), "docs")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (3, 1), (5, 5), (7, 8), (20, 19), (19, 18), (18, 17), (17, 16)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {
        1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, **{n: 16 for n in range(16, 21)}
    }
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


# Encoding


def test_encoding_equals_the_library(docs, odd, empty):
    library = Tokenizer.from_file(bpe.TOKENIZER)
    for df in (odd, docs):
        source = df.select("doc_id", "text").collect()
        wanted = Counter()
        for r in source:
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            raw = np.array(ids, "<u4").tobytes()
            back = library.decode(ids, skip_special_tokens=False).encode()
            wanted[r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back).hexdigest()] += 1
        assert Counter(map(tuple, bpe.encode_digests(df).collect())) == wanted
    assert bpe.encode_digests(empty).isEmpty()
    whole = {r.doc_id: r for r in bpe.encode_table(odd).collect()}
    assert np.frombuffer(whole[6].ids, "<u4").tolist() == library.encode("word", add_special_tokens=False).ids
    assert whole[4].ids == b"" and whole[4].decoded == ""


def test_encoding_of_hard_strings():
    library, own = Tokenizer.from_file(bpe.TOKENIZER), bpe.encoder(bpe.TOKENIZER)
    rng = np.random.default_rng(1)
    letters = list("abcsstemdlrv'\"  \n\t.,!-0123é€ßÉ漢字Σςİǆ́̈\xa0\x85\x1c　１½Ⅷ😀ﬁ각")
    hard = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(800)]
    hard += ["aaaa" * 9, "<|endoftext|>", "a<|endoftext|><|startoftext|>b", "it's we'll 'sabc !'s", "'", "x'", "'s"]
    ids, offsets = own.encode(hard)
    for text, a, b in zip(hard, offsets[:-1], offsets[1:]):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_merges_only_use_earlier_tokens():
    """Merging all places of a pair at once needs tokens to be made before they are used."""
    import json

    with open(bpe.TOKENIZER, encoding="utf-8") as file:
        merges = json.load(file)["model"]["merges"]
    rank = {a + b: i for i, (a, b) in enumerate(merges)}
    assert len(rank) == len(merges)
    assert all(rank.get(part, -1) < i for i, pair in enumerate(merges) for part in pair)


# Packing


def test_packing_is_whole_and_tight(docs, odd, empty):
    library = Tokenizer.from_file(bpe.TOKENIZER)
    for df in (odd, docs):
        wanted = Counter()
        for r in df.select("doc_id", "text").collect():
            ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
            for k, a in enumerate(range(0, len(ids), 4096)):
                part = np.array(ids[a:a + 4096], "<u4")
                wanted[r.doc_id, k, a, len(part), zlib.crc32(part.tobytes())] += 1
        packed = packing.pack_documents(df).toPandas()
        key = packed[["doc_id", "piece", "start", "length", "ids_crc32"]]
        got = Counter(tuple(None if v != v else int(v) for v in row) for row in key.itertuples(index=False))
        assert got == wanted
        ordered = packed.sort_values(["sequence_id", "offset"])
        before = ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"]
        assert (before == ordered["offset"]).all()
        assert packed.groupby("sequence_id")["length"].sum().max() <= 4096
        assert packed["sequence_id"].nunique() <= math.ceil(packed["length"].sum() / 4096) + 1
    assert packing.pack_documents(empty).isEmpty()


def test_blocks_are_packed_again(docs):
    pieces = store(packing.cut_pieces(docs), "pieces")
    packed = packing.pack(pieces, block_tokens=60_000).toPandas()
    assert len(packed) == pieces.count() and packed.groupby("sequence_id")["length"].sum().max() <= 4096
    assert packed["sequence_id"].nunique() <= 1 + math.ceil(packed["length"].sum() / 4096)


def test_bin_completion_beats_best_fit():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1200, 1500, 200).tolist()
    found = packing.complete_bins(lengths, 4096)
    assert sorted(x for b in found for x in b) == sorted(lengths) and max(map(sum, found)) <= 4096
    assert len(found) < len(packing.best_fit(lengths, 4096))
    assert packing.complete_bins([], 4096) == []
    assert len(packing.complete_bins([2, 2, 2, 3, 3, 3, 5, 5, 5], 10)) == 3


def fewest_bins(lengths, capacity):
    """By all subsets: the fewest bins, and the least content of the last one."""
    best = [(1, 0)] + [(len(lengths) + 1, 0)] * (2 ** len(lengths) - 1)
    for chosen in range(1, len(best)):
        for i, length in enumerate(lengths):
            if chosen >> i & 1:
                bins, used = best[chosen ^ 1 << i]
                best[chosen] = min(best[chosen], (bins, used + length) if used + length <= capacity else (bins + 1, length))
    return best[-1][0]


def test_bin_completion_is_exact_on_small_cases():
    rng = np.random.default_rng(5)
    for _ in range(150):
        lengths = rng.integers(8, 60, rng.integers(4, 11)).tolist()
        found = packing.complete_bins(lengths, 100)
        assert sorted(x for b in found for x in b) == sorted(lengths) and max(map(sum, found)) <= 100
        assert len(found) == fewest_bins(lengths, 100)
    # Pieces that fill their bins, for which greedy fillings end one bin above the minimum.
    assert len(packing.complete_bins([62, 7, 31, 30, 68, 2, 70, 24, 6, 54, 40, 6], 100)) == 4
    assert len(packing.complete_bins([332, 133, 76, 459, 87, 508, 85, 320, 40, 436, 297, 227], 1000)) == 3
    found = list(packing.every_filling([10, 30, 35, 60], [1, 1, 1, 1], 100, 100))
    assert {f for f in found if f} == {(60, 35), (60, 30, 10)}
    assert list(packing.every_filling([], [], 7, 7)) == [()]


# Rollups


def test_rollups_are_idempotent(spark, tmp_path):
    rows = [("a", "en", "v1", 3), ("a", "en", "v1", 4), (None, "en", "v1", 5), ("b", None, "v1", None)]
    df = spark.createDataFrame(rows, "source string, lang string, tokenizer string, n_tokens long")
    df = df.withColumns({"n_docs": F.lit("clash"), "batch": F.lit(1)})
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    assert rollup.commit("load/1", rollups.inserted(df)) and not rollup.commit("load/1", rollups.inserted(df))

    def totals():
        return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}

    loaded = {("a", "en", "v1"): (2, 7), (None, "en", "v1"): (1, 5), ("b", None, "v1"): (1, 0)}
    assert totals() == loaded
    rollup.compact()
    assert totals() == loaded and not rollup.commit("load/1", rollups.inserted(df))
    one = df.filter("n_tokens = 4")
    rollup.commit("revise", rollups.revised(one, one.withColumn("n_tokens", F.lit(9))))
    rollup.commit("delete", rollups.deleted(df.filter("source IS NULL")))
    rollup.commit("nothing", rollups.inserted(df.limit(0)))
    rollup.compact()
    assert totals() == {("a", "en", "v1"): (2, 12), ("b", None, "v1"): (1, 0)}


def test_broken_batch_is_written_anew(spark, tmp_path):
    df = spark.createDataFrame([("a", "en", "v", 3)], "source string, lang string, tokenizer string, n_tokens long")
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    rollup.commit("one", rollups.inserted(df))
    (tmp_path / "r/batches/one/_SUCCESS").unlink()
    assert rollup.commit("one", rollups.inserted(df))
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v", 1, 3)]


# Nearest neighbours


def test_neighbours(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    ids, vectors = zip(*((r.vec_id, r.embedding) for r in df.orderBy("vec_id").collect()))
    ids, vectors = np.array(ids), np.array(vectors, float)
    found = collision_knn.nearest(df, F.col("vec_id") % 20 == 0, 20).toPandas()
    hits = total = 0
    for q, group in found.groupby("query_id"):
        scores = (vectors * vectors[ids == q]).sum(1)
        near = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        hits += len({*ids[near]} & {*group["vec_id"]})
        total += 20
        group = group.sort_values("rank")
        assert group["rank"].tolist() == list(range(1, 21))
        assert (scores[np.searchsorted(ids, group["vec_id"])] == group["score"]).all()
    assert total == 20 * (ids % 20 == 0).sum() and hits >= 0.9 * total


def test_neighbours_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, [1.0]), (8, [-1.0, 5.0]), (20, [2.0, 0.0]), (None, [1.0, 1.0]), (9, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("dim", F.lit("clash"))
    found = collision_knn.nearest(df, F.col("vec_id") % 20 == 0, 3)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 2.0), (20, 1, 1, 4.0), (20, 2, 2, 4.0), (20, 3, 0, 2.0)]
    assert collision_knn.nearest(df.limit(0), F.col("vec_id") % 20 == 0, 3).isEmpty()


# Repeats


def repeats_by_hand(rows):
    """Per (doc_id, text) the flags of repeated bytes; rows are in the operator's order of documents."""
    seen, out = set(), {}
    for key, raw in rows:
        cover = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - 99):
            window = raw[i:i + 100]
            if window in seen:
                cover[i] += 1
                cover[min(i + 100, len(raw))] -= 1
            seen.add(window)
        out[key] = np.cumsum(cover[:-1]) > 0
    return out


def digest_of(raw, gone):
    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
    spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
    return len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("many,keys", [(5000, 1_500_000), (2, 3)])
def test_repeats_equal_brute_force(docs, odd, empty, monkeypatch, many, keys):
    monkeypatch.setattr(suffix_dedup, "MANY_SEGMENTS", many)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_KEYS", keys)
    for df in (docs, odd):
        rows = {(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()}
        ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
        gone = repeats_by_hand([(k, k[1]) for k in ordered])
        wanted = {(k[0], *digest_of(k[1], g)) for k, g in gone.items()}
        found = suffix_dedup.digests(df).collect()
        assert set(map(tuple, found)) == wanted and len(found) == df.count()
    assert suffix_dedup.digests(empty).isEmpty()


def test_cut_documents_keep_characters_and_columns(odd):
    cut = suffix_dedup.cut_documents(odd)
    assert cut.columns == odd.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    # The passage repeats within the first document as well.
    assert left[1] == PASSAGE[:50] + "one"
    assert 2 not in left and left[3] == "Other start.wo" and left[5] is None and left[4] == ""
    assert set(left[8]) == {"é", *" tail"}


def test_columns_in_files_and_steps():
    rng = np.random.default_rng(5)
    for turn in range(8):
        base = bytes(rng.choice([97, 98], 60).tolist())
        strings = [b"c" + base[a:a + n] + bytes(rng.choice([97, 98, 99], 4).tolist())
                   for a, n in rng.integers(0, 30, (20, 2)).tolist()]
        data, ends = np.frombuffer(b"".join(strings), np.uint8), np.cumsum([len(s) for s in strings])
        starts = np.concatenate(([0], ends[:-1]))
        options = {"step": 7, "limit": 5} if turn % 2 else {}
        place, common = (np.concatenate(c) for c in zip(*suffix_dedup.sort_columns(data, starts, ends, 10, **options)))
        suffixes = [data[p:ends[np.searchsorted(ends, p, "right")]].tobytes() for p in place]
        assert suffixes == sorted(suffixes) and len(suffixes) == len(data)
        for a, b, shared in zip(suffixes, suffixes[1:], common[1:]):
            if min(len(a), len(b)) >= 10:
                assert shared == next((i for i in range(10) if a[i] != b[i]), 10)


# Near duplicates


def near_by_hand(rows, size, percent=80):
    """Component per row number, and set sizes."""
    sets = []
    for text in rows:
        words = re.findall(WORD, lower(text))
        many = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
        sets.append(frozenset(many or ([tuple(words)] if words else [])))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        common = Counter(j for s in own for j in holders[s])
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in own:
            holders[s].append(i)
    return [find(i) for i in range(len(rows))], [len(s) for s in sets]


@pytest.mark.parametrize("size,small", [(2, 8), (5, 2)])
def test_near_duplicates_equal_brute_force(docs, odd, empty, monkeypatch, size, small):
    monkeypatch.setattr(minhash_join, "SMALL_BUCKET", small)
    for df in (docs, odd):
        rows = df.select("doc_id", "text").collect()
        roots, sizes = near_by_hand([r.text for r in rows], size)
        least = {}
        for r, root in zip(rows, roots):
            least[root] = min((i for i in (least.get(root), r.doc_id) if i is not None), default=None)
        wanted = Counter()
        for r, root, n in zip(rows, roots, sizes):
            component = least[root] if n else r.doc_id
            wanted[r.doc_id, n, component, r.doc_id == component] += 1
        found = minhash_join.near_duplicates(df, size)
        assert Counter(tuple(r)[:4] for r in found.collect()) == wanted
    assert minhash_join.near_duplicates(empty, size).isEmpty()


def test_few_equal_symbols_are_compared(spark):
    """A pair that shares one key and nothing else of its signatures goes to the exact check."""
    one = list(range(minhash_join.SYMBOLS))
    other = [v if v in (0, 1, 3, 4) else v + 1000 for v in one]
    rows = [(7, 2, 1, 10, one), (7, 2, 2, 9, other), (7, 2, 3, 5, other)]
    df = spark.createDataFrame(rows, "key long, spot int, node long, n_shingles long, signature array<int>")
    assert [tuple(r) for r in minhash_join._small_bucket_pairs(df, 80).collect()] == [(1, 2)]


def test_large_group_of_near_copies(spark):
    """A base with copies that each change a few words; some are too far from all others."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        own = list(words)
        for place in rng.choice(120, rng.integers(0, 12), replace=False):
            own[place] = f"x{i}_{place}"
        rows.append(" ".join(own))
    roots, _ = near_by_hand(rows, 2)
    found = minhash_join.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), 2)
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(roots))


def test_large_groups_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Twice the near copies need less than four times the comparisons, and a second group inside is found."""
    counts = []
    compared = minhash_join._compared

    def counted(*args, **kwargs):
        out = compared(*args, **kwargs)
        counts[-1] += out.count()
        return out

    monkeypatch.setattr(minhash_join, "_compared", counted)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(120)]
    for size in (150, 300):
        rows = []
        for i in range(size):
            own = list(words)
            if i % 3 == 0:
                own[::9] = [f"other{j}" for j in range(len(own[::9]))]
            for place in rng.choice(120, rng.integers(0, 12), replace=False):
                own[place] = f"x{i}_{place}"
            rows.append(" ".join(own))
        roots, _ = near_by_hand(rows, 2)
        counts.append(0)
        df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
        found = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(df, 2).collect()}
        assert found == dict(enumerate(roots))
    assert counts[1] < 4 * counts[0]


def test_shingles_that_come_too_late_are_not_joined(spark, monkeypatch):
    """Near copies that share many of their changes meet through the rarest ones only, and no link is lost."""
    joined = []
    centre_pairs = minhash_join._centre_pairs

    def counted(index, percent):
        joined.append(index.count())
        return centre_pairs(index, percent)

    monkeypatch.setattr(minhash_join, "_centre_pairs", counted)
    rng = np.random.default_rng(11)
    rows = []
    for _ in range(300):
        own = [f"w{i}" for i in range(120)]
        for place in rng.choice(120, rng.integers(0, 26), replace=False):
            own[place] = f"y{place}_{rng.integers(0, 2)}"
        rows.append(" ".join(own))
    roots, _ = near_by_hand(rows, 2)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(df, 2).collect()}
    assert found == dict(enumerate(roots))
    assert joined and max(joined) < 30 * len(rows)


@pytest.mark.parametrize("percent", [50, 80])
def test_linked_rows_share_a_shingle_of_the_index(spark, percent):
    """Rows of many distances and sizes around a pivot: all links of a row that stands apart are met."""
    rng = np.random.default_rng(percent)
    pivot = set(range(60))
    sets = []
    for i in range(120):
        # Six families at growing distance from the pivot, each row a few shingles off its family.
        far = 4 * (i % 6)
        family = pivot - set(range(far)) | set(range(100 * far, 100 * far + far))
        gone = rng.choice(sorted(family), rng.integers(0, 9), replace=False).tolist()
        new = rng.choice(60, rng.integers(0, 9), replace=False).tolist()
        sets.append(family - set(gone) | {100 + n for n in new})

    def linked(one, other):
        return 100 * len(one & other) >= percent * len(one | other)

    apart = [not linked(pivot, s) for s in sets]
    stars = spark.createDataFrame(
        [(i, -1, len(s), 60, len(s & pivot), sorted(s ^ pivot)) for i, s in enumerate(sets)],
        "a long, b long, n_a int, n_b int, common int, delta array<long>",
    )
    placed = spark.createDataFrame([(i, -1, a) for i, a in enumerate(apart)], "node long, pivot long, apart boolean")
    index = minhash_join._delta_index(placed, stars, percent).withColumn("root", F.col("node"))
    met = {(r.a, r.b) for r in minhash_join._index_pairs(index, percent).collect()}
    wanted = {
        (i, j) for j in range(len(sets)) for i in range(j)
        if sets[i] != sets[j] and (apart[i] or apart[j]) and linked(sets[i], sets[j])
    }
    assert len(wanted) > 20 and wanted <= met
    assert index.count() * 3 < sum(len(s ^ pivot) for s in sets) * 2


# Language model


def model_by_hand(train, order):
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for text in train:
        raw = b"\xff" * order + lower(text).encode() + b"\xff"
        for at in range(order, len(raw)):
            for j in range(order + 1):
                counts[j][raw[at - j:at]][raw[at]] += 1

    def log(context, symbol):
        out, total = set(), 0.0
        for j in range(order, -1, -1):
            left = {s: n for s, n in counts[j].get(context[order - j:], {}).items() if s not in out}
            if not left:
                continue
            parts = sum(left.values()) + len(left)
            if symbol in left:
                return total + math.log10(left[symbol] / parts)
            total += math.log10(len(left) / parts)
            out |= left.keys()
        return total - math.log10(256 - len(out))

    return log


@pytest.mark.parametrize("whole", [False, True])
def test_scores_equal_a_plain_model(odd, whole):
    rows = odd.select("doc_id", "text").filter("doc_id IS NULL OR doc_id <> 20").collect()
    df = odd.filter("doc_id IS NULL OR doc_id <> 20")
    out = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    train = [r.text for r, o in zip(rows, out) if not o]
    tokens = Counter(t for text in train for t in [*re.findall(WORD, lower(text)), None])
    total, kinds = sum(tokens.values()), len(tokens)
    log, order = model_by_hand(train, ppm.ORDER), ppm.ORDER
    wanted = []
    for r, o in zip(rows, out):
        own = [*re.findall(WORD, lower(r.text)), None]
        raw = b"\xff" * order + lower(r.text).encode() + b"\xff"
        score = sum(log(raw[i - order:i], raw[i]) for i in range(order, len(raw)))
        base = sum(math.log10((tokens[t] + 1) / (total + kinds + 1)) for t in own)
        wanted.append((r.doc_id or -1, o, len(own), sum(t in tokens for t in own), total, base, score))
    block = F.lit(1) if whole else F.pmod(F.hash("doc_id", "text"), F.lit(3))
    found = ppm.score_documents(df, block, ppm.held_out()).collect()
    got = [(r.doc_id or -1, *tuple(r)[1:]) for r in found]
    for a, b in zip(sorted(got), sorted(wanted), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6)


def test_probabilities_sum_to_one():
    data = np.frombuffer(b"abracadabra abracadabra", np.uint8)
    packed, _ = ppm.grams(data, np.array([0, len(data)]))
    keys, counts = ppm._summed(packed, np.ones(len(packed)))
    levels = [ppm.Contexts(*ppm.shorter(keys, counts, k)) for k in range(ppm.ORDER + 1)]
    for context in (keys[5] >> 8, keys[0] >> 8, 0x7A7A7A7A7A):
        everything = (int(context) << 8) + np.arange(256)
        assert (10 ** ppm.log_probabilities(everything, levels)).sum() == pytest.approx(1)


def test_scores_without_training_or_rows(spark, empty):
    assert ppm.score_documents(empty, F.lit(0), ppm.held_out()).isEmpty()
    one = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    row = ppm.score_documents(one, F.lit(0), F.lit(True)).first()
    assert row.score == pytest.approx(-3 * math.log10(256), rel=1e-6) and row.train_tokens == 0 and row.n_known == 0


# Quality


def counts_by_hand(text):
    text = text or ""
    words = re.findall(WORD, text)
    triples = Counter(zip(words, words[1:], words[2:]))
    again = {i + k for i in range(len(words) - 2) if triples[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, double = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            double += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), double, len(again)


def test_quality_counts_and_verdict(spark, sf_dir, docs, odd, empty):
    labels = table(spark, sf_dir, "labels")
    for df in (docs, odd):
        trees = quality.fit_quality(docs, labels)
        wanted = Counter()
        for r in df.select("doc_id", "text").collect():
            n = counts_by_hand(r.text)
            wanted[r.doc_id, *n, n[0] < 50 or 100 * n[4] > 50 * n[0]] += 1
        found = quality.judge(df, trees).collect()
        assert Counter(tuple(r)[:7] for r in found) == wanted
        assert not any(r.kept and r.base_failed for r in found)
        kept = quality.keep_good(df, trees)
        assert kept.columns == df.columns and kept.count() == sum(r.kept for r in found)
    assert quality.quality_rules(empty, labels).isEmpty()
    assert quality.fit_quality(docs, labels.limit(0)) is None


def test_trees_learn_and_hold_out():
    rng = np.random.default_rng(4)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.2)).astype(float)
    trees = quality.fit_trees(x[:2000], y[:2000], falling=(0,))
    assert ((trees.score(x[2000:]) > 0.5) == (y[2000:] > 0)).mean() > 0.97
    line = np.stack([np.linspace(0, 1, 200), np.full(200, 0.7), np.full(200, 0.4)], 1)
    assert (np.diff(trees.score(line)) <= 1e-12).all()
    assert quality.fit_trees(x, np.ones(3000), (0,)) is None


def test_trees_keep_held_out_documents(spark, sf_dir, docs):
    """Fitted on odd ids, judged on even ones."""
    labels = table(spark, sf_dir, "labels").filter("quality IS NOT NULL")
    trees = quality.fit_quality(docs, labels.filter("doc_id % 2 = 1"))
    judged = quality.judge(docs, trees).join(labels.filter("doc_id % 2 = 0"), "doc_id").filter("NOT base_failed")
    right = judged.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right > 0.9


# Licences


def test_licence_places(docs, odd, empty):
    phrases = [(p.split(), label) for p, label in license_scan.PHRASES]
    for df in (docs, odd):
        wanted = Counter()
        for r in df.select("doc_id", "text").collect():
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r.text))
            at = [(i, v) for p, v in phrases for i in range(len(words)) if words[i:i + len(p)] == p]
            places = [i for i, _ in at]
            ends = (min(places), max(places)) if at else (None, None)
            wanted[r.doc_id, len(words), len(at), *ends, ",".join(sorted({v for _, v in at}))] += 1
        found = license_scan.license_report(df).collect()
        assert Counter(tuple(r)[:6] for r in found) == wanted
        assert all(0 <= r.score <= 1 and {*r.base_labels.split(",")} <= {*r.labels.split(","), ""} for r in found)
    assert license_scan.license_report(empty).isEmpty()


def test_licence_spans(spark):
    words = license_scan.TEMPLATES[0][1].split()
    changed = "Intro words here. " + " ".join(words[:30]) + " some odd text " + " ".join(words[33:])
    rows = [(1, changed), (2, "permission is hereby granted to nobody"), (3, " ".join(words * 2))]
    found = license_scan.license_report(spark.createDataFrame(rows, "doc_id long, text string"))
    labels = {r.doc_id: (r.labels, len(r.spans)) for r in found.collect()}
    assert labels[1][0] == "mit" and labels[2][0] == "" and labels[3][0] == "mit"
    span = found.filter("doc_id = 1").first().spans[0]
    assert span.first_word == 3 and 0.6 <= span.share < 1


def test_automaton_knows_all_runs():
    rng = np.random.default_rng(6)
    sequences = [rng.integers(0, 3, n).tolist() for n in (7, 9, 5, 9)]
    automaton = license_scan.SuffixAutomaton(sequences)
    runs = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    text = rng.integers(0, 3, 60).tolist()
    state = length = 0
    for i, word in enumerate(text):
        state, length = automaton.advance(state, length, word)
        longest = max((n for n in range(i + 2) if n == 0 or tuple(text[i + 1 - n:i + 1]) in runs))
        assert length == longest


# Pages


PAGES = (
    ("<html><head><title>T</title></head><body><nav><a href=x>Home</a></nav><div class='ad'>Buy this now please</div>"
     "<article><h1>Head &amp; tail</h1><p>One\n two <b>bold</b>.<br>Next<p>Der.</p><div class=comments><p>Nice one</p>"
     "</div></article><footer>&copy; x</footer></body></html>", "Head & tail\nOne two bold. Next\nDer."),
    ("<article><p>open <script>var a = '</p>';</script>text<!-- no --><style>p{}</style> end", "open text end"),
    ("<main><aside>side words</aside><form>Name <input></form><p>caf&#233; &lt;b&gt;</p></main>", "café <b>"),
    ("", ""), (None, ""), ("<p", ""), ("<article>cut off <b>here</b> &am", "cut off here &am"),
)


def test_pages(spark):
    assert html_text.page_texts([p for p, _ in PAGES]) == [t for _, t in PAGES]
    rows = [(i, f"u{i}", p, "x") for i, (p, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0], None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.extract_text(df).collect()
    wanted = [(r[0], r[1], PAGES[r[0]][1] if r[0] is not None else "") for r in rows]
    assert Counter((r.page_id, r.url, r.text) for r in found) == Counter(wanted)
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_text.extract_text(df.limit(0)).isEmpty()


def test_tree_fits_its_table_and_long_pages():
    rows = np.array(html_text.LABELLED, float)
    assert (html_text.fitted_tree().predict(rows[:, :-1]) == rows[:, -1]).all()
    held = [html_text.Tree(np.delete(rows, i, 0)[:, :-1], np.delete(rows, i, 0)[:, -1]).predict(rows[i:i + 1, :-1])[0]
            == rows[i, -1] for i in range(len(rows))]
    assert np.mean(held) > 0.85
    page = "<article>" + "<p>some words here</p>" * 20000 + "</article>"
    assert html_text.page_texts([page])[0].count("\n") == 19999


CODE_PAGES = (
    ("<body><script>for(i=0;i<n;i++){f(i);}</script><article><p>kept text</p></article>", "kept text"),
    ("<head><script>if(a<b)c='</p>'</script><style>a<b{}</style><title>1 <a 2</title></head><main>kept</main>", "kept"),
    ("<main>one<textarea><b <p></textarea> two<noscript><img src='</noscript> three</main>", "one two three"),
    ("<main><SCRIPT>x<y</scripts></Script >kept <svg><style>a<b</style></svg>too</main>", "kept too"),
    ("<main><script><!-- w('<script>a<b</script>') --></script>kept</main>", "kept"),
    ("<main><script><!-- w('<script>a')</script>kept</main>", "kept"),
    ("<head><title>T</title><meta charset=x><h1>Head of it</h1><main><p>kept</p></main>", "kept"),
    ("<head><title>T</title><main><h1>Head</h1><p>kept</p></main>", "Head\nkept"),
    ("<title>T</title><article>kept</article>", "kept"),
    ("<head><title>T<body><article>kept</article>", "kept"),
    ("<head id=menu><script>a<b</head><body><article>kept</article>", "kept"),
    ("<article>kept <script>a<b", "kept"),
)


PARAGRAPH = "A paragraph of the text that is long enough to be told from a menu entry by its words alone."
# Boilerplate by marks of paragraphs, of compounds and by hidden parts, and pages without any content element.
PLAIN_PAGES = (
    ("<article><p>one</p><p class='ad'>gone</p><p>two</p></article>", "one\ntwo"),
    ("<article><p class=notice>gone<p>one<p class=comment>gone<div>two</div></article>", "one\ntwo"),
    ("<article><p class=ad>gone <b>too</b><p>one</p></article>", "one"),
    ("<article><p hidden>gone</p><div style='color:red; display: none'>gone</div><p>one</p></article>", "one"),
    ("<article><p hidden='until-found'>one</p></article>", "one"),
    ("<article>one<div class='reader-comments'><p>gone</p></div></article>", "one"),
    ("<article>one<ol class='commentlist'><li>gone</ol></article>", "one"),
    ("<article>one<div class='sponsored-content'><p>gone</p></div>two</article>", "one\ntwo"),
    ("<article>one<div id='user-comments'><p>gone</p></div></article>", "one"),
    ("<article><h2 id='comments-section'>Head</h2><p>one</p></article>", "Head\none"),
    (f"<body><h1>Head</h1><p>{PARAGRAPH}</p><h2>Part</h2><p>Short one here.</p><p>{PARAGRAPH}</p></body>",
     f"Head\n{PARAGRAPH}\nPart\nShort one here.\n{PARAGRAPH}"),
    (f"<h1>Head</h1><p>{PARAGRAPH}</p><ul><li>first thing<li>second thing<li>third</ul><p>{PARAGRAPH}</p>",
     f"Head\n{PARAGRAPH}\nfirst thing\nsecond thing\nthird\n{PARAGRAPH}"),
    (f"<ul><li><a href=x>Home</a><li><a href=y>About us</a></ul><h1>Head</h1><p>{PARAGRAPH}</p><p>The end.</p>",
     f"Head\n{PARAGRAPH}\nThe end."),
)


def test_paragraph_marks_and_pages_without_content_elements():
    assert html_text.page_texts([p for p, _ in PLAIN_PAGES]) == [t for _, t in PLAIN_PAGES]
    rows = np.array(html_text.PLAIN, float)
    assert (html_text.plain_tree().predict(rows[:, :-1]) == rows[:, -1]).all()


def test_code_in_pages_and_left_out_tags():
    assert html_text.page_texts([p for p, _ in CODE_PAGES]) == [t for _, t in CODE_PAGES]
    page = "<article>" + "<script><!--<script>a<b</script>" * 20000 + "kept"
    assert html_text.page_texts([page]) == ["kept"]


MARKED_PAGES = (
    ("<div class='layout has-sidebar'><article><p>kept</p></article></div>", "kept"),
    ("<main class='no-sidebar'><p>kept</p></main>", "kept"),
    ("<article class='post comment-status-open'><p>kept</p></article>", "kept"),
    ("<article><h2 id='related-work'>Head</h2><h2 id=search>Two</h2><p>kept</p></article>", "Head\nTwo\nkept"),
    ("<article><section id='search'><p>kept</p></section></article>", "kept"),
    ("<main><div class=section id=search><p>kept</p></div><p data-id=ad data-role='menu'>too</p></main>", "kept\ntoo"),
    ("<article><div data-id='sidebar' title='a class=ad here' xclass=ad><p>kept</p></div></article>", "kept"),
    ("<div class='widget'><article><p>one</p></article><article><p>two</p></article></div>", "one\ntwo"),
    ("<form id=menu><div class=sidebar><main><p>kept</p></main><p>gone</p></div></form>", "kept"),
    ("<main><article>kept</article><div class=related><article>gone</article></div></main>", "kept"),
    ("<div class=sidebar><article>kept<div class=comments><article>gone</article></div></article></div>", "kept"),
    ("<div class=widget><main><article>kept</article><div class=related><article>gone</article></div></main></div>", "kept"),
    ("<div class=widget><article>a<article>b</article></article><article>c</article></div>", "a\nb\nc"),
    ("<article>kept<aside><article>gone</article></aside><div class='ad top'>gone</div> too</article>", "kept\ntoo"),
    ("<article>kept<ul class='comment-list'><li>gone</ul><div class='site__footer'>gone</div></article>", "kept"),
    ("<main>kept<div id=comments>gone</div><div class='Ad-Slot-12'>gone</div><b role=navigation>gone</b></main>", "kept"),
)


def test_marks_are_whole_names():
    assert html_text.page_texts([p for p, _ in MARKED_PAGES]) == [t for _, t in MARKED_PAGES]


# The pipeline


def test_pipeline_takes_effect(spark, sf_dir, docs, texts):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near-duplicate removal", "repeated passages", "best-fit packing"
    ]
    stage = docs
    kept = []
    for name, run in corpus_pipeline.STAGES[:-1]:
        stage = store(run(spark, stage, sf_dir), "stage")
        assert stage.columns == docs.columns
        kept.append({r.doc_id: r.text for r in stage.collect()})
    good, single, cut = kept
    assert set(single) <= set(good) <= set(texts) and all(len(t.split()) >= 50 for t in good.values())
    rows = sorted(good)
    roots, _ = near_by_hand([good[i] for i in rows], 5)
    assert set(single) == {rows[r] for r in set(roots)}
    gone = repeats_by_hand([(i, single[i].encode()) for i in sorted(single)])
    for i, flags in gone.items():
        if not flags.any():
            assert cut[i] == single[i]
        elif i in cut:
            assert len(cut[i].encode()) - (len(flags) - int(flags.sum())) in range(0, 8)
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(cut)
