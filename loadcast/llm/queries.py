"""The registered queries of the operators. None can be put in SQL; `tests/llm` holds them against plain versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm import (
    bpe, collision_knn, html_text, license_scan, minhash_join, packing, ppm, quality, ranked_search, rollups,
    suffix_dedup, toxicity, word_runs,
)
from loadcast.llm.common import store, table
from loadcast.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all documents under two tokenizers by source and language, null keys being keys of their own.

    They are reached by loads of both, a withdrawal and a return of the documents without tokens, a revision of counts
    and its opposite, replays of batches, which add nothing, and a compaction in between.
    """
    docs, keys = table(spark, sf_dir, "documents"), ["source", "lang"]
    words = store(bpe.count_table(docs, keys).withColumn("tokenizer", F.lit("word_bpe_49k")), "words")
    pieces = store(rollups.library_counts(docs, keys).withColumn("tokenizer", F.lit("byte_bpe_50k")), "pieces")
    rollup = rollups.Rollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("words", rollups.inserted(words))
    empty = words.filter("n_tokens = 0")
    rollup.commit("withdrawn", rollups.deleted(empty))
    rollup.commit("pieces", rollups.inserted(pieces))
    rollup.compact()
    longer = pieces.withColumn("n_tokens", F.col("n_tokens") + 1)
    rollup.commit("with ends", rollups.revised(pieces, longer))
    rollup.commit("words", rollups.inserted(words))
    rollup.commit("returned", rollups.inserted(empty))
    rollup.commit("without ends", rollups.revised(longer, pieces))
    rollup.commit("without ends", rollups.revised(longer, pieces))
    return rollup.totals()


def op3_collision_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_knn.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"))


def op7_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ppm.score_documents(docs, ppm.file_blocks(docs), ppm.held_out())


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.run_digests(word_runs.cycled(table(spark, sf_dir, "documents")))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_best_fit_packing, op2_token_counts, op3_collision_knn, op4_suffix_dedup, op5_minhash_near_dedup, op6_bpe,
        op7_ppm_scores, op8_quality_rules, op9_license_scan, op10_html_text, op11_word_runs, op12_toxicity,
        op13_ranked_search,
    )
}

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
TERMS = r"unnest(regexp_extract_all(translate(coalesce(text, ''), %s), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))" % LETTERS

ORACLE: dict[str, str] = {
    "op13_ranked_search": f"""
        WITH held AS (SELECT doc_id, {TERMS} AS term FROM documents),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY ALL),
        sizes AS (SELECT doc_id, count(*) AS n FROM held GROUP BY ALL),
        whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
        norms AS (SELECT doc_id, 75 + (25 * n * docs) // words AS m FROM sizes, whole),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, whole GROUP BY term, docs
        ),
        wanted AS (SELECT item_id, {TERMS} AS term FROM benchmark),
        asked AS (SELECT item_id, term, count(*) AS times FROM wanted GROUP BY ALL),
        scored AS (
            SELECT item_id, doc_id,
                CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
            FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN norms USING (doc_id)
            GROUP BY ALL
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
            doc_id, score
        FROM scored WHERE score > 0
        QUALIFY rank <= 20
    """,
}
