"""The registered queries of the subpackage: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import (
    alignment, bpe, divergence, forest, impact, labelled, packing, quality, setsketch, substrings, tokenfile, toxicity, unigram, warc,
)
from curbline.llm.frames import table
from curbline.session import new_work_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text that they decode to."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), WORDS).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages hold, read back from them."""
    files = warc.write_archives(warc.chunk_table(table(spark, sf_dir, "pages")), new_work_dir(spark, "warc"))
    return warc.read_records(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces and score of the best unigram segmentation of every document."""
    return unigram.count_tokens(table(spark, sf_dir, "documents"), PIECES)


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, from the files that hold them."""
    files = tokenfile.write_ids(table(spark, sf_dir, "documents"), BYTES, new_work_dir(spark, "token-ids"))
    return tokenfile.read_ids(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def scored(docs: DataFrame, score, held_out) -> DataFrame:
    return docs.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int")
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by trees that are fitted on labels outside of the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, quality.score(F.col("text"), model), labelled.held_out("doc_id", quality.FOLDS, quality.TEST_FOLD))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a grammar that is fitted on labels outside of the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, toxicity.score(F.col("text"), grammar), labelled.held_out("doc_id", toxicity.FOLDS, toxicity.TEST_FOLD))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of several lengths."""
    return packing.pack(packing.lengths(table(spark, sf_dir, "documents"), BYTES))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by word shingles."""
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors by cosine."""
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 20 rows for every twentieth vector."""
    return impact.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ, and by which terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that stand earlier."""
    return substrings.dedup(table(spark, sf_dir, "documents"), size=20).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers lie over each other in every document."""
    return alignment.align(table(spark, sf_dir, "documents"), BYTES, PIECES).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe, op2_warc, op3_token_counts, op4_quality, op5_toxicity, op6_packing, op7_minhash, op8_token_file,
        op9_embeddings, op10_topk, op11_divergence, op12_substrings, op13_alignment,
    )
}
