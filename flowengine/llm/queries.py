"""The operators' named queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowengine.llm import (
    bpe,
    cap_filters,
    decontamination,
    exact_topk,
    language_id,
    line_templates,
    merkle,
    quality,
    simhash,
    source_mixing,
    spelling,
    token_counts,
    url_filter,
)
from flowengine.llm.common import table

TOKENIZER = "byte_bpe_50k.json"

#: The rules by which the `pages` URLs are judged.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: One in so many words is misspelt before words are counted.
NOISE = 199


def tokenizer_path() -> str:
    """The vocabulary's place, the same on the driver and every executor."""
    return public_tokenizers.path(TOKENIZER)


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk.search(vectors, F.col("vec_id") % 100 == 0)


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of recurring templates."""
    kept = line_templates.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "text", "n_lines", "n_dropped")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    _, shares = source_mixing.mix(table(spark, sf_dir, "documents"))
    return shares.select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots"
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    documents = table(spark, sf_dir, "documents")
    profiles = language_id.learn(documents.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.predict(documents, profiles).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document: its source is the host, its language the path."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path")
    )
    return quality.score(documents, table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict for every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.build_index(rules))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and verdict, with some texts tampered with."""
    copied = merkle.tampered_text(F.col("doc_id"), F.col("text"))
    leaves = table(spark, sf_dir, "documents").select(
        "doc_id", "source", merkle.leaf().alias("digest"),
        merkle.leaf(text=copied).alias("claimed"),
    )
    return merkle.verified(merkle.manifest(leaves))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document has of the benchmark's items."""
    found = decontamination.find(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form and root of every word that occurs five times, with one in 199 misspelt."""
    counted = spelling.count_words(table(spark, sf_dir, "documents"), noise=NOISE)
    return spelling.variants(counted.where(F.col("n") >= spelling.MIN_COUNT))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Each callable takes (spark, sf_dir) and returns a DataFrame."""
    return {
        "op1_exact_topk": op1_exact_topk,
        "op2_embedding_near_dedup": op2_embedding_near_dedup,
        "op3_line_dedup": op3_line_dedup,
        "op4_source_mixing": op4_source_mixing,
        "op5_token_counts": op5_token_counts,
        "op6_language_id": op6_language_id,
        "op7_quality": op7_quality,
        "op8_url_filter": op8_url_filter,
        "op9_simhash_near_dedup": op9_simhash_near_dedup,
        "op10_bpe_round_trip": op10_bpe_round_trip,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_benchmark_decontamination": op12_benchmark_decontamination,
        "op13_spelling_variants": op13_spelling_variants,
        "pipeline": corpus_pipeline.run,
    }
