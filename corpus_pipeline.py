"""From raw documents to token ids: five stages, each over all rows that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowengine.llm import bpe, language_id, line_templates, simhash, source_mixing
from flowengine.llm.common import materialised, table

#: The vocabulary of the last stage.
TOKENIZER = "byte_bpe_50k.json"
#: Words in a shingle and differing bits that still link, for near-duplicates.
SHINGLE, DISTANCE = 3, 2
#: A text whose n-grams are further than this from every language's is in none of them.
LEAST_SCORE = 0.3

_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are in one of the languages learned from the labelled ones. Texts
    without a letter, or unlike all languages, go; a wrong `lang` is no reason to go."""
    profiles = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    judged = language_id.predict(docs, profiles)
    found = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return judged.where(found).select(*_COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines whose template was in an earlier document."""
    return line_templates.drop_recurring_lines(docs).select(*_COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs, SHINGLE, DISTANCE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as it takes them."""
    return source_mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of every document of the mix: packed
    token ids, and digests of them and of the text that they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("bpe", encode),
]

#: Fingerprints, profiles and merges cannot be told in SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialised(docs, f"pipeline-{name}")
    return docs
