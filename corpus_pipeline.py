"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trailmix.llm import exact_dedup, language, near_dedup, packing, pii
from trailmix.llm.common import documents, written
from trailmix.llm.queries import KEY, WINDOW


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters or in no learned language."""
    return language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words, similarity 0.8: the least doc_id of each group stays."""
    return near_dedup.drop_near_duplicates(docs, k=5, percent=80)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates; n_chars follows the text."""
    return pii.replace_in_rows(docs, KEY, chars_col="n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens.  Fewer documents are encoded
    at a time, as the heap has grown with the stages before."""
    return packing.pack_documents(docs, WINDOW, public_tokenizers.path("word_bpe_49k.json"), 2, slice_rows=512)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]

# Similarity joins over hashed trees, surrogates and token ids are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
