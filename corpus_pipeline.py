"""From raw documents to packed training sequences.

``STAGES`` are the steps in order; each takes (spark, docs, sf_dir) and works
on all rows that the step before kept.  All but the last return the columns
of ``docs``.

Defined results, of every stage: a null or empty text fails the quality rules,
which keep no document of fewer than 20 words; of equal texts, and of rows that
repeat doc_id and text, one row stays; a null doc_id is no near-duplicate; very
long texts are read whole; an empty table gives an empty result; columns with
the names of those that an operator adds are untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starkit.llm.common import tidy
from starkit.llm.exact_dedup import keep_first
from starkit.llm.minhash_dedup import keep_one
from starkit.llm.packing import pack
from starkit.llm.quality_rules import keep_good
from starkit.llm.queries import tokenizer
from starkit.llm.substring_dedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: similarity 0.8 or
    more of the sets of five-word shingles."""
    return keep_one(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur twice go from the texts."""
    return remove_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens."""
    return pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("substring_dedup", substrings), ("packing", pack_sequences)]

#: Clustering, tokenising and packing have no SQL form.
ORACLE_SQL = None


@tidy
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; a stage's
    own tables go once its result is written, the stages' results at the end."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = tidy(stage)(spark, docs, sf_dir)
    return STAGES[-1][1](spark, docs, sf_dir)
