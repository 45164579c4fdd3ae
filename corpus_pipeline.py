"""A training-corpus pipeline over `documents`: language ID, line dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a caller that writes it
and reads it again between stages cuts the lineage. All stages but the last return the
columns of documents, whatever further columns there are, and keep rows with a null id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm import langid, linededup, minhash, packing
from silverloom.llm.common import materialised


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those that are null or hold no letter go.

    Profiles are learned from all labelled documents. Without any, nothing can be told.
    """
    return langid.identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document of a smaller id has; n_chars follows the text.

    A document that loses all its words goes: it held nothing but repeats.
    """
    found = linededup.deduplicate(docs)
    new = {"text": F.col("text"), "n_chars": F.when(F.col("removed_lines") > 0, F.length("text")).otherwise(F.col("row.n_chars"))}
    emptied = (F.col("removed_lines") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return found.where(~F.coalesce(emptied, F.lit(False))).select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id.

    Groups are connected by links of 0.8 or more on five-word shingles. Rows without id or
    words are linked with nothing and stay. If an id has several texts, each is judged by itself.
    """
    return minhash.one_of_each(docs, shingle=5, similarity=(4, 5))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("packing", pack)]

#: Tokenisation and similarity can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents, each stage's rows checkpointed before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
