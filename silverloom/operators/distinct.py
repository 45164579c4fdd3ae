"""Exact distinct counts that can be stored and merged: bitmaps over whole-number ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_state(df: DataFrame, by: list[str], number: Column) -> DataFrame:
    """(by..., bucket, bits): the ids of each group as bitmaps of 32,768 ids, built in tasks before the shuffle.

    Null ids aren't counted. Ids should be dense (keys, days): a bitmap takes 4 KB however few ids it holds.
    """
    own = df.withColumn("number", number.cast("bigint")).where("number is not null")
    rows = own.select(*by, F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("place"))
    return rows.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))


def merged_state(states: DataFrame, by: list[str]) -> DataFrame:
    """The states of coarser groups, or of several tables of states, as one state."""
    return states.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(states: DataFrame, by: list[str], name: str = "n") -> DataFrame:
    """(by..., name): the exact number of distinct ids of each group, over whatever states are given."""
    return merged_state(states, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
