"""Keyed-table operators: latest rows, upserts, refreshes, anti joins, unpivot, checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first by `order`, which should end in a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_with_ties(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """All rows of each key that hold its greatest `by`."""
    w = Window.partitionBy(*keys).orderBy(F.desc(by))
    return df.withColumn("_rk", F.rank().over(w)).where("_rk = 1").drop("_rk")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: Iterable[str] | None = None, first_seen: str | None = None, now: Column | None = None) -> DataFrame:
    """target after a keyed merge with source, whose keys must be unique.

    Matched rows take source's `update` columns (default: all), nulls included; the others
    keep target's. Unmatched source rows are inserted whole, unmatched target rows stay.
    `first_seen` is set to `now` on insert only.
    """
    update = set(update if update is not None else [c for c in target.columns if c not in keys])
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    both = t.join(s, on, "full_outer")
    new, old = F.col("s._s").isNotNull(), F.col("t._t").isNotNull()

    def value(c: str) -> Column:
        if c == first_seen:
            return F.when(old, F.col(f"t.{c}")).otherwise(now)
        if c in keys:
            return F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        if c not in source.columns:
            return F.col(f"t.{c}")
        take = new if c in update else new & ~old
        return F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))

    return both.select(*[value(c).alias(c) for c in target.columns])


def upsert_counts(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """(inserted, updated): how many source rows an upsert inserts and updates."""
    hit = source.join(target.select(*keys).distinct().withColumn("_hit", F.lit(True)), keys, "left")
    return hit.agg(F.count_if(F.col("_hit").isNull()).alias("inserted"), F.count_if("_hit").alias("updated"))


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti"))


def replace_by_key(target: DataFrame, source: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """All rows of the given keys are replaced by source's."""
    return target.join(keys.select(*on).distinct(), on, "left_anti").unionByName(source)


def missing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of left without a match: work lists, ids without files, outputs not there yet."""
    return left.join(right.select(*keys), keys, "left_anti")


def unpivot_days(df: DataFrame, key: str, days: list[tuple[int, str, Column, Column, Column]]) -> DataFrame:
    """One row a day: (key, day_of_week, day_name, open, close, is_closed); both times 0 mean none."""
    rows = [
        F.struct(
            F.lit(n).alias("day_of_week"), F.lit(name).alias("day_name"),
            F.when((F.coalesce(o, F.lit(-1)) == 0) & (F.coalesce(c, F.lit(-1)) == 0), None).otherwise(o).alias("open_minutes"),
            F.when((F.coalesce(o, F.lit(-1)) == 0) & (F.coalesce(c, F.lit(-1)) == 0), None).otherwise(c).alias("close_minutes"),
            F.coalesce(closed, F.lit(False)).alias("is_closed"),
        ) for n, name, o, c, closed in days
    ]
    return df.select(key, F.inline(F.array(*rows)))


def first_category(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by the given columns: first category wins."""
    return latest(df, keys, [F.col(c) for c in order])


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def unique_guard(df: DataFrame, name: str, keys: list[str], exists: bool) -> DataFrame:
    """(constraint, outcome): EXISTS, SKIP (there are duplicates) or ADDED."""
    n = duplicates(df, keys).agg(F.count("*").alias("n"))
    outcome = F.lit("EXISTS") if exists else F.when(F.col("n") > 0, "SKIP").otherwise("ADDED")
    return n.select(F.lit(name).alias("constraint"), outcome.alias("outcome"))


def checked(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet all rules, rejects with the names of the rules they break)."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]), lambda x: x.isNotNull())
    marked = df.withColumn("_broken", broken)
    return marked.where(F.size("_broken") == 0).drop("_broken"), marked.where(F.size("_broken") > 0).withColumnRenamed("_broken", "broken_rules")
