"""Parquet tables partitioned by a hash of their keys: an upsert rewrites the touched partitions only, a lookup reads one."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.operators.tables import upsert

#: The partition column.
PART = "key_part"


class HashedTable:
    """A table at a path, its rows in `parts` folders by a hash of the keys.

    The number of parts belongs to the table: choose it for parts of a few hundred MB. Within a
    part rows are sorted by key, and key columns have Parquet Bloom filters, so a lookup reads few
    row groups of one part. Writes replace whole parts through Spark's dynamic partition overwrite:
    a job that fails before its commit leaves the table as it was, and a repeated upsert gives the
    same rows. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], parts: int = 64) -> None:
        self.spark, self.path, self.keys, self.parts = spark, path, keys, parts

    def part_of(self, *keys: Column) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.parts)).cast("int")

    def stored(self) -> DataFrame | None:
        """The rows with their part, None if nothing has been written."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return None
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame | None:
        found = self.stored()
        return None if found is None else found.drop(PART)

    def touched(self, source: DataFrame) -> list[int]:
        """The parts of source's keys: whole numbers below `parts`, whatever the source's size."""
        return sorted(r[0] for r in source.select(self.part_of(*map(F.col, self.keys)).alias(PART)).distinct().collect())

    def _write(self, rows: DataFrame) -> None:
        dealt = rows.withColumn(PART, self.part_of(*map(F.col, self.keys))).hint("rebalance", PART).sortWithinPartitions(PART, *self.keys)
        blooms = {f"parquet.bloom.filter.enabled#{k}": "true" for k in self.keys}
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**blooms).partitionBy(PART).parquet(self.path)

    def upsert(self, source: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None, update: Iterable[str] | None = None, first_seen: str | None = None, now: Column | None = None) -> int:
        """Merge source, whose keys are unique, into the table; returns how many parts were rewritten.

        Only parts that hold one of source's keys are read, joined and written; the files of all
        others stay. merge(old rows, source) gives the parts' new rows; by default upsert() with
        the same update, first_seen and now.
        """
        parts, old = self.touched(source), self.stored()
        if not parts:
            return 0
        if old is None:
            self._write(source)
        else:
            own = old.where(F.col(PART).isin(parts)).drop(PART)
            self._write(merge(own, source) if merge else upsert(own, source, self.keys, update, first_seen, now))
        return len(parts)

    def lookup(self, *key: object) -> DataFrame:
        """The rows of one key: the scan is pruned to its part, and to row groups by statistics and Bloom filters."""
        rows = self.stored()
        kinds = [rows.schema[k].dataType for k in self.keys]
        values = [F.lit(v).cast(kind) for v, kind in zip(key, kinds, strict=True)]
        number = self.spark.range(1).select(self.part_of(*values)).first()[0]
        for k, v in zip(self.keys, values):
            rows = rows.where(F.col(k) == v)
        return rows.where(F.col(PART) == number).drop(PART)
