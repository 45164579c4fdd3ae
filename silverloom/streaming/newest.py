"""Newest rows kept incrementally: keyed state in the state store instead of a window over all history.

A stream over bronze files holds the newest row of each key as its state. A run reads the files
that have landed since the last one, compares them with the state, and hands on the keys that
they changed; these are upserted into a table of which only their parts are rewritten.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from silverloom.operators.tables import checked, upsert
from silverloom.plans import entities
from silverloom.plans.medallion import ENTITIES, EXCLUDING, silver_rules
from silverloom.sources.hashed import HashedTable


def newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key, the greatest by `order`, whose last column should be unique; works on a stream, where it is state.

    The state is one row a key. Spark sums up batches in tasks first, so a key that very many rows share
    reaches the state as one row a task.
    """
    rest = [c for c in rows.columns if c not in keys]
    by = [c for c in order if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*by)).alias("best")
    return rows.groupBy(*keys).agg(best).select(*keys, "best.*")


def keep_newest(spark: SparkSession, source: str, schema: T.StructType, table: HashedTable, order: list[str], checkpoint: str, each: Callable[[DataFrame], None] | None = None, make: Callable[[DataFrame], DataFrame] = lambda df: df, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Read the Parquet files that have landed under source since the last call, then stop; table holds the newest row of each key.

    make turns newest rows into the table's rows, which may be fewer. A row that lands late and is
    older than the state changes nothing. A batch that is tried again writes the same rows.
    Rows with a null key are left out; each(rows) is called with what a batch changed.
    """
    files = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source)
    for k in table.keys:
        files = files.where(F.col(k).isNotNull())

    def batch(df: DataFrame, _: int) -> None:
        df = stored_once(df, f"{checkpoint}/changed")
        if each:
            each(df)
        table.upsert(make(df), merge)

    out = newest(files, table.keys, order).writeStream.outputMode("update")
    return out.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_once(df: DataFrame, path: str) -> DataFrame:
    """A batch's rows from a table that is written anew for each batch, so that the state is read and updated once."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_silver_new(spark: SparkSession, entity: str, root: str, excluded: list[int] | None = None, parts: int = 64) -> dict[str, int]:
    """As run_silver, from the bronze files that are new since the last call: {entity: rows, errors: rows} of these.

    Silver is HashedTable silver_live/<entity> by source_id, and location_hours beside locations. Records
    without an id and rows that break a constraint are added to meta/sync_errors_live/<entity>,
    by the stream's batch, so that a batch that is tried again replaces its own.
    """
    own, now = ENTITIES[entity], F.current_timestamp()
    every = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/bronze/{entity}")
    table = HashedTable(spark, f"{root}/silver_live/{entity}", ["source_id"], parts)
    seen = {entity: 0, "errors": 0}
    place, state = f"{root}/meta/sync_errors_live/{entity}", f"{root}/meta/streams/{entity}"

    def put(bad: DataFrame, kind: str, number: int) -> None:
        target = f"{place}/kind={kind}/batch={number}"
        bad.select("source_id", "error", "raw_json").write.mode("overwrite").parquet(target)
        seen["errors"] += spark.read.parquet(target).count()

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        return upsert(old, new, ["source_id"], first_seen="first_seen_at", now=now)

    def batch(df: DataFrame, number: int) -> None:
        df = stored_once(df, f"{state}/changed")
        make = entities.SILVER[entity]
        rows, broken = checked(make(df, excluded) if entity in EXCLUDING else make(df), silver_rules(entity))
        broken = broken.select("source_id", F.array_join("broken_rules", ", ").alias("error"), F.lit(None).cast("string").alias("raw_json"))
        put(entities.rejects(df, own.required).unionByName(broken), "row", number)
        rows = rows.withColumns({"first_seen_at": now, "last_synced_at": now})
        seen[entity] += rows.count()
        table.upsert(rows, merge)
        if entity == "locations":
            hours = entities.location_hours(df, excluded).join(rows.select(F.col("source_id").alias("location_source_id")), "location_source_id", "left_semi")
            HashedTable(spark, f"{root}/silver_live/location_hours", ["location_source_id", "day_of_week"], parts).upsert(hours.withColumns({"first_seen_at": now, "last_synced_at": now}), first_seen="first_seen_at", now=now)

    def without_id(df: DataFrame, number: int) -> None:
        put(entities.rejects(df.select("source_id", "id", "raw_json").distinct(), own.required or ["Id"]), "no_id", number)

    files = spark.readStream.schema(every.schema).option("recursiveFileLookup", True).parquet(f"{root}/bronze/{entity}")
    streams = [
        (newest(files.where("source_id is not null"), ["source_id"], ["synced_at", "id"]).writeStream.outputMode("update").foreachBatch(batch), f"{state}/newest"),
        (files.where("source_id is null").writeStream.foreachBatch(without_id), f"{state}/no_id"),
    ]
    for out, checkpoint in streams:
        out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return seen
