"""Incremental silver: new snapshot files only, once, each micro-batch upserted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from silverloom.operators.tables import latest, upsert
from silverloom.plans.medallion import Table

SNAPSHOT = "raw_json string, source string, entity string, run_id string, snapshot_at_utc timestamp"


def ingest_available(spark: SparkSession, landing: str, table: Table, make: Callable[[DataFrame], DataFrame], checkpoint: str, keys: list[str], rejects: Table | None = None) -> StreamingQuery:
    """Upsert what has landed since the last call, then stop; the checkpoint replaces rescans for the latest rows.

    make turns snapshot rows into target rows with the keys and snapshot_at_utc, by which an older
    snapshot that arrives late leaves newer rows as they are. A batch that is tried again gives the
    same table. Records without an id go to `rejects`, if given, once each.
    """
    files = spark.readStream.schema(SNAPSHOT).option("recursiveFileLookup", True).json(landing)

    def batch(df: DataFrame, _: int) -> None:
        df = df.withColumn("source_id", F.get_json_object(F.to_json(F.try_parse_json("raw_json")), "$.Id").try_cast("bigint"))
        new = make(latest(df.where("source_id is not null"), ["source_id"], [F.desc("snapshot_at_utc"), F.desc("run_id"), F.desc("raw_json")]))
        old = table.read()
        if old is not None:
            stored = old.select(*keys, F.col("snapshot_at_utc").alias("_stored"))
            new = new.join(stored, keys, "left").where(F.col("_stored").isNull() | (F.col("snapshot_at_utc") >= F.col("_stored"))).drop("_stored")
        table.write(new if old is None else upsert(old, new, keys))
        if rejects is not None:
            bad, known = df.where("source_id is null").select("raw_json", "run_id").distinct(), rejects.read()
            rejects.write(bad if known is None else known.unionByName(bad).distinct())

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
