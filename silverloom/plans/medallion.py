"""The bronze and silver runs, with run tracking.

Tables are Parquet directories of versions: a run writes a new version and then points to
it by its greatest number, so readers never see half a write.
"""

from __future__ import annotations

import json
import time
import traceback
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from types import TracebackType

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverloom.operators.tables import checked, latest, upsert
from silverloom.plans import entities
from silverloom.sources.files import write_snapshot
from silverloom.sources.lookups import lookup, resource_pairs, split_errors
from silverloom.sources.rest import PagedRest

RUN_SCHEMA = "run_id string, source string, entity string, layer string, triggered_by string, metadata string, status string, rows_read long, rows_written long, rows_skipped long, error string, at timestamp"


@dataclass(frozen=True)
class Entity:
    """Where an entity comes from, its denormalised bronze keys {column: JSON field or None}, and what its silver rows must meet."""

    path: str
    keys: dict[str, str | None]
    required: list[str]
    rules: dict[str, int]  # the most characters of a column that mustn't be null; 0: any


#: The entities' API paths and the constraints of their tables.
ENTITIES = {
    "locations": Entity("sys/businesses", {}, ["Id"], {"source_id": 0, "name": 512}),
    "products": Entity("sys/floorplandesks", {"location_id": "FloorPlanBusinessId", "item_type": "ItemType"}, ["Id"], {"source_id": 0, "item_type": 0, "location_source_id": 0, "name": 256}),
    "contracts": Entity("billing/coworkercontracts", {"product_id": None, "location_id": None}, [], {"source_id": 0}),
    "resources": Entity("spaces/resources", {"location_id": "BusinessId"}, ["Id"], {"source_id": 0}),
    "extra_services": Entity("billing/extraservices", {"location_id": "BusinessId"}, ["Id", "BusinessId"], {"source_id": 0, "location_source_id": 0, "name": 512, "price": 0}),
}
#: Entities that excluded locations are left out of.
EXCLUDING = ("locations", "products")


class Table:
    """A versioned Parquet table; the list of versions is read with Spark, so any store will do.

    One writer at a time: of two that write at once the later one fails, since its version is there. The
    last `keep` versions stay, for readers that have begun.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 5) -> None:
        self.spark, self.path, self.keep = spark, path, keep

    def versions(self) -> list[int]:
        """The numbers of the versions that were written whole, in order."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(root) if fs.exists(hadoop.Path(s.getPath(), "_SUCCESS"))) if fs.exists(root) else []

    def version(self) -> int:
        return max(self.versions(), default=0)

    def read(self) -> DataFrame | None:
        n = self.version()
        return self.spark.read.parquet(f"{self.path}/v{n}") if n else None

    def write(self, df: DataFrame) -> DataFrame:
        to = f"{self.path}/v{self.version() + 1}"
        df.write.parquet(to)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for n in self.versions()[: -self.keep]:
            old = hadoop.Path(f"{self.path}/v{n}")
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
        return self.spark.read.parquet(to)


class RunTracker:
    """Context manager that appends a 'running' event and then 'success' or 'failed'; errors pass on. metadata: any text, as the run that caused this one."""

    def __init__(self, spark: SparkSession, path: str, source: str, entity: str, layer: str, triggered_by: str = "cron", metadata: str | None = None) -> None:
        self.spark, self.path = spark, path
        self.row = {"run_id": str(uuid.uuid4()), "source": source, "entity": entity, "layer": layer, "triggered_by": triggered_by, "metadata": metadata}
        self.rows_read = self.rows_written = self.rows_skipped = 0

    def _event(self, status: str, error: str | None = None) -> None:
        row = [*self.row.values(), status, self.rows_read, self.rows_written, self.rows_skipped, error]
        df = self.spark.createDataFrame([tuple(row)], RUN_SCHEMA.rsplit(",", 1)[0])
        df.withColumn("at", F.current_timestamp()).write.mode("append").parquet(self.path)

    def __enter__(self) -> RunTracker:
        self._event("running")
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        text = "".join(traceback.format_exception_only(kind, error))[:4000] if error else None
        self._event("failed" if error else "success", text)


def current_runs(events: DataFrame) -> DataFrame:
    """The latest event of each run; a finished state wins a tie."""
    return latest(events, ["run_id"], [F.desc("at"), (F.col("status") == "running").asc()])


#: Types of the key columns.
KEY_TYPES = {"item_type": "int"}


def scan(spark: SparkSession, entity: str, where: Column | None = None, **options: str) -> DataFrame:
    """Records of an entity (raw_json) from the paged API; options as of the paged_rest source.

    where: a condition on the entity's keys, as item_type = 5; with option `push` it becomes parameters of the calls.
    """
    spark.dataSource.register(PagedRest)
    keys = {c: [field, KEY_TYPES.get(c, "bigint")] for c, field in ENTITIES[entity].keys.items() if field}
    found = spark.read.format("paged_rest").options(path=ENTITIES[entity].path, keys=json.dumps(keys), **options).load()
    return (found if where is None else found.where(where)).select("raw_json")


def scan_resources(spark: SparkSession, root: str, call: Callable[[dict], object], readers: int = 3) -> tuple[DataFrame, DataFrame]:
    """(records, skipped) of the resources that the products' newest bronze rows name: one call for each pair of location and resource.

    call gets a row (location_id, resource_id, path). What isn't found is dropped; a call that fails is skipped, with its error.
    """
    products = latest(read_bronze(spark, root, "products").where("source_id is not null"), ["source_id"], [F.desc("synced_at"), F.desc("id")])
    pairs = resource_pairs(products.select("location_id", F.get_json_object("raw_json", "$.ResourceId").try_cast("bigint").alias("resource_id")))
    keys = pairs.withColumn("path", F.concat(F.lit(ENTITIES["resources"].path + "/"), "resource_id"))
    ok, bad = split_errors(lookup(keys, call, readers))
    return ok.select(F.col("reply").alias("raw_json"), "location_id"), bad


def read_bronze(spark: SparkSession, root: str, entity: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).parquet(f"{root}/bronze/{entity}")


def run_bronze(spark: SparkSession, entity: str, records: DataFrame, root: str, run_id: str, source: str = "api") -> int:
    """Land records (raw_json, and keys by name if they are known) as a snapshot and as the run's bronze rows; returns how many.

    All records are kept, also those that aren't JSON or have no id: the silver run reports them.
    A run that is repeated replaces its own rows.
    """
    at = F.lit(time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime())).cast("timestamp")
    with RunTracker(spark, f"{root}/meta/sync_runs", source, entity, "bronze", metadata=run_id) as run:
        write_snapshot(records, f"{root}/landing", source, entity, run_id, at)
        rows = entities.bronze_rows(records, run_id, at, ENTITIES[entity].keys)
        target = f"{root}/bronze/{entity}/{run_id}"
        rows.withColumn("id", F.xxhash64("sync_run_id", "source_id", "raw_json")).write.mode("overwrite").parquet(target)
        run.rows_written = spark.read.parquet(target).count()
    return run.rows_written


def silver_rules(entity: str) -> dict[str, Column]:
    """The constraints of an entity's silver table by name."""
    out = {}
    for c, most in ENTITIES[entity].rules.items():
        out[f"{c} is null"] = F.col(c).isNotNull()
        if most:
            out[f"{c} is longer than {most}"] = F.coalesce(F.length(c), F.lit(0)) <= most
    return out


def run_silver(spark: SparkSession, entity: str, root: str, excluded: list[int] | None = None) -> dict[str, int]:
    """Upsert the latest bronze rows of an entity into silver: {entity: rows, errors: rows}, and location_hours for locations.

    Records that aren't JSON, lack a key or break a constraint go to meta/sync_errors/<entity>, which
    each run writes anew, so a repeated run adds nothing. The latest rows are found once.
    """
    own = ENTITIES[entity]
    with RunTracker(spark, f"{root}/meta/sync_runs", "bronze", entity, "silver") as run:
        every = read_bronze(spark, root, entity)
        bronze = latest(every.where("source_id is not null"), ["source_id"], [F.desc("synced_at"), F.desc("id")]).persist()
        make = entities.SILVER[entity]
        new, broken = checked(make(bronze, excluded) if entity in EXCLUDING else make(bronze), silver_rules(entity))
        broken = broken.select("source_id", F.array_join("broken_rules", ", ").alias("error"), F.lit(None).cast("string").alias("raw_json"))
        unread = every.where("source_id is null").select("source_id", "id", "raw_json").distinct()
        bad = entities.rejects(unread, own.required or ["Id"]).unionByName(entities.rejects(bronze, own.required)).unionByName(broken)
        errors = Table(spark, f"{root}/meta/sync_errors/{entity}").write(bad.withColumn("entity", F.lit(entity))).count()
        done = {entity: _merge(spark, f"{root}/silver/{entity}", new, ["source_id"])}
        if entity == "locations":
            hours = entities.location_hours(bronze, excluded).join(new.select(F.col("source_id").alias("location_source_id")), "location_source_id", "left_semi")
            times = [c for c in hours.columns if c not in ("location_source_id", "day_of_week", "day_name")]
            done["location_hours"] = _merge(spark, f"{root}/silver/location_hours", hours, ["location_source_id", "day_of_week"], [*times, "last_synced_at"])
        run.rows_read, run.rows_written = bronze.count(), done[entity]
        bronze.unpersist()
        return {**done, "errors": errors}


def _merge(spark: SparkSession, path: str, new: DataFrame, keys: list[str], update: list[str] | None = None) -> int:
    """Upsert new into the table at path; returns the number of new's rows."""
    now = F.current_timestamp()
    new = new.withColumns({"first_seen_at": now, "last_synced_at": now})
    table, seen = Table(spark, path), Observation()
    old, new = table.read(), new.observe(seen, F.count("*").alias("n"))
    table.write(new if old is None else upsert(old, new, keys, update=update, first_seen="first_seen_at", now=now))
    return seen.get["n"]


def run_all(spark: SparkSession, root: str, run_id: str, call: Callable[[dict], object], excluded: list[int] | None = None, **options: str) -> dict[str, dict[str, int]]:
    """Bronze and silver of all entities, resources after the products that name them: counts by entity, with the resources skipped."""
    out = {}
    for entity in ENTITIES:
        skipped = None
        if entity == "resources":
            records, bad = scan_resources(spark, root, call)
            bad.write.mode("overwrite").parquet(f"{root}/meta/skipped/{entity}/{run_id}")
            skipped = spark.read.parquet(f"{root}/meta/skipped/{entity}/{run_id}").count()
        else:
            records = scan(spark, entity, **options)
        run_bronze(spark, entity, records, root, run_id)
        out[entity] = run_silver(spark, entity, root, excluded) | ({} if skipped is None else {"skipped": skipped})
    return out
