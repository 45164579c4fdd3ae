"""Queries of whole runs over the test tables, with their SQL: sources, sinks, incremental tables, entity projections.

Stand-ins: customers are locations, parts products, orders contracts, suppliers services and
resources; their rows become JSON as the service gives it. Runs write below scratch().
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from functools import lru_cache, reduce
from itertools import accumulate
from operator import and_

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.functions import dates as D
from silverloom.functions import json as J
from silverloom.functions import strings as S

from silverloom.plans import enrichment, entities, extraction, medallion, reports
from silverloom.plans.catalogue import AS_OF, CONTRACTS, NOTICE, NOTICE_SQL, SQL, TERMS, _split_orders, _terms, contracts, day, query, t
from silverloom.session import scratch
from silverloom.sources import files, lookups, rest
from silverloom.sources.documents import opened, read_documents, write_documents
from silverloom.sources.hashed import HashedTable
from silverloom.streaming import newest as N

# --- incremental tables ----------------------------------------------------------------------


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events WHERE user_id IS NOT NULL)
SELECT user_id, event_id, event_type, ts FROM r WHERE rn = 1""")
def newest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The newest event of each user as a stream's state, over three landings of which later ones hold older events too."""
    root, events = scratch(spark), t(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    table = HashedTable(spark, f"{root}/newest", ["user_id"], 8)
    for i in range(3):
        events.where(F.pmod(F.col("event_id"), F.lit(3)) == 2 - i).write.parquet(f"{root}/landing/{i}")
        N.keep_newest(spark, f"{root}/landing", events.schema, table, ["ts", "event_id"], f"{root}/checkpoint").awaitTermination()
    return table.read()


@query(SQL["upsert_merge"])
def upsert_touched_parts(spark: SparkSession, sf: str) -> DataFrame:
    """As upsert_merge, into a table partitioned by a hash of the key, in two upserts."""
    old, new = _split_orders(spark, sf)
    table = HashedTable(spark, f"{scratch(spark)}/orders", ["o_orderkey"], 16)
    table.upsert(old.withColumn("first_seen", F.lit(1)))
    for part in (0, 1):
        rows = new.where(F.pmod(F.col("o_orderkey"), F.lit(2)) == part).withColumn("first_seen", F.lit(2))
        table.upsert(rows, first_seen="first_seen", now=F.lit(2))
    return table.read()


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)")
def part_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One order by its key: the scan is pruned to one part of the table."""
    orders = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    table = HashedTable(spark, f"{scratch(spark)}/orders", ["o_orderkey"], 16)
    table.upsert(orders)
    return table.lookup(orders.agg(F.max("o_orderkey")).first()[0])


# --- entities --------------------------------------------------------------------------------


def _bronze(rows: DataFrame, record: dict) -> DataFrame:
    """Bronze rows of records {field: Column}, in the API's names; fields that are null are left out, as JSON leaves them."""
    raw = rows.select(F.to_json(F.struct(*[c.alias(n) for n, c in record.items()])).alias("raw_json"))
    return entities.bronze_rows(raw, "r", F.lit("2025-01-01").cast("timestamp"), {}).withColumn("id", F.col("source_id"))


def locations_of(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return _bronze(t(spark, sf, "customer"), {
        "Id": F.when(k % 11 != 0, k), "UniqueId": F.concat(F.lit(" u"), k.cast("string")), "Name": F.when(k % 5 != 0, F.when(k % 5 == 1, F.lit(" ")).otherwise(F.col("c_name"))), "ToStringText": F.when(k % 2 == 0, F.col("c_name")),
        "TownCity": F.col("c_mktsegment"), "CountryId": F.col("c_nationkey"), "Latitude": F.col("c_acctbal"), "AboutUs": F.concat(F.lit("<p>a <b>"), F.col("c_name"), F.lit("</b>\n</p>")), "CreatedOn": F.lit("2025-03-04T05:06:07Z"),
        "UpdatedOn": F.lit("soon"), "MondayOpenTime": k % 3 * 60, "MondayCloseTime": k % 2 * 600, "SundayClosed": k % 4 == 0,
    })


@query("""WITH c AS (SELECT *, nullif(trim(CASE WHEN c_custkey % 5 = 1 THEN ' ' WHEN c_custkey % 5 <> 0 THEN c_name END), '') AS own FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey NOT IN (3, 5))
SELECT c_custkey AS source_id, 'u' || c_custkey AS source_uuid, coalesce(own, CASE WHEN c_custkey % 2 = 0 THEN c_name END, 'Unknown') AS name, c_mktsegment AS city, CAST(c_nationkey AS BIGINT) AS country_id,
 CAST(c_acctbal AS DOUBLE) AS latitude, 'a ' || c_name AS description, TIMESTAMP '2025-03-04 05:06:07' AS created_on, CAST(NULL AS TIMESTAMP) AS updated_on FROM c""")
def silver_locations(spark: SparkSession, sf: str) -> DataFrame:
    """Locations projected from JSON: fallback names, HTML, dates, records without id and excluded ones left out."""
    out = entities.locations(locations_of(spark, sf), [3, 5]).select("source_id", "source_uuid", "name", "city", "country_id", "latitude", "description", "created_on", "updated_on")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_on", "updated_on")})


@query("""SELECT c_custkey AS location_source_id, d.n AS day_of_week, d.name AS day_name,
 CASE WHEN d.n = 1 AND NOT (c_custkey % 3 = 0 AND c_custkey % 2 = 0) THEN c_custkey % 3 * 60 END AS open_minutes, CASE WHEN d.n = 1 AND NOT (c_custkey % 3 = 0 AND c_custkey % 2 = 0) THEN c_custkey % 2 * 600 END AS close_minutes,
 d.n = 7 AND c_custkey % 4 = 0 AS is_closed FROM customer, (VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'), (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')) d(n, name) WHERE c_custkey % 11 <> 0""")
def silver_hours(spark: SparkSession, sf: str) -> DataFrame:
    return entities.location_hours(locations_of(spark, sf))


def products_of(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    fields = F.struct(F.array(F.struct(F.lit("Other").alias("Name"), F.lit("1").alias("Value")), F.struct(F.lit("Size").alias("Name"), F.col("p_size").cast("string").alias("Value"))).alias("Data"))
    return _bronze(t(spark, sf, "part"), {
        "Id": k, "ItemType": (k % 6).cast("int"), "FloorPlanBusinessId": k % 10, "FloorPlanBusinessName": F.col("p_brand"), "Name": F.when(k % 3 == 0, "").otherwise(F.col("p_name")), "ToStringText": F.when(k % 2 == 0, F.col("p_type")),
        "Area": F.when(k % 4 == 0, "").otherwise(F.lit("A")), "Price": F.col("p_retailprice"), "Available": k % 2 == 0, "Capacity": F.col("p_size"), "ResourceId": k + 7, "ResourceName": F.col("p_brand"), "ResourceInternet": k % 3 == 1,
        "CoworkerTeamNames": F.when(k % 2 == 1, ""), "CoworkerCompanyName": F.col("p_brand"), "CustomFields": fields,
    })


@query("""SELECT p_partkey AS source_id, CAST(p_partkey % 6 AS BIGINT) AS item_type, CASE p_partkey % 6 WHEN 1 THEN 'Private Office' WHEN 2 THEN 'Dedicated Desk' WHEN 3 THEN 'Hot Desk' WHEN 4 THEN 'Other' WHEN 5 THEN 'Meeting Room' ELSE 'Unknown' END AS item_type_label,
 CAST(p_partkey % 10 AS BIGINT) AS location_source_id, CASE WHEN p_partkey % 3 <> 0 THEN p_name WHEN p_partkey % 2 = 0 THEN p_type ELSE 'Unknown' END AS name, CASE WHEN p_partkey % 4 <> 0 THEN 'A' END AS area_code,
 CAST(round(p_retailprice, 2) AS DECIMAL(12, 2)) AS price, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS available, p_brand AS coworker_company, CAST(p_size AS DOUBLE) AS custom_size, CAST(p_size AS BIGINT) AS capacity,
 CASE WHEN p_partkey % 6 IN (4, 5) THEN p_partkey + 7 END AS resource_id, CASE WHEN p_partkey % 6 IN (4, 5) THEN p_brand END AS resource_name, CASE WHEN p_partkey % 6 IN (4, 5) THEN CASE WHEN p_partkey % 3 = 1 THEN 1 ELSE 0 END END AS has_internet
 FROM part WHERE p_partkey % 10 NOT IN (2)""")
def silver_products(spark: SparkSession, sf: str) -> DataFrame:
    """Products projected from JSON: labels, fallbacks, fields that only rooms have, the size among named fields."""
    return entities.products(products_of(spark, sf), [2]).select(
        "source_id", "item_type", "item_type_label", "location_source_id", "name", "area_code", "price", "available", "coworker_company", "custom_size", "capacity", "resource_id", "resource_name", "has_internet"
    )


def contracts_of(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _bronze(t(spark, sf, "orders"), {
        "id": F.when(k % 2 == 0, k).when(k % 3 == 0, F.lit(0)), "Id": F.when(k % 7 != 0, k), "Active": F.col("o_orderstatus") == "O", "Cancelled": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F"), "CoworkerId": F.col("o_custkey"),
        "CoworkerActive": F.when(k % 5 == 0, F.lit(True)), "TariffName": F.concat(F.lit(" "), F.col("o_orderpriority")), "Price": F.col("o_totalprice"), "Quantity": F.lit(2), "StartDate": F.date_format(day(), "yyyy-MM-dd'T'00:00:00"), "Notes": F.lit("  "),
    })


@query("""WITH o AS (SELECT *, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN nullif(o_orderkey, 0) END, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END) AS source_id FROM orders)
SELECT source_id, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS active, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS cancelled, CAST(o_custkey AS BIGINT) AS coworker_id, CASE WHEN o_orderkey % 5 = 0 THEN 1 END AS coworker_active,
 o_orderpriority AS tariff_name, CAST(round(o_totalprice, 2) AS DECIMAL(12, 2)) AS price, CAST(2 AS BIGINT) AS quantity, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS start_date, CAST(NULL AS VARCHAR) AS notes FROM o WHERE source_id IS NOT NULL""")
def silver_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Contracts projected from JSON: either spelling of the id, flags, trimmed texts, money, dates."""
    out = entities.contracts(contracts_of(spark, sf)).select("source_id", "active", "cancelled", "coworker_id", "coworker_active", "tariff_name", "price", "quantity", "start_date", "notes")
    return out.withColumn("start_date", F.col("start_date").cast("timestamp_ntz"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'ACTIVE' WHEN o_orderstatus = 'F' THEN 'CANCELLED' ELSE 'INACTIVE' END AS contract_status FROM orders WHERE (o_orderkey % 2 = 0 AND o_orderkey <> 0) OR o_orderkey % 7 <> 0""")
def contract_status(spark: SparkSession, sf: str) -> DataFrame:
    out = entities.contracts(contracts_of(spark, sf))
    return out.select(F.col("source_id").alias("o_orderkey"), S.contract_status(F.col("active"), F.col("cancelled")).alias("contract_status"))


@query("""SELECT s_suppkey AS source_id, CAST(s_nationkey AS BIGINT) AS location_source_id, CASE WHEN s_suppkey % 3 <> 0 THEN s_name ELSE '' END AS name, CAST(CASE WHEN s_suppkey % 2 = 0 THEN round(s_acctbal, 2) ELSE 0 END AS DECIMAL(12, 2)) AS price,
 CAST(4 AS BIGINT) AS charge_period, CASE WHEN s_suppkey % 2 = 1 THEN 1 ELSE 0 END AS is_default_price, 0 AS only_for_members, CASE WHEN s_suppkey % 5 = 0 THEN 'Room,Hall' END AS resource_type_names FROM supplier WHERE s_suppkey % 13 <> 0""")
def silver_extra_services(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    bronze = _bronze(t(spark, sf, "supplier"), {
        "Id": k, "BusinessId": F.when(k % 13 != 0, F.col("s_nationkey")), "Name": F.when(k % 3 != 0, F.col("s_name")), "Price": F.when(k % 2 == 0, F.col("s_acctbal")), "ChargePeriod": F.lit(4), "IsDefaultPrice": k % 2 == 1,
        "OnlyForMembers": F.when(k % 2 == 0, F.lit(False)), "ResourceTypeNames": F.when(k % 5 == 0, "Room,Hall"),
    })
    return entities.extra_services(bronze).select("source_id", "location_source_id", "name", "price", "charge_period", "is_default_price", "only_for_members", "resource_type_names")


@query("""SELECT s_suppkey AS source_id, CAST(s_nationkey AS BIGINT) AS location_source_id, s_name AS name, CAST(s_suppkey % 9 AS BIGINT) AS capacity, CAST(s_acctbal AS DOUBLE) AS size, s_suppkey % 2 = 0 AS visible, s_suppkey % 3 = 0 AND s_suppkey % 2 = 1 AS online FROM supplier WHERE s_suppkey <> 0""")
def silver_resources(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    bronze = _bronze(t(spark, sf, "supplier"), {"Id": k, "BusinessId": F.col("s_nationkey"), "Name": F.col("s_name"), "Capacity": k % 9, "Size": F.col("s_acctbal"), "Visible": k % 2 == 0, "Online": F.when(k % 2 == 1, k % 3 == 0)})
    return entities.resources(bronze).select("source_id", "location_source_id", "name", "capacity", "size", "visible", "online")


# --- runs from the service to silver ---------------------------------------------------------


@lru_cache(maxsize=4)
def _row_groups(table: str) -> list[ds.Fragment]:
    fs, root = opened(table)
    return [g for f in ds.dataset(root, filesystem=fs, format="parquet").get_fragments() for g in f.split_by_row_group()]


def _fits(wanted: tuple) -> ds.Expression | None:
    return reduce(and_, [ds.field(c) == v for c, v in wanted]) if wanted else None


@lru_cache(maxsize=64)
def _ends(table: str, wanted: tuple) -> list[int]:
    """How many rows that fit `wanted`, pairs (column, value), each row group and all before it hold. Nothing fits a null."""
    return list(accumulate(g.to_table(columns=[], filter=_fits(wanted)).num_rows for g in _row_groups(table)))


@lru_cache(maxsize=2)
def _fitting(table: str, wanted: tuple, fields: tuple, group: int) -> pa.Table:
    """The records of a row group's rows that fit: readers go forward, so each reads a group about once, whatever its pages are."""
    return _row_groups(table)[group].to_table(columns={k: ds.field(c) for k, c in fields}, filter=_fits(wanted)).combine_chunks()


def table_client(options: dict):
    """A service over a table's files: pages of records of `field`: column, and filters by the same names; options table, fields (JSON).

    A page costs its own records: its place is found by the row groups' counts, and no more than two row groups' fields are held.
    """
    table, fields = options["table"], tuple(json.loads(options["fields"]).items())

    def get(path: str, params: dict) -> dict:
        wanted = tuple((c, params[k]) for k, c in fields if k in params)
        ends, at = _ends(table, wanted), (params["page"] - 1) * params["size"]
        total, stop, records = (ends or [0])[-1], at + params["size"], []
        for group in range(bisect_right(ends, at), bisect_left(ends, min(stop, total)) + 1) if at < total else ():
            start = ends[group - 1] if group else 0
            records += _fitting(table, wanted, fields, group).slice(max(at - start, 0), stop - max(at, start)).to_pylist()
        return {"Records": records, "HasNextPage": stop < total, "TotalPages": -(-total // params["size"])}

    return get


def _service(spark: SparkSession, sf: str, name: str, fields: dict[str, str], size: int) -> dict[str, str]:
    """Options of a service over a table's fields, which Spark, as it reads paths that others can't, writes below scratch()."""
    path = f"{scratch(spark)}/{name}"
    t(spark, sf, name).select(*dict.fromkeys(fields.values())).write.parquet(path)
    return {"client": "silverloom.plans.runs:table_client", "table": path, "fields": json.dumps(fields), "page_size": str(size)}


@query("SELECT c_custkey AS source_id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer WHERE c_nationkey IN (3, 4) AND c_custkey > 20")
def rest_scan_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Records of a paged service: the filter on the nation is a parameter of its calls where the session pushes filters down."""
    spark.dataSource.register(rest.PagedRest)
    push = {"push": '{"nation": "NationId"}'} if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true" else {}
    options = _service(spark, sf, "customer", {"Id": "c_custkey", "Name": "c_name", "NationId": "c_nationkey"}, 100)
    found = spark.read.format("paged_rest").options(path="customers", keys='{"source_id": ["Id", "bigint"], "nation": ["NationId", "bigint"]}', **push, **options).load()
    return found.where("nation in (3, 4) and source_id > 20").select("source_id", F.get_json_object("raw_json", "$.Name").alias("name"), "nation")


@query("SELECT o_orderkey AS source_id, CAST(o_totalprice AS DOUBLE) AS price FROM orders")
def rest_scan_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """All records of a paged service, landed by a stream of pages that is called twice: the second call finds nothing new."""
    root = scratch(spark)
    options = {"path": "orders", **_service(spark, sf, "orders", {"Id": "o_orderkey", "Price": "o_totalprice"}, 1000), "batch_pages": "8"}
    for _ in range(2):
        rest.resumable_scan(spark, options, f"{root}/landing", f"{root}/checkpoint")
    raw = spark.read.parquet(f"{root}/landing")
    return raw.select(F.get_json_object("raw_json", "$.Id").cast("bigint").alias("source_id"), F.get_json_object("raw_json", "$.Price").cast("double").alias("price"))


RUN_SQL = """SELECT p_partkey AS source_id, CASE WHEN p_partkey % 3 = 0 THEN p_name || '!' ELSE p_name END AS name, CAST(p_partkey % 5 + 1 AS BIGINT) AS item_type, 'row' AS kind FROM part WHERE p_partkey % 4 <> 1
UNION ALL SELECT p_partkey, 'name is null', NULL, 'error' FROM part WHERE p_partkey < 0"""


def _product_runs(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Two runs of products: the second has other names for every third, and no others than that; some locations are excluded."""
    k = F.col("p_partkey")
    record = F.to_json(F.struct(k.alias("Id"), (k % 5 + 1).alias("ItemType"), (k % 4).alias("FloorPlanBusinessId"), F.col("name").alias("Name")))
    first = t(spark, sf, "part").withColumn("name", F.col("p_name"))
    again = first.where("p_partkey % 3 = 0").withColumn("name", F.concat("p_name", F.lit("!")))
    return [df.select(record.alias("raw_json")) for df in (first, again)]


@query(RUN_SQL)
def silver_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two bronze and silver runs of products, with snapshots and a run log; one location is excluded."""
    root = scratch(spark)
    for i, records in enumerate(_product_runs(spark, sf)):
        medallion.run_bronze(spark, "products", records, root, f"run{i}")
        medallion.run_silver(spark, "products", root, [1])
    out = medallion.Table(spark, f"{root}/silver/products").read()
    return out.select("source_id", "name", "item_type", F.lit("row").alias("kind"))


@query(RUN_SQL)
def silver_run_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The same two runs, of which silver reads new bronze files only and rewrites the parts that they touch."""
    root = scratch(spark)
    for i, records in enumerate(_product_runs(spark, sf)):
        medallion.run_bronze(spark, "products", records, root, f"run{i}")
        N.run_silver_new(spark, "products", root, [1], parts=8)
    return HashedTable(spark, f"{root}/silver_live/products", ["source_id"], 8).read().select("source_id", "name", "item_type", F.lit("row").alias("kind"))


def geo_service(row: dict) -> dict:
    """Two places for each search of a location, one of which all its searches find; locations of keys 0 mod 7 fail at trains."""
    at = row["location_source_id"]
    if at % 7 == 0 and row["category"] == "train":
        raise RuntimeError("quota")
    if row["kind"] == "geocode":
        return {"status": "OK", "results": [{"address_components": [{"types": ["locality"], "long_name": f"Town {at % 3}"}]}]}
    spot = lambda i, lat: {"place_id": i, "name": i, "types": ["x"], "geometry": {"location": {"lat": lat, "lng": 1.0}}}
    return {"status": "OK", "results": [spot(f"{at}-{row['kind']}-{row['ordinal']}", 1.001), spot(f"{at}-{row['kind']}", 1.02)]}


@query("""SELECT s_suppkey AS location_source_id, CASE WHEN s_suppkey % 7 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN s_suppkey % 7 <> 0 THEN CAST(11 AS BIGINT) END AS pois_found, CASE WHEN s_suppkey % 7 <> 0 THEN CAST(5 AS BIGINT) END AS transit_found,
 CASE WHEN s_suppkey % 7 = 0 THEN 'RuntimeError: quota' END AS error_message, CASE WHEN s_suppkey % 7 <> 0 THEN 'Town ' || s_suppkey % 3 END AS city_name FROM supplier WHERE s_suppkey % 5 <> 0""")
def enrichment_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """An enrichment run that is repeated: the log, places and neighbourhoods are as after one run. Some suppliers have no coordinates."""
    root, k = scratch(spark), F.col("s_suppkey")
    locations = t(spark, sf, "supplier").select(k.alias("source_id"), F.col("s_name").alias("name"), F.when(k % 5 != 0, F.lit(1.0)).alias("latitude"), F.lit(1.0).alias("longitude"))
    for _ in range(2):
        enrichment.enrich(spark, locations, geo_service, root, "r1", pause=0)
    log, around = (medallion.Table(spark, f"{root}/{n}").read() for n in ("meta/enrichment_log", "silver/neighbourhoods"))
    return log.join(around, "location_source_id", "left").select("location_source_id", "status", "pois_found", "transit_found", "error_message", "city_name")


# --- documents -------------------------------------------------------------------------------


@query("SELECT s_name AS name, CAST(s_suppkey AS BIGINT) AS source_id, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS version FROM supplier")
def document_files(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON file a supplier; every third is written again and read from its latest run."""
    path, s = f"{scratch(spark)}/documents", t(spark, sf, "supplier")
    for version, rows in ((1, s), (2, s.where("s_suppkey % 3 = 0"))):
        write_documents(rows.select(F.col("s_name").alias("name"), F.to_json(F.struct(F.col("s_suppkey").alias("key"), F.lit(version).alias("version"))).alias("json")), path)
    docs = read_documents(spark, path)
    return docs.select("name", F.get_json_object("json", "$.key").cast("bigint").alias("source_id"), F.get_json_object("json", "$.version").cast("int").alias("version"))


def scan_pages(content: bytes) -> int:
    """Pages of a stand-in scan, whose content is its number of pages."""
    return int(content)


def scan_reader(content: bytes, page: int, question: str) -> str:
    """Answers on a stand-in scan: the section is on page 4 of documents of an even number of pages."""
    if question == "terms":
        return json.dumps({"start_date": "2025-01-31", "end_date": "TBD"})
    if question == "section":
        return json.dumps({"has_section_5": page == 4 and int(content) % 2 == 0, "renewal_text": "month-to-month", "termination_notice_table": {"1-11 months": {"0-24": "1 month"}}})
    return json.dumps({"additional_notes": f"page {page}", "has_table": False})


@query("""WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey % 20 + 1 AS INT) AS n FROM supplier)
SELECT CAST(k AS VARCHAR) AS coworker_id, CASE WHEN n < 10 THEN 'new' ELSE 'old' END AS contract_type, n AS total_pages, '2025-01-31' AS start_date, CASE WHEN n >= 2 THEN 'page 2' ELSE '' END AS notes,
 CASE WHEN n < 10 THEN 'same duration as the Initial Commitment Term' WHEN n % 2 = 0 THEN 'monthly' ELSE '' END AS renewal, CASE WHEN n >= 10 AND n % 2 = 0 THEN 4 END AS section_page FROM s""")
def extraction_run(spark: SparkSession, sf: str) -> DataFrame:
    """Agreement documents read from scans and written as files, in two calls of which the second skips what is there."""
    path, k = f"{scratch(spark)}/extracted", F.col("s_suppkey")
    name = F.concat(F.lit("/scans/"), k.cast("string"), F.lit("_Ann_f.pdf"))
    scans = t(spark, sf, "supplier").select(name.alias("path"), F.lit("pdf").alias("kind"), (k % 20 + 1).cast("string").cast("binary").alias("content"))
    extraction.extract_new(spark, scans.where("path like '%0_Ann_f.pdf'"), path, scan_pages, scan_reader)
    extraction.extract_new(spark, scans, path, scan_pages, scan_reader)
    docs = read_documents(spark, path).select(F.from_json("json", files.AGREEMENT).alias("d")).select("d.*")
    flat = files.flat_agreements(docs)
    return flat.select("coworker_id", "contract_type", F.col("total_pages").cast("int").alias("total_pages"), "start_date", F.col("additional_notes").alias("notes"), F.col("renewal_system").alias("renewal"), F.nullif("section_5_found_on_page", F.lit("")).cast("int").alias("section_page"))


# --- dates -----------------------------------------------------------------------------------


@query("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS e, CAST(o_orderkey % 3 AS INT) AS days FROM orders)
SELECT o_orderkey, CASE WHEN days > 0 THEN e + CAST(greatest(0, ceil(date_diff('day', e, DATE '2030-01-31') / CAST(days AS DOUBLE))) AS INT) * days END AS rolled FROM o""")
def roll_forward_days(spark: SparkSession, sf: str) -> DataFrame:
    """Contracts of one and two days, decades from the report's date: moved by arithmetic, not step by step."""
    days = (F.col("o_orderkey") % 3).cast("int")
    return t(spark, sf, "orders").select("o_orderkey", D.roll_forward(day(), F.lit(0), days, F.lit("2030-01-31").cast("date")).alias("rolled"))


@query("""SELECT count(*) FILTER (o_orderdate IS NOT NULL) AS enriched, count(*) FILTER (o_orderdate IS NULL) AS pending FROM customer LEFT JOIN
(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders WHERE o_orderpriority = '1-URGENT') o ON o_custkey = c_custkey AND rn = 1""")
def enrichment_counts(spark: SparkSession, sf: str) -> DataFrame:
    log = t(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("location_source_id"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("finished_at"))
    return enrichment.status_counts(enrichment.status(t(spark, sf, "customer").select(F.col("c_custkey").alias("location_source_id")), log))


#: What the notice report says of agreements that are orders (see TERMS): capacity is that of the customer's last valid contract.
REPORT = TERMS + ", " + CONTRACTS.removeprefix("WITH ") + f""", cap AS (SELECT w.coworker_id, desks AS desk_ids, CASE WHEN desks IS NULL THEN 0 ELSE (SELECT CAST(sum(p_size) AS BIGINT) FROM part WHERE p_partkey IN (1, 2)) END AS capacity FROM w WHERE rl = 1),
b AS (SELECT f.*, o_custkey, date_diff('month', s, DATE '1997-06-15') AS n, coalesce(capacity, 0) AS desks, coalesce(desk_ids, '') AS desk_ids, cap.coworker_id IS NOT NULL AS has FROM f JOIN orders USING (o_orderkey) LEFT JOIN cap ON cap.coworker_id = o_custkey),
t AS (SELECT *, n - CASE WHEN CAST(s + to_months(CAST(n AS INT)) AS DATE) > DATE '1997-06-15' AND s <= DATE '1997-06-15' THEN 1 ELSE 0 END + CASE WHEN s > DATE '1997-06-15' AND CAST(s + to_months(CAST(n AS INT)) AS DATE) < DATE '1997-06-15' THEN 1 ELSE 0 END AS whole FROM b),
l AS (SELECT t.*, coalesce(label, 'N/A') AS notice_label FROM t LEFT JOIN ({NOTICE_SQL}) k ON ten = CASE WHEN whole <= 11 THEN '1-11 months' WHEN whole <= 23 THEN '12-23 months' ELSE '24+ months' END AND cap = CASE WHEN desks <= 24 THEN '0-24' WHEN desks <= 74 THEN '25-74' ELSE '75+' END),
g AS (SELECT *, coalesce(try_cast(nullif(regexp_extract(notice_label, '^([0-9]+) *month', 1), '') AS INT), 0) AS notice FROM l),
q AS (SELECT o_orderkey, m, d, notice, rolled AS e, 0 AS k FROM g UNION ALL SELECT o_orderkey, m, d, notice, CAST(e + to_months(CAST(m AS INT)) AS DATE) + CAST(d AS INT), k + 1 FROM q WHERE e < DATE '1997-06-15' + to_months(notice) AND k < 120),
last AS (SELECT o_orderkey, max(e) AS real_end FROM q GROUP BY 1)
SELECT 'f' || g.o_orderkey AS membership_agreement_id, CAST(o_custkey AS VARCHAR) AS coworker_id, CASE WHEN has THEN 'Town' ELSE '' END AS location_name, desk_ids AS contract_floor_plan_desk_ids, desks AS capacity,
 CASE WHEN g.o_orderkey % 2 = 0 THEN 'monthly' ELSE 'same_period | its own term' END AS renewal_system, s AS start_date, real_end AS real_end_date, notice_label AS notice_period, whole AS tenure_months,
 date_diff('month', s, real_end) - CASE WHEN CAST(s + to_months(CAST(date_diff('month', s, real_end) AS INT)) AS DATE) > real_end THEN 1 ELSE 0 END AS total_tenure_months FROM g JOIN last USING (o_orderkey)"""


@query(REPORT)
def notice_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report on agreement files: each order an agreement of its customer, written as JSON, one file each, and read back."""
    terms = _terms(spark, sf).join(t(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    renewal = F.when(F.col("category") == "monthly", F.to_variant_object(F.struct(F.lit("monthly").alias("category")))).otherwise(F.to_variant_object(F.struct(F.lit("same_period").alias("category"), F.lit("its own term").alias("raw_text"))))
    raw = terms.select(F.to_json(F.struct(
        F.col("o_custkey").cast("string").alias("coworker_id"), F.lit("n").alias("coworker_name"), F.concat(F.lit("f"), "o_orderkey").alias("file_id"), F.lit("old").alias("contract_type"),
        F.struct(text("s").alias("start_date"), text("e").alias("end_date")).alias("page_1"), renewal.alias("renewal_system"), J.constant(NOTICE).alias("termination_notice_table"),
    )).alias("json"))
    docs = raw.select(F.from_json("json", files.AGREEMENT).alias("d")).select("d.*")
    own = contracts(spark, sf).withColumn("location_name", F.lit("Town"))
    products = t(spark, sf, "part").select(F.col("p_partkey").alias("source_id"), F.col("p_size").alias("capacity"))
    out = reports.notice_periods(docs, own, products, "urgent", F.lit(AS_OF))
    return out.select(
        "membership_agreement_id", "coworker_id", "location_name", "contract_floor_plan_desk_ids", F.col("capacity").cast("bigint").alias("capacity"), "renewal_system", "start_date", "real_end_date", "notice_period",
        F.col("tenure_months").cast("bigint").alias("tenure_months"), F.col("total_tenure_months").cast("bigint").alias("total_tenure_months"),
    )


# --- keyed calls, files, logs ----------------------------------------------------------------


@query("SELECT n_nationkey, c_custkey AS source_id, CAST(NULL AS VARCHAR) AS error FROM nation JOIN customer ON c_nationkey = n_nationkey")
def paged_keys(spark: SparkSession, sf: str) -> DataFrame:
    """All records of each key from a paged service, the key a parameter of the call."""
    get = table_client(_service(spark, sf, "customer", {"Id": "c_custkey", "NationId": "c_nationkey"}, 25))
    found = lookups.paged_lookup(t(spark, sf, "nation").select("n_nationkey"), get, "customers", "NationId", "n_nationkey")
    return found.select("n_nationkey", F.get_json_object("raw_json", "$.Id").cast("bigint").alias("source_id"), "error")


def one_record(row: dict) -> dict | None:
    """A stand-in for a service of single records: keys 0 mod 5 aren't found, 0 mod 7 fail."""
    if row["p_partkey"] % 7 == 0:
        raise RuntimeError(f"down at {row['p_partkey']}")
    return None if row["p_partkey"] % 5 == 0 else {"Id": row["p_partkey"], "Beside": row["beside"]}


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 3 = 0 THEN 9007199254740993 + p_partkey END END AS beside, CASE WHEN p_partkey % 7 = 0 THEN 'RuntimeError: down at ' || p_partkey END AS error
FROM part WHERE p_partkey % 7 = 0 OR p_partkey % 5 <> 0""")
def record_lookups(spark: SparkSession, sf: str) -> DataFrame:
    """One call a key: replies and errors apart, what isn't found left out; large numbers beside nulls reach the service as they are."""
    keys = t(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.lit(9007199254740993) + F.col("p_partkey")).alias("beside"))
    ok, bad = lookups.split_errors(lookups.lookup(keys, one_record))
    ok = ok.select("p_partkey", F.get_json_object("reply", "$.Beside").cast("bigint").alias("beside"), F.lit(None).cast("string").alias("error"))
    return ok.unionByName(bad.select("p_partkey", F.lit(None).cast("bigint").alias("beside"), "error"))


def one_file(row: dict) -> tuple[bytes, str]:
    if row["s_suppkey"] % 7 == 0:
        raise RuntimeError("gone")
    return row["s_name"].encode(), ("image/png", "image/jpeg", "application/pdf", "text/plain")[row["s_suppkey"] % 4]


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS content, CASE WHEN s_suppkey % 7 <> 0 THEN CASE s_suppkey % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' WHEN 2 THEN '.pdf' ELSE '.plain' END END AS extension,
 CASE WHEN s_suppkey % 7 = 0 THEN 'RuntimeError: gone' END AS error FROM supplier""")
def file_downloads(spark: SparkSession, sf: str) -> DataFrame:
    found = lookups.downloads(t(spark, sf, "supplier").select("s_suppkey", "s_name"), one_file)
    return found.select("s_suppkey", F.col("content").cast("string").alias("content"), "extension", "error")


@query("SELECT 'silver' AS layer, 'success' AS status, 2 * count(*) FILTER (p_partkey % 4 <> 1) AS rows_written, 'part' AS entity FROM part UNION ALL SELECT 'bronze', 'success', count(*) + count(*) FILTER (p_partkey % 3 = 0), 'part' FROM part")
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Rows written by layer, from the log of two bronze and two silver runs, each with its last state."""
    root = scratch(spark)
    for i, records in enumerate(_product_runs(spark, sf)):
        medallion.run_bronze(spark, "products", records, root, f"run{i}")
        medallion.run_silver(spark, "products", root, [1])
    now = medallion.current_runs(spark.read.parquet(f"{root}/meta/sync_runs"))
    return now.groupBy("layer", "status").agg(F.sum("rows_written").alias("rows_written"), F.lit("part").alias("entity"))


@query("""SELECT c_custkey AS coworker_id, c_name AS name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderkey % 2 = 0)""")
def coworkers_without_files(spark: SparkSession, sf: str) -> DataFrame:
    """Written as JSON and read back."""
    path = f"{scratch(spark)}/missing"
    coworkers = t(spark, sf, "customer").select(F.col("c_custkey").alias("coworker_id"), F.col("c_name").alias("name"))
    own = t(spark, sf, "orders").where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("coworker_id"))
    files.write_coworkers_without_files(coworkers, own, path)
    return spark.read.schema("coworker_id bigint, name string").json(path)


@query("""SELECT 'parts' AS sheet, CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part UNION ALL SELECT 'suppliers', CAST(s_suppkey AS VARCHAR), CASE WHEN s_suppkey % 2 = 0 THEN s_name END FROM supplier""")
def report_book(spark: SparkSession, sf: str) -> DataFrame:
    """The sheets of a workbook, written as CSV reports and read back; an empty cell is null."""
    path = f"{scratch(spark)}/book"
    sheets = {"parts": t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), "suppliers": t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("name"))}
    files.write_reports(sheets, path)
    one = [spark.read.csv(f"{path}/{n}", header=True).select(F.lit(n).alias("sheet"), "id", "name") for n in sheets]
    return one[0].unionByName(one[1])


@query("""SELECT s_suppkey AS k, s_suppkey % 3 AS pages, 'manual review' AS review, CASE WHEN s_suppkey % 3 = 0 THEN 'ERROR: no pages' END AS error FROM supplier WHERE s_suppkey % 2 = 1
UNION ALL SELECT s_suppkey, s_suppkey + 3, 'ok', NULL FROM supplier WHERE s_suppkey % 2 = 0""")
def page_counts_report(spark: SparkSession, sf: str) -> DataFrame:
    """Page counts of stand-in scans with a review flag; short and unreadable ones are to be reviewed."""
    k = F.col("s_suppkey")
    scans = t(spark, sf, "supplier").select(k.cast("string").alias("path"), F.lit("pdf").alias("kind"), F.when(k % 2 == 0, k + 3).otherwise(k % 3).cast("string").cast("binary").alias("content"))
    out = files.page_report(files.page_counts(scans, some_pages))
    return out.select(F.col("path").cast("bigint").alias("k"), F.coalesce(F.col("pages"), F.lit(0)).cast("bigint").alias("pages"), "review", "error")


def some_pages(content: bytes) -> int:
    if not int(content):
        raise ValueError("no pages")
    return int(content)
