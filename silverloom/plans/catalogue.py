"""Named queries over the test tables, one or more for each operator family, with their SQL.

Stand-ins: orders are contracts (customer = coworker, order date = start, priority =
tariff), events are bronze snapshots (user = key, props = payload), pages hold HTML.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.functions import dates as D
from silverloom.functions import json as J
from silverloom.functions import numbers as N
from silverloom.functions import strings as S
from silverloom.operators import profile
from silverloom.operators import tables as O
from silverloom.operators.distinct import distinct_counts, distinct_state
from silverloom.plans import enrichment, entities, extraction, medallion, reports
from silverloom.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: The date from which reports look; a parameter of every report.
AS_OF = dt.date(1997, 6, 15)
TEXT_DAY = "strftime(o_orderdate, '%Y-%m-%d')"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    from silverloom.plans import runs  # noqa: F401  registers the queries of whole runs

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def day(c: str = "o_orderdate") -> Column:
    return F.col(c).cast("date")


# --- latest rows, typed JSON, labels ---------------------------------------------------------


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events)
SELECT user_id, event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  CASE event_type WHEN 'click' THEN 'Click' WHEN 'view' THEN 'View' WHEN 'purchase' THEN 'Purchase' ELSE 'Unknown' END AS label
FROM r WHERE rn = 1 AND user_id NOT IN (3, 5, 8)""")
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The newest event of each user that isn't excluded, its payload typed and its type labelled."""
    rows = t(spark, sf, "events").where(~F.coalesce(F.col("user_id").isin(3, 5, 8), F.lit(False)))
    rows = O.latest(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    label = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for x in ("click", "Click", "view", "View", "purchase", "Purchase")]), "event_type"), F.lit("Unknown"))
    return rows.select("user_id", "event_id", J.field(J.parsed(F.col("props")), "k", "bigint").alias("k"), label.alias("label"))


@query("SELECT e.user_id, e.event_id, e.event_type FROM events e JOIN (SELECT user_id, max(ts) m FROM events GROUP BY 1) x ON e.user_id = x.user_id AND e.ts = x.m")
def latest_snapshot_ties(spark: SparkSession, sf: str) -> DataFrame:
    return O.latest_with_ties(t(spark, sf, "events"), ["user_id"], "ts").select("user_id", "event_id", "event_type")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_int, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double, CASE WHEN json_extract_string(props, '$.k') IS NULL THEN NULL ELSE CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) <> 0 AS INT) END AS k_bit, json_extract_string(props, '$.none') AS none FROM events")
def typed_json_projection(spark: SparkSession, sf: str) -> DataFrame:
    v = J.parsed(F.col("props"))
    return t(spark, sf, "events").withColumn("v", v).select(
        "event_id", J.field(F.col("v"), "k", "bigint").alias("k_int"), J.field(F.col("v"), "k", "double").alias("k_double"), N.flag(J.truthy(F.col("v"), "k")).alias("k_bit"), J.text(F.col("v"), "none").alias("none")
    )


@query(r"SELECT page_id, nullif(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g')), '') AS body FROM pages")
def strip_html(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "pages").select("page_id", S.strip_html(F.col("html")).alias("body"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'Unknown' END AS status_label FROM orders WHERE o_custkey NOT IN (1, 2, 3)")
def label_and_exclude(spark: SparkSession, sf: str) -> DataFrame:
    rows = t(spark, sf, "orders").where(~F.coalesce(F.col("o_custkey").isin(1, 2, 3), F.lit(False)))
    return rows.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "Finished").when(F.col("o_orderstatus") == "O", "Open").otherwise("Unknown").alias("status_label"))


@query("SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END, ''), nullif(c_mktsegment, ''), 'Unknown') AS name FROM customer")
def fallback_chain(spark: SparkSession, sf: str) -> DataFrame:
    own = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name"))
    return t(spark, sf, "customer").select("c_custkey", S.first_truthy(own, F.col("c_mktsegment"), F.lit("Unknown")).alias("name"))


DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
HOURS = f"""SELECT o_orderkey, d.n AS day_of_week, d.name AS day_name,
  CASE WHEN a = 0 AND b = 0 THEN NULL ELSE a END AS open_minutes, CASE WHEN a = 0 AND b = 0 THEN NULL ELSE b END AS close_minutes, d.n >= 6 AS is_closed
FROM (SELECT o_orderkey, CAST(o_orderkey % 3 AS INT) * 60 AS a0, CAST(o_orderkey % 2 AS INT) * 170 AS b0 FROM orders) o,
  (VALUES {", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(DAYS))}) d(n, name), LATERAL (SELECT a0 * (d.n - 1) AS a, b0 * (d.n - 1) AS b)"""


def _hours(spark: SparkSession, sf: str) -> DataFrame:
    a, b = (F.col("o_orderkey") % 3).cast("int") * 60, (F.col("o_orderkey") % 2).cast("int") * 170
    days = [(i + 1, n, a * i, b * i, F.lit(i >= 5)) for i, n in enumerate(DAYS)]
    return O.unpivot_days(t(spark, sf, "orders"), "o_orderkey", days)


@query(HOURS)
def hours_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return _hours(spark, sf)


# --- upserts and refreshes -------------------------------------------------------------------


def _split_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stored orders (key not 0 mod 3), and newly read ones (key not 1 mod 3) with another price and status."""
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.where("o_orderkey % 3 <> 1").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return o.where("o_orderkey % 3 <> 0"), new


SPLIT = """WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0),
new AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 3 <> 1) """


@query(SPLIT + """SELECT coalesce(old.o_orderkey, new.o_orderkey) AS o_orderkey,
 CASE WHEN new.o_orderkey IS NOT NULL THEN new.o_orderstatus ELSE old.o_orderstatus END AS o_orderstatus,
 CASE WHEN new.o_orderkey IS NOT NULL THEN new.o_totalprice ELSE old.o_totalprice END AS o_totalprice,
 CASE WHEN old.o_orderkey IS NOT NULL THEN 1 ELSE 2 END AS first_seen FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey""")
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _split_orders(spark, sf)
    return O.upsert(old.withColumn("first_seen", F.lit(1)), new, ["o_orderkey"], first_seen="first_seen", now=F.lit(2))


@query(SPLIT + """SELECT coalesce(old.o_orderkey, new.o_orderkey) AS o_orderkey, CASE WHEN old.o_orderkey IS NULL THEN new.o_orderstatus ELSE old.o_orderstatus END AS o_orderstatus,
 coalesce(new.o_totalprice, old.o_totalprice) AS o_totalprice FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey""")
def upsert_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Only the price is updated on a match, as the day name is kept for opening hours."""
    old, new = _split_orders(spark, sf)
    return O.upsert(old, new, ["o_orderkey"], update=["o_totalprice"])


@query(SPLIT + "SELECT count(*) FILTER (old.o_orderkey IS NULL) AS inserted, count(*) FILTER (old.o_orderkey IS NOT NULL) AS updated FROM new LEFT JOIN old ON old.o_orderkey = new.o_orderkey")
def upsert_counts(spark: SparkSession, sf: str) -> DataFrame:
    return O.upsert_counts(*_split_orders(spark, sf), ["o_orderkey"])


@query(SPLIT + "SELECT * FROM old UNION ALL SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.o_orderkey = new.o_orderkey)")
def insert_only(spark: SparkSession, sf: str) -> DataFrame:
    return O.insert_only(*_split_orders(spark, sf), ["o_orderkey"])


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey % 5 <> 0
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1 FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber <= 2""")
def replace_by_key(spark: SparkSession, sf: str) -> DataFrame:
    lines = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    keys = lines.where("l_orderkey % 5 = 0")
    new = keys.where("l_linenumber <= 2").withColumn("l_quantity", F.col("l_quantity") + 1)
    return O.replace_by_key(lines, new, keys, ["l_orderkey"])


# --- joins -----------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name FROM customer c WHERE c_acctbal IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'F')")
def unenriched_anti(spark: SparkSession, sf: str) -> DataFrame:
    done = t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return O.missing(t(spark, sf, "customer").where("c_acctbal is not null"), done, ["c_custkey"]).select("c_custkey", "c_name")


@query("""SELECT c_custkey AS source_id, o_orderkey AS run, CASE WHEN o_orderdate IS NOT NULL THEN 'enriched' ELSE 'pending' END AS enrichment FROM customer LEFT JOIN
(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders WHERE o_orderpriority = '1-URGENT') o ON o_custkey = c_custkey AND rn = 1""")
def enrichment_status(spark: SparkSession, sf: str) -> DataFrame:
    log = t(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("location_source_id"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("finished_at"))
    out = enrichment.status(t(spark, sf, "customer").select(F.col("c_custkey").alias("location_source_id")), log)
    return out.select(F.col("location_source_id").alias("source_id"), F.col("id").alias("run"), "enrichment")


@query("SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), (SELECT string_split(p_name, ' ')[1] FROM part WHERE p_partkey = (SELECT min(p_partkey) FROM part)))")
def product_exists_in_list(spark: SparkSession, sf: str) -> DataFrame:
    parts = t(spark, sf, "part")
    word = parts.agg(F.min_by(F.get(F.split("p_name", " "), F.lit(0)), "p_partkey")).scalar()
    return parts.where(F.array_contains(F.split("p_name", " "), word)).select("p_partkey", "p_name")


@query("""SELECT DISTINCT l_partkey AS product_id, l_orderkey AS source_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' AND l_partkey % 3 = 0""")
def contracts_of_product(spark: SparkSession, sf: str) -> DataFrame:
    """Active contracts of every third product, found in their desk lists."""
    lists = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(F.col("l_partkey").cast("string")), ",").alias("floor_plan_desk_ids"))
    own = lists.join(t(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("source_id"), N.flag(F.col("o_orderstatus") == "F").alias("active"), "floor_plan_desk_ids")
    products = t(spark, sf, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("source_id"))
    return reports.contracts_of(own, products).select("product_id", "source_id")


@query("""WITH d AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
SELECT l_orderkey AS source_id, CAST(coalesce(sum(p_size), 0) AS BIGINT) AS capacity FROM d LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def list_capacity_sum(spark: SparkSession, sf: str) -> DataFrame:
    """Desk lists are comma strings with brackets and repeats; each desk counts once."""
    lists = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.col("l_partkey").cast("string")), ", "), F.lit("]")).alias("floor_plan_desk_ids"))
    parts = t(spark, sf, "part").select(F.col("p_partkey").alias("source_id"), F.col("p_size").alias("capacity"))
    return reports.desk_capacity(lists.withColumnRenamed("l_orderkey", "source_id"), parts).select("source_id", F.col("capacity").cast("bigint").alias("capacity"))


def _rooms(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    key = F.col("c_custkey")
    rooms = t(spark, sf, "customer").select(
        key.alias("source_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("location_source_id"), F.when(key % 7 != 0, F.left("c_mktsegment", F.lit(4))).alias("resource_type_name"),
        (key % 5 + 1).cast("int").alias("item_type"), (key % 9).cast("int").alias("capacity"), F.when(key % 4 != 0, key % 150).alias("resource_id"),
    )
    services = t(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("location_source_id"), F.lit("EUR").alias("currency_code"), F.lit(4).alias("charge_period"),
        F.when(F.col("s_suppkey") % 3 == 0, "BUILDING,MACHINERY").when(F.col("s_suppkey") % 3 == 1, "AUTOMOBILE").alias("resource_type_names"), F.col("s_acctbal").alias("price"),
        (F.col("s_suppkey") % 2).cast("int").alias("is_default_price"), (F.col("s_suppkey") % 3 > 0).cast("int").alias("only_for_members"),
    )
    return rooms, services


ROOMS = """WITH r AS (SELECT c_name AS name, c_nationkey AS loc, CASE WHEN c_custkey % 7 <> 0 THEN left(c_mktsegment, 4) END AS kind, CAST(c_custkey % 9 AS INT) AS capacity,
 CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 150 END AS resource, CAST(c_custkey % 5 + 1 AS INT) AS item_type FROM customer WHERE c_custkey % 5 + 1 IN (4, 5)),
s AS (SELECT s_name AS tier, s_nationkey AS loc, CASE WHEN s_suppkey % 3 = 0 THEN 'BUILDING,MACHINERY' WHEN s_suppkey % 3 = 1 THEN 'AUTOMOBILE' END AS names, s_acctbal AS price, CAST(s_suppkey % 2 AS INT) AS is_default, CAST(s_suppkey % 3 > 0 AS INT) AS members FROM supplier) """


@query(ROOMS + "SELECT r.loc AS location_source_id, name AS room_name, kind AS resource_type_name, capacity, tier AS price_tier, price, 'EUR' AS currency_code, 4 AS charge_period, members AS only_for_members, is_default AS is_default_price FROM r JOIN s ON r.loc = s.loc AND (names IS NULL OR contains(names, kind))")
def room_pricing_theta(spark: SparkSession, sf: str) -> DataFrame:
    return reports.room_prices(*_rooms(spark, sf))


@query(ROOMS + """SELECT n_name AS location, r.name AS product_name, r.item_type, capacity, p_partkey AS resource_id, tier AS pricing_tier, price, CASE WHEN tier IS NOT NULL THEN 'EUR' END AS currency_code
FROM r JOIN nation ON n_nationkey = r.loc LEFT JOIN part ON p_partkey = resource AND p_partkey % 2 = 0 LEFT JOIN s ON r.loc = s.loc AND (names IS NULL OR contains(names, kind))""")
def full_picture(spark: SparkSession, sf: str) -> DataFrame:
    rooms, services = _rooms(spark, sf)
    locations = t(spark, sf, "nation").select(F.col("n_nationkey").alias("source_id"), F.col("n_name").alias("name"))
    resources = t(spark, sf, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("source_id"))
    return reports.full_picture(locations, rooms, resources, services)


@query("SELECT p_partkey, s_suppkey FROM part JOIN supplier ON CAST(p_size % 25 AS VARCHAR) = CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey || ',' || s_suppkey ELSE CAST(s_nationkey AS VARCHAR) END")
def multi_value_equality(spark: SparkSession, sf: str) -> DataFrame:
    """Equality with a list text matches lists of one value only."""
    s = t(spark, sf, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.concat_ws(",", F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string"))).otherwise(F.col("s_nationkey").cast("string")).alias("resource_type_names"))
    p = t(spark, sf, "part").select("p_partkey", (F.col("p_size") % 25).cast("string").alias("resource_type_name"))
    return reports.same_types(p, s).select("p_partkey", "s_suppkey")


@query("SELECT s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 2 = 1 AND s_suppkey % 3 = 0")
def price_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Default prices that aren't for members only."""
    rows = t(spark, sf, "supplier").withColumns({"is_default_price": F.col("s_suppkey") % 2, "only_for_members": N.flag(F.col("s_suppkey") % 3 > 0)})
    return reports.tiers(rows, is_default_price=1, only_for_members=0).select("s_suppkey", "s_acctbal")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment ILIKE 'mach%'")
def company_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return reports.companies(t(spark, sf, "customer").withColumn("coworker_company", F.col("c_mktsegment")), "Mach").select("c_custkey")


@query("SELECT DISTINCT l_suppkey AS location_id, l_partkey AS resource_id FROM lineitem WHERE l_suppkey <> 0 AND l_partkey <> 0")
def resource_pairs(spark: SparkSession, sf: str) -> DataFrame:
    from silverloom.sources.lookups import resource_pairs as pairs

    return pairs(t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("location_id"), F.col("l_partkey").alias("resource_id")))


# --- contracts -------------------------------------------------------------------------------


def contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as contracts: open ones have no cancellation, every third has no term."""
    start = day()
    return t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("source_id"), F.col("o_custkey").alias("coworker_id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("coworker_name"), start.alias("start_date"),
        F.when(F.col("o_orderkey") % 3 != 0, F.add_months(start, (F.col("o_orderkey") % 40).cast("int"))).alias("contract_term"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(start, (F.col("o_orderkey") % 400).cast("int"))).alias("cancellation_date"),
        F.col("o_orderpriority").alias("tariff_name"), F.when(F.col("o_orderkey") % 4 == 0, "1-URGENT").otherwise(F.col("o_orderpriority")).alias("next_tariff_name"), F.when(F.col("o_orderkey") % 5 != 0, "1,2").alias("floor_plan_desk_ids"),
    )


CONTRACTS = """WITH c AS (SELECT o_orderkey AS source_id, o_custkey AS coworker_id, 'c' || o_custkey AS coworker_name, CAST(o_orderdate AS DATE) AS start_date,
 CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_orderdate AS DATE) + to_months(CAST(o_orderkey % 40 AS INT)) AS DATE) END AS contract_term,
 CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INT) END AS cancellation_date,
 o_orderpriority AS tariff_name, CASE WHEN o_orderkey % 4 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS next_tariff, CASE WHEN o_orderkey % 5 <> 0 THEN '1,2' END AS desks FROM orders),
v AS (SELECT * FROM c WHERE tariff_name ILIKE '%urgent%' AND (cancellation_date IS NULL OR start_date <> cancellation_date)),
w AS (SELECT *, row_number() OVER (PARTITION BY coworker_id ORDER BY start_date, source_id) rf, row_number() OVER (PARTITION BY coworker_id ORDER BY start_date DESC, source_id DESC) rl FROM v),
fl AS (SELECT l.coworker_id, l.coworker_name, f.start_date AS first_start, l.source_id, l.start_date, l.contract_term, l.cancellation_date FROM w l JOIN w f ON l.coworker_id = f.coworker_id AND f.rf = 1 WHERE l.rl = 1) """


@query(CONTRACTS + "SELECT coworker_id, coworker_name, first_start, cancellation_date, date_diff('month', first_start, cancellation_date) AS tenure_months FROM fl WHERE cancellation_date IS NOT NULL")
def first_last_tenure(spark: SparkSession, sf: str) -> DataFrame:
    """Coworkers whose last valid contract is cancelled, with their tenure."""
    out = reports.cancelled_coworkers(contracts(spark, sf), "urgent")
    return out.select("coworker_id", "coworker_name", "first_start", "cancellation_date", F.col("tenure_months").cast("bigint").alias("tenure_months"))


#: First start to last cancellation by next tariff; contracts of no length count too.
TENURES = CONTRACTS + """, k AS (SELECT *, row_number() OVER (PARTITION BY coworker_id ORDER BY start_date, source_id) ka, row_number() OVER (PARTITION BY coworker_id ORDER BY start_date DESC, source_id DESC) kz FROM c WHERE next_tariff ILIKE '%urgent%'),
te AS (SELECT a.coworker_id, z.coworker_name, a.start_date AS first_start_date, z.cancellation_date AS last_cancellation_date, date_diff('month', a.start_date, z.cancellation_date) AS tenure_months
 FROM k a JOIN k z ON a.coworker_id = z.coworker_id AND a.ka = 1 AND z.kz = 1 WHERE z.cancellation_date IS NOT NULL) """


@query(TENURES + "SELECT * FROM te")
def tenure_ad_hoc(spark: SparkSession, sf: str) -> DataFrame:
    return reports.tenures(contracts(spark, sf), "urgent").withColumn("tenure_months", F.col("tenure_months").cast("bigint"))


@query(TENURES + "SELECT *, CAST(trunc(avg(tenure_months) OVER ()) AS BIGINT) AS avg_tenure_months FROM te WHERE tenure_months > 0")
def tenure_with_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Positive tenures beside their truncated average."""
    return reports.average_tenures(contracts(spark, sf), "urgent").withColumn("tenure_months", F.col("tenure_months").cast("bigint"))


@query(CONTRACTS + """SELECT coworker_id, source_id FROM c WHERE (start_date >= DATE '1997-06-15' OR coalesce(contract_term, DATE '1997-06-15') >= DATE '1997-06-15') AND cancellation_date IS NULL
 AND next_tariff ILIKE '%urgent%' AND coalesce(contract_term, DATE '1997-12-15') >= DATE '1997-12-15' AND desks IS NOT NULL AND coworker_id = 7""")
def running_contracts_of_one(spark: SparkSession, sf: str) -> DataFrame:
    return reports.running(contracts(spark, sf), "urgent", F.lit(AS_OF), coworker=7).select("coworker_id", "source_id")


@query(CONTRACTS + """, n AS (SELECT *, row_number() OVER (PARTITION BY coworker_id ORDER BY start_date DESC, source_id DESC) rn FROM c
 WHERE (start_date >= DATE '1997-06-15' OR (start_date < DATE '1997-06-15' AND coalesce(contract_term, DATE '1997-06-15') >= DATE '1997-06-15'))
 AND coalesce(contract_term, DATE '1997-12-15') >= DATE '1997-12-15' AND desks IS NOT NULL AND next_tariff ILIKE '%urgent%'),
f AS (SELECT coworker_id, min(start_date) AS first_start FROM c WHERE tariff_name ILIKE '%urgent%' GROUP BY 1)
SELECT n.coworker_id, n.source_id, f.first_start, date_diff('month', f.first_start, coalesce(contract_term, DATE '1997-06-15')) AS tenure_months FROM n JOIN f ON n.coworker_id = f.coworker_id WHERE rn = 1""")
def future_contracts(spark: SparkSession, sf: str) -> DataFrame:
    out = reports.future_contracts(contracts(spark, sf), "urgent", F.lit(AS_OF))
    return out.select("coworker_id", "source_id", "first_start", F.col("tenure_months").cast("bigint").alias("tenure_months"))


@query(CONTRACTS + "SELECT coworker_id, source_id, start_date FROM w WHERE rl = 1 AND contract_term IS NULL AND cancellation_date IS NULL")
def open_ended(spark: SparkSession, sf: str) -> DataFrame:
    return reports.open_ended(contracts(spark, sf), "urgent").select("coworker_id", "source_id", "start_date")


@query(CONTRACTS + "SELECT coworker_id, source_id FROM w WHERE rl = 1")
def latest_valid_contract(spark: SparkSession, sf: str) -> DataFrame:
    return O.latest(reports.valid_contracts(contracts(spark, sf), "urgent"), ["coworker_id"], [F.desc("start_date"), F.desc("source_id")]).select("coworker_id", "source_id")


@query("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 AS INT) - 300 AS b FROM orders),
m AS (SELECT *, date_diff('month', a, b) AS n FROM o)
SELECT o_orderkey, n AS boundaries, CASE WHEN b >= a THEN n - CASE WHEN CAST(a + to_months(CAST(n AS INT)) AS DATE) > b THEN 1 ELSE 0 END
 ELSE n + CASE WHEN CAST(a + to_months(CAST(n AS INT)) AS DATE) < b THEN 1 ELSE 0 END END AS complete FROM m""")
def complete_months(spark: SparkSession, sf: str) -> DataFrame:
    a, b = day(), F.date_add(day(), (F.col("o_orderkey") % 900).cast("int") - 300)
    return t(spark, sf, "orders").select("o_orderkey", D.month_boundaries(a, b).cast("bigint").alias("boundaries"), D.complete_months(a, b).cast("bigint").alias("complete"))


#: Terms for the roll-forward: the end lies 1 to 14 months and up to 27 days after the start.
TERMS = """WITH RECURSIVE o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate + to_months(CAST(o_orderkey % 14 + 1 AS INT)) AS DATE) + CAST(o_orderkey % 28 AS INT) AS e, o_orderkey % 2 = 0 AS monthly FROM orders),
x AS (SELECT *, date_diff('month', s, e) AS n FROM o),
y AS (SELECT *, n - CASE WHEN CAST(s + to_months(CAST(n AS INT)) AS DATE) > e THEN 1 ELSE 0 END AS cm FROM x),
z AS (SELECT o_orderkey, s, e, CASE WHEN monthly THEN 1 ELSE cm END AS m, CASE WHEN monthly THEN 0 ELSE e - CAST(s + to_months(CAST(cm AS INT)) AS DATE) END AS d FROM y),
r AS (SELECT o_orderkey, s, e, m, d FROM z UNION ALL SELECT o_orderkey, s, CAST(e + to_months(CAST(m AS INT)) AS DATE) + CAST(d AS INT), m, d FROM r WHERE e < DATE '1997-06-15'),
f AS (SELECT o_orderkey, s, m, d, max(e) AS rolled FROM r GROUP BY ALL) """


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    start = day()
    end = F.date_add(F.add_months(start, (F.col("o_orderkey") % 14 + 1).cast("int")), (F.col("o_orderkey") % 28).cast("int"))
    rows = t(spark, sf, "orders").select("o_orderkey", start.alias("s"), end.alias("e"), F.when(F.col("o_orderkey") % 2 == 0, "monthly").otherwise("same_duration").alias("category"))
    m, d = D.renewal_delta(F.col("s"), F.col("e"), F.col("category"))
    rows = rows.withColumns({"m": m, "d": d})
    return rows.withColumn("rolled", D.roll_forward(F.col("e"), F.col("m"), F.col("d"), F.lit(AS_OF)))


@query(TERMS + "SELECT o_orderkey, m AS months, CAST(d AS BIGINT) AS days, rolled FROM f")
def roll_forward(spark: SparkSession, sf: str) -> DataFrame:
    return _terms(spark, sf).select("o_orderkey", F.col("m").cast("bigint").alias("months"), F.col("d").cast("bigint").alias("days"), "rolled")


NOTICE = {"1-11 months": {"0-24": "2 months", "25-74": "2 months"}, "12-23 months": {"0-24": "2 months", "25-74": "3 months", "75+": "N/A"}, "24+ months": {"0-24": "3 months", "75+": "6 months"}}
NOTICE_SQL = " UNION ALL ".join(f"SELECT '{r}' AS ten, '{c}' AS cap, '{v}' AS label" for r, own in NOTICE.items() for c, v in own.items())


@query(TERMS + f""", b AS (SELECT *, date_diff('month', s, DATE '1997-06-15') AS n, o_orderkey % 90 AS desks FROM f),
w AS (SELECT *, n - CASE WHEN CAST(s + to_months(CAST(n AS INT)) AS DATE) > DATE '1997-06-15' AND s <= DATE '1997-06-15' THEN 1 ELSE 0 END + CASE WHEN s > DATE '1997-06-15' AND CAST(s + to_months(CAST(n AS INT)) AS DATE) < DATE '1997-06-15' THEN 1 ELSE 0 END AS whole FROM b),
l AS (SELECT w.*, coalesce(label, 'N/A') AS notice_label FROM w LEFT JOIN ({NOTICE_SQL}) x ON ten = CASE WHEN whole <= 11 THEN '1-11 months' WHEN whole <= 23 THEN '12-23 months' ELSE '24+ months' END AND cap = CASE WHEN desks <= 24 THEN '0-24' WHEN desks <= 74 THEN '25-74' ELSE '75+' END),
g AS (SELECT *, coalesce(try_cast(nullif(regexp_extract(notice_label, '^([0-9]+) *month', 1), '') AS INT), 0) AS notice FROM l),
q AS (SELECT o_orderkey, m, d, notice_label, notice, rolled AS e, 0 AS k FROM g UNION ALL SELECT o_orderkey, m, d, notice_label, notice, CAST(e + to_months(CAST(m AS INT)) AS DATE) + CAST(d AS INT), k + 1 FROM q WHERE e < DATE '1997-06-15' + to_months(notice) AND k < 120)
SELECT o_orderkey, notice_label, notice AS notice_months, max(e) AS real_end FROM q GROUP BY 1, 2, 3""")
def notice_period(spark: SparkSession, sf: str) -> DataFrame:
    """The notice by tenure and capacity, looked up in a table, and the end that leaves room for it."""
    rows = _terms(spark, sf).withColumn("table", J.constant(NOTICE))
    rows = rows.withColumn("notice_label", reports.notice_of(F.col("table"), D.complete_months(F.col("s"), F.lit(AS_OF)), F.col("o_orderkey") % 90))
    rows = rows.withColumn("notice", S.notice_months(F.col("notice_label")))
    return rows.select("o_orderkey", "notice_label", F.col("notice").alias("notice_months"), D.notice_end(F.col("rolled"), F.col("m"), F.col("d"), F.lit(AS_OF), F.col("notice")).alias("real_end"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS iso, CAST(o_orderdate AS DATE) AS dmy, CAST(o_orderdate AS DATE) AS dotted, CAST(o_orderdate AS DATE) AS cut,
 last_day(CAST(o_orderdate AS DATE)) AS clamped, CAST(NULL AS DATE) AS none, CAST(NULL AS DATE) AS prose FROM orders""")
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Every written form of the order date, a day beyond its month, and a text without a date."""
    f = lambda p: F.date_format("o_orderdate", p)
    forms = {"iso": f("yyyy-MM-dd"), "dmy": f("d/M/yyyy"), "dotted": f("dd.MM.yyyy"), "cut": F.concat(f("dd.MM.yyyy"), F.lit(", then monthly")), "clamped": F.concat(F.lit("31/"), f("M/yyyy")), "none": F.lit("TBD"), "prose": F.concat(F.lit("30 days after 12 months of "), f("yyyy"))}
    return t(spark, sf, "orders").select("o_orderkey", *[D.parse_date(c).alias(n) for n, c in forms.items()])


@query("SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) - INTERVAL 2 HOUR AS at, CAST(NULL AS TIMESTAMP) AS bad FROM orders")
def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    return t(spark, sf, "orders").select("o_orderkey", D.parse_timestamp(text).cast("timestamp_ntz").alias("at"), D.parse_timestamp(F.lit("10:30")).cast("timestamp_ntz").alias("bad"))


@query("""WITH x AS (SELECT o_orderkey, ['Month-to-month', 'same period as before', 'by agreement', '', 'monthly; same duration', '  '][CAST(o_orderkey % 6 + 1 AS INT)] AS t FROM orders)
SELECT o_orderkey, CASE WHEN t = '' THEN 'unknown' WHEN t ILIKE '%month-to-month%' THEN 'monthly' WHEN t ILIKE '%same period%' OR t ILIKE '%same duration%' THEN 'same_period_initial_commitment' ELSE 'personalized' END AS extracted,
 CASE WHEN t = '' THEN 'unknown' WHEN t ILIKE '%same duration%' THEN 'same_duration' WHEN t ILIKE '%month%' THEN 'monthly' ELSE 'personalized' END AS reported FROM x""")
def renewal_classify(spark: SparkSession, sf: str) -> DataFrame:
    texts = F.array(*[F.lit(x) for x in ("Month-to-month", "same period as before", "by agreement", "", "monthly; same duration", "  ")])
    text = F.get(texts, (F.col("o_orderkey") % 6).cast("int"))
    return t(spark, sf, "orders").select("o_orderkey", S.classify_renewal(text).alias("extracted"), S.renewal_category(text).alias("reported"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS q, CAST(l_quantity AS INT) || ' Months notice' AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN q - 5 <= 11 THEN '1-11 months' WHEN q - 5 <= 23 THEN '12-23 months' ELSE '24+ months' END AS tenure, CASE WHEN q * 2 <= 24 THEN '0-24' WHEN q * 2 <= 74 THEN '25-74' ELSE '75+' END AS capacity,
 q AS anchored, 0 AS other FROM x""")
def buckets(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    text = F.concat(q.cast("string"), F.lit(" Months notice"))
    return t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", S.tenure_bucket(q - 5).alias("tenure"), S.capacity_bucket(q * 2).alias("capacity"), S.notice_months(text).alias("anchored"), S.notice_months(F.concat(F.lit("at least "), text)).alias("other")
    )


# --- aggregates ------------------------------------------------------------------------------


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders GROUP BY 1, 2")
def distinct_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct counts from bitmaps that are built by day and merged, as stored states would be."""
    by, o = ["o_orderstatus", "o_orderpriority"], t(spark, sf, "orders").withColumn("day", F.datediff(day(), F.lit("1970-01-01")))
    out = o.groupBy(*by).agg(F.count("*").alias("n"))
    for name, number in (("customers", "o_custkey"), ("days", "day")):
        out = out.join(distinct_counts(distinct_state(o, [*by, "day"], F.col(number)), by, name), by)
    return out


@query("SELECT o_orderpriority, count(*) AS n, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished, count(CASE WHEN o_totalprice > 100000 THEN 1 END) AS large FROM orders GROUP BY 1")
def bit_summary(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum(N.flag(F.col("o_orderstatus") == "F")).alias("finished"), F.count(F.when(F.col("o_totalprice") > 100000, 1)).alias("large"))


@query("SELECT n_name, count(c_custkey) AS n, count(DISTINCT c_mktsegment) AS segments, min(c_acctbal) AS lowest, max(c_acctbal) AS highest FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def minmax_by_group(spark: SparkSession, sf: str) -> DataFrame:
    both = t(spark, sf, "nation").join(t(spark, sf, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return both.groupBy("n_name").agg(F.count("c_custkey").alias("n"), F.count_distinct("c_mktsegment").alias("segments"), F.min("c_acctbal").alias("lowest"), F.max("c_acctbal").alias("highest"))


@query("SELECT user_id, CAST(sum(CASE WHEN value <= 50 AND event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks, CAST(sum(CASE WHEN value <= 50 AND event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views, count(*) AS n FROM events GROUP BY 1")
def conditional_counts(spark: SparkSession, sf: str) -> DataFrame:
    one = lambda k: F.sum(F.when((F.col("value") <= 50) & (F.col("event_type") == k), 1).otherwise(0))
    return t(spark, sf, "events").groupBy("user_id").agg(one("click").alias("clicks"), one("view").alias("views"), F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, round(count(*) FILTER (value > 10) * 100.0 / count(*), 6) AS success_pct FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1")
def success_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Success rate of the last seven days by function."""
    e = t(spark, sf, "events")
    recent = e.where(F.col("ts") > e.agg(F.max("ts")).scalar() - F.expr("interval 7 days"))
    return recent.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.count_if(F.col("value") > 10) * 100.0 / F.count("*"), 6).alias("success_pct"))


@query("SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_guard(spark: SparkSession, sf: str) -> DataFrame:
    return O.duplicates(t(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@query("SELECT 'UQ_custkey_date' AS \"constraint\", CASE WHEN (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)) > 0 THEN 'SKIP' ELSE 'ADDED' END AS outcome")
def constraint_guard(spark: SparkSession, sf: str) -> DataFrame:
    return O.unique_guard(t(spark, sf, "orders"), "UQ_custkey_date", ["o_custkey", "o_orderdate"], exists=False)


NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in NAMES))
def table_counts_union(spark: SparkSession, sf: str) -> DataFrame:
    return reports.table_counts({n: t(spark, sf, n) for n in NAMES})


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def topn_recent(spark: SparkSession, sf: str) -> DataFrame:
    """The ten latest runs: the limit is the report."""
    return t(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(10)


@query("""WITH x AS (SELECT l_suppkey, l_partkey, l_linenumber, l_orderkey, row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY l_shipdate DESC, l_orderkey) AS rk FROM lineitem),
y AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_linenumber, rk) AS rn FROM x WHERE rk <= 20)
SELECT l_suppkey, l_partkey, l_linenumber AS category, rk AS result_rank FROM y WHERE rn = 1""")
def first_category_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Each search is capped first; then a place keeps its first category only."""
    from pyspark.sql import Window

    w = Window.partitionBy("l_suppkey", "l_linenumber").orderBy(F.desc("l_shipdate"), "l_orderkey")
    x = t(spark, sf, "lineitem").withColumn("result_rank", F.row_number().over(w).cast("bigint")).where("result_rank <= 20")
    return O.first_category(x, ["l_suppkey", "l_partkey"], ["l_linenumber", "result_rank"]).select("l_suppkey", "l_partkey", F.col("l_linenumber").alias("category"), "result_rank")


@query("""WITH x AS (SELECT c_custkey, 40 + c_custkey % 10 / 100.0 AS la, -3 - c_nationkey / 200.0 AS lo FROM customer),
h AS (SELECT *, power(sin(radians(la - 40.05) / 2), 2) + cos(radians(40.05)) * cos(radians(la)) * power(sin(radians(lo + 3.01) / 2), 2) AS a FROM x),
d AS (SELECT c_custkey, CAST(trunc(2 * 6371000 * atan2(sqrt(a), sqrt(1 - a))) AS INT) AS metres FROM h)
SELECT c_custkey, metres, greatest(1, CAST(round_even(metres / 80.0, 0) AS INT)) AS minutes FROM d""")
def haversine_walk(spark: SparkSession, sf: str) -> DataFrame:
    la, lo = F.lit(40.0) + (F.col("c_custkey") % 10) / F.lit(100.0), F.lit(-3.0) - F.col("c_nationkey") / F.lit(200.0)
    metres = N.haversine_m(F.lit(40.05), F.lit(-3.01), la, lo)
    return t(spark, sf, "customer").select("c_custkey", metres.alias("metres"), N.walking_minutes(metres).alias("minutes"))


@query("""SELECT n_nationkey, n_name AS neighborhood, lower(n_name) AS district, CAST(n_regionkey AS VARCHAR) AS city, CAST(n_nationkey AS VARCHAR) AS postal_code FROM nation""")
def geocode_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered fold over address components, by nation; the second sublocality falls through to the district."""
    c = lambda kinds, name: F.struct(F.array(*[F.lit(k) for k in kinds]).alias("types"), name.alias("long_name"))
    n = F.col("n_name")
    parts = F.array(c(["sublocality", "sublocality_level_1"], n), c(["sublocality", "sublocality_level_1"], F.lower(n)), c(["locality"], F.col("n_regionkey").cast("string")), c(["postal_code"], F.col("n_nationkey").cast("string")))
    return t(spark, sf, "nation").select("n_nationkey", J.address_parts(parts).alias("a")).select("n_nationkey", "a.*")


# --- profiling and quality -------------------------------------------------------------------


@query("""WITH x AS (SELECT event_type, json_extract_string(props, '$.k') AS v FROM events)
SELECT event_type, 'k' AS path, count(*) AS n, count(*) AS records, 100.0::DOUBLE AS coverage_pct, 0.0::DOUBLE AS null_pct, 'int' AS kinds,
 array_to_string(list_sort(list(DISTINCT v))[1:3], '|') AS samples, CASE WHEN count(DISTINCT v) = 1 THEN 'constant' ELSE '' END AS flag FROM x GROUP BY 1""")
def key_coverage(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.coverage(t(spark, sf, "events"), "props", ["event_type"])
    return out.select("event_type", "path", "n", "records", *[F.col(c).cast("double").alias(c) for c in ("coverage_pct", "null_pct")], *[F.array_join(c, "|").alias(c) for c in ("kinds", "samples")], "flag")


def _payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Events with nested payloads: all have 'a', null at times; clicks and some others have 'b' with 'c' inside, and an internal key."""
    more = F.when((F.col("event_id") % 4 == 0) | (F.col("event_type") == "click"), F.concat(F.lit('{"a": 1, "Is": {"d": 1}, "b": {"c": '), F.col("event_id").cast("string"), F.lit("}}"))).otherwise('{"a": null}')
    return t(spark, sf, "events").select("event_type", more.alias("raw"))


PAYLOADS = "WITH x AS (SELECT event_type, event_id, event_id % 4 = 0 OR event_type = 'click' AS has FROM events), g AS (SELECT event_type, count(*) AS records, count(*) FILTER (has) AS m FROM x GROUP BY 1)"


@query(PAYLOADS + """, p AS (SELECT event_type, round(m * 100.0 / records, 1) AS pct FROM g), w AS (SELECT coalesce(max(pct) FILTER (event_type = 'click'), 0)::DOUBLE AS click, coalesce(max(pct) FILTER (event_type = 'view'), 0)::DOUBLE AS view, coalesce(max(pct) FILTER (event_type = 'purchase'), 0)::DOUBLE AS purchase FROM p)
SELECT path, w.* FROM w, (VALUES ('b'), ('b.c')) v(path) WHERE greatest(click, view, purchase) - least(click, view, purchase) > 20""")
def coverage_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Paths whose coverage differs between two event types by more than 20 points, but for internal keys."""
    groups = ["click", "view", "purchase"]
    out = profile.coverage_pivot(_payloads(spark, sf), "raw", "event_type", groups, drop=["Is"])
    return out.select("path", *[F.col(g).cast("double").alias(g) for g in groups])


@query(PAYLOADS + """, r AS (SELECT event_type, records, 'a' AS path, records AS n, records - m AS nulls, 'NoneType|int' AS kinds, 1 AS d FROM g
 UNION ALL SELECT event_type, records, 'b', m, 0, 'dict', 1 FROM g WHERE m > 0 UNION ALL SELECT event_type, records, 'b.c', m, 0, 'int', 2 FROM g WHERE m > 0)
SELECT event_type, path, n, CASE WHEN path = 'a' AND n = nulls THEN 'NoneType' WHEN path = 'a' AND nulls = 0 THEN 'int' ELSE kinds END AS kinds,
 CASE WHEN n * 100.0 / records < 5 THEN 'very sparse' WHEN nulls * 100.0 / records > 90 THEN 'mostly null' WHEN d = 1 THEN 'constant' WHEN n = records AND nulls = 0 THEN 'complete' ELSE '' END AS flag FROM r""")
def profile_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_by_type(_payloads(spark, sf), "raw", "event_type", ["Is"]).select("event_type", "path", "n", F.array_join("kinds", "|").alias("kinds"), "flag")


@query(f"WITH h AS ({HOURS}) SELECT h.o_orderkey AS location_source_id, day_name, o_orderstatus AS location_name FROM h JOIN orders o ON o.o_orderkey = h.o_orderkey WHERE NOT is_closed AND (open_minutes IS NULL OR close_minutes IS NULL)")
def hours_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Open days without times, with their location."""
    hours = _hours(spark, sf).withColumnRenamed("o_orderkey", "location_source_id")
    locations = t(spark, sf, "orders").select(F.col("o_orderkey").alias("source_id"), F.col("o_orderstatus").alias("name"))
    return reports.open_hours_without_times(hours, locations).select("location_source_id", "day_name", "location_name")


@query("""SELECT CASE WHEN event_id % 10 > 1 THEN event_id END AS source_id, CASE event_id % 10 WHEN 0 THEN 'malformed JSON' WHEN 1 THEN 'missing Id' ELSE 'missing BusinessId' END AS error FROM events WHERE event_id % 10 <= 1 OR event_id % 7 = 0""")
def bronze_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Records that bronze keeps and silver reports: not JSON, without id, without a needed key."""
    e, text = F.col("event_id"), F.col("event_id").cast("string")
    business = F.when(e % 7 != 0, F.lit('"BusinessId": 1, ')).otherwise("")
    raw = F.when(e % 10 == 0, F.concat(F.lit("{"), text)).when(e % 10 == 1, F.concat(F.lit("{"), business, F.lit('"x": '), text, F.lit("}")))
    raw = F.coalesce(raw, F.concat(F.lit("{"), business, F.lit('"Id": '), text, F.lit("}")))
    bronze = entities.bronze_rows(t(spark, sf, "events").select(raw.alias("raw_json")), "r", F.lit("2025-01-01").cast("timestamp"), {})
    return entities.rejects(bronze, ["Id", "BusinessId"]).select("source_id", "error")


@query("""SELECT c_nationkey AS location_source_id, n_name AS location_name, c_custkey, CAST(c_custkey * 37 % 1500 AS INT) AS distance_meters FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def nearby_places(spark: SparkSession, sf: str) -> DataFrame:
    pois = t(spark, sf, "customer").select(F.col("c_nationkey").alias("location_source_id"), "c_custkey", (F.col("c_custkey") * 37 % 1500).cast("int").alias("distance_meters"))
    locations = t(spark, sf, "nation").select(F.col("n_nationkey").alias("source_id"), F.col("n_name").alias("name"))
    return enrichment.nearby(locations, pois, ["c_custkey", "distance_meters"])


@query("""SELECT n_nationkey AS location_source_id, (SELECT CAST(sum(CASE WHEN c_mktsegment = 'BUILDING' AND c_custkey * 37 % 1500 <= 500 THEN 1 ELSE 0 END) AS BIGINT) FROM customer WHERE c_nationkey = n_nationkey) AS restaurants,
 (SELECT CAST(sum(CASE WHEN c_mktsegment = 'MACHINERY' AND c_custkey * 37 % 1500 <= 500 THEN 1 ELSE 0 END) AS BIGINT) FROM customer WHERE c_nationkey = n_nationkey) AS cafes,
 (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_suppkey * 41 % 900 <= 500) AS stops, n_name AS city, 'Mark ' || n_name AS landmark, CAST(NULL AS VARCHAR) AS station FROM nation""")
def neighbourhood_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Address, landmark and what is near each nation, from replies as the service gives them; none has a station."""
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "restaurant").when(F.col("c_mktsegment") == "MACHINERY", "cafe").otherwise("bar")
    pois = t(spark, sf, "customer").select(F.col("c_nationkey").alias("location_source_id"), kind.alias("category"), (F.col("c_custkey") * 37 % 1500).alias("distance_meters"))
    stops = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("location_source_id"), (F.col("s_suppkey") * 41 % 900).alias("distance_meters"))
    name = F.col("n_name")
    city = F.concat(F.lit('{"status": "OK", "results": [{"address_components": [{"types": ["locality"], "long_name": "'), name, F.lit('"}]}]}'))
    mark = F.concat(F.lit('{"status": "OK", "results": [{"place_id": "p", "name": "Mark '), name, F.lit('", "geometry": {"location": {"lat": 1.0, "lng": 2.0}}}]}'))
    none = F.lit('{"status": "ZERO_RESULTS", "results": []}')
    asked = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).alias("category"), r.alias("reply")) for k, c, r in (("geocode", "geocode", city), ("nearest", "landmark", mark), ("nearest", "main_station", none))])
    keys = t(spark, sf, "nation").select(F.col("n_nationkey").alias("location_source_id"), F.lit(0.5).alias("latitude"), F.lit(0.5).alias("longitude"), "n_name")
    replies = keys.select("location_source_id", "latitude", "longitude", F.inline(asked))
    out = enrichment.neighbourhoods(keys, replies, pois, stops)
    return out.select("location_source_id", F.col("total_restaurants_500m").alias("restaurants"), F.col("total_cafes_500m").alias("cafes"), F.col("total_transit_500m").alias("stops"), F.col("city_name").alias("city"), F.col("nearest_landmark_name").alias("landmark"), F.col("nearest_main_station_name").alias("station"))


@query("""WITH f AS (SELECT o_orderkey AS id, o_custkey AS coworker_id, CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '0001-01-01' WHEN o_orderkey % 2 = 0 THEN date_trunc('second', o_orderdate) ELSE o_orderdate END AS made FROM orders)
SELECT coworker_id, id FROM (SELECT *, row_number() OVER (PARTITION BY coworker_id ORDER BY made DESC, id) AS rn FROM f) WHERE rn = 1""")
def latest_file(spark: SparkSession, sf: str) -> DataFrame:
    """The latest file of each customer; times are written in two ways, some not at all."""
    at = F.col("o_orderdate").cast("timestamp")
    text = F.when(F.col("o_orderkey") % 5 == 0, "soon").when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("/Date("), F.unix_millis(at).cast("string"), F.lit(")/"))).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX"))
    return files.latest_files(t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("coworker_id"), text.alias("created_on"))).select("coworker_id", "id")


@query("SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_custkey % 2 = 0 THEN 'internet' END, CASE WHEN c_custkey % 3 = 0 THEN 'heating' END, CASE WHEN c_nationkey > 12 THEN 'cctv' END], lambda x: x IS NOT NULL), ',') AS amenities FROM customer")
def amenity_names(spark: SparkSession, sf: str) -> DataFrame:
    flags = {"internet": N.flag(F.col("c_custkey") % 2 == 0), "heating": N.flag(F.col("c_custkey") % 3 == 0), "cctv": N.flag(F.col("c_nationkey") > 12)}
    return t(spark, sf, "customer").select("c_custkey", F.array_join(S.names_of(flags), ",").alias("amenities"))


@query("SELECT count(*) AS locations, count(*) * 17 AS calls FROM customer WHERE c_custkey % 3 <> 0")
def api_call_estimate(spark: SparkSession, sf: str) -> DataFrame:
    rows = t(spark, sf, "customer").select(F.when(F.col("c_custkey") % 3 != 0, 1.0).alias("latitude"), F.lit(2.0).alias("longitude"))
    return enrichment.api_calls(rows)


@query("SELECT o_orderdate AS at, o_orderpriority AS entity, CAST(o_custkey AS VARCHAR) AS error FROM orders WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '1997-06-15'")
def recent_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Failed runs since a day."""
    rows = t(spark, sf, "orders").select(F.col("o_orderdate").alias("at"), F.col("o_orderpriority").alias("entity"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("status"), F.col("o_custkey").cast("string").alias("error"))
    return reports.recent_errors(rows, F.lit(AS_OF).cast("timestamp_ntz"))


@query("""SELECT event_id, concat_ws(',', CASE WHEN event_id % 10 = 0 THEN 'json' END, CASE WHEN NOT value <= 95 THEN 'range' END) AS broken FROM events WHERE event_id % 10 = 0 OR NOT value <= 95""")
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with malformed payloads or values out of range, with the rules that they break."""
    raw = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    _, bad = O.checked(t(spark, sf, "events").withColumn("raw", raw), {"json": J.parsed(F.col("raw")).isNotNull(), "range": F.col("value") <= 95})
    return bad.select("event_id", F.array_join("broken_rules", ",").alias("broken"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events) SELECT user_id, event_id, event_type, ts FROM r WHERE rn = 1 AND event_type = 'click'""")
def run_log_current(spark: SparkSession, sf: str) -> DataFrame:
    """The current state of each run, where it failed: events are the run log, a view is a run that goes on."""
    log = t(spark, sf, "events").select(F.col("user_id").alias("run_id"), "event_id", "event_type", F.when(F.col("event_type") == "view", "running").otherwise("failed").alias("status"), F.col("ts").alias("at"))
    now = medallion.current_runs(log)
    return now.where("event_type = 'click'").select(F.col("run_id").alias("user_id"), "event_id", "event_type", F.col("at").alias("ts"))


@query("""SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total, min(n_chars) AS least, max(n_chars) AS most, round(avg(n_chars), 1) AS mean, count(*) FILTER (n_chars < 300) AS review FROM documents GROUP BY 1""")
def page_stats_flags(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("n_chars")
    return t(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.sum(c).alias("total"), F.min(c).alias("least"), F.max(c).alias("most"), F.round(F.avg(c), 1).alias("mean"), F.count_if(c < 300).alias("review"))


@query(r"""WITH x AS (SELECT page_id, page_id || '_' || split_part(url, '/', 3) || '_' || split_part(url, '/', 5) AS s FROM pages), p AS (SELECT *, string_split(s, '_') AS q FROM x)
SELECT page_id, q[1] AS coworker_id, q[2] AS coworker_name, array_to_string(q[3:], '_') AS file_id FROM p""")
def filename_split(spark: SparkSession, sf: str) -> DataFrame:
    url = F.split("url", "/")
    stem = F.concat_ws("_", F.col("page_id").cast("string"), F.get(url, F.lit(2)), F.get(url, F.lit(4)))
    return t(spark, sf, "pages").select("page_id", S.stem_parts(stem).alias("s")).select("page_id", "s.*")


@query(r"SELECT page_id, trim(regexp_replace(url, '[^\p{L}\p{N} _-]', '_', 'g')) AS name, left(url, 4) || '...' || right(url, 4) AS masked, printf('%02d:%02d', CAST((page_id % 1440) // 60 AS INT), CAST((page_id % 1440) % 60 AS INT)) AS clock FROM pages")
def small_strings(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "pages").select("page_id", S.safe_filename(F.col("url")).alias("name"), S.masked(F.col("url")).alias("masked"), S.hhmm(F.col("page_id") % 1440).alias("clock"))


@query("SELECT r_regionkey, CASE WHEN r_regionkey % 2 = 0 THEN r_name END AS name, CASE WHEN r_regionkey % 2 <> 0 THEN r_name END AS raw_response FROM region")
def fence_json(spark: SparkSession, sf: str) -> DataFrame:
    """Replies in a code fence, and one that is no JSON."""
    reply = F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit('```json\n{"name": "'), "r_name", F.lit('"}\n```'))).otherwise(F.col("r_name"))
    v = J.fenced_json(reply)
    return t(spark, sf, "region").select("r_regionkey", J.field(v, "name").alias("name"), J.field(v, "raw_response").alias("raw_response"))


@query("""SELECT r_regionkey, 'y' AS "75+", r_name AS "0-24", CASE WHEN r_regionkey % 2 = 0 THEN 'z' END AS other FROM region""")
def map_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two notice tables merged; the first wins where both have a cell."""
    a = F.create_map(F.lit("1-11 months"), F.create_map(F.lit("0-24"), F.col("r_name")))
    b = F.create_map(F.lit("1-11 months"), F.create_map(F.lit("0-24"), F.lit("x"), F.lit("75+"), F.lit("y")), F.when(F.col("r_regionkey") % 2 == 0, "24+ months").otherwise("12-23 months"), F.create_map(F.lit("0-24"), F.lit("z")))
    cell = lambda row, column: F.try_element_at(F.try_element_at("m", F.lit(row)), F.lit(column)).alias(column)
    merged = t(spark, sf, "region").select("r_regionkey", J.merged_tables(a, b).alias("m"))
    return merged.select("r_regionkey", cell("1-11 months", "0-24"), cell("1-11 months", "75+"), cell("24+ months", "0-24").alias("other"))


@query("""SELECT page_id, page_id || '_' || 'n' AS stem_key, CASE WHEN page_id % 3 = 0 THEN 'new' ELSE 'old' END AS contract_type, CASE WHEN page_id % 3 <> 0 AND page_id % 2 = 0 THEN 4 END AS section_page,
 CASE WHEN page_id % 3 = 0 THEN '2 months' WHEN page_id % 2 = 0 THEN '5 months' END AS cell, CASE WHEN page_id % 3 = 0 THEN '6 months' WHEN page_id % 2 = 0 THEN '7 months' END AS continued FROM pages""")
def agreement_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Documents put together from the replies on their pages: two pages may have the section, the first counts, and the next page goes on."""
    p = F.col("page_id")
    old, key = p % 3 != 0, F.concat(p.cast("string"), F.lit("_n_f.pdf"))
    section = lambda has, months: F.when(has, F.lit(f'{{"has_section_5": true, "renewal_text": "monthly basis", "termination_notice_table": {{"1-11 months": {{"0-24": "{months} months"}}}}}}')).otherwise('{"has_section_5": false}')
    asked = [
        (1, "terms", F.lit('```json\n{"start_date": "2025-01-01"}\n```')), (2, "notes", F.lit("no JSON")), (3, "section", section(F.lit(False), 1)), (4, "section", section(p % 2 == 0, 5)),
        (5, "continuation", F.lit('{"has_table": true, "termination_notice_table": {"1-11 months": {"0-24": "9 months"}, "24+ months": {"75+": "7 months"}}}')), (6, "section", section(p % 2 == 0, 8)),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("page"), F.lit(q).alias("question"), r.alias("reply")) for n, q, r in asked])
    replies = t(spark, sf, "pages").select(key.alias("path"), F.lit("pdf").alias("kind"), F.when(old, 12).otherwise(3).alias("total_pages"), F.inline(rows), F.lit(None).cast("string").alias("error"))
    d = extraction.agreements(replies)
    cell = lambda row, column: F.try_element_at(F.try_element_at("termination_notice_table", F.lit(row)), F.lit(column))
    return d.select(F.col("coworker_id").cast("bigint").alias("page_id"), F.concat_ws("_", "coworker_id", "coworker_name").alias("stem_key"), "contract_type", F.col("section_5_found_on_page").alias("section_page"), cell("1-11 months", "0-24").alias("cell"), cell("24+ months", "75+").alias("continued"))
