"""Geo enrichment: nearby places and transit by location, neighbourhood context, and the run that stores them.

A run asks the outside service once for each location and search, keeps the replies, and
derives all rows from them with joins. A location with a failed call is logged as failed and
keeps what it had; the others' rows are replaced whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.functions.json import address_parts
from silverloom.functions.numbers import haversine_m, walking_minutes
from silverloom.functions.strings import first_of, joined
from silverloom.operators.tables import first_category, latest, missing, replace_by_key, upsert
from silverloom.plans.medallion import Table
from silverloom.sources.lookups import lookup, search_plan

#: Searches in order of priority, (category, type, radius, most results).
POI_SEARCHES = [
    ("restaurant", "restaurant", 500, 15), ("cafe", "cafe", 500, 10), ("bar", "bar", 500, 8), ("supermarket", "supermarket", 800, 5), ("pharmacy", "pharmacy", 800, 3),
    ("atm", "atm", 500, 3), ("gym", "gym", 1000, 5), ("parking", "parking", 500, 5), ("hotel", "lodging", 1000, 5), ("park", "park", 800, 5),
]
TRANSIT_SEARCHES = [("metro", "subway_station", 1000, 5), ("train", "train_station", 2000, 3), ("tram", "light_rail_station", 800, 5), ("bus", "bus_station", 500, 5)]
#: Searches of which the first result counts, (name, type, radius, most results).
NEAREST = [("landmark", "tourist_attraction", 2000, 1), ("main_station", "train_station", 5000, 1)]
LOG = "location_source_id long, location_name string, status string, pois_found long, transit_found long, error_message string, started_at timestamp, finished_at timestamp, id string"
PLACES = (
    "status string, results array<struct<place_id: string, name: string, vicinity: string, formatted_address: string, types: array<string>, "
    "geometry: struct<location: struct<lat: double, lng: double>>, rating: double, user_ratings_total: int, price_level: int, business_status: string, "
    "opening_hours: struct<weekday_text: array<string>>>>"
)


def searches(spark: SparkSession) -> DataFrame:
    """All calls for a location: kind (poi, transit, nearest, geocode), ordinal, category, type, radius, max_results."""
    plan = [("poi", POI_SEARCHES), ("transit", TRANSIT_SEARCHES), ("nearest", NEAREST), ("geocode", [("geocode", None, None, None)])]
    rows = [(kind, i, *r) for kind, own in plan for i, r in enumerate(own)]
    return spark.createDataFrame(rows, "kind string, ordinal int, category string, type string, radius int, max_results int")


def api_calls(locations: DataFrame) -> DataFrame:
    """How many calls an enrichment of these locations makes."""
    n = len(POI_SEARCHES) + len(TRANSIT_SEARCHES) + len(NEAREST) + 1
    return locations.where("latitude is not null and longitude is not null").agg(F.count("*").alias("locations"), (F.count("*") * n).alias("calls"))


def places(replies: DataFrame) -> DataFrame:
    """Rows of places from replies (location_source_id, latitude, longitude, ordinal, category, radius, max_results, reply).

    Replies that aren't OK have no places; each search is capped at max_results before the
    same place of a location is kept for its first category only.
    """
    r = replies.withColumn("r", F.from_json("reply", PLACES))
    found = F.when(F.col("r.status") == "OK", F.slice("r.results", F.lit(1), F.col("max_results")))
    rows = r.select("location_source_id", "latitude", "longitude", "ordinal", "category", "radius", F.posexplode(found).alias("result_rank", "p"))
    rows = rows.withColumn("place_id", F.col("p.place_id"))
    rows = first_category(rows, ["location_source_id", "place_id"], ["ordinal", "result_rank"])
    lat, lng = F.col("p.geometry.location.lat"), F.col("p.geometry.location.lng")
    metres = haversine_m(F.col("latitude"), F.col("longitude"), lat, lng)
    return rows.select(
        "location_source_id", "place_id", "category", first_of(F.col("p.types")).alias("primary_type"), joined(F.col("p.types"), ",").alias("all_types"),
        F.coalesce("p.name", F.lit("Unknown")).alias("name"), F.coalesce(F.nullif(F.col("p.vicinity"), F.lit("")), "p.formatted_address").alias("address"), lat.alias("latitude"), lng.alias("longitude"),
        metres.alias("distance_meters"), walking_minutes(metres).alias("walking_minutes"), F.col("p.rating").try_cast("decimal(2,1)").alias("rating"), F.col("p.user_ratings_total").alias("ratings_total"),
        F.col("p.price_level").alias("price_level"), F.col("p.business_status").alias("business_status"), joined(F.col("p.opening_hours.weekday_text"), "\n", True).alias("hours_text"),
        F.col("radius").alias("search_radius"), F.to_json("p").alias("raw_json"),
    )


def transit(replies: DataFrame) -> DataFrame:
    """Rows of stops from replies as of places(); a stop that several searches find keeps its first type. Lines aren't known."""
    return places(replies).select(
        "location_source_id", "place_id", F.col("category").alias("transit_type"), "all_types", "name", "address", "latitude", "longitude",
        "distance_meters", "walking_minutes", F.lit(None).cast("string").alias("transit_lines"), "search_radius", "raw_json",
    )


def first_result(replies: DataFrame, prefix: str, distance: str) -> DataFrame:
    """Name, place, coordinates and distance of each location's first result, as the service ranks it."""
    r = replies.withColumn("r", F.from_json("reply", PLACES))
    p = F.when(F.col("r.status") == "OK", F.get("r.results", F.lit(0)))
    lat, lng = p["geometry"]["location"]["lat"], p["geometry"]["location"]["lng"]
    metres = haversine_m(F.col("latitude"), F.col("longitude"), lat, lng)
    return r.select("location_source_id", p["name"].alias(f"{prefix}_name"), lat.alias(f"{prefix}_lat"), lng.alias(f"{prefix}_lng"), metres.alias(f"{distance}_distance_m"), p["place_id"].alias(f"{distance}_place_id"))


def neighbourhoods(keys: DataFrame, replies: DataFrame, pois: DataFrame, stops: DataFrame) -> DataFrame:
    """One row for each key: address parts, nearest landmark and main station, and what is within 500 m."""
    own = lambda kind, name: replies.where((F.col("kind") == kind) & (F.col("category") == name))
    out = keys.select("location_source_id")
    names = {"neighborhood": "neighborhood_name", "district": "district_name", "city": "city_name"}
    parts = [
        geocoded(own("geocode", "geocode")).withColumnsRenamed(names),
        first_result(own("nearest", "landmark"), "nearest_landmark", "landmark"),
        first_result(own("nearest", "main_station"), "nearest_main_station", "main_station"),
        nearby_counts(pois, stops),
    ]
    for part in parts:
        out = out.join(part, "location_source_id", "left")
    return out.fillna(0, ["total_transit_500m"])


def geocoded(replies: DataFrame) -> DataFrame:
    """Neighbourhood fields of each location from reverse-geocode replies."""
    schema = "status string, results array<struct<address_components: array<struct<types: array<string>, long_name: string>>>>"
    r = replies.withColumn("r", F.from_json("reply", schema))
    parts = F.when(F.col("r.status") == "OK", address_parts(F.flatten(F.transform("r.results", lambda x: x["address_components"]))))
    return r.select("location_source_id", parts.alias("a")).select("location_source_id", "a.*")


def nearby_counts(pois: DataFrame, transit: DataFrame, within: int = 500) -> DataFrame:
    """Places and stops within walking range by location; sums are null where a location has no row, the stop count is 0."""
    near = F.col("distance_meters") <= within
    one = pois.groupBy("location_source_id").agg(*[F.sum(F.when(near & (F.col("category") == c), 1).otherwise(0)).alias(f"total_{c}s_{within}m") for c in ("restaurant", "cafe")])
    two = transit.where(near).groupBy("location_source_id").agg(F.count("*").alias(f"total_transit_{within}m"))
    return one.join(two, "location_source_id", "full_outer").fillna(0, [f"total_transit_{within}m"])


def nearby(locations: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Places, stops or neighbourhoods beside their location's name, the nearest first where there is a distance."""
    own = locations.select(F.col("source_id").alias("location_source_id"), F.col("name").alias("location_name"))
    out = own.join(rows.select("location_source_id", *columns), "location_source_id")
    return out.orderBy("location_name", *(["distance_meters"] if "distance_meters" in columns else []))


def to_enrich(locations: DataFrame, log: DataFrame, force: bool = False) -> DataFrame:
    """Locations with coordinates that have no successful run yet, or all of them."""
    usable = locations.where("latitude is not null and longitude is not null")
    return usable if force else missing(usable, log.where("status = 'success'").select("location_source_id").distinct(), ["location_source_id"])


def status(locations: DataFrame, log: DataFrame) -> DataFrame:
    last = latest(log, ["location_source_id"], [F.desc("finished_at"), F.desc("id")])
    label: Column = F.when(F.col("finished_at").isNotNull(), "enriched").otherwise("pending")
    return locations.join(last, "location_source_id", "left").withColumn("enrichment", label)


def chosen(locations: DataFrame, log: DataFrame, force: bool, ids: list[int] | None) -> DataFrame:
    """The work list; given ids must all exist, and are enriched whatever the log says."""
    if ids is None:
        return to_enrich(locations, log, force)
    own = locations.where(F.col("location_source_id").isin(ids))
    known = {r[0] for r in own.select("location_source_id").distinct().collect()}
    if lost := sorted(set(ids) - known):
        raise ValueError(f"no such locations: {lost}")
    return own


def status_counts(states: DataFrame) -> DataFrame:
    """(enriched, pending): how many locations are in each state."""
    return states.agg(F.count_if(F.col("enrichment") == "enriched").alias("enriched"), F.count_if(F.col("enrichment") == "pending").alias("pending"))


def _located(locations: DataFrame) -> DataFrame:
    return locations.select(F.col("source_id").alias("location_source_id"), F.col("name").alias("location_name"), "latitude", "longitude")


def _log(spark: SparkSession, root: str) -> DataFrame:
    log = Table(spark, f"{root}/meta/enrichment_log").read()
    return spark.createDataFrame([], LOG) if log is None else log


def _replies(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored replies of a run, None if it has none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop) else None


def dry_run(spark: SparkSession, locations: DataFrame, root: str, force: bool = False, ids: list[int] | None = None) -> DataFrame:
    """(location_source_id, location_name, calls): what a run would enrich, and the calls that it would make; nothing is called or written."""
    todo = chosen(_located(locations), _log(spark, root), force, ids)
    calls = search_plan(todo, searches(spark)).groupBy("location_source_id").agg(F.count("*").alias("calls"))
    return todo.select("location_source_id", "location_name").join(calls, "location_source_id", "left").fillna(0, ["calls"])


def enrich(spark: SparkSession, locations: DataFrame, call: Callable[[dict], object], root: str, run_id: str, force: bool = False, ids: list[int] | None = None, readers: int = 3, pause: float = 1.0) -> dict[str, int]:
    """Enrich silver locations (source_id, name, latitude, longitude): {enriched, skipped, failed}.

    call gets a row (kind, category, type, radius, max_results, latitude, longitude, ...) and returns
    the service's reply. Replies are stored by run_id before anything is made of them. A run that is
    repeated, after a failure or not, makes only the calls that have no reply yet, writes the rows and
    log entries of all its locations once more, and so mends what was left half done.
    skipped: locations that other runs have enriched.
    """
    log_table = Table(spark, f"{root}/meta/enrichment_log")
    log = _log(spark, root)
    own = _located(locations)
    usable = own.where("latitude is not null and longitude is not null")
    todo = chosen(own, log.where(F.col("id") != run_id), force, ids)
    at, path = F.current_timestamp(), f"{root}/landing/places/{run_id}"
    plan, call_of = search_plan(todo, searches(spark)), ["location_source_id", "kind", "ordinal"]
    stored = _replies(spark, path)
    left = plan if stored is None else missing(plan, stored.where("error is null"), call_of)
    lookup(left, call, readers, pause=pause).withColumn("started_at", at).write.mode("append").parquet(path)
    replies = latest(_replies(spark, path), call_of, [F.col("error").isNotNull().asc(), F.desc("started_at"), F.col("reply")])
    replies = replies.join(todo.select("location_source_id"), "location_source_id", "left_semi")
    errors = replies.where("error is not null").groupBy("location_source_id").agg(F.min("error").alias("error_message"))
    nowhere = missing(todo, search_plan(todo, searches(spark)).select("location_source_id"), ["location_source_id"])
    errors = errors.unionByName(nowhere.select("location_source_id", F.lit("no coordinates").alias("error_message")))
    good = missing(todo.select("location_source_id", "location_name"), errors, ["location_source_id"])
    fine = missing(replies, errors, ["location_source_id"])
    pois, stops = places(fine.where("kind = 'poi'")), transit(fine.where("kind = 'transit'"))
    rows = {"nearby_pois": pois, "transit_stations": stops}
    new = {}
    for name, found in rows.items():
        table = Table(spark, f"{root}/silver/{name}")
        old = table.read()
        new[name] = table.write(found if old is None else replace_by_key(old, found, good, ["location_source_id"]))
    kept = {n: df.join(good.select("location_source_id"), "location_source_id", "left_semi") for n, df in new.items()}
    around = neighbourhoods(good, fine, kept["nearby_pois"], kept["transit_stations"]).withColumn("enriched_at", at)
    table = Table(spark, f"{root}/silver/neighbourhoods")
    old = table.read()
    table.write(around if old is None else upsert(old, around, ["location_source_id"]))
    counts = [df.groupBy("location_source_id").agg(F.count("*").alias(n)) for n, df in (("pois_found", kept["nearby_pois"]), ("transit_found", kept["transit_stations"]))]
    begun = replies.groupBy("location_source_id").agg(F.min("started_at").alias("started_at"))
    entry = todo.select("location_source_id", "location_name").join(errors, "location_source_id", "left").join(begun, "location_source_id", "left")
    for c in counts:
        entry = entry.join(c, "location_source_id", "left")
    ok = F.col("error_message").isNull()
    entry = entry.select(
        "location_source_id", "location_name", F.when(ok, "success").otherwise("failed").alias("status"), *[F.when(ok, F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in ("pois_found", "transit_found")],
        "error_message", F.coalesce("started_at", at).alias("started_at"), at.alias("finished_at"), F.lit(run_id).alias("id"),
    )
    earlier = log.where(F.col("id") != run_id).unionByName(missing(log.where(F.col("id") == run_id), entry, ["location_source_id"]))
    done = log_table.write(earlier.unionByName(entry)).where(F.col("id") == run_id)
    n = {r.status: r["count"] for r in done.groupBy("status").count().collect()}
    return {"enriched": n.get("success", 0), "skipped": usable.count() - done.join(usable, "location_source_id", "left_semi").count(), "failed": n.get("failed", 0)}
