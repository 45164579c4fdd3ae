"""Membership reports: tenure, future contracts, open ends, notice periods, room prices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.functions.dates import complete_months, month_boundaries, notice_end, parse_date, renewal_delta, roll_forward
from silverloom.functions.strings import capacity_bucket, id_list, notice_months, renewal_category, tenure_bucket
from silverloom.operators.tables import latest
from silverloom.sources.files import renewal_text


def valid_contracts(contracts: DataFrame, tariff: str, column: str = "tariff_name") -> DataFrame:
    """Contracts of a tariff that aren't of zero length; a null start with a cancellation is left out."""
    alive = F.col("cancellation_date").isNull() | (F.to_date("start_date") != F.to_date("cancellation_date"))
    return contracts.where(F.lower(column).contains(tariff.lower()) & alive)


def first_and_last(contracts: DataFrame) -> DataFrame:
    """One row a coworker: first start, and start, term and cancellation of the last contract, in one pass."""
    first, last = F.struct("start_date", "source_id"), F.struct("start_date", "source_id", "contract_term", "cancellation_date", "coworker_name")
    out = contracts.groupBy("coworker_id").agg(F.min(first).alias("f"), F.max_by(last, F.struct("start_date", "source_id")).alias("l"))
    return out.select("coworker_id", F.col("l.coworker_name").alias("coworker_name"), F.col("f.start_date").alias("first_start"), *[F.col(f"l.{c}").alias(c) for c in ("source_id", "start_date", "contract_term", "cancellation_date")])


def cancelled_coworkers(contracts: DataFrame, tariff: str) -> DataFrame:
    """Coworkers whose last valid contract is cancelled, with their tenure in month boundaries."""
    ends = first_and_last(valid_contracts(contracts, tariff)).where("cancellation_date is not null")
    return ends.withColumn("tenure_months", month_boundaries(F.col("first_start"), F.col("cancellation_date"))).orderBy(F.desc("tenure_months"), "coworker_id")


def future_contracts(contracts: DataFrame, tariff: str, as_of: Column) -> DataFrame:
    """Latest active or future contract of each coworker with half a year or more to run, and the total tenure."""
    start, term, later = F.col("start_date"), F.col("contract_term"), F.add_months(as_of, 6)
    runs = (start >= as_of) | ((start < as_of) & (F.coalesce(term, as_of) >= as_of))
    far = F.coalesce(term, later) >= later
    now = contracts.where(runs & far & F.col("floor_plan_desk_ids").isNotNull() & F.lower("next_tariff_name").contains(tariff.lower()))
    now = latest(now, ["coworker_id"], [F.desc("start_date"), F.desc("source_id")])
    first = contracts.where(F.lower("tariff_name").contains(tariff.lower())).groupBy("coworker_id").agg(F.min("start_date").alias("first_start"))
    return now.join(first, "coworker_id").withColumn("tenure_months", month_boundaries(F.col("first_start"), F.coalesce(term, as_of)))


def open_ended(contracts: DataFrame, tariff: str) -> DataFrame:
    """Coworkers whose last valid contract has neither term nor cancellation."""
    last = latest(valid_contracts(contracts, tariff), ["coworker_id"], [F.desc("start_date"), F.desc("source_id")])
    return last.where("contract_term is null and cancellation_date is null")


def desk_capacity(contracts: DataFrame, products: DataFrame) -> DataFrame:
    """(source_id, capacity): capacities of the distinct desks in each contract's list; 0 without any."""
    desks = contracts.select("source_id", F.explode(F.array_distinct(id_list(F.col("floor_plan_desk_ids")))).alias("desk")).withColumn("desk", F.col("desk").try_cast("bigint"))
    own = desks.join(products.select(F.col("source_id").alias("desk"), "capacity"), "desk").groupBy("source_id").agg(F.sum(F.coalesce("capacity", F.lit(0))).alias("capacity"))
    return contracts.select("source_id").join(own, "source_id", "left").fillna(0, ["capacity"])


def notice_of(table: Column, months: Column, capacity: Column) -> Column:
    """The cell of a notice table (a map of maps) for a tenure and capacity, 'N/A' if there is none."""
    return F.coalesce(F.try_element_at(F.try_element_at(table, tenure_bucket(months)), capacity_bucket(capacity)), F.lit("N/A"))


def notice_periods(docs: DataFrame, contracts: DataFrame, products: DataFrame, tariff: str, as_of: Column) -> DataFrame:
    """One row for each agreement document: the report's 14 columns, then type, category, and last day to give notice.

    A missing end is inferred from rolling terms (a month, monthly) or from a number of
    months. Dates that are missing or in the wrong order give a label and no notice. All of
    it is expressions over one join; documents keep one row each.
    """
    kinds = renewal_text(F.col("renewal_system"))
    options, raw_end = F.lower(F.coalesce("page_1.additional_commitment_term_options", F.lit(""))), F.lower(F.coalesce("page_1.end_date", F.lit("")))
    d = docs.withColumns({
        "start": parse_date(F.col("page_1.start_date")), "given_end": parse_date(F.col("page_1.end_date")), "raw_category": renewal_category(kinds["category"]), "renewal_display": kinds["display"],
    })
    rolling = (F.col("raw_category") == "monthly") | options.contains("rolling month") | (options == "rolling") | raw_end.contains("rolling")
    months = notice_months(options, anchored=False)
    no_end = F.col("given_end").isNull() & F.col("start").isNotNull()
    d = d.withColumns({
        "category": F.when(no_end & rolling, "monthly").otherwise(F.col("raw_category")),
        "end": F.when(no_end & rolling, F.add_months("start", 1)).when(no_end & (months > 0), F.add_months("start", months)).otherwise(F.col("given_end")),
    })
    last = latest(valid_contracts(contracts, tariff), ["coworker_id"], [F.desc("start_date"), F.desc("source_id")])
    cap = last.join(desk_capacity(last, products), "source_id").select(F.col("coworker_id").cast("string").alias("coworker_id"), "capacity", "location_name", "floor_plan_desk_ids")
    d = d.join(cap, "coworker_id", "left").withColumn("capacity", F.coalesce("capacity", F.lit(0)))
    d = d.withColumn("dates", F.when(F.col("start").isNull() | F.col("end").isNull(), "N/A (missing dates)").when(F.col("end") <= F.col("start"), "DATA ERROR (end <= start)").otherwise("ok"))
    ok = F.col("dates") == "ok"
    m, days = renewal_delta(F.col("start"), F.col("end"), F.col("category"))
    label = notice_of(F.col("termination_notice_table"), complete_months(F.col("start"), as_of), F.col("capacity"))
    d = d.withColumns({"m": F.when(ok, m), "days": F.when(ok, days), "notice_label": F.when(ok, label).otherwise(F.col("dates"))})
    d = d.withColumns({"notice": F.when(ok, notice_months(F.col("notice_label"))), "rolled": F.when(ok, roll_forward(F.col("end"), F.col("m"), F.col("days"), as_of))})
    d = d.withColumn("real_end", F.when(F.col("rolled").isNotNull(), notice_end(F.col("rolled"), F.col("m"), F.col("days"), as_of, F.col("notice"))))
    start, real_end, table = F.col("start"), F.col("real_end"), F.col("termination_notice_table")
    return d.select(
        F.col("file_id").alias("membership_agreement_id"), "coworker_id", "coworker_name", F.coalesce("location_name", F.lit("")).alias("location_name"),
        F.coalesce("floor_plan_desk_ids", F.lit("")).alias("contract_floor_plan_desk_ids"), "capacity", F.col("renewal_display").alias("renewal_system"),
        F.when(F.size(table) > 0, F.to_json(table)).otherwise("").alias("termination_notice_table"), start.alias("start_date"), F.col("end").alias("end_date"), real_end.alias("real_end_date"),
        F.col("notice_label").alias("notice_period"), F.when(start.isNull() | F.col("end").isNull(), 0).otherwise(complete_months(start, as_of)).alias("tenure_months"),
        complete_months(start, real_end).alias("total_tenure_months"),
        "contract_type", "category", F.col("notice").alias("notice_months"), F.add_months("real_end", -F.col("notice")).alias("notice_deadline"),
    )


ROOMS = (4, 5)


#: Characters of a piece by which names are looked for in lists.
GRAM = 3


def named_types(types: DataFrame, lists: DataFrame) -> DataFrame:
    """(location, kind, names): the types beside the lists of their location that hold them as a substring.

    types (location, kind) and lists (location, names) are distinct. A type's first characters are joined
    with all pieces of the lists, and only these pairs are compared, so no task gets a location as a whole.
    """
    first = types.where("kind is not null").withColumn("gram", F.left("kind", F.lit(GRAM)))

    def pieces(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("names") - n + 1)), lambda i: F.substring(F.col("names"), i, F.lit(n)))

    grams = F.array_distinct(F.concat(F.array(F.lit("")), *[pieces(n) for n in range(1, GRAM + 1)]))
    pairs = first.join(lists.where("names is not null").withColumn("gram", F.explode(grams)), ["location", "gram"])
    return pairs.where(F.contains("names", F.col("kind"))).select("location", "kind", "names")


def fitting(rooms: DataFrame, services: DataFrame, how: str) -> DataFrame:
    """Rooms r beside the services s of their location that name the room's type, or no type.

    A null type matches only services for all types. Each type of a location is held against each
    list of names once, whatever the number of rooms and services that have them; rooms are then
    joined by location and type, a key that Spark can split where it is skewed.
    """
    types = rooms.select(F.col("location_source_id").alias("location"), F.col("resource_type_name").alias("kind")).distinct().where("location is not null")
    lists = services.select(F.col("location_source_id").alias("location"), F.col("resource_type_names").alias("names")).distinct()
    pairs = named_types(types, lists).unionByName(types.join(lists.where("names is null"), "location"))
    own = services.withColumns({"location": F.col("location_source_id"), "names": F.col("resource_type_names")})
    same = pairs.withColumnsRenamed({"location": "p_location", "names": "p_names"})
    s = own.join(same, (F.col("location") == F.col("p_location")) & F.col("names").eqNullSafe(F.col("p_names")))
    s, r = s.drop("location", "names", "p_location", "p_names").alias("s"), rooms.alias("r")
    return r.join(s, (F.col("r.location_source_id") == F.col("s.location_source_id")) & F.col("r.resource_type_name").eqNullSafe(F.col("s.kind")), how)


def room_prices(products: DataFrame, services: DataFrame) -> DataFrame:
    """Price tiers of rooms (item types ROOMS), by location, room and default price first."""
    out = fitting(products.where(F.col("item_type").isin(*ROOMS)), services, "inner")
    out = out.select(
        F.col("r.location_source_id").alias("location_source_id"), F.col("r.name").alias("room_name"), F.col("r.resource_type_name").alias("resource_type_name"), F.col("r.capacity").alias("capacity"),
        F.col("s.name").alias("price_tier"), F.col("s.price").alias("price"), F.col("s.currency_code").alias("currency_code"), F.col("s.charge_period").alias("charge_period"),
        F.col("s.only_for_members").alias("only_for_members"), F.col("s.is_default_price").alias("is_default_price"),
    )
    return out.orderBy("location_source_id", "room_name", F.desc("is_default_price"))


def full_picture(locations: DataFrame, products: DataFrame, resources: DataFrame, services: DataFrame) -> DataFrame:
    """Location, room, resource and price tier in one row; rooms without resource or tier stay."""
    own = resources.select(F.col("source_id").alias("resource_id"), F.lit(True).alias("has_resource"))
    rooms = products.where(F.col("item_type").isin(*ROOMS)).join(own, "resource_id", "left")
    rooms = rooms.join(locations.select(F.col("source_id").alias("location_source_id"), F.col("name").alias("location")), "location_source_id")
    return fitting(rooms, services, "left").select(
        "location", F.col("r.name").alias("product_name"), F.col("r.item_type").alias("item_type"), F.col("r.capacity").alias("capacity"), F.when(F.col("has_resource"), F.col("r.resource_id")).alias("resource_id"),
        F.col("s.name").alias("pricing_tier"), F.col("s.price").alias("price"), F.col("s.currency_code").alias("currency_code"),
    )


def same_types(resources: DataFrame, services: DataFrame) -> DataFrame:
    """Services beside the resources whose type is all that the service names."""
    return services.join(resources, services["resource_type_names"] == resources["resource_type_name"])


def contracts_of(contracts: DataFrame, products: DataFrame) -> DataFrame:
    """Active contracts of each product: (product_id, then the contract), by the ids in its desk list, which aren't trimmed.

    The list is exploded once, so that any number of products is one equi-join; an id that a list repeats counts once.
    """
    one = contracts.where("active = 1").withColumn("desk", F.explode(F.array_distinct(F.split("floor_plan_desk_ids", ","))))
    own = products.select(F.col("source_id").alias("product_id"), F.col("source_id").cast("string").alias("desk"))
    return one.join(own, "desk").drop("desk")


def running(contracts: DataFrame, tariff: str, as_of: Column, coworker: int | None = None) -> DataFrame:
    """Uncancelled contracts with desks that run or begin later and have half a year or no end to go; of one coworker or all."""
    start, term, later = F.col("start_date"), F.col("contract_term"), F.add_months(as_of, 6)
    runs = (start >= as_of) | ((start < as_of) & (F.coalesce(term, as_of) >= as_of))
    out = contracts.where(runs & F.col("cancellation_date").isNull() & F.lower("next_tariff_name").contains(tariff.lower()) & (F.coalesce(term, later) >= later) & F.col("floor_plan_desk_ids").isNotNull())
    return out if coworker is None else out.where(F.col("coworker_id") == coworker)


def tenures(contracts: DataFrame, tariff: str) -> DataFrame:
    """First start to last cancellation of each coworker by next tariff, contracts of no length included, longest first."""
    ends = first_and_last(contracts.where(F.lower("next_tariff_name").contains(tariff.lower()))).where("cancellation_date is not null")
    months = month_boundaries(F.col("first_start"), F.col("cancellation_date"))
    return ends.select("coworker_id", "coworker_name", F.col("first_start").alias("first_start_date"), F.col("cancellation_date").alias("last_cancellation_date"), months.alias("tenure_months")).orderBy(F.desc("tenure_months"), "coworker_id")


def average_tenures(contracts: DataFrame, tariff: str) -> DataFrame:
    """Positive tenures beside their truncated average."""
    return with_average(tenures(contracts, tariff).where("tenure_months > 0"), "tenure_months", "avg_tenure_months")


def tiers(services: DataFrame, **flags: int) -> DataFrame:
    """Price tiers with the given flags, as is_default_price=1."""
    return services.where(" and ".join(f"`{k}` = {int(v)}" for k, v in flags.items()) or "true")


def companies(contracts: DataFrame, prefix: str) -> DataFrame:
    """Contracts of companies whose name begins with the prefix, in any case."""
    return contracts.where(F.lower("coworker_company").startswith(prefix.lower()))


def open_hours_without_times(hours: DataFrame, locations: DataFrame) -> DataFrame:
    """Days that are open although a time is missing, with the location's name."""
    bad = hours.where(~F.col("is_closed") & (F.col("open_minutes").isNull() | F.col("close_minutes").isNull()))
    return bad.join(locations.select(F.col("source_id").alias("location_source_id"), F.col("name").alias("location_name")), "location_source_id")


def recent_errors(runs: DataFrame, since: Column) -> DataFrame:
    """Failed runs since a time, the latest first."""
    return runs.where((F.col("status") == "failed") & (F.col("at") > since)).select("at", "entity", "error").orderBy(F.desc("at"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) of all tables."""
    one = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, one)


def with_average(df: DataFrame, value: str, name: str) -> DataFrame:
    """df with the truncated whole-table average: a one-row aggregate read as a scalar subquery, not a window over all rows."""
    return df.withColumn(name, df.agg(F.avg(value).cast("bigint")).scalar())
