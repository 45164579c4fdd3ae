"""Bronze and silver runs, upserts, sources and streaming on small fixtures."""

import datetime as dt
import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from silverloom.operators import tables as O
from silverloom.plans import enrichment, entities, extraction, medallion, reports
from silverloom.sources import files, lookups, rest
from silverloom.streaming.ingest import ingest_available

PAGES = [[{"Id": 1, "Name": "a"}, {"Id": 2, "Name": " "}], [{"Id": 3}], []]


def fake_client(options):
    return lambda path, params: {"Records": PAGES[params["page"] - 1] if params["page"] <= len(PAGES) else [], "HasNextPage": params["page"] < 2}


def test_paged_source(spark):
    spark.dataSource.register(rest.PagedRest)
    got = spark.read.format("paged_rest").option("path", "x").option("client", "test_medallion:fake_client").option("readers", 2).load()
    assert sorted(json.loads(r.raw_json)["Id"] for r in got.collect()) == [1, 2, 3]


def test_retry():
    calls, waits = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError("lost")
        return {"ok": 1}

    assert rest.with_retry(call, sleep=waits.append) == {"ok": 1} and waits == [4, 4]
    limit = urllib.error.HTTPError("u", 429, "slow", {"Retry-After": "7"}, None)
    waits.clear()
    with pytest.raises(urllib.error.HTTPError):
        rest.with_retry(lambda: (_ for _ in ()).throw(limit), sleep=waits.append)
    assert waits == [7, 4, 7, 4, 7, 8, 7, 16]
    waits.clear()
    with pytest.raises(urllib.error.HTTPError):
        rest.with_retry(lambda: (_ for _ in ()).throw(limit), sleep=waits.append, codes={429}, attempts=3)
    assert waits == [7, 7]
    with pytest.raises(ConnectionError):
        rest.with_retry(lambda: (_ for _ in ()).throw(ConnectionError()), sleep=waits.append, codes={429})
    assert waits == [7, 7]
    with pytest.raises(ValueError):
        rest.with_retry(lambda: (_ for _ in ()).throw(ValueError("no")), sleep=waits.append)


def test_token():
    clock, fetched = [0.0], []

    def fetch():
        fetched.append(clock[0])
        return f"t{len(fetched)}", 100.0

    token = rest.TokenProvider(fetch=fetch, now=lambda: clock[0])
    assert [token(), token()] == ["t1", "t1"]
    clock[0] = 41
    assert token() == "t2" and rest.TokenProvider("s", fetch)() == "s" and len(fetched) == 2
    with pytest.raises(ValueError):
        rest.TokenProvider()()


def files_of(path, params):
    if params["coworker"] == 3:
        raise ValueError("gone")
    return {"Records": [{"Id": params["coworker"] * 10 + params["page"]}], "HasNextPage": params["page"] < params["coworker"]}


def fetched(row):
    if row["id"] == 2:
        raise RuntimeError("lost")
    return b"x" * row["id"], "image/JPEG; q=1" if row["id"] == 3 else "application/octet-stream.x"


def test_keyed_scans_and_downloads(spark):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "coworker int")
    got = lookups.paged_lookup(keys, files_of, "files", "coworker", "coworker").collect()
    assert sorted((r.coworker, json.loads(r.raw_json)["Id"]) for r in got if r.raw_json) == [(1, 11), (2, 21), (2, 22)]
    assert [(r.coworker, r.error) for r in got if r.error] == [(3, "ValueError: gone")]
    got = {r.id: (r.content and bytes(r.content), r.extension, r.error) for r in lookups.downloads(spark.createDataFrame([(1,), (2,), (3,)], "id int"), fetched).collect()}
    assert got == {1: (b"x", ".pdf", None), 2: (None, None, "RuntimeError: lost"), 3: (b"xxx", ".jpg", None)}


def look(row):
    if row["k"] == 2:
        raise RuntimeError("boom")
    return None if row["k"] == 3 else {"k": row["k"]}


def test_lookup(spark):
    ok, bad = lookups.split_errors(lookups.lookup(spark.range(1, 5).withColumnRenamed("id", "k"), look))
    assert sorted(r.k for r in ok.collect()) == [1, 4] and [r.error for r in bad.collect()] == ["RuntimeError: boom"]


def test_bronze_to_silver(spark, tmp_path):
    root = str(tmp_path)
    def raws(*ds):
        return spark.createDataFrame([(json.dumps(d),) for d in ds], "raw_json string")

    room = {"Id": 7, "ItemType": 5, "FloorPlanBusinessId": 1, "Name": "", "ToStringText": "Room", "Price": 12.345, "ResourceId": 9, "ResourceInternet": True, "CustomFields": {"Data": [{"Name": "Size", "Value": "31.5"}]}}
    desk = {"Id": 8, "ItemType": 9, "FloorPlanBusinessId": 2, "Name": " x ", "ResourceId": 4}
    assert medallion.run_bronze(spark, "products", raws(room, desk), root, "r1") == 2
    assert medallion.run_silver(spark, "products", root, excluded=[2]) == {"products": 1, "errors": 0}
    room["Price"] = None
    medallion.run_bronze(spark, "products", raws(room), root, "r2")
    medallion.run_silver(spark, "products", root)
    got = {r.source_id: r for r in medallion.Table(spark, f"{root}/silver/products").read().collect()}
    assert set(got) == {7, 8} and got[7].name == "Room" and got[7].price is None and got[7].has_internet == 1 and got[7].custom_size == 31.5
    assert got[8].item_type_label == "Unknown" and got[8].resource_id is None and got[8].name == " x "
    assert got[7].first_seen_at < got[7].last_synced_at
    runs = medallion.current_runs(spark.read.parquet(f"{root}/meta/sync_runs"))
    assert {r.status for r in runs.collect()} == {"success"} and runs.count() == 4
    with pytest.raises(RuntimeError), medallion.RunTracker(spark, f"{root}/meta/other", "s", "e", "bronze"):
        raise RuntimeError("down")
    assert medallion.current_runs(spark.read.parquet(f"{root}/meta/other")).first().status == "failed"


def test_nothing_is_lost(spark, tmp_path):
    """Bad records reach sync_errors, a repeated run adds nothing, and hours are written beside locations."""
    root = str(tmp_path)
    raws = ["{bad", json.dumps({"Name": "no id"}), json.dumps({"Id": 1, "Name": "x" * 600}), json.dumps({"Id": 2, "Name": "b", "MondayOpenTime": 60, "MondayCloseTime": 120}), json.dumps({"Id": 3, "Name": "c"})]
    df = spark.createDataFrame([(r,) for r in raws], "raw_json string")
    for _ in range(2):
        assert medallion.run_bronze(spark, "locations", df, root, "r1") == 5
        assert medallion.read_bronze(spark, root, "locations").count() == 5
        assert medallion.run_silver(spark, "locations", root, excluded=[3]) == {"locations": 1, "location_hours": 7, "errors": 3}
    errors = medallion.Table(spark, f"{root}/meta/sync_errors/locations").read().collect()
    assert sorted(r.error for r in errors) == ["malformed JSON", "missing Id", "name is longer than 512"] and {r.raw_json for r in errors} >= set(raws[:2])
    hours = {r.day_of_week: r for r in medallion.Table(spark, f"{root}/silver/location_hours").read().collect()}
    assert len(hours) == 7 and (hours[1].open_minutes, hours[1].close_minutes, hours[2].open_minutes) == (60, 120, None)
    medallion.run_bronze(spark, "contracts", spark.createDataFrame([('{"id": 4}', 7)], "raw_json string, product_id long"), root, "r1")
    row = medallion.read_bronze(spark, root, "contracts").first()
    assert (row.source_id, row.product_id, row.location_id) == (4, 7, None)


ENTITY_PAGES = {
    "sys/businesses": [{"Id": 1, "Name": "l"}], "billing/coworkercontracts": [], "billing/extraservices": [{"Id": 5, "BusinessId": 1}],
    "sys/floorplandesks": [{"Id": 10 + i, "ItemType": 5, "FloorPlanBusinessId": 1, "Name": "p", "ResourceId": r} for i, r in enumerate((7, 7, 8, 9, 0, None))],
}


def entity_client(options):
    return lambda path, params: {"Records": ENTITY_PAGES[path] if params["page"] == 1 else [], "HasNextPage": False}


def resource_call(row):
    if row["resource_id"] == 8:
        raise RuntimeError("down")
    return None if row["resource_id"] == 9 else {"Id": row["resource_id"], "BusinessId": 1, "Name": row["path"]}


def test_all_entities(spark, tmp_path):
    got = medallion.run_all(spark, str(tmp_path), "r1", resource_call, client="test_medallion:entity_client")
    assert got == {
        "locations": {"locations": 1, "location_hours": 7, "errors": 0}, "products": {"products": 6, "errors": 0}, "contracts": {"contracts": 0, "errors": 0},
        "resources": {"resources": 1, "errors": 0, "skipped": 1}, "extra_services": {"extra_services": 1, "errors": 0},
    }
    assert medallion.Table(spark, f"{tmp_path}/silver/resources").read().first().name == "spaces/resources/7"


def spot(i, lat):
    return {"place_id": f"p{i}", "name": f"n{i}", "types": ["x"], "geometry": {"location": {"lat": lat, "lng": 1.0}}}


def geo(row):
    """Location 1 has places, location 2's service fails on trains."""
    if row["location_source_id"] == 2 and row["category"] == "train":
        raise RuntimeError("quota")
    if row["kind"] == "geocode":
        return {"status": "OK", "results": [{"address_components": [{"types": ["locality"], "long_name": "Town"}]}]}
    found = {"restaurant": [spot(1, 1.001), spot(2, 1.01)], "cafe": [spot(2, 1.01), spot(3, 1.002)], "metro": [spot(4, 1.001)], "bus": [spot(4, 1.001), spot(5, 1.02)], "landmark": [spot(6, 1.003), spot(7, 1.0)]}
    results = found.get(row["category"], [])
    return {"status": "OK" if results else "ZERO_RESULTS", "results": results}


def test_enrichment_run(spark, tmp_path):
    root = str(tmp_path)
    locations = spark.createDataFrame([(1, "one", 1.0, 1.0), (2, "two", 1.0, 1.0), (3, "three", None, 1.0), (4, "four", 0.0, 1.0)], "source_id long, name string, latitude double, longitude double")
    assert enrichment.api_calls(locations).first().calls == 3 * 17
    assert enrichment.enrich(spark, locations, geo, root, "r1", pause=0) == {"enriched": 1, "skipped": 0, "failed": 2}
    read = lambda name: medallion.Table(spark, f"{root}/{name}").read()
    assert sorted((r.place_id, r.category) for r in read("silver/nearby_pois").collect()) == [("p1", "restaurant"), ("p2", "restaurant"), ("p3", "cafe")]
    assert sorted((r.place_id, r.transit_type, r.transit_lines) for r in read("silver/transit_stations").collect()) == [("p4", "metro", None), ("p5", "bus", None)]
    n = read("silver/neighbourhoods").first()
    assert (n.location_source_id, n.city_name, n.nearest_landmark_name, n.landmark_place_id, n.nearest_main_station_name) == (1, "Town", "n6", "p6", None)
    assert (n.total_restaurants_500m, n.total_cafes_500m, n.total_transit_500m) == (1, 1, 1) and n.landmark_distance_m == 333
    log = {r.location_source_id: r for r in read("meta/enrichment_log").collect()}
    assert {k: r.status for k, r in log.items()} == {1: "success", 2: "failed", 4: "failed"} and (log[1].pois_found, log[1].transit_found) == (3, 2)
    assert log[2].error_message == "RuntimeError: quota" and log[4].error_message == "no coordinates"
    assert enrichment.enrich(spark, locations, geo, root, "r2", pause=0) == {"enriched": 0, "skipped": 1, "failed": 2}
    assert enrichment.enrich(spark, locations, lambda row: {"status": "ZERO_RESULTS", "results": []}, root, "r3", ids=[1], pause=0)["enriched"] == 1
    assert read("silver/nearby_pois").count() == read("silver/transit_stations").count() == 0 and read("silver/neighbourhoods").first().city_name is None
    state = {r.location_source_id: r.enrichment for r in enrichment.status(locations.withColumnRenamed("source_id", "location_source_id"), read("meta/enrichment_log")).collect()}
    assert state == {1: "enriched", 2: "enriched", 3: "pending", 4: "enriched"}
    with pytest.raises(ValueError):
        enrichment.enrich(spark, locations, geo, root, "r4", ids=[9])


def answer(content, page, question):
    if content == b"broken":
        raise OSError("unreadable")
    if question == "section":
        return json.dumps({"has_section_5": page in (5, 8), "renewal_text": "month-to-month", "termination_notice_table": {"1-11 months": {"0-24": "1 month"}}})
    if question == "continuation":
        return json.dumps({"has_table": page == 6, "termination_notice_table": {"1-11 months": {"0-24": "9 months", "75+": "4 months"}}})
    return "```json\n" + json.dumps({"start_date": "2025-01-01", "additional_notes": "none"}) + "\n```"


def test_extraction(spark):
    rows = [("/d/1_Ann_f1.pdf", "pdf", b"long"), ("/d/2_Bob_f2.pdf", "pdf", b"new"), ("/d/3_Cy_f3.png", "png", b"pic"), ("/d/4_Di_f4.pdf", "pdf", b"broken"), ("/d/5_Ed_f5.pdf", "pdf", b"none")]
    scans = spark.createDataFrame(rows, "path string, kind string, content binary")
    replies = extraction.page_replies(scans, lambda c: {b"long": 12, b"none": 4}.get(c, 9) if c != b"broken" else 12, answer)
    asked = {(r.path[3], r.page, r.question) for r in replies.collect() if not r.error}
    assert {a for a in asked if a[0] == "1"} == {("1", 1, "terms"), ("1", 2, "notes"), ("1", 3, "section"), ("1", 4, "section"), ("1", 5, "section"), ("1", 6, "continuation")}
    assert {a for a in asked if a[0] == "3"} == {("3", 1, "terms")} and ("2", 3, "section") not in asked
    assert [r.error for r in replies.where("error is not null").collect()] == ["OSError: unreadable"]
    docs = extraction.agreements(replies)
    got = {r.coworker_id: r for r in docs.collect()}
    assert set(got) == {"1", "2", "3", "5"} and (got["1"].contract_type, got["1"].section_5_found_on_page, got["1"].page_1.start_date) == ("old", 5, "2025-01-01")
    assert got["1"].termination_notice_table == {"1-11 months": {"0-24": "1 month", "75+": "4 months"}} and got["2"].termination_notice_table == extraction.NEW_TABLE
    flat = {r.coworker_id: r for r in files.flat_agreements(docs).collect()}
    assert len(flat["1"]) == 14 and (flat["1"].renewal_system, flat["1"].renewal_system_raw_text) == ("monthly", "month-to-month") and (flat["2"].renewal_system, flat["2"].renewal_system_raw_text) == (extraction.NEW_RENEWAL, "")
    assert flat["3"].additional_notes == "" and flat["2"].additional_notes == "none"
    left = extraction.not_yet_read(scans, docs.where("coworker_id <> '3'"))
    assert {r.path[3] for r in left.collect()} == {"3", "4"}
    linked = files.scans_with_results(scans, docs.withColumn("file_name", F.regexp_replace(F.regexp_extract("pdf_path", "[^/]+$", 0), "(pdf|png)$", "json")))
    assert {(r.path[3], r.coworker_id) for r in linked.collect()} == {(k, k) for k in "1235"}


def test_entities(spark):
    def bronze(*ds):
        return spark.createDataFrame([(i, "r", d if isinstance(d, str) else json.dumps(d), 1) for i, d in enumerate(ds)], "id long, sync_run_id string, raw_json string, source_id long")

    hours = {r.day_of_week: r for r in entities.location_hours(bronze({"Id": 1, "MondayOpenTime": 0, "MondayCloseTime": 0, "TuesdayOpenTime": 0, "TuesdayCloseTime": 1020, "SundayClosed": True})).collect()}
    assert len(hours) == 7 and hours[1].open_minutes is None and hours[2].open_minutes == 0 and hours[7].is_closed
    loc = entities.locations(bronze({"Id": 5, "Name": "  ", "AboutUs": "<p>x</p>"}, {"Id": 6}, {"Name": "no id"}, "{bad"), excluded=[6]).collect()
    assert [(r.source_id, r.name, r.description) for r in loc] == [(5, "Unknown", "x")]
    assert sorted(r.error for r in entities.rejects(bronze({"Name": "x"}, "{bad"), ["Id"]).collect()) == ["malformed JSON", "missing Id"]
    res = {r.source_id: r for r in entities.resources(bronze({"Id": 1, "Visible": None}, {"Id": 2}, {"Id": 0})).collect()}
    assert set(res) == {1, 2} and res[1].visible is None and res[2].visible is False
    ctr = entities.contracts(bronze({"id": 0, "Id": 4, "StartDate": "2025-01-31T00:00:00Z", "Active": "false"})).first()
    assert (ctr.source_id, ctr.active, ctr.cancelled, ctr.start_date) == (4, 1, 0, dt.datetime(2025, 1, 31))
    svc = entities.extra_services(bronze({"Id": 1, "BusinessId": 2})).first()
    assert svc.name == "" and svc.price == 0 and svc.only_for_members == 0


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, seen int")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    once = O.upsert(old, new, ["k"], first_seen="seen", now=F.lit(9))
    want = [(1, "a", 1), (2, None, 1), (3, "c", 9)]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, O.upsert(once, new, ["k"], first_seen="seen", now=F.lit(10)).collect())) == want


def test_places(spark):
    def place(i, lat=0.001):
        return {"place_id": f"p{i}", "name": f"n{i}", "types": ["cafe", "food"], "geometry": {"location": {"lat": lat, "lng": 0.0}}}

    rows = [(1, 0.0, 0.0, 0, "restaurant", 500, 2, json.dumps({"status": "OK", "results": [place(1), place(2), place(3)]})), (1, 0.0, 0.0, 1, "cafe", 500, 5, json.dumps({"status": "OK", "results": [place(2), place(3)]})), (2, 0.0, 0.0, 0, "restaurant", 500, 2, json.dumps({"status": "ZERO", "results": []}))]
    got = enrichment.places(spark.createDataFrame(rows, "location_source_id int, latitude double, longitude double, ordinal int, category string, radius int, max_results int, reply string"))
    assert sorted((r.place_id, r.category, r.walking_minutes, r.primary_type) for r in got.collect()) == [("p1", "restaurant", 1, "cafe"), ("p2", "restaurant", 1, "cafe"), ("p3", "cafe", 1, "cafe")]


def test_notice_report(spark, tmp_path):
    def doc(i, start, end, renewal, options=""):
        d = {"coworker_id": str(i), "coworker_name": "n", "file_id": "f", "contract_type": "new", "total_pages": 3, "page_1": {"start_date": start, "end_date": end, "additional_commitment_term_options": options}, "renewal_system": renewal, "termination_notice_table": {"12-23 months": {"0-24": "3 months"}}}
        (tmp_path / f"{i}.json").write_text(json.dumps(d))

    doc(1, "31/01/2024", "2024-12-31", "month-to-month")
    doc(2, "2024-06-01", "TBD", {"category": "same_period", "raw_text": "x"}, "6 months")
    doc(3, "2024-06-01", "2024-05-01", "monthly")
    doc(4, "TBD", None, None)
    doc(5, "2024-06-01", "2025-06-01", {"raw_text": "by agreement"})
    (tmp_path / "summary.json").write_text("{}")
    contracts = spark.createDataFrame([(9, 1, dt.datetime(2024, 1, 1), None, None, "Private Office A", "1,2,2")], "source_id long, coworker_id long, start_date timestamp, contract_term timestamp, cancellation_date timestamp, tariff_name string, floor_plan_desk_ids string").withColumn("location_name", F.lit("Town")).withColumn("coworker_name", F.lit("n"))
    products = spark.createDataFrame([(1, 4), (2, 5)], "source_id long, capacity int")
    out = reports.notice_periods(files.read_agreements(spark, str(tmp_path)), contracts, products, "private office", F.lit(dt.date(2025, 5, 15)))
    got = {r.coworker_id: r for r in out.collect()}
    assert set(got) == set("12345")
    assert got["1"].capacity == 9 and got["1"].notice_period == "3 months" and got["1"].real_end_date == dt.date(2025, 8, 28)
    assert (got["1"].location_name, got["1"].contract_floor_plan_desk_ids, got["1"].membership_agreement_id, got["1"].renewal_system) == ("Town", "1,2,2", "f", "month-to-month")
    assert (got["1"].tenure_months, got["1"].total_tenure_months) == (15, 18) and got["1"].notice_deadline == dt.date(2025, 5, 28)
    assert got["2"].end_date == dt.date(2024, 12, 1) and got["2"].real_end_date == dt.date(2025, 6, 1) and got["2"].renewal_system == "same_period | x" and got["2"].location_name == ""
    assert got["3"].notice_period.startswith("DATA ERROR") and got["3"].tenure_months == 11 and got["3"].total_tenure_months is None
    assert got["4"].notice_period == "N/A (missing dates)" and got["4"].tenure_months == 0 and got["4"].category == "unknown"
    assert got["5"].category == "unknown" and got["5"].renewal_system == " | by agreement"


def test_page_counts(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"xxxx")
    (tmp_path / "b.pdf").write_bytes(b"yy")
    (tmp_path / "c.png").write_bytes(b"p")
    got = files.page_report(files.page_counts(files.read_scans(spark, str(tmp_path)), lambda c: 4 // (len(c) - 2) + 2))
    assert [(r.path[-5:], r.pages, r.review) for r in got.collect()] == [("c.png", 1, "manual review"), ("a.pdf", 4, "ok"), ("b.pdf", None, "manual review")]


def test_report_files(spark, tmp_path):
    two = spark.createDataFrame([(1, "a"), (2, None)], "coworker_id int, name string")
    files.write_reports({"one": two, "two": two.limit(0)}, str(tmp_path / "book"))
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "book/one"), header=True).collect()] == [("1", "a"), ("2", None)]
    files.write_coworkers_without_files(two, spark.createDataFrame([(1,), (1,)], "coworker_id int"), str(tmp_path / "none"))
    assert [r.coworker_id for r in spark.read.json(str(tmp_path / "none")).collect()] == [2]
    assert files.encoded(spark.createDataFrame([(b"hi",)], "content binary")).first().content_base64 == "aGk="
    made = spark.createDataFrame([(1, "/Date(1000)/", 5), (1, "2025-01-01", 6), (2, "soon", 7), (2, "soon", 8)], "coworker_id int, created_on string, id int")
    assert sorted((r.coworker_id, r.id) for r in files.latest_files(made).collect()) == [(1, 6), (2, 7)]


def test_streaming_ingest(spark, tmp_path):
    landing, table, bad = str(tmp_path / "landing"), medallion.Table(spark, str(tmp_path / "table")), medallion.Table(spark, str(tmp_path / "bad"))

    def land(run, day, *raws):
        records = spark.createDataFrame([(r if isinstance(r, str) else json.dumps({"Id": r, "run": run}),) for r in raws], "raw_json string")
        files.write_snapshot(records, landing, "api", "things", run, F.lit(f"2025-01-0{day}").cast("timestamp"))
        ingest_available(spark, landing, table, lambda df: df.select("source_id", "run_id", "snapshot_at_utc"), str(tmp_path / "cp"), ["source_id"], bad).awaitTermination()

    land("1", 1, 1, 2)
    land("3", 3, 2, 3, '{"x": 1}', "{bad")
    land("2", 2, 1, 3, '{"x": 1}')
    assert sorted((r.source_id, r.run_id) for r in table.read().collect()) == [(1, "2"), (2, "3"), (3, "3")]
    assert sorted((r.raw_json, r.run_id) for r in bad.read().collect()) == [('{"x": 1}', "2"), ('{"x": 1}', "3"), ("{bad", "3")]
