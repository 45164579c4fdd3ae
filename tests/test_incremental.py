"""Incremental tables, the document sink, repeated runs and bounded states on small fixtures."""

import calendar
import datetime as dt
import json
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from silverloom.functions import dates as D
from silverloom.functions import json as J
from silverloom.functions import strings as S
from silverloom.operators import profile
from silverloom.operators.distinct import distinct_counts, distinct_state, merged_state
from silverloom.plans import enrichment, extraction, medallion, reports
from silverloom.sources import files
from silverloom.sources.documents import read_documents, write_documents
from silverloom.sources.hashed import PART, HashedTable
from silverloom.streaming.newest import keep_newest, run_silver_new


def files_of(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_touched_parts_only(spark, tmp_path):
    """An upsert leaves the files of the other parts as they are; a lookup reads one part."""
    table = HashedTable(spark, str(tmp_path / "t"), ["k", "s"], 8)
    assert table.read() is None and table.stored() is None
    rows = [(i, f"s{i % 3}", i) for i in range(200)] + [(None, "x", 1)]
    table.upsert(spark.createDataFrame(rows, "k long, s string, v long"))
    before = files_of(tmp_path / "t")
    new = spark.createDataFrame([(7, "s1", -7), (7, "s2", 70)], "k long, s string, v long")
    touched = table.touched(new)
    assert table.upsert(new) == len(touched) <= 2
    after = files_of(tmp_path / "t")
    same = {p for p in before if p in after and before[p] == after[p]}
    assert {p.parent.name for p in before if p not in same} == {f"{PART}={n}" for n in touched}
    assert {p.parent.name for p in same} | {f"{PART}={n}" for n in touched} == {p.parent.name for p in after}
    want = {(k, s): v for k, s, v in rows} | {(7, "s1"): -7, (7, "s2"): 70}
    assert {(r.k, r.s): r.v for r in table.read().collect()} == want
    assert table.upsert(new.where("false")) == 0
    again = files_of(tmp_path / "t")
    assert table.upsert(new) and {(r.k, r.s): r.v for r in table.read().collect()} == want and again != files_of(tmp_path / "t")
    found = table.lookup(7, "s2")
    assert [r.v for r in found.collect()] == [70] and len(found.inputFiles()) >= 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_part" in plan and "PushedFilters: [IsNotNull(k)" in plan
    assert table.lookup(999, "none").count() == 0


def test_newest_rows_are_kept(spark, tmp_path):
    """A second call reads new files only; a late row doesn't win, a tie goes to the greater id."""
    schema = spark.createDataFrame([], "k long, at long, id long, v string").schema
    table, seen = HashedTable(spark, str(tmp_path / "t"), ["k"], 4), []

    def land(name, *rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/landing/{name}")
        q = keep_newest(spark, f"{tmp_path}/landing", schema, table, ["at", "id"], f"{tmp_path}/cp", each=lambda df: seen.append(df.count()))
        q.awaitTermination()
        return sum(p["numInputRows"] for p in q.recentProgress)

    assert land("1", (1, 10, 1, "a"), (1, 9, 2, "late"), (2, 5, 3, "b"), (None, 1, 1, "no key")) == 3  # the null key is filtered by the scan
    assert land("2", (1, 8, 9, "later"), (3, 1, 4, "c"), (2, 5, 4, "tie")) == 3
    assert {r.k: r.v for r in table.read().collect()} == {1: "a", 2: "tie", 3: "c"}
    assert seen == [2, 3]
    q = keep_newest(spark, f"{tmp_path}/landing", schema, table, ["at", "id"], f"{tmp_path}/cp")
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 0


def test_silver_from_new_bronze(spark, tmp_path):
    """As run_silver over the same bronze; errors are counted once, first_seen_at stays."""
    root = str(tmp_path)

    def run(name, *raws):
        df = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in raws], "raw_json string")
        medallion.run_bronze(spark, "locations", df, root, name)
        return run_silver_new(spark, "locations", root, [9], parts=4)

    assert run("r1", {"Id": 1, "Name": "a", "MondayOpenTime": 60}, {"Id": 2, "Name": "x" * 600}, {"Id": 9, "Name": "excluded"}, "{bad") == {"locations": 1, "errors": 2}
    first = HashedTable(spark, f"{root}/silver_live/locations", ["source_id"], 4).read().collect()
    assert run("r2", {"Id": 3, "Name": "c"}, {"Id": 1, "Name": "b"}) == {"locations": 2, "errors": 0}
    rows = {r.source_id: r for r in HashedTable(spark, f"{root}/silver_live/locations", ["source_id"], 4).read().collect()}
    assert {k: r.name for k, r in rows.items()} == {1: "b", 3: "c"} and rows[1].first_seen_at == first[0].first_seen_at < rows[1].last_synced_at
    assert HashedTable(spark, f"{root}/silver_live/location_hours", ["location_source_id", "day_of_week"], 4).read().count() == 14
    errors = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/meta/sync_errors_live/locations").collect()
    assert sorted(r.error for r in errors) == ["malformed JSON", "name is longer than 512"]
    medallion.run_silver(spark, "locations", root, [9])
    assert {(r.source_id, r.name) for r in medallion.Table(spark, f"{root}/silver/locations").read().collect()} == {(1, "b"), (3, "c")}


def test_documents_are_there_at_once(spark, tmp_path):
    """A job that fails leaves nothing; what is written again is read from its latest run."""
    path = str(tmp_path / "docs")
    assert read_documents(spark, path).count() == 0
    rows = [(f"{i}_Ann Lee+#%_f", json.dumps({"v": i})) for i in range(20)]
    write_documents(spark.createDataFrame(rows, "name string, json string").repartition(4), path)
    assert sorted(map(tuple, read_documents(spark, path).collect())) == sorted(rows)
    bad = spark.createDataFrame([("new", "{}"), ("a/b", "{}")], "name string, json string").repartition(2)
    with pytest.raises(Exception):
        write_documents(bad, path)
    assert sorted(map(tuple, read_documents(spark, path).collect())) == sorted(rows) and not [p for p in Path(path).iterdir() if p.name.startswith(".")]
    write_documents(spark.createDataFrame([(rows[3][0], "again"), ("empty", None)], "name string, json string"), path)
    got = dict(map(tuple, read_documents(spark, path).collect()))
    assert got == {**dict(rows), rows[3][0]: "again", "empty": "null"}
    write_documents(bad.where("false"), path)
    assert len(list(Path(path).iterdir())) == 2 and len(list(Path(path).rglob("*.json"))) == 22


def pages(content):
    return int(content)


def ask(content, page, question):
    if content == b"13":
        raise OSError("unreadable")
    if question == "section":
        return json.dumps({"has_section_5": page == 5 and content == b"12", "renewal_text": "monthly", "termination_notice_table": {"1-11 months": {"0-24": "1 month"}}})
    return json.dumps({"start_date": "2025-01-01", "additional_notes": "n", "has_table": False})


def ask_again(content, page, question):
    assert content == b"11", "only the long document without the section is read again"
    return json.dumps({"has_section_5": page == 3, "renewal_text": "monthly", "start_date": "2025-02-02"})


def test_extraction_goes_on(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(f"/s/{i}_Ann Lee_f{i}.pdf", "pdf", c) for i, c in ((1, b"12"), (2, b"11"), (3, b"4"), (4, b"13"))]
    scans = spark.createDataFrame(rows, "path string, kind string, content binary")
    assert extraction.extract_new(spark, scans.where("path like '/s/1%'"), path, pages, ask) == {"processed": 1, "skipped": 0, "failed": 0}
    assert extraction.extract_new(spark, scans, path, pages, ask) == {"processed": 2, "skipped": 1, "failed": 1}
    assert extraction.extract_new(spark, scans.where("path not like '/s/4%'"), path, pages, ask_again) == {"processed": 0, "skipped": 3, "failed": 0}
    assert extraction.extract_new(spark, scans.where("path not like '/s/4%'"), path, pages, ask_again, again=True) == {"processed": 1, "skipped": 2, "failed": 0}
    docs = {r["name"]: json.loads(r["json"]) for r in read_documents(spark, path).collect()}
    assert {n: (d["contract_type"], d.get("section_5_found_on_page")) for n, d in docs.items()} == {"1_Ann Lee_f1": ("old", 5), "2_Ann Lee_f2": ("old", 3), "3_Ann Lee_f3": ("new", None)}
    read = files.read_agreements(spark, f"{path}/*/*")
    linked = files.scans_with_results(scans, read.where("section_5_found_on_page is not null or contract_type = 'new'"))
    assert {r.path for r in linked.collect()} == {r[0] for r in rows[:3]}


def counted(row):
    Path(COUNT.read_text()).joinpath(f"{row['location_source_id']}-{row['kind']}-{row['ordinal']}-{random.random()}").touch()
    if row["location_source_id"] == 2 and row["category"] == "train" and (Path(COUNT.read_text()) / "broken").exists():
        raise RuntimeError("quota")
    return {"status": "OK", "results": [{"place_id": f"p{row['location_source_id']}", "name": "n", "types": [], "geometry": {"location": {"lat": 1.0, "lng": 1.0}}}]} if row["kind"] != "geocode" else {"status": "ZERO"}


COUNT = Path("/tmp/silverloom-enrichment-count")


def test_enrichment_is_repeatable(spark, tmp_path, monkeypatch):
    """A run that is repeated keeps its log and makes no call twice; one that was stopped between tables is mended."""
    root, calls = str(tmp_path / "r"), tmp_path / "calls"
    calls.mkdir()
    COUNT.write_text(str(calls))
    made = lambda: Counter(p.name.rsplit("-", 1)[0] for p in calls.iterdir() if "-" in p.name)
    locations = spark.createDataFrame([(1, "one", 1.0, 1.0), (2, "two", 1.0, 1.0), (3, "none", None, None)], "source_id long, name string, latitude double, longitude double")
    assert [(r.location_source_id, r.calls) for r in enrichment.dry_run(spark, locations, root).orderBy("location_source_id").collect()] == [(1, 17), (2, 17)]
    (calls / "broken").touch()
    assert enrichment.enrich(spark, locations, counted, root, "r1", pause=0) == {"enriched": 1, "skipped": 0, "failed": 1}
    read = lambda name: medallion.Table(spark, f"{root}/{name}").read()
    log = lambda: {(r.id, r.location_source_id): (r.status, r.pois_found) for r in read("meta/enrichment_log").collect()}
    assert log() == {("r1", 1): ("success", 1), ("r1", 2): ("failed", None)} and set(made().values()) == {1} and len(made()) == 34
    (calls / "broken").unlink()
    assert enrichment.enrich(spark, locations, counted, root, "r1", pause=0) == {"enriched": 2, "skipped": 0, "failed": 0}
    assert log() == {("r1", 1): ("success", 1), ("r1", 2): ("success", 1)}
    assert {k: n for k, n in made().items() if n > 1} == {"2-transit-1": 2}, "only the failed call is made again"
    assert enrichment.enrich(spark, locations, counted, root, "r1", pause=0) == {"enriched": 2, "skipped": 0, "failed": 0} and sum(made().values()) == 35
    places = sorted(map(tuple, read("silver/nearby_pois").select("location_source_id", "place_id").collect()))
    assert enrichment.enrich(spark, locations, counted, root, "r2", pause=0) == {"enriched": 0, "skipped": 2, "failed": 0} and sum(made().values()) == 35

    class Stop(Exception):
        pass

    def stopped(*a):
        raise Stop

    with monkeypatch.context() as m:
        m.setattr(enrichment, "neighbourhoods", stopped)
        with pytest.raises(Stop):
            enrichment.enrich(spark, locations, counted, root, "r3", force=True, pause=0)
    assert not [k for k in log() if k[0] == "r3"]
    assert enrichment.enrich(spark, locations, counted, root, "r3", force=True, pause=0)["enriched"] == 2
    assert sum(made().values()) == 35 + 34 and sorted(k for k in log() if k[0] == "r3") == [("r3", 1), ("r3", 2)]
    assert sorted(map(tuple, read("silver/nearby_pois").select("location_source_id", "place_id").collect())) == places


def test_roll_forward_against_steps(spark):
    def add(d, months):
        y, m = divmod(d.year * 12 + d.month - 1 + months, 12)
        return dt.date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))

    def rolled(e, m, d, until, most):
        while e < until and most:
            e, most = add(e, m) + dt.timedelta(days=d), most - 1
        return e

    rng, rows = random.Random(2), []
    for m, d in ((0, 1), (0, 7), (1, 0), (2, 0), (6, 0), (11, 0), (12, 0), (48, 0), (1, 3), (5, 20), (0, 0), (13, 0)):
        for _ in range(60):
            e = dt.date(rng.randint(1950, 2030), rng.randint(1, 12), 1) + dt.timedelta(days=rng.choice([0, 27, 28, 29, 30]))
            rows.append((e, m, d, dt.date(rng.randint(1990, 2030), rng.randint(1, 12), rng.randint(1, 28)), rng.randint(0, 8)))
    df = spark.createDataFrame(rows, "e date, m int, d int, u date, n int")
    args = [F.col(c) for c in "emdu"]
    for r in df.select("*", D.roll_forward(*args).alias("rolled"), D.notice_end(*args, F.col("n")).alias("notice")).collect():
        assert r.rolled == (rolled(r.e, r.m, r.d, r.u, 10**6) if r.m or r.d else None)
        assert r.notice == rolled(r.e, r.m, r.d, add(r.u, r.n), D.STEPS)


def test_fitting_against_pairs(spark):
    """Rooms and services of one large location and some small ones, against all pairs of a location."""
    kinds = [None, "", "Room", "Ro", "R", "Meeting Room", "Hall", "été", "x"]
    names = [None, "", "Meeting Room,Hall", "Room", "Rooms and halls", "l'été", "R"]
    rooms = [(i, [1, 1, 1, 2, None][i % 5], kinds[i % len(kinds)]) for i in range(120)]
    services = [(i, [1, 1, 3, 2, None][i % 5], names[i % len(names)]) for i in range(90)]
    r = spark.createDataFrame(rooms, "room int, location_source_id int, resource_type_name string")
    s = spark.createDataFrame(services, "service int, location_source_id int, resource_type_names string")
    want = {(i, j) for i, a, k in rooms for j, b, n in services if a is not None and a == b and (n is None or (k is not None and k in n))}
    got = reports.fitting(r, s, "inner").select("r.room", "s.service").collect()
    assert len(got) == len(want) and {tuple(x) for x in got} == want
    left = {tuple(x) for x in reports.fitting(r, s, "left").select("r.room", "s.service").collect()}
    assert left == want | {(i, None) for i, _, _ in rooms if i not in {a for a, _ in want}}


def test_merged_distinct_counts(spark):
    rows = [(i % 3, i % 7, n) for i, n in enumerate([0, 1, 1, None, -5, 32768, 32769, 1 << 40, -(1 << 40), 0] * 50)]
    df = spark.createDataFrame(rows, "g int, day int, n long").repartition(4)
    states = distinct_state(df, ["g", "day"], F.col("n"))
    one, two = states.where("day < 3"), merged_state(states.where("day >= 3"), ["g"])
    got = {r.g: r.n for r in distinct_counts(one.drop("day").unionByName(two), ["g"]).collect()}
    assert got == {g: len({n for a, _, n in rows if a == g and n is not None}) for g in range(3)}


def test_profile_states_are_bounded(spark):
    """What the tasks hand on grows with paths and tasks, not with values; samples are the first distinct values."""
    raw = [json.dumps({"id": i, "name": f"n{i:05d}", "same": "x", "maybe": None if i % 2 else i % 4, "deep": {"list": [{"k": i % 3}]}}) for i in range(3000)]
    df = spark.createDataFrame([(r, i % 2) for i, r in enumerate(raw)], "raw string, g int").repartition(5)
    states = profile.path_states(profile.key_paths(df, "raw", ["g"]), ["g"], 3)
    assert states.count() <= 5 * 2 * 7
    got = {(r.g, r.path): r for r in profile.coverage(df, "raw", ["g"]).collect()}
    assert got[0, "name"].samples == ["n00000", "n00002", "n00004"] and got[1, "same"].samples == ["x"] and got[1, "same"].flag == "constant"
    assert got[1, "maybe"].flag == "mostly null" and got[1, "maybe"].samples == [] and got[0, "maybe"].kinds == ["int"] and got[0, "maybe"].samples == ["0", "2"]
    assert got[0, "deep.list[].k"].n == 1500 and got[0, "deep.list"].samples == ["[list]"] and got[0, "id"].coverage_pct == 100


def test_old_versions_go(spark, tmp_path):
    table = medallion.Table(spark, str(tmp_path / "t"), keep=2)
    for i in range(4):
        old = table.read()
        new = spark.createDataFrame([(i,)], "i int")
        table.write(new if old is None else old.unionByName(new))
    assert table.versions() == [3, 4] and sorted(r.i for r in table.read().collect()) == [0, 1, 2, 3]


def test_truth_and_status(spark):
    df = spark.createDataFrame([('{"a": [], "b": {}, "c": [0], "d": {"x": null}, "e": null, "f": 0, "g": "", "h": "0", "i": false, "j": 0.5}',)], "raw string")
    v = F.try_parse_json("raw")
    got = df.select(*[J.truthy(v, k).alias(k) for k in "abcdefghijk"]).first().asDict()
    assert got == {"a": False, "b": False, "c": True, "d": True, "e": None, "f": False, "g": False, "h": True, "i": False, "j": True, "k": None}
    rows = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (None, None), (1, None)], "a int, c int")
    assert [r[0] for r in rows.select(S.contract_status(F.col("a"), F.col("c"))).collect()] == ["ACTIVE", "CANCELLED", "INACTIVE", "INACTIVE", "ACTIVE"]
    log = spark.createDataFrame([(1, dt.datetime(2025, 1, 1), "a"), (3, None, "b")], "location_source_id int, finished_at timestamp, id string")
    states = enrichment.status(spark.createDataFrame([(1,), (2,), (3,)], "location_source_id int"), log)
    assert tuple(enrichment.status_counts(states).first()) == (1, 2)
