"""Paged sources: calls are counted, filters pushed down, scans resumed, the rate shared; keyed calls keep their keys."""

import http.server
import json
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from silverloom.plans import medallion
from silverloom.sources import lookups, rest

ROWS = [{"Id": i, "ItemType": i % 5 + 1, "FloorPlanBusinessId": i % 3, "Name": f"n{i}"} for i in range(95)]


def counting_client(options):
    """Pages of ROWS, filtered by parameter `type`; each call leaves a file in the folder of option `log`."""

    def get(path, params):
        log = Path(options["log"])
        (log / f"{time.time_ns()}-{params['page']}-{params.get('type', '')}").touch()
        if (log / "broken").exists() and params["page"] >= int((log / "broken").read_text()):
            raise ValueError("down")
        own = [r for r in ROWS if "type" not in params or r["ItemType"] == params["type"]]
        at = (params["page"] - 1) * params["size"]
        more = at + params["size"] < len(own)
        return {"Records": own[at : at + params["size"]], "HasNextPage": more, **({"TotalPages": -(-len(own) // params["size"])} if options.get("stated") else {})}

    return get


def calls(folder):
    return sorted(tuple(p.name.split("-")[1:]) for p in Path(folder).iterdir() if "-" in p.name)


@pytest.fixture
def pushing(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def loaded(spark, log, **more):
    log.mkdir(exist_ok=True)
    spark.dataSource.register(rest.PagedRest)
    options = {"path": "x", "client": "test_sources:counting_client", "log": str(log), "page_size": "10", "keys": json.dumps({"item_type": ["ItemType", "int"], "location_id": ["FloorPlanBusinessId", "bigint"]}), "push": json.dumps({"item_type": "type"}), **more}
    return spark.read.format("paged_rest").options(**options).load()


def ids(df):
    return sorted(json.loads(r.raw_json)["Id"] for r in df.select("raw_json").collect())


def test_filters_become_parameters(spark, tmp_path, pushing):
    """A filter costs the calls that its own pages need."""
    want = [r["Id"] for r in ROWS if r["ItemType"] == 5]
    assert ids(loaded(spark, tmp_path / "a", stated="1").where("item_type = 5 and location_id >= 0")) == want
    assert calls(tmp_path / "a") == [("1", "5"), ("2", "5")]
    assert ids(loaded(spark, tmp_path / "b", stated="1").where("item_type in (1, 5) and location_id = 2")) == [r["Id"] for r in ROWS if r["ItemType"] in (1, 5) and r["FloorPlanBusinessId"] == 2]
    assert calls(tmp_path / "b") == [("1", "1"), ("1", "5"), ("2", "1"), ("2", "5")]
    assert ids(loaded(spark, tmp_path / "c", stated="1").where("location_id = 1")) == [r["Id"] for r in ROWS if r["FloorPlanBusinessId"] == 1]
    assert [p for p, _ in calls(tmp_path / "c")] == sorted(map(str, range(1, 11)))
    # a service that ignores the parameter gives the same rows
    assert ids(loaded(spark, tmp_path / "d", push=json.dumps({"item_type": "unknown"})).where("item_type = 5")) == want


def test_each_page_once(spark, tmp_path, pushing):
    for name, more in (("stated", {"stated": "1"}), ("unstated", {})):
        for readers in ("1", "3", "20"):
            log = tmp_path / f"{name}{readers}"
            assert ids(loaded(spark, log, readers=readers, **more)) == list(range(95))
            pages = [int(p) for p, _ in calls(log)]
            assert len(pages) == len(set(pages)) and set(range(1, 11)) <= set(pages) and (not more or len(pages) == 10) and len(pages) <= 9 + int(readers) + 1
    assert ids(loaded(spark, tmp_path / "none", params=json.dumps({"type": 99}))) == [] and len(calls(tmp_path / "none")) == 1


def test_entity_scan(spark, tmp_path, pushing):
    log = tmp_path / "log"
    log.mkdir()
    found = medallion.scan(spark, "products", F.col("item_type") == 4, client="test_sources:counting_client", log=str(log), push='{"item_type": "type"}', stated="1")
    assert ids(found) == [r["Id"] for r in ROWS if r["ItemType"] == 4] and calls(log) == [("1", "4")]


def test_resumed_scan(spark, tmp_path):
    """A scan that is stopped goes on after its last whole batch; nothing is lost or there twice."""
    log, target, checkpoint = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "cp")
    log.mkdir()
    options = {"path": "x", "client": "test_sources:counting_client", "log": str(log), "page_size": "10", "batch_pages": "3"}
    (log / "broken").write_text("8")
    with pytest.raises(Exception):
        rest.resumable_scan(spark, options, target, checkpoint)
    first = spark.read.parquet(target)
    assert sorted(r.page for r in first.select("page").distinct().collect()) == list(range(1, 7))
    (log / "broken").unlink()
    before = len(calls(log))
    rest.resumable_scan(spark, options, target, checkpoint)
    again = calls(log)[:]
    rows = spark.read.parquet(target)
    assert ids(rows) == list(range(95)) and rows.where("page = 10").count() == 5
    assert len(again) - before <= 4 + 8  # four pages are left; the rest are looks at where the pages end
    rest.resumable_scan(spark, options, target, checkpoint)
    assert ids(spark.read.parquet(target)) == list(range(95))


def test_one_rate_for_all_readers():
    """However many readers, no second has more calls than the rate, but for one more by each at the start."""
    for readers in (1, 3, 10):
        times = []
        for _ in range(readers):
            clock = [0.0]
            pace = rest.Pace(20, readers, lambda c=clock: c[0], lambda s, c=clock: c.__setitem__(0, c[0] + s))
            while clock[0] < 30:
                pace()
                times.append(clock[0])
        times.sort()
        most = max(sum(t <= x < t + 1 for x in times) for t in times)
        assert most <= 20 + readers and len(times) > 30 * 20 * 0.7
    free = rest.Pace(0, 3, sleep=lambda s: pytest.fail("no limit"))
    free()


def timed(row):
    Path(row["log"], f"{time.time_ns()}").touch()
    return {"k": row["k"]}


def test_rate_of_lookups(spark, tmp_path):
    keys = spark.range(24).selectExpr("id k").withColumn("log", F.lit(str(tmp_path)))
    assert lookups.lookup(keys, timed, readers=3, every=10, pause=1.0).where("reply is not null").count() == 24
    at = sorted(int(p.name) / 1e9 for p in tmp_path.iterdir())
    assert at[-1] - at[0] > 1.5 and max(sum(t <= x < t + 1 for x in at) for t in at) <= 13


def echo(row):
    if row["k"] == 2:
        raise RuntimeError("lost")
    return {"k": row["k"], "other": row["other"]}


def fetched(row):
    return str(row["other"]).encode(), "image/png"


def test_keys_beside_nulls(spark):
    """Whole numbers beyond 2^53 and nulls in one column reach the client and come back as they are."""
    big = 9007199254740993
    rows = [(big, None), (1, big), (2, 5), (None, big + 1)]
    df = spark.createDataFrame(rows, "k long, other long").coalesce(1)
    got = lookups.lookup(df, echo, readers=1).collect()
    assert {(r.k, r.other) for r in got} == set(rows)
    assert {(json.loads(r.reply)["k"], json.loads(r.reply)["other"]) for r in got if r.reply} == set(rows) - {(2, 5)}
    assert {bytes(r.content) for r in lookups.downloads(df, fetched, readers=1).collect()} == {str(o).encode() for _, o in rows}
    assert lookups.lookup(df.where("false"), echo).count() == 0


class Service(http.server.BaseHTTPRequestHandler):
    seen: list = []

    def do_POST(self):
        self.seen.append("token")
        self._say({"access_token": f"t{self.seen.count('token')}", "expires_in": 60.5})

    def do_GET(self):
        self.seen.append(self.headers["Authorization"])
        if self.path.startswith("/slow"):
            time.sleep(1.5)
        self._say({"Records": [{"Id": len(self.seen)}], "HasNextPage": False})

    def _say(self, body):
        data = json.dumps(body).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *_):
        pass


def test_http_client():
    """The token is fetched, kept while it holds and renewed; connecting and reading have timeouts of their own."""
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    get = rest.http_client({"base_url": base, "token_url": f"{base}/token", "username": "u", "password": "p", "timeout": "0.6"})
    assert get("/things", {"page": 1})["Records"] and get("things", {})["Records"]
    time.sleep(0.6)  # a minute before its end the token is renewed
    get("things", {})
    assert Service.seen == ["token", "Bearer t1", "Bearer t1", "token", "Bearer t2"]
    with pytest.raises(OSError):
        get("slow", {})
    assert rest.http_client({"base_url": base, "token": "fixed"})("x", {})["Records"] and Service.seen[-1] == "Bearer fixed"
    server.shutdown()
    began = time.time()
    with pytest.raises(OSError):
        rest.http_client({"base_url": "http://10.255.255.1", "token": "x", "connect_timeout": "0.3", "timeout": "60"})("x", {})
    assert time.time() - began < 10
