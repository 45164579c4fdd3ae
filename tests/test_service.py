"""The stand-in service pages large tables in proportion to their rows, and gives what SQL gives."""

import json
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF

from silverloom.plans import catalogue, runs
from silverloom.sources import rest

FIELDS = {"Id": "c_custkey", "Name": "c_name", "NationId": "c_nationkey"}


def customers(folder, n, nations=25, nulls=0, **how):
    """A table of n customers; every `nulls`-th has no nation."""
    own = [None if nulls and i % nulls == 0 else i % nations for i in range(n)]
    pq.write_table(pa.table({"c_custkey": pa.array(range(n), pa.int64()), "c_name": [f"c{i}" for i in range(n)], "c_nationkey": pa.array(own, pa.int32())}), folder / "customer.parquet", **how)
    return str(folder)


def service(folder, size):
    """Options of a service over the folder's customers."""
    return {"client": "silverloom.plans.runs:table_client", "table": f"{folder}/customer.parquet", "fields": json.dumps(FIELDS), "page_size": str(size)}


def within(seconds, records):
    """The records, or a failure as soon as it takes longer."""
    began, out = time.monotonic(), []
    for r in records:
        out.append(r)
        assert time.monotonic() - began < seconds
    return out


def test_pages_of_a_key(tmp_path):
    """All pages of one key among 300,000 rows, in their order over row groups."""
    get = runs.table_client(service(customers(tmp_path, 300_000, nations=3, row_group_size=70_000), 25))
    found = within(15, rest.paginate(get, "customers", {"NationId": 2}, 25))
    assert [r["Id"] for r in found] == list(range(2, 300_000, 3)) and found[0] == {"Id": 2, "Name": "c2", "NationId": 2}


def test_keys_are_those_of_sql(spark, tmp_path):
    """Keys that are null find nothing, as in a join; keys that stand twice are found twice; the table is a folder."""
    (tmp_path / "customer.parquet").mkdir()
    for i in range(2):
        (tmp_path / f"{i}").mkdir()
        customers(tmp_path / f"{i}", 230 + i, nulls=7, row_group_size=50)
        (tmp_path / f"{i}" / "customer.parquet").rename(tmp_path / "customer.parquet" / f"part-{i}.parquet")
    pq.write_table(pa.table({"n_nationkey": pa.array([0, 1, 1, None, 24, 77], pa.int32())}), tmp_path / "nation.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS FROM '{tmp_path}/customer.parquet/*.parquet'; CREATE VIEW nation AS FROM '{tmp_path}/nation.parquet'")
    want = con.sql(catalogue.SQL["paged_keys"]).fetchall()
    assert Counter(map(tuple, runs.paged_keys(spark, str(tmp_path)).collect())) == Counter(want)


def test_scan_by_readers(tmp_path):
    """A scan of 300,000 rows without a filter in the calls: each record once, whatever the readers."""
    reader = rest.PagedReader({"path": "customers", "keys": '{"source_id": ["Id", "bigint"]}', **service(customers(tmp_path, 300_000, row_group_size=70_000), 100)})
    found = within(30, (row for p in reader.partitions() for row in reader.read(p)))
    assert sorted(r[1] for r in found) == list(range(300_000))


def numbered(options):
    """500 pages of one record each; while the file `broken` in the folder of option `log` is there, its page fails."""

    def get(path, params):
        if (broken := Path(options["log"], "broken")).exists() and params["page"] == int(broken.read_text()):
            raise ValueError("down")
        return {"Records": [{"Id": params["page"]}] if params["page"] <= 500 else [], "HasNextPage": params["page"] < 500}

    return get


def dealt(options, monkeypatch, seconds):
    """Pages of each batch of a stream whose batches take so long."""
    clock, reader, at, out = [0.0], rest.PageStreamReader(options), {"page": 0}, []
    monkeypatch.setattr(rest.time, "monotonic", lambda: clock[0])
    while True:
        pages, end = reader.read(at)
        if end == at:
            assert not list(pages) and reader.read(at)[1] == at
            return out
        out.append([p for (p,) in pages])
        at, clock[0] = end, clock[0] + seconds(len(out[-1]))


def test_quick_batches_grow(tmp_path, monkeypatch):
    """Batches of which each costs little are few; slow ones keep batch_pages; all pages are dealt once, in order, even before one that is looked at and fails."""
    options = {"path": "x", "client": "test_service:numbered", "log": str(tmp_path), "batch_pages": "3"}
    quick = dealt(options, monkeypatch, lambda n: 0.3)
    assert sum(quick, []) == list(range(1, 501)) and len(quick) <= 9 and len(quick[0]) == 3
    assert [len(b) for b in dealt(options, monkeypatch, lambda n: 10.0)] == [3] * 166 + [2]
    even = dealt(options, monkeypatch, lambda n: 0.3 + n / 10)
    assert sum(even, []) == list(range(1, 501)) and max(map(len, even)) * 0.1 <= 2 * rest.QUICK + 1
    (tmp_path / "broken").write_text("45")  # the end of a batch of 24 pages after 3, 6 and 12
    reader, at, steps = rest.PageStreamReader(options), {"page": 0}, []
    monkeypatch.setattr(rest.time, "monotonic", lambda: 0.0)
    while at["page"] < 42:
        at = reader.read(at)[1]
        steps.append(at["page"])
    assert steps[:4] == [3, 9, 21, 24] and steps[-1] == 42 and 45 not in steps


def test_failure_in_a_large_batch(spark, tmp_path):
    """Pages before one that fails are landed up to a step of batch_pages, whatever the batch; then the scan goes on, and each page is there once."""
    options = {"path": "x", "client": "test_service:numbered", "log": str(tmp_path), "batch_pages": "3"}
    (tmp_path / "broken").write_text("200")
    target, scan = str(tmp_path / "out"), lambda: rest.resumable_scan(spark, options, str(tmp_path / "out"), str(tmp_path / "cp"))
    ids = lambda: sorted(json.loads(r.raw_json)["Id"] for r in spark.read.parquet(target).collect())
    for _ in range(2):  # it fails at the same page again, and nothing is there twice
        with pytest.raises(Exception, match="down"):
            scan()
        assert ids() == list(range(1, 199))
    (tmp_path / "broken").unlink()
    scan()
    assert ids() == list(range(1, 501)) and len(list((tmp_path / "out").glob("batch=*"))) < 60


def test_tables_that_only_spark_reads(spark):
    """The queries give what SQL gives where Spark's readers alone can open the path."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.service.link./in", f"file://{SF}")
    con = duckdb.connect()
    for t in ("customer", "orders", "nation"):
        con.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    for name in ("paged_keys", "rest_scan_resumed", "rest_scan_filtered"):
        got = catalogue.queries()[name](spark, "viewfs://service/in")
        want = con.sql(catalogue.SQL[name]).select(*got.columns)
        assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())
