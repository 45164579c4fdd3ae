"""WARC archives: read back against plain Python, the index against all captures, awkward rows."""

import base64
import gzip
import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F

from silverloom.llm import queries, warc

SCHEMA = "page_id long, url string, html string, key string, digest string, id int, n long, hit boolean, payload string"
LONG = "long é page " * 300_000
PAGES = [
    (1, "http://A.example.com/x?q=1#f", "<p>one</p>"), (2, "https://b.example.com:8080/", "<p>one</p>"), (3, None, "<p>one</p>"), (4, "http://a.example.com/x?q=1", "two\r\n\r\nWARC/1.1\r\n"),
    (5, "no scheme", None), (6, "http://a.example.com/y", ""), (7, "", "é🙂"), (7, "", "é🙂"), (7, "", "é🙂"), (7, "http://z", "é🙂"), (None, "http://n", "é🙂"), (None, None, "only"), (None, None, "only"),
    (8, "http://user@a.example.com:80/\n \x00", LONG), (9, "http://a.example.com/" + "p" * 100_000, "<p>one</p>"), (-3, "http://a.example.com/x?q=1", "two\r\n\r\nWARC/1.1\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "k", "d", 1, 1, True, "p") for r in PAGES], SCHEMA).repartition(3)


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    df, want = queries.op12_warc(spark, SF), con.sql(queries.oracle_sql()["op12_warc"])
    cols = sorted(df.columns)
    assert sorted(want.columns) == cols
    assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(want.select(*cols).fetchall(), key=repr)


@pytest.mark.parametrize("least", [0, 5, 1000])
def test_awkward_rows(spark, pages, tmp_path, least):
    got = Counter(map(tuple, warc.round_trip(pages, f"file://{tmp_path}/w", least).collect()))
    groups = defaultdict(list)
    for i, u, h in PAGES:
        groups[(h or "").encode()].append((i is None, i, u is not None, u or ""))
    want = Counter()
    for data, rows in groups.items():
        rows.sort(key=lambda r: (r[0], r[1] or 0, r[3], r[2]))
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        for k, r in enumerate(rows):
            visit = k > 0 and len(data) >= least
            want[(r[1], len(data), digest, "revisit" if visit else "response", rows[0][1] if visit else None)] += 1
    assert got == want


def test_empty(spark, pages, tmp_path):
    assert warc.round_trip(pages.where("false"), str(tmp_path / "w")).count() == 0
    warc.delete(str(tmp_path / "none"))


def test_archives_are_whole(spark, pages, tmp_path):
    """Every archive unpacks with gzip alone, record by record, and holds the payloads of responses only."""
    captures = warc.write(pages, str(tmp_path)).collect()
    data = {p.name: p.read_bytes() for p in Path(tmp_path).glob("*.warc.gz")}
    assert sum(map(len, data.values())) == sum(c.length for c in captures) and set(data) == {c.archive for c in captures}
    for c in captures:
        member = data[c.archive][c.offset : c.offset + c.length]
        headers, payload = warc.parsed(member)
        assert gzip.decompress(member).startswith(b"WARC/1.1\r\nWARC-Type: " + c.kind.encode())
        assert headers["WARC-Payload-Digest"] == f"sha1:{c.digest}" and ("\n" not in headers.get("WARC-Target-URI", ""))
        assert (warc.base32_sha1(payload) == c.digest) if c.kind == "response" else payload == b""
        assert ("WARC-Refers-To" in headers) == (c.kind == "revisit")
        with pytest.raises(Exception):
            warc.parsed(member[:-9])


def test_index(spark, tmp_path):
    """Every key finds exactly its captures, over block and part ends; other keys find none."""
    urls = [f"http://s{i % 7}.example.org/{i % 40}" for i in range(3000)] + ["http://hot.example.org/"] * 2000
    rows = spark.createDataFrame([(i, u, f"page {i % 3500}") for i, u in enumerate(urls)], "page_id long, url string, html string").repartition(5)
    captures = warc.write(rows, str(tmp_path / "w"))
    index = warc.build_index(captures, str(tmp_path / "i"), block=64)
    parts = index.parts.collect()
    assert len(parts) > 1 and sum(p.captures for p in parts) == 5000 and all(p.blocks == -(-p.captures // 64) for p in parts)
    every = Counter((c.key, c.id, c.offset) for c in captures.collect())
    asked = warc.with_key(rows)
    assert Counter((c.key, c.id, c.offset) for c in warc.lookup(index, asked).collect()) == every
    some = spark.createDataFrame([("org,example,hot)/",), ("org,example,s3)/3",), ("org,example,s3)/",), ("",), ("zz",), (None,)], "key string")
    found = Counter((c.key, c.id, c.offset) for c in warc.lookup(index, some).collect())
    assert found == Counter({k: n for k, n in every.items() if k[0] in ("org,example,hot)/", "org,example,s3)/3")}) and len(found) > 2000
    texts = {r.id: bytes(r.payload).decode() for r in warc.fetch(captures.where("kind = 'response'"), str(tmp_path / "w")).collect()}
    assert len(texts) == 3500 and all(texts[str(i)] == f"page {i}" for i in range(3500))
    broken = next(Path(tmp_path / "w").glob("*.warc.gz"))
    data = bytearray(broken.read_bytes())
    data[40] ^= 1
    broken.write_bytes(data)
    with pytest.raises(Exception):
        warc.fetch(captures, str(tmp_path / "w")).select(F.sum("payload_bytes")).collect()


def test_keys():
    assert [warc.url_key(u) for u in ("http://WWW.Example.com:80/A?b#c", "https://u:p@x.org:8443", None, "", "x/y", "http://?q")] == ["com,example,www)/A?b", "org,x:8443)", "", "", "x)/y", ")?q"]
