"""WARC archives of pages with a two-level capture index.

write() turns each page into a gzip member of an archive: a response with its payload, or a
revisit of the response that has the same payload. build_index() sorts the captures by their
URL keys, whose host is reversed so that a site's pages are neighbours, into compressed
blocks; each part of the index ends with a sparse directory, one entry a block, and the
index itself knows only each part's first and last key. lookup() finds the part of a key,
binary-searches the part's directory and then the block; fetch() reads ranges of the
archives, neighbouring records in one read. Archives and index are written by the tasks
themselves, in a folder that all machines share; files that the rows of a finished task
don't name are of failed attempts and belong to nothing.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import attach, materialised, portions, shuffle_partitions

#: Bytes after which a task begins another archive, and captures of an index block.
ROLL, BLOCK = 1 << 30, 2048
#: Captures of an index part at least, and parts at most; the parts' first and last keys, KEPT characters each, are what a lookup broadcasts.
PART, PARTS, KEPT = 1 << 20, 4096, 256
#: A read of an archive goes on over a gap of so many bytes, and ends after so many.
GAP, READ = 1 << 16, 8 << 20
CAPTURE = "key string, id string, kind string, digest string, archive string, offset long, length long"


def arrow_schema(ddl: str) -> pa.Schema:
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, types[k]) for n, k in (f.split() for f in ddl.split(", "))])


def typed_rows(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder (local or shared path, hdfs, s3, gs) and its path there."""
    uri = re.sub(r"^file:/+", "/", re.sub(r"^s3[an]://", "s3://", folder))
    return pafs.FileSystem.from_uri(uri)


def delete(folder: str) -> None:
    """The folder with all archives and index parts goes, if it is there."""
    fs, root = opened(folder)
    if fs.get_file_info(root).type != pafs.FileType.NotFound:
        fs.delete_dir(root)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host lower-cased with its labels reversed, port unless usual, then ')' and path and query as they are.

    Scheme, user and fragment are left out. A null or empty URL has the empty key; a URL without '://' begins with its host.
    """
    if not url:
        return ""
    rest = url.split("://", 1)[-1]
    host, tail = re.match(r"([^/?#]*)([^#]*)", rest, re.S).groups()
    host, _, port = host.rsplit("@", 1)[-1].lower().partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port not in ("", "80", "443") else "") + ")" + tail


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(row_id: str | None, url: str | None, digest: bytes) -> str:
    """The id of the response that a payload's revisits refer to, known without reading it."""
    return str(uuid.UUID(bytes=hashlib.md5(repr((row_id, url)).encode() + digest).digest()))


def record(kind: str, url: str | None, payload: bytes, own_id: str, row_id: str | None, refers_to: tuple | None, date: str, digest: str | None = None) -> bytes:
    """A WARC record of kind response or revisit as one gzip member. A revisit has its payload's digest and length, not the payload.

    White space and control characters of the URL are percent-encoded. X-Row-Id is the row's id, percent-encoded.
    """
    safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{own_id}>"), ("WARC-Date", date), ("WARC-Target-URI", safe), ("X-Row-Id", None if row_id is None else quote(row_id, safe=""))]
    if refers_to:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:uuid:{refers_to[0]}>"), ("X-Refers-To-Row-Id", None if refers_to[1] is None else quote(refers_to[1], safe=""))]
    head += [("WARC-Payload-Digest", f"sha1:{digest or base32_sha1(payload)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v is not None) + "\r\n"
    gzip = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gzip.compress(text.encode() + block + b"\r\n\r\n") + gzip.flush()


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of a gzip member; a revisit's payload is empty. What isn't a whole record is an error."""
    unzip = zlib.decompressobj(31)
    data = unzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    length = int(headers["Content-Length"])
    if not unzip.eof or version != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return headers, rest[:length].partition(b"\r\n\r\n")[2]


class Archives:
    """A task's archives, one after the other, each of its own name."""

    def __init__(self, folder: str) -> None:
        self.fs, self.root = opened(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.out, self.at = None, 0

    def add(self, member: bytes) -> tuple[str, int, int]:
        """(archive, offset, length)"""
        if self.out is None or self.at >= ROLL:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
        self.out.write(member)
        self.at += len(member)
        return self.name, self.at - len(member), len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def _with_originals(rows: DataFrame, least_bytes: int) -> DataFrame:
    """rows (id, url, payload) with digest, revisit, first_id and first_url of the response of the same payload.

    That is the row of the smallest id, then url; rows without id come last. Of rows that agree in
    all of it one is the response. Payloads are grouped by SHA-256; counts are summed in tasks first.
    """
    rows, small = rows.withColumn("digest", F.unhex(F.sha2(F.col("payload").cast("binary"), 256))), None
    if least_bytes > 0:  # small payloads are looked for nowhere, so however many there are, they stay where they are
        large = F.octet_length("payload") >= least_bytes
        rows, small = rows.where(large), rows.where(~large).withColumns({"revisit": F.lit(False), "first_id": F.lit(None).cast(rows.schema["id"].dataType), "first_url": F.lit(None).cast("string")})
    same = rows.groupBy("digest", "id", "url").agg(F.count("*").alias("same"))
    by = F.struct(F.col("id").isNull().alias("none"), "id", F.coalesce("url", F.lit("")).alias("u"), "url", "same")
    groups = same.groupBy("digest").agg(F.min(by).alias("first"), F.sum("same").alias("n")).where("n > 1")
    groups = materialised(groups.select("digest", "n", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url"), F.col("first.same").alias("same")))
    total, tied = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("same"), F.lit(0))).first()
    found = attach(rows, groups.withColumn("hit", F.lit(True)), ["digest"], "n", total)
    is_first = F.col("hit").isNull() | (F.col("id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url")))
    found = found.withColumn("revisit", ~is_first)
    out = ["id", "url", "payload", "digest", "revisit", "first_id", "first_url"]
    whole = lambda df: df.select(*out) if small is None else df.select(*out).unionByName(small.select(*out))
    if tied < 2:
        return whole(found)
    again = ~F.col("revisit") & (F.coalesce("same", F.lit(1)) > 1)
    copies = found.where(again).groupBy("id", "url", "digest", "first_id", "first_url").agg(F.max("payload").alias("payload"), F.count("*").alias("same"))
    spread = copies.withColumn("from", F.explode(F.sequence(F.lit(0), F.col("same") - 1, F.lit(1000)))).repartition(shuffle_partitions(rows))
    spread = spread.withColumn("k", F.explode(F.sequence("from", F.least(F.col("from") + 999, F.col("same") - 1)))).withColumn("revisit", F.col("k") > 0)
    return whole(found.where(~again).select(*out).unionByName(spread.select(*out)))


def write(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Archive every page; returns the captures (key, id, kind, digest, archive, offset, length), id as text.

    The payload is the text in UTF-8; null counts as empty. Of rows with equal payloads of at
    least least_bytes the one of the smallest id is a response and the others revisit it
    (ties by url; rows without id last); smaller payloads are all responses. Rows without URL
    have the empty key. Extra columns are ignored; an empty table gives no captures.
    A payload that very many rows share is joined by broadcast, so no task gets all of them.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = Archives(folder)
        for part in portions(batches):
            made = []
            for r in part.to_pylist():
                payload = r["payload"].encode()
                digest = base32_sha1(payload)
                kind = "revisit" if r["revisit"] else "response"
                to = (record_id(r["first_id"], r["first_url"], r["digest"]), r["first_id"]) if r["revisit"] else None
                own = record_id(r["id"], r["url"], r["digest"]) if not r["revisit"] and len(payload) >= least_bytes else str(uuid.uuid4())
                member = record(kind, r["url"], payload, own, r["id"], to, date, digest)
                made.append((url_key(r["url"]), r["id"], kind, digest, *archives.add(member)))
            yield typed_rows(made, kinds)
        archives.close()

    kinds = arrow_schema(CAPTURE)
    texts = [F.col(c).cast("string").alias(c) for c in ("id", "first_id")]
    found = _with_originals(rows, least_bytes).select(*texts, "url", "payload", "digest", "revisit", "first_url")
    return materialised(found.mapInArrow(run, CAPTURE))


@dataclass(frozen=True)
class Index:
    """A capture index: its folder, and a row (file, first, last, blocks, captures) for each of its parts, PARTS at most."""

    folder: str
    parts: DataFrame


def packed_block(rows: list[list]) -> bytes:
    return zlib.compress("\n".join(json.dumps(r, ensure_ascii=False) for r in rows).encode(), 6)


def build_index(captures: DataFrame, folder: str, block: int = BLOCK) -> Index:
    """Sort captures by key into blocks of so many, with a directory at the end of each part.

    A part ends with its directory (first and last key, offset and length of each block; keys cut to KEPT
    characters) and the directory's length in eight bytes. Equal keys may span blocks and parts. Ranges
    are dealt by key and place, so captures of one key don't fill a task.
    """
    parts = min(PARTS, max(shuffle_partitions(captures), -(-captures.count() // PART)))
    columns = [f.split()[0] for f in CAPTURE.split(", ")]
    ordered = captures.select(*columns).repartitionByRange(parts, "key", "archive", "offset").sortWithinPartitions("key", "archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        name, out, directory, rows, at, n = f"{uuid.uuid4().hex}.idx", None, [], [], 0, 0

        def flush() -> None:
            nonlocal at, n, rows
            data = packed_block(rows)
            out.write(data)
            directory.append([rows[0][0][:KEPT], rows[-1][0][:KEPT], at, len(data)])
            at, n, rows = at + len(data), n + len(rows), []

        for part in portions(batches):
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                rows.append(list(row))
                if len(rows) == block:
                    flush()
        if out is not None:
            if rows:
                flush()
            footer = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(footer + len(footer).to_bytes(8, "little"))
            out.close()
            values = ([name], [directory[0][0]], [directory[-1][1]], [len(directory)], [n])
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["file", "first", "last", "blocks", "captures"])

    return Index(folder, materialised(ordered.mapInArrow(run, "file string, first string, last string, blocks long, captures long")))


class Part:
    """One part of an index: its directory in memory, blocks read as they are needed, the last one kept."""

    def __init__(self, folder: str, file: str) -> None:
        fs, root = opened(folder)
        self.file = fs.open_input_file(f"{root}/{file}")
        size = self.file.size()
        length = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, size - 8 - length)))
        self.last = [d[1] for d in self.directory]
        self.held: tuple[int, list[list], list[str]] | None = None

    def block(self, i: int) -> tuple[int, list[list], list[str]]:
        if self.held is None or self.held[0] != i:
            _, _, at, length = self.directory[i]
            rows = [json.loads(r) for r in zlib.decompress(self.file.read_at(length, at)).decode().split("\n")]
            self.held = (i, rows, [r[0] for r in rows])
        return self.held

    def find(self, key: str) -> Iterator[list[list]]:
        """The captures of a key, block by block: a binary search of the directory, then one in each block that can hold it."""
        short = key[:KEPT]
        i = bisect_left(self.last, short)
        while i < len(self.directory) and self.directory[i][0] <= short:
            _, rows, keys = self.block(i)
            lo = bisect_left(keys, key)
            hi = lo
            while hi < len(keys) and keys[hi] == key:
                hi += 1
            if hi > lo:
                yield rows[lo:hi]
            i += 1


def with_key(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct keys of the URLs of df, null ones included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches):
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in part.column(0).to_pylist()], pa.string())], names=["key"])

    return df.select(url_col).mapInArrow(run, "key string").distinct()


def lookup(index: Index, keys: DataFrame) -> DataFrame:
    """Captures of all keys (column `key`, distinct); keys without captures give no rows.

    A key goes to the parts that can hold it, by their first and last keys, which are broadcast.
    (part, key) is dealt in ranges and read in order, so a task opens few parts and each block once.
    """
    folder, parts = index.folder, sorted((r["first"], r["last"], r["file"]) for r in index.parts.collect())
    shared = keys.sparkSession.sparkContext.broadcast(parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lasts = [p[1] for p in shared.value]
        for b in batches:
            at, to = [], []
            for k in b.column(0).to_pylist():
                short = k[:KEPT]
                i = bisect_left(lasts, short)
                while i < len(lasts) and shared.value[i][0] <= short:
                    at.append(i)
                    to.append(k)
                    i += 1
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(to, pa.string())], names=["part", "key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part, rows = None, None, []
        for b in batches:
            for p, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if p != number:
                    number, part = p, Part(folder, shared.value[p][2])
                for found in part.find(key):
                    rows += found
                    if len(rows) >= BLOCK:
                        yield typed_rows(rows, kinds)
                        rows = []
        yield typed_rows(rows, kinds)

    kinds = arrow_schema(CAPTURE)
    dealt = keys.select("key").where("key is not null").mapInArrow(deal, "part int, key string")
    ordered = dealt.repartitionByRange(shuffle_partitions(keys), "part", "key").sortWithinPartitions("part", "key")
    return ordered.mapInArrow(read, CAPTURE)


RECORD = "id string, kind string, url string, record_id string, refers_to_record string, refers_to string, digest string, payload_bytes long, payload binary"


def fetch(captures: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of captures (archive, offset, length), read back from the archives.

    digest and payload_bytes are the payload's own, a revisit's digest is its header's and its bytes are null.
    A response whose payload hasn't the digest of its header is an error. Captures are dealt and
    read in the archives' order, neighbours in one read of READ bytes or a record at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        name, file = None, None
        for b in batches:
            places = list(zip(*(c.to_pylist() for c in b.columns)))
            i = 0
            while i < len(places):
                j, end = i + 1, places[i][1] + places[i][2]
                while j < len(places) and places[j][0] == places[i][0] and places[j][1] <= end + GAP and places[j][1] + places[j][2] - places[i][1] <= READ:
                    end = max(end, places[j][1] + places[j][2])
                    j += 1
                if places[i][0] != name:
                    name = places[i][0]
                    file = fs.open_input_file(f"{root}/{name}")
                start = places[i][1]
                data = file.read_at(end - start, start)
                found, held = [], 0
                for _, at, length in places[i:j]:
                    found.append(read(data[at - start : at - start + length]))
                    held += len(found[-1][-1] or b"")
                    if held > READ:
                        yield typed_rows(found, kinds)
                        found, held = [], 0
                yield typed_rows(found, kinds)
                i = j

    def read(member: bytes) -> tuple:
        h, body = parsed(member)
        stated, plain = h["WARC-Payload-Digest"].removeprefix("sha1:"), lambda c: h[c].removeprefix("<urn:uuid:").removesuffix(">") if c in h else None
        own = h["WARC-Type"] == "response"
        if own and base32_sha1(body) != stated:
            raise ValueError(f"record {h['WARC-Record-ID']} hasn't the payload of its digest")
        row_id, to = (unquote(h[c]) if c in h else None for c in ("X-Row-Id", "X-Refers-To-Row-Id"))
        return row_id, h["WARC-Type"], h.get("WARC-Target-URI"), plain("WARC-Record-ID"), plain("WARC-Refers-To"), to, stated, len(body) if own else None, body if own and payload else None

    kinds = arrow_schema(RECORD)
    ordered = captures.select("archive", "offset", "length").repartitionByRange(shuffle_partitions(captures), "archive", "offset").sortWithinPartitions("archive", "offset")
    return ordered.mapInArrow(run, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Records whose revisits have payload_bytes and digest of the response that they refer to, found by its record id.

    A response that very many revisits refer to is joined by broadcast.
    """
    records = materialised(records)
    visits = records.where("kind = 'revisit'").drop("digest", "payload_bytes")
    times = visits.groupBy("refers_to_record").agg(F.count("*").alias("n"))
    responses = records.where("kind = 'response'").select(F.col("record_id").alias("refers_to_record"), "digest", "payload_bytes")
    found = attach(visits, responses.join(times, "refers_to_record"), ["refers_to_record"], "n", records.count())
    return records.where("kind = 'response'").unionByName(found.select(*records.columns))


def as_type(c: str, df: DataFrame, id_col: str) -> Column:
    """A row id, text in the archives, in its table's type."""
    return F.col(c).cast(df.schema[id_col].dataType)


def round_trip(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of every page, from archives written, indexed, looked up and read back.

    All URLs are looked up in the index; what it finds is fetched. The rows are checkpointed, so the folder can go.
    """
    captures = write(pages, folder, least_bytes, id_col=id_col, url_col=url_col, payload_col=payload_col)
    index = build_index(captures, f"{folder}/index")
    found = materialised(lookup(index, materialised(with_key(pages, url_col))))
    records = resolved(fetch(found, folder, payload=False).drop("payload"))
    return materialised(records.select(
        as_type("id", pages, id_col).alias(id_col), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), as_type("refers_to", pages, id_col).alias("refers_to")
    ))
