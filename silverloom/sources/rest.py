"""Paged REST sources: Python data sources that land each record as one JSON string.

spark.read.format("paged_rest").option("client", "module:factory").option("path", "products")
The client is injectable: factory(options) returns a function (path, params) -> dict with
"Records" and "HasNextPage", so tests need no network. Filters on key columns become
parameters of the calls, readers share one rate, and a scan can be a stream of pages that
goes on where it was stopped.
"""

from __future__ import annotations

import functools
import http.client
import importlib
import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, SimpleDataSourceStreamReader

RETRIED = {429, 500, 502, 503, 504}


def retriable(e: Exception, codes: set[int] = RETRIED) -> bool:
    """Errors of the given codes are tried again, and lost connections and timeouts unless only overload (429) is."""
    if isinstance(e, urllib.error.HTTPError):
        return e.code in codes
    return codes != {429} and isinstance(e, (ConnectionError, TimeoutError, urllib.error.URLError))


def with_retry(call: Callable[[], dict], attempts: int = 5, factor: float = 2, least: float = 4, most: float = 60, wait: float = 15, sleep: Callable[[float], None] = time.sleep, codes: set[int] = RETRIED) -> dict:
    """call() with exponential back-off, factor x 2^k seconds between least and most; a 429 first waits for its Retry-After.

    With codes={429} nothing else is tried again, and the stated wait is all there is.
    """
    for k in range(attempts):
        try:
            return call()
        except Exception as e:
            if not retriable(e, codes) or k == attempts - 1:
                raise
            if isinstance(e, urllib.error.HTTPError) and e.code == 429:
                sleep(float((e.headers or {}).get("Retry-After", wait)))
            if codes != {429}:
                sleep(min(most, max(least, factor * 2**k)))
    raise AssertionError("not reached")


class Pace:
    """At most `per_second` calls a second over all of `readers` tasks, however they overlap.

    Each reader waits readers / per_second seconds from call to call, up to a fifth more so that
    they don't call in step. per_second 0: no limit.
    """

    def __init__(self, per_second: float, readers: int, now: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, jitter: float = 0.2) -> None:
        self.gap, self.now, self.sleep, self.jitter, self.next = readers / per_second if per_second else 0.0, now, sleep, jitter, None

    def __call__(self) -> None:
        if not self.gap:
            return
        at = self.now()
        if self.next is None:  # readers begin at times of their own
            self.next = at + self.gap * random.random()
        if self.next > at:
            self.sleep(self.next - at)
        self.next = max(at, self.next) + self.gap * (1 + self.jitter * random.random())


class TokenProvider:
    """A bearer token: a static one, or one that fetch() -> (token, seconds) gives, kept until a minute before it ends."""

    def __init__(self, static: str | None = None, fetch: Callable[[], tuple[str, float]] | None = None, now: Callable[[], float] = time.time, spare: float = 60) -> None:
        self.static, self.fetch, self.now, self.spare, self.token, self.ends = static, fetch, now, spare, None, 0.0

    def __call__(self) -> str:
        if self.static:
            return self.static
        if self.token is None or self.now() >= self.ends - self.spare:
            if self.fetch is None:
                raise ValueError("neither a token nor a way to fetch one is given")
            began = self.now()
            self.token, seconds = self.fetch()
            self.ends = began + seconds
        return self.token


def password_grant(url: str, username: str, password: str, timeout: float = 30) -> Callable[[], tuple[str, float]]:
    """fetch() for TokenProvider by the password grant; a reply without a lifetime counts as 20159 seconds."""

    def fetch() -> tuple[str, float]:
        body = urllib.parse.urlencode({"grant_type": "password", "username": username, "password": password}).encode()
        with urllib.request.urlopen(urllib.request.Request(url, body), timeout=timeout) as reply:
            data = json.load(reply)
        return data["access_token"], float(data.get("expires_in", 20159))

    return fetch


@functools.lru_cache(maxsize=32)
def token_provider(token: str | None, url: str | None, username: str | None, password: str | None) -> TokenProvider:
    """One provider for a worker's tasks, so a fetched token is shared until it ends."""
    return TokenProvider(token, password_grant(url, username, password) if url else None)


def opener(connect: float, read: float) -> urllib.request.OpenerDirector:
    """An opener with a timeout for connecting and another one for each read."""

    def patient(kind: type) -> type:
        class Connection(kind):
            def connect(self) -> None:
                self.timeout = connect
                super().connect()
                self.sock.settimeout(read)

        return Connection

    class Plain(urllib.request.HTTPHandler):
        def http_open(self, request):
            return self.do_open(patient(http.client.HTTPConnection), request)

    class Secure(urllib.request.HTTPSHandler):
        def https_open(self, request):
            return self.do_open(patient(http.client.HTTPSConnection), request)

    return urllib.request.build_opener(Plain, Secure)


def http_client(options: dict) -> Callable[[str, dict], dict]:
    """Client over HTTP. Options: base_url, token, or token_url, username and password for one that is renewed while
    the scan goes on; connect_timeout (10 seconds), timeout (60)."""
    token = token_provider(*(options.get(k) or None for k in ("token", "token_url", "username", "password")))
    calls = opener(float(options.get("connect_timeout", 10)), float(options.get("timeout", 60)))

    def get(path: str, params: dict) -> dict:
        query = urllib.parse.urlencode(params)
        request = urllib.request.Request(f"{options['base_url']}/{path.lstrip('/')}?{query}", headers={"Authorization": f"Bearer {token()}"})
        with calls.open(request) as reply:
            return json.load(reply)

    return get


def client_of(options: dict) -> Callable[[str, dict], dict]:
    module, _, name = options.get("client", "silverloom.sources.rest:http_client").partition(":")
    return getattr(importlib.import_module(module), name)(dict(options))


def page_records(body: dict | list) -> tuple[list, bool]:
    """(records, whether there are more pages) of a reply; a bare list is a whole result."""
    if isinstance(body, list):
        return body, False
    records = body.get("Records") or []
    return records, bool(records and body.get("HasNextPage"))


def paginate(get: Callable[[str, dict], dict], path: str, params: dict, size: int, first: int = 1, step: int = 1, last: int | None = None, pace: Callable[[], None] = lambda: None, **retry) -> Iterator[dict]:
    """Records of pages first, first+step, ... until a page is empty or the last, or `last` is passed."""
    page = first
    while last is None or page <= last:
        pace()
        records, more = page_records(with_retry(lambda p=page: get(path, {**params, "page": p, "size": size}), **retry))
        yield from records
        if not more:
            return
        page += step


def _params(options: dict) -> dict:
    """Parameters of every call: option params, a JSON object, and options param.<name>, whose names Spark lower-cases."""
    return {k.removeprefix("param."): v for k, v in options.items() if k.startswith("param.")} | json.loads(options.get("params", "{}"))


class PagedRest(DataSource):
    """Options: path, client, page_size (100), readers (3), per_second (0: no limit), params (JSON) or param.<name>, total (TotalPages).

    keys, a JSON object {column: [field, type]}, adds columns of the records' fields; push, a JSON
    object {column: parameter}, names the call parameter that stands for a column. A filter
    `column = value` or `column in (...)` is then a parameter of the calls, and Spark filters
    what comes back once more, so a service that ignores the parameter gives the same rows. With
    push, Spark wants spark.sql.python.filterPushdown.enabled, which session() sets.
    If the first page's reply states the number of pages in the field that `total` names, pages are
    dealt in ranges; otherwise reader i takes pages i, i + readers, ... up to one that is empty.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        keys = json.loads(self.options.get("keys", "{}"))
        return ", ".join(["raw_json string", *(f"`{c}` {kind}" for c, (_, kind) in keys.items())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return (PushingReader if self.options.get("push") else PagedReader)(dict(self.options))


class PageRange(InputPartition):
    """Pages first, first + step, ... up to last of one set of parameters; records of page 1 if they have been read."""

    def __init__(self, params: dict, first: int, step: int, last: int | None, records: list | None = None) -> None:
        self.params, self.first, self.step, self.last, self.records = params, first, step, last, records


#: A key column's value from a record's field, None if it can't be.
CASTS = {"boolean": bool, "string": str, "double": float, "float": float}


def key_value(value: object, kind: str) -> object:
    try:
        return None if value is None else CASTS.get(kind, int)(value)
    except (TypeError, ValueError):
        return None


class PagedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options, self.asked = options, []
        self.keys, self.push = json.loads(options.get("keys", "{}")), json.loads(options.get("push", "{}"))
        self.readers = int(options.get("readers", 3))

    def partitions(self) -> list[InputPartition]:
        o, own = self.options, _params(self.options)
        names = [n for n, _ in self.asked]
        sets = [{**own, **dict(zip(names, values))} for values in product(*(sorted(set(v), key=repr) for _, v in self.asked))] if len(names) == len(set(names)) else [own]
        out, pace = [], Pace(float(o.get("per_second", 0)), 1)
        for params in sets:
            pace()
            body = with_retry(lambda p=params: client_of(o)(o["path"], {**p, "page": 1, "size": int(o.get("page_size", 100))}))
            records, more = page_records(body)
            total = body.get(o.get("total", "TotalPages")) if isinstance(body, dict) else None
            out.append(PageRange(params, 1, 1, 1, records))
            if more and total:
                per = -(-(int(total) - 1) // self.readers)
                out += [PageRange(params, a, 1, min(int(total), a + per - 1)) for a in range(2, int(total) + 1, per)]
            elif more:
                out += [PageRange(params, 2 + i, self.readers, None) for i in range(self.readers)]
        return out or [PageRange(own, 1, 1, 0, [])]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        o, p = self.options, partition
        records = p.records
        if records is None:
            records = paginate(client_of(o), o["path"], p.params, int(o.get("page_size", 100)), p.first, p.step, p.last, Pace(float(o.get("per_second", 0)), self.readers))
        for r in records:
            yield (json.dumps(r, ensure_ascii=False), *(key_value(r.get(field) if isinstance(r, dict) else None, kind) for field, kind in self.keys.values()))


class PushingReader(PagedReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equalities on pushed columns become parameters; all filters stay with Spark too."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in self.push:
                self.asked.append((self.push[column], [f.value] if isinstance(f, EqualTo) else [v for v in f.value if v is not None]))
            yield f


class PageStream(DataSource):
    """The page numbers of a paged path as a stream, for records_of() to read in tasks. Options as of paged_rest; batch_pages (30).

    The offset is the last page that was dealt, so a stopped scan goes on after its last
    complete batch. The first batch has batch_pages pages. What a batch costs besides its pages is
    the same for few and many, so after one that took less than QUICK seconds the next has twice
    the pages, after one of more than SLOW half of them, batch_pages at least. A batch asks for its
    last page only, to see whether the pages end before it; in that case their end is found by
    halving. If such a look fails, the batch has batch_pages pages, so pages before a broken one
    are dealt.
    """

    @classmethod
    def name(cls) -> str:
        return "rest_pages"

    def schema(self) -> str:
        return "page int"

    def simpleStreamReader(self, schema: T.StructType) -> SimpleDataSourceStreamReader:
        return PageStreamReader(dict(self.options))


#: Seconds of a batch below which the next one is larger, above which it is smaller.
QUICK, SLOW = 2.0, 8.0


class PageStreamReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.options, self.times, self.dealt_at, self.ended = options, 1, None, None

    def initialOffset(self) -> dict:
        return {"page": 0}

    def has(self, page: int) -> bool:
        o = self.options
        params = {**_params(o), "page": page, "size": int(o.get("page_size", 100))}
        return bool(page_records(with_retry(lambda: client_of(o)(o["path"], params)))[0])

    def last(self, done: int, end: int) -> int:
        """The last page up to `end` that has records, `done` if none after it has any."""
        if self.has(end):
            return end
        low, high = done, end  # page `low` has records or was dealt before, page `high` has none
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self.has(middle) else (low, middle)
        return low

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        done, size = start["page"], int(self.options.get("batch_pages", 30))
        if self.dealt_at is not None:
            took = time.monotonic() - self.dealt_at
            self.times = self.times * 2 if took < QUICK else max(1, self.times // 2) if took > SLOW else self.times
        if done == self.ended and not self.has(done + 1):  # the pages ended here at the last look
            return iter([]), start
        try:
            end = self.last(done, done + size * self.times)
        except Exception:
            if self.times == 1:
                raise
            self.times, end = 1, self.last(done, done + size)
        whole = end == done + size * self.times
        self.ended, self.times, self.dealt_at = (None, self.times, time.monotonic()) if whole else (end, 1, None)
        return self.readBetweenOffsets(start, {"page": end}), {"page": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(p,) for p in range(start["page"] + 1, end["page"] + 1)])


def records_of(pages: DataFrame, options: dict[str, str], readers: int = 3) -> DataFrame:
    """(page, raw_json) of all records of the pages, read by tasks at one rate (option per_second)."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, pace = client_of(options), Pace(float(options.get("per_second", 0)), readers)
        for b in batches:
            for page in b.column(0).to_pylist():
                found = paginate(get, options["path"], _params(options), int(options.get("page_size", 100)), page, last=page, pace=pace)
                texts = [json.dumps(r, ensure_ascii=False) for r in found]
                yield pa.RecordBatch.from_arrays([pa.array([page] * len(texts), pa.int32()), pa.array(texts, pa.string())], names=["page", "raw_json"])

    return pages.select("page").repartition(readers).mapInArrow(run, "page int, raw_json string")


def resumable_scan(spark: SparkSession, options: dict[str, str], target: str, checkpoint: str, readers: int = 3, each: Callable[[int], None] = lambda _: None) -> None:
    """Land all pages of a path as Parquet (page, raw_json) under target, batch by batch, and end with the last page.

    Call it again with the same checkpoint after a failure: it goes on after the last batch that
    was landed whole. A batch that is tried again replaces its own rows, so none is there twice.
    Of a batch that fails the pages before the failure are landed, in steps of batch_pages.
    each(batch) is called after each batch.
    """
    spark.dataSource.register(PageStream)
    pages, size = spark.readStream.format("rest_pages").options(**options).load(), int(options.get("batch_pages", 30))

    def land(batch: DataFrame, number: int) -> None:
        write = lambda df, mode: records_of(df, options, readers).write.mode(mode).parquet(f"{target}/batch={number}")
        try:
            write(batch, "overwrite")
        except Exception:
            numbers = sorted(r.page for r in batch.collect())
            if len(numbers) <= size:
                raise
            for at in range(0, len(numbers), size):
                part = batch.sparkSession.createDataFrame([(p,) for p in numbers[at : at + size]], "page int")
                write(part, "append" if at else "overwrite")
        each(number)

    query = pages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
