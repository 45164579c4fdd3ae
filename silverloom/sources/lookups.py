"""Keyed lookups against outside services: one call a row, errors kept apart, client injectable."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.functions.strings import extension_of
from silverloom.sources.rest import Pace, paginate

#: Rows of an Arrow batch that are handed to the client before they go on.
AT_ONCE = 64
TEXT, BYTES = pa.string(), pa.binary()


def _called(rows: DataFrame, extra: dict[str, tuple[T.DataType, pa.DataType]], answers: Callable[[dict], list[tuple]], readers: int, per_second: float = 0) -> DataFrame:
    """Each row beside each of its answers, a tuple of the extra columns' values. Rows stay in Arrow, so a null
    beside large whole numbers changes neither; the readers share one rate."""
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, kind) for n, (kind, _) in extra.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = Pace(per_second, readers)
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                part = b.slice(at, AT_ONCE)
                own, made = [], []
                for i, row in enumerate(part.to_pylist()):
                    pace()
                    found = answers(row)
                    own += [i] * len(found)
                    made += found
                columns = zip(*made) if made else [[]] * len(extra)
                arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, extra.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(own, pa.int64())) for c in part.columns), *arrays], names=schema.names)

    return rows.repartition(readers).mapInArrow(run, schema)


def lookup(keys: DataFrame, call: Callable[[dict], object], readers: int = 3, every: int = 10, pause: float = 0.0) -> DataFrame:
    """keys with (reply, error): the JSON of call(row), null reply without error if there is none (404).

    `readers` partitions call at the same time, all together at most `every` times in `pause` seconds.
    """

    def answers(row: dict) -> list[tuple]:
        try:
            got = call(row)
            return [(None if got is None else json.dumps(got, ensure_ascii=False), None)]
        except Exception as e:  # kept with its key, the other rows go on
            return [(None, f"{type(e).__name__}: {e}")]

    return _called(keys, {"reply": (T.StringType(), TEXT), "error": (T.StringType(), TEXT)}, answers, readers, every / pause if pause else 0)


def paged_lookup(keys: DataFrame, get: Callable[[str, dict], dict], path: str, param: str, key: str, size: int = 25, readers: int = 3) -> DataFrame:
    """(key, raw_json, error): all records of each key from a paged path, the key given as a parameter of the call.

    A key whose call fails gives one row with the error.
    """

    def answers(row: dict) -> list[tuple]:
        try:
            return [(json.dumps(r, ensure_ascii=False), None) for r in paginate(get, path, {param: row[key]}, size, codes={429}, attempts=6, wait=60)]
        except Exception as e:  # kept with its key, the other keys go on
            return [(None, f"{type(e).__name__}: {e}")]

    return _called(keys.select(key), {"raw_json": (T.StringType(), TEXT), "error": (T.StringType(), TEXT)}, answers, readers)


def downloads(files: DataFrame, fetch: Callable[[dict], tuple[bytes, str]], readers: int = 3) -> DataFrame:
    """files with (content, extension, error): fetch(row) -> (bytes, content type), the extension by the type, '.pdf' by default."""

    def answers(row: dict) -> list[tuple]:
        try:
            return [(*fetch(row), None)]
        except Exception as e:  # kept with its file, the others go on
            return [(None, None, f"{type(e).__name__}: {e}")]

    extra = {"content": (T.BinaryType(), BYTES), "content_type": (T.StringType(), TEXT), "error": (T.StringType(), TEXT)}
    found = _called(files, extra, answers, readers)
    return found.withColumn("extension", F.when(F.col("error").isNull(), extension_of(F.col("content_type")))).drop("content_type")


def split_errors(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a reply, rows with an error); rows with neither were not found and are dropped."""
    return found.where("reply is not null").drop("error"), found.where("error is not null").drop("reply")


def resource_pairs(products: DataFrame) -> DataFrame:
    """Distinct (location_id, resource_id) of products that have both."""
    both = products.where("location_id is not null and location_id <> 0 and resource_id is not null and resource_id <> 0")
    return both.select("location_id", "resource_id").distinct()


def search_plan(locations: DataFrame, searches: DataFrame) -> DataFrame:
    """Each location with coordinates beside each configured search, a small table with its ordinal."""
    usable = locations.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & (F.col("latitude") != 0) & (F.col("longitude") != 0))
    return usable.join(F.broadcast(searches), F.lit(True))
