"""Vector codes: each part of a vector is named by the nearest entry of its position's codebook.

Components become whole numbers, so distances, sums and means are exact and results don't
depend on how rows are dealt. The nearest entry is found by annular norm pruning: entries
are sorted by norm; since ||x| - |e|| is at most the distance of x and e, the best distance
so far allows an interval of norms, which is found by binary search and shrinks with each
better entry; entries in the interval, its ends included, are compared exactly. Rounds of
assignment and averaging are sums made in tasks, one row for each number of a codebook.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.llm.common import attach, materialised

#: Components times this are rounded down to whole numbers; the greatest of these that keeps squared distances of 128 in 64 bits.
SCALE, GREATEST = 4096, 1 << 27
#: Bytes of vectors that a task compares at once; a bound of memory.
AT_ONCE = 16 << 20


def usable(vector: Column) -> Column:
    """Vectors without null, NaN or infinite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest entry, squared distance) of each row of x, all 64-bit integers; ties go to the lower number."""
    norms = np.sqrt((entries * entries).sum(axis=1).astype(np.float64))
    order = np.argsort(norms, kind="stable")
    norms, sorted_ = norms[order], entries[order]
    own = np.sqrt((x * x).sum(axis=1).astype(np.float64))
    slack = 1e-9 * (own + norms[-1]) + 1e-6  # over what rounding can take away, so ends are included

    at = np.clip(np.searchsorted(norms, own), 1, max(1, len(norms) - 1))
    if len(norms) > 1:
        start = np.where(own - norms[at - 1] <= norms[at] - own, at - 1, at)
    else:
        start = np.zeros(len(x), np.int64)
    best, index = ((x - sorted_[start]) ** 2).sum(axis=1), order[start]
    reach = np.sqrt(best.astype(np.float64)) + slack
    low, high = np.searchsorted(norms, own - reach, "left"), np.searchsorted(norms, own + reach, "right")
    for step in range(1, len(norms)):
        for place in (start + step, start - step):
            rows = np.flatnonzero((place >= low) & (place < high))
            if not len(rows):
                continue
            e = place[rows]
            d = ((x[rows] - sorted_[e]) ** 2).sum(axis=1)
            better = (d < best[rows]) | ((d == best[rows]) & (order[e] < index[rows]))
            rows, e = rows[better], e[better]
            best[rows], index[rows] = d[better], order[e]
            reach = np.sqrt(best[rows].astype(np.float64)) + slack[rows]
            low[rows], high[rows] = np.searchsorted(norms, own[rows] - reach, "left"), np.searchsorted(norms, own[rows] + reach, "right")
    return index, best


def whole_vectors(rows: DataFrame, vector_col: str, dims: int) -> DataFrame:
    """The other columns with `v`: the vector's whole numbers as little-endian 32-bit integers."""
    keep = [c for c in rows.columns if c != vector_col]
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("v", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column(len(keep)).flatten(), np.float64).reshape(-1, dims)
            x = np.floor(x * SCALE)
            if (np.abs(x) > GREATEST).any():
                raise ValueError(f"components beyond {GREATEST // SCALE} have no exact squared distance in 64 bits")
            data = x.astype("<i4")
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array([r.tobytes() for r in data], pa.binary())], names=schema.names)

    typed = rows.select(*keep, F.col(vector_col).cast("array<double>").alias(vector_col))
    return typed.mapInArrow(run, schema)


def blocks(b: pa.RecordBatch, place: int, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch of whole vectors, of bounded size, with their numbers."""
    rows = max(1, AT_ONCE // (8 * dims))
    for at in range(0, b.num_rows, rows):
        part = b.slice(at, rows)
        yield part, np.frombuffer(b"".join(part.column(place).to_pylist()), "<i4").astype(np.int64).reshape(-1, dims)


def averaged(whole: DataFrame, books: np.ndarray) -> tuple[np.ndarray, int]:
    """(the codebooks after one round, number of vectors). books: parts x entries x width.

    Tasks hand on one row for each number and each entry's count, whatever they read; the
    driver gets as many numbers as the codebooks have. Unused entries stay.
    """
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, used = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            for _, x in blocks(b, 0, parts * width):
                for p in range(parts):
                    own = x[:, p * width : (p + 1) * width]
                    index, _ = nearest(own, books[p])
                    order = np.argsort(index, kind="stable")
                    first = np.searchsorted(index[order], np.arange(entries))
                    n = np.bincount(index, minlength=entries)
                    hit = np.flatnonzero(n)
                    if len(hit):
                        sums[p, hit] += np.add.reduceat(own[order], first[hit], axis=0)
                    used[p] += n
        if used.any():
            values = np.concatenate([sums.ravel(), used.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["slot", "total"])

    got = whole.select("v").mapInArrow(run, "slot long, total long").groupBy("slot").agg(F.sum("total").alias("total")).toPandas()
    values = np.zeros(books.size + parts * entries, np.int64)
    values[got["slot"].to_numpy(np.int64)] = got["total"].to_numpy(np.int64)
    sums, used = values[: books.size].reshape(books.shape), values[books.size :].reshape(parts, entries)
    new = np.where(used[:, :, None] > 0, sums // np.maximum(used, 1)[:, :, None], books)
    return new, int(used[0].sum())


def compress(df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every row with a usable vector.

    A codebook starts as its part of the `entries` smallest ids' vectors (ties by vector, null
    ids last; fewer if there are fewer rows), and each of the rounds replaces each entry by the
    floor of its parts' mean. Code: two hex digits a part; error: the squared distances summed;
    label_error: errors summed over equal labels, nulls together. Vectors that are null or empty
    or hold null or non-finite components are left out, and so are vectors of another length
    than the first's, which must be a multiple of `parts`. Components beyond 32,768 are an
    error. Repeated rows are coded alike, extra columns ignored; an empty table gives no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 256 entries at most")
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("x")).where(usable(F.col("x")) & (F.size("x") > 0))
    order = [F.asc_nulls_last("id"), F.col("x")]
    one = rows.orderBy(*order).select(F.size("x").alias("dims")).first()
    dims = one.dims if one else parts
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    rows = rows.where(F.size("x") == dims)
    first = rows.orderBy(*order).limit(entries).select(F.col("x").cast("array<double>").alias("x")).collect()
    whole = materialised(whole_vectors(rows, "x", dims))
    start = np.floor(np.asarray([r.x for r in first], np.float64).reshape(-1, dims) * SCALE).astype(np.int64)
    books, total = start.reshape(-1, parts, dims // parts).transpose(1, 0, 2), 0
    for _ in range(rounds if first else 0):
        books, total = averaged(whole, books)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    width = dims // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{i:02x}" for i in range(256)])
        for b in batches:
            for part, x in blocks(b, 2, dims):
                found = [nearest(x[:, p * width : (p + 1) * width], books[p]) for p in range(parts)]
                code = ["".join(r) for r in digits[np.stack([i for i, _ in found], axis=1)].tolist()]
                error = np.sum([d for _, d in found], axis=0)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["id", "label", "code", "error"])

    schema = T.StructType([whole.schema["id"], whole.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    # labels as text, so that nulls are a label of their own and rows can be joined by it
    key = F.concat(F.col("label").isNull().cast("int").cast("string"), F.coalesce(F.col("label").cast("string"), F.lit("")))
    coded = materialised(whole.mapInArrow(run, schema).withColumn("label_key", key))
    sums = coded.groupBy("label_key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    out = attach(coded, sums, ["label_key"], "n", total)
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
