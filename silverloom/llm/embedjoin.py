"""Near-duplicate embeddings by an epsilon grid order join.

Vectors are scaled to length one, so that a least cosine is a greatest distance epsilon.
They are sorted by their grid cells (of side epsilon) on the leading principal dimensions
and cut into intervals of this order. Intervals whose boxes are farther apart than
epsilon on these dimensions are never paired; the others are joined recursively, halving
intervals and skipping distant halves, down to small blocks that a matrix product joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.llm.common import Union, attach, components, materialised

#: Leading principal dimensions of the grid.
DIMS = 6
#: Vectors of an interval, and of the blocks that the recursion ends with.
INTERVAL, LEAF = 1024, 128
#: Slack of all distance bounds against rounding.
TINY = 1e-9


def scaled(flat: np.ndarray, size: int) -> np.ndarray:
    """Rows in double precision times powers of two (which changes no digit), so that no product overflows or vanishes."""
    x = flat.reshape(-1, size).astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(flat: np.ndarray, size: int) -> np.ndarray:
    """Rows of length one in double precision."""
    x = scaled(flat, size)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rows_of(batch: pa.RecordBatch, at: int) -> list[np.ndarray]:
    column = batch.column(at)
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *pa.compute.list_value_length(column).to_pylist()])
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def principal(vectors: DataFrame, rounds: int = 2) -> dict[int, np.ndarray]:
    """For each vector size the leading principal axes (size x up to DIMS) of all unit vectors, nearly.

    Subspace iteration from fixed random axes: in each of `rounds` passes tasks sum the products
    of their vectors with the axes so far; the driver gets `size` short rows a size. Any
    orthonormal axes give right results; good ones keep distant vectors apart.
    """
    spare = DIMS + 4
    axes: dict[int, np.ndarray] = {}

    def start(n: int) -> np.ndarray:
        return np.linalg.qr(np.random.default_rng(n).normal(size=(n, min(n, spare))))[0]

    names = [f"s{k}" for k in range(spare + 1)]  # the last column: the sum of the vectors; row -1: sums of the products and the count

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            by: dict[int, list[np.ndarray]] = {}
            for v in rows_of(b, 0):
                by.setdefault(len(v), []).append(v)
            for n, vs in by.items():
                u = unit(np.concatenate(vs), n)
                y = u @ axes.get(n, start(n))
                out = sums.setdefault(n, np.zeros((n + 1, spare + 1)))
                out[:n, : y.shape[1]] += u.T @ y
                out[:n, spare] += u.sum(axis=0)
                out[n, : y.shape[1]] += y.sum(axis=0)
                out[n, spare] += len(u)
        for n, s in sums.items():
            cols = [pa.array(np.full(n + 1, n)), pa.array(np.arange(n + 1)), *map(pa.array, s.T)]
            yield pa.RecordBatch.from_arrays(cols, names=["n", "i", *names])

    for _ in range(rounds):
        rows = vectors.select("embedding").mapInArrow(products, ", ".join(["n long", "i long", *(f"{c} double" for c in names)]))
        sums: dict[int, np.ndarray] = {}
        for n, i, *s in rows.groupBy("n", "i").agg(*[F.sum(c) for c in names]).collect():
            sums.setdefault(n, np.zeros((n + 1, spare + 1)))[i] = s
        for n, s in sums.items():
            k = min(n, spare)
            spread = s[:n, :k] / s[n, spare] - np.outer(s[:n, spare], s[n, :k]) / s[n, spare] ** 2
            axes[n] = np.linalg.svd(spread + 1e-12 * start(n), full_matrices=False)[0]
    return {n: x[:, :DIMS] for n, x in axes.items()}


def cells_of(vectors: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """vectors (rep, label, embedding, copies) with their size and the grid cells on the leading axes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs = rows_of(b, 2)
            cells = [np.floor(unit(v, len(v)) @ axes[len(v)] / eps).astype(np.int32)[0] for v in vs]
            more = [pa.array([len(v) for v in vs], pa.int32()), pa.array(cells, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, "size", "cells"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema) + ", size int, cells array<int>"
    return vectors.mapInArrow(run, schema)


def intervals(ordered: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """Intervals of the grid order: up to INTERVAL neighbouring vectors of one label and size, with their box."""

    def packed(part: int, at: int, held: list[tuple]) -> tuple:
        size = held[0][3]
        u = unit(np.concatenate([h[2] for h in held]), size) @ axes[size]
        flat = np.concatenate([h[2] for h in held]).tobytes()
        ids, copies = (np.asarray([h[i] for h in held], np.int64).tobytes() for i in (0, 4))
        return part * (1 << 32) + at, held[0][1], size, u.min(axis=0), u.max(axis=0), ids, copies, flat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, held = TaskContext.get().partitionId(), 0, []
        out = []
        for b in batches:
            kind = b.schema.field("label").type
            cols = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names) if n != "embedding"}
            for rep, label, v, size, copies in zip(cols["rep"], cols["label"], rows_of(b, b.schema.names.index("embedding")), cols["size"], cols["copies"]):
                if held and (len(held) == INTERVAL or (label, size) != (held[0][1], held[0][3])):
                    out.append(packed(part, at, held))
                    at, held = at + 1, []
                held.append((rep, label, v.copy(), size, copies))
            if out:
                yield rows(out, kind)
                out = []
        if held:
            yield rows([packed(part, at, held)], kind)

    def rows(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [pa.int64(), kind, pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["chunk", "label", "size", "lo", "hi", "ids", "copies", "flat"])

    name = ordered.schema["label"].dataType.simpleString()
    return ordered.mapInArrow(run, f"chunk long, label {name}, size int, lo array<double>, hi array<double>, ids binary, copies binary, flat binary")


def joined(a: dict, b: dict, axes: np.ndarray, least: float, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two intervals (or of one with itself, i < j) with cosine >= least, by recursion."""
    ua, ub = a["u"], b["u"]
    pa_, pb = ua @ axes, ub @ axes
    same = a is b
    left, right = [], []

    def box(p: np.ndarray, s: slice) -> tuple[np.ndarray, np.ndarray]:
        return p[s].min(axis=0), p[s].max(axis=0)

    def go(s: slice, t: slice) -> None:
        if same and s.start > t.start:
            return
        (la, ha), (lb, hb) = box(pa_, s), box(pb, t)
        gap = np.maximum(0, np.maximum(la - hb, lb - ha))
        if (gap * gap).sum() > eps * eps + TINY:
            return
        n, m = s.stop - s.start, t.stop - t.start
        if n <= LEAF and m <= LEAF:
            cos = ua[s] @ ub[t].T
            i, j = np.nonzero(cos >= least - TINY)
            close = np.flatnonzero(np.abs(cos[i, j] - least) <= TINY)
            keep = np.ones(len(i), bool)
            for k in close:
                x, y = a["x"][s.start + i[k]], b["x"][t.start + j[k]]
                keep[k] = float(np.dot(x, y)) / (float(np.sqrt(np.dot(x, x))) * float(np.sqrt(np.dot(y, y)))) >= least
            i, j = i[keep] + s.start, j[keep] + t.start
            if same:
                i, j = i[i < j], j[i < j]
            left.append(i)
            right.append(j)
            return
        halves = lambda r: [r] if r.stop - r.start <= LEAF else [slice(r.start, (r.start + r.stop) // 2), slice((r.start + r.stop) // 2, r.stop)]
        for x in halves(s):
            for y in halves(t):
                go(x, y)

    go(slice(0, len(ua)), slice(0, len(ub)))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def linked(chunks: DataFrame, axes: dict[int, np.ndarray], least: float, eps: float, kind: type, salts: int = 8) -> DataFrame:
    """(id, links, anchor) of the vectors that interval pairs link: rows that it gains, and a vector of its component.

    Pairs are found by the cells that boxes cover on the first two dimensions; boxes and no vectors
    take part in that. kind: numpy's type of the components."""
    box = chunks.select("chunk", "label", "size", "lo", "hi")

    def cells(lo: str, hi: str, more: int) -> Column:
        side = lambda k: F.sequence(F.floor(F.coalesce(F.get(lo, F.lit(k)), F.lit(0.0)) / eps) - more, F.floor(F.coalesce(F.get(hi, F.lit(k)), F.lit(0.0)) / eps) + more)
        return F.explode(F.flatten(F.transform(side(0), lambda x: F.transform(side(1), lambda y: F.struct(x.alias("x"), y.alias("y"))))))

    one = box.withColumn("cell", cells("lo", "hi", 1)).withColumn("salt", F.pmod("chunk", F.lit(salts)))
    two = box.select(F.col("chunk").alias("chunk2"), "label", "size", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    two = two.withColumn("cell", cells("lo2", "hi2", 0))
    two = two.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    gap = F.zip_with(F.arrays_zip("lo", "hi"), F.arrays_zip("lo2", "hi2"), lambda x, y: F.greatest(F.lit(0.0), x["lo"] - y["hi2"], y["lo2"] - x["hi"]))
    far = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g) > eps * eps + TINY
    pairs = one.join(two, ["label", "size", "cell", "salt"]).where((F.col("chunk") <= F.col("chunk2")) & ~far).select("chunk", "chunk2").distinct()
    load = chunks.select("chunk", "size", "ids", "copies", "flat")
    other = chunks.select(F.col("chunk").alias("chunk2"), *[F.col(c).alias(c + "2") for c in ("ids", "copies", "flat")])
    full = pairs.join(load, "chunk").join(other, "chunk2")

    def side(size: int, ids: bytes, copies: bytes, flat: bytes) -> dict:
        x = scaled(np.frombuffer(flat, kind), size)
        return {"ids": np.frombuffer(ids, np.int64), "copies": np.frombuffer(copies, np.int64), "u": unit(x, size), "x": x}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                r = {n: b.column(i)[at].as_py() for i, n in enumerate(b.schema.names)}
                x = side(r["size"], r["ids"], r["copies"], r["flat"])
                y = x if r["chunk"] == r["chunk2"] else side(r["size"], r["ids2"], r["copies2"], r["flat2"])
                i, j = joined(x, y, axes[r["size"]], least, eps)
                ids, gain = np.concatenate([x["ids"][i], y["ids"][j]]), np.concatenate([y["copies"][j], x["copies"][i]])
                own, back = np.unique(ids, return_inverse=True)
                union = Union()
                half = len(i)
                order = np.unique(back[:half] * np.int64(len(own) + 1) + back[half:]) if half else []
                for k in order:
                    union.join(int(k // (len(own) + 1)), int(k % (len(own) + 1)))
                anchor = own[[union.root(k) for k in range(len(own))]] if len(own) else own
                links = np.bincount(back, gain, len(own)).astype(np.int64) if len(own) else own
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(links, pa.int64()), pa.array(anchor, pa.int64())], names=["id", "links", "anchor"])

    return full.mapInArrow(run, "id long, links long, anchor long")


def near_vectors(
    df: DataFrame, least: float, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(id, n_links, component_id) of every row: other rows of its label and vector size with cosine >= least.

    component_id is the smallest id that links reach. Equal vectors of a label are joined as
    one with its number of copies, so a vector that a third of the rows share is one row of
    the join. Cosines are taken in double precision of the components as they are: array<float> as
    floats, all others as doubles. Labels may be of any type that can be grouped. Rows that are null, empty or zero, hold a null or non-finite component, or lack
    a label or id are linked with nothing: n_links is 0 and component_id the row's own id.
    Rows that repeat an id are rows of their own. Other columns are ignored.
    """
    eps = float(np.sqrt(max(0.0, 2 - 2 * least)))
    name, kind = ("float", np.float32) if df.schema[vector_col].dataType == T.ArrayType(T.FloatType()) else ("double", np.float64)
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(f"array<{name}>").alias("embedding")
    )
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("fine", F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & fine, F.lit(False)))
    good = rows.where("fine").select("id", "label", "embedding")
    vectors = good.groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    vectors = materialised(vectors.select("rep", "label", "embedding", "copies"))
    total = vectors.agg(F.sum("copies")).first()[0] or 0
    axes = principal(vectors)
    grid = cells_of(vectors, axes, eps)
    keys = [F.col("label"), F.col("size"), F.col("cells"), F.col("rep")]
    chunks = materialised(intervals(grid.repartitionByRange(*keys).sortWithinPartitions(*keys), axes))
    found = materialised(linked(chunks, axes, least, eps, kind))
    ends = components(found.select(F.col("id").alias("a"), F.col("anchor").alias("b")))
    gains = found.groupBy("id").agg(F.sum("links").alias("links"))
    ends = gains.join(ends, F.col("id") == F.col("node"), "left").select(F.col("id").alias("rep"), "links", "component")
    done = vectors.join(ends, "rep", "left").select(
        "label", "embedding", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    out = attach(good, done, ["label", "embedding"], "copies", total, "inner").select("id", "n_links", "component_id")
    rest = rows.where("not fine").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(rest).withColumnRenamed("id", id_col)
