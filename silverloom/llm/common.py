"""Helpers that several operators share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def materialised(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and cut its lineage.

    The folder is the session's spark.checkpoint.dir. A session without one, as in tests, gets
    a temporary folder if all of it runs on this machine; on a cluster it is an error, since
    executors don't see each other's folders. Spark removes a checkpoint with its DataFrame
    if spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, set as materialised() says."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp())
    return sc.getCheckpointDir()


ARROW = {
    "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
    "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


#: Rows and bytes of an Arrow batch that a task turns into Python values at once; bounds of memory.
ROWS_AT_ONCE, BYTES_AT_ONCE = 1024, 4 << 20


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded size, one row at least; an empty batch gives none."""
    for b in batches:
        rows = max(1, min(ROWS_AT_ONCE, BYTES_AT_ONCE * b.num_rows // max(1, b.nbytes)))
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def map_texts(df: DataFrame, keep: list[str], text_col: str, fields: dict[str, str], make: Callable, within: str | None = None) -> DataFrame:
    """Narrow pass: the kept columns of each row, unchanged, with the fields made from its text.

    make(texts) gets the texts of an Arrow batch, nulls as empty texts, and returns
    (rows, columns): a column of values for each field, and the number of the input row of
    each value, or None for one value a row. Batches are bounded in rows and bytes by Spark.
    `within` names a kept struct, never null, that holds the text, so that it travels once.
    """
    kept = [f"_{i}" for i in range(len(keep))]
    slim = df.select(*[df[c].alias(k) for c, k in zip(keep, kept)], *([] if within else [df[text_col].alias("_text")]))
    place = keep.index(within) if within else len(keep)
    schema = T.StructType([T.StructField(k, df.schema[c].dataType) for c, k in zip(keep, kept)])
    for name, kind in fields.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            texts = b.column(place).field(text_col) if within else b.column(place)
            rows, columns = make([t if isinstance(t, str) else "" for t in texts.to_pylist()])
            own = b.columns[: len(kept)]
            if rows is not None:
                at = pa.array(np.asarray(rows, np.int64))
                own = [c.take(at) for c in own]
            made = [pa.array(c, ARROW[kind], from_pandas=False) for c, kind in zip(columns, fields.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*own, *made], names=schema.names)

    out = slim.mapInArrow(run, schema)
    return out.withColumnsRenamed(dict(zip(kept, keep)))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def attach(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int, how: str = "left", shares: int = 1000) -> DataFrame:
    """Join left with right, which has one row per key and the key's row count in `weight`.

    A key with more than 1/shares of `total` rows is joined by broadcast: at most
    `shares` such keys exist, so the broadcast is bounded. All others are shuffled,
    and none of them can fill a task. Null keys match nothing.
    """
    floor = max(2, total // shares)
    hot = right.where(F.col(weight) > floor).drop(weight)
    cold = right.where(F.col(weight) <= floor).drop(weight)
    by_broadcast = left.join(F.broadcast(hot), keys, "inner")
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, how)
    return by_broadcast.unionByName(rest.select(*by_broadcast.columns))


def attach_once(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int, deal: Column, shares: int = 1000) -> DataFrame:
    """attach() as a left join that reads `left` once, for one that is costly: rows of broadcast keys are shuffled too, dealt by `deal`."""
    floor = max(2, total // shares)
    new = [c for c in right.columns if c not in (*keys, weight)]
    hot = right.where(F.col(weight) > floor).select(*keys, F.struct(*new).alias("_hot"))
    cold = right.where(F.col(weight) <= floor).select(*keys, F.struct(*new).alias("_cold"), F.lit(0).cast("long").alias("_deal"))
    dealt = left.join(F.broadcast(hot), keys, "left").withColumn("_deal", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(deal).cast("long"))
    found = dealt.join(cold, [*keys, "_deal"], "left").withColumn("_new", F.coalesce("_hot", "_cold"))
    return found.select(*left.columns, *[F.col("_new")[c].alias(c) for c in new])


def components(edges: DataFrame, a: str = "a", b: str = "b", per_task: int = 50_000) -> DataFrame:
    """Connected components of an undirected graph: (node, component), component = smallest node.

    Alternating large-star and small-star rounds, each two joins on the node and a
    checkpoint, until the edges no longer change; a logarithmic number of rounds.
    Nothing but two numbers a round reaches the driver. A node with a large share of the
    edges, as the centre of a star, is joined by broadcast, so its edges stay where they are.
    Self loops and nulls are ignored, nodes without edges are not returned.
    """
    star = materialised(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    mark = None
    while True:
        seen = tuple(star.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == seen or not seen[0]:
            break
        mark = seen
        tasks = max(1, -(-seen[0] // per_task))  # few edges go to few tasks, which keeps shuffle files few
        star = star.coalesce(tasks)
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        large = attach(both, least, ["u"], "n", 2 * seen[0], "inner").where("v > u")
        large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).coalesce(tasks)
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = attach(large, low, ["u"], "n", seen[0], "inner")
        small = small.select("u", "v", "m", F.explode(F.array(F.lit(True), F.lit(False))).alias("own"))
        small = small.select(F.when(F.col("own"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        star = materialised(small.where("u <> v").coalesce(tasks).distinct().coalesce(tasks))
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


class Union:
    """Union-find over any hashable items, inside a task."""

    def __init__(self) -> None:
        self.up: dict = {}

    def root(self, x):
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True
