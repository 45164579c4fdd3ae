"""Document fingerprints by locally consistent parsing.

A text is parsed level by level. On each level runs of one symbol become one symbol,
deterministic coin tossing reduces the symbols to six labels that differ between
neighbours, and a phrase starts at each local maximum of the labels. A phrase is named by
a hash of its symbols, and the names are the symbols of the next level. Labels depend on
a few neighbours only, so equal substrings get equal phrase names apart from their ends,
wherever they stand. The fingerprint is a sketch of the names of the longer phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import map_texts, shuffle_partitions

#: Cells of a sketch; each holds 16 bits of the least name that falls in it, 0 if none does.
CELLS = 128
#: Phrases of this level and above are sketched: about 15 characters and more.
LEVEL = 3
#: Characters parsed together in a task; a bound of memory, results don't depend on it.
GROUP = 300_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _toss_table(symbols: int) -> np.ndarray:
    """Coin tossing of small labels: [before, label] -> twice the lowest differing bit's place, plus that bit."""
    before, label = np.meshgrid(np.arange(symbols), np.arange(symbols), indexing="ij")
    x = before ^ label
    place = np.where(x == 0, 0, np.log2(np.maximum(x & -x, 1)).astype(int))
    return (2 * place + ((label >> place) & 1)).astype(np.uint8)


TOSS = [_toss_table(n) for n in (128, 14, 8)]


def labels(names: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Six labels, by coin tossing four times; a text's first symbol tosses against its own complement."""
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[start] = names[start] ^ np.uint64(1)
    x = names ^ before
    low = x & (~x + np.uint64(1))
    place = ((low.astype(np.float64).view(np.int64) >> 52) - 1023).astype(np.uint64)
    out = (np.uint64(2) * place + ((names >> place) & np.uint64(1))).astype(np.uint8)
    for table in TOSS:
        first = out[start] & 1
        out[1:] = table[out[:-1], out[1:]]
        out[start] = first
    return out


def parse(names: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: the names of the phrases, and the phrase that each text starts with. No text is empty."""
    is_start = np.zeros(len(names), bool)
    is_start[start] = True
    head = is_start.copy()
    head[1:] |= names[1:] != names[:-1]
    run = np.flatnonzero(head)
    length = np.diff(np.append(run, len(names))).astype(np.uint64)
    names = np.where(length > 1, mixed(names[run] * ODD + length), names[run])
    start = np.searchsorted(run, start)
    lab = labels(names, start)
    cut = np.zeros(len(names), bool)
    cut[1:-1] = (lab[1:-1] > lab[:-2]) & (lab[1:-1] >= lab[2:])
    last = np.append(start[1:], len(names)) - 1
    cut[last] = False
    cut[start] = True
    phrase = np.flatnonzero(cut)
    size = np.diff(np.append(phrase, len(names)))
    place = np.arange(len(names)) - np.repeat(phrase, size)
    total = np.add.reduceat(mixed(names + place.astype(np.uint64) * ODD), phrase)
    return mixed(total + size.astype(np.uint64)), np.searchsorted(phrase, start)


def phrases(texts: list[str], level: int = LEVEL) -> tuple[np.ndarray, np.ndarray]:
    """(text number, name) of all phrases from `level` on, and of each text's last phrase; none of an empty text."""
    own = np.flatnonzero([bool(t) for t in texts])
    sizes = np.asarray([len(texts[i]) for i in own], np.int64)
    if not len(own):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    docs, found = [], []
    at = 0
    while len(own):
        size = np.diff(np.append(start, len(names)))
        each = np.repeat(np.arange(len(own)), size)
        done = size == 1
        take = np.ones(len(names), bool) if at >= level else done[each]
        docs.append(own[each[take]])
        found.append(names[take])
        rest = ~done[each]
        names, own = names[rest], own[~done]
        start = np.concatenate([[0], np.cumsum(size[~done])[:-1]]).astype(np.int64)
        if len(own):
            names, start = parse(names, start)
        at += 1
    return np.concatenate(docs), np.concatenate(found)


def sketches(texts: list[str]) -> np.ndarray:
    """The sketch of each text, a row of CELLS 16-bit numbers; the empty text's is all zero."""
    out = np.zeros((len(texts), CELLS), np.uint16)
    at = 0
    while at < len(texts):
        to, chars = at, 0
        while to < len(texts) and (to == at or chars + len(texts[to]) <= GROUP):
            chars += len(texts[to])
            to += 1
        doc, name = phrases(texts[at:to])
        name = mixed(name ^ ODD)
        cell = doc * CELLS + (name >> np.uint64(57)).astype(np.int64)
        key = (cell.astype(np.uint64) << np.uint64(32)) | (name & np.uint64(0xFFFFFFFF))
        key.sort()
        cell = (key >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else cell
        out[at:to].reshape(-1)[cell[first]] = (key[first] & np.uint64(0xFFFFFFFF)) % np.uint64(65535) + np.uint64(1)
        at = to
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of common phrases of pairs of sketches (rows), 0 to 1: Dice's measure from the cells that agree.

    Two empty texts are alike, an empty and another are not."""
    either = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    j = same / np.maximum(either, 1)
    return np.where(either == 0, 1.0, 2 * j / (1 + j))


def as_text(s: np.ndarray) -> list[str]:
    return [r.astype(">u2").tobytes().hex() for r in s]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row in one narrow pass; null counts as the empty text, equal texts get equal fingerprints."""
    return map_texts(df, [id_col], text_col, {"fingerprint": "string"}, lambda texts: (None, [as_text(sketches(texts))]))


def beside_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Each row beside its next one: (id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next).

    The next row has the next smaller id, and after the last row comes the first. Rows that
    repeat an id stand in order of their texts; rows without id come last. edited is the text
    with its last half (rounded down) replaced by as much of the next row's beginning. Null
    texts count as empty. A lone row is its own next one. Other columns are ignored.

    Ids are cut at approximate quantiles into buckets, each sorted by its task, which reads
    it as a stream: one shuffle of the texts, no window over all rows, no partition held in
    memory. Only one id for each bucket reaches the driver: the first row of a bucket is
    also sent to the end of the bucket before it.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = buckets or min(4096, 4 * shuffle_partitions(df))
    shares = F.array(*[F.lit((k + 1) / n) for k in range(n - 1)]) if n > 1 else F.array(F.lit(0.5))
    cuts = rows.agg(F.percentile_approx("id", shares, 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c >= F.col("id"))) if cuts else F.lit(0)
    rows = rows.withColumn("bucket", F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(above).cast("int"))
    firsts = sorted(tuple(r) for r in rows.groupBy("bucket").agg(F.max("id")).collect())
    follow = [(i, b) for (b, _), (_, i) in zip(firsts, firsts[1:] + firsts[:1])]
    follow = df.sparkSession.createDataFrame(follow, "first long, before int")
    extra = rows.join(F.broadcast(follow), F.col("id").eqNullSafe(F.col("first")))
    extra = extra.select("id", "text", F.col("before").alias("bucket"), F.lit(True).alias("extra"))
    both = rows.withColumn("extra", F.lit(False)).unionByName(extra)
    both = both.repartition(shuffle_partitions(df), "bucket").sortWithinPartitions("bucket", "extra", F.desc_nulls_last("id"), "text")

    def finished(held: list[tuple], sk: np.ndarray) -> pa.RecordBatch:
        """Rows of held but the last, each beside the one after it."""
        pairs = [i for i in range(len(held) - 1) if not held[i][3] and held[i][2] == held[i + 1][2]]
        texts = [held[i][1] for i in pairs]
        halves = [len(t) // 2 for t in texts]
        edited = [t[: len(t) - h] + held[i + 1][1][:h] for i, t, h in zip(pairs, texts, halves)]
        changed = sketches(edited)
        at = np.asarray(pairs, np.int64)
        own, after = sk[at], sk[at + 1] if len(at) else sk[at]
        columns = [
            pa.array([held[i][0] for i in pairs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(edited, pa.string()),
            pa.array(as_text(own), pa.string()), pa.array(as_text(changed), pa.string()), pa.array(likeness(own, changed)), pa.array(likeness(own, after)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = np.zeros((0, CELLS), np.uint16)
        for b in batches:
            new = list(zip(*[c.to_pylist() for c in b.columns]))
            sk = np.concatenate([last, sketches([r[1] for r in new])])
            held += new
            if held:
                yield finished(held, sk)
                held, last = held[-1:], sk[-1:]

    schema = "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return both.select("id", "text", "bucket", "extra").mapInArrow(run, schema).withColumnRenamed("id", id_col)
