"""Alignment of two tokenizers' tokens over the same bytes.

Token ends are marked in packed bitsets over the bytes of a batch of texts, one bitset for
each tokenizer. Their AND holds the cuts where tokens of both end; the number of marks
before a cut (popcounts of whole words, and of one word's lower bits) is the number of
tokens that end there, so it gives the token ranges of the group between two cuts. Each mark
of their OR ends the overlap of one token of each: these are the links.

Link counts over all documents are summed in tasks first. The most frequent pairs are held
by every task; what is left of each document's pairs is joined with their counts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.bpe import SPLIT, Codec
from silverloom.llm.common import map_texts, materialised, portions

#: Pairs whose counts every task holds, and distinct pairs that a task gathers before it hands their counts on; bounds of memory.
HELD, GATHER = 1 << 21, 1 << 22
#: White space that the faster encoder isn't given: its pattern matcher has a stack of its own.
BLANK = re.compile(r"\s{5000}")


class Groups(NamedTuple):
    """A batch's groups and links. Docs are the batch's texts; starts have one more entry than texts."""

    group_start: np.ndarray  # first group of each text
    byte: np.ndarray  # byte after each group, counted over the batch
    a: np.ndarray  # tokens of A up to each group's end, counted over the batch
    b: np.ndarray
    link_start: np.ndarray  # first link of each text
    link_a: np.ndarray  # the token of A of each link, counted over the batch
    link_b: np.ndarray


class Marks:
    """A packed bitset with the rank of any place."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def at(cls, places: np.ndarray, n: int) -> Marks:
        flags = np.zeros(-(-(n + 1) // 64) * 64, bool)
        flags[places] = True
        return cls(np.packbits(flags, bitorder="little").view("<u8"))

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Marks before each place."""
        word = places >> 6
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def select(self) -> np.ndarray:
        """All marked places, in order."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


def grouped(sizes_a: np.ndarray, sizes_b: np.ndarray, n_a: np.ndarray) -> Groups:
    """Groups and links of texts of n_a tokens of A each; the sizes are the tokens' bytes, alike in sum for each text."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    n = int(ends_a[-1]) if len(ends_a) else 0
    a, b = Marks.at(ends_a - 1, n), Marks.at(ends_b - 1, n)
    shared, either = Marks(a.words & b.words), Marks(a.words | b.words)
    cuts, marks = shared.select(), either.select()
    text_ends = np.concatenate([[0], ends_a])[np.concatenate([[0], np.cumsum(n_a)])]
    return Groups(shared.rank(text_ends), cuts + 1, a.rank(cuts) + 1, b.rank(cuts) + 1, either.rank(text_ends), a.rank(marks), b.rank(marks))


class Two:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        codec = Codec(a_path)
        by_rank = [new for _, new in sorted(codec.ranks.values())]
        if by_rank != sorted(by_rank) or codec.split.pattern != SPLIT:
            raise ValueError(f"{a_path}: merges aren't in the order of their ids")
        plain = {b: i for b, i in codec.ids.items() if i not in codec.added.values()}
        self.fast = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=plain, special_tokens={})
        self.any = Tokenizer.from_file(a_path)
        self.any.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.n_b = self.b.get_piece_size()
        self.bytes_a = [b""] * (max(plain.values()) + 1)
        for data, i in plain.items():
            self.bytes_a[i] = data
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        self.size_a, self.size_b = (np.asarray([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        digits = len(str(max(len(self.bytes_a), self.n_b)))
        #: Ids with what follows them in a description: by tokenizer, then in or at the end of a group.
        self.written = [[np.asarray([f"{i}{after}" for i in range(n)], f"S{digits + 1}") for after in ends] for n, ends in ((len(self.bytes_a), ",|"), (self.n_b, ",;"))]

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids by A of a space and the text, and by B of the text, which adds the space. None if the text is empty or the bytes differ from space and text."""
        if not text:
            return [], []
        full = " " + text
        a = self.any.encode(full, add_special_tokens=False).ids if BLANK.search(text) else self.fast.encode_ordinary(full)
        b = self.b.encode(text)
        data = full.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != data or b"".join(map(self.bytes_b.__getitem__, b)) != data:
            return [], []
        return a, b

    def align(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Groups]:
        """(A's ids, B's ids, and how many of each text, groups) of a batch."""
        found = [self.encode(t) for t in texts]
        n_a, n_b = (np.asarray([len(f[k]) for f in found], np.int64) for k in (0, 1))
        a, b = (np.concatenate([np.empty(0, np.int64), *(np.asarray(f[k], np.int64) for f in found)]) for k in (0, 1))
        return a, b, n_a, n_b, grouped(self.size_a[a], self.size_b[b], n_a)

    def descriptions(self, a: np.ndarray, b: np.ndarray, n: np.ndarray, g: Groups) -> list[bytes]:
        """'a1,a2|b1;a3|b2,b3' of each text of n tokens: the ids of its groups in order."""
        groups = np.arange(len(g.a))
        of_a, of_b = (np.repeat(groups, np.diff(x, prepend=0)) for x in (g.a, g.b))
        line = np.empty(len(a) + len(b), self.written[0][0].dtype if self.written[0][0].itemsize >= self.written[1][0].itemsize else self.written[1][0].dtype)
        for ids, mine, others, own, ends in ((a, of_a, np.concatenate([[0], g.b]), self.written[0], g.a), (b, of_b, g.a, self.written[1], g.b)):
            last = np.zeros(len(ids), bool)
            last[ends - 1] = True
            line[np.arange(len(ids)) + others[mine]] = np.where(last, own[1][ids], own[0][ids])
        ends = np.concatenate([[0], np.cumsum(n)])
        return [line[lo:hi].tobytes().replace(b"\0", b"")[:-1] for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]


@lru_cache(maxsize=1)
def two(a_path: str, b_path: str) -> Two:
    """Both tokenizers once per worker; the files must be at the same place on all machines."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Two(a_path, b_path)


def packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted distinct pairs and how often each occurs, as differences in byte planes, compressed."""
    planes = np.concatenate([np.diff(pairs, prepend=0).astype("<u4"), times.astype("<u4")]).view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, -1)
    values = np.ascontiguousarray(planes.T).view("<u4").ravel()
    return np.cumsum(values[:n], dtype=np.int64), values[n:].astype(np.int64)


def alignments(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, group, start, end, a, b): each group of each row, its bytes in space and text and the ids of both tokenizers.

    Rows with null or empty texts, or whose tokens don't give back the text, have no groups; repeated rows are aligned alike.
    """

    def make(texts: list[str]) -> tuple[list[int], list]:
        a, b, n_a, _, g = two(a_path, b_path).align(texts)
        doc = np.repeat(np.arange(len(texts)), np.diff(g.group_start))
        first = g.group_start[doc]
        starts = [np.concatenate([[0], x])[:-1] for x in (g.byte, g.a, g.b)]
        base = starts[0][first] if len(doc) else first
        parts = [[ids[lo:hi].tolist() for lo, hi in zip(s.tolist(), e.tolist())] for ids, s, e in ((a, starts[1], g.a), (b, starts[2], g.b))]
        return doc.tolist(), [(np.arange(len(doc)) - first).tolist(), (starts[0] - base).tolist(), (g.byte - base).tolist(), *parts]

    return map_texts(df, [id_col], text_col, {"group": "int", "start": "long", "end": "long", "a": "array<int>", "b": "array<int>"}, make)


def tokenised(df: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, n_pairs, pairs) of every row; pairs as packed() makes them, a pair is A's id x B's vocabulary + B's id."""

    def make(texts: list[str]) -> tuple[None, list]:
        own = two(a_path, b_path)
        a, b, n_a, n_b, g = own.align(texts)
        links = a[g.link_a] * own.n_b + b[g.link_b]
        n_pairs, data = [], []
        for lo, hi in zip(g.link_start[:-1].tolist(), g.link_start[1:].tolist()):
            pairs, times = np.unique(links[lo:hi], return_counts=True)
            n_pairs.append(len(pairs))
            data.append(packed(pairs, times) if len(pairs) else b"")
        described = [hashlib.sha256(d).hexdigest() if n else "" for d, n in zip(own.descriptions(a, b, n_a + n_b, g), n_a.tolist())]
        return None, [n_a.tolist(), n_b.tolist(), np.diff(g.group_start).tolist(), np.diff(g.link_start).tolist(), described, n_pairs, data]

    fields = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string", "n_pairs": "long", "pairs": "binary"}
    return map_texts(df, [id_col], text_col, fields, make)


def pair_counts(docs: DataFrame) -> DataFrame:
    """(pair, n): in how many rows each pair is linked. Summed in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, size = (np.empty(0, np.int64), np.empty(0, np.int64)), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new, times = np.unique(np.concatenate(waiting), return_counts=True) if waiting else held
            waiting.clear()
            pairs, at = np.unique(np.concatenate([held[0], new]), return_inverse=True)
            return pairs, np.bincount(at, np.concatenate([held[1], times]), len(pairs)).astype(np.int64)

        for b in portions(batches):
            for data, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                waiting.append(unpacked(data, n)[0])
                size += n
                if size > GATHER:
                    held, size = merged(), 0
                    if len(held[0]) > GATHER:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["pair", "n"])
                        held = (np.empty(0, np.int64), np.empty(0, np.int64))
        held = merged() if waiting else held
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["pair", "n"])

    return docs.select("pairs", "n_pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = HELD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, n, best) of the most frequent pairs, sorted by pair: at most `most`, and all of some count or more; whole steps of about one in ten."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sums = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    taken, least = 0, None
    for s, n in sums:
        if taken + n > most:
            break
        taken, least = taken + n, s
    got = counts.where(step >= (1 << 30 if least is None else least)).select("pair", "n", "best").toPandas().sort_values("pair")
    return got["pair"].to_numpy(np.int64), got["n"].to_numpy(np.int64), got["best"].to_numpy(bool)


def link(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A pair's count is the number of rows that have it linked; n_best counts links whose pair has
    its A id's greatest count, count_sum adds the counts of all links. Rows without tokens (null
    or empty text, or tokens that don't give back the text) have zeros and an empty digest.
    Repeated rows count each; extra columns are ignored; an empty table gives no rows.

    Only pairs of more than one row have a row in the counts; any other pair counts once. A's ids
    with such pairs are at most its vocabulary, so their greatest counts are broadcast. Pairs
    that no task holds are rare, so the join with their counts has no hot key.
    """
    docs = materialised(tokenised(df, a_path, b_path, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    n_b = two(a_path, b_path).n_b
    counts = materialised(pair_counts(docs).where("n > 1").withColumn("a", F.floor(F.col("pair") / n_b).cast("int")))
    tops = counts.groupBy("a").agg(F.max("n").alias("top"))
    counts = counts.join(F.broadcast(tops), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    more = np.zeros(len(two(a_path, b_path).bytes_a), bool)  # A's ids with a pair of more than one row
    more[[r.a for r in tops.select("a").collect()]] = True
    shared = df.sparkSession.sparkContext.broadcast((*frequent(counts), more))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, best, more = shared.value
        for b in portions(batches):
            found = [unpacked(d, k) for d, k in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            rows = b.column(0).to_numpy()
            doc = np.repeat(np.arange(len(rows)), [len(p) for p, _ in found])
            pairs, times = (np.concatenate([np.empty(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
            order = np.argsort(pairs, kind="stable")  # places are looked up in order
            at = np.empty(len(pairs), np.int64)
            at[order] = np.searchsorted(held, pairs[order])
            at = np.minimum(at, max(0, len(held) - 1))
            known = held[at] == pairs if len(held) else np.zeros(len(pairs), bool)
            k, rare = np.flatnonzero(known), np.flatnonzero(~known)
            sums = [np.bincount(doc[k], w, len(rows)).astype(np.int64) for w in (times[k] * best[at[k]], times[k] * n[at[k]])]
            none = np.zeros(len(rare), np.int64)
            columns = [
                np.concatenate([rows, rows[doc[rare]]]), np.concatenate([-1 - rows, pairs[rare]]), np.concatenate([np.zeros(len(rows), np.int64), times[rare]]),
                np.concatenate([sums[0], none]), np.concatenate([sums[1], none]), np.concatenate([np.zeros(len(rows), bool), ~more[pairs[rare] // n_b]]),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "pair", "times", "n_best", "count_sum", "alone"])

    found = docs.select("row", "pairs", "n_pairs").mapInArrow(look, "row long, pair long, times long, n_best long, count_sum long, alone boolean")
    found = found.join(counts, "pair", "left")
    sums = found.groupBy("row").agg(
        F.sum(F.col("n_best") + F.when(F.coalesce("best", "alone"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("count_sum") + F.col("times") * F.coalesce("n", F.lit(1))).alias("count_sum"),
    )
    return docs.join(sums, "row").select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
