"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of neighbouring lines chooses where chunks of lines begin,
so boundaries move with the content; the more words the lines have, the likelier a boundary
is, so that chunks have about a sentence's words. Longer lines are chunks of their own and
are cut in parts at words that a rolling hash over words chooses, so that a passage inside
a line is found too. Chunks that occur more than once anywhere are found by digest, compared
byte by byte, and all but the first occurrence are removed where they form a passage of
several lines or many words, in which all neighbouring chunks repeat together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.llm.common import attach_once, materialised, portions, shuffle_partitions

#: Words of a chunk of lines: a line of so many or more is cut in parts.
SPACING = 12
#: A part of a long line begins at the least hash of so many words on either side.
NEAR, PERIOD = 4, 12
#: Words that are enough for a chunk or run of chunks to be removed.
LONG = 50
#: Lines with words that a removed run of chunks has at least, unless it has LONG words.
LINES = 2
#: 64-bit words of the filter of repeated chunks: 16 bits a chunk, 2 to 16 MB. Its false positives cost time and disk alone.
FILTER = (1 << 18, 1 << 21)
#: A chunk sets two bits of a word, which its digest gives after these shifts: at 16 bits a chunk 1.7 % of others pass, with one bit 6.1 %.
BITS = (32, 40)
#: Digests that a task gathers before it hands them on, and bytes cut up together; bounds of memory, of a core's cache too.
GATHER, TOGETHER = 1_000_000, 1 << 18
#: Repeated chunks that a bucket has about, if they are many; bytes of a text that weigh like a digest.
BUCKET, BYTES = 50_000, 32
#: Bytes of text, of all rows, whose digests are a bucket at most, where texts repeat little.
TEXT = 128 << 20
#: Bytes of text, of all rows, for each task whose rows become a file; a file starts a helper process of the executor's size on some file systems.
FILE = 16 << 20
MASK = np.uint64((1 << 64) - 1)
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Which bytes are white space (1, others 0); words stand between them.
SPACE = bytes(c in b" \t\n\r\v\f" for c in range(256))
#: Bytes that are hashed at once; bounds the memory of long texts.
BLOCK = 1 << 16


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1) in 64 bits."""
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(0, n - 1), base, np.uint64)]))[:n]


BACK = pow(int(ODD), -1, 1 << 64)
POWER, INVERSE = powers(int(ODD), BLOCK), powers(BACK, BLOCK)
#: What a byte adds to a polynomial hash.
BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)


def prefixes(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The polynomial hash of buf up to each of the ascending places `at`."""
    out, carry, scale = np.zeros(len(at), np.uint64), 0, 1
    for begin in range(0, len(buf), BLOCK):
        block = buf[begin : begin + BLOCK]
        sums = BYTE.take(block)
        sums *= POWER[: len(block)]
        np.cumsum(sums, out=sums)
        a, z = np.searchsorted(at, [begin, begin + len(block)], "right")
        out[a:z] = sums.take(at[a:z] - (begin + 1)) * np.uint64(scale) + np.uint64(carry)
        carry = (carry + int(sums[-1]) * scale) & int(MASK)
        scale = scale * pow(int(ODD), BLOCK, 1 << 64) & int(MASK)
    return out


@dataclass
class Chunks:
    """The chunks of several texts, in order: places in raw, text and line numbers, whether a line begins here, words, lines.

    begin and stop are places without white space around the chunk, key the digest of what stands between.
    """

    raw: bytes
    lo: np.ndarray
    hi: np.ndarray
    doc: np.ndarray
    line: np.ndarray
    head: np.ndarray
    size: np.ndarray
    lines: np.ndarray
    begin: np.ndarray
    stop: np.ndarray
    key: np.ndarray

    def pieces(self, at: np.ndarray) -> list[bytes]:
        """The texts of chunks without white space around them."""
        return [self.raw[a:b] for a, b in zip(self.begin[at].tolist(), self.stop[at].tolist())]


def cut_up(texts: list[bytes]) -> Chunks:
    """Cut texts in chunks of lines and parts of long lines; they hold everything but the line ends between them."""
    raw = b"\n".join(texts)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    buf = np.frombuffer(raw, np.uint8)
    space = np.frombuffer(b"".join([b"\1", raw.translate(SPACE), b"\1"]), bool)
    edges = np.flatnonzero(space[1:] != space[:-1])
    word, word_end, ends = edges[::2], edges[1::2], np.flatnonzero(buf == 10)
    line_at = np.concatenate([[0], ends + 1])
    text_of = np.searchsorted(begins, line_at, "right") - 1
    sums = prefixes(buf, edges)
    to_word, past_word = sums[::2], sums[1::2]
    blocks = np.diff(np.searchsorted(word, np.arange(0, len(buf) + BLOCK, BLOCK)))
    shift = INVERSE.take(word & (BLOCK - 1)) * np.repeat(powers(pow(BACK, BLOCK, 1 << 64), len(blocks)), blocks)
    h = mixed((past_word - to_word) * shift)
    past = np.append(np.searchsorted(word, ends), len(word))
    n = np.diff(past, prepend=0)
    first = past - n
    # chunks of lines; beside a long line any line opens one
    short, whole = n < SPACING, np.where(n < SPACING, n, 0)
    few = np.cumsum(whole)
    place = np.arange(few[-1]) - np.repeat(few - whole, whole)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h[np.repeat(short, n)] + place.astype(np.uint64) * ODD))])
    own = sums[few] - sums[few - whole]
    opens = np.ones(len(line_at), bool)
    chance = (mixed(own[:-1] * ODD + own[1:]) >> np.uint64(40)) & np.uint64(0xFFFF)
    opens[1:] = (chance * np.uint64(SPACING) < np.maximum(n[:-1], n[1:]).astype(np.uint64) << np.uint64(16)) | (text_of[1:] != text_of[:-1])
    heads = np.flatnonzero(opens)
    cut, line_of_cut = parts_of(h, n)
    # all in order of their places
    lo = np.concatenate([line_at[heads], word[cut]])
    order = np.argsort(lo, kind="stable")
    lo, line = lo[order], np.concatenate([heads, line_of_cut])[order]
    words, head = np.concatenate([first[heads], cut])[order], order < len(heads)
    hi = np.append(lo[1:] - head[1:], len(raw))
    lines = np.where(head, np.diff(np.append(line, len(line_at))), 0)
    lines[head] = np.diff(np.append(line[head], len(line_at)))
    of_first = np.searchsorted(text_of, text_of[line])
    size = np.diff(np.append(words, len(word)))
    begin, stop, key, some = lo.copy(), lo.copy(), np.zeros(len(lo), np.uint64), np.flatnonzero(size)
    a, z = words[some], words[some] + size[some] - 1
    begin[some], stop[some], key[some] = word[a], word_end[z], mixed((past_word[z] - to_word[a]) * shift[a])
    return Chunks(raw, lo, hi, text_of[line], line - of_first, head, size, np.maximum(lines, 1), begin, stop, key)


def parts_of(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words inside long lines that parts begin with, and their lines; h has all words' hashes, n each line's words.

    They are those whose hash, rolled with that of the word before, is less than those of the
    NEAR words on either side; the words of other lines don't count. Where words recur within
    NEAR, so that hashes are equal, parts have PERIOD words, which any such recurrence divides.
    """
    lines = np.flatnonzero(n >= SPACING)
    n_long = n[lines]
    end = np.cumsum(n_long)
    first, total = end - n_long, int(n_long.sum())
    if not total:
        return lines, lines
    own = h if total == len(h) else h[np.repeat(n >= SPACING, n)]
    rolled = np.full(total + 2 * NEAR, MASK)
    middle = rolled[NEAR:-NEAR]
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[first] = MASK
    before *= ODD
    before += own
    middle[:] = mixed(before) >> np.uint64(1)
    two = np.minimum(rolled[:-1], rolled[1:])
    four = np.minimum(two[:-2], two[2:])  # the least of NEAR hashes from each on
    left, right = four[:total], four[NEAR + 1 :].copy()
    for k in range(NEAR):  # near a line's ends fewer words count
        left[first + k] = middle[first + k - 1] if k else MASK
        right[end - 1 - k] = middle[end - k] if k else MASK
        if k > 1:
            left[first + k] = np.minimum(left[first + k], left[first + k - 1])
            right[end - 1 - k] = np.minimum(right[end - 1 - k], right[end - k])
    least = (middle <= left) & (middle <= right)
    least[first] = False
    found = np.flatnonzero(least)
    alone = middle[found] < left[found]
    line = np.searchsorted(end, found, "right")
    far = found - first[line]
    ties = np.unique(line[~alone])
    for a, z in zip(np.searchsorted(line, ties).tolist(), np.searchsorted(line, ties, "right").tolist()):
        last = 0
        for k in range(a, z):
            if alone[k] or far[k] - last >= PERIOD:
                last, alone[k] = far[k], True
    line, far = line[alone], far[alone]
    line = lines[line]
    return (np.cumsum(n) - n)[line] + far, line


def pieces(text: str) -> list[str]:
    """The texts of the chunks that have words; their numbers are those that the functions below speak of."""
    c = cut_up([text.encode("utf-8", "surrogatepass")])
    return [p.decode("utf-8", "surrogatepass") for p in c.pieces(np.flatnonzero(c.size))]


def without(text: str, repeated: set[int], joined: set[int] | None = None) -> tuple[str, int, int]:
    """The text without its removed chunks, its number of lines, and of lines that went or lost a part; see shortened()."""
    numbers = [None if x is None else np.asarray(sorted(x), np.int64) for x in (repeated, joined)]
    [(left, removed)] = shortened([text.encode("utf-8", "surrogatepass")], *([x] for x in numbers))
    return left.decode("utf-8", "surrogatepass"), text.count("\n") + 1, removed


def shortened(texts: list[bytes], repeated: list[np.ndarray], joined: list[np.ndarray | None]) -> Iterator[tuple[bytes, int]]:
    """Each text without its removed chunks, and how many lines went or lost a part.

    A run of repeated chunks goes if it has LONG words; of a shorter one, LINES or more whole lines
    with words go. `joined`: chunks that repeat together with the one before them, as those of a
    run must; None is all. Blank chunks go with both their neighbours."""
    for at, to in together(texts):
        yield from shortened_at_once(cut_up(texts[at:to]), repeated[at:to], joined[at:to])


def shortened_at_once(c: Chunks, repeated: list[np.ndarray], joined: list[np.ndarray | None]) -> Iterator[tuple[bytes, int]]:
    """shortened() of the texts of c."""
    ends = np.searchsorted(c.doc, np.arange(len(repeated) + 1)).tolist()
    for first, end, again, side, some in zip(ends, ends[1:], repeated, joined, with_runs(c, repeated, joined)):
        if not some:
            yield c.raw[c.lo[first] : c.hi[end - 1]], 0
            continue
        size, line, head, lines, lo, hi = (x[first:end] for x in (c.size, c.line, c.head, c.lines, c.lo, c.hi))
        worded, gone = np.flatnonzero(size), np.zeros(end - first, bool)
        rep, near = np.zeros(len(worded), bool), np.full(len(worded), side is None)
        rep[again] = True
        if side is not None:
            near[side] = True
        starts = rep.copy()
        starts[1:] &= ~(rep[:-1] & near[1:])
        chunk, run = worded[rep], np.cumsum(starts[rep]) - 1
        words, whole = np.bincount(run, size[chunk]), np.bincount(run, lines[chunk] * head[chunk])
        gone[chunk[words[run] >= LONG]] = True
        parts = None
        for r in np.flatnonzero((words < LONG) & (whole >= LINES)).tolist():
            own = chunk[slice(*np.searchsorted(run, [r, r + 1]))]
            parts = np.bincount(line[worded]) if parts is None else parts
            own = own[np.bincount(line[own], minlength=len(parts))[line[own]] == parts[line[own]]]
            if sum(bool(x.strip()) for i in own[head[own]].tolist() for x in c.raw[lo[i] : hi[i]].split(b"\n")) >= LINES:
                gone[own] = True
        if not gone.any():
            yield c.raw[lo[0] : hi[-1]], 0
            continue
        for i in np.flatnonzero(gone[worded[:-1]] & gone[worded[1:]] & (np.diff(worded) > 1)).tolist():
            gone[worded[i] : worded[i + 1]] = True
        edges = np.flatnonzero(np.diff(~gone, prepend=False, append=False))
        a, z = edges[::2], edges[1::2]
        block = np.cumsum(head)
        open_ = np.zeros(len(a), bool)
        open_[1:] = block[a[1:]] == block[z[:-1] - 1]  # what stood before in this line stays too
        kept = [(b"" if o or not k else b"\n") + c.raw[x:y] for k, (o, x, y) in enumerate(zip(open_.tolist(), lo[a].tolist(), hi[z - 1].tolist()))]
        yield b"".join(kept), int(lines[np.flatnonzero(gone)[np.unique(line[gone], return_index=True)[1]]].sum())


def with_runs(c: Chunks, repeated: list[np.ndarray], joined: list[np.ndarray | None]) -> list[bool]:
    """Which texts of c have a run of repeated chunks that has the words or lines to go; see shortened()."""
    worded = np.flatnonzero(c.size)
    doc = c.doc[worded]
    ends = np.searchsorted(doc, np.arange(len(repeated) + 1))
    rep, near = np.zeros(len(worded), bool), np.repeat([x is None for x in joined], np.diff(ends))
    for mark, numbers in ((rep, repeated), (near, joined)):
        given = [x + a for x, a in zip(numbers, ends.tolist()) if x is not None]
        mark[np.concatenate(given or [ends[:0]])] = True
    near[ends[:-1][ends[:-1] < ends[1:]]] = False
    starts = rep.copy()
    starts[1:] &= ~(rep[:-1] & near[1:])
    chunk, run = worded[rep], np.cumsum(starts[rep]) - 1
    far = (np.bincount(run, c.size[chunk]) >= LONG) | (np.bincount(run, c.lines[chunk] * c.head[chunk]) >= LINES)
    out = np.zeros(len(repeated), bool)
    out[doc[starts][far]] = True
    return out.tolist()


def together(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Where the texts are divided, so that those cut up at once are one or have TOGETHER bytes at most."""
    at = 0
    while at < len(texts):
        to, held = at + 1, len(texts[at])
        while to < len(texts) and held + len(texts[to]) <= TOGETHER:
            held += len(texts[to])
            to += 1
        yield at, to
        at = to


def cut_portions(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, Chunks, np.ndarray, np.ndarray]]:
    """(rows, chunks of their texts, those with words, their digests) of batches without null texts, a bounded number at once."""
    for b in portions(batches):
        texts = b.column(column).cast(pa.binary()).to_pylist()
        for at, to in together(texts):
            c = cut_up(texts[at:to])
            worded = np.flatnonzero(c.size)
            yield b.slice(at, to - at), c, worded, c.key[worded]


def repeated_digests(rows: DataFrame, buckets: int) -> DataFrame:
    """(key) of all chunk digests that occur more than once in rows (text).

    Tasks hand on their distinct digests packed by bucket; those that repeat within a task are
    marked, so a chunk that very many rows have is one number for each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held or [np.zeros(0, np.uint64)]), return_counts=True)
            held.clear()
            cols: list[list] = [[], [], []]
            for again in (False, True):
                own = keys[n > 1] if again else keys
                bucket = (own >> np.uint64(20)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                own, bucket = own[order], bucket[order]
                for a, z in zip(ends := np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(own) else [], [*ends[1:], len(own)]):
                    for col, v in zip(cols, (int(bucket[a]), own[a:z].tobytes(), again)):
                        col.append(v)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.binary(), pa.bool_()))], names=["bucket", "keys", "again"])

        for _, _, _, keys in cut_portions(batches, "text"):
            held.append(keys)
            if sum(map(len, held)) > GATHER:
                yield out()
        yield out()

    def again(table: pa.Table) -> pa.Table:
        once, twice = [], [np.zeros(0, np.uint64)]
        for k, marked in zip(table.column("keys").to_pylist(), table.column("again").to_pylist()):
            (twice if marked else once).append(np.frombuffer(k, np.uint64))
        keys, n = np.unique(np.concatenate(once), return_counts=True)
        found = np.union1d(keys[n > 1], np.concatenate(twice))
        return pa.table({"key": pa.array(found.view(np.int64))})

    packed = rows.select("text").mapInArrow(run, "bucket long, keys binary, again boolean")
    return packed.groupBy("bucket").applyInArrow(again, "key long")


def filter_of(again: DataFrame) -> np.ndarray:
    """The filter: two bits for each key, set by Spark in 64-bit words; the driver gets FILTER[1] words at most."""
    low, high = FILTER
    while low < high and low * 4 < again.count():
        low *= 2
    one, two = (F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned("key", k), F.lit(64)).cast("int")) for k in BITS)
    words = again.groupBy(F.pmod("key", F.lit(low)).alias("w")).agg(F.bit_or(one.bitwiseOR(two)).alias("bits")).toPandas()
    table = np.zeros(low, np.int64)
    table[words["w"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return table.view(np.uint64)


def passed(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which digests pass the filter: all that repeat, and a few others."""
    words = table.take((keys % np.uint64(len(table))).astype(np.int64))
    one, two = (words >> ((keys >> np.uint64(k)) % np.uint64(64)) for k in BITS)
    return (one & two & np.uint64(1)).astype(bool)


def passing(rows: DataFrame, bits: Callable[[], np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]:
    """Of batches of rows (id, digest, text), in portions: (rows, chunks, numbers of those that pass the filter, their
    keys, the key of the chunk before if that passes too, masked otherwise, their rows, their numbers among chunks with words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        table = bits()
        for b, c, worded, keys in cut_portions(batches, "text"):
            hit = passed(table, keys)
            doc, keep = c.doc[worded], np.flatnonzero(hit)
            begin = np.searchsorted(doc, np.arange(b.num_rows))
            no, signed = (np.arange(len(doc)) - begin[doc]).astype(np.int32)[keep], keys.view(np.int64)
            if len(keep):
                before = np.ma.masked_array(signed[keep - 1], (no == 0) | ~hit[keep - 1])
                yield b, c, worded[keep], signed[keep], before, doc[keep], no

    return run


def occurrences(rows: DataFrame, bits: Callable[[], np.ndarray]) -> DataFrame:
    """The chunks of rows (id, digest, text) that pass the filter, in arrays by row: (id, digest, no, key, before)."""
    each = passing(rows, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, _, key, before, doc, no in each(batches):
            n = np.bincount(doc, minlength=b.num_rows)
            some = np.flatnonzero(n)
            ends = pa.array(np.concatenate([[0], np.cumsum(n[some])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, v) for v in (pa.array(no), pa.array(key), pa.array(before.data, mask=before.mask))]
            yield pa.RecordBatch.from_arrays([*[b.column(x).take(pa.array(some)) for x in ("id", "digest")], *lists], names=["id", "digest", "no", "key", "before"])

    return rows.select("id", "digest", "text").mapInArrow(run, "id long, digest long, no array<int>, key array<long>, before array<long>")


#: What is counted of chunks and of neighbours: their keys, the place of the first, how many there are.
COUNTED = {"key": pa.int64(), "before": pa.int64(), "id": pa.int64(), "mark": pa.int32(), "no": pa.int32(), "n": pa.int64()}


def firsts(what: list[np.ndarray], rows: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Rows of COUNTED alike in `what` as one, that of the first place with the sum of n; and where in rows that stood."""
    order = np.lexsort((rows["no"], rows["mark"], rows["id"], *what))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in what:
        new[1:] |= x[order][1:] != x[order][:-1]
    at = np.flatnonzero(new)
    out = {k: v[order][at] for k, v in rows.items()}
    out["n"] = np.add.reduceat(rows["n"][order], at) if len(at) else out["n"]
    return out, order[at]


def counted(rows: DataFrame, bits: Callable[[], np.ndarray], buckets: int) -> DataFrame:
    """(key, before, id, mark, no, n) of chunks that repeat and have one text, before null, and of neighbours that repeat.

    id, mark and no are the first place; the mark is the upper half of the text's digest. Tasks count what they read and hand it on packed by
    bucket, chunks by their key and with their text, neighbours by both keys, so that no bucket
    gets more than a few rows a task of a chunk that very many rows have.
    """
    each = passing(rows, bits)
    names = list(COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[dict[str, np.ndarray], np.ndarray, list[bytes]]] = []

        def out() -> Iterator[pa.RecordBatch]:
            all_rows = {k: np.concatenate([h[0][k] for h in held]) for k in names}
            alone = np.concatenate([h[1] for h in held])
            texts = pa.array([t for h in held for t in h[2]], pa.binary())
            held.clear()
            code = texts.dictionary_encode().indices.to_numpy()
            chunks, at = firsts([code], all_rows)
            pairs, _ = firsts([all_rows["before"][~alone], all_rows["key"][~alone]], {k: v[~alone] for k, v in all_rows.items()})
            for what, chunk in ((chunks, texts.take(pa.array(at))), (pairs, None)):
                by = what["key"] if chunk is not None else mixed((what["key"].view(np.uint64) + what["before"].view(np.uint64) * ODD)).view(np.int64)
                bucket = (by.view(np.uint64) >> np.uint64(20)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                ends = np.append(np.flatnonzero(np.diff(bucket[order], prepend=np.uint64(buckets))), len(order)).astype(np.int32)
                lists = {k: pa.ListArray.from_arrays(ends, pa.array(what[k][order], t)) for k, t in COUNTED.items()}
                if chunk is not None:
                    lists["before"] = pa.nulls(len(ends) - 1, pa.list_(pa.int64()))
                own = pa.ListArray.from_arrays(ends, chunk.take(pa.array(order))) if chunk is not None else pa.nulls(len(ends) - 1, pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[order][ends[:-1]].astype(np.int64)), *lists.values(), own], names=["bucket", *names, "chunk"])

        size = 0
        for b, c, at, key, before, doc, no in each(batches):
            own = [b.column("id").to_numpy(zero_copy_only=False)[doc], (b.column("digest").to_numpy(zero_copy_only=False)[doc] >> 32).astype(np.int32)]
            held.append((dict(zip(names, (key, before.data, *own, no, np.ones(len(no), np.int64)))), np.ma.getmaskarray(before), c.pieces(at)))
            size += len(at) + int((c.stop[at] - c.begin[at]).sum()) // BYTES
            if size > GATHER:
                yield from out()
                size = 0
        if held:
            yield from out()

    def again(table: pa.Table) -> pa.Table:
        def flat(part: pa.Table, of: list[str] = names) -> dict[str, np.ndarray]:
            return {k: part.column(k).combine_chunks().flatten().to_numpy() for k in of}

        with_text = table.filter(table.column("chunk").is_valid())
        texts = with_text.column("chunk").combine_chunks().flatten()
        chunks, _ = firsts([texts.dictionary_encode().indices.to_numpy()], flat(with_text, [k for k in names if k != "before"]))
        _, which, same = np.unique(chunks["key"], return_inverse=True, return_counts=True)
        one = (same[which] == 1) & (chunks["n"] > 1)
        pairs = flat(table.filter(table.column("chunk").is_null()))
        pairs, _ = firsts([pairs["before"], pairs["key"]], pairs)
        more = pairs["n"] > 1
        cols = {k: np.concatenate([chunks.get(k, chunks["key"])[one], pairs[k][more]]) for k in names}
        none = np.arange(len(cols["n"])) < one.sum()
        return pa.table({k: pa.array(v, COUNTED[k], mask=none if k == "before" else None) for k, v in cols.items()})

    kinds = {pa.int64(): "long", pa.int32(): "int"}
    packed = ", ".join(f"{k} array<{kinds[t]}>" for k, t in COUNTED.items())
    packed = rows.select("id", "digest", "text").mapInArrow(run, f"bucket long, {packed}, chunk array<binary>")
    return packed.groupBy("bucket").applyInArrow(again, ", ".join(f"{k} {kinds[t]}" for k, t in COUNTED.items()))


def in_files(df: DataFrame, held: int) -> DataFrame:
    """df in no more partitions than so many bytes of text and all cores are worth."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, held // FILE))


def repeated_chunks(df: DataFrame, held: int) -> DataFrame:
    """(id, digest, no, joined) of the occurrences of df's chunks (id, digest, text) but the first of each repeated chunk, confirmed byte by byte; held: the texts' bytes.

    The first has the smallest id, then digest of the text, then number. Several texts of one id
    have chunks of their own. Digests find what repeats; of chunks that pass a filter texts are
    compared. Should different chunks share a digest, they all stay; so do first places of two texts of one
    id whose digests agree in their upper halves. joined: the chunk and the one before it stand
    together elsewhere too, and not here first.
    """
    own = ["id", "digest"]
    rows = df.where("id is not null and text is not null")
    parts = max(4 * shuffle_partitions(df), held // TEXT)  # a bucket of digests stays small, whatever the session's setting
    again = materialised(in_files(repeated_digests(rows, parts), held))
    shared = df.sparkSession.sparkContext.broadcast(filter_of(again))
    bits = lambda: shared.value
    here = F.struct("id", F.shiftright("digest", 32).cast("int").alias("mark"), "no")
    counts = materialised(in_files(counted(rows, bits, max(parts, again.count() // BUCKET)), held))
    counts = counts.select("key", "before", "n", F.struct("id", "mark", "no").alias("first"))
    groups, joints = counts.where("before is null").drop("before"), counts.where("before is not null")
    # what is counted nowhere stands once, so these sums bound what a common key has
    of_groups, of_joints = (x.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for x in (groups, joints))
    found = occurrences(rows, bits).select(*own, F.inline(F.arrays_zip("no", "key", "before")))
    place = F.xxhash64(*own, "no")
    later = attach_once(found, groups, ["key"], "n", of_groups, place).where(here != F.col("first")).drop("first")
    # a chunk without one before it is like no joint of its key; this deals such rows evenly
    later = later.withColumns({"alone": F.col("before").isNull(), "before": F.coalesce("before", place)})
    later = attach_once(later, joints, ["before", "key"], "n", of_joints, place)
    return later.select(*own, "no", (~F.col("alone") & F.coalesce(here != F.col("first"), F.lit(False))).alias("joined"))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, text, n_lines, removed_lines): each row of df as a struct beside its text without repeated passages.

    One occurrence of every passage stays: that in the smallest id. A null text stays null, with
    no lines; an empty text has one empty line. Rows without id are left as they are. Rows that
    repeat an id with the same text count as one document and get the same result; with
    different texts they are documents of their own. df's columns may have any names, and come
    back unchanged in the struct.
    """
    key = [F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("digest")]
    held = df.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    later = repeated_chunks(df.select(*key, F.col(text_col).alias("text")), held).groupBy("id", "digest")
    later = later.agg(F.collect_set(F.col("no") * 2 + F.col("joined").cast("int")).alias("gone"))  # a number and whether it is joined
    whole = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), *key)
    whole = whole.join(later, ["id", "digest"], "left").select("row", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            row, gone = b.columns
            texts = row.field(text_col).cast(pa.string())
            lines = pc.add(pc.fill_null(pc.count_substring(texts, "\n"), -1), 1).cast(pa.int64())
            removed = np.zeros(b.num_rows, np.int64)
            hit = pc.and_(gone.is_valid(), texts.is_valid())
            if (at := np.flatnonzero(hit.to_numpy(zero_copy_only=False))).size:
                again = [np.sort(x.values.to_numpy()) for x in gone.filter(hit)]
                made = list(shortened(texts.cast(pa.binary()).filter(hit).to_pylist(), [x >> 1 for x in again], [x[x & 1 > 0] >> 1 for x in again]))
                texts = pc.replace_with_mask(texts, hit, pa.array([m[0] for m in made], pa.binary()).cast(pa.string()))
                removed[at] = [m[1] for m in made]
            yield pa.RecordBatch.from_arrays([row, texts, lines, pa.array(removed)], names=["row", "text", "n_lines", "removed_lines"])

    schema = T.StructType([whole.schema["row"]]).add("text", "string").add("n_lines", "long").add("removed_lines", "long")
    return in_files(whole.mapInArrow(run, schema), held)
