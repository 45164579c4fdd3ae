"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become pieces of at most `limit` tokens. Pieces are dealt evenly to shards;
each shard is packed by best fit and then improved by a swap-based local search, which
moves and exchanges pieces between underfull bins so that the squared fill grows until
bins are empty. The bins that stay open in the shards are packed again together.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable
from functools import lru_cache
from struct import pack as pack_ints

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.llm.bpe import byte_alphabet
from silverloom.llm.common import map_texts, materialised

#: Pieces of a shard: enough that the one open bin a shard may leave doesn't count.
SHARD = 16_384
#: Words of a generation that a worker remembers, and their characters at most; bounds of memory, results don't depend on them.
CACHE, KEPT = 250_000, 64
#: Code points below this one are the same kind of character in all Unicode versions.
LATIN = "\u0250"
#: Pairs of bins that the local search looks at for each item before it stops.
EFFORT = 64


class Remembered(dict):
    """Values of a function by its argument, in two generations of CACHE entries at most.

    When the newer one is full it becomes the older one; what is still in use moves over.
    """

    def __init__(self, make: Callable[[str], bytes]) -> None:
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > KEPT:
            return value
        if len(self) >= CACHE:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordIds:
    """Token ids of texts by the tokenizers library, each word encoded once while remembered.

    For vocabularies that normalise a text, cut it by one pattern and encode each match on
    its own. `CUT` must be the file's pattern. A match of Latin text goes to the library's
    model in the printable spelling of its bytes; others go through the whole library, since
    Unicode versions differ on what a letter is. No match holds white space, so ids are first
    looked up by what stands between white space, and only what is new there is cut.
    """

    #: The file's split pattern.
    CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        own = self.tok.pre_tokenizer.__getstate__().decode()
        if json.loads(own)["pretokenizers"][0].get("pattern") != {"Regex": self.CUT}:
            raise ValueError(f"{path}: texts are not cut by {self.CUT}")
        self.cut = regex.compile(self.CUT)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        #: Planes where Unicode versions differ on what a letter is: the library takes the whole text.
        self.beyond = regex.compile("[\U00011000-\U0010ffff]")
        #: Control characters that Python takes for white space and the pattern doesn't.
        self.odd = regex.compile("[\x1c-\x1f]")
        self.spelled = {b: ord(c) for c, b in byte_alphabet().items()}
        self.known = Remembered(self.of_part)

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if any(s in text for s in self.added) or self.odd.search(text) or not text.isascii() and self.beyond.search(text):
            return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, text.split()))

    def of_part(self, part: str) -> bytes:
        """Ids of a text without white space. A match of the pattern is the same alone as beside others."""
        if part.isascii() or max(part) < LATIN:  # these stay as they are but for case
            lowered = part.lower()
            if lowered.isalpha():
                return self.of_match(part) if lowered == part else self.known[lowered]
            if lowered[-1] in ".,;:!?" and lowered[:-1].isalpha():
                return self.known[lowered[:-1]] + self.known[lowered[-1]]
        else:
            lowered = self.tok.normalizer.normalize_str(part)
        matches = self.cut.findall(lowered)
        return self.of_match(part) if matches == [part] else b"".join([self.known[m] if max(m) < LATIN else self.of_match(m) for m in matches])

    def of_match(self, word: str) -> bytes:
        if max(word) < LATIN:
            as_bytes = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.spelled)
            ids = [t.id for t in self.model.tokenize(as_bytes)]
        else:
            ids = self.tok.encode(word, add_special_tokens=False).ids
        return pack_ints(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordIds(path)


def pieces(df: DataFrame, path: str, limit: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every row, ids followed by the end id.

    A null text is empty and gives one piece with the end id. Only documents of more than
    `limit` ids are cut. Narrow: no shuffle; the ids themselves stay in the task.
    """
    tail = np.asarray([end_id], "<u4").tobytes()

    def make(texts: list[str]) -> tuple[list[int], list]:
        own, rows, out = word_ids(path), [], []
        for i, text in enumerate(texts):
            data = own(text) + tail
            for k, at in enumerate(range(0, len(data), 4 * limit)):
                part = data[at : at + 4 * limit]
                rows.append(i)
                out.append((k, k * limit, len(part) // 4, zlib.crc32(part)))
        return rows, list(zip(*out)) or [[]] * 4

    return map_texts(df, [id_col], text_col, {"piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}, make)


def fewest(sizes: list[int], limit: int) -> int:
    """A lower bound of the bins: for each size k up to half a bin, items of more than limit - k are alone with what is
    smaller than k, those above half a bin are in bins of their own, and only what these leave takes up the rest from k on."""
    s = np.sort(np.asarray(sizes, np.int64))
    total = np.concatenate([[0], np.cumsum(s)])
    half = np.searchsorted(s, limit // 2, "right")
    k = np.concatenate([[0], np.unique(s[:half])])
    alone, low = np.searchsorted(s, limit - k, "right"), np.searchsorted(s, k, "left")
    alone = np.maximum(alone, half)
    free = (alone - half) * limit - (total[alone] - total[half])
    more = -(-(total[half] - total[low] - free) // limit)
    return int((len(s) - half + np.maximum(0, more)).max())


def best_fit(sizes: list[int], limit: int) -> list[list[int]]:
    """Bins (lists of item numbers) by best fit over decreasing sizes."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(limit + 1)]  # bins by room left
    rooms: list[int] = []  # the rooms that occur, in order
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(rooms, sizes[i])
        if at < len(rooms):
            room = rooms[at]
            b = with_room[room].pop()
            if not with_room[room]:
                del rooms[at]
        else:
            b, room = len(bins), limit
            bins.append([])
        bins[b].append(i)
        room -= sizes[i]
        if room:
            if not with_room[room]:
                insort(rooms, room)
            with_room[room].append(b)
    return bins


def local_search(bins: list[list[int]], sizes: list[int], limit: int) -> list[list[int]]:
    """Fewer bins by moves and exchanges that increase the sum of squared fills.

    A bin gives to fuller ones, the emptiest bin first: an item moves to the fullest bin with
    room for it; or it is exchanged for one or two smaller items of a fuller bin; or two of
    its items for one. Each step raises the squared fill (the fuller bin gains what the
    emptier loses), so the search ends; a bin that has given all is dropped. It stops when the
    bins are as few as the sizes allow, when no bin can give anything more, or after EFFORT
    pairs of bins looked at for each item, which bounds its time and never leaves an item out.
    """
    fill = [sum(sizes[i] for i in b) for b in bins]
    least = fewest(sizes, limit)
    alive = set(range(len(bins)))
    effort = EFFORT * len(sizes)
    while len(alive) > least and effort > 0:
        under = sorted((b for b in alive if fill[b] < limit), key=lambda b: (-fill[b], b))
        for k in range(len(under) - 1, 0, -1):
            effort -= k
            if _give(under[k], under[:k], bins, sizes, fill, limit):
                if not bins[under[k]]:
                    alive.discard(under[k])
                break
            if effort <= 0:
                break
        else:
            break
    return [bins[b] for b in sorted(alive)]


def _give(poor: int, others: list[int], bins: list[list[int]], sizes: list[int], fill: list[int], limit: int) -> bool:
    """One step from the poor bin to a fuller one; False if there is none."""

    def trade(rich: int, out: list[int], back: list[int]) -> bool:
        gain = sum(sizes[i] for i in out) - sum(sizes[i] for i in back)
        for i in out:
            bins[poor].remove(i)
        for i in back:
            bins[rich].remove(i)
        bins[rich] += out
        bins[poor] += back
        fill[rich] += gain
        fill[poor] -= gain
        return True

    mine = sorted(bins[poor], key=lambda i: -sizes[i])
    for x in mine:
        for rich in others:
            if fill[rich] + sizes[x] <= limit:
                return trade(rich, [x], [])
    for rich in others:
        room = limit - fill[rich]
        theirs = sorted(bins[rich], key=lambda i: sizes[i])
        values = [sizes[i] for i in theirs]
        for x in mine:
            at = bisect_left(values, sizes[x] - room)  # the smallest that leaves room
            if at < len(values) and values[at] < sizes[x]:
                return trade(rich, [x], [theirs[at]])
            for j, y in enumerate(theirs):  # two of theirs for x
                at = bisect_left(values, sizes[x] - room - values[j], j + 1)
                if at < len(values) and values[at] + values[j] < sizes[x]:
                    return trade(rich, [x], [y, theirs[at]])
        for j, x in enumerate(mine):  # two of mine for one of theirs
            for z in mine[j + 1 :]:
                both = sizes[x] + sizes[z]
                at = bisect_left(values, both - room)
                if at < len(values) and values[at] < both:
                    return trade(rich, [x, z], [theirs[at]])
    return False


def _pack_shard(limit: int, first: bool):
    """Rows stay in Arrow, so ids of any type come back as they are, nulls beside large numbers too."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("_id", "piece", "start", "length", "ids_crc32")])
        sizes = rows["length"].to_pylist()
        bins = local_search(best_fit(sizes, limit), sizes, limit)
        number, offset, open_ = (np.zeros(len(sizes), t) for t in (np.int64, np.int64, bool))
        for k, b in enumerate(bins):
            at = 0
            for i in b:
                number[i], offset[i] = k, at
                at += sizes[i]
            open_[b] = at < limit * 15 // 16
        shard = rows["_shard"][0].as_py()
        made = {"sequence_id": (shard * 2 + (not first)) * (1 << 32) + number, "offset": offset, "is_open": open_}
        for name, values in made.items():
            rows = rows.append_column(name, pa.array(values))
        return rows

    return run


def pack(items: DataFrame, limit: int = 4096, id_col: str = "doc_id", shard_size: int = SHARD) -> DataFrame:
    """items (id, piece, start, length, ids_crc32) with their sequence_id and offset.

    Every row is placed exactly once, repeated rows and null ids too; rows longer than the
    limit are not allowed. Lengths of a shard are all that a task holds. Best-fit packing
    leaves a shard with a bin or two that are not full; these are dealt to shards once
    more and packed together, so a thousand shards share their last bins.
    """
    cols = ["_id", "piece", "start", "length", "ids_crc32"]
    items = materialised(items.select(items[id_col].alias("_id"), *cols[1:]))
    shards = max(1, -(-items.count() // shard_size))
    key = F.pmod(F.xxhash64(*cols, F.monotonically_increasing_id()), F.lit(shards))
    schema = T.StructType(items.schema.fields).add("_shard", "long").add("sequence_id", "long").add("offset", "long").add("is_open", "boolean")
    packed = materialised(items.withColumn("_shard", key).groupBy("_shard").applyInArrow(_pack_shard(limit, True), schema))
    rest = packed.where("is_open").select(*cols)
    again = max(1, -(-packed.where("is_open").count() // shard_size))
    key = F.pmod(F.xxhash64(*cols, F.monotonically_increasing_id()), F.lit(again))
    rest = rest.withColumn("_shard", key).groupBy("_shard").applyInArrow(_pack_shard(limit, False), schema)
    return packed.where("not is_open").unionByName(rest).select(F.col("_id").alias(id_col), *cols[1:], "sequence_id", "offset")


def pack_documents(df: DataFrame, path: str, limit: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise and pack: (id, piece, start, length, ids_crc32, sequence_id, offset).

    Null and empty texts, repeated rows and extra columns as in pieces() and pack();
    an empty table gives no rows.
    """
    return pack(pieces(df, path, limit, end_id, id_col, text_col), limit, id_col)
