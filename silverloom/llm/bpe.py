"""Byte-level BPE encoding and decoding with the vocabulary of a public tokenizer file.

A text is cut at the added tokens' strings and then into short words. Each distinct
word is encoded once per worker by the contiguous rank array: the part boundaries and
the rank of each adjacent pair lie in two small lists; the lowest rank is found by
scanning, its boundary is deleted, and the neighbouring ranks are looked up again. Words
of more than SHORT bytes make the same merges with a heap and linked parts, since scans
would take time in the square of their length.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame

from silverloom.llm.common import map_texts

#: The split pattern of this byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words kept by a worker before it starts anew; a bound of memory, results don't depend on it.
CACHE = 400_000
#: Bytes of a word that is scanned, and characters of a word that is kept.
SHORT, KEPT = 400, 64
NO_RANK = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in characters of the 256 bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["pre_tokenizer"].get("type") != "ByteLevel" or not spec["pre_tokenizer"].get("use_regex") or spec["pre_tokenizer"].get("add_prefix_space") or spec["normalizer"]:
            raise ValueError(f"{path}: texts are not cut by the byte-level split pattern alone")
        alphabet = byte_alphabet()
        as_bytes = lambda s: bytes(alphabet[c] for c in s)
        self.ids = {as_bytes(s): i for s, i in spec["model"]["vocab"].items() if all(c in alphabet for c in s)}
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (as_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.ranks[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.added.items()}
        cut = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, cut)) + ")") if cut else None
        self.split = regex.compile(SPLIT)
        self.known: dict[str, tuple[str, int, bytes]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word, by the contiguous rank array."""
        if len(word) > SHORT:
            return self.merge_long(word)
        parts = [self.single[b] for b in word]
        none = (NO_RANK, -1)
        ranks = self.ranks
        pairs = [ranks.get(p, none) for p in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best[0] == NO_RANK:
                break
            i = pairs.index(best)
            parts[i] = best[1]
            del parts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get((parts[i], parts[i + 1]), none)
            if i:
                pairs[i - 1] = ranks.get((parts[i - 1], parts[i]), none)
        return parts

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges, the lowest rank and then the leftmost first, by a heap of the pairs of linked parts."""
        parts, ranks, n = [self.single[b] for b in word], self.ranks, len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if (r := ranks.get(p))]
        heapify(heap)
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:  # one of the two has changed
                continue
            parts[i], parts[j], after[i] = ranks[left, right][1], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := ranks.get((parts[a], parts[b]))):
                    heappush(heap, (r[0], a, parts[a], parts[b]))
        return [p for p in parts if p >= 0]

    def learn(self, word: str) -> tuple[str, int, bytes]:
        ids = self.merge(word.encode())
        out = (",".join(map(str, ids)), len(ids), self.decode_bytes(ids))
        if len(word) <= KEPT:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[word] = out
        return out

    def words(self, text: str) -> Iterator[str | int]:
        """The words of a text; an added token comes as its id."""
        if self.cut is None or not any(s in text for s in self.added):
            yield from self.split.findall(text)
            return
        for piece in self.cut.split(text):
            if piece in self.added:
                yield self.added[piece]
            elif piece:
                yield from self.split.findall(piece)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for w in self.words(text):
            out += [w] if isinstance(w, int) else self.merge(w.encode())
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, sha256 of the ids joined by commas, sha256 of the decoded text)."""
        n, ids, data, known = 0, [], [], self.known
        for w in self.words(text):
            s, k, b = (str(w), 1, self.bytes_of[w]) if isinstance(w, int) else known.get(w) or self.learn(w)
            ids.append(s)
            data.append(b)
            n += k
        back = b"".join(data).decode("utf-8", "replace").encode()
        return n, hashlib.sha256(",".join(ids).encode()).hexdigest(), hashlib.sha256(back).hexdigest()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and file; the file must be at the same place on all machines."""
    return Codec(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row. A null or empty text has no ids; repeated rows are encoded alike."""
    make = lambda texts: (None, [[codec(path).encode(t) for t in texts]])
    return map_texts(df, [id_col], text_col, {"ids": "array<int>"}, make)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows with ids; null ids decode to the empty text, invalid UTF-8 to U+FFFD."""
    rows = df.select(id_col, ids_col)
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({id_col: b[id_col], "text": [codec(path).decode([] if i is None else list(i)) for i in b[ids_col]]})

    return rows.mapInPandas(run, schema)


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): every row encoded, decoded and digested.

    One narrow pass without a shuffle. Null texts count as empty; other columns are ignored.
    """

    def make(texts: list[str]) -> tuple[None, list]:
        own = codec(path)
        return None, list(zip(*map(own.digest, texts))) or [[], [], []]

    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return map_texts(df, [id_col], text_col, fields, make)
