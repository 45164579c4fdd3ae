"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

Each document gets one minimum per hash function. Bands of full minima propose
candidates; only the low bits of the minima are kept, packed in words, and the
similarity they show, corrected for chance collisions, is a count of bits. Pairs that
may reach the threshold are confirmed on the whole sets before they count as links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import Union, attach, components, map_texts, materialised

#: Bands and minima of a band. Two documents at 0.8 miss all bands with probability 3e-6, at 0.85 7e-9.
BANDS, ROWS = 32, 5
#: Low bits kept of each minimum.
BITS = 2
#: Documents of a block, and shingles on average; larger candidate groups are split into such blocks.
BLOCK, WEIGHT = 512, 4_000_000
#: Documents of a large group that every block of it is compared with, besides its head.
PIVOTS = 16
#: Rows of about 50 bytes that may be broadcast; more are joined by a shuffle.
FEW = 500_000
#: Standard errors that an estimate may lie below the threshold before a pair is skipped.
SLACK = 6.0


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; fewer words make one shingle, none make no shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
    return np.unique(out)


def constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 32, n, np.uint32) | np.uint32(1)


def minima(sh: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a non-empty shingle set, in chunks of bounded size."""
    x = (sh >> np.uint64(32)).astype(np.uint32)
    a = constants(BANDS * ROWS, 7)
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 256):
        part = x[at : at + 256, None] * a[None, :]
        part ^= part >> np.uint32(15)
        np.minimum(out, part.min(axis=0), out=out)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    wide = low.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, k])
    return key.view(np.int64)


def packed(low: np.ndarray) -> bytes:
    """The low bits of the minima as BITS planes of packed bits."""
    y = low * np.uint32(0x85EBCA6B)
    y ^= y >> np.uint32(13)
    planes = [np.packbits((y >> np.uint32(b)) & np.uint32(1)) for b in range(BITS)]
    return np.concatenate(planes).astype(np.uint8).tobytes()


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of a packed signature with many: bit counts of where all planes agree."""
    n = BANDS * ROWS
    differ = (one[None, :] ^ many).reshape(len(many), BITS, n // 8)
    unequal = np.bitwise_count(np.bitwise_or.reduce(differ, axis=1)).sum(axis=1)
    chance = 0.5**BITS
    return (1 - unequal / n - chance) / (1 - chance)


def floor_of(num: int, den: int) -> float:
    """The estimate below which a pair is taken to be under the threshold."""
    t, chance = num / den, 0.5**BITS
    p = t + (1 - t) * chance
    return t - SLACK * (p * (1 - p) / (BANDS * ROWS)) ** 0.5 / (1 - chance)


def signed(df: DataFrame, keep: list[str], text_col: str, size: int) -> DataFrame:
    """(keep..., class, n_shingles, signature, bands) of every row; class: digest of the word sequence."""

    def make(texts: list[str]) -> tuple[None, list]:
        out = []
        for t in texts:
            words = tokens(t)
            sh = shingles(words, size)
            low = minima(sh) if len(sh) else None
            sig, keys = (None, None) if low is None else (packed(low), band_keys(low))
            out.append((hashlib.md5(b" ".join(words)).digest(), len(sh), sig, keys))
        return None, list(zip(*out)) or [[]] * 4

    fields = {"class": "binary", "n_shingles": "long", "signature": "binary", "bands": "array<long>"}
    return map_texts(df, keep, text_col, fields, make)


def whole_sets(rows: DataFrame, need: DataFrame, size: int, few: bool) -> DataFrame:
    """(node, shingles) of the classes of need (node, class, rep): whole sets, from a row (id, text) of that id with that text."""

    def make(texts: list[str]) -> tuple[None, list]:
        words = [tokens(t) for t in texts]
        return None, [[hashlib.md5(b" ".join(w)).digest() for w in words], [shingles(w, size).tobytes() for w in words]]

    own = need.select("node", F.col("class").alias("want"), F.col("rep").alias("id"))
    found = map_texts(rows.join(F.broadcast(own) if few else own, "id"), ["node", "want"], "text", {"class": "binary", "shingles": "binary"}, make)
    return found.where("class = want").select("node", "shingles").dropDuplicates(["node"])


def likely(rows: pd.DataFrame, num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a block, the later ones that it may be linked with by sizes and signatures, the likeliest first.

    Pairs of rows of one side are left out if the block has two sides.
    """
    sigs = np.frombuffer(b"".join(map(bytes, rows["signature"])), np.uint8).reshape(len(rows), -1)
    sizes, side, low = rows["n_shingles"].to_numpy(np.int64), rows["side"].to_numpy(), floor_of(num, den)
    two = side.min() < side.max()
    for i in range(len(rows) - 1):
        near = estimate(sigs[i], sigs[i + 1 :])
        small, large = np.minimum(sizes[i], sizes[i + 1 :]), np.maximum(sizes[i], sizes[i + 1 :])
        may = (near >= low) & (small * den >= large * num)
        if two:
            may &= side[i] != side[i + 1 :]
        at = np.flatnonzero(may)
        yield i, at[np.argsort(-near[at], kind="stable")] + i + 1


def confirm(rows: pd.DataFrame, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the rows of one block, as pairs of nodes.

    rows: node, n_shingles, signature, shingles, side, known (a node of its component so far).
    Pairs already connected are skipped; likely ones are confirmed on the full sets.
    """
    rows = rows.sort_values("node", kind="stable").drop_duplicates("node")
    if len(rows) < 2:
        return []
    nodes, sets = [int(x) for x in rows["node"]], [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
    union, out = Union(), []
    for x, k in zip(nodes, rows["known"]):
        union.join(x, int(k))
    for i, others in likely(rows, num, den):
        for j in others:
            if union.root(nodes[i]) == union.root(nodes[j]):
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both * den >= num * (len(sets[i]) + len(sets[j]) - both):
                union.join(nodes[i], nodes[j])
                out.append((nodes[i], nodes[j]))
    return out


def links(rows: DataFrame, sets: DataFrame, keys: list[str], num: int, den: int) -> DataFrame:
    """Confirmed links (a, b) of blocks: rows (keys..., grp, node, n_shingles, signature, side, known) with their sets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [e for _, g in pdf.groupby("grp", sort=True) for e in confirm(g, num, den)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.join(sets, "node").groupBy(*keys).applyInPandas(run, "a long, b long")


def first_round(groups: DataFrame, sets: DataFrame, total: int, num: int, den: int) -> DataFrame:
    """Links within blocks of groups (grp, node, blocks, home, ...): a small group is one block, and small ones share tasks."""
    large = F.col("blocks") > 1
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    pivot = (F.col("node") == F.col("grp")) | (F.pmod(F.xxhash64("node", F.lit(2)), F.ceil(F.col("members") / PIVOTS)) == 0)
    shared = F.pmod(F.xxhash64("grp"), F.lit(max(1, total // (BLOCK // 2))))
    rows = groups.withColumn("at", F.explode(F.when(large & pivot, every).otherwise(F.array("home")))).select(
        F.when(large, F.col("grp")).alias("task"), F.when(large, F.col("at")).otherwise(shared).alias("at"),
        "grp", "node", "n_shingles", "signature", F.lit(0).alias("side"), F.col("node").alias("known"),
    )
    return links(rows, sets, ["task", "at"], num, den)


def second_round(big: DataFrame, found: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The links of large groups between blocks, given those found within them.

    Rows outside a group's main component are open. Blocks of open rows meet each block of
    the others and each other, two blocks a task. There signatures alone are compared first;
    only rows with a likely partner of another component go on with their whole sets.
    """
    so_far = components(found)
    big = big.join(so_far, "node", "left").withColumn("known", F.coalesce("component", "node"))
    parts = big.groupBy("grp", "known").count()
    main = parts.groupBy("grp").agg(F.max(F.struct("count", "known")).alias("top"), F.sum("count").alias("all"))
    main = main.select("grp", F.col("top.known").alias("main"), F.col("all").alias("n"), F.ceil((F.col("all") - F.col("top.count")) / BLOCK).alias("q"))
    big = attach(big.drop("component"), main, ["grp"], "n", big.count(), "inner").where("q > 0")
    is_open, p, q, none = F.col("known") != F.col("main"), F.col("blocks"), F.col("q"), F.lit(0).cast("long")
    home = F.pmod(F.xxhash64("node", F.lit(1)), F.when(is_open, q).otherwise(p))
    upto = lambda n: F.sequence(none, n - 1)
    met = lambda one, kind, two, side: F.struct(one.alias("one"), F.lit(kind).alias("kind"), two.alias("two"), side.cast("int").alias("side"))
    of_open = F.concat(
        F.transform(upto(p), lambda c: met(home, 0, c, none)),
        F.transform(upto(q), lambda o: met(F.least(home, o), 1, F.greatest(home, o), F.when(home > o, 1).otherwise(0))),
    )
    of_rest = F.transform(upto(q), lambda o: met(o, 0, home, F.lit(1)))
    keys = ["grp", "one", "kind", "two"]
    rows = big.select("grp", "node", "n_shingles", "signature", "known", F.explode(F.when(is_open, of_open).otherwise(of_rest)).alias("m"))
    rows = rows.select("grp", "m.*", "node", "n_shingles", "signature", "known")

    def active(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable").reset_index(drop=True)
        known, on = pdf["known"].to_numpy(), np.zeros(len(pdf), bool)
        for i, others in likely(pdf, num, den):
            apart = others[known[others] != known[i]]
            on[apart] = True
            on[i] |= len(apart) > 0
        return pdf[on]

    kept = rows.groupBy(*keys).applyInPandas(active, rows.schema)
    return links(kept, sets, keys, num, den)


def groups_of(df: DataFrame, id_col: str, text_col: str, shingle: int, similarity: tuple[int, int], by_id: bool = True) -> DataFrame:
    """(id, key, n_shingles, first) of every row: key is a hash of its text, first the smallest (id, key) of its group.

    Groups are connected by links between texts and, with by_id, by texts that share an id. A row
    without id has a null `first`, one without words is a group of its own. How links are found:

    Exact copies (equal word sequences) form a class, a node that is handled once. The classes
    that share a band form a bucket; all classes of the buckets with the same smallest node, their
    head, form a group, in which links are confirmed. Any two classes that share a band are
    together in a group, and no group grows by chains of chance collisions. A group up to BLOCK
    classes is one block; for larger ones see first_round and second_round. No link is left out
    because of a group's size, and no task holds more than two blocks. Components are taken of
    confirmed links alone.
    """
    num, den = similarity
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    docs = materialised(signed(rows, ["id", "key"], "text", shingle))
    total = docs.count()
    classes = docs.where("n_shingles > 0 and id is not null").groupBy("class").agg(
        F.min(F.struct("id", "key")).alias("first"), F.count("*").alias("copies"), *[F.any_value(c).alias(c) for c in ("n_shingles", "signature", "bands")]
    )
    classes = materialised(classes.withColumn("node", F.monotonically_increasing_id()))
    band = classes.select("node", F.explode("bands").alias("key"))
    heads = band.groupBy("key").agg(F.min("node").alias("grp"), F.count("*").alias("n")).where("n > 1")
    star = attach(band, heads, ["key"], "n", total, "inner").select("grp", "node").distinct()
    star = materialised(star.join(classes.select("node", "n_shingles", "signature"), "node"))
    sizes = star.groupBy("grp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    sizes = sizes.select("grp", "n", F.col("n").alias("members"), F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("weight") / WEIGHT)).alias("blocks"))
    members = star.count()
    groups = attach(star, sizes, ["grp"], "n", members, "inner").withColumn("home", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")))
    nodes = star.select("node").distinct()
    need = classes.join(nodes, "node", "left_semi").select("node", "class", F.col("first.id").alias("rep"))
    sets = materialised(whole_sets(rows, need, shingle, nodes.count() <= FEW))
    found = materialised(first_round(groups, sets, members, num, den))
    big = groups.where("blocks > 1")
    if not big.isEmpty():
        found = materialised(found.unionByName(second_round(big, found, sets, num, den)))
    if by_id:
        found = found.unionByName(texts_of_one_id(docs, classes))
    ends = components(found)
    tops = classes.select("node", "class", "first", "copies").join(ends, "node", "left").withColumn("component", F.coalesce("component", "node"))
    tops = materialised(tops)
    best = tops.groupBy("component").agg(F.min("first").alias("top"), F.count("*").alias("n"))
    tops = attach(tops, best, ["component"], "n", classes.count(), "inner").select("class", "top", "copies")
    out = attach(docs.select("id", "key", "class", "n_shingles"), tops, ["class"], "copies", total)
    own = F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("top")), F.struct("id", "key")))
    return out.select("id", "key", "n_shingles", own.alias("first"))


def texts_of_one_id(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between the classes of texts that share an id: to the smallest one."""
    pairs = docs.where("n_shingles > 0 and id is not null").select("id", "class").distinct()
    several = materialised(pairs.groupBy("id").agg(F.count("*").alias("n")).where("n > 1"))
    if several.isEmpty():
        return several.select(F.col("id").alias("a"), F.col("id").alias("b"))
    pairs = attach(pairs, several, ["id"], "n", pairs.count(), "inner").join(classes.select("class", "node"), "class").select("id", "node")
    least = pairs.groupBy("id").agg(F.min("node").alias("b"), F.count("*").alias("n"))
    return attach(pairs, least, ["id"], "n", pairs.count(), "inner").select(F.col("node").alias("a"), "b")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: tuple[int, int] = (4, 5)
) -> DataFrame:
    """(id, n_shingles, component_id) of every row of df.

    Two documents are linked if the Jaccard similarity of their shingle sets is at least
    similarity[0] / similarity[1]; component_id is the smallest id that links reach. See groups_of.

    A null, empty or blank text has no shingles and is linked with nothing. A row with a
    null id gets a null component and is linked with nothing. Rows that repeat an id are
    each returned; those with words share one component, whatever their texts. Other columns are ignored.
    """
    out = groups_of(df, id_col, text_col, shingle, similarity)
    return out.select(F.col("id").alias(id_col), "n_shingles", F.col("first.id").alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """df, with the columns it has, but for all texts of each group of near-duplicates except that of the smallest id.

    Groups are connected by links between texts alone, so a text stays although another text
    of its id goes. Rows without id or words stay, as do rows that repeat id and text of one that stays.
    """
    found = groups_of(df, id_col, text_col, shingle, similarity, by_id=False)
    gone = found.where(F.struct("id", "key") != F.col("first")).select("id", "key").distinct()
    same = (df[id_col].cast("long") == gone["id"]) & (F.xxhash64(df[text_col]) == gone["key"])
    return df.join(gone, same, "left_anti")
