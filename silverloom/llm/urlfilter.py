"""URL filter: rules first, then a blocked Bloom filter in front of an exact join.

The list of URLs may be of any size. Its canonical entries set bits in a blocked
Bloom filter: a table of 512-bit blocks whose number is capped, so that the table can
be broadcast. Each URL is looked up under the host suffixes and path prefixes of its
canonical form that have the length of an entry's; only what the filter passes goes on to
an exact hash join with the list, which removes the false positives.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import shuffle_partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: 64-bit words of a block, and bits set for an entry.
WORDS, PROBES = 8, 8
#: The filter never has more blocks than this (72 bytes each): at most 9 MB, 16 bits a key up to 4 million keys.
#: A longer list fills it more, so that more lookups reach the exact join; results are the same.
MAX_BLOCKS = 1 << 17


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without '://'."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; rules: (verdict, 'host/path').

    A rule fits its host and all subdomains if the path starts with the rule's path.
    The rules are configuration and become one CASE expression.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def canonical(url: Column) -> tuple[Column, Column]:
    """Canonical host and path: no user, port, outer or double dots, repeated slashes; root path '/'."""
    host, path = host_path(url)
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    host = F.regexp_replace(F.regexp_replace(host, r"\.{2,}", "."), r"^\.|\.$", "")
    path = F.regexp_replace(F.concat(F.lit("/"), path), r"/{2,}", "/")
    return host, path


def listed_key(url: Column) -> Column:
    """The canonical form 'host/path' under which a listed URL is stored; null without host."""
    host, path = canonical(url)
    return F.when(host != "", F.concat(host, path))


def lookups(host: Column, path: Column, host_lengths: list[int], path_lengths: list[int]) -> Column:
    """All forms of a canonical URL under which an entry of these lengths may be listed: every host suffix
    of two labels or more (the whole host if it has one), with the whole path and every path prefix that ends in '/'.

    Lengths that no entry has are never cut out, so a long URL makes no more than the list has lengths."""

    def fitting(lengths: list[int], whole: Column, fits: Callable[[Column], Column], cut: Callable[[Column], Column]) -> Column:
        own = F.filter(F.lit(lengths).cast("array<int>"), lambda n: (n <= F.length(whole)) & ((n == F.length(whole)) | fits(n)))
        return F.transform(own, cut)

    def suffix(n: Column) -> Column:
        return F.substring(host, F.length(host) - n + 1, n)

    hosts = fitting(host_lengths, host, lambda n: (F.substring(host, F.length(host) - n, F.lit(1)) == ".") & F.contains(suffix(n), F.lit(".")), suffix)
    paths = fitting(path_lengths, path, lambda n: F.substring(path, n, F.lit(1)) == "/", lambda n: F.substring(path, F.lit(1), n))
    both = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    return F.when(host != "", both).otherwise(F.array().cast("array<string>"))


def lengths(keys: DataFrame) -> tuple[list[int], list[int]]:
    """The lengths of the hosts and of the paths that the list's keys have; no more numbers than the longest key has characters."""
    n = F.instr("key", "/") - 1
    got = keys.agg(F.array_sort(F.collect_set(n)), F.array_sort(F.collect_set(F.length("key") - n))).first()
    return list(got[0]), list(got[1])


def probe(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block number and the masks of its 64-bit words for a key."""
    at, bits = F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2))
    masks = [F.lit(0).cast("long")] * WORDS
    for p in range(PROBES):
        place = F.shiftrightunsigned(bits, p * 7).bitwiseAND(F.lit(63)).cast("int")
        masks[p % WORDS] = masks[p % WORDS].bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return F.pmod(at, F.lit(blocks).cast("long")).cast("int"), masks


def bloom(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The blocked Bloom filter of keys as a table (block, w0..w7), built by bit_or with map-side combine."""
    block, masks = probe(F.col(key), blocks)
    rows = keys.select(block.alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def listed(urls: DataFrame, url: str, blocklist: DataFrame, listed_url: str, bits_per_key: int = 16, salts: int = 16) -> DataFrame:
    """The distinct urls that are on the blocklist: (url, listed), listed = the longest matching entry.

    Null urls and urls without host are on no list. Repeated urls and list entries count
    once. Hot keys: lookups are made distinct before the exact join, and its left side is salted.
    """
    keys = blocklist.select(listed_key(F.col(listed_url)).alias("key")).where("key is not null").distinct()
    n = keys.count()
    blocks = max(1, min(MAX_BLOCKS, -(-n * bits_per_key // (64 * WORDS))))
    table = bloom(keys, "key", blocks)
    asked = urls.select(F.col(url).alias("url")).where("url is not null").distinct()
    host, path = canonical(F.col("url"))
    asked = asked.select("url", host.alias("host"), path.alias("path"))
    asked = asked.repartition(shuffle_partitions(urls))  # few bytes make many lookups; partitions merged by bytes would be few
    asked = asked.select("url", F.explode(lookups(F.col("host"), F.col("path"), *lengths(keys))).alias("key"))
    block, masks = probe(F.col("key"), blocks)
    asked = asked.withColumns({"block": block} | {f"m{i}": m for i, m in enumerate(masks)})
    hit = reduce(lambda x, y: x & y, [F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}") for i in range(WORDS)])
    possible = asked.join(F.broadcast(table), "block").where(hit).select("url", "key")
    possible = possible.withColumn("salt", F.pmod(F.xxhash64("url"), F.lit(salts)))
    exact = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    found = possible.join(exact, ["key", "salt"]).groupBy("url").agg(F.max(F.struct(F.length("key"), "key")).alias("best"))
    return found.select("url", F.col("best.key").alias("listed"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], blocklist: DataFrame, id_col: str = "page_id", url_col: str = "url", listed_url: str = "url", salts: int = 16) -> DataFrame:
    """Judge every row: (id, host, path, rule, verdict, listed).

    The longest fitting rule decides; without one, 'block' if the URL is on the
    blocklist, else 'allow'. One row out for each row in, repeated rows included. A null
    or malformed URL has an empty host and path, no rule, and is allowed. An empty
    blocklist blocks nothing. Other columns of pages are ignored.
    """
    host, path = host_path(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    found = listed(rows, "url", blocklist, listed_url, salts=salts)
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    out = rows.join(found, ["url", "salt"], "left").withColumns({"host": host, "path": path})
    own = F.when(F.col("listed").isNotNull(), "block").otherwise("allow")
    return out.select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "listed"
    )
