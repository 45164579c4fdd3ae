"""Very long or deep single values, large ids and clashing names: right results in time near the length."""

import time
from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from silverloom.llm import embedjoin, htmltext, lm, packing, queries, urlfilter


@pytest.mark.parametrize(
    ("html", "nodes"),
    [
        ("<div>" + "<p>x</p>" * 200_000 + "</div>", 200_002), ("<b>" * 200_000 + "</i>" * 200_000 + "<p>x", 2), ("<i><div>" + "<b>" * 200_000 + "</i>" * 200_000, 2),
        ("<ul>" * 100_000 + "<p>x</p>" * 100_000, 200_001), ("<div>" * 100_000 + "</p>" * 100_000, 100_001), ("<p><div>" + "<b>" * 100_000 + "<p></p>" * 50_000, 50_003),
    ],
)
def test_long_pages(html, nodes):
    began = time.process_time()
    page = htmltext.Page(html)
    assert len(page.tag) == nodes
    sizes = [len(x) for x in htmltext.features(page)]
    assert sum(sizes) == nodes and max(sizes) <= htmltext.NODES
    assert time.process_time() - began < 60


def test_elements_that_others_end():
    def shape(html):
        page = htmltext.Page(html)
        return [(t, page.tag[p] if p >= 0 else None) for t, p in zip(page.tag[1:], page.parent[1:])]

    assert shape("<p>a<p>b") == [("p", "html"), ("p", "html")]
    assert shape("<ul><li><b>a<li>b<ul><li>c</ul><li>d") == [("ul", "html"), ("li", "ul"), ("li", "ul"), ("ul", "li"), ("li", "ul"), ("li", "ul")]
    assert shape("<table><tr><td>a<td>b<tr><td>c") == [("table", "html"), ("tr", "table"), ("td", "tr"), ("td", "tr"), ("tr", "table"), ("td", "tr")]
    assert shape("<p><table><tr><td><p>a<p>b</table><p>c") == [("p", "html"), ("table", "html"), ("tr", "table"), ("td", "tr"), ("p", "td"), ("p", "td"), ("p", "html")]
    assert shape("<div><i>a</div></i><p>b<body><html></b>") == [("div", "html"), ("p", "html"), ("body", "p")]


def test_long_urls(spark):
    deep, wide = "http://x.test/" + "a/" * 50_000 + "end", "http://" + "a." * 50_000 + "listed.test/p/q"
    listed = spark.createDataFrame([("http://listed.test/p/",), ("http://x.test/" + "a/" * 30_000,), ("http://y.test/",), (None,), ("no host",)], "url string")
    rows = [(1, deep), (2, wide), (3, deep.replace("x.test", "z.test")), (4, "http://x.test/" + "a/" * 29_999), (5, wide.replace("/p/q", "/p"))]
    pages = spark.createDataFrame([(*r, 1, "k", "c", 1) for r in rows], "page_id int, url string, salt int, listed string, key string, block int")
    began = time.time()
    got = {r.page_id: (r.verdict, r.listed and len(r.listed)) for r in urlfilter.judge(pages, [("block", "com/")], listed).collect()}
    assert got == {1: ("block", 60_007), 2: ("block", 14), 3: ("allow", None), 4: ("allow", None), 5: ("allow", None)}
    assert time.time() - began < 60


def test_lookups_are_all_listed_forms(spark):
    """Against every suffix and prefix cut in Python."""
    urls = ["http://a.b.c.d/x/y//z.html?q", "https://u@h.i:80/", "http://one/p/", "http://h.i/x", "http://a..b.c/x/y/"]
    keys = ["d/", "c.d/x/", "b.c.d/x/y/", "a.b.c.d/x/y/z.html", "h.i/", "h.i/x", "one/p/", "one/", "i/", "b.c/x/y/", "c.d/x/y/z.htm", "a.b.c/"]
    listed = spark.createDataFrame([("http://" + k,) for k in keys], "url string")
    found = {r.url: r.listed for r in urlfilter.listed(spark.createDataFrame([(u,) for u in urls], "url string"), "url", listed, "url").collect()}

    def longest(host, path):
        labels, parts = host.split("."), path.split("/")
        hosts = {".".join(labels[i:]) for i in range(len(labels)) if len(labels) - i > 1 or len(labels) == 1}
        paths = {path} | {"/".join(parts[:i]) + "/" for i in range(1, len(parts))}
        return max((h + p for h in hosts for p in paths if h + p in keys), key=lambda k: (len(k), k), default=None)

    want = [("a.b.c.d", "/x/y/z.html"), ("h.i", "/"), ("one", "/p/"), ("h.i", "/x"), ("a.b.c", "/x/y/")]
    assert found == {u: k for u, w in zip(urls, want) if (k := longest(*w))}


def test_large_ids_beside_nulls(spark):
    ids = [9007199254740993, None, 1152921504606846977, -(1 << 63), None, 9007199254740992]
    docs = spark.createDataFrame([(i, f"text {k} of some words", 1, 2) for k, i in enumerate(ids)], "shard long, text string, _id int, _shard int")
    got = packing.pack_documents(docs, P.path("word_bpe_49k.json"), id_col="shard").collect()
    assert Counter(r.shard for r in got) == Counter(ids) and len({r.ids_crc32 for r in got}) == len(ids)


def test_frequent_words_fill_up(spark):
    """A step of counts that doesn't fit gives its first words, whatever its size."""
    counts = spark.createDataFrame([(f"w{i:03d}".encode(), 7 if i < 300 else 1000 + i % 2) for i in range(310)], "word binary, n long").repartition(4)
    want = sorted(((r.word, r.n) for r in counts.collect()), key=lambda r: (-r[1], bytes(r[0])))
    for most in (0, 3, 10, 100, 310, 1000):
        assert lm.frequent(counts, most) == [(bytes(w), n) for w, n in want[:most]]
    assert lm.frequent(counts.where("n = 7"), 50) == [(f"w{i:03d}".encode(), 7) for i in range(50)]


def test_names_that_clash(spark):
    vectors = [(i, [1.0, i / 10, 0.0], 1, 1, 2, 3, 4) for i in range(6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int, cells int, salt int, a int, b int")
    plain = embedjoin.near_vectors(df.select("vec_id", "embedding", "label"), 0.93).collect()
    assert sorted(map(tuple, embedjoin.near_vectors(df, 0.93).collect())) == sorted(map(tuple, plain))
    assert queries.blocklist() and df.select(F.lit(1)).count() == 6
