"""Operators against brute force on the small tables, and on rows with every awkward value."""

import datetime as dt
import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter
from decimal import Decimal
from html import unescape

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silverloom.llm import bpe, embedjoin, fingerprint, htmlpages, htmltext, langid, linededup, lm, minhash, packing, queries, trees, urlfilter
from silverloom.llm.common import components

LONG = " ".join(f"w{i % 977} x{i}" for i in range(20_000))
PASSAGE = "\n".join(f"line {i} of a passage that repeats in more than one text of this table again" for i in range(6))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, bucket int, gone int, class string, word string, _0 int"
TEXTS = [
    (1, "Hello world, this is one text.\n" + PASSAGE), (2, None), (3, ""), (4, "  \t\n "), (5, LONG), (6, "Hello world, this is one text.\n" + PASSAGE),
    (7, "une phrase en français\n" + PASSAGE), (7, "une phrase en français\n" + PASSAGE), (None, "no id here"), (8, "a"), (9, "a b"), (10, "12 34 !!"), (11, "é🙂<|endoftext|>x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "fr" if t and "fran" in t else "en", None, None, "r", 5, 1, 1, "c", "w", 0) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


def by_id(df):
    return {r[0]: r for r in df.collect()}


def roots(links, ids):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 100), (7, 7), (300, 301), (302, 301)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots([e for e in edges if e[0] != e[1]], {x for e in edges for x in e})
    assert got == {k: v for k, v in want.items()}


def test_fingerprints(spark, docs, odd, empty):
    got = by_id(queries.op1_fingerprints(spark, SF))
    order = sorted(docs, reverse=True)
    near = []
    for k, d in enumerate(order):
        t, n = docs[d] or "", docs[order[(k + 1) % len(order)]] or ""
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d].fingerprint == fingerprint.as_text(fingerprint.sketches([t]))[0]
        if len(t) > 300 and t != n:
            near.append((got[d].near_edited, got[d].near_next))
    assert np.median([a for a, _ in near]) > 0.4 and np.median([b for _, b in near]) < 0.05
    rows = fingerprint.beside_next(odd).collect()
    assert len(rows) == len(TEXTS) and {r.n_chars for r in rows if r.doc_id in (2, 3)} == {0}
    assert next(r for r in rows if r.doc_id is None).edited.startswith("no id")
    assert fingerprint.beside_next(empty).count() == 0
    assert fingerprint.beside_next(odd.where("doc_id = 8")).first().near_next == 1.0


def test_likeness_is_of_common_phrases(spark, docs):
    """Sketched likeness is near the share of phrase names that texts have in common, all of them counted."""
    got, order, off = by_id(queries.op1_fingerprints(spark, SF)), sorted(docs, reverse=True), []

    def names(text):
        return set(fingerprint.phrases([text])[1].tolist())

    for k, d in enumerate(order):
        t, n = docs[d] or "", docs[order[(k + 1) % len(order)]] or ""
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        for value, other in ((got[d].near_edited, edited), (got[d].near_next, n)):
            a, b = names(t), names(other)
            exact = 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0
            off.append(abs(value - exact))
    assert max(off) < 0.4 and np.mean(off) < 0.04


def test_phrases_are_local():
    rng = np.random.default_rng(1)
    body = "".join(chr(97 + c) for c in rng.integers(0, 26, 4000))
    a = {n for _, n in zip(*map(list, fingerprint.phrases([body])))}
    b = {n for _, n in zip(*map(list, fingerprint.phrases(["some other beginning " + body])))}
    assert len(a & b) / len(a) > 0.9


def test_embeddings(spark):
    v = duckdb.sql(f"select vec_id, embedding, label from '{SF}/embeddings.parquet'").fetchall()
    x = {i: np.asarray(e, float) for i, e, _ in v}
    links, count = [], Counter()
    for a, _, la in v:
        for b, _, lb in v:
            if a < b and la == lb and x[a] @ x[b] / math.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= 0.93:
                links.append((a, b))
                count.update((a, b))
    root = roots(links, x)
    for r in queries.op2_embedding_join(spark, SF).collect():
        assert (r.n_links, r.component_id, r.kept) == (count[r.vec_id], root[r.vec_id], root[r.vec_id] == r.vec_id)


def test_odd_embeddings(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1), (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1),
            (9, [None, 1.0], 1), (10, [1.0, 0.0], None), (11, [], 1), (12, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1))
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id) for r in embedjoin.near_vectors(df, 0.93).collect()), key=repr)
    want = [(1, 3, 1), (2, 3, 1), (3, 3, 1), (3, 3, 1), (0, 0, None), *[(i, 0, i) for i in range(4, 13)]]
    assert got == sorted(want, key=repr)
    assert embedjoin.near_vectors(df.limit(0), 0.93).count() == 0


@pytest.mark.parametrize(("kind", "labels"), [("double", "a b"), ("boolean", [True, False]), ("date", [dt.date(2025, 1, 1), dt.date(2025, 1, 2)]), ("smallint", [1, 2]), ("decimal(5,2)", [Decimal("1.50"), Decimal("2.00")]), ("double", [1.5, 2.5])])
def test_embeddings_in_doubles(spark, kind, labels):
    """Large, small and close components count as the doubles they are, whatever the labels' type."""
    one, two = labels.split() if isinstance(labels, str) else labels
    kind = "string" if isinstance(labels, str) else kind
    c = 0.93
    edge = lambda d: [c + d, math.sqrt(1 - (c + d) ** 2)]
    rows = [(1, [1.0, 0.0], one), (2, [1e200, 0.0], one), (3, [1e-200, 0.0], one), (4, edge(1e-12), one), (5, edge(-1e-12), one), (6, [3e300, 0.0], two), (7, [0.0, -1.0], one), (8, [2.0, 0.0], None)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedjoin.near_vectors(df, c).collect())
    x, links, count = {i: np.asarray(v) / max(map(abs, v)) for i, v, _ in rows}, [], Counter()
    for a, _, la in rows:
        for b, _, lb in rows:
            if a < b and la == lb and la is not None and x[a] @ x[b] / math.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= c:
                links.append((a, b))
                count.update((a, b))
    root = roots(links, x)
    assert (1, 4) in links and (1, 5) not in links and got == sorted((i, count[i], root[i]) for i in x)


def test_principal_axes(spark):
    """The axes found are orthonormal and hold most of the spread that any could, even if it is nearly flat."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 40)) * np.linspace(3, 0.2, 40)
    df = spark.createDataFrame([(v.tolist(),) for v in x], "embedding array<double>")
    axes = embedjoin.principal(df)[40]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    spread = np.cov(u.T, bias=True)
    assert np.allclose(axes.T @ axes, np.eye(embedjoin.DIMS)) and np.trace(axes.T @ spread @ axes) > 0.9 * np.linalg.eigvalsh(spread)[-embedjoin.DIMS :].sum()


def test_lm(spark, docs, odd, empty):
    toks = {d: lm.tokens(t or "") for d, t in docs.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    c = Counter(w for d in docs if not held[d] for w in toks[d])
    n, v = sum(c.values()), len(c)
    base = total = 0.0
    for r in queries.op3_lm_score(spark, SF).collect():
        want = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in toks[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(toks[r.doc_id]), sum(c[w] > 0 for w in toks[r.doc_id]), n)
        assert r.base_score == pytest.approx(want, rel=1e-9)
        if r.held_out:
            base, total = base + r.base_score, total + r.score
    assert total > base
    out = lm.score(odd, F.col("doc_id") != 5).collect()
    assert len(out) == len(TEXTS) and all(r.score <= 1e-9 for r in out) and next(r for r in out if r.doc_id == 2).n_tokens == 1
    assert lm.score(empty, F.lit(True)).count() == 0
    assert {r.base_score for r in lm.score(odd, F.lit(False)).collect()} == {0.0}


def test_lm_score_by_token(spark, docs):
    """Scores are the sums of the model's log probabilities, each by a softmax over all classes, and of those within the classes."""
    table = spark.read.parquet(f"{SF}/documents.parquet").where(queries.fold("doc_id", 7) != 2)
    words = lm.word_counts(table)
    c = {bytes(r.word): r.n for r in words.collect()}
    top, bottom = lm.frequent(words), sum(c.values()) + len(c) + 1
    made = lm.Classes.made(top, sum(c.values()), len(c))
    classes, k = {w: int(of) for (w, _), of in zip(top, made.of)}, len(made.share) - 1
    assert k > lm.CLASSES and sorted({*classes.values()}) == list(range(k)) and [classes[w] for w, _ in top[: lm.CLASSES]] == list(range(lm.CLASSES))
    inside = Counter()
    for w, of in classes.items():
        inside[of] += c[w] + 1
    inside[k] = bottom - sum(inside.values())
    m = lm.train(table, classes, made.share)
    got = by_id(queries.op3_lm_score(spark, SF))
    for d in [d for d in sorted(docs) if len(docs[d] or "") < 3000][:40]:
        one = two = k + 1
        total = 0.0
        for w in lm.tokens(docs[d] or ""):
            x = (m.place[0] * m.context[one] + m.place[1] * m.context[two]) @ m.target.T + m.bias
            cls = classes.get(w, k)
            total += (x[cls] - np.log(np.exp(x).sum())) / np.log(10)
            total += math.log10((c.get(w, 0) + 1) / inside[cls])
            one, two = cls, one
        assert got[d].score == pytest.approx(total, rel=1e-6)


def test_words_are_grouped_by_spelling():
    rng = np.random.default_rng(2)
    words = [bytes(rng.choice(list(letters), 12).tolist()) for letters in (b"ab", b"yz") for _ in range(lm.MEMBERS)]
    got = lm.grouped(words)
    assert len(set(got[: lm.MEMBERS])) == len(set(got[lm.MEMBERS :])) == 1 and got[0] != got[-1]
    assert lm.grouped([]).tolist() == [] and set(lm.grouped(words[:5])) == {0}
    assert np.isfinite(lm.spelling([b"", b"\n", b"x" * 100_000])).all()


def test_lm_is_normalised():
    m = lm.Model.start(np.asarray([5.0, 3.0, 2.0]) / 10)
    totals = m.log_totals()
    one = np.repeat(np.arange(4), 4)
    two = np.tile(np.arange(4), 4)
    p = np.exp(m.predicted(one, two) @ m.target.T + m.bias - totals[one, two][:, None])
    assert np.allclose(p.sum(axis=1), 1)


def test_urls(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    cols = "page_id, host, path, rule, verdict, listed"
    got = queries.op4_url_filter(spark, SF).select(*cols.split(", ")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(con.sql(queries.oracle_sql()["op4_url_filter"]).select(cols).fetchall(), key=repr)
    urls = [None, "", "no scheme", "HTTP://A.NET", "http://a.net/", "http://x.example.NET/en/1", "http://example.org/fr/", "http://BAD.com:80//a/./b?q", "http://sub.bad.com/a/", "http://bad.com/c", "ftp://u@bad.com/a/x#f"]
    df = spark.createDataFrame(list(enumerate(urls)) + [(4, urls[4])], "page_id int, url string").withColumn("key", F.lit(1))
    listed = spark.createDataFrame([("http://bad.com/a/",), ("http://bad.com/a/",), (None,)], "url string")
    r = sorted(urlfilter.judge(df, queries.RULES, listed).collect(), key=lambda r: r.page_id)
    assert [x.verdict for x in r] == ["allow"] * 4 + ["block"] * 2 + ["allow"] * 2 + ["block"] * 2 + ["allow", "block"]
    assert (r[0].host, r[0].path, r[3].host, r[3].path, r[3].rule, r[4].rule) == ("", "", "a.net", "", None, "net/")
    assert urlfilter.judge(df, queries.RULES, listed.limit(0)).where("listed is not null").count() == 0
    assert urlfilter.judge(df.limit(0), queries.RULES, listed).count() == 0


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(5000).selectExpr("concat('http://h', id % 50, '.com/', id) url")
    assert urlfilter.listed(keys, "url", keys, "url").count() == 5000
    assert urlfilter.listed(keys.selectExpr("concat(url, 'x') url"), "url", keys, "url").count() == 0


def test_language(spark, odd, empty):
    truth = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    rows = [r for r in queries.op5_language_id(spark, SF).collect() if r.held_out]
    assert len(rows) > 30 and np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.95 and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows} == {True}
    profiles = langid.learn(odd)
    got = langid.predict(odd, profiles).collect()
    assert len(got) == len(TEXTS) and {r.lang_pred for r in got if r.doc_id in (2, 3, 4, 10)} == {"und"}
    assert {r.lang_pred for r in langid.predict(odd, {}).collect()} == {"und"}
    kept = langid.identified(odd)
    assert kept.columns == odd.columns and kept.count() == len(TEXTS) - 4 and langid.identified(empty).count() == 0


def test_distances_by_hand(spark, docs):
    """Every document's language and score by a plain reckoning of ranks."""
    langs = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())

    def grams(text):
        out = Counter()
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            w = "\x01" + "".join(chr(ord(c) + 2) for c in w) + "\x01"
            out.update(g for n in (1, 2, 3) for i in range(len(w) - n + 1) if (g := w[i : i + n]).strip("\x01"))
        return out

    def ranked(counts):
        return sorted(counts, key=lambda g: (-counts[g], *[0] * (3 - len(g)), *map(ord, g)))[: langid.PROFILE]

    sums = {}
    for d, t in docs.items():
        if langs[d] and t and zlib.crc32(str(d).encode()) % 3 != 1:
            sums.setdefault(langs[d], Counter()).update(grams(t))
    profiles = {k: {g: i for i, g in enumerate(ranked(c))} for k, c in sums.items()}
    for r in queries.op5_language_id(spark, SF).collect():
        own = ranked(grams(docs[r.doc_id] or ""))
        far = {k: sum(min(langid.PROFILE, abs(p.get(g, 10**6) - i)) for i, g in enumerate(own)) for k, p in profiles.items()}
        best = min(sorted(far), key=far.get) if own else langid.UNKNOWN
        assert r.lang_pred == best and r.score == pytest.approx(1 - far[best] / (len(own) * langid.PROFILE) if own else 0)


def test_gram_counts_by_hand():
    doc, code, n = langid.gram_counts(["Ab ab", "..", "b"])
    assert sorted(doc.tolist()) == [0] * 7 + [2] * 4 and n.sum() == 2 * 7 + 4 and (np.diff(code[doc == 0]) > 0).all()


def test_packing(spark, docs, odd, empty):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = queries.op6_best_fit_packing(spark, SF).collect()
    got = {(r.doc_id, r.piece): r for r in rows}
    total = 0
    for d, t in docs.items():
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for k in range(0, len(ids), 4096):
            part, r = ids[k : k + 4096], got.pop((d, k // 4096))
            assert (r.start, r.length, r.ids_crc32) == (k, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes()))
    assert not got
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= packing.fewest([r.length for r in rows], 4096) + 1 and len(bins) <= -(-total // 4096) + 1
    out = packing.pack_documents(odd, P.path("word_bpe_49k.json"))
    assert {r.length for r in out.collect() if r.doc_id in (2, 3, 4)} == {1} and out.where("doc_id = 7").count() == 2
    assert packing.pack_documents(empty, P.path("word_bpe_49k.json")).count() == 0


def test_word_ids_like_library():
    tok, own = Tokenizer.from_file(P.path("word_bpe_49k.json")), packing.WordIds(P.path("word_bpe_49k.json"))
    for i in [*range(0xD800), *range(0xE000, 0x20000)]:
        s = f"a{chr(i)}{chr(i)}B é{chr(i)}1'S x"
        if i % 7 == 0 or i < 0x3000:
            assert own(s) == np.asarray(tok.encode(s, add_special_tokens=False).ids, "<u4").tobytes(), hex(i)


def test_word_ids_when_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 3)
    tok, own = Tokenizer.from_file(P.path("word_bpe_49k.json")), packing.WordIds(P.path("word_bpe_49k.json"))
    for s in ["One, two; ONE two. one's two's", "a.b ..! é, É. İ. İx ŉ' don't 12, 3", "", " ", "one two three four five six one two?"] * 3:
        assert own(s) == np.asarray(tok.encode(s, add_special_tokens=False).ids, "<u4").tobytes(), s
        assert len(own.known) <= 3 and len(own.known.older) <= 3


def test_local_search_empties_bins():
    sizes = [6, 6, 5, 3, 4, 4, 2]
    bins = packing.local_search([[0, 3], [1, 6], [2, 4], [5]], sizes, 10)
    assert sorted(i for b in bins for i in b) == list(range(7)) and all(sum(sizes[i] for i in b) <= 10 for b in bins) and len(bins) == 3


def test_fewest_bins():
    """No more than the best packing of small tables has, found by trying all."""

    def best(sizes, room, bins=()):
        if not sizes:
            return len(bins)
        x, rest = sizes[0], sizes[1:]
        tries = [best(rest, room, (*bins[:i], b + x, *bins[i + 1 :])) for i, b in enumerate(bins) if b + x <= room]
        return min([*tries, best(rest, room, (*bins, x))])

    rng = np.random.default_rng(2)
    for _ in range(60):
        sizes = rng.integers(1, 11, 7).tolist()
        assert -(-sum(sizes) // 10) <= packing.fewest(sizes, 10) <= best(sizes, 10)
    assert packing.fewest([6] * 5 + [5] * 4, 10) == 7 and packing.fewest([], 10) == 0


def test_bpe(spark, docs, odd, empty):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = by_id(queries.op7_bpe(spark, SF))
    for d, t in docs.items():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert tuple(got[d])[1:] == want
    path = P.path("byte_bpe_50k.json")
    ids = bpe.encode(odd, path)
    back = [(r.doc_id, r.text) for r in bpe.decode(ids, path).collect()]
    assert sorted(back, key=repr) == sorted(((i, t or "") for i, t in TEXTS), key=repr)
    for r in ids.collect():
        assert any(list(r.ids) == tok.encode(t or "", add_special_tokens=False).ids for i, t in TEXTS if i == r.doc_id)
    assert bpe.round_trip(empty, path).count() == 0


@pytest.mark.parametrize("word", ["a" * 3000, "etaoin" * 40_000, "!" * 20_000, "ééßü" * 500, "\n" * 2000, "12345" * 900])
def test_bpe_of_long_words(word):
    """A word of any length takes seconds, and its ids are those of the scanned array and of the library."""
    path = P.path("byte_bpe_50k.json")
    own, text = bpe.codec(path), f"so {word} x"
    assert own.encode(text) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    short = word[:200].encode()
    assert own.merge_long(short) == own.merge(short)
    assert own.digest(text)[0] == len(own.encode(text)) and max(map(len, own.known)) <= bpe.KEPT


def test_vocabularies_are_cut_as_expected():
    with pytest.raises(ValueError):
        bpe.Codec(P.path("word_bpe_49k.json"))
    with pytest.raises((ValueError, KeyError)):
        packing.WordIds(P.path("byte_bpe_50k.json"))


def article(page):
    """The main text of a test page, by the layout that these pages happen to have."""
    body = re.sub(r"<br>", " ", re.search(r"(?s)<article>(.*)</article>", page)[1])
    parts = [" ".join(unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(x for x in parts if x)


def test_html_of_test_pages(spark):
    pages = dict(duckdb.sql(f"select page_id, html from '{SF}/pages.parquet'").fetchall())
    got = by_id(queries.op8_html_text(spark, SF))
    assert np.mean([got[i].text == article(h) for i, h in pages.items()]) > 0.98
    odd = "<p>It is super<wbr>cali, and <math><mi>x</mi> = 1</math> holds for all of the numbers that we have seen here.</p>"
    page = f"<body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>One title of it</h1>{odd}{odd}</article><footer>&copy; me</footer></body>"
    rows = spark.createDataFrame([(1, page), (1, page), (2, odd)], "page_id int, html string")
    text = [r.text for r in htmltext.extract(rows, ["page_id"]).collect()]
    assert text[0] == text[1] and "supercali" in text[0] and "x = 1 holds" in text[0] and "Home" not in text[0]


def test_html(spark):
    fitted = htmltext.model()
    exact = 0
    for html in htmlpages.generated(60, 77):
        page = htmltext.Page(html)
        want = [b.replace(htmlpages.MARK, "") for b in htmltext.blocks(page, np.ones(len(page.tag), bool)) if htmlpages.MARK in b]
        exact += htmltext.main_texts([html.replace(htmlpages.MARK, "")], fitted)[0] == "\n\n".join(" ".join(w.split()) for w in want)
    assert exact >= 57
    for r in queries.op8_html_text(spark, SF).collect():
        assert r.text and r.n_chars == len(r.text) and "©" not in r.text and "track(" not in r.text
    odd = [(1, None), (2, ""), (3, "plain"), (4, "<![CDATA[ x ]]><p>unclosed <b>a&amp;b"), (5, "<article><p>" + "word " * 100_000 + "</p></article>"), (6, "<div>" * 2000 + "deep")]
    got = by_id(htmltext.extract(spark.createDataFrame(odd, "page_id int, html string").withColumn("text", F.lit(1)), ["page_id"]))
    assert got[1].text == got[2].text == "" and got[5].n_chars == 499_999 and len(got) == 6
    assert htmltext.extract(spark.createDataFrame([], "page_id int, html string"), ["page_id"]).count() == 0


def test_decoding_is_hierarchical():
    page = htmltext.Page("<body><div><p>a</p><p>b</p></div></body>")
    kept = htmltext.decoded(page, np.asarray([2.0, 2.0, -5.0, 1.0, 1.0]))
    assert not kept[3:].any() and kept[:2].all()


def test_trees():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    assert ((trees.fit(x, y, trees=20).log_odds(x) > 0) == y).mean() > 0.97


def test_line_dedup(spark, docs, odd, empty):
    parts = {d: linededup.pieces(t) if t else [] for d, t in docs.items()}
    pairs = {d: [*zip([None, *ps], ps)] for d, ps in parts.items()}

    def later(items):
        """Where each item of a document stands that stands elsewhere too, and not here first."""
        n, first = Counter(p for ps in items.values() for p in ps), {}
        for d in sorted(items):
            for k, p in enumerate(items[d]):
                first.setdefault(p, (d, k))
        return {d: {k for k, p in enumerate(ps) if n[p] > 1 and first[p] != (d, k)} for d, ps in items.items()}

    gone, joined = later(parts), later(pairs)
    got = by_id(queries.op9_line_dedup(spark, SF))
    for d, t in docs.items():
        assert tuple(got[d])[1:] == linededup.without(t, gone[d], joined[d])
    r = [(x.row.doc_id, x.text, x.removed_lines) for x in linededup.deduplicate(odd).collect()]
    assert len(r) == len(TEXTS) and (2, None, 0) in r and (3, "", 0) in r and (None, "no id here", 0) in r
    assert next(x for x in r if x[0] == 1)[2] == 0 and next(x for x in r if x[0] == 6)[2] >= 6 and PASSAGE[-40:] not in next(x for x in r if x[0] == 7)[1]
    assert linededup.deduplicate(empty).count() == 0


def test_line_dedup_inside_lines(spark):
    """A passage that stands at different places of long lines goes from the later one, and nothing else does."""
    passage = " ".join(f"p{i * i % 1009}" for i in range(100))
    one, two = (" ".join(f"{x}{i * i % 997}" for i in range(80)) for x in "ab")
    texts = {1: f"{one} {passage} {one[::-1]}", 2: f"{two}\n{two[::-1]} {passage}\tand {two.upper()}", 3: f"{passage}\u00a0é"}
    got = by_id(linededup.deduplicate(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).select("row.doc_id", "text", "n_lines", "removed_lines"))
    assert tuple(got[1])[1:] == (texts[1], 1, 0) and tuple(got[2])[2:] == (2, 1) and tuple(got[3])[2:] == (1, 1)
    for d in (2, 3):
        left = got[d].text.split(" ")
        assert sum(w in left for w in passage.split()) < linededup.LONG
    assert got[2].text.startswith(f"{two}\n{two[::-1]} ") and got[2].text.endswith(f"\tand {two.upper()}") and got[3].text.endswith("\u00a0é")


def test_chunk_digests_beyond_a_block():
    """A passage has the same chunks and digests at any place of a text longer than what is hashed at once."""
    passage = " ".join(f"p{i * i % 1009}" for i in range(300)).encode()
    wanted = linededup.cut_up([passage])
    for at in (0, linededup.BLOCK - 700, 3 * linededup.BLOCK - 5):
        c = linededup.cut_up([b"x" * at + b"\n" + passage, b"", b" \n", passage])
        found = c.key[np.isin(c.key, wanted.key)]
        assert len(found) >= 2 * len(wanted.key) - 4 and set(found) >= set(wanted.key[1:-1])
        assert all(c.raw[a:b].strip() == p for a, b, p in zip(c.lo, c.hi, c.pieces(np.arange(len(c.lo)))))


def test_chunks_are_cut_within_a_cache():
    """However many texts a batch has, what is cut at once takes so little memory that it stays in a core's cache."""
    texts = pa.array([" ".join(f"w{i * i % 1009}" for i in range(k, k + 300)) for k in range(2000)])
    tracemalloc.start()
    for _ in linededup.cut_portions(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text"):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * (1 << 18)


def test_filter_of_repeated_chunks(spark, monkeypatch):
    """Every repeated digest passes the filter, and few others, which would be shuffled with their texts."""
    monkeypatch.setattr(linededup, "FILTER", (1 << 8, 1 << 12))
    keys = linededup.mixed(np.arange(1, 40_001, dtype=np.uint64) * linededup.ODD)
    table = linededup.filter_of(spark.createDataFrame(pa.table({"key": keys[:4000].view(np.int64)})))
    assert len(table) == 1 << 10 and linededup.passed(table, keys[:4000]).all() and linededup.passed(table, keys[4000:]).mean() < 0.025


@pytest.mark.parametrize("unit", ["and", "ha ho", "one two three"])
def test_parts_of_recurring_words(unit):
    """However a run of few words begins, its parts are alike."""
    one, two = (linededup.pieces(f"{start} " + " ".join([unit] * 60) + f" {end}") for start, end in (("x y z", "a b c"), (f"q {unit.split()[-1]}", "d e")))
    assert sum(len(p.split()) for p in one if p in two) >= 60 * len(unit.split()) - 40


def test_line_dedup_of_lines_that_meet_once(spark):
    """Short lines that each repeat, but never side by side, stay; side by side again they go from the later text."""
    x, y = "Menteases ue por las llbo.", "Released under the MIT License."
    own = [f"Row {i} holds just what no other row of all these ever says again here." for i in range(6)]
    texts = {1: [own[0], x, own[1]], 2: [own[2], y, own[3]], 3: [own[4], x, y, own[5]], 4: [own[0][::-1], x, y, own[1][::-1]]}
    df = spark.createDataFrame([(d, "\n".join(t)) for d, t in texts.items()], "doc_id long, text string")
    got = {r.row.doc_id: (r.text.split("\n"), r.removed_lines) for r in linededup.deduplicate(df).collect()}
    assert got == {d: (t, 0) for d, t in texts.items() if d < 4} | {4: (texts[4][:1] + texts[4][3:], 2)}


def test_line_dedup_of_a_small_table_makes_few_files(spark, monkeypatch):
    """However many partitions shuffles have, digests and counts alone are written, in a file a core at most, and so is the result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made, cores = [], spark.sparkContext.defaultParallelism
    want = {(r.row.doc_id, r.text, r.removed_lines) for r in linededup.deduplicate(docs).collect()}
    with monkeypatch.context() as m:
        write = linededup.materialised
        m.setattr(linededup, "materialised", lambda df: made.append(write(df)) or made[-1])
        settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
        before = {k: spark.conf.get(k) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            got = linededup.deduplicate(docs)
            assert {(r.row.doc_id, r.text, r.removed_lines) for r in got.collect()} == want
            assert len(made) == 2 and all(d.rdd.getNumPartitions() <= cores for d in [*made, got])
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)


def test_line_dedup_of_texts_that_share_an_id(spark):
    """What repeats in one text of an id isn't cut out of another text of that id."""
    p, q = ("\n".join(f"{x} {i} has words {i * 7} of its own {i * i}" for i in range(12)) for x in "pq")
    df = spark.createDataFrame([(1, p), (2, p), (2, q), (None, p), (None, q)], "doc_id long, text string")
    got = [(r.row.doc_id, r.row.text == p, r.removed_lines, r.text) for r in linededup.deduplicate(df).collect()]
    assert sorted(got, key=repr) == sorted([(1, True, 0, p), (2, True, 12, ""), (2, False, 0, q), (None, True, 0, p), (None, False, 0, q)], key=repr)


def exact_groups(texts, size, num, den):
    sets = {}
    for d, t in texts.items():
        w = minhash.tokens(t or "")
        sets[d] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return {d: len(s) for d, s in sets.items()}, roots(links, ids)


def test_minhash(spark, docs, odd, empty):
    n, root = exact_groups(docs, 3, 85, 100)
    for r in queries.op10_minhash(spark, SF).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (n[r.doc_id], root[r.doc_id], root[r.doc_id] == r.doc_id)
    got = [(r.doc_id, r.n_shingles > 0, r.component_id) for r in minhash.near_duplicates(odd).collect()]
    assert sorted(got, key=repr) == sorted(((i, bool((t or "").split()), 1 if i == 6 else i) for i, t in TEXTS), key=repr)
    assert minhash.near_duplicates(empty).count() == 0


def test_minhash_large_groups(spark, monkeypatch):
    """Groups beyond a block: pivots and the second round find the same components as all pairs."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "PIVOTS", 4)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for d in range(150):
        w = list(base)
        for k in rng.integers(0, 60, rng.integers(0, 6)):
            w[k] = f"z{rng.integers(0, 4)}"
        texts[d] = " ".join(w)
    n, root = exact_groups(texts, 3, 85, 100)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df, shingle=3, similarity=(85, 100)).collect()} == root


def changed(words, *at):
    return " ".join(f"x{k}" if k in at else w for k, w in enumerate(words))


def test_minhash_of_texts_that_share_an_id(spark):
    """An id that holds two texts joins what is near either; each text of it is judged by itself where one of a group stays."""
    a, b, u = ([f"{x}{i}" for i in range(80)] for x in "abu")
    rows = [(1, changed(a)), (1, changed(b)), (2, changed(a, 40)), (3, changed(b, 9)), (4, changed(u)), (4, ""), (5, None), (4, changed(u)), (None, changed(a))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1))
    got = sorted((r.doc_id or 0, r.n_shingles > 0, r.component_id or 0) for r in minhash.near_duplicates(df, shingle=3, similarity=(85, 100)).collect())
    assert got == [(0, True, 0), (1, True, 1), (1, True, 1), (2, True, 1), (3, True, 1), (4, False, 4), (4, True, 4), (4, True, 4), (5, False, 5)]
    rows = [(1, changed(a)), (2, changed(a, 40)), (2, changed(u)), (3, changed(u, 5)), (2, changed(u)), (None, changed(u)), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("key", F.lit(1))
    kept = minhash.one_of_each(df, shingle=3, similarity=(85, 100))
    assert kept.columns == df.columns and sorted([(r.doc_id or 0, r.text) for r in kept.collect()], key=repr) == sorted([(1, changed(a)), (2, changed(u)), (2, changed(u)), (0, changed(u)), (6, None)], key=repr)


def test_minhash_of_templates(spark, monkeypatch):
    """Texts that all have half of their words in common are glued by no chain of chance collisions, and the few links among them are found."""
    monkeypatch.setattr(minhash, "BLOCK", 64)
    frame = [f"t{i}" for i in range(70)]
    texts = {d: " ".join([*frame, *(f"d{d // 2 if d % 50 == 1 else d}x{i}" for i in range(30))]) for d in range(1000)}
    texts |= {1000 + d: texts[d * 100 + 1] for d in range(10)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    first = {}
    want = {d: first.setdefault(t, d) for d, t in texts.items()}
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df, shingle=3, similarity=(85, 100)).collect()} == want
