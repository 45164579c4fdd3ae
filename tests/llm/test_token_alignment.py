"""Token alignment against plain Python over the same tokenizers."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silverloom.llm import align, bpe, queries

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "Hello world", "Hello world", "a<|endoftext|>b <s> </s> <0x41>", "under▁score", "x ▁y", "é\U0001f642 naïve\r\n\r\n  two  ", "\t\ttab", "\x00\x01", "　日本語の文",
    " " * 20_000 + "end", "\n" * 300_000, "a" * 50_000, "w1 w2,w3 " * 20_000, "ﬁ Ｆ x² é", "<unk>", "'s 'LL they'll",
]


@pytest.fixture(scope="module")
def plain():
    tok, sp, alphabet = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), bpe.byte_alphabet()
    tok.encode_special_tokens = True

    def ends(parts):
        return np.cumsum([len(p) for p in parts]).tolist()

    def of(text):
        """(A's ids, B's ids, groups, links) by token ends in plain lists and sets."""
        full = (" " + (text or "")).encode()
        a, b = tok.encode(" " + (text or ""), add_special_tokens=False).ids, sp.encode(text or "")
        as_a = [bytes(alphabet[c] for c in tok.id_to_token(i)) for i in a]
        as_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, sp.id_to_piece(i)) for i in b)]
        if not text or b"".join(as_a) != full or b"".join(as_b) != full:
            return [], [], [], []
        ea, eb = ends(as_a), ends(as_b)
        groups, i, j = [], 0, 0
        for cut in sorted(set(ea) & set(eb)):
            k, m = i, j
            while i < len(ea) and ea[i] <= cut:
                i += 1
            while j < len(eb) and eb[j] <= cut:
                j += 1
            groups.append((a[k:i], b[m:j]))
        links, i, j = [], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ea[i], eb[j]
            i, j = i + (x <= y), j + (y <= x)
        return a, b, groups, links

    return of


def expected(plain, texts):
    found = {i: plain(t) for i, t in texts}
    count = Counter(p for _, _, _, links in found.values() for p in set(links))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(n, top.get(a, 0))
    out = {}
    for i, (a, b, groups, links) in found.items():
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(said.encode()).hexdigest() if a else ""
        out[i] = (i, len(a), len(b), len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), digest)
    return out


def test_documents(spark, plain):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    df = queries.op11_token_alignment(spark, SF)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r.doc_id: tuple(r) for r in df.collect()} == expected(plain, [tuple(r) for r in rows])


def test_awkward_texts(spark, plain, monkeypatch):
    rows = list(enumerate(TEXTS))
    want = expected(plain, rows)
    assert want[5][1] > 0 and want[6] == (6, 0, 0, 0, 0, 0, 0, "") and want[12][1] > 0 and want[13][1] > 0
    df = spark.createDataFrame([(i, t, 1, 2, 3, "p") for i, t in rows], "doc_id long, text string, row long, pair long, n long, pairs string").repartition(3)
    for most in (align.HELD, 40, 0):  # few pairs held, then none
        monkeypatch.setattr(align.frequent, "__defaults__", (most,))
        assert {r.doc_id: tuple(r) for r in align.link(df, A, B).collect()} == want
    twice = align.link(df.union(df.where("doc_id is not null")).withColumn("doc_id", F.when(F.col("doc_id") != 3, F.col("doc_id"))), A, B).collect()
    assert len(twice) == 2 * len(rows) and sum(r.doc_id is None for r in twice) == 2
    assert align.link(df.where("false"), A, B).count() == 0


def test_groups(spark, plain):
    df = spark.createDataFrame(list(enumerate(TEXTS[:9])), "doc_id long, text string")
    got = align.alignments(df, A, B).orderBy("doc_id", "group").collect()
    for i, t in enumerate(TEXTS[:9]):
        own = [r for r in got if r.doc_id == i]
        assert [(list(r.a), list(r.b)) for r in own] == [(x, y) for x, y in plain(t)[2]]
        assert [r.group for r in own] == list(range(len(own))) and all(r.end == s.start for r, s in zip(own, own[1:]))
        assert not own or (own[0].start, own[-1].end) == (0, len((" " + t).encode()))
