"""Vector codes against SQL, plain Python and awkward rows."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from conftest import SF

from silverloom.llm import queries, vectorcodes


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    df = queries.op13_vector_codes(spark, SF)
    want = con.sql(queries.oracle_sql()["op13_vector_codes"])
    assert sorted(want.columns) == sorted(df.columns)
    cols = sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(want.select(*cols).fetchall())


@pytest.mark.parametrize("spread", [1, 3, 50, 100_000])
def test_nearest_is_exact_with_ties(spread):
    """Few distinct values give many equal distances and equal norms."""
    rng = np.random.default_rng(spread)
    for entries in (1, 2, 16, 200):
        x, e = rng.integers(-spread, spread + 1, (500, 4)), rng.integers(-spread, spread + 1, (entries, 4))
        d = ((x[:, None, :] - e[None]) ** 2).sum(axis=2)
        index, best = vectorcodes.nearest(x, e)
        assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    big = np.array([[vectorcodes.GREATEST, -vectorcodes.GREATEST], [vectorcodes.GREATEST - 1, -vectorcodes.GREATEST], [0, 0]], np.int64)
    index, best = vectorcodes.nearest(big, big[[2, 1, 0]])
    assert index.tolist() == [2, 1, 0] and best.tolist() == [0, 0, 0]


def plain(rows, parts, entries, rounds):
    """{row number: (code, error, label)} by lists of Python integers."""
    kept = [(k, i, [math.floor(4096 * c) for c in v], lb) for k, (i, v, lb) in enumerate(rows)]
    order = sorted(kept, key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    w = len(kept[0][2]) // parts
    books = [[r[2][p * w : (p + 1) * w] for r in order[:entries]] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * w : (p + 1) * w], e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = [[] for _ in books[p]]
            for r in kept:
                own[near(r[2], p)[1]].append(r[2][p * w : (p + 1) * w])
            new.append([[sum(c) // len(m) for c in zip(*m)] if m else e for e, m in zip(books[p], own)])
        books = new
    found = {}
    for k, _, v, lb in kept:
        got = [near(v, p) for p in range(parts)]
        found[k] = ("".join(f"{n:02x}" for _, n in got), sum(d for d, _ in got), lb)
    flat = [c for b in books for e in b for c in e]
    return found, hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


SCHEMA = "vec_id long, embedding array<float>, label int, id long, x int, v string, code string, n long"


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.integers(-3, 4, 4)], [None, 1, 2][i % 3]) for i in range(40)]
    good += [(7, good[7][1], good[7][2]), (None, [0.1, 0.2, 0.3, 0.4], 9), (90, [0.0] * 4, None), (-5, [1e-5, -1e-5, 30000.0, -32768.0], 2)]
    bad = [(91, None, 1), (92, [1.0, None, 1.0, 1.0], 1), (93, [float("nan")] + [1.0] * 3, 1), (94, [float("inf")] + [1.0] * 3, None), (95, [], 1), (96, [1.0] * 8, 1)]
    df = spark.createDataFrame([(*r, 1, 1, "v", "c", 1) for r in good + bad], SCHEMA).repartition(3)
    for entries, rounds in ((16, 6), (3, 2), (100, 1)):
        got = vectorcodes.compress(df, parts=2, entries=entries, rounds=rounds).collect()
        want, digest = plain([(i, [float(np.float32(c)) for c in v], lb) for i, v, lb in good], 2, entries, rounds)
        total = {}
        for _, e, lb in want.values():
            total[lb] = total.get(lb, 0) + e
        expected = sorted(((good[k][0], c, e, total[lb]) for k, (c, e, lb) in want.items()), key=repr)
        assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=repr) == expected
        assert {r.codebooks_sha256 for r in got} == {digest}
    assert vectorcodes.compress(df.where("false"), parts=2).count() == 0
    assert vectorcodes.compress(df.where("embedding is null"), parts=2).count() == 0
    with pytest.raises(ValueError):
        vectorcodes.compress(df, parts=3)
    with pytest.raises(Exception, match="32768"):
        vectorcodes.compress(spark.createDataFrame([(1, [1e6, 0.0], 1)], "vec_id long, embedding array<float>, label int"), parts=2).collect()
