"""Edge cases of the expressions, and month arithmetic against a model."""

import datetime as dt

from dateutil.relativedelta import relativedelta
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverloom.functions import dates as D
from silverloom.functions import json as J
from silverloom.functions import numbers as N
from silverloom.functions import strings as S
from silverloom.operators import profile


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first().y


def test_strings(spark):
    for value, want in ((None, None), ("", None), (" \t\n", None), (" a b\n", "a b"), (" x", "x")):
        assert one(spark, value, S.clean_text) == want
    assert one(spark, "<p>a<b>b</b></p>\n\t<i></i>c &amp;", S.strip_html) == "a b c &amp;"
    assert one(spark, "[1, 2,,2]", S.id_list) == ["1", "2", "2"]
    assert [one(spark, m, S.tenure_bucket, "int") for m in (-1, 11, 12, 23, 24)] == ["1-11 months"] * 2 + ["12-23 months"] * 2 + ["24+ months"]
    assert [one(spark, m, S.capacity_bucket, "int") for m in (0, 24, 25, 74, 75)] == ["0-24"] * 2 + ["25-74"] * 2 + ["75+"]
    assert [one(spark, v, S.notice_months) for v in ("3 Months", "in 3 months", "N/A", None)] == [3, 0, 0, 0]
    assert one(spark, "12_Ann_f7", S.stem_parts).asDict() == {"coworker_id": "12", "coworker_name": "Ann", "file_id": "f7"}
    assert one(spark, "12_f7", S.stem_parts).asDict() == {"coworker_id": "12", "coworker_name": "", "file_id": "f7"}
    assert one(spark, "unknown", S.renewal_category) == "personalized"
    assert [one(spark, v, S.classify_renewal) for v in ("The same term", " ", "", None)] == ["same_period_initial_commitment", "personalized", "unknown", "unknown"]


def test_numbers(spark):
    assert [one(spark, d, N.walking_minutes, "int") for d in (0, 40, 200, 280)] == [1, 1, 2, 4]
    assert [one(spark, v, N.to_int) for v in ("12.5", " 12 ", "abc", None)] == [None, 12, None, None]


def test_json(spark):
    raw = '{"a": 12.9, "b": "12.5", "c": null, "d": false, "e": "false", "f": 0, "g": ""}'
    v = lambda f: one(spark, raw, lambda x: f(J.parsed(x)))
    assert v(lambda x: J.field(x, "a", "bigint")) == 12 and v(lambda x: J.field(x, "b", "bigint")) is None
    assert [v(lambda x, k=k: J.truthy(x, k)) for k in "acdefgz"] == [True, None, False, True, False, False, None]
    assert v(lambda x: J.has(x, "c")) and not v(lambda x: J.has(x, "z"))
    assert one(spark, "{bad", J.parsed) is None
    assert spark.range(1).select(J.constant({"a": {"b": "c"}}).alias("m")).first().m == {"a": {"b": "c"}}


def test_profile(spark):
    """Counts, kinds and samples as a plain walk finds them; nested objects count as one value."""
    raws = ['{"a": 1, "o": {"x": [{"y": 1}], "z": {"w": {"deep": 1}}}}', '{"a": null, "o": {"x": []}, "l": ["s"]}', '{"a": 2.5, "o": {}}', "bad", '{"a": "t"}']
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = {r.path: (r.n, r.kinds, r.samples, r.flag) for r in profile.coverage(df, "raw").collect()}
    want = {
        "a": (4, ["NoneType", "float", "int", "str"], ["1", "2.5", "t"], ""), "o": (3, ["dict"], ["[dict]"], "constant"), "o.x": (2, ["list"], ["[list]"], "constant"), "o.x[].y": (1, ["int"], ["1"], "constant"),
        "o.z": (1, ["dict"], ["[dict]"], "constant"), "o.z.w": (1, ["dict"], ["[dict]"], "constant"), "o.z.w.deep": (1, ["int"], ["1"], "constant"), "l": (1, ["list"], ["[list]"], "constant"),
    }
    assert got == want
    assert {r.path for r in profile.coverage(df, "raw", depth=3, drop=["o"]).collect()} == {"a", "l"}


def test_parse_date(spark):
    cases = {
        "2025-08-01": dt.date(2025, 8, 1), "1/3/2026": dt.date(2026, 3, 1), "1.1.2025": dt.date(2025, 1, 1), "01/03/26": dt.date(2026, 3, 1), "31/06/2025": dt.date(2025, 6, 30),
        "2028-02-31": dt.date(2028, 2, 29), "01.05.2025, then monthly": dt.date(2025, 5, 1), "TBD": None, "0/5/2025": None, "1/13/2025": None, None: None,
        "30 days after 12 months of 2025": None, "1 of 3 phases in 2026": None, "1/2/3/2025": None, "45/06/2025": dt.date(2045, 6, 30), "01/03/75": dt.date(1975, 3, 1), "1 / 3 / 2026": dt.date(2026, 3, 1), "2025-8-1 then on": dt.date(2025, 8, 1),
    }
    for text, want in cases.items():
        assert one(spark, text, D.parse_date) == want, text
    assert one(spark, "10:30", D.parse_timestamp) is None


day = st.dates(dt.date(2000, 1, 1), dt.date(2035, 12, 31))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(day, day), min_size=100, max_size=100))
def test_complete_months(spark, pairs):
    got = spark.createDataFrame(pairs, "a date, b date").select("a", "b", D.complete_months(F.col("a"), F.col("b")).alias("m")).collect()
    for r in got:
        delta = relativedelta(r.b, r.a)
        assert r.m == delta.years * 12 + delta.months


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(day, st.integers(1, 800), st.booleans(), st.integers(0, 12)), min_size=60, max_size=60))
def test_roll_forward_and_notice(spark, terms):
    as_of = dt.date(2030, 3, 31)
    rows = [(s, s + dt.timedelta(n), "monthly" if m else "same_duration", k) for s, n, m, k in terms]
    df = spark.createDataFrame(rows, "s date, e date, c string, n int")
    m, d = D.renewal_delta(F.col("s"), F.col("e"), F.col("c"))
    df = df.withColumns({"m": m, "d": d}).withColumn("r", D.roll_forward(F.col("e"), F.col("m"), F.col("d"), F.lit(as_of)))
    df = df.withColumn("q", D.notice_end(F.col("r"), F.col("m"), F.col("d"), F.lit(as_of), F.col("n")))
    for r in df.collect():
        x = relativedelta(r.e, r.s)
        step = relativedelta(months=1) if r.c == "monthly" else relativedelta(months=x.years * 12 + x.months, days=x.days)
        end = r.e
        while end < as_of:
            end += step
        assert r.r == end
        for _ in range(120):
            if as_of + relativedelta(months=r.n) <= end:
                break
            end += step
        assert r.q == end
