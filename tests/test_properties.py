"""Property tests: operators against brute-force Python models on random micro-tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellmart.functions import rules
from cellmart.operators.changes import upsert
from cellmart.operators.pivot import conditional_sums

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.one_of(st.none(), st.integers(0, 6))


@SETTINGS
@given(st.lists(st.tuples(keys, st.text("ab", max_size=2)), max_size=12),
       st.lists(st.tuples(keys, st.text("xy", max_size=2)), max_size=8, unique_by=lambda r: r[0]))
def test_upsert_matches_merge_model(spark, target, source):
    t = spark.createDataFrame(target, "id int, v string")
    s = spark.createDataFrame(source, "id int, v string")
    got = sorted(repr((r.id, r.v)) for r in upsert(t, s, ["id"], check=False).collect())
    src = {k: v for k, v in source if k is not None}
    # MERGE model: matched target rows take the source value, unmatched source rows are
    # inserted, other target rows stay; NULL keys never match.
    model = [(k, src[k] if k is not None and k in src else v) for k, v in target]
    target_keys = {k for k, _ in target if k is not None}
    model += [(k, v) for k, v in source if k is None or k not in target_keys]
    assert got == sorted(repr(x) for x in model)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("pq"), st.sampled_from(["2G", "3G", "4G", "WIFI", "Other", "5G"]),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=30))
def test_conditional_sums_match_case_model(spark, data):
    df = spark.createDataFrame(data, "k string, t string, m int")
    got = {r["k"]: r.asDict() for r in conditional_sums(df, ["k"], F.col("t"), {"X": F.col("m")},
                                                         {"X": rules.VOICE_BUCKETS}).collect()}
    for k in {k for k, _, _ in data}:
        for value, suffix in rules.VOICE_BUCKETS:
            # SUM(CASE WHEN t = value THEN m ELSE 0 END): NULL only when every row of the key is
            # in the bucket with a NULL measure.
            terms = [(m if t == value else 0) for kk, t, m in data if kk == k]
            non_null = [x for x in terms if x is not None]
            expected = sum(non_null) if non_null else None
            assert got[k][f"X_{suffix}"] == expected


import datetime as _dt

from cellmart.operators.joins import effective_dated_join

codes = st.one_of(st.none(), st.sampled_from(["A", " A", "B ", "B", "C"]))
days = st.integers(0, 20).map(lambda n: _dt.date(2021, 1, 1) + _dt.timedelta(days=n))


@SETTINGS
@given(st.lists(st.tuples(codes, days), max_size=10),
       st.lists(st.tuples(codes, days, st.integers(0, 8)), max_size=8))
def test_effective_dated_join_matches_model(spark, facts, windows):
    fact = spark.createDataFrame([(i, c, d) for i, (c, d) in enumerate(facts)], "fid int, code string, d date")
    dim = spark.createDataFrame([(j, c, s, s + _dt.timedelta(days=n)) for j, (c, s, n) in enumerate(windows)],
                                "wid int, pcode string, s date, e date")
    j = effective_dated_join(fact, dim, fact_key=F.col("code"), dim_key=F.col("pcode"), fact_date=F.col("d"),
                             start=F.col("s"), end=F.col("e"))
    got = sorted((r.fid, r.wid if r.wid is not None else -1) for r in j.collect())
    model = []
    for i, (c, d) in enumerate(facts):
        hits = [w for w, (pc, s, n) in enumerate(windows)
                if c is not None and pc is not None and c.strip() == pc.strip()
                and s <= d <= s + _dt.timedelta(days=n)]
        model += [(i, w) for w in hits] or [(i, -1)]
    assert got == sorted(model)
