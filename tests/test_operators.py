"""Operators on hand-written micro-tables with NULL, tie, whitespace, duplicate and empty rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellmart.functions import calendar as cal
from cellmart.functions import rules
from cellmart.functions.text import safe_long, tokenise, trim_ws, zero_prefix
from cellmart.operators.aggregates import sign_flag
from cellmart.operators.changes import AmbiguousMatchError, conditional_update, stamp_missing, update_from, upsert
from cellmart.operators.joins import effective_dated_join, prefix_join
from cellmart.operators.pivot import conditional_sums
from cellmart.operators.quality import GateError, next_period, reconcile, require_files
from cellmart.operators.rank import rank_first
from cellmart.operators.setops import union_distinct
from tests.conftest import rows

D = dt.date


def test_rank_first_keeps_ties_and_sorts_null_first(spark):
    df = spark.createDataFrame([
        ("a", D(2020, 1, 5), 1), ("a", D(2020, 1, 5), 2), ("a", D(2020, 2, 1), 3),
        ("b", None, 4), ("b", D(2020, 1, 1), 5), ("c", D(2021, 1, 1), 6)],
        "k string, d date, id int")
    got = rank_first(df, ["k"], [F.asc_nulls_first("d")])
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 4, 6]
    one = rank_first(df, ["k"], [F.asc_nulls_first("d")], keep_ties=False)
    assert one.count() == 3


def test_rank_first_desc_puts_null_last(spark):
    df = spark.createDataFrame([("m", None, 1), ("m", "3G", 2), ("m", "4G", 3)], "m string, p string, id int")
    got = rank_first(df, ["m"], [F.desc("p")])
    assert [r["id"] for r in got.collect()] == [3]


def test_rank_first_empty_input(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert rank_first(df, ["k"], [F.desc("v")]).count() == 0


def test_effective_dated_join_edges(spark):
    fact = spark.createDataFrame([
        ("P1 ", D(2020, 1, 1)),   # boundary = start, padded code
        ("P1", D(2020, 6, 30)),   # boundary = end of first and inside second window
        ("P2", D(2020, 3, 1)),    # no match
        (None, D(2020, 3, 1))],   # NULL key
        "code string, d date")
    dim = spark.createDataFrame([
        (" P1", D(2020, 1, 1), D(2020, 6, 30), "w1"),
        ("P1", D(2020, 6, 1), D(2020, 12, 31), "w2"),
        ("P2", D(2021, 1, 1), D(2021, 12, 31), "w3")],
        "pcode string, s date, e date, tag string")
    j = effective_dated_join(fact, dim, fact_key=F.col("code"), dim_key=F.col("pcode"),
                             fact_date=F.col("d"), start=F.col("s"), end=F.col("e"))
    got = sorted(repr((r["code"], str(r["d"]), r["tag"])) for r in j.collect())
    assert got == sorted(repr(t) for t in [("P1 ", "2020-01-01", "w1"), ("P1", "2020-06-30", "w1"),
                                           ("P1", "2020-06-30", "w2"), ("P2", "2020-03-01", None),
                                           (None, "2020-03-01", None)])


def test_prefix_join_missing_device(spark):
    fact = spark.createDataFrame([("35000001999", 1), ("99999999000", 2), (None, 3)], "imei string, id int")
    dim = spark.createDataFrame([("35000001", "4G")], "tac string, protocol string")
    got = {r["id"]: r["protocol"] for r in prefix_join(fact, dim, "imei", "tac", 8).collect()}
    assert got == {1: "4G", 2: None, 3: None}


def _cells(spark, data):
    return spark.createDataFrame(data, "id long, name string, record_ts timestamp")


def test_upsert_matched_new_untouched_null_key(spark):
    t0, t1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    target = _cells(spark, [(1, "old", t0), (2, "keep", t0), (None, "nullkey", t0), (1, "old-dup", t0)])
    source = spark.createDataFrame([(1, "new"), (3, "insert"), (None, "nullsrc")], "id long, name string")
    got = sorted(repr((r["id"], r["name"], r["record_ts"]))
                 for r in upsert(target, source, ["id"], stamp_col="record_ts", stamp=t1).collect())
    assert got == sorted(repr(t) for t in [(1, "new", t1), (1, "new", t1), (2, "keep", t0), (3, "insert", t1),
                                           (None, "nullkey", t0), (None, "nullsrc", t1)])


def test_upsert_is_idempotent(spark):
    t1 = dt.datetime(2021, 1, 1)
    target = _cells(spark, [(1, "a", None), (2, "b", None)])
    source = spark.createDataFrame([(2, "B"), (3, "C")], "id long, name string")
    once = upsert(target, source, ["id"], stamp_col="record_ts", stamp=t1)
    twice = upsert(once, source, ["id"], stamp_col="record_ts", stamp=t1)
    assert rows(once) == rows(twice)


def test_upsert_duplicate_source_key_raises(spark):
    target = _cells(spark, [(1, "a", None)])
    source = spark.createDataFrame([(1, "x"), (1, "y")], "id long, name string")
    with pytest.raises(AmbiguousMatchError):
        upsert(target, source, ["id"], stamp_col="record_ts", stamp=dt.datetime(2021, 1, 1))


def test_stamp_missing_and_conditional_update(spark):
    ts = dt.datetime(2022, 7, 13)
    df = spark.createDataFrame([(" 07 ", None, 202203), ("\t08", ts, 202201), (" 09", ts, None)],
                               "msisdn string, record_ts timestamp, month_id long")
    stamped = stamp_missing(df, "record_ts", dt.datetime(2030, 1, 1))
    assert sorted(str(r[0]) for r in stamped.select("record_ts").collect()) == \
        ["2022-07-13 00:00:00", "2022-07-13 00:00:00", "2030-01-01 00:00:00"]
    upd = conditional_update(df, F.col("month_id") >= 202203, {"msisdn": trim_ws("msisdn")})
    assert sorted(r[0] for r in upd.select("msisdn").collect()) == ["\t08", " 09", "07"]


def test_update_from_aggregate_signs(spark):
    usage = spark.createDataFrame([
        ("a", 202104, 1), ("a", 202105, 1),      # sum > 0
        ("b", 202104, -1),                       # sum < 0
        ("c", 202104, 1), ("c", 202105, -1),     # sum = 0
        ("d", 202104, None),                     # sum NULL
        ("e", 202101, 1),                        # outside the window
        ("a", 202107, 0), ("b", 202107, 0), ("c", 202107, 0), ("d", 202107, 0), ("e", 202107, 0),
        ("a", 202106, 0)], "MSISDN string, AGG_MTH long, ACTIVE_30D_PAYG int")
    flags = sign_flag(usage.filter(F.col("AGG_MTH").between(202104, 202106)), ["MSISDN"], "ACTIVE_30D_PAYG",
                      flag_col="NEW_ACTIVE90D_FLAG")
    target = usage.withColumn("NEW_ACTIVE90D_PAYG", F.lit(None).cast("int"))
    out = update_from(target, flags, ["MSISDN"], F.col("AGG_MTH") == 202107,
                      {"NEW_ACTIVE90D_PAYG": "NEW_ACTIVE90D_FLAG"})
    got = {r["MSISDN"]: r["NEW_ACTIVE90D_PAYG"] for r in out.filter("AGG_MTH = 202107").collect()}
    assert got == {"a": 1, "b": -1, "c": 0, "d": None, "e": None}
    assert out.filter("AGG_MTH <> 202107").filter(F.col("NEW_ACTIVE90D_PAYG").isNotNull()).count() == 0


def test_union_distinct(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, None), (3, None)], "k int, v string")
    assert sorted((r.k, r.v) for r in union_distinct(a, b).collect()) == [(1, "x"), (2, "y"), (3, None)]


def test_conditional_sums_zero_for_empty_bucket_and_null_semantics(spark):
    df = spark.createDataFrame([
        ("a", "2G", 5), ("a", "3G", 7), ("a", "3G", None),
        ("b", "2G", None),                    # bucket rows all NULL -> NULL; other buckets 0
        ("c", "2G", None), ("c", "4G", 1)],   # NULL bucket + other bucket -> 0
        "k string, t string, m long")
    got = {r["k"]: r.asDict() for r in conditional_sums(
        df, ["k"], F.col("t"), {"X": F.col("m")}, {"X": rules.VOICE_BUCKETS}).collect()}
    assert (got["a"]["X_2G"], got["a"]["X_3G"], got["a"]["X_4G"], got["a"]["X_WI"]) == (5, 7, 0, 0)
    assert got["b"]["X_2G"] is None and got["b"]["X_3G"] == 0
    assert got["c"]["X_2G"] == 0 and got["c"]["X_4G"] == 1


def test_pivot_columns_sum_to_unpivoted_total(spark):
    df = spark.createDataFrame([(k, t, v) for k in "ab" for t, v in
                                [("2G", 1), ("3G", 2), ("4G", 3), ("WIFI", 4), ("Other", 5)]],
                               "k string, t string, m long")
    p = conditional_sums(df, ["k"], F.col("t"), {"X": F.col("m")}, {"X": rules.VOICE_BUCKETS})
    total = p.select(sum(F.col(f"X_{s}") for _, s in rules.VOICE_BUCKETS).alias("t")).collect()
    assert [r.t for r in total] == [15, 15]


@pytest.mark.parametrize("as_of,prev_start,prev_end,back13", [
    (D(2022, 3, 1), D(2022, 2, 1), D(2022, 2, 28), D(2021, 2, 1)),
    (D(2022, 3, 31), D(2022, 2, 1), D(2022, 2, 28), D(2021, 2, 28)),
    (D(2022, 1, 15), D(2021, 12, 1), D(2021, 12, 31), D(2020, 12, 15)),
    (D(2024, 3, 31), D(2024, 2, 1), D(2024, 2, 29), D(2023, 2, 28)),
])
def test_calendar_windows(spark, as_of, prev_start, prev_end, back13):
    r = spark.range(1).select(cal.prev_month_start(as_of).alias("a"), cal.prev_month_end(as_of).alias("b"),
                              cal.months_back(as_of, 13).alias("c")).first()
    assert (r.a, r.b, r.c) == (prev_start, prev_end, back13)


def test_month_and_day_keys(spark):
    r = spark.createDataFrame([(D(2021, 2, 3), "202102", 20210203)], "d date, k string, dk long").select(
        cal.month_key("d").alias("mk"), cal.month_key_str("d").alias("ms"), cal.day_key("d").alias("dk2"),
        cal.month_start("k").alias("m0"), cal.date_from_day_key("dk").alias("d2")).first()
    assert (r.mk, r.ms, r.dk2, r.m0, r.d2) == (202102, "202102", 20210203, D(2021, 2, 1), D(2021, 2, 3))


def test_text_helpers(spark):
    df = spark.createDataFrame([(" \t7 \n", "12a", "It's a dog's life, 42!")], "a string, b string, c string")
    r = df.select(trim_ws("a").alias("t"), zero_prefix(trim_ws("a")).alias("z"), safe_long("b").alias("s"),
                  tokenise("c").alias("w")).first()
    assert (r.t, r.z, r.s, r.w) == ("7", "07", None, ["It's", "a", "dog's", "life"])
    assert spark.range(1).select(zero_prefix(F.lit("0123")), zero_prefix(F.lit(None).cast("string"))).first() \
        == ("0123", None)


def test_quality_gates(spark):
    assert require_files(102, 102) == 102
    with pytest.raises(GateError):
        require_files(101, 102)
    assert next_period("202112") == "202201"
    before = spark.range(10).toDF("x")
    after = spark.range(15).toDF("x")
    for expected, ok in ((5, True), (6, False), (4, False)):
        r = reconcile(before, after, spark.createDataFrame([(expected,)], "n long")).first()
        assert (r.rows_before, r.rows_after, r.rows_loaded, r.rows_expected, r.ok) == (10, 15, 5, expected, ok)
