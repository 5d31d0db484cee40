"""Sources and sinks: strict typed loads, manifests, file counts, partition guard, retention;
plus a property test of rank-first."""

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellmart.operators.rank import rank_first
from cellmart.sinks import writers
from cellmart.sources.delimited import read_delimited
from cellmart.sources.files import count_files, manifest_counts, read_manifest


def test_failfast_load_rejects_a_malformed_row(spark, tmp_path):
    p = tmp_path / "bad.dat"
    p.write_text("date_of_call|msisdn|calls\n20210701|07|3\n20210702|08|not-a-number\n")
    df = read_delimited(spark, str(p), "date_of_call long, msisdn string, calls long", sep="|")
    with pytest.raises(Exception):
        df.collect()


def test_typed_load_and_pipe_quoting_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a|b', 'say "hi"'), (2, "", None)], "id long, x string, y string")
    out = str(tmp_path / "out")
    writers.write_csv(df, out, ["id", "x", "y"], sep="|", compression="gzip")
    back = read_delimited(spark, out + "/*.csv.gz", "id long, x string, y string", sep="|")
    got = sorted((r.id, r.x, r.y) for r in back.collect())
    assert got[0] == (1, "a|b", 'say "hi"')
    assert got[1][0] == 2


def test_manifest_last_line_and_file_counts(spark, tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    (d / "EE_USAGE_202107_001.dat.gz").write_bytes(b"x")
    (d / "EE_USAGE_202107_002.dat.gz").write_bytes(b"x")
    (d / "EE_USAGE_202106_001.dat.gz").write_bytes(b"x")
    (d / "EE_USAGE_202107_HASH.dat").write_text("HASH abc\nrows\n1234\n\n")
    assert read_manifest(spark, str(d / "EE_USAGE_202107_HASH.dat")) == 1234
    bad = tmp_path / "bad_HASH.dat"
    bad.write_text("no count here\n")
    assert manifest_counts(spark, str(bad)).first()["expected_rows"] is None
    assert count_files(spark, str(d), recursive=True, contains="202107") == 3
    assert count_files(spark, str(d), "*.dat.gz") == 3


def test_read_period_requires_bounds_and_prunes(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2021, 7, d)) for d in range(1, 11)], "id long, call_date date")
    path = str(tmp_path / "t")
    writers.append(df, path, partition_by=["call_date"])
    with pytest.raises(ValueError):
        writers.read_period(spark, path, "call_date", None, dt.date(2021, 7, 5))
    got = writers.read_period(spark, path, "call_date", dt.date(2021, 7, 3), dt.date(2021, 7, 5))
    assert got.count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "call_date" in plan
    assert len([n for n in os.listdir(path) if n.startswith("call_date=")]) == 10


def test_retention_boundary(spark):
    df = spark.createDataFrame([(dt.date(2021, 7, d),) for d in (1, 2, 3)], "d date")
    kept = writers.retain(df, "d", 30, dt.date(2021, 8, 1))   # 2021-07-02 + 30 days = 2021-08-01: expired
    assert [r.d for r in kept.orderBy("d").collect()] == [dt.date(2021, 7, 3)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.one_of(st.none(), st.integers(0, 5))), min_size=1,
                max_size=40))
def test_rank_first_property(spark, data):
    df = spark.createDataFrame(data, "k string, v int")
    got = [(r.k, r.v) for r in rank_first(df, ["k"], [F.asc_nulls_first("v")]).collect()]
    for k in {k for k, _ in data}:
        vals = [v for kk, v in data if kk == k]
        best = None if None in vals else min(vals)
        expected = [v for v in vals if v == best]
        assert sorted((v for kk, v in got if kk == k), key=str) == sorted(expected, key=str)


def test_control_value(spark):
    from cellmart.sources.files import control_value
    ctl = spark.createDataFrame([("next_mthly_file_mon", "202108"), ("other", "x")],
                                "property_name string, property_value string")
    assert control_value(ctl, "next_mthly_file_mon") == "202108"
    with pytest.raises(KeyError):
        control_value(ctl, "missing")


def test_ratings_text_sink(spark, tmp_path):
    from cellmart.plans.text_flows import ratings_above, write_ratings
    src = tmp_path / "ratings.csv"
    src.write_text("user,movie,rating\n1,m1,4.5\n2,m2,3.0\n3,m3,4.0\n4,m4,5\n")
    kept = ratings_above(spark, str(src), ["user", "movie", "rating"])
    out = str(tmp_path / "results")
    write_ratings(kept, out)
    lines = sorted(line for f in os.listdir(out) if f.startswith("part-")
                   for line in open(os.path.join(out, f)).read().splitlines())
    assert lines == ["1,m1,4.5", "4,m4,5"]


ODD_TEXTS = [(1, "plain", 2.5), (2, " padded\t", None), (None, 'say "hi"', 1e20), (-4, "a|b", -0.0), (5, "", None),
             (6, None, 3.0), (7, "two\nlines", 1.0), (8, "back\\slash", 1.0), (9, "#", 1.0), (10, "caf\u00e9\r", 1.0)]


@pytest.mark.parametrize("fill", ["", "-"])
def test_a_text_sink_prints_plain_columns_as_casts_do(spark, tmp_path, fill):
    df = spark.createDataFrame(ODD_TEXTS, "id long, x string, y double").coalesce(1)
    order = ["x", "id", "none", "y"]
    cast = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(fill)).alias(c) if c in df.columns else F.lit(fill).alias(c) for c in order])
    cast.write.option("sep", "|").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(f"{tmp_path}/cast")
    writers.write_csv(df, f"{tmp_path}/sink", order, sep="|", fill=fill)
    texts = [b"".join(p.read_bytes() for p in (tmp_path / name).glob("*.csv")) for name in ("cast", "sink")]
    assert texts[0] == texts[1] and texts[0].startswith(b"x|id|none|y\n")
    assert dict(writers.in_order(df, order, fill).dtypes)["id"] == ("bigint" if fill == "" else "string")


def test_a_compressed_text_sink_takes_the_fast_level(spark, tmp_path):
    rows = spark.range(0, 20000, 1, 1).selectExpr("id", "cast(id * 7919 % 10007 AS string) AS x")
    writers.write_csv(rows, f"{tmp_path}/sink", ["id", "x"], compression="gzip")
    rows.write.option("header", True).option("compression", "gzip").csv(f"{tmp_path}/default")
    small, fast = (sum(p.stat().st_size for p in (tmp_path / n).glob("*.csv.gz")) for n in ("default", "sink"))
    assert fast > small
    assert read_delimited(spark, f"{tmp_path}/sink/*.gz", "id long, x string", sep=",").exceptAll(rows).isEmpty()
