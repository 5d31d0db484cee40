"""Loads that fail, run again or read odd files; refreshes of partitioned tables."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellmart import schemas, session
from cellmart.operators.changes import update_from, upsert
from cellmart.operators.quality import GateError
from cellmart.plans import ledger, loads, oracle_queries, roles, usage
from cellmart.sinks import writers
from cellmart.sources.delimited import read_delimited
from cellmart.sources.files import count_files
from cellmart.streaming.landing import landing_stream, run_once

TS = dt.datetime(2001, 8, 15, 6)


def _land(spark, folder, months, manifest):
    names = schemas.MONTHLY_STAGING.fieldNames()
    rows = spark.createDataFrame([(m, f"n{i}") for i, m in enumerate(months)], "month_id long, msisdn string")
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(schemas.MONTHLY_STAGING[c].dataType).alias(c) for c in names])
    writers.write_csv(rows, f"{folder}/data", names, sep="|", compression="gzip")
    spark.createDataFrame([(f"H\n{manifest}",)], "value string").write.mode("overwrite").text(f"{folder}/manifest")


def _load(spark, tmp_path):
    return loads.monthly_load_with_checks(
        spark, landing_dir=str(tmp_path / "landing"), month="200107", table_path=str(tmp_path / "table"), record_ts=TS,
        min_files=0, manifest_glob="manifest/*.txt", data_glob="data/*.csv.gz")


def test_a_refused_load_leaves_no_rows_and_a_repeated_one_no_doubles(spark, tmp_path):
    table = str(tmp_path / "table")
    _land(spark, str(tmp_path / "landing"), [200107] * 3, 5)
    with pytest.raises(GateError):
        _load(spark, tmp_path)
    assert not os.path.exists(table)
    _land(spark, str(tmp_path / "landing"), [200107] * 3, 3)
    for _ in range(2):
        assert _load(spark, tmp_path).ok
        assert spark.read.parquet(table).count() == 3
    _land(spark, str(tmp_path / "landing"), [200107, 200106], 2)
    with pytest.raises(GateError):
        _load(spark, tmp_path)
    assert spark.read.parquet(table).count() == 3


def test_a_broken_ledger_is_an_error_and_an_absent_one_is_empty(spark, tmp_path):
    assert ledger.ledger(spark, str(tmp_path / "absent")).count() == 0
    folder = tmp_path / "broken__ledger"
    folder.mkdir()
    (folder / "part-0.parquet").write_bytes(b"PAR1 no parquet PAR1")
    with pytest.raises(Exception, match="FOOTER|footer|parquet"):
        ledger.ledger(spark, str(tmp_path / "broken")).collect()


def test_gate_counts_file_names_of_the_month_only(spark, tmp_path):
    folder = tmp_path / "in_200107"
    folder.mkdir()
    for name in ("u_200106.gz", "d_20010712.gz", "u_200107.gz", "200107.gz", "empty_200107.gz"):
        (folder / name).write_text("" if name.startswith("empty") else "x")
    assert count_files(spark, str(tmp_path), "*.gz", recursive=True, contains="200107") == 2


def test_refresh_replaces_partitions_that_are_gone(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.refresh(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["k"])
    writers.refresh(spark.createDataFrame([(9, "a")], "k int, v string"), path, ["k"])
    assert [tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()] == [(9, "a")]
    writers.replace_partitions(spark.createDataFrame([(8, "c")], "k int, v string"), path, ["k"])
    assert spark.read.parquet(path).count() == 2


def test_stream_and_batch_read_the_same_dialect_and_archive(spark, tmp_path):
    schema = StructType.fromDDL("k int, v string")
    landing, archive = tmp_path / "landing", tmp_path / "archive"
    landing.mkdir()

    def run():
        run_once(landing_stream(spark, str(landing), schema, str(tmp_path / "out"), str(tmp_path / "ckpt"), str(archive)))

    (landing / "a.csv").write_text('k|v\n3|"say ""hi|there"""\n')
    batch = read_delimited(spark, str(landing), schema).collect()
    run()
    assert spark.read.parquet(str(tmp_path / "out")).collect() == batch == [(3, 'say "hi|there"')]
    (landing / "b.csv").write_text("k|v\n4|x\n")
    run()
    (landing / "c.csv").write_text("k|v\n5|y\n")
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert {f for _, _, names in os.walk(archive) for f in names if f.endswith(".csv")} >= {"a.csv"}


def test_update_from_refuses_repeated_keys(spark):
    target = spark.createDataFrame([(1, 0), (2, 0)], "k int, v int")
    updates = spark.createDataFrame([(1, 5), (1, 6)], "k int, n int")
    with pytest.raises(PySparkException):
        update_from(target, updates, ["k"], F.lit(True), {"v": "n"}).collect()
    once = update_from(target, updates.limit(1), ["k"], F.lit(True), {"v": "n"})
    assert sorted(r["v"] for r in once.collect()) == [0, 5]


def test_upsert_does_not_shuffle_the_target(spark):
    target = spark.range(100_000).withColumn("v", F.lit(0))
    plan = upsert(target, target.limit(5), ["id"], check=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "LeftOuter" in plan and "LeftAnti" in plan


def test_expired_partitions_go(spark, tmp_path):
    days = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 5, 9)], "day date, v int")
    writers.append(days, str(tmp_path / "t"), partition_by=["day"])
    writers.append(spark.createDataFrame([(None, 0)], "day date, v int"), str(tmp_path / "t"), partition_by=["day"])
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("day=2024-01-0[59]/*.parquet")}
    assert writers.expire_partitions(spark, str(tmp_path / "t"), "day", 5, dt.date(2024, 1, 9)) == ["2024-01-01"]
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [0, 5, 9]
    # The kept files are the same ones, and a second run finds nothing.
    assert files == {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("day=2024-01-0[59]/*.parquet")}
    assert writers.expire_partitions(spark, str(tmp_path / "t"), "day", 5, dt.date(2024, 1, 9)) == []


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_placeholder_number_with_many_cards_and_tied_contracts(spark):
    """The flagship where one number holds most of the rows: the result equals the oracle."""
    import duckdb

    sf = "/root/testdata/sf0.001"
    u = roles.usage(spark, sf)
    hot = u.withColumn("msisdn", F.when(F.col("first_cell_data_id") % 3 > 0, F.lit("7")).otherwise(F.col("msisdn"))).withColumn(
        "imsi", F.when(F.col("msisdn") == "7", F.concat(F.lit("c"), F.col("date_of_call"))).otherwise(F.col("imsi")))
    b = roles.base(spark, sf)
    tied = b.withColumn("subscriber_num", F.when(F.col("subscriber_num").cast("int") % 4 == 0, F.lit("7")).otherwise(F.col("subscriber_num"))).withColumn(
        "contract_start_date", F.when(F.col("subscriber_num") == "7", F.lit(dt.date(1994, 1, 1))).otherwise(F.col("contract_start_date")))
    mart = usage.usage_mart(tied, roles.products(spark, sf), roles.products2(spark, sf), hot, roles.cells(spark, sf), roles.ORDERS_AS_OF)
    c = duckdb.connect()
    for name, df in (("usage", hot), ("base", tied), ("products", roles.products(spark, sf)), ("products2", roles.products2(spark, sf)), ("cells", roles.cells(spark, sf))):
        c.register(f"{name}_given", df.toArrow())
    ctes = ", ".join(f"{n} AS (SELECT * FROM {n}_given)" for n in ("usage", "base", "products", "products2", "cells"))
    want = c.sql(f"WITH {ctes} {oracle_queries._MART} SELECT * FROM mart")
    names = sorted(want.columns)

    def shape(rows):
        return sorted(repr(tuple(round(float(v), 6) if isinstance(v, (int, float)) else str(v) for v in r)) for r in rows)

    got = [tuple(r) for r in mart.select(*names).collect()]
    expected = shape(want.select(*names).fetchall())
    assert sum(r[names.index("MSISDN")] == "07" for r in got) > 100
    assert shape(got) == expected
