"""Loads that take every file once, archives, rewrites of several tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellmart import schemas
from cellmart.functions import calendar
from cellmart.operators.quality import GateError, LayoutDrift, layout_drift
from cellmart.plans import ledger, loads, network, roles
from cellmart.sinks import writers
from cellmart.sinks.snapshots import Snapshots

TS = dt.datetime(2001, 8, 15, 6)
COLUMNS = ["date_of_call"] + schemas.USAGE_COLUMNS


def land(spark, folder, days):
    rows = spark.createDataFrame([(d, n, c) for d, n, c in days], "date_of_call long, msisdn string, home_mo_count long")
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(schemas.DAILY_STAGING[c].dataType).alias(c) for c in COLUMNS])
    writers.write_csv(rows.coalesce(1), folder, COLUMNS, sep="|", compression="gzip")


def stored(spark, table):
    return sorted((r["date_of_call"], r["msisdn"] or "", r["home_mo_count"]) for r in ledger.read_loaded(spark, table).collect())


def test_a_late_file_adds_its_rows_and_no_file_is_taken_twice(spark, tmp_path):
    landing, table = str(tmp_path / "in"), str(tmp_path / "t")
    land(spark, landing + "/a", [(20010701, "x", 1), (20010701, "x", 1), (20010702, " y ", 5)])
    assert loads.load_daily(spark, landing, table, TS).rows_loaded == 3
    land(spark, landing + "/b", [(20010701, "z", 2), (20010703, None, 3)])
    report = loads.load_daily(spark, landing, table, TS)
    assert (report.files, report.rows_before, report.rows_loaded, report.rows_after, report.null_keys) == (1, 3, 2, 5, 1)
    assert loads.load_daily(spark, landing, table, TS).files == 0
    want = [(20010701, "x", 1), (20010701, "x", 1), (20010701, "z", 2), (20010702, "y", 5), (20010703, "", 3)]
    assert stored(spark, table) == want
    audit = ledger.loads_of(spark, table).orderBy("load_number").select("files", "rows_before", "rows_loaded", "null_keys", "measure", "keys").collect()
    assert [tuple(r) for r in audit] == [(1, 0, 3, 0, 7, 2), (1, 3, 2, 1, 5, 1)]


def test_a_load_that_breaks_before_its_commit_is_not_seen_and_not_doubled(spark, tmp_path, monkeypatch):
    landing, table = str(tmp_path / "in"), str(tmp_path / "t")
    land(spark, landing + "/a", [(20010701, "x", 1)])
    loads.load_daily(spark, landing, table, TS)
    land(spark, landing + "/b", [(20010701, "y", 2), (20010704, "y", 2)])

    def refuse(report):
        raise GateError("stop")

    files = ledger.new_files(spark, landing, "*.gz", table).collect()
    rows = loads.daily_final_rows(loads.staged_daily(spark, [f["path"] for f in files]), TS)
    with pytest.raises(GateError):
        ledger.publish(spark, rows, files, table, TS, partition_by=["call_date"], columns=loads.DAILY_COLUMNS, check=refuse)
    assert spark.read.parquet(table).count() == 3      # written, not committed
    assert stored(spark, table) == [(20010701, "x", 1)]
    loads.load_daily(spark, landing, table, TS)
    assert spark.read.parquet(table).count() == 3
    assert stored(spark, table) == [(20010701, "x", 1), (20010701, "y", 2), (20010704, "y", 2)]


def test_files_move_after_the_commit_only(spark, tmp_path, monkeypatch):
    landing, table, archive = tmp_path / "in", str(tmp_path / "t"), tmp_path / "old"
    land(spark, str(landing / "a"), [(20010701, "x", 1)])
    names = lambda folder: sorted(f.name for f in folder.rglob("*.gz"))
    first = names(landing)

    def broken(*args):
        raise OSError("no move")

    with monkeypatch.context() as m:
        m.setattr(ledger, "move_files", broken)
        with pytest.raises(OSError):
            loads.load_daily(spark, str(landing), table, TS, archive=str(archive))
    assert names(landing) == first and stored(spark, table) == [(20010701, "x", 1)]
    # The next run loads what is new and moves both files; nothing is loaded twice.
    land(spark, str(landing / "b"), [(20010701, "y", 1)])
    loads.load_daily(spark, str(landing), table, TS, archive=str(archive))
    assert names(landing) == [] and len(names(archive)) == 2 and set(first) < set(names(archive))
    assert stored(spark, table) == [(20010701, "x", 1), (20010701, "y", 1)]
    assert loads.load_daily(spark, str(landing), table, TS, archive=str(archive)).files == 0


def test_a_rewrite_changes_all_tables_or_none(spark, tmp_path, monkeypatch):
    tables = Snapshots(spark, str(tmp_path / "base"))
    day = lambda d: dt.date(2001, 7, d)
    ts = lambda d: dt.datetime(2001, 7, d)
    daily = spark.createDataFrame([(day(1), " a", ts(2)), (day(2), " b", ts(20)), (day(2), "c ", ts(3))], "call_date date, msisdn string, record_ts timestamp")
    monthly = spark.createDataFrame([(dt.date(2001, 6, 1), 200106, " a"), (dt.date(2001, 7, 1), 200107, " b")], "month_date date, month_id long, msisdn string")
    tables.rewrite({"daily": (daily, ["call_date"]), "monthly": (monthly, ["month_date"])})
    before = [sorted(map(tuple, tables.read(n).collect())) for n in ("daily", "monthly")]

    # The second table's rewrite breaks: both stay as they were.
    with monkeypatch.context() as m:
        m.setattr(loads, "key_backfill_monthly", lambda df, month: df.withColumn("msisdn", F.raise_error(F.lit("broken")).cast("string")))
        with pytest.raises(Exception, match="broken"):
            loads.backfill_keys(tables, dt.date(2001, 7, 10), 200107)
    assert [sorted(map(tuple, tables.read(n).collect())) for n in ("daily", "monthly")] == before

    old = tables.state()[1]
    loads.backfill_keys(tables, dt.date(2001, 7, 10), 200107)
    new = tables.state()[1]
    assert sorted(r["msisdn"] for r in tables.read("daily").collect()) == [" a", "b", "c "]
    assert sorted(r["msisdn"] for r in tables.read("monthly").collect()) == [" a", "b"]
    # Only the touched partitions have new folders.
    same = lambda n: [p for p, v in new[n]["folders"].items() if old[n]["folders"][p] == v]
    assert same("daily") == ["call_date=2001-07-01"] and same("monthly") == ["month_date=2001-06-01"]

    # A second writer that started from the same snapshot is refused.
    number, state = tables.state()
    tables._commit(number, state)
    with pytest.raises(RuntimeError):
        tables._commit(number, state)


def test_retention_by_snapshot_reads_and_writes_no_rows(spark, tmp_path):
    tables = Snapshots(spark, str(tmp_path / "base"))
    rows = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 5, 9)], "day date, v int")
    tables.rewrite({"t": (rows, ["day"])})
    files = sorted((tmp_path / "base").rglob("*.parquet"))
    assert tables.expire("t", 5, dt.date(2024, 1, 9)) == ["day=2024-01-01"]
    assert sorted(r["v"] for r in tables.read("t").collect()) == [5, 9]
    assert sorted((tmp_path / "base").rglob("*.parquet")) == files
    assert tables.expire("t", 5, dt.date(2024, 1, 9)) == []
    assert tables.expire("t", 0, dt.date(2024, 2, 1)) and tables.read("t").count() == 0


def test_clustered_site_mart_opens_one_bucket_and_joins_without_exchange(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "date_add(DATE'2001-06-01', cast(id % 60 AS int)) AS call_date", "cast(id % 97 AS string) AS site_id",
        "cast(id AS string) AS msisdn", "id % 7 AS TOTAL_CALLS_4G")
    sites = spark.range(97).selectExpr("cast(id AS string) AS site_id", "1.5D AS latitude", "2.5D AS longitude")
    mart, dim = network.store_site_usage(rows, sites, "site_mart_test", str(tmp_path / "t"))
    months = list((tmp_path / "t" / "mart").glob("month_date=*"))
    assert len(months) == 2 and all(len(list(m.glob("*.parquet"))) <= network.SITE_BUCKETS for m in months)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        one = mart.filter("month_date = DATE'2001-06-01' AND site_id = '13'")
        assert "SelectedBucketsCount: 1 out of 16" in one._jdf.queryExecution().executedPlan().toString()
        total = network.monthly_site_totals(mart, dim)
        got = total.collect()
        assert "Exchange" not in total._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert sum(r["mart_rows"] for r in got) == 4000 and len(got) == 2 * 97
    assert sum(r["calls_4g"] for r in got) == sum(i % 7 for i in range(4000))


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(20000).selectExpr("DATE'2001-06-01' AS call_date", "'S1' AS site_id", "cast(id AS string) AS msisdn", "id AS TOTAL_CALLS_4G")
    sites = spark.sql("SELECT 'S1' AS site_id, 1.5D AS latitude, 2.5D AS longitude")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        mart, dim = network.store_site_usage(rows, sites, "site_mart_large", str(tmp_path / "t"))
        assert len(list((tmp_path / "t" / "mart").rglob("*.parquet"))) > 1
        assert [(r["mart_rows"], r["calls_4g"]) for r in network.monthly_site_totals(mart, dim).collect()] == [(20000, sum(range(20000)))]
    finally:
        spark.conf.set(key, old)


def test_layout_drift_refuses_a_refresh(spark, tmp_path):
    good = spark.createDataFrame([("x",) * 8], schemas.DEVICE_EXTRACT)
    loads.declared_refresh(good, schemas.DEVICE_EXTRACT, str(tmp_path / "t"), TS)
    for bad in (good.drop("tac"), good.withColumn("more", F.lit(1)), good.withColumn("tac", F.lit(1))):
        with pytest.raises(LayoutDrift):
            loads.declared_refresh(bad, schemas.DEVICE_EXTRACT, str(tmp_path / "t"), TS)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    dates = spark.createDataFrame([("c", TS, None)], "product_code string, effective_date timestamp, expiration_date timestamp")
    drift = {x[0] for x in layout_drift(dates.schema, schemas.PRODUCT_EXTRACT)}
    assert "effective_date" not in drift and "brand" in drift


def test_month_of_a_long_key_is_that_of_its_text(spark):
    keys = [(k,) for k in (100001, 199912, 200002, 999912, None)]
    df = spark.createDataFrame(keys, "k long").select("k", calendar.month_start("k").alias("text"),
                                                      calendar.month_start_of_long("k", calendar.month_start("k")).alias("digits"))
    assert all(r["text"] == r["digits"] for r in df.collect())
    for wrong in (200100, 200113, 20011, -200101):
        with pytest.raises(Exception):
            spark.createDataFrame([(wrong,)], "k long").select(calendar.month_start_of_long("k", calendar.month_start("k"))).collect()


def test_usage_dealt_out_by_month_is_shuffled_before_its_columns_are_derived(spark, tmp_path):
    ts = [dt.datetime(2001, m, d, 5) for m in (1, 2, 3) for d in (1, 28)]
    spark.createDataFrame([(k, 7 + k, 100.0) for k in range(6)], "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, 1, 2, 3, 4.0, 50.0, t) for k, t in enumerate([*ts[:5], None])],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    plain, dealt = roles.usage(spark, str(tmp_path)), roles.usage(spark, str(tmp_path), by_month=True)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, dealt.collect()))
    places = dealt.select("month_id", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(places) == len({r["month_id"] for r in places}) == 4
