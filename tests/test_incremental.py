"""Marts kept up to date by period equal the marts built from all rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellmart.plans import incremental, ledger, loads, network, usage
from cellmart.sinks.snapshots import Snapshots
from tests.test_ledger import TS, land
from tests.test_marts import AS_OF, MEASURE_COLS, base_row, fixtures

CELLS = "cell_data_id long, technology string, cell string, global_cell_id string, site_id string"


def content(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def full(spark, table, cells):
    return network.site_usage(ledger.read_loaded(spark, table), cells)


def test_a_late_file_derives_its_period_again_and_no_other(spark, tmp_path, monkeypatch):
    cells = spark.createDataFrame([(1, "4G", "c", "g", "s1"), (2, "3G UMTS", "c", "g", "s2")], CELLS)
    landing, table = str(tmp_path / "in"), str(tmp_path / "t")
    tables, mart = Snapshots(spark, str(tmp_path / "marts")), network.site_mart(cells)
    land(spark, landing + "/a", [(20010601, "x", 1), (20010601, "x", 2), (20010702, "y", 5), (20010703, None, None)])
    loads.load_daily(spark, landing, table, TS)
    assert mart.refresh(tables, table) == [dt.date(2001, 6, 1), dt.date(2001, 7, 1)]
    assert content(mart.read(tables)) == content(full(spark, table, cells))
    assert mart.refresh(tables, table) == []

    land(spark, landing + "/b", [(20010702, "y", 7), (20010705, "z", 1)])
    loads.load_daily(spark, landing, table, TS)
    before = tables.state()[1]
    # a refresh that breaks while the mart is written leaves sums and mart as they were
    with monkeypatch.context() as m:
        m.setattr(incremental.IncrementalMart, "derive", property(lambda self: 1 / 0), raising=False)
        with pytest.raises(ZeroDivisionError):
            mart.refresh(tables, table)
    assert tables.state()[1] == before
    assert mart.refresh(tables, table) == [dt.date(2001, 7, 1)]
    after = tables.state()[1]
    for name in ("site_usage", "site_usage__sums"):
        changed = [p for p, place in after[name]["folders"].items() if before[name]["folders"].get(p) != place]
        assert changed == ["period=2001-07-01"]
    assert content(mart.read(tables)) == content(full(spark, table, cells))


def test_changed_cells_derive_the_mart_again_without_usage(spark, tmp_path):
    cells = spark.createDataFrame([], CELLS)
    landing, table = str(tmp_path / "in"), str(tmp_path / "t")
    tables = Snapshots(spark, str(tmp_path / "marts"))
    land(spark, landing + "/a", [(20010601, "x", 1), (20010702, "y", None)])
    loads.load_daily(spark, landing, table, TS)
    network.site_mart(cells).refresh(tables, table)
    moved = spark.createDataFrame([(None, "4G", "c", "g", "nowhere"), (3, "4G", "c", "g", "s3")], CELLS)
    mart = network.site_mart(moved)
    mart.derive_again(tables)
    assert content(mart.read(tables)) == content(full(spark, table, moved))


def test_rows_without_a_date_have_a_period_of_their_own(spark, tmp_path):
    table, tables = str(tmp_path / "t"), Snapshots(spark, str(tmp_path / "marts"))
    rows = spark.createDataFrame([(None, "x", 1), (dt.date(2001, 6, 1), "x", 2)], "day date, msisdn string, calls long")
    mart = incremental.IncrementalMart("calls", ["msisdn"], [F.sum("calls").alias("calls")], F.trunc("day", "MM"), lambda sums, _: sums)
    for k in (1, 2):
        ledger.publish(spark, rows, [{"path": f"f{k}", "length": k, "modified": TS}], table, TS, partition_by=["day"])
        assert None in mart.refresh(tables, table)
    assert sorted((r["msisdn"], r["calls"]) for r in mart.read(tables).collect()) == [("x", 2), ("x", 4)]


def published(tables, mart):
    return content(mart.read(tables))


def test_the_published_usage_mart_is_kept_up_to_date(spark, tmp_path):
    """Usage of July in two loads, the second with a counter that is NULL; then June's base, without usage, and a
    base of July that lost a number."""
    base, products, products2, use, cells = fixtures(spark)
    use = use.unionByName(use.filter("imsi = '234301'").withColumn("work_mo_count", F.lit(None).cast("long")))
    june = spark.createDataFrame([base_row("7704", "P1", dt.date(2021, 1, 1))], base.schema).withColumn("agg_mth", F.lit("202106"))
    table, tables = str(tmp_path / "t"), Snapshots(spark, str(tmp_path / "marts"))

    def load(k, rows):
        ledger.publish(spark, rows, [{"path": f"f{k}", "length": k, "modified": TS}], table, TS, partition_by=["month_date"],
                       columns=["month_id", "msisdn", "imei", "imsi", "first_cell_data_id", *MEASURE_COLS, "month_date"])

    def full(base):
        return content(usage.publish(usage.usage_mart(base, products, products2, use, cells, AS_OF)))

    mart = usage.published_mart(base.unionByName(june), products, products2, cells, AS_OF)
    late = F.col("imsi").isin("234302", "234301") & F.col("work_mo_count").isNull() | (F.col("imsi") == "0")
    load(1, use.filter(~late | F.col("imsi").isNull()))
    assert mart.refresh(tables, table) == [dt.date(2019, 7, 1), dt.date(2021, 7, 1)]
    load(2, use.filter(late))
    before = tables.state()[1]
    assert mart.refresh(tables, table) == [dt.date(2021, 7, 1)]
    after = tables.state()[1]
    assert before["usage_mart__sums"]["folders"]["period=2019-07-01"] == after["usage_mart__sums"]["folders"]["period=2019-07-01"]
    assert published(tables, mart) == full(base)
    mart.derive_again(tables, [dt.date(2021, 6, 1)])
    assert published(tables, mart) == full(base.unionByName(june))
    # a month of the base that comes again replaces what it gave before, also with nothing
    fewer = base.filter("subscriber_num <> '07701'")
    usage.published_mart(fewer, products, products2, cells, AS_OF).derive_again(tables, [dt.date(2021, 6, 1), dt.date(2021, 7, 1)])
    assert published(tables, mart) == full(fewer)
    assert list(tables.state()[1]["usage_mart"]["folders"]) == ["period=2021-07-01"]


def test_site_buckets_are_summed_after_the_shuffle(spark):
    cells = spark.createDataFrame([(1, "4G", "c", "g", "s1")], CELLS)
    sums = spark.range(4).selectExpr("date_add(DATE'2001-06-01', cast(id AS int)) AS period", *[f"id AS {c}" for c in (*network.SITE_KEYS, *network._PLAIN)])
    plan = network.site_mart(cells).derive(sums, [])._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("partial_sum" in line for line in plan)
    assert not any("Exchange" in line and "partial_sum" in below for line, below in zip(plan, plan[1:]))


def test_the_protocol_mart_shuffles_its_sums_once_after_the_joins(spark, tmp_path):
    """Nothing wider than the joined sums is shuffled, and each month has the rows of the full mart."""
    cells = spark.createDataFrame([(1, "4G", "c", "g", "s1", "50", "-1"), (2, "3G UMTS", "c", "g", "s2", "51", "-2")], CELLS + ", latitude string, longitude string")
    devices = spark.createDataFrame([("00000001", "4G", "Tablet", "m", "n", "Y")], "tac string, protocol string, device_type string, model string, marketing_name string, volte_flag string")
    subs = spark.createDataFrame([("x", 1, "s", "b"), ("x", 2, "s", "b")], "msisdn string, business_name long, segment string, brand string")
    counters = sorted({c for e in network._PLAIN.values() for c in e.split(" + ")})
    days = [dt.date(2001, 6, 1), dt.date(2001, 7, 1), None]
    rows = spark.range(60).select(F.element_at(F.array(*[F.lit(x).cast("date") for x in days]), (F.col("id") % 3 + 1).cast("int")).alias("month_date"),
                                  (F.col("id") % 4).alias("first_cell_data_id"), F.when(F.col("id") % 7 < 5, "x").alias("msisdn"),
                                  F.when(F.col("id") % 5 < 4, "000000010000001").alias("imei"), F.lit("i").alias("imsi"), (F.col("id") % 2).alias("exbr_account_num"),
                                  *[F.col("id").alias(c) for c in counters]).localCheckpoint()
    table, tables = str(tmp_path / "t"), Snapshots(spark, str(tmp_path / "marts"))
    mart = network.protocol_mart(cells, devices, subs)
    for k, part in enumerate((rows.filter("home_mo_count < 50"), rows.filter("home_mo_count >= 50"))):
        ledger.publish(spark, part, [{"path": f"f{k}", "length": k, "modified": TS}], table, TS, partition_by=["month_date"])
        assert len(mart.refresh(tables, table)) == 3
    assert content(mart.read(tables)) == content(network.protocol_site_usage(rows, cells, devices, subs))
    sums = rows.groupBy(*network.PROTOCOL_KEYS).agg(*network._plain_sums(network.TOTALS))
    plan = mart.derive(sums, days)._jdf.queryExecution().executedPlan().toString().splitlines()
    spread = [k for k, line in enumerate(plan) if "Aggregate" in line and "partial_sum(CASE" in line]
    assert spread and not any("Exchange" in line for line in plan[:spread[0]])
