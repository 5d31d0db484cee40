"""A refresh of a stored mart works on what its loads name, and leaves no shuffle files on the disks."""

import time

import pytest
from pyspark.sql import functions as F

from cellmart import schemas
from cellmart.operators import joins
from cellmart.plans import catalog, incremental, ledger, loads, network, usage
from cellmart.sinks import writers
from cellmart.sinks.snapshots import Snapshots
from tests.test_incremental import CELLS, content, full
from tests.test_ledger import TS, land
from tests.test_marts import AS_OF, MEASURE_COLS, fixtures

FIRST = [(20010601, "x", 1), (20010601, "x", 2), (20010602, "y", 3), (20010702, "y", 5), (20010703, None, None), (20010703, None, 4)]
LATER = [[(20010601, "y", 7), (20010604, "z", 1)], [(20010605, None, 2), (20010703, None, 2)], [(20010602, "y", 1), (20010801, "x", 8)]]


def shuffle_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks) if f.getName().startswith("shuffle_")}


def site(spark, tmp_path):
    cells = spark.createDataFrame([(1, "4G", "c", "g", "s1"), (1, "3G", "c", "g", "s1"), (2, "3G UMTS", "c", "g", "s2")], CELLS)
    return cells, str(tmp_path / "in"), str(tmp_path / "t"), Snapshots(spark, str(tmp_path / "marts")), network.site_mart(cells)


@pytest.mark.parametrize("layers, subjects, rows", [(8, 1 << 18, 1 << 25), (2, 1, 1), (8, 0, 2)])
def test_layers_subjects_and_turns_give_the_full_mart(spark, tmp_path, monkeypatch, layers, subjects, rows):
    """Sums added as layers and merged, rows of the named subjects or of whole periods, all periods at once or in turns: after each load
    the mart is the full one."""
    cells, landing, table, tables, mart = site(spark, tmp_path)
    for name, value in (("LAYERS", layers), ("SUBJECTS", subjects), ("TURN_ROWS", rows)):
        monkeypatch.setattr(incremental, name, value)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    for k, days in enumerate((FIRST, *LATER)):
        land(spark, f"{landing}/{k}", days)
        loads.load_daily(spark, landing, table, TS)
        mart.refresh(tables, table)
        assert content(mart.read(tables)) == content(full(spark, table, cells))
    mart.derive_again(tables)
    assert content(mart.read(tables)) == content(full(spark, table, cells))
    assert spark.conf.get(key, None) == before
    held = [len(v) if isinstance(v, list) else 1 for v in tables.state()[1]["site_usage__sums"]["folders"].values()]
    assert max(held) == (4 if layers == 8 else 2)


def test_a_load_neither_rewrites_sums_nor_derives_other_subjects(spark, tmp_path, monkeypatch):
    cells, landing, table, tables, mart = site(spark, tmp_path)
    land(spark, landing + "/a", FIRST)
    loads.load_daily(spark, landing, table, TS)
    mart.refresh(tables, table)
    old = tables.state()[1]["site_usage__sums"]["folders"]
    derived = []
    spread = network._with_bounded_tech
    monkeypatch.setattr(network, "_with_bounded_tech", lambda sums, *a: derived.append(sums) or spread(sums, *a))
    land(spark, landing + "/b", LATER[1])
    loads.load_daily(spark, landing, table, TS)
    mart.refresh(tables, table)
    assert {r["msisdn"] for d in derived for r in d.collect()} == {None}
    new = tables.state()[1]["site_usage__sums"]["folders"]
    assert all(new[p][0] == old[p] and len(new[p]) == 2 for p in ("period=2001-06-01", "period=2001-07-01"))
    assert content(mart.read(tables)) == content(full(spark, table, cells))


def test_a_rewrite_leaves_no_shuffle_files(spark, tmp_path):
    cells, landing, table, tables, mart = site(spark, tmp_path)
    land(spark, landing, FIRST)
    loads.load_daily(spark, landing, table, TS)
    added = mart._summed(spark.read.parquet(table).withColumn("period", mart.period).select("period", *mart.keys, *mart.measures), mart.sums, [1, 2])
    before = shuffle_blocks(spark)
    tables.rewrite({"sums": (added, ["period"]), "again": (lambda written: written["sums"], ["period"])})
    for _ in range(50):
        left = shuffle_blocks(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left


def test_sums_of_layers_are_usage_rows_for_the_published_mart(spark, tmp_path):
    base, products, products2, use, cells = fixtures(spark)
    use = use.unionByName(use.filter("imsi = '234301'").withColumn("work_mo_count", F.lit(None).cast("long")))
    table, tables = str(tmp_path / "t"), Snapshots(spark, str(tmp_path / "marts"))
    mart = usage.published_mart(base, products, products2, cells, AS_OF)
    for k, rows in enumerate((use.filter("work_mo_count IS NOT NULL"), use.filter("work_mo_count IS NULL"), use.filter("imsi = '234302'"))):
        ledger.publish(spark, rows, [{"path": f"f{k}", "length": k, "modified": TS}], table, TS, partition_by=["month_date"],
                       columns=["month_id", "msisdn", "imei", "imsi", "first_cell_data_id", *MEASURE_COLS, "month_date"])
        mart.refresh(tables, table)
    folders = tables.state()[1]["usage_mart__sums"]["folders"]
    assert max(len(v) if isinstance(v, list) else 1 for v in folders.values()) == 3
    whole = use.unionByName(use.filter("imsi = '234302'"))
    assert content(mart.read(tables)) == content(usage.publish(usage.usage_mart(base, products, products2, whole, cells, AS_OF)))


def test_both_deliveries_are_written_by_one_pass(spark, tmp_path):
    """Each has the rows of a file written for it alone."""
    sf, columns, layout = "/root/testdata/sf0.001", catalog.STAGED_MONTHLY, schemas.MONTHLY_STAGING
    for k, (folder, rows) in enumerate(zip(catalog._send(spark, sf, columns, layout), catalog._deliveries(spark, sf, columns, layout))):
        writers.write_csv(rows, str(tmp_path / f"alone{k}"), columns, sep="|", compression="gzip")
        catalog._land(spark, folder, str(tmp_path / f"in{k}"))
        sent, alone = (loads.staged_monthly(spark, [f["path"] for f in ledger.landed_files(spark, str(tmp_path / f"{name}{k}"), "*.gz").collect()])
                       for name in ("in", "alone"))
        assert sent.count() > 0 and content(sent) == content(alone)


def test_only_a_measured_dimension_is_broadcast(spark, monkeypatch):
    dim = spark.range(10).selectExpr("id AS k", "cast(id AS string) AS v")
    hinted = lambda: "broadcast" in joins.bounded(dim)._jdf.queryExecution().toString().lower()
    assert hinted()
    monkeypatch.setattr(joins, "SENT_BYTES", 100)
    assert not hinted()


def test_a_load_derives_the_protocol_mart_of_its_numbers_alone(spark, tmp_path, monkeypatch):
    """Numbers with two attribute rows, none, and no number; the second load names one of them, in turns of a month."""
    cells = spark.createDataFrame([(1, "4G", "c", "g", "s1", "50", "-1"), (1, "3G", "c", "g", "s1", "50", "-1")], CELLS + ", latitude string, longitude string")
    devices = spark.createDataFrame([("00000001", "4G", "Tablet", "m", "n", "Y")], "tac string, protocol string, device_type string, model string, marketing_name string, volte_flag string")
    subs = spark.createDataFrame([("x", 1, "s", "b"), ("x", 2, "s", "b"), ("y", 1, "s", "b")], "msisdn string, business_name long, segment string, brand string")
    counters = sorted({c for e in network._PLAIN.values() for c in e.split(" + ")})
    rows = spark.range(40).selectExpr("CASE id % 3 WHEN 0 THEN DATE'2001-06-01' WHEN 1 THEN DATE'2001-07-01' END AS month_date", "id % 3 AS first_cell_data_id",
                                      "element_at(array('x', 'y', 'z', NULL), cast(id % 4 + 1 AS int)) AS msisdn", "'000000010000001' AS imei", "'i' AS imsi",
                                      "id % 2 AS exbr_account_num", *[f"CASE WHEN id % 5 < 4 THEN id END AS {c}" for c in counters]).localCheckpoint()
    table, tables, derived = str(tmp_path / "t"), Snapshots(spark, str(tmp_path / "marts")), []
    spread = network._with_bounded_tech
    monkeypatch.setattr(network, "_with_bounded_tech", lambda sums, *a: derived.append(sums) or spread(sums, *a))
    monkeypatch.setattr(incremental, "TURN_ROWS", 1)
    mart = network.protocol_mart(cells, devices, subs)
    later = F.coalesce(F.col("msisdn") == "x", F.lit(False)) & (F.col("home_mo_count") > 20)
    for k, part in enumerate((rows.filter(~F.coalesce(later, F.lit(False))), rows.filter(later))):
        derived.clear()
        ledger.publish(spark, part, [{"path": f"f{k}", "length": k, "modified": TS}], table, TS, partition_by=["month_date"])
        mart.refresh(tables, table)
        assert len(derived) > 1
    assert {r["msisdn"] for d in derived for r in d.collect()} == {"x"}
    assert content(mart.read(tables)) == content(network.protocol_site_usage(rows, cells, devices, subs))
