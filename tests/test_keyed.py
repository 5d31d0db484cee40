"""The dimension in key buckets: merges equal the plain upsert and leave other buckets alone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellmart import schemas
from cellmart.operators.changes import upsert
from cellmart.plans import ledger, loads
from cellmart.sinks import writers
from cellmart.sinks.keyed import KeyedTable
from cellmart.sinks.snapshots import Snapshots

TS = dt.datetime(2001, 8, 15, 6)
SCHEMA = "id long, name string, record_ts timestamp"


def made(spark, tmp_path, rows, buckets=16):
    dim = KeyedTable(Snapshots(spark, str(tmp_path / "dims")), "cells", ["id"])
    target = spark.createDataFrame(rows, SCHEMA)
    dim.create(target, buckets)
    return dim, target


def content(df):
    return sorted(map(repr, df.collect()))


def test_merge_equals_the_upsert_and_touches_the_feed_s_buckets_alone(spark, tmp_path):
    # A repeated key, a NULL key on both sides and a feed whose key is an int.
    dim, target = made(spark, tmp_path, [(i, f"n{i}", None) for i in range(400)] + [(7, "again", None), (None, "none", None)])
    before = dim.tables.state()[1]["cells"]["folders"]
    feed = spark.createDataFrame([(7, "new"), (1000, "more"), (None, "nobody")], "id int, name string")
    report = dim.merge(feed, stamp_col="record_ts", stamp=TS)
    assert (report.updated, report.inserted) == (2, 2) and report.buckets <= 3
    assert content(dim.read()) == content(upsert(target, feed, ["id"], stamp_col="record_ts", stamp=TS))
    after = dim.tables.state()[1]["cells"]["folders"]
    assert sum(after[part] != before.get(part) for part in after) == report.buckets
    # the same feed again changes nothing but its stamp
    assert (dim.merge(feed.filter("id IS NOT NULL"), stamp_col="record_ts", stamp=TS).inserted) == 0
    assert content(dim.read()) == content(upsert(target, feed, ["id"], stamp_col="record_ts", stamp=TS))


def test_several_feed_rows_for_one_stored_row_are_refused(spark, tmp_path):
    dim, target = made(spark, tmp_path, [(1, "a", None), (2, "b", None)], buckets=2)
    twice = spark.createDataFrame([(1, "x", None), (1, "y", None)], SCHEMA)
    with pytest.raises(Exception, match="several feed rows match"):
        dim.merge(twice)
    assert content(dim.read()) == content(target)
    # repeated rows without a stored match are inserted, as MERGE does
    assert dim.merge(twice.withColumn("id", F.lit(5))).inserted == 2
    assert dim.merge(twice.limit(0)).buckets == 0
    with pytest.raises(ValueError, match="lacks"):
        dim.merge(twice.drop("name"))


def test_a_feed_without_keys_is_spread_and_inserted(spark, tmp_path):
    dim, _ = made(spark, tmp_path, [(None, "kept", None)], buckets=4)
    feed = spark.range(500).select(F.lit(None).cast("long").alias("id"), F.col("id").cast("string").alias("name"), F.lit(None).cast("timestamp").alias("record_ts"))
    assert (dim.merge(feed).inserted, dim.read().count()) == (500, 501)


def test_cell_feed_is_merged_once_and_archived_after_the_commit(spark, tmp_path, monkeypatch):
    names = schemas.CELL_FEED.fieldNames()
    empty = spark.createDataFrame([], schemas.CELL_FEED).withColumn("record_ts", F.lit(None).cast("timestamp"))
    dim = KeyedTable(Snapshots(spark, str(tmp_path / "dims")), "cells", ["cell_data_id"])
    dim.create(empty.unionByName(spark.createDataFrame([(i, "old") for i in range(1, 6)], "cell_data_id long, cell string"), allowMissingColumns=True), 4)

    def land(folder, ids):
        rows = spark.createDataFrame([(i, "new") for i in ids], "cell_data_id long, cell string").coalesce(1)
        writers.write_csv(empty.unionByName(rows, allowMissingColumns=True).drop("record_ts").coalesce(1), folder, names, sep="|", compression="gzip")

    landing, archive = str(tmp_path / "in"), str(tmp_path / "archive")
    land(landing + "/a", [1, 9])
    # broken between merge and commit: the next run merges the same rows again
    with monkeypatch.context() as m:
        m.setattr(ledger, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("broken")))
        with pytest.raises(RuntimeError):
            loads.load_cells(spark, dim, landing, str(tmp_path / "s"), TS, archive=archive)
    assert loads.load_cells(spark, dim, landing, str(tmp_path / "s"), TS, archive=archive).updated == 2
    land(landing + "/b", [2])
    assert loads.load_cells(spark, dim, landing, str(tmp_path / "s"), TS, archive=archive).updated == 1
    assert loads.load_cells(spark, dim, landing, str(tmp_path / "s"), TS, archive=archive).buckets == 0
    assert sorted((r["cell_data_id"], r["cell"]) for r in dim.read().collect()) == [(1, "new"), (2, "new"), (3, "old"), (4, "old"), (5, "old"), (9, "new")]
    assert ledger.landed_files(spark, archive, "*.gz").count() == 2
    audit = ledger.loads_of(spark, dim.path).orderBy("load_number").select("rows_before", "rows_loaded").collect()
    assert [tuple(r) for r in audit] == [(0, 2), (2, 1)]
