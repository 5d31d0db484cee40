"""Session settings: broadcast bounds and partition counts follow the data."""

import os

from cellmart import session


def test_keys_of_a_compressed_table_are_not_broadcast(spark, tmp_path):
    # About 8 MB of file; the hash table of these keys in the driver would take well over 100 MB.
    spark.range(2_000_000).selectExpr("id AS k", "id % 7 AS v").write.parquet(f"{tmp_path}/keys")
    spark.range(10_000).selectExpr("id * 3 AS f").write.parquet(f"{tmp_path}/facts")
    keys, facts = spark.read.parquet(f"{tmp_path}/keys").select("k"), spark.read.parquet(f"{tmp_path}/facts")
    joined = facts.join(keys, facts["f"] == keys["k"], "left")
    assert joined.count() == 10_000
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_bytes_of_the_input(spark, tmp_path):
    key, plain = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        for pieces in (0, 3, 40):
            folder = tmp_path / str(pieces) / "table.parquet"
            os.makedirs(folder)
            (folder / "part").write_bytes(bytes(pieces * session.INPUT_PER_PARTITION))
            assert session.size_initial_partitions(spark, str(folder.parent)) == max(plain, pieces)
            assert spark.conf.get(key) == str(max(plain, pieces))
    finally:
        spark.conf.unset(key)


def test_folders_of_days_are_listed_by_few_tasks(spark, tmp_path):
    spark.range(150).selectExpr("id AS v", "id AS day").repartition(1).write.partitionBy("day").parquet(f"{tmp_path}/days")
    paths = [f"{tmp_path}/days/day={i}" for i in range(150)]
    tracker, group = spark.sparkContext.statusTracker(), "list-days"
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = spark.read.schema("v long").parquet(*paths)
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        most = max((tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)), default=0)
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert most <= 64
    assert found.count() == 150
