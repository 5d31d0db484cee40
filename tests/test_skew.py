"""A key holding a third of all rows: results stay whole and AQE splits the hot partition."""

from pyspark.sql import functions as F

from cellmart.operators.joins import attribute_join
from cellmart.operators.rank import rank_first

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_cell_join_is_split_and_whole(spark):
    old = _with_conf(spark, SKEW_CONF)
    try:
        n = 30000
        # cell 0 carries a third of all usage rows
        usage = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1)
                                      .alias("cell_id"), F.col("id").alias("row_id"))
        cells = spark.range(0, 98).select(F.col("id").alias("cell_data_id"),
                                          (F.col("id") * 10).alias("tech"))
        j = attribute_join(usage, cells, [(F.col("cell_id"), F.col("cell_data_id"))], "left")
        assert j.count() == n
        out = j.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))
        assert {r.cell_id: r.n for r in out.collect()}[0] == n // 3
        j.collect()
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        _restore(spark, old)


def test_hot_key_rank_first_keeps_all_ties(spark):
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
                               .alias("k"), (F.col("id") % 5).alias("v"))
    top = rank_first(df, ["k"], [F.asc("v")])
    hot = top.filter(F.col("k") == "hot")
    # hot ids are multiples of 3; v = id % 5 == 0 for a fifth of them: every tie is kept
    assert hot.count() == len([i for i in range(0, n, 3) if i % 5 == 0])


def test_number_with_very_many_cards_goes_to_many_tasks(spark):
    """200,000 SIM identities of one number in one month: every identity has its row with the month's
    totals, and no task of the join holds more than a small part of them."""
    from cellmart.plans import roles, usage

    sf, n = "/root/testdata/sf0.001", 200_000
    real, base = roles.usage(spark, sf), roles.base(spark, sf)
    args = (roles.products(spark, sf), roles.products2(spark, sf))
    cells = roles.cells(spark, sf)
    seen = usage.usage_mart(base, *args, real, cells, roles.ORDERS_AS_OF).filter(F.col("MO_CALLS_4G") > 0).head()
    number, month = seen["MSISDN"][1:], seen["AGG_MTH"]
    one = real.filter((F.col("msisdn") == number) & (F.date_format("month_date", "yyyyMM") == month)).limit(1)
    many = one.withColumn("card", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn("imsi", F.concat(F.lit("card"), F.col("card"))).drop("card")
    hot = real.filter(F.col("msisdn") != number).unionByName(many)

    mart = usage.usage_mart(base, *args, hot, cells, roles.ORDERS_AS_OF).filter(
        (F.col("MSISDN") == "0" + number) & (F.col("AGG_MTH") == month))
    got = mart.groupBy("MO_CALLS_4G", "PRODUCT_CODE", "SUBSCRIBER_STATUS", "CONTRACT_START_DATE").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("IMSI").alias("cards")).collect()
    assert got and all(r["rows"] % n == 0 and r["cards"] == n for r in got)
    parts = usage.identity_list(many).groupBy(usage._identity_part().alias("part")).count().collect()
    assert len(parts) == usage.IDENTITY_PARTS and max(r["count"] for r in parts) < 2 * n / usage.IDENTITY_PARTS
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and "windowspecdefinition(t_msisdn" not in plan
