"""The usage mart: each subscriber-month of the consumer base with its tariff protocol,
base type and usage pivoted by radio technology (the flagship), its published form, and the
rolling activity flag written back onto it.

Inputs (reference column names):
  base      subscriber base per month (``subscriber_num``, ``agg_mth`` YYYYMM string,
            ``price_plan``, brand / billing / status attributes, contract dates)
  products  first tariff catalogue, effective-dated (``product_code``, ``effective_date``,
            ``expiration_date``, ``protocol``, ``product_description``, ...)
  products2 second tariff catalogue, effective-dated (``curr_product_code``, ``start_date``,
            ``end_date``, ``mobile_data_speed``, ``mobile_service_type``, ...)
  usage     monthly usage fact (``msisdn``, ``month_id``, ``month_date``, ``imsi``,
            ``first_cell_data_id`` and home/work counters)
  cells     cell dimension (``cell_data_id``, ``technology``, ``cell``, ``global_cell_id``)

Plan, with the scale decisions:
1. ``contracts``: base scan with the 13-month / status / segment filter pushed down, two
   effective-dated left joins (key equality + range residual; the planner broadcasts a
   catalogue only under its size threshold), the rule columns, then RANK per
   (month, subscriber) with a partial WindowGroupLimit before the shuffle. A window count
   per (msisdn, month) gives k, the number of first-ranked contract rows; it leaves the
   contracts hash-partitioned on the key of the join below.
2. Usage is aggregated *before* any join with the contracts: one hash aggregate per (msisdn, month)
   computes the 40 technology buckets from raw integer sums (map-side partial aggregation, so a
   subscriber holding a third of the rows is combined before the shuffle) and says which of 64
   parts hold its SIM identities. The reference joins every usage row to every first-ranked contract
   row, which multiplies the sums by k; that factor is applied after the aggregate (k * sum is
   exact on integers).
3. Contracts left-join the totals (one row per key), are dealt out by part and left-join the
   identity list (distinct over four columns of usage) on (msisdn, month, part): no window holds the
   identities of a subscriber-month, and a number with very many of them goes to many
   tasks. The final 19-key aggregate then sees one row per contract row and identity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellmart.session import scratch_path
from cellmart.sinks import writers
from cellmart.functions import rules
from cellmart.functions.calendar import date_window, month_key, month_key_window, month_start, months_back
from cellmart.functions.text import safe_long, trim_ws, zero_prefix
from cellmart.operators.aggregates import sign_flag
from cellmart.operators.changes import update_from
from cellmart.operators.joins import effective_dated_join
from cellmart.operators.rank import rank_first
from cellmart.plans.incremental import IncrementalMart

HORIZON_MONTHS = 13
#: Parts over which the SIM identities of one subscriber-month are spread (bits of a long, at most 64).
IDENTITY_PARTS = 64

# Measures of the pivot: name -> (home column, work column, unit divisor or None)
MEASURES = {
    "MO_CALLS": ("home_mo_count", "work_mo_count", None),
    "MT_CALLS": ("home_mt_count", "work_mt_count", None),
    "MO_MINS": ("home_mo_duration_secs", "work_mo_duration_secs", 60.0),
    "MT_MINS": ("home_mt_duration_secs", "work_mt_duration_secs", 60.0),
    "MO_SMS": ("home_mo_sms_count", "work_mo_sms_count", None),
    "MT_SMS": ("home_mt_sms_count", "work_mt_sms_count", None),
    "DL_MB": ("home_data_in_volume_kb", "work_data_in_volume_kb", 1024.0),
    "UL_MB": ("home_data_out_volume_kb", "work_data_out_volume_kb", 1024.0),
}
MEASURE_BUCKETS = {name: (rules.DATA_BUCKETS if name in ("DL_MB", "UL_MB") else rules.VOICE_BUCKETS)
                   for name in MEASURES}
PIVOT_COLUMNS = [f"{m}_{suffix}" for m in MEASURES for _, suffix in MEASURE_BUCKETS[m]]

GROUP_KEYS = ["MSISDN", "IMSI", "AGG_MTH", "SUBSCRIBER_STATUS", "BRAND", "BILLING_BASE",
              "BUSINESS_TYPE", "TAR_PROTOCOL", "BASE_TYPE", "ACTIVE_30D_PAYG", "ACTIVE_90D_PAYG",
              "ACCOUNT_TYPE", "ACCOUNT_NUM", "PRODUCT_CODE", "PRODUCT_DESCRIPTION", "PRODUCT_GROUP",
              "ARPU", "CONTRACT_START_DATE", "CONTRACT_END_DATE"]

PUBLISHED_KEYS = ["MSISDN", "AGG_MTH", "IMSI", "SUBSCRIBER_STATUS", "BRAND", "BILLING_BASE",
                  "BUSINESS_TYPE", "TAR_PROTOCOL", "BASE_TYPE", "ACTIVE_30D_PAYG", "ACTIVE_90D_PAYG",
                  "ACCOUNT_TYPE", "ACCOUNT_NUM", "PRODUCT_CODE", "PRODUCT_DESCRIPTION", "PRODUCT_GROUP",
                  "ARPU", "CONTRACT_START_DATE", "CONTRACT_END_DATE"]

BASE_COLS = ["subscriber_num", "agg_mth", "subscriber_status", "current_brand", "business_type",
             "billing_base", "active_30d_payg", "active_90d_payg", "account_num", "account_type",
             "contract_start_date", "contract_end_date", "arpu", "price_plan"]
PRODUCT_COLS = ["product_code", "effective_date", "expiration_date", "protocol", "product_rollup",
                "base_type", "product_group", "product_description", "base_type_level1"]
PRODUCT2_COLS = ["curr_product_code", "start_date", "end_date", "mobile_data_speed", "product_group",
                 "product_name", "mobile_service_type"]


def tech_of_cell(cells_prefix: str = "") -> F.Column:
    p = cells_prefix
    return rules.radio_technology(technology=F.col(f"{p}technology"), cell=F.col(f"{p}cell"),
                                  global_cell_id=F.col(f"{p}global_cell_id"))


def contract_attributes(base: DataFrame, products: DataFrame, products2: DataFrame, as_of) -> DataFrame:
    """Consumer subscriber-months of the last 13 months joined to both tariff catalogues
    (effective-dated) with the brand switch, tariff protocol and base type rules applied."""
    b = base.select(*BASE_COLS).filter(
        month_key_window("agg_mth", as_of, HORIZON_MONTHS, 0)
        & F.col("subscriber_status").isin("A", "S")
        & (F.col("business_type") == "Consumer"))
    b = b.withColumn("__month", month_start("agg_mth"))
    dpr = products.select(*[F.col(c).alias(f"dpr_{c}") for c in PRODUCT_COLS])
    ov = products2.select(*[F.col(c).alias(f"ov_{c}") for c in PRODUCT2_COLS])
    j = effective_dated_join(b, dpr, fact_key=F.col("price_plan"), dim_key=F.col("dpr_product_code"),
                             fact_date=F.col("__month"), start=F.col("dpr_effective_date"),
                             end=F.col("dpr_expiration_date"))
    j = effective_dated_join(j, ov, fact_key=F.col("price_plan"), dim_key=F.col("ov_curr_product_code"),
                             fact_date=F.col("__month"), start=F.col("ov_start_date"),
                             end=F.col("ov_end_date"))
    brand = F.col("current_brand")
    c = j.select(
        trim_ws("subscriber_num").alias("msisdn"), "subscriber_num", "agg_mth", "__month", "price_plan",
        "subscriber_status", "current_brand", "business_type", "billing_base", "active_30d_payg",
        "active_90d_payg", "account_num", "account_type", "contract_start_date", "contract_end_date",
        "arpu",
        rules.brand_switch(brand, F.col("ov_curr_product_code"), F.col("dpr_product_code")).alias("product_code"),
        rules.brand_switch(brand, F.col("ov_product_name"), F.col("dpr_product_description")).alias("product_description"),
        rules.brand_switch(brand, F.col("ov_product_group"), F.col("dpr_product_group")).alias("product_group"),
        rules.tariff_protocol(
            protocol=F.col("dpr_protocol"), base_type_level1=F.col("dpr_base_type_level1"),
            product_code=F.col("dpr_product_code"), product_description=F.col("dpr_product_description"),
            product_rollup=F.col("dpr_product_rollup"), product_group=F.col("dpr_product_group"),
            brand=brand, billing_base=F.col("billing_base"),
            alt_data_speed=F.col("ov_mobile_data_speed")).alias("tar_p2"),
        rules.base_type(
            product_code=F.col("dpr_product_code"), product_description=F.col("dpr_product_description"),
            brand=brand, alt_service_type=F.col("ov_mobile_service_type"),
            catalogue_base_type=F.col("dpr_base_type")).alias("base_type"))
    return c


def contracts(base: DataFrame, products: DataFrame, products2: DataFrame, as_of) -> DataFrame:
    """``contract_attributes`` ranked by contract start within (month, subscriber); only the
    first-ranked rows are returned, ties kept (a NULL start date sorts first)."""
    c = contract_attributes(base, products, products2, as_of)
    return rank_first(c, ["agg_mth", "subscriber_num"], [F.asc_nulls_first("contract_start_date")])


def usage_by_tech_raw(usage: DataFrame, cells: DataFrame, as_of) -> DataFrame:
    """Usage rows of the 13-month window with the radio technology of their first cell."""
    cols = sorted({c for home, work, _ in MEASURES.values() for c in (home, work)})
    u = usage.select("msisdn", "month_id", "month_date", "first_cell_data_id", *cols) \
             .filter(date_window("month_date", as_of, HORIZON_MONTHS))
    cd = cells.select(F.col("cell_data_id").alias("__cell_id"), "technology", "cell", "global_cell_id")
    j = u.join(cd, u["first_cell_data_id"] == cd["__cell_id"], "left")
    return j.withColumn("interp_tech", tech_of_cell()).withColumn("msisdn", trim_ws("msisdn"))


def usage_by_tech(usage: DataFrame, cells: DataFrame, as_of) -> DataFrame:
    """Per (msisdn, month, technology): calls, minutes, SMS, MB down / up (one row per
    technology actually used). Minutes are seconds / 60, MB are kB / 1024; a NULL home or
    work counter makes its row count as NULL (not coalesced)."""
    j = usage_by_tech_raw(usage, cells, as_of)
    aggs = []
    for name, (home, work, div) in MEASURES.items():
        s = F.sum(F.col(home) + F.col(work))
        aggs.append((s / F.lit(div) if div else s).alias(name.lower()))
    return j.groupBy("msisdn", "month_id", "month_date", "interp_tech").agg(*aggs)


def _subscriber_month_totals(usage: DataFrame, cells: DataFrame, as_of) -> DataFrame:
    """Per (trimmed msisdn, month): integer bucket sums of the usage rows and a bitmap of the parts in which
    the subscriber-month has valid SIM identities (0: none). All buffers have a fixed width, so rows of
    one number are combined in their tasks before the shuffle. The generated aggregates are SQL
    expression strings (one JVM parse per column)."""
    cols = sorted({c for home, work, _ in MEASURES.values() for c in (home, work)})
    u = usage.select("msisdn", "month_date", "imsi", "first_cell_data_id", *cols) \
             .filter(date_window("month_date", as_of, HORIZON_MONTHS))
    cd = cells.select(F.col("cell_data_id").alias("__cell_id"), "technology", "cell", "global_cell_id")
    j = u.join(cd, u["first_cell_data_id"] == cd["__cell_id"], "left") \
         .withColumn("interp_tech", tech_of_cell()).withColumn("__part", _identity_part())
    aggs = [F.expr(f"sum(CASE WHEN interp_tech = '{value}' THEN {home} + {work} ELSE 0 END)")
            .alias(f"t_{name}_{suffix}")
            for name, (home, work, _) in MEASURES.items() for value, suffix in MEASURE_BUCKETS[name]]
    parts = F.expr("coalesce(bit_or(shiftleft(1L, __part)), 0L)").alias("t_parts")
    return j.groupBy(trim_ws("msisdn").alias("t_msisdn"), F.col("month_date").alias("t_month")).agg(*aggs, parts)


def _identity_part() -> Column:
    """Part (0 to IDENTITY_PARTS - 1) of a valid SIM identity, NULL for the others."""
    valid = ~trim_ws("imsi").isin(*rules.INVALID_IMSI)
    return F.when(valid, F.pmod(F.xxhash64("imsi"), F.lit(IDENTITY_PARTS)).cast("int"))


def identity_list(usage: DataFrame) -> DataFrame:
    """Distinct (month, msisdn, imsi) of usage with the invalid SIM identities dropped
    (a NULL imsi is dropped too: NOT IN is unknown for NULL)."""
    return (usage.select("month_id", "month_date", "msisdn", "imsi")
            .filter(~trim_ws("imsi").isin(*rules.INVALID_IMSI))
            .distinct())


def usage_mart(base: DataFrame, products: DataFrame, products2: DataFrame, usage: DataFrame,
               cells: DataFrame, as_of) -> DataFrame:
    """Usage by subscriber x month x technology, 19 attributes + 40 measures."""
    cdm = contracts(base, products, products2, as_of)
    # k: first-ranked contract rows per subscriber-month (all base types) = the reference's
    # join multiplicity of the usage sums. As a window count it reuses the contract rows
    # (no second pass over the base) and leaves them hash-partitioned on (msisdn, month),
    # the key of both joins below, so neither join reshuffles the contract side.
    k = F.count(F.lit(1)).over(Window.partitionBy("msisdn", "__month"))
    c = cdm.withColumn("k", k).filter(F.col("base_type") != "MIFI")

    # The totals of a subscriber-month are one row, so this join multiplies nothing and the contracts
    # keep their partitioning. A subscriber-month is then dealt out by the parts that hold its
    # identities and joined to the identity list by part: a placeholder number with very many SIM
    # identities goes to many tasks. One without a valid identity keeps a single row with a NULL
    # identity, as the reference's left join does.
    totals = _subscriber_month_totals(usage, cells, as_of).withColumn("t_hit", F.lit(True))
    t = c.join(totals, (c["msisdn"] == totals["t_msisdn"]) & (c["__month"] == totals["t_month"]), "left")
    parts = F.filter(F.sequence(F.lit(0), F.lit(IDENTITY_PARTS - 1)), lambda p: F.getbit("t_parts", p) == 1)
    t = t.withColumn("__part", F.explode_outer(F.when(F.col("t_parts") != 0, parts)))
    ids = (identity_list(usage.filter(date_window("month_date", as_of, HORIZON_MONTHS)))
           .select(trim_ws("msisdn").alias("i_msisdn"), F.col("month_date").alias("i_month"), F.col("imsi").alias("IMSI"),
                   _identity_part().alias("i_part")))
    f = t.join(ids, (t["msisdn"] == ids["i_msisdn"]) & (t["__month"] == ids["i_month"]) & (t["__part"] == ids["i_part"]), "left")

    keyed = f.select(
        zero_prefix("msisdn").alias("MSISDN"), "IMSI", F.col("agg_mth").alias("AGG_MTH"),
        F.col("subscriber_status").alias("SUBSCRIBER_STATUS"),
        rules.brand_relabel(F.col("current_brand"), F.col("tar_p2")).alias("BRAND"),
        F.col("billing_base").alias("BILLING_BASE"), F.col("business_type").alias("BUSINESS_TYPE"),
        F.col("tar_p2").alias("TAR_PROTOCOL"), F.col("base_type").alias("BASE_TYPE"),
        F.col("active_30d_payg").alias("ACTIVE_30D_PAYG"), F.col("active_90d_payg").alias("ACTIVE_90D_PAYG"),
        F.col("account_type").alias("ACCOUNT_TYPE"), F.col("account_num").alias("ACCOUNT_NUM"),
        F.col("product_code").alias("PRODUCT_CODE"), F.col("product_description").alias("PRODUCT_DESCRIPTION"),
        F.col("product_group").alias("PRODUCT_GROUP"), F.col("arpu").alias("ARPU"),
        F.col("contract_start_date").alias("CONTRACT_START_DATE"),
        F.col("contract_end_date").alias("CONTRACT_END_DATE"), "k", "t_hit",
        *[f"t_{p}" for p in PIVOT_COLUMNS])

    def scaled(name, suffix, div):
        v = f"k * t_{name}_{suffix}" + (f" / {div}D" if div else "")
        return f"CASE WHEN t_hit THEN {v} ELSE 0 END AS {name}_{suffix}"

    # The 40 generated measure columns go to the JVM as one list of SQL expressions.
    keyed = keyed.selectExpr(*GROUP_KEYS, *[scaled(name, suffix, div) for name, (_, _, div) in MEASURES.items()
                                            for _, suffix in MEASURE_BUCKETS[name]])
    return keyed.groupBy(*GROUP_KEYS).agg(*[F.sum(p).alias(p) for p in PIVOT_COLUMNS])


def publish(mart: DataFrame) -> DataFrame:
    """Published form: month key as a number (NULL when not numeric), protocol collapsed to
    4G / 5G when the text contains it, columns in the published order."""
    return mart.select(
        "MSISDN", safe_long("AGG_MTH").alias("AGG_MTH"),
        *[rules.protocol_collapse(F.col(k)).alias(k) if k == "TAR_PROTOCOL" else F.col(k)
          for k in PUBLISHED_KEYS[2:]],
        *PIVOT_COLUMNS)


def published_mart(base: DataFrame, products: DataFrame, products2: DataFrame, cells: DataFrame, as_of) -> IncrementalMart:
    """The published mart kept up to date by month from the monthly usage table. A row counts by home + work, which
    is NULL when one of them is, so the sums are of that: a summed row stands for its usage rows. Ranks,
    ties and identities lie within a month, so a month is derived from its own base and sums. A month of the
    base that has no usage, or was loaded again, is derived by name; so are months that enter the window of 13
    when ``as_of`` moves on (those that leave it expire)."""
    names = [(home, work) for home, work, _ in MEASURES.values()]
    keys = ["month_id", "msisdn", "imsi", "first_cell_data_id"]

    def derive(sums, periods):
        rows = sums.withColumns({"month_date": F.col("period"), **{work: F.lit(0).cast("long") for _, work in names}})
        own = base.filter(month_start("agg_mth").isin([p for p in periods if p is not None]))
        return publish(usage_mart(own, products, products2, rows, cells, as_of)).withColumn("period", month_start("AGG_MTH"))

    return IncrementalMart("usage_mart", keys, [F.sum(home).alias(home) for home, _ in names], F.col("month_date"), derive,
                           measures=[(F.col(home) + F.col(work)).alias(home) for home, work in names], adds=True)


def publish_and_flag(mart: DataFrame, path: str, as_of) -> DataFrame:
    """Write the published mart partitioned by month, then set last month's activity flag: the three
    months of the window and last month are read, and only last month's partition is replaced."""
    spark = mart.sparkSession
    published = publish(mart).withColumn("NEW_ACTIVE90D_PAYG", F.lit(None).cast("int"))
    writers.refresh(published, path, partition_by=["AGG_MTH"])
    stored = spark.read.schema(published.schema).parquet(path)
    first, last = month_key(months_back(as_of, 4)), month_key(months_back(as_of, 1))
    window = stored.filter(F.col("AGG_MTH").between(first, last))
    flagged = active90d_update(window, as_of).filter(F.col("AGG_MTH") == last)
    staging = scratch_path(spark, "flagged")
    writers.refresh(flagged, staging)
    writers.replace_partitions(spark.read.schema(published.schema).parquet(staging), path, ["AGG_MTH"])
    return spark.read.schema(published.schema).parquet(path)


def active90d_update(published: DataFrame, as_of) -> DataFrame:
    """Sign of the 30-day activity flag summed over months -4..-2 written as
    ``NEW_ACTIVE90D_PAYG`` onto last month's rows of the same subscriber; other rows keep
    their value (NULL when the column is new)."""
    window = F.col("AGG_MTH").between(month_key(months_back(as_of, 4)), month_key(months_back(as_of, 2)))
    flags = sign_flag(published.filter(window), ["MSISDN"], "ACTIVE_30D_PAYG", "NEW_ACTIVE90D_FLAG")
    target = published
    if "NEW_ACTIVE90D_PAYG" not in target.columns:
        target = target.withColumn("NEW_ACTIVE90D_PAYG", F.lit(None).cast("int"))
    last_month = F.col("AGG_MTH") == month_key(months_back(as_of, 1))
    return update_from(target, flags, ["MSISDN"], last_month, {"NEW_ACTIVE90D_PAYG": "NEW_ACTIVE90D_FLAG"})
