"""Subscriber base of the month and the subscriber category projection.

The base of the previous month is the union (distinct) of two feeds:
  * the daily billing snapshot of the last day of the previous month (mobile services only),
    with brand and account type taken from the legacy base when the number, month and
    contract start match (a LEFT join against a DISTINCT projection of the legacy base);
  * the legacy monthly base of the previous month for non-consumers and consumer PAYG
    subscribers of every brand but one.

Plan: both feeds are filtered at the scan; the legacy projection is de-duplicated with a
partial aggregate before its shuffle; the union-distinct is one more hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellmart.functions.calendar import month_key_str, prev_month_end, prev_month_start
from cellmart.functions.text import safe_long, zero_prefix
from cellmart.operators.setops import union_distinct

BASE_COLUMNS = ["account_num", "agg_mth", "stack", "price_plan", "sub_id", "base_type", "current_brand",
                "subscriber_status", "subscriber_num", "billing_base", "arpu", "account_type",
                "business_type", "active_30d_payg", "active_90d_payg", "contract_start_date",
                "contract_end_date"]

OUTPUT_COLUMNS = ["subscriber_num", "price_plan", "agg_mth", "stack", "current_brand", "business_type",
                  "billing_base", "arpu", "subscriber_status", "active_30d_payg", "active_90d_payg",
                  "account_num", "sub_id", "base_type", "account_type", "contract_start_date",
                  "contract_end_date"]

# Fixed values of the segment predicate of the legacy feed.
EXCLUDED_PAYG_BRAND = "Orange"


def billing_feed(daily: DataFrame, legacy: DataFrame, as_of) -> DataFrame:
    d = daily.filter((F.col("service") == "Mobile") & (F.col("snapshot_date") == prev_month_end(as_of)))
    d = d.withColumn("__agg", F.concat(F.year("snapshot_date").cast("string"),
                                       F.lpad(F.month("snapshot_date").cast("string"), 2, "0")).cast("string")) \
         .withColumn("__ctn", safe_long("ctn"))
    bvp = (legacy.select("subscriber_num", "account_type", "agg_mth", "current_brand", "contract_start_date")
           .distinct()
           .select(*[F.col(c).alias(f"bvp_{c}") for c in
                     ("subscriber_num", "account_type", "agg_mth", "current_brand", "contract_start_date")]))
    j = d.join(bvp, (d["__ctn"] == bvp["bvp_subscriber_num"])
               & (d["__agg"] == bvp["bvp_agg_mth"].cast("string"))
               & (d["contract_start_date"] == bvp["bvp_contract_start_date"]), "left")
    matched = F.col("__ctn") == F.col("bvp_subscriber_num")
    return j.select(
        F.col("account_num"), F.col("__agg").alias("agg_mth"), F.col("csm_stack").alias("stack"),
        F.col("service_product_code").alias("price_plan"), F.col("service_id").alias("sub_id"),
        F.col("service_product_type").alias("base_type"),
        F.when(matched, F.col("bvp_current_brand")).otherwise(F.col("brand")).alias("current_brand"),
        F.col("service_id_status").alias("subscriber_status"), F.col("ctn").alias("subscriber_num"),
        F.lit("PAYM").alias("billing_base"), F.col("total_service_product_rev_pm").alias("arpu"),
        F.when(matched, F.col("bvp_account_type")).otherwise(F.lit("N/A")).alias("account_type"),
        F.lit("Consumer").alias("business_type"), F.lit(-1).cast("long").alias("active_30d_payg"),
        F.lit(-1).cast("long").alias("active_90d_payg"), "contract_start_date", "contract_end_date")


def legacy_feed(legacy: DataFrame, as_of) -> DataFrame:
    bt, bb, brand = F.col("business_type"), F.col("billing_base"), F.col("current_brand")
    segment = (bt != "Consumer") | ((bb == "PAYG") & (brand != EXCLUDED_PAYG_BRAND))
    l = legacy.filter((F.col("agg_mth").cast("string") == month_key_str(prev_month_start(as_of))) & segment)
    return l.select(
        F.col("account_num").cast("string").alias("account_num"),
        F.col("agg_mth").cast("string").alias("agg_mth"), "stack", "price_plan",
        F.col("sub_id").cast("string").alias("sub_id"), "base_type", "current_brand", "subscriber_status",
        zero_prefix(F.col("subscriber_num").cast("string")).alias("subscriber_num"), "billing_base",
        F.col("arpu").cast("decimal(38,9)").alias("arpu"), "account_type", "business_type",
        "active_30d_payg", "active_90d_payg", "contract_start_date", "contract_end_date")


def combined_feed(daily: DataFrame, legacy: DataFrame, as_of) -> DataFrame:
    """UNION DISTINCT of both feeds (17 columns)."""
    return union_distinct(billing_feed(daily, legacy, as_of), legacy_feed(legacy, as_of), BASE_COLUMNS)


def subscriber_base(daily: DataFrame, legacy: DataFrame, as_of) -> DataFrame:
    u = combined_feed(daily, legacy, as_of)
    return u.select(
        zero_prefix("subscriber_num").alias("subscriber_num"), "price_plan", "agg_mth", "stack",
        "current_brand", "business_type", "billing_base", "arpu", "subscriber_status", "active_30d_payg",
        "active_90d_payg", "account_num", "sub_id", "base_type", "account_type",
        F.col("contract_start_date").cast("date").alias("contract_start_date"),
        F.col("contract_end_date").cast("date").alias("contract_end_date"))


def subscriber_category(base: DataFrame) -> DataFrame:
    """Subscriber category by month: month date, number, brand, billing base, business type
    (a distinct projection of the monthly base; the source table declares only the schema)."""
    return base.select(F.to_date(F.col("agg_mth").cast("string"), "yyyyMM").alias("date_mth"),
                       F.col("subscriber_num").alias("msisdn"), F.col("current_brand").alias("Brand"),
                       "billing_base", "business_type").distinct()
