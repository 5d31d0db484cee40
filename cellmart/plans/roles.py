"""Role adapter: the driver's star-schema tables seen as the telecom tables of the marts.

The marts are written against the reference data model (usage fact, device / tariff
catalogues, cell dimension, subscriber base). The driver ships TPC-H-like tables instead, so
each telecom table is *derived* here, lazily, from those tables; its size grows with theirs.

    subscriber          = customer (o_custkey)
    usage row           = lineitem x orders (month / day from l_shipdate)
    handset (imei)      = part key (first 8 characters = device type code) + supplier key
    cell                = supplier x nation (technology from the region, site from the nation)
    tariff (price plan) = part, with two overlapping validity windows per code
    base row (contract) = lineitem x orders x customer (month from o_orderdate)

The same derivations are written as DuckDB SQL in ``oracle_sql.py``; both must change together.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.sources.tables import read_table

# Fixed dates of the driver data: orders span 1995-01..2001-08, events 2024-01.
ORDERS_AS_OF = dt.date(2001, 8, 15)
EVENTS_AS_OF = dt.date(2024, 2, 10)
LOAD_TS = dt.datetime(2001, 8, 15, 6, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a driver table."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case_sql(col: str, mapping: dict, default) -> str:
    lit = lambda v: repr(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {lit(default)} END"


# Fixed role mappings of the adapter (driver value -> telecom value).
SEGMENT_BRAND = {"AUTOMOBILE": "BT", "BUILDING": "EE", "FURNITURE": "T-Mobile", "HOUSEHOLD": "EE"}
SEGMENT_BRAND_DEFAULT = "Orange"
ORDER_STATUS = {"F": "A", "O": "S"}
ORDER_STATUS_DEFAULT = "C"
REGION_TECHNOLOGY = {0: "2G GSM", 1: "3G UMTS", 2: "4G", 3: "WIFI"}
REGION_TECHNOLOGY_DEFAULT = "-1"
PART_TYPE_PROTOCOL = {"PROMO": "5G", "STANDARD": "4G", "LARGE": "4G", "MEDIUM": "3G", "SMALL": "3G"}
PART_TYPE_PROTOCOL_DEFAULT = "2G"
EVENT_TECHNOLOGY = {"view": "2G", "click": "3G", "signup": "4G", "error": "WIFI", "purchase": "5G"}


def usage(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """Usage fact with both the monthly (month_id, month_date) and daily (date_of_call,
    call_date) keys. Counters are integer functions of the line so that sums are exact. ``by_month`` deals
    the rows out by month, one task a month, before the columns are derived."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    if by_month:
        j = j.select("o_custkey", "o_totalprice", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
        j = j.repartition(F.expr("year(l_shipdate) * 100 + month(l_shipdate)"))
    return j.selectExpr(
        "cast(o_custkey as string) AS msisdn",
        "trunc(to_date(l_shipdate), 'MM') AS month_date",
        "cast(year(l_shipdate) * 100 + month(l_shipdate) AS bigint) AS month_id",
        "to_date(l_shipdate) AS call_date",
        "cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS bigint) AS date_of_call",
        "lpad(cast(l_partkey as string), 8, '0') || lpad(cast(l_suppkey as string), 7, '0') AS imei",
        "'2343' || lpad(cast(l_linenumber - 1 as string), 11, '0') AS imsi",
        "o_custkey AS exbr_account_num",
        "l_suppkey AS first_cell_data_id",
        "l_suppkey AS last_cell_data_id",
        "floor(l_quantity) AS home_mo_count",
        "cast(l_linenumber AS bigint) AS work_mo_count",
        "floor(l_quantity / 2) AS home_mt_count",
        "cast(l_linenumber AS bigint) % 3 AS work_mt_count",
        "floor(l_quantity / 3) AS home_mo_sms_count",
        "cast(l_linenumber AS bigint) % 2 AS work_mo_sms_count",
        "floor(l_quantity / 5) AS home_mt_sms_count",
        "cast(1 AS bigint) AS work_mt_sms_count",
        "floor(l_extendedprice / 10) AS home_mo_duration_secs",
        "floor(l_quantity) * 7 AS work_mo_duration_secs",
        "floor(l_extendedprice / 20) AS home_mt_duration_secs",
        "floor(l_quantity) * 11 AS work_mt_duration_secs",
        "floor(l_extendedprice) AS home_data_in_volume_kb",
        "floor(o_totalprice / 100) AS work_data_in_volume_kb",
        "floor(l_extendedprice / 4) AS home_data_out_volume_kb",
        "floor(l_quantity) * 13 AS work_data_out_volume_kb",
        "floor(l_extendedprice / 3) AS home_data_duration_secs",
        "cast(l_linenumber AS bigint) * 5 AS work_data_duration_secs",
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device catalogue keyed on the 8-character type code."""
    return table(spark, sf_dir, "part").selectExpr(
        "lpad(cast(p_partkey as string), 8, '0') AS tac",
        "p_name AS marketing_name",
        "p_brand AS manufacturer",
        "p_brand || '-' || cast(p_size as string) AS model",
        f"{_case_sql('p_type', PART_TYPE_PROTOCOL, PART_TYPE_PROTOCOL_DEFAULT)} AS protocol",
        "CASE WHEN p_size < 10 THEN 'Dongle' WHEN p_size < 40 THEN 'Smartphone' ELSE 'Tablet' END AS device_type",
        "CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS volte_flag",
        "CASE WHEN p_retailprice >= 1500 THEN 'Y' ELSE 'N' END AS vowifi_flag",
    )


# Product attributes of the first catalogue (SQL expressions over the part table).
_PRODUCT_ATTRS = [
    "'X' || cast(p_partkey as string) AS product_code",
    "CASE WHEN p_type = 'PROMO' THEN '5G' WHEN p_type = 'ECONOMY' THEN '3G' ELSE '4G' END AS protocol",
    "p_type || ' ' || p_brand AS product_rollup",
    "CASE WHEN p_size >= 48 THEN 'MIFI' WHEN p_size >= 46 THEN CAST(NULL AS string) ELSE 'Handset' END AS base_type",
    "CASE WHEN p_size < 20 THEN 'Handset' ELSE 'SIMO 30D' END AS product_group",
    "CASE p_size % 7 WHEN 0 THEN 'EE 3G PLAN ' || p_name WHEN 1 THEN p_name || ' 5G' "
    "WHEN 2 THEN 'smart ' || p_name || ' sim' WHEN 3 THEN '1 EE HOME ' || p_name "
    "WHEN 4 THEN p_name || ' watch' WHEN 5 THEN p_name || ' wifi' ELSE p_name END AS product_description",
    "CASE p_size % 11 WHEN 0 THEN 'PAYG SWITCH' WHEN 1 THEN 'EE 3G LEGACY' ELSE 'STANDARD' END AS base_type_level1",
    "'Consumer' AS product_type",
    "p_brand AS brand",
]


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First tariff catalogue: two validity windows per code that overlap for half a year."""
    p = table(spark, sf_dir, "part")
    early = p.selectExpr(*_PRODUCT_ATTRS, "DATE'1990-01-01' AS effective_date",
                         "make_date(1996 + p_size % 5, 12, 31) AS expiration_date")
    late = p.selectExpr(*_PRODUCT_ATTRS, "make_date(1996 + p_size % 5, 7, 1) AS effective_date",
                        "DATE'2099-12-31' AS expiration_date")
    return early.unionByName(late)


def products2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second tariff catalogue (codes padded with a trailing blank, one window per code)."""
    return table(spark, sf_dir, "part").selectExpr(
        "'X' || cast(p_partkey as string) || ' ' AS curr_product_code",
        "DATE'1995-01-01' AS start_date",
        "make_date(2000 + p_size % 3, 6, 30) AS end_date",
        "CASE WHEN p_size > 25 THEN '5G' ELSE '4G' END AS mobile_data_speed",
        "'BT ' || p_type AS product_group",
        "'BT ' || p_name AS product_name",
        "CASE WHEN p_size < 25 THEN 'Voice' ELSE 'Data' END AS mobile_service_type",
        "CASE WHEN p_size % 4 = 0 THEN 'BT Home' ELSE 'BT Mobile' END AS product_line",
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"], "inner").selectExpr(
        "s_suppkey AS cell_data_id",
        f"{_case_sql('n_regionkey', REGION_TECHNOLOGY, REGION_TECHNOLOGY_DEFAULT)} AS technology",
        "cast(s_suppkey % 100 as string) AS cell",
        "'30' || cast(n_nationkey % 6 as string) || lpad(cast(s_suppkey as string), 6, '0') AS global_cell_id",
        "'S' || cast(s_nationkey as string) AS site_id",
        "n_name AS site_name",
        "cast(50 + n_nationkey as string) AS latitude",
        "cast(-5 + n_regionkey as string) AS longitude",
    )


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber base per month: one row per contract line (order line) of a customer."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_returnflag")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner") \
          .join(c, F.col("o_custkey") == c["c_custkey"], "inner")
    return j.selectExpr(
        "cast(o_custkey as string) AS subscriber_num",
        "'X' || cast(l_partkey as string) AS price_plan",
        "date_format(o_orderdate, 'yyyyMM') AS agg_mth",
        "'CSM' AS stack",
        f"{_case_sql('c_mktsegment', SEGMENT_BRAND, SEGMENT_BRAND_DEFAULT)} AS current_brand",
        "CASE WHEN c_nationkey < 20 THEN 'Consumer' ELSE 'Business' END AS business_type",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PAYG' ELSE 'PAYM' END AS billing_base",
        "o_totalprice AS arpu",
        f"{_case_sql('o_orderstatus', ORDER_STATUS, ORDER_STATUS_DEFAULT)} AS subscriber_status",
        "cast(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END AS bigint) AS active_30d_payg",
        "cast(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS bigint) AS active_90d_payg",
        "o_custkey AS ee_lifetime_id",
        "'A' || cast(o_custkey as string) AS account_num",
        "cast(o_orderkey as string) AS sub_id",
        "'Handset' AS base_type",
        "CASE WHEN c_acctbal > 5000 THEN 'Premium' ELSE 'Standard' END AS account_type",
        "to_date(l_shipdate) AS contract_start_date",
        "date_add(to_date(l_shipdate), 730) AS contract_end_date",
    )


def daily_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily billing base snapshot (one row per order, snapshot = last day of the order month)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "inner").selectExpr(
        "'A' || cast(o_custkey as string) AS account_num",
        "last_day(to_date(o_orderdate)) AS snapshot_date",
        "'CSM' AS csm_stack",
        "'X' || cast(o_custkey as string) AS service_product_code",
        "cast(o_orderkey as string) AS service_id",
        "c_mktsegment AS service_product_type",
        f"{_case_sql('c_mktsegment', SEGMENT_BRAND, SEGMENT_BRAND_DEFAULT)} AS brand",
        f"{_case_sql('o_orderstatus', ORDER_STATUS, ORDER_STATUS_DEFAULT)} AS service_id_status",
        "cast(o_custkey as string) AS ctn",
        "o_totalprice AS total_service_product_rev_pm",
        "to_date(o_orderdate) AS contract_start_date",
        "date_add(to_date(o_orderdate), 365) AS contract_end_date",
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'Broadband' ELSE 'Mobile' END AS service",
    )


def legacy_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly legacy base with numeric subscriber numbers (one row per order)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "inner").selectExpr(
        "o_custkey AS account_num",
        "cast(year(o_orderdate) * 100 + month(o_orderdate) AS bigint) AS agg_mth",
        "'LEGACY' AS stack",
        "'X' || cast(o_custkey as string) AS price_plan",
        "o_orderkey AS sub_id",
        "c_mktsegment AS base_type",
        f"{_case_sql('c_mktsegment', SEGMENT_BRAND, SEGMENT_BRAND_DEFAULT)} AS current_brand",
        f"{_case_sql('o_orderstatus', ORDER_STATUS, ORDER_STATUS_DEFAULT)} AS subscriber_status",
        "o_custkey AS subscriber_num",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PAYG' ELSE 'PAYM' END AS billing_base",
        "o_totalprice AS arpu",
        "CASE WHEN c_acctbal > 5000 THEN 'Premium' ELSE 'Standard' END AS account_type",
        "CASE WHEN c_nationkey < 20 THEN 'Consumer' ELSE 'Business' END AS business_type",
        "cast(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END AS bigint) AS active_30d_payg",
        "cast(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS bigint) AS active_90d_payg",
        "to_date(o_orderdate) AS contract_start_date",
        "date_add(to_date(o_orderdate), 365) AS contract_end_date",
    )


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber attributes for the site mart (segment, brand, business name)."""
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) AS msisdn",
        "cast(c_nationkey as bigint) AS business_name",
        "c_mktsegment AS segment",
        f"{_case_sql('c_mktsegment', SEGMENT_BRAND, SEGMENT_BRAND_DEFAULT)} AS brand",
    )
