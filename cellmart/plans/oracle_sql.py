"""DuckDB SQL oracles for the driver queries.

Each oracle is written from the reference's SQL (views, load and DML statements) as plain
ANSI SQL over the driver tables, with the role derivations of ``roles.py`` as CTEs. They
are an independent statement of the semantics, not generated from the Spark code.

Portability notes (Spark vs DuckDB): ``||`` propagates NULL (DuckDB ``concat`` skips NULL);
ASC NULL order is spelled out; integer sums are cast to BIGINT (DuckDB sums to HUGEINT);
divisions use DOUBLE literals; date +/- interval is cast back to DATE.
"""

from __future__ import annotations

# Fixed dates shared with roles.py.
ORDERS_AS_OF = "DATE '2001-08-15'"
EVENTS_AS_OF = "DATE '2024-02-10'"

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"


def trim_ws(x: str) -> str:
    return f"trim({x}, {WS})"


def months_back(n: int, as_of: str = ORDERS_AS_OF) -> str:
    return f"CAST({as_of} - INTERVAL {n} MONTH AS DATE)"


def month_key(d: str) -> str:
    return f"CAST(year({d}) * 100 + month({d}) AS BIGINT)"


ROLE_CTES = {
    "usage": """
usage AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS msisdn,
         CAST(date_trunc('month', CAST(l.l_shipdate AS DATE)) AS DATE) AS month_date,
         CAST(year(l.l_shipdate) * 100 + month(l.l_shipdate) AS BIGINT) AS month_id,
         CAST(l.l_shipdate AS DATE) AS call_date,
         CAST(year(l.l_shipdate) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) AS BIGINT) AS date_of_call,
         lpad(CAST(l.l_partkey AS VARCHAR), 8, '0') || lpad(CAST(l.l_suppkey AS VARCHAR), 7, '0') AS imei,
         '2343' || lpad(CAST(l.l_linenumber - 1 AS VARCHAR), 11, '0') AS imsi,
         o.o_custkey AS exbr_account_num,
         l.l_suppkey AS first_cell_data_id,
         l.l_suppkey AS last_cell_data_id,
         CAST(floor(l.l_quantity) AS BIGINT) AS home_mo_count,
         CAST(l.l_linenumber AS BIGINT) AS work_mo_count,
         CAST(floor(l.l_quantity / 2) AS BIGINT) AS home_mt_count,
         CAST(l.l_linenumber AS BIGINT) % 3 AS work_mt_count,
         CAST(floor(l.l_quantity / 3) AS BIGINT) AS home_mo_sms_count,
         CAST(l.l_linenumber AS BIGINT) % 2 AS work_mo_sms_count,
         CAST(floor(l.l_quantity / 5) AS BIGINT) AS home_mt_sms_count,
         CAST(1 AS BIGINT) AS work_mt_sms_count,
         CAST(floor(l.l_extendedprice / 10) AS BIGINT) AS home_mo_duration_secs,
         CAST(floor(l.l_quantity) AS BIGINT) * 7 AS work_mo_duration_secs,
         CAST(floor(l.l_extendedprice / 20) AS BIGINT) AS home_mt_duration_secs,
         CAST(floor(l.l_quantity) AS BIGINT) * 11 AS work_mt_duration_secs,
         CAST(floor(l.l_extendedprice) AS BIGINT) AS home_data_in_volume_kb,
         CAST(floor(o.o_totalprice / 100) AS BIGINT) AS work_data_in_volume_kb,
         CAST(floor(l.l_extendedprice / 4) AS BIGINT) AS home_data_out_volume_kb,
         CAST(floor(l.l_quantity) AS BIGINT) * 13 AS work_data_out_volume_kb,
         CAST(floor(l.l_extendedprice / 3) AS BIGINT) AS home_data_duration_secs,
         CAST(l.l_linenumber AS BIGINT) * 5 AS work_data_duration_secs
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)""",
    "devices": """
devices AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS tac,
         p_name AS marketing_name,
         p_brand AS manufacturer,
         p_brand || '-' || CAST(p_size AS VARCHAR) AS model,
         CASE p_type WHEN 'PROMO' THEN '5G' WHEN 'STANDARD' THEN '4G' WHEN 'LARGE' THEN '4G'
                     WHEN 'MEDIUM' THEN '3G' WHEN 'SMALL' THEN '3G' ELSE '2G' END AS protocol,
         CASE WHEN p_size < 10 THEN 'Dongle' WHEN p_size < 40 THEN 'Smartphone' ELSE 'Tablet' END AS device_type,
         CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS volte_flag,
         CASE WHEN p_retailprice >= 1500 THEN 'Y' ELSE 'N' END AS vowifi_flag
  FROM part
)""",
    "products": """
product_attrs AS (
  SELECT p_size,
         'X' || CAST(p_partkey AS VARCHAR) AS product_code,
         CASE WHEN p_type = 'PROMO' THEN '5G' WHEN p_type = 'ECONOMY' THEN '3G' ELSE '4G' END AS protocol,
         p_type || ' ' || p_brand AS product_rollup,
         CASE WHEN p_size >= 48 THEN 'MIFI' WHEN p_size >= 46 THEN NULL ELSE 'Handset' END AS base_type,
         CASE WHEN p_size < 20 THEN 'Handset' ELSE 'SIMO 30D' END AS product_group,
         CASE p_size % 7 WHEN 0 THEN 'EE 3G PLAN ' || p_name WHEN 1 THEN p_name || ' 5G'
              WHEN 2 THEN 'smart ' || p_name || ' sim' WHEN 3 THEN '1 EE HOME ' || p_name
              WHEN 4 THEN p_name || ' watch' WHEN 5 THEN p_name || ' wifi' ELSE p_name END AS product_description,
         CASE p_size % 11 WHEN 0 THEN 'PAYG SWITCH' WHEN 1 THEN 'EE 3G LEGACY' ELSE 'STANDARD' END AS base_type_level1,
         'Consumer' AS product_type,
         p_brand AS brand
  FROM part
),
products AS (
  SELECT product_code, protocol, product_rollup, base_type, product_group, product_description,
         base_type_level1, product_type, brand,
         DATE '1990-01-01' AS effective_date, make_date(1996 + p_size % 5, 12, 31) AS expiration_date
  FROM product_attrs
  UNION ALL
  SELECT product_code, protocol, product_rollup, base_type, product_group, product_description,
         base_type_level1, product_type, brand,
         make_date(1996 + p_size % 5, 7, 1) AS effective_date, DATE '2099-12-31' AS expiration_date
  FROM product_attrs
)""",
    "products2": """
products2 AS (
  SELECT 'X' || CAST(p_partkey AS VARCHAR) || ' ' AS curr_product_code,
         DATE '1995-01-01' AS start_date,
         make_date(2000 + p_size % 3, 6, 30) AS end_date,
         CASE WHEN p_size > 25 THEN '5G' ELSE '4G' END AS mobile_data_speed,
         'BT ' || p_type AS product_group,
         'BT ' || p_name AS product_name,
         CASE WHEN p_size < 25 THEN 'Voice' ELSE 'Data' END AS mobile_service_type,
         CASE WHEN p_size % 4 = 0 THEN 'BT Home' ELSE 'BT Mobile' END AS product_line
  FROM part
)""",
    "cells": """
cells AS (
  SELECT s.s_suppkey AS cell_data_id,
         CASE n.n_regionkey WHEN 0 THEN '2G GSM' WHEN 1 THEN '3G UMTS' WHEN 2 THEN '4G'
                            WHEN 3 THEN 'WIFI' ELSE '-1' END AS technology,
         CAST(s.s_suppkey % 100 AS VARCHAR) AS cell,
         '30' || CAST(n.n_nationkey % 6 AS VARCHAR) || lpad(CAST(s.s_suppkey AS VARCHAR), 6, '0') AS global_cell_id,
         'S' || CAST(s.s_nationkey AS VARCHAR) AS site_id,
         n.n_name AS site_name,
         CAST(50 + n.n_nationkey AS VARCHAR) AS latitude,
         CAST(-5 + n.n_regionkey AS VARCHAR) AS longitude
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
)""",
    "base": """
base AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS subscriber_num,
         'X' || CAST(l.l_partkey AS VARCHAR) AS price_plan,
         strftime(o.o_orderdate, '%Y%m') AS agg_mth,
         'CSM' AS stack,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'BT' WHEN 'BUILDING' THEN 'EE'
              WHEN 'FURNITURE' THEN 'T-Mobile' WHEN 'HOUSEHOLD' THEN 'EE' ELSE 'Orange' END AS current_brand,
         CASE WHEN c.c_nationkey < 20 THEN 'Consumer' ELSE 'Business' END AS business_type,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PAYG' ELSE 'PAYM' END AS billing_base,
         o.o_totalprice AS arpu,
         CASE o.o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'S' ELSE 'C' END AS subscriber_status,
         CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END AS BIGINT) AS active_30d_payg,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS active_90d_payg,
         o.o_custkey AS ee_lifetime_id,
         'A' || CAST(o.o_custkey AS VARCHAR) AS account_num,
         CAST(o.o_orderkey AS VARCHAR) AS sub_id,
         'Handset' AS base_type,
         CASE WHEN c.c_acctbal > 5000 THEN 'Premium' ELSE 'Standard' END AS account_type,
         CAST(l.l_shipdate AS DATE) AS contract_start_date,
         CAST(l.l_shipdate AS DATE) + 730 AS contract_end_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
)""",
    "daily_base": """
daily_base AS (
  SELECT 'A' || CAST(o.o_custkey AS VARCHAR) AS account_num,
         last_day(CAST(o.o_orderdate AS DATE)) AS snapshot_date,
         'CSM' AS csm_stack,
         'X' || CAST(o.o_custkey AS VARCHAR) AS service_product_code,
         CAST(o.o_orderkey AS VARCHAR) AS service_id,
         c.c_mktsegment AS service_product_type,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'BT' WHEN 'BUILDING' THEN 'EE'
              WHEN 'FURNITURE' THEN 'T-Mobile' WHEN 'HOUSEHOLD' THEN 'EE' ELSE 'Orange' END AS brand,
         CASE o.o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'S' ELSE 'C' END AS service_id_status,
         CAST(o.o_custkey AS VARCHAR) AS ctn,
         o.o_totalprice AS total_service_product_rev_pm,
         CAST(o.o_orderdate AS DATE) AS contract_start_date,
         CAST(o.o_orderdate AS DATE) + 365 AS contract_end_date,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN 'Broadband' ELSE 'Mobile' END AS service
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)""",
    "legacy_base": """
legacy_base AS (
  SELECT o.o_custkey AS account_num,
         CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS BIGINT) AS agg_mth,
         'LEGACY' AS stack,
         'X' || CAST(o.o_custkey AS VARCHAR) AS price_plan,
         o.o_orderkey AS sub_id,
         c.c_mktsegment AS base_type,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'BT' WHEN 'BUILDING' THEN 'EE'
              WHEN 'FURNITURE' THEN 'T-Mobile' WHEN 'HOUSEHOLD' THEN 'EE' ELSE 'Orange' END AS current_brand,
         CASE o.o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'S' ELSE 'C' END AS subscriber_status,
         o.o_custkey AS subscriber_num,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PAYG' ELSE 'PAYM' END AS billing_base,
         o.o_totalprice AS arpu,
         CASE WHEN c.c_acctbal > 5000 THEN 'Premium' ELSE 'Standard' END AS account_type,
         CASE WHEN c.c_nationkey < 20 THEN 'Consumer' ELSE 'Business' END AS business_type,
         CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END AS BIGINT) AS active_30d_payg,
         CAST(CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS BIGINT) AS active_90d_payg,
         CAST(o.o_orderdate AS DATE) AS contract_start_date,
         CAST(o.o_orderdate AS DATE) + 365 AS contract_end_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)""",
    "subscribers": """
subscribers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS msisdn,
         CAST(c_nationkey AS BIGINT) AS business_name,
         c_mktsegment AS segment,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'BT' WHEN 'BUILDING' THEN 'EE'
              WHEN 'FURNITURE' THEN 'T-Mobile' WHEN 'HOUSEHOLD' THEN 'EE' ELSE 'Orange' END AS brand
  FROM customer
)""",
}


def with_roles(roles: list[str], body: str) -> str:
    """Prefix a query with the role CTEs it reads (``body`` may continue the WITH list by
    starting with a comma, or be a plain SELECT)."""
    ctes = ",\n".join(ROLE_CTES[r].strip() for r in roles)
    body = body.strip()
    if body.startswith(","):
        return f"WITH {ctes}{body}"
    return f"WITH {ctes}\n{body}"
