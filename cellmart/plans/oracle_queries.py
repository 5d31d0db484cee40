"""DuckDB oracle SQL per registered query (see ``oracle_sql.py`` for the role CTEs)."""

from __future__ import annotations

import itertools

from cellmart.schemas import CELL74
from cellmart.plans.oracle_sql import EVENTS_AS_OF, ORDERS_AS_OF, month_key, months_back, trim_ws, with_roles

AS_OF = ORDERS_AS_OF
PREV_MONTH = f"CAST(date_trunc('month', {AS_OF}) - INTERVAL 1 MONTH AS DATE)"

ORACLES: dict[str, str] = {}

# ---- device marts -------------------------------------------------------------------------

# Order of the candidates of a subscriber as one comparable row: the best device is the one whose
# row equals the subscriber's largest. An absent value is below every present one.
_DEVICE_ORDER = """row(coalesce(kind.protocol, ''), coalesce(seen.data_secs, -1), coalesce(seen.calls, -1),
           coalesce(seen.texts, -1), coalesce(kind.tac, ''))"""

_SEEN = """,
seen AS (
  SELECT {month} msisdn AS number, substr(imei, 1, 8) AS type_code, max(date_of_call) AS last_day,
         sum(home_data_duration_secs + work_data_duration_secs) AS data_secs,
         sum(home_mo_count + home_mt_count + work_mo_count + work_mt_count) AS calls,
         sum(home_mo_sms_count + home_mt_sms_count + work_mo_sms_count + work_mt_sms_count) AS texts
  FROM usage WHERE {period} GROUP BY ALL
)"""

_KIND = "kind.protocol, kind.device_type, kind.model, kind.manufacturer, kind.marketing_name, kind.volte_flag, kind.vowifi_flag"

# The catalogue as a set: copies of an entry make the sums of a subscriber's device larger.
_CATALOGUE = """,
catalogue AS (
  SELECT tac, protocol, device_type, model, manufacturer, marketing_name, volte_flag, vowifi_flag, count(*) AS copies
  FROM devices GROUP BY ALL
)"""


def _scored(period: str, month: str, first_key: str) -> str:
    scaled = _DEVICE_ORDER
    for name in ("data_secs", "calls", "texts"):
        scaled = scaled.replace(f"seen.{name}", f"seen.{name} * coalesce(kind.copies, 1)")
    key = scaled if not first_key else scaled.replace("row(", f"row({first_key}, ", 1)
    return _SEEN.format(period=period, month=month) + _CATALOGUE + f""",
scored AS (
  SELECT seen.*, kind.tac, {_KIND}, {key} AS standing
  FROM seen LEFT JOIN catalogue kind ON kind.tac = seen.type_code
),
leaders AS (SELECT number, max(standing) AS standing FROM scored GROUP BY number)"""


_BEST = _scored(f"month_date = {PREV_MONTH}", "month_id,", "")
_BEST_FROM = "FROM scored kind JOIN leaders USING (number, standing)"

ORACLES["best_device"] = with_roles(["usage", "devices"], _BEST + f"""
SELECT DISTINCT month_id, number AS msisdn, tac, {_KIND} {_BEST_FROM}""")

ORACLES["best_device_history"] = with_roles(["usage", "devices"], _BEST + f"""
SELECT DISTINCT month_id AS MONTH_ID, number AS MSISDN, tac AS TAC, protocol AS PROTOCOL,
       device_type AS DEVICE_TYPE, model AS MODEL, manufacturer AS MANUFACTURER,
       marketing_name AS MARKETING_NAME, volte_flag AS VOLTE_FLAG, vowifi_flag AS VOWIFI_FLAG,
       TIMESTAMP '2001-08-15 06:00:00' AS RECORD_TS
{_BEST_FROM}""")

ORACLES["recent_device"] = with_roles(["usage", "devices"], _scored(
    f"call_date >= {PREV_MONTH} AND call_date < CAST(date_trunc('month', {AS_OF}) AS DATE)", "", "coalesce(seen.last_day, -1)") + f"""
SELECT number AS msisdn, type_code AS tac, {_KIND}, last_day AS last_date {_BEST_FROM}""")

ORACLES["view_scan"] = f"""
SELECT device_type, count(*) AS subscribers, max(last_date) AS last_date
FROM ({ORACLES["recent_device"]}) GROUP BY device_type"""

# ---- contracts and rules ------------------------------------------------------------------

MONTH_OF_AGG = "CAST(strptime({a}, '%Y%m') AS DATE)"

# The classifications are tables of rules: a row fits a rule when all its patterns fit, and the
# fitting rule of the lowest number decides. Patterns and outcomes, in order.
TARIFF_FIELDS = ["protocol", "level", "code", "brand", "description", "caps", "rollup", "billing", "family"]
TARIFF_RULES = [
    ({"protocol": ["5G"]}, "5G"),
    ({"level": ["PAYG SWITCH", "EE 3G%"]}, "3G"),
    ({"code": ["X18PYG035", "X18PYG036"]}, "3G"),
    ({"brand": ["T-Mobile"]}, "3G"),
    ({"description": ["%5G", "%5G %", "%5GEE%"]}, "5G"),
    ({"rollup": ["%5G%"]}, "5G"),
    ({"code": ["X2%", "XB2%"], "billing": ["PAYM"], "family": ["Handset"]}, "5G"),
    ({"code": ["X2%", "XB2%"], "billing": ["PAYM"], "family": ["SIMO%"],
      "caps": ["SMART%SIM%", "5G SIM%", "FULL WORKS%", "%APPLE%"]}, "5G"),
    ({"caps": ["EE 3G PL%", "MBB 3G P%", "EE 3G MB%", "EE SPECIAL RATES (3G)", "EE STANDARD RATES (3G)"]}, "3G"),
    ({"brand": ["EE"]}, "4G"),
    ({"brand": ["BT"]}, "second catalogue"),
]
BASE_FIELDS = ["caps", "code_caps", "brand"]
BASE_RULES = [
    ({"caps": ["__EE HR%", "__EE HO%", "__EE RO%", "__ME BR%"]}, "FWA"),
    ({"caps": ["%WIFI%"]}, "Wifi"),
    ({"code_caps": ["%WEA%", "%WATCH%"]}, "Watch"),
    ({"caps": ["%WEA%", "%WATCH%"]}, "Watch"),
    ({"brand": ["BT"]}, "second catalogue"),
]
RADIO_FIELDS = ["technology", "cell", "global_id"]
RADIO_RULES = [
    ({"technology": ["2G%"]}, "2G"),
    ({"technology": ["3G%"]}, "3G"),
    ({"cell": ["_1", "_2"]}, "3G"),
    ({"technology": ["FEMTO"]}, "3G"),
    ({"technology": ["4G"]}, "4G"),
    ({"global_id": ["304%"]}, "4G"),
    ({"global_id": ["305%"]}, "5G"),
    ({"technology": ["WIFI"]}, "WIFI"),
    ({"technology": ["-1"], "global_id": ["300%", "301%", "330%"]}, "2G"),
    ({"technology": ["-1"], "global_id": ["302%"]}, "3G"),
]


def rule_table(name: str, fields: list[str], rules: list) -> str:
    """A CTE with a row for each combination of a rule's patterns; any text fits ``%``."""
    rows = []
    for number, (patterns, outcome) in enumerate(rules):
        for choice in itertools.product(*(patterns.get(f, ["%"]) for f in fields)):
            rows.append("(" + ", ".join([str(number), *(f"'{c}'" for c in choice), f"'{outcome}'"]) + ")")
    return f",\n{name}(number, {', '.join(fields)}, outcome) AS (VALUES {', '.join(rows)})"


def decided(table: str, values: dict[str, str]) -> str:
    """The outcome of the first fitting rule, NULL when none fits."""
    fits = " AND ".join(f"coalesce({value}, '') LIKE {table}.{field}" for field, value in values.items())
    return f"(SELECT arg_min({table}.outcome, {table}.number) FROM {table} WHERE {fits})"


_TARIFF = decided("tariff_rule", {
    "protocol": "main.protocol", "level": "main.base_type_level1", "code": "main.product_code", "brand": "held.current_brand",
    "description": "main.product_description", "caps": "upper(main.product_description)", "rollup": "main.product_rollup",
    "billing": "held.billing_base", "family": "main.product_group"})
_LINE = decided("base_rule", {
    "caps": "upper(main.product_description)", "code_caps": "upper(main.product_code)", "brand": "held.current_brand"})


def _of_second(field: str, other: str) -> str:
    """A BT contract is described by the second catalogue."""
    return f"if(coalesce(held.current_brand, '') = 'BT', second.{other}, main.{field})"


# Contracts of the window with both catalogues. ``first``: no contract of the subscriber-month
# starts earlier (an unknown start is the earliest).
_CDM = rule_table("tariff_rule", TARIFF_FIELDS, TARIFF_RULES) + rule_table("base_rule", BASE_FIELDS, BASE_RULES) + f""",
held AS (
  SELECT *, {trim_ws('price_plan')} AS plan, {MONTH_OF_AGG.format(a='agg_mth')} AS month,
         coalesce(contract_start_date, DATE '0001-01-01') AS begins
  FROM base
  WHERE business_type = 'Consumer' AND subscriber_status IN ('A', 'S')
    AND CAST(agg_mth AS BIGINT) >= {month_key(months_back(13))} AND CAST(agg_mth AS BIGINT) <= {month_key(AS_OF)}
),
contracts AS (
  SELECT held.*, {trim_ws('held.subscriber_num')} AS number,
         {_of_second('product_code', 'curr_product_code')} AS product_code,
         {_of_second('product_description', 'product_name')} AS product_description,
         {_of_second('product_group', 'product_group')} AS product_group,
         coalesce(nullif({_TARIFF}, 'second catalogue'),
                  CASE WHEN {_TARIFF} IS NULL THEN 'Other' ELSE second.mobile_data_speed END) AS tariff,
         coalesce(nullif({_LINE}, 'second catalogue'),
                  CASE WHEN {_LINE} IS NULL THEN main.base_type ELSE second.mobile_service_type END) AS line,
         NOT EXISTS (SELECT 1 FROM held other WHERE other.agg_mth = held.agg_mth AND other.begins < held.begins
                     AND other.subscriber_num = held.subscriber_num) AS first
  FROM held
  LEFT JOIN products main ON {trim_ws('main.product_code')} = held.plan
    AND held.month >= main.effective_date AND held.month <= main.expiration_date
  LEFT JOIN products2 second ON {trim_ws('second.curr_product_code')} = held.plan
    AND held.month >= second.start_date AND held.month <= second.end_date
)"""

_CDM_ROLES = ["base", "products", "products2"]

ORACLES["second_catalogue_switch"] = with_roles(_CDM_ROLES, _CDM + """
SELECT subscriber_num, agg_mth, price_plan, contract_start_date, current_brand, product_code,
       product_description, product_group FROM contracts""")

ORACLES["tariff_rules"] = with_roles(_CDM_ROLES, _CDM + """
SELECT subscriber_num, agg_mth, price_plan, contract_start_date, current_brand, billing_base,
       tariff AS tar_protocol FROM contracts""")

ORACLES["base_type_rules"] = with_roles(_CDM_ROLES, _CDM + """
SELECT subscriber_num, agg_mth, price_plan, contract_start_date, current_brand, line AS base_type FROM contracts""")

ORACLES["earliest_contract"] = with_roles(["base"], """
SELECT subscriber_num, agg_mth, price_plan, sub_id, contract_start_date FROM base one
WHERE NOT EXISTS (
  SELECT 1 FROM base other WHERE other.agg_mth = one.agg_mth AND other.subscriber_num = one.subscriber_num
    AND coalesce(other.contract_start_date, DATE '0001-01-01') < coalesce(one.contract_start_date, DATE '0001-01-01'))""")

ORACLES["effective_dated_join"] = with_roles(["base", "products"], f"""
SELECT b.subscriber_num, b.agg_mth, b.sub_id, b.price_plan, p.product_code, p.effective_date,
       p.expiration_date, p.protocol
FROM base b LEFT JOIN products p
  ON {trim_ws('b.price_plan')} = {trim_ws('p.product_code')}
 AND {MONTH_OF_AGG.format(a='b.agg_mth')} BETWEEN p.effective_date AND p.expiration_date""")

_RADIO = rule_table("radio_rule", RADIO_FIELDS, RADIO_RULES) + """,
radio AS (
  SELECT cells.*, coalesce(""" + decided("radio_rule", {
    "technology": "cells.technology", "cell": "cells.cell", "global_id": "cells.global_cell_id"}) + """, 'Other') AS layer
  FROM cells
)"""

ORACLES["tech_interpretation"] = with_roles(["cells"], _RADIO + """
SELECT cell_data_id, technology, cell, global_cell_id, layer AS interp_tech FROM radio""")

# ---- usage --------------------------------------------------------------------------------

# Usage of a number, month and radio layer in whole units: calls, seconds, texts, kilobytes.
_LAYERS = f""",
layered AS (
  SELECT {trim_ws('usage.msisdn')} AS number, usage.month_id, usage.month_date, coalesce(radio.layer, 'Other') AS layer,
         CAST(sum(home_mo_count + work_mo_count) AS BIGINT) AS mo_calls,
         CAST(sum(home_mt_count + work_mt_count) AS BIGINT) AS mt_calls,
         CAST(sum(home_mo_duration_secs + work_mo_duration_secs) AS BIGINT) AS mo_mins,
         CAST(sum(home_mt_duration_secs + work_mt_duration_secs) AS BIGINT) AS mt_mins,
         CAST(sum(home_mo_sms_count + work_mo_sms_count) AS BIGINT) AS mo_sms,
         CAST(sum(home_mt_sms_count + work_mt_sms_count) AS BIGINT) AS mt_sms,
         CAST(sum(home_data_in_volume_kb + work_data_in_volume_kb) AS BIGINT) AS dl_mb,
         CAST(sum(home_data_out_volume_kb + work_data_out_volume_kb) AS BIGINT) AS ul_mb
  FROM usage LEFT JOIN radio ON radio.cell_data_id = usage.first_cell_data_id
  WHERE usage.month_date >= {months_back(13)} AND usage.month_date <= {AS_OF}
  GROUP BY ALL
)"""

#: What a unit of the result holds of the whole units.
UNIT = {"mo_mins": "60.0::DOUBLE", "mt_mins": "60.0::DOUBLE", "dl_mb": "1024.0::DOUBLE", "ul_mb": "1024.0::DOUBLE"}
MEASURES = ["mo_calls", "mt_calls", "mo_mins", "mt_mins", "mo_sms", "mt_sms", "dl_mb", "ul_mb"]

ORACLES["usage_by_tech"] = with_roles(["usage", "cells"], _RADIO + _LAYERS + f"""
SELECT number AS msisdn, month_id, month_date, layer AS interp_tech,
       {", ".join(f"{m} / {UNIT[m]} AS {m}" if m in UNIT else m for m in MEASURES)}
FROM layered""")

# Numbers and cards seen together in a month; the placeholder cards are none.
_CARDS = f""",
cards AS (
  SELECT DISTINCT month_id, month_date, msisdn, imsi FROM usage
  WHERE {trim_ws('imsi')} <> '0' AND {trim_ws('imsi')} <> '234300000000000'
)"""

ORACLES["identity_list"] = with_roles(["usage"], _CARDS + """
SELECT month_id, month_date, msisdn, imsi FROM cards""")

VOICE = [("2G", "2G"), ("3G", "3G"), ("4G", "4G"), ("WIFI", "WI"), ("Other", "OTHER")]
DATA = [("2G", "2G"), ("3G", "3G"), ("4G", "4G"), ("5G", "5G"), ("Other", "OTHER")]
_PIVOT_MEASURES = [("MO_CALLS", "mo_calls", VOICE, True), ("MT_CALLS", "mt_calls", VOICE, True),
                   ("MO_MINS", "mo_mins", VOICE, False), ("MT_MINS", "mt_mins", VOICE, False),
                   ("MO_SMS", "mo_sms", VOICE, True), ("MT_SMS", "mt_sms", VOICE, True),
                   ("DL_MB", "dl_mb", DATA, False), ("UL_MB", "ul_mb", DATA, False)]


# The columns of the published tables, fixed by the data model.
_ATTRIBUTES = {
    "AGG_MTH": "agg_mth", "SUBSCRIBER_STATUS": "subscriber_status", "BILLING_BASE": "billing_base",
    "BUSINESS_TYPE": "business_type", "TAR_PROTOCOL": "tariff", "BASE_TYPE": "line", "ACTIVE_30D_PAYG": "active_30d_payg",
    "ACTIVE_90D_PAYG": "active_90d_payg", "ACCOUNT_TYPE": "account_type", "ACCOUNT_NUM": "account_num",
    "PRODUCT_CODE": "product_code", "PRODUCT_DESCRIPTION": "product_description", "PRODUCT_GROUP": "product_group",
    "ARPU": "arpu", "CONTRACT_START_DATE": "contract_start_date", "CONTRACT_END_DATE": "contract_end_date"}


def _bucket_sql() -> str:
    """Each measure of a layer, times the tied contracts and the equal lines of the subscriber."""
    columns = []
    for out, measure, buckets, _ in _PIVOT_MEASURES:
        for layer, suffix in buckets:
            units = f"coalesce(max(spread.{measure}) FILTER (spread.layer = '{layer}'), 0) * any_value(ties.rows)"
            if measure in UNIT:
                units = f"{units} / {UNIT[measure]}"
            columns.append(f"    {units} * any_value(lines.copies) AS {out}_{suffix}")
    return ",\n".join(columns)


# A subscriber's line is a set of equal first contracts. Its usage counts once for each tied contract
# of the subscriber-month and once for each equal one; every card of the month gets a row.
_MART = _CDM + _RADIO + _LAYERS + _CARDS + f""",
ties AS (SELECT number, month, count(*) AS rows FROM contracts WHERE first GROUP BY ALL),
lines AS (
  SELECT number, month, if(starts_with(number, '0'), number, '0' || number) AS "MSISDN",
         if(current_brand = 'EE' AND tariff = '3G', 'OUK EE 3G', current_brand) AS "BRAND",
         {", ".join(f'{column} AS "{name}"' for name, column in _ATTRIBUTES.items())}, count(*) AS copies
  FROM contracts WHERE first AND line <> 'MIFI' GROUP BY ALL
),
spread AS (
  SELECT layered.*, cards.imsi FROM layered
  LEFT JOIN cards ON {trim_ws('cards.msisdn')} = layered.number AND cards.month_date = layered.month_date
),
mart AS (
  SELECT "MSISDN", "BRAND", {", ".join(f'"{name}"' for name in _ATTRIBUTES)}, spread.imsi AS "IMSI",
{_bucket_sql()}
  FROM lines JOIN ties USING (number, month)
  LEFT JOIN spread ON spread.number = lines.number AND spread.month_date = lines.month
  GROUP BY "MSISDN", "BRAND", {", ".join(f'"{name}"' for name in _ATTRIBUTES)}, spread.imsi, lines.number
)"""

_MART_ROLES = ["base", "products", "products2", "usage", "cells"]

ORACLES["usage_mart"] = with_roles(_MART_ROLES, _MART + "\nSELECT * FROM mart")

# A tariff that names a generation is published as that generation, 4G before 5G.
_PUBLISHED = """,
published AS (
  SELECT * REPLACE (
    TRY_CAST("AGG_MTH" AS BIGINT) AS "AGG_MTH",
    coalesce(nullif(regexp_extract("TAR_PROTOCOL", '4G'), ''), nullif(regexp_extract("TAR_PROTOCOL", '5G'), ''), "TAR_PROTOCOL") AS "TAR_PROTOCOL")
  FROM mart
)"""

ORACLES["usage_mart_published"] = with_roles(_MART_ROLES, _MART + _PUBLISHED + "\nSELECT * FROM published")

ORACLES["update_from_aggregate"] = with_roles(_MART_ROLES, _MART + _PUBLISHED + f""",
activity AS (
  SELECT "MSISDN", CAST(sign(sum("ACTIVE_30D_PAYG")) AS INTEGER) AS flag FROM published
  WHERE "AGG_MTH" IN ({", ".join(month_key(months_back(n)) for n in (2, 3, 4))}) GROUP BY ALL
)
SELECT published.*, if("AGG_MTH" = {month_key(months_back(1))}, flag, NULL) AS NEW_ACTIVE90D_PAYG
FROM published LEFT JOIN activity USING ("MSISDN")""")

ORACLES["usage_pivot"] = f"""
WITH ev AS (
  SELECT user_id, CAST(date_trunc('month', CAST(ts AS DATE)) AS DATE) AS month_date,
         CASE event_type WHEN 'view' THEN '2G' WHEN 'click' THEN '3G' WHEN 'signup' THEN '4G'
                         WHEN 'error' THEN 'WIFI' WHEN 'purchase' THEN '5G' ELSE 'Other' END AS tech,
         CAST(round(value * 100) AS BIGINT) AS value_cents
  FROM events
)
SELECT user_id, month_date,
{",".join(f"{chr(10)}  CAST(SUM(CASE WHEN tech = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS EVENTS_{s}" for v, s in VOICE)},
{",".join(f"{chr(10)}  CAST(SUM(CASE WHEN tech = '{v}' THEN value_cents ELSE 0 END) AS BIGINT) AS VALUE_CENTS_{s}" for v, s in DATA)}
FROM ev GROUP BY 1, 2"""

# ---- subscriber base ----------------------------------------------------------------------

_MONTH_TEXT = "strftime({d}, '%Y%m')"

#: Fixed order of the feed's columns.
_FEED_COLUMNS = ("account_num, agg_mth, stack, price_plan, sub_id, base_type, current_brand, subscriber_status, subscriber_num, "
                 "billing_base, arpu, account_type, business_type, active_30d_payg, active_90d_payg, contract_start_date, "
                 "contract_end_date")

# The daily feed of last month's end, with brand and account type of the billing row of the same number, month
# and start where there is one, and the billing rows that the daily feed does not cover.
_FEEDS = f""",
billing AS (
  SELECT DISTINCT subscriber_num AS digits, CAST(agg_mth AS VARCHAR) AS month, contract_start_date AS begins,
         current_brand, account_type
  FROM legacy_base
),
daily AS (
  SELECT *, TRY_CAST(ctn AS BIGINT) AS digits, {_MONTH_TEXT.format(d='snapshot_date')} AS month
  FROM daily_base WHERE service = 'Mobile' AND snapshot_date = last_day({months_back(1)})
),
uncovered AS (
  SELECT * FROM legacy_base
  WHERE CAST(agg_mth AS VARCHAR) = {_MONTH_TEXT.format(d=months_back(1))}
    AND (business_type <> 'Consumer' OR billing_base = 'PAYG' AND current_brand <> 'Orange')
),
feed AS (
  SELECT daily.account_num, daily.month AS agg_mth, csm_stack AS stack, service_product_code AS price_plan,
         service_id AS sub_id, service_product_type AS base_type,
         if(billing.digits IS NULL, daily.brand, billing.current_brand) AS current_brand,
         service_id_status AS subscriber_status, ctn AS subscriber_num, 'PAYM' AS billing_base,
         total_service_product_rev_pm AS arpu,
         if(billing.digits IS NULL, 'N/A', billing.account_type) AS account_type, 'Consumer' AS business_type,
         CAST(-1 AS BIGINT) AS active_30d_payg, CAST(-1 AS BIGINT) AS active_90d_payg,
         daily.contract_start_date, daily.contract_end_date
  FROM daily LEFT JOIN billing
    ON billing.digits = daily.digits AND billing.month = daily.month AND billing.begins = daily.contract_start_date
  UNION ALL
  SELECT CAST(account_num AS VARCHAR), CAST(agg_mth AS VARCHAR), stack, price_plan, CAST(sub_id AS VARCHAR), base_type,
         current_brand, subscriber_status,
         repeat('0', 1 - CAST(starts_with(CAST(subscriber_num AS VARCHAR), '0') AS INTEGER)) || CAST(subscriber_num AS VARCHAR),
         billing_base, CAST(CAST(arpu AS DECIMAL(38, 9)) AS DOUBLE), account_type, business_type, active_30d_payg,
         active_90d_payg, contract_start_date, contract_end_date
  FROM uncovered
),
feeds AS (SELECT {_FEED_COLUMNS} FROM feed GROUP BY ALL)"""

_BASE_SELECT = f"""
SELECT {_FEED_COLUMNS.replace("subscriber_num,", "").replace("contract_start_date, contract_end_date", "")}
       if(starts_with(subscriber_num, '0'), subscriber_num, '0' || subscriber_num) AS subscriber_num,
       CAST(contract_start_date AS DATE) AS contract_start_date, CAST(contract_end_date AS DATE) AS contract_end_date
FROM feeds"""

ORACLES["subscriber_base"] = with_roles(["daily_base", "legacy_base"], _FEEDS + _BASE_SELECT)
ORACLES["union_distinct"] = with_roles(["daily_base", "legacy_base"], _FEEDS + "\nSELECT * FROM feeds")
ORACLES["subscriber_category"] = with_roles(["daily_base", "legacy_base"], _FEEDS + f""",
sb AS ({_BASE_SELECT})
SELECT DISTINCT CAST(strptime(agg_mth, '%Y%m') AS DATE) AS date_mth, subscriber_num AS msisdn,
       current_brand AS Brand, billing_base, business_type
FROM sb""")

# ---- row-changing statements ----------------------------------------------------------------

_UPSERT = """,
t AS (SELECT *, TIMESTAMP '2001-01-01 00:00:00' AS record_ts FROM cells
      WHERE technology IN ('2G GSM', '3G UMTS', '4G', 'WIFI')),
s AS (SELECT cell_data_id, technology, cell, global_cell_id, site_id, site_name || ' v2' AS site_name,
             latitude, longitude FROM cells WHERE technology IN ('4G', 'WIFI', '-1'))
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.cell_data_id = t.cell_data_id)
UNION ALL
SELECT s.*, TIMESTAMP '2001-08-15 06:00:00' AS record_ts FROM s"""

ORACLES["upsert_dim"] = with_roles(["cells"], _UPSERT)


def _cell_column(name: str, kind: str) -> str:
    made = {"antenna_bearing": "cell_data_id * 1.25", "radius": "cell_data_id / 8", "begin_angle": "-0.5",
            "node_id": "cell_data_id * 10", "cell_generation": "substr(technology, 1, 2)"}
    given = {"cell_data_id", "technology", "cell", "global_cell_id", "site_id", "site_name", "latitude", "longitude"}
    value = made.get(name, name if name in given else "NULL")
    return f"CAST({value} AS {dict(long='BIGINT', string='VARCHAR', numeric='DOUBLE')[kind]}) AS {name}"


ORACLES["cell_upsert"] = with_roles(["cells"], _UPSERT.replace("SELECT t.* FROM t", ", merged AS (SELECT t.* FROM t", 1) + f""")
SELECT {", ".join(_cell_column(*column) for column in CELL74)}, record_ts FROM merged""")

# Two deliveries of one feed, each row in one of them, end in the same dimension.
ORACLES["cell_merge"] = ORACLES["cell_upsert"]

_PADDED = """,
padded AS (
  SELECT month_id, month_date, date_of_call, call_date, imei, imsi,
         CASE WHEN work_mo_count % 2 = 0 THEN ' ' || msisdn || chr(9) ELSE msisdn END AS msisdn,
         CAST(call_date + 1 AS TIMESTAMP) AS record_ts
  FROM usage
)"""

ORACLES["conditional_trim"] = with_roles(["usage"], _PADDED + f"""
SELECT month_id, date_of_call, imei, imsi,
       CASE WHEN month_id >= 200001 THEN {trim_ws('msisdn')} ELSE msisdn END AS msisdn
FROM padded""")

ORACLES["key_backfill"] = with_roles(["usage"], _PADDED + f"""
SELECT date_of_call, imei, imsi,
       CASE WHEN CAST(record_ts AS DATE) > DATE '2000-07-12' THEN {trim_ws('msisdn')} ELSE msisdn END AS msisdn,
       record_ts
FROM padded""")

ORACLES["stamp_missing"] = """
SELECT event_id, user_id, event_type,
       coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE ts END, TIMESTAMP '2024-02-10 03:00:00') AS record_ts
FROM events"""

# ---- windows, keys, retention --------------------------------------------------------------

ORACLES["three_month_slice"] = with_roles(["usage"], f"""
SELECT call_date, date_of_call, msisdn, exbr_account_num, imei, imsi, first_cell_data_id, home_mo_count,
       home_mt_count, home_mo_sms_count, home_mt_sms_count, home_mo_duration_secs, home_mt_duration_secs,
       home_data_in_volume_kb, work_mo_count, work_mt_count, work_mo_sms_count, work_mt_sms_count,
       work_mo_duration_secs, work_mt_duration_secs, work_data_in_volume_kb, home_data_out_volume_kb,
       work_data_out_volume_kb, home_data_duration_secs, work_data_duration_secs
FROM usage
WHERE call_date BETWEEN CAST(date_trunc('month', {months_back(3)}) AS DATE) AND last_day({months_back(1)})""")

ORACLES["thirteen_month_window"] = with_roles(["usage"], f"""
SELECT month_id, month_date, CAST(count(*) AS BIGINT) AS usage_rows
FROM usage
WHERE month_id BETWEEN CAST(strftime({months_back(13)}, '%Y%m') AS BIGINT) AND CAST(strftime({AS_OF}, '%Y%m') AS BIGINT)
  AND month_date BETWEEN {months_back(13)} AND {AS_OF}
GROUP BY 1, 2""")

ORACLES["month_keys"] = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey,
       CAST(year(d) * 100 + month(d) AS BIGINT) AS month_id,
       strftime(d, '%Y%m') AS agg_mth,
       CAST(strptime(strftime(d, '%Y%m'), '%Y%m') AS DATE) AS month_date,
       CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS day_key,
       CAST(strptime(CAST(year(d) * 10000 + month(d) * 100 + day(d) AS VARCHAR), '%Y%m%d') AS DATE) AS order_day,
       CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) AS prev_month_start,
       last_day(d) AS month_end,
       CAST(year(d) AS INTEGER) AS order_year,
       CAST(month(d) AS INTEGER) AS order_month
FROM o"""

ORACLES["retain_partitions"] = f"""
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_date
FROM events WHERE CAST(ts AS DATE) > CAST({EVENTS_AS_OF} - INTERVAL 30 DAY AS DATE)"""

ORACLES["partition_guard_read"] = """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_date
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'"""

# ---- files, loads and reconciliation ------------------------------------------------------

ORACLES["delimited_roundtrip"] = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"

ORACLES["csv_cleanse"] = """
WITH lines AS (
  SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
         CASE WHEN p_size % 10 = 0 THEN '' ELSE p_name END AS p_name,
         p_type, CAST(p_size AS VARCHAR) AS p_size
  FROM part
)
SELECT p_partkey, p_name, p_type, p_size, '' AS p_flag FROM lines WHERE p_name <> ''"""

ORACLES["full_refresh"] = with_roles(["products2"], """
SELECT curr_product_code, start_date, end_date, mobile_data_speed, product_group, product_name,
       mobile_service_type, product_line, TIMESTAMP '2001-08-15 06:00:00' AS record_ts
FROM products2 WHERE product_line = 'BT Mobile'""")

ORACLES["device_refresh"] = with_roles(["devices"], "SELECT *, TIMESTAMP '2001-08-15 06:00:00' AS record_ts FROM devices")
ORACLES["product_refresh"] = with_roles(["products"], "SELECT *, TIMESTAMP '2001-08-15 06:00:00' AS record_ts FROM products")
ORACLES["refresh_drift"] = """
SELECT column_name, problem, declared, found, (SELECT count(*) FROM part) AS rows_kept
FROM (VALUES ('model', 'missing', 'string', NULL), ('model_name', 'added', NULL, 'string'),
             ('tac', 'retyped', 'string', 'bigint')) v(column_name, problem, declared, found)"""

ORACLES["file_gate"] = with_roles(["usage"], """,
d AS (SELECT DISTINCT month_id, exbr_account_num % (3 + month_id % 4) AS delivery FROM usage)
SELECT month_id, count(*) AS files, CAST(5 AS BIGINT) AS minimum, count(*) >= 5 AS ok FROM d GROUP BY month_id""")

# The refused load leaves the table as it was; the second attempt adds the month.
ORACLES["reconcile_load"] = with_roles(["usage"], """,
c AS (SELECT count(*) AS rows, count(*) FILTER (month_id = 200107) AS month FROM usage)
SELECT CAST(1 AS BIGINT) AS attempt, rows - month AS rows_before, rows - month AS rows_after, CAST(0 AS BIGINT) AS rows_loaded,
       month + 3 AS rows_expected, false AS ok FROM c
UNION ALL SELECT 2, rows - month, rows, month, month, true FROM c""")

_LOADED = f"""
SELECT {{key}}, {trim_ws("' ' || msisdn")} AS msisdn, imei, imsi, first_cell_data_id,
       {{columns}}, TIMESTAMP '2001-08-15 06:00:00' AS record_ts FROM usage"""

_MONTHLY_LOADED = "home_mo_count, work_mo_count, home_data_in_volume_kb"
ORACLES["monthly_usage_load"] = with_roles(["usage"], _LOADED.format(key="month_date, month_id", columns=_MONTHLY_LOADED))
ORACLES["monthly_export_load"] = ORACLES["monthly_usage_load"]
ORACLES["monthly_load_checked"] = with_roles(["usage"], _LOADED.format(key="month_id", columns=_MONTHLY_LOADED))
ORACLES["daily_usage_load"] = with_roles(["usage"], _LOADED.format(
    key="call_date, date_of_call",
    columns="exbr_account_num, home_mo_count, work_mo_count, home_mo_duration_secs, home_data_out_volume_kb"))

# Every delivered row once, whichever delivery it came in; numbers are blank on some rows.
ORACLES["daily_load_twice"] = ORACLES["daily_usage_load"].replace(
    trim_ws("' ' || msisdn") + " AS msisdn", "CASE WHEN work_mo_count <> 3 THEN " + trim_ws("' ' || msisdn") + " END AS msisdn")

ORACLES["load_audit"] = with_roles(["usage"], """,
per AS (
  SELECT CASE WHEN exbr_account_num % 40 = 0 THEN 2 ELSE 1 END AS load_number, count(*) AS rows_loaded,
         count(*) FILTER (work_mo_count = 3) AS null_keys, CAST(sum(home_mo_count) AS BIGINT) AS home_mo_count
  FROM usage GROUP BY 1)
SELECT CAST(p.load_number AS BIGINT) AS load_number, CAST(coalesce(sum(e.rows_loaded), 0) AS BIGINT) AS rows_before, p.rows_loaded,
       CAST(coalesce(sum(e.rows_loaded), 0) + p.rows_loaded AS BIGINT) AS rows_after, p.null_keys, p.home_mo_count,
       TIMESTAMP '2001-08-15 06:00:00' AS record_ts
FROM per p LEFT JOIN per e ON e.load_number < p.load_number
GROUP BY p.load_number, p.rows_loaded, p.null_keys, p.home_mo_count""")

ORACLES["landing_archive"] = with_roles(["usage"], """
SELECT month_id, CASE WHEN month_id <= 200107 THEN 'archive' ELSE 'landing' END AS place,
       count(*) FILTER (month_id <= 200107) AS rows_loaded
FROM usage GROUP BY month_id""")

ORACLES["backfill_stored"] = with_roles(["usage"], _PADDED + f"""
SELECT 'daily' AS table_name, call_date AS period, imei, imsi,
       CASE WHEN CAST(record_ts AS DATE) > DATE '2000-07-12' THEN {trim_ws('msisdn')} ELSE msisdn END AS msisdn
FROM padded
UNION ALL
SELECT 'monthly', month_date, imei, imsi, CASE WHEN month_id >= 200001 THEN {trim_ws('msisdn')} ELSE msisdn END
FROM padded""")

ORACLES["monthly_close"] = f"""
SELECT 'load' AS step, CAST(1 AS BIGINT) AS finished, count(*) AS rows FROM ({ORACLES["monthly_usage_load"]}) WHERE month_id = 200107
UNION ALL SELECT 'base', 1, count(*) FROM ({ORACLES["subscriber_base"]})
UNION ALL SELECT 'history', 1, count(*) FROM ({ORACLES["best_device"]})
UNION ALL SELECT 'mart', 1, NULL"""

ORACLES["period_cursor"] = with_roles(["usage"], """,
m AS (SELECT max(month_id) AS m FROM usage),
nxt AS (SELECT strftime(CAST(strptime(CAST(m AS VARCHAR), '%Y%m') AS DATE) + INTERVAL 1 MONTH, '%Y%m') AS next_month FROM m)
SELECT next_month,
       strftime(CAST(strptime(next_month, '%Y%m') AS DATE) + INTERVAL 1 MONTH, '%Y%m') AS following_month
FROM nxt""")

ORACLES["staging_copy"] = with_roles(["cells"], """
SELECT cell_data_id, technology, cell, global_cell_id, site_id FROM cells""")

# ---- text flows ---------------------------------------------------------------------------

ORACLES["ratings_filter"] = "SELECT event_id, user_id, value AS rating FROM events WHERE value > 4"

ORACLES["word_extract"] = """
SELECT word, CAST(count(*) AS BIGINT) AS occurrences
FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z'']+')) AS word FROM documents)
GROUP BY word"""

# ---- network marts ------------------------------------------------------------------------

SITE_VOICE = [("2G", "2G"), ("3G", "3G"), ("4G", "4G"), ("WIFI", "WIFI"), ("Other", "OTHER")]


def _site_measure_sql(totals_only: bool) -> str:
    mo_calls = "(u.home_mo_count + u.work_mo_count)"
    mt_calls = "(u.home_mt_count + u.work_mt_count)"
    mo_secs = "(u.home_mo_duration_secs + u.work_mo_duration_secs)"
    mt_secs = "(u.home_mt_duration_secs + u.work_mt_duration_secs)"
    mo_sms = "(u.home_mo_sms_count + u.work_mo_sms_count)"
    mt_sms = "(u.home_mt_sms_count + u.work_mt_sms_count)"
    dl = "(u.home_data_in_volume_kb + u.work_data_in_volume_kb)"
    ul = "(u.home_data_out_volume_kb + u.work_data_out_volume_kb)"
    out = []
    for name, mo, mt, div in (("CALLS", mo_calls, mt_calls, None), ("MINS", mo_secs, mt_secs, "60.0"),
                              ("SMS", mo_sms, mt_sms, None)):
        parts = [("TOTAL", f"({mo} + {mt})")] if totals_only else [("MO", mo), ("MT", mt), ("TOTAL", f"({mo} + {mt})")]
        for label, expr in parts:
            for value, suffix in SITE_VOICE:
                s = f"SUM(CASE WHEN interp_tech = '{value}' THEN {expr} ELSE 0 END)"
                s = f"{s} / {div}::DOUBLE" if div else f"CAST({s} AS BIGINT)"
                out.append(f"  {s} AS {label}_{name}_{suffix}")
    dparts = [("TOTAL_DATA", f"({dl} + {ul})")] if totals_only else [("UL", ul), ("DL", dl), ("TOTAL_DATA", f"({dl} + {ul})")]
    for label, expr in dparts:
        for value, suffix in DATA:
            out.append(f"  SUM(CASE WHEN interp_tech = '{value}' THEN {expr} ELSE 0 END) / 1024.0::DOUBLE AS {label}_MB_{suffix}")
    return ",\n".join(out)


_SITE_TECH = _RADIO + """,
ut AS (
  SELECT u.*, radio.site_id, radio.latitude, radio.longitude, coalesce(radio.layer, 'Other') AS interp_tech
  FROM usage u LEFT JOIN radio ON u.first_cell_data_id = radio.cell_data_id
)"""

ORACLES["site_usage"] = with_roles(["usage", "cells"], _SITE_TECH + f"""
SELECT date_of_call, call_date, msisdn, imei, imsi, exbr_account_num, site_id,
{_site_measure_sql(False)}
FROM ut u GROUP BY 1, 2, 3, 4, 5, 6, 7""")

ORACLES["protocol_site_usage"] = with_roles(["usage", "cells", "devices", "subscribers"], _SITE_TECH + f""",
g AS (
  SELECT u.month_date AS date_of_call_month_date, u.site_id AS SITE_ID, u.latitude AS LATITUDE,
         CAST(u.latitude AS DOUBLE) AS LATDD, u.longitude AS LONGITUDE,
         CAST(u.longitude AS DOUBLE) AS LONGDD, u.msisdn AS MSISDN, u.imei, u.imsi,
         u.exbr_account_num AS ACCOUNT_NUM, s.business_name AS BUSINESS_NAME, s.segment AS SEGMENT,
         s.brand AS BRAND, d.protocol AS DEVICE_PROTOCOL, d.device_type AS DEVICE_TYPE, d.model AS MODEL,
         d.marketing_name AS MARKETING_NAME, d.volte_flag AS VOLTE_FLAG,
{_site_measure_sql(True)}
  FROM ut u
  LEFT JOIN devices d ON substr(u.imei, 1, 8) = d.tac
  LEFT JOIN subscribers s ON u.msisdn = s.msisdn
  GROUP BY ALL
)
SELECT *,
       CASE WHEN coalesce(TOTAL_CALLS_3G, 0) + coalesce(TOTAL_MINS_3G, 0) + coalesce(TOTAL_SMS_3G, 0)
                 + coalesce(TOTAL_DATA_MB_3G, 0) > 0 THEN 'Y' ELSE 'N' END AS FLAG_3G_USAGE,
       CASE WHEN coalesce(TOTAL_CALLS_4G, 0) + coalesce(TOTAL_MINS_4G, 0) + coalesce(TOTAL_SMS_4G, 0)
                 + coalesce(TOTAL_DATA_MB_4G, 0) > 0 THEN 'Y' ELSE 'N' END AS FLAG_4G_USAGE
FROM g""")

# Rows of two deliveries, whichever came first; numbers are blank on some rows.
for _name in ("site_usage", "protocol_site_usage"):
    ORACLES[f"{_name}_incremental"] = ORACLES[_name].replace(
        "SELECT u.*, radio.site_id", "SELECT u.* REPLACE (CASE WHEN work_mo_count <> 3 THEN msisdn END AS msisdn), radio.site_id")

ORACLES["usage_mart_incremental"] = with_roles(_MART_ROLES, """,
landed AS (SELECT * REPLACE (CASE WHEN work_mo_count <> 3 THEN msisdn END AS msisdn) FROM usage)""" + (
    _MART + _PUBLISHED).replace("FROM usage", "FROM landed AS usage") + "\nSELECT * FROM published")

ORACLES["site_usage_clustered"] = f"""
SELECT m.*, CAST(s.latitude AS DOUBLE) AS latitude, CAST(s.longitude AS DOUBLE) AS longitude
FROM (SELECT CAST(date_trunc('month', call_date) AS DATE) AS month_date, site_id, count(*) AS mart_rows,
             CAST(sum(TOTAL_CALLS_4G) AS BIGINT) AS calls_4g
      FROM ({ORACLES["site_usage"]}) GROUP BY 1, 2) m
JOIN ({with_roles(["cells"], "SELECT site_id, min(latitude) AS latitude, min(longitude) AS longitude FROM cells GROUP BY site_id")}) s
  ON s.site_id = m.site_id"""

# ---- streaming ----------------------------------------------------------------------------

ORACLES["landing_stream"] = """
SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS event_date FROM events"""
