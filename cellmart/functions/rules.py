"""Ordered business rules as searched CASE expressions.

A rule list is evaluated top to bottom and the first condition that is TRUE wins; a NULL
condition counts as no match, exactly like SQL ``CASE WHEN``. Each classifier takes its
inputs as Columns, so the same rules run on any table that supplies those roles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# Fixed values that must equal the reference data product's classification literals.
# ---------------------------------------------------------------------------------------
# Tariff protocol
FIVE_G = "5G"
PAYG_SWITCH = "PAYG SWITCH"
EE_3G_LEVEL1_PREFIX = "EE 3G%"
THREE_G_PRODUCT_CODES = ("X18PYG035", "X18PYG036")
T_MOBILE = "T-Mobile"
FIVE_G_DESCRIPTION_PATTERNS = ("%5G", "%5G %", "%5GEE%")
FIVE_G_ROLLUP_PATTERN = "%5G%"
FIVE_G_CODE_PATTERNS = ("X2%", "XB2%")
PAYM = "PAYM"
HANDSET_GROUP = "Handset"
SIMO_GROUP_PATTERN = "SIMO%"
FIVE_G_SIMO_DESCRIPTION_PATTERNS = ("SMART%SIM%", "5G SIM%", "FULL WORKS%", "%APPLE%")
THREE_G_DESCRIPTION_PREFIXES = ("EE 3G PL", "MBB 3G P", "EE 3G MB")
THREE_G_DESCRIPTIONS = ("EE SPECIAL RATES (3G)", "EE STANDARD RATES (3G)")
EE = "EE"
BT = "BT"
OTHER = "Other"
# Base type
FWA_DESCRIPTION_CODES = ("EE HR", "EE HO", "EE RO", "ME BR")
WIFI_PATTERN = "%WIFI%"
WATCH_PATTERNS = ("%WEA%", "%WATCH%")
# Radio technology of a cell
TWO_G_GLOBAL_PREFIXES = ("300", "301", "330")
# Invalid SIM identities dropped from the identity list
INVALID_IMSI = ("0", "234300000000000")
# Brand relabel
EE_3G_BRAND = "OUK EE 3G"
# Technology buckets of the usage pivot (bucket value, column suffix)
VOICE_BUCKETS = (("2G", "2G"), ("3G", "3G"), ("4G", "4G"), ("WIFI", "WI"), ("Other", "OTHER"))
DATA_BUCKETS = (("2G", "2G"), ("3G", "3G"), ("4G", "4G"), ("5G", "5G"), ("Other", "OTHER"))
# ---------------------------------------------------------------------------------------


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Build ``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE default END``."""
    if not rules:
        return _as_col(default)
    expr = None
    for cond, value in rules:
        value = _as_col(value)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(_as_col(default))


def _as_col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _any_like(c: Column, patterns: Sequence[str]) -> Column:
    out = None
    for p in patterns:
        term = c.like(p)
        out = term if out is None else (out | term)
    return out


def tariff_protocol(*, protocol: Column, base_type_level1: Column, product_code: Column,
                    product_description: Column, product_rollup: Column, product_group: Column,
                    brand: Column, billing_base: Column, alt_data_speed: Column) -> Column:
    """Network generation a tariff supports (12 ordered rules, else ``Other``)."""
    desc_u = F.upper(product_description)
    code_5g = _any_like(product_code, FIVE_G_CODE_PATTERNS) & (billing_base == PAYM)
    return first_match([
        (protocol == FIVE_G, "5G"),
        (base_type_level1 == PAYG_SWITCH, "3G"),
        (base_type_level1.like(EE_3G_LEVEL1_PREFIX), "3G"),
        (product_code.isin(*THREE_G_PRODUCT_CODES), "3G"),
        (brand == T_MOBILE, "3G"),
        (_any_like(product_description, FIVE_G_DESCRIPTION_PATTERNS)
         | product_rollup.like(FIVE_G_ROLLUP_PATTERN), "5G"),
        (code_5g & (product_group == HANDSET_GROUP), "5G"),
        (code_5g & product_group.like(SIMO_GROUP_PATTERN)
         & _any_like(desc_u, FIVE_G_SIMO_DESCRIPTION_PATTERNS), "5G"),
        (F.upper(F.substring(product_description, 1, 8)).isin(*THREE_G_DESCRIPTION_PREFIXES), "3G"),
        (desc_u.isin(*THREE_G_DESCRIPTIONS), "3G"),
        (brand == EE, "4G"),
        (brand == BT, alt_data_speed),
    ], OTHER)


def base_type(*, product_code: Column, product_description: Column, brand: Column,
              alt_service_type: Column, catalogue_base_type: Column) -> Column:
    """Base type with FWA / Wifi / Watch overrides, brand switch, else the catalogue value."""
    desc_u = F.upper(product_description)
    code_u = F.upper(product_code)
    return first_match([
        (F.upper(F.substring(product_description, 3, 5)).isin(*FWA_DESCRIPTION_CODES), "FWA"),
        (desc_u.like(WIFI_PATTERN), "Wifi"),
        (_any_like(code_u, WATCH_PATTERNS), "Watch"),
        (_any_like(desc_u, WATCH_PATTERNS), "Watch"),
        (brand == BT, alt_service_type),
    ], catalogue_base_type)


def radio_technology(*, technology: Column, cell: Column, global_cell_id: Column) -> Column:
    """Radio generation of a cell; an unknown cell (all inputs NULL) is ``Other``."""
    minus_one = technology == "-1"
    return first_match([
        (technology.like("2G%"), "2G"),
        (technology.like("3G%"), "3G"),
        (cell.like("_1"), "3G"),
        (cell.like("_2"), "3G"),
        (technology == "FEMTO", "3G"),
        (technology == "4G", "4G"),
        (global_cell_id.like("304%"), "4G"),
        (global_cell_id.like("305%"), "5G"),
        (technology == "WIFI", "WIFI"),
        (minus_one & F.substring(global_cell_id, 1, 3).isin(*TWO_G_GLOBAL_PREFIXES), "2G"),
        (minus_one & global_cell_id.like("302%"), "3G"),
    ], OTHER)


def brand_relabel(brand: Column, tariff_protocol_col: Column) -> Column:
    """EE customers on a 3G tariff are reported under their own brand label."""
    return F.when((brand == EE) & (tariff_protocol_col == "3G"), F.lit(EE_3G_BRAND)).otherwise(brand)


def protocol_collapse(tariff_protocol_col: Column) -> Column:
    """Collapse any protocol text containing 4G / 5G (4G tested first)."""
    return first_match([
        (tariff_protocol_col.like("%4G%"), "4G"),
        (tariff_protocol_col.like("%5G%"), "5G"),
    ], tariff_protocol_col)


def brand_switch(brand: Column, alt_value: Column, main_value: Column) -> Column:
    """Take an attribute from the second catalogue for BT customers, else from the first."""
    return F.when(brand == BT, alt_value).otherwise(main_value)


def matched_or(matched: Column, value: Column, default) -> Column:
    """Value from a joined row when the join matched, else a default."""
    return F.when(matched, value).otherwise(_as_col(default))
