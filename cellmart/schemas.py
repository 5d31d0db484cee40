"""Declared schemas of the landing files and tables (all columns nullable).

Column names and types are the reference's data model (warehouse JSON schemas), mapped to
Spark types: INTEGER -> long, NUMERIC -> decimal(38,9), FLOAT -> double, DATETIME ->
timestamp_ntz, TIMESTAMP -> timestamp.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, LongType, StringType, StructField, StructType,
                               TimestampType)

NUMERIC = DecimalType(38, 9)

# The 59 usage columns shared by the daily and monthly usage layouts, in file order.
USAGE59 = [
    ("msisdn", "string"), ("exbr_account_num", "long"), ("css_account_id", "long"),
    ("jt_customer_id", "long"), ("subscription_sk", "long"), ("imei", "string"), ("imsi", "string"),
    ("first_cell_data_id", "long"), ("last_cell_data_id", "long"), ("home_mo_count", "long"),
    ("home_mt_count", "long"), ("home_mo_sms_count", "long"), ("home_mt_sms_count", "long"),
    ("home_mo_duration_secs", "long"), ("home_mt_duration_secs", "long"), ("home_data_cdr_count", "long"),
    ("home_data_in_volume_kb", "long"), ("work_mo_count", "long"), ("work_mt_count", "long"),
    ("work_mo_sms_count", "long"), ("work_mt_sms_count", "long"), ("work_mo_duration_secs", "long"),
    ("work_mt_duration_secs", "long"), ("work_data_cdr_count", "long"), ("work_data_in_volume_kb", "long"),
    ("cnt_of_distinct_bnumber", "long"), ("home_data_session_count", "long"),
    ("home_data_out_volume_kb", "long"), ("work_data_session_count", "long"),
    ("work_data_out_volume_kb", "long"), ("home_mo_dropcalls_count", "long"),
    ("home_mt_dropcalls_count", "long"), ("work_mo_dropcalls_count", "long"),
    ("work_mt_dropcalls_count", "long"), ("home_mo_ce_dropcalls_count", "long"),
    ("home_mt_ce_dropcalls_count", "long"), ("work_mo_ce_dropcalls_count", "long"),
    ("work_mt_ce_dropcalls_count", "long"), ("home_abnormal_session_count", "long"),
    ("work_abnormal_session_count", "long"), ("home_data_duration_secs", "long"),
    ("work_data_duration_secs", "long"), ("mo_handoff_cell_count", "long"),
    ("mt_handoff_cell_count", "long"), ("mo_handoff_technology_count", "long"),
    ("mt_handoff_technology_count", "long"), ("mo_handoff_mnc_count", "long"),
    ("mt_handoff_mnc_count", "long"), ("home_csd_duration_secs", "long"),
    ("work_csd_duration_secs", "long"), ("home_mt_dropcalls_ran_count", "long"),
    ("home_mt_dropcalls_core_count", "long"), ("work_mt_dropcalls_ran_count", "long"),
    ("work_mt_dropcalls_core_count", "long"), ("home_mo_dropcalls_ran_count", "long"),
    ("home_mo_dropcalls_core_count", "long"), ("work_mo_dropcalls_ran_count", "long"),
    ("work_mo_dropcalls_core_count", "long"), ("process_run_sequence", "long"),
]

_TYPES = {"string": StringType(), "long": LongType(), "date": DateType(), "timestamp": TimestampType(),
          "numeric": NUMERIC}


def struct(cols) -> StructType:
    return StructType([StructField(n, _TYPES[t], True) for n, t in cols])


USAGE_COLUMNS = [n for n, _ in USAGE59]
DAILY_STAGING = struct([("date_of_call", "long")] + USAGE59)
MONTHLY_STAGING = struct([("month_id", "long")] + USAGE59)

# The columns of the cell feed and dimension, in file order.
CELL74 = [
    ("cell_data_id", "long"), ("effective_from_date_id", "long"), ("effective_to_date_id", "long"),
    ("ims_date", "long"), ("node_id", "long"), ("node_name", "string"), ("node_class", "string"),
    ("configuration_data_1", "long"), ("configuration_data_2", "long"), ("configuration_data_3", "long"),
    ("site_code", "string"), ("site_name", "string"), ("bst_status", "string"),
    ("engineering_name", "string"), ("region", "string"), ("parent_node", "string"),
    ("antenna_bearing", "numeric"), ("cell_generation", "string"), ("site_address_line_1", "string"),
    ("site_address_line_2", "string"), ("site_address_line_3", "string"), ("site_address_line_4", "string"),
    ("county", "string"), ("site_number", "string"), ("site_area_description", "string"),
    ("acquisition_status", "string"), ("radius", "numeric"), ("begin_angle", "numeric"),
    ("end_angle", "numeric"), ("cellsector_name", "string"), ("node_county", "string"),
    ("node_site_number", "string"), ("source", "string"), ("cell_id", "numeric"), ("lac", "string"),
    ("site_id", "string"), ("max_cell_radius", "numeric"), ("mnc", "string"), ("cell_status", "string"),
    ("latitude", "string"), ("longitude", "string"), ("northing", "string"), ("easting", "string"),
    ("antenna_type", "string"), ("post_code", "string"), ("mcc", "string"), ("loaded_dt", "long"),
    ("bsc", "string"), ("altitude", "string"), ("cell", "string"), ("accmin", "string"),
    ("antenna_gain", "string"), ("bcc", "string"), ("bcchno", "string"), ("bspwr", "string"),
    ("bspwrb", "string"), ("c_sys_type", "string"), ("cell_dir", "string"), ("cell_type", "string"),
    ("env_char", "string"), ("height", "string"), ("max_altitude", "string"), ("min_altitude", "string"),
    ("ncc", "string"), ("sector_angle", "string"), ("talim", "string"), ("antenna_tilt", "string"),
    ("override_ta", "string"), ("node_status", "string"), ("enodebid", "numeric"),
    ("global_cell_id", "string"), ("technology", "string"), ("process_run_sequence", "long"),
    ("sourced_from", "string"),
]

CELL_FEED = struct(CELL74)


def _texts(names: str) -> list:
    return [(n, "string") for n in names.split()]


# Declared layouts of the reference extracts.
DEVICE_EXTRACT = struct(_texts("tac marketing_name manufacturer model protocol device_type volte_flag vowifi_flag"))
PRODUCT_EXTRACT = struct(
    _texts("product_code protocol product_rollup base_type product_group product_description base_type_level1 product_type brand")
    + [("effective_date", "date"), ("expiration_date", "date")])
PRODUCT2_EXTRACT = struct(
    _texts("curr_product_code") + [("start_date", "date"), ("end_date", "date")]
    + _texts("mobile_data_speed product_group product_name mobile_service_type product_line"))
