"""Network marts: three-month dashboard slice, site usage by technology, and site usage by
device protocol.

The two site marts exist in the reference as table declarations only; their recipe is
inferred from the column names and the usage pivot: TOTAL = MO + MT, DATA = DL + UL, a
technology per row from its first cell, buckets summed with 0 for an empty bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellmart.functions import rules
from cellmart.functions.calendar import trailing_whole_months
from cellmart.operators.joins import attribute_join, bounded, prefix_join
from cellmart.plans.incremental import IncrementalMart, dealt_by_period
from cellmart.plans.usage import tech_of_cell
from cellmart.sinks import writers

DASHBOARD_COLUMNS = [
    "call_date", "date_of_call", "msisdn", "exbr_account_num", "imei", "imsi", "first_cell_data_id",
    "home_mo_count", "home_mt_count", "home_mo_sms_count", "home_mt_sms_count", "home_mo_duration_secs",
    "home_mt_duration_secs", "home_data_in_volume_kb", "work_mo_count", "work_mt_count",
    "work_mo_sms_count", "work_mt_sms_count", "work_mo_duration_secs", "work_mt_duration_secs",
    "work_data_in_volume_kb", "home_data_out_volume_kb", "work_data_out_volume_kb",
    "home_data_duration_secs", "work_data_duration_secs"]

# Bucket suffixes of the site marts (value -> suffix).
SITE_VOICE = (("2G", "2G"), ("3G", "3G"), ("4G", "4G"), ("WIFI", "WIFI"), ("Other", "OTHER"))
SITE_DATA = (("2G", "2G"), ("3G", "3G"), ("4G", "4G"), ("5G", "5G"), ("Other", "OTHER"))


def three_month_slice(usage_dly: DataFrame, as_of) -> DataFrame:
    """Daily usage of the three whole months before ``as_of`` in the dashboard layout."""
    return usage_dly.filter(trailing_whole_months("call_date", as_of, 3)).select(*DASHBOARD_COLUMNS)


def _with_tech(usage: DataFrame, cells: DataFrame, cell_cols) -> DataFrame:
    cd = cells.select(F.col("cell_data_id").alias("__cell_id"), "technology", "cell", "global_cell_id",
                      *cell_cols)
    j = usage.join(cd, usage["first_cell_data_id"] == cd["__cell_id"], "left")
    return j.withColumn("interp_tech", tech_of_cell())


def _with_bounded_tech(sums: DataFrame, cells: DataFrame, cell_cols) -> DataFrame:
    """``_with_tech`` with the technology derived once a cell, and the cells sent to the sums as long as they are
    few; the cell itself is not kept."""
    cd = bounded(cells.select(F.col("cell_data_id").alias("__cell_id"), tech_of_cell().alias("__tech"), *cell_cols))
    no_cell = rules.radio_technology(**dict.fromkeys(("technology", "cell", "global_cell_id"), F.lit(None).cast("string")))
    j = sums.join(cd, sums["first_cell_data_id"] == cd["__cell_id"], "left")
    return j.withColumn("interp_tech", F.when(F.col("__cell_id").isNull(), no_cell).otherwise(F.col("__tech"))) \
            .drop("__cell_id", "__tech", "first_cell_data_id")


# Plain measures of a usage row (SQL expressions).
_PLAIN = {
    "mo_calls": "home_mo_count + work_mo_count", "mt_calls": "home_mt_count + work_mt_count",
    "mo_mins": "home_mo_duration_secs + work_mo_duration_secs", "mt_mins": "home_mt_duration_secs + work_mt_duration_secs",
    "mo_sms": "home_mo_sms_count + work_mo_sms_count", "mt_sms": "home_mt_sms_count + work_mt_sms_count",
    "dl_mb": "home_data_in_volume_kb + work_data_in_volume_kb", "ul_mb": "home_data_out_volume_kb + work_data_out_volume_kb",
}
_PLAIN |= {f"total_{kind}": f"{_PLAIN[a]} + {_PLAIN[b]}" for kind, a, b in (
    ("calls", "mo_calls", "mt_calls"), ("mins", "mo_mins", "mt_mins"), ("sms", "mo_sms", "mt_sms"), ("data_mb", "dl_mb", "ul_mb"))}
TOTALS = [name for name in _PLAIN if name.startswith("total_")]


def _plain_sums(names):
    return [F.expr(f"sum({_PLAIN[name]})").alias(name) for name in names]


def _measures(names):
    return [F.expr(_PLAIN[name]).alias(name) for name in names]


def _sums_of(names):
    return [F.sum(name).alias(name) for name in names]


def _spread(names):
    """The plain sums of each technology as bucket columns (one JVM parse per column)."""
    out = []
    for name in names:
        label, unit = name.upper().rsplit("_", 1)
        divisor = {"MINS": " / 60.0D", "MB": " / 1024.0D"}.get(unit, "")
        for value, suffix in SITE_DATA if unit == "MB" else SITE_VOICE:
            out.append(F.expr(f"sum(CASE WHEN interp_tech = '{value}' THEN {name} ELSE 0 END){divisor}").alias(f"{label}_{unit}_{suffix}"))
    return out


def site_usage(usage_dly: DataFrame, cells: DataFrame) -> DataFrame:
    """Per day x subscriber x handset x SIM x account x site: calls, minutes, SMS (MO, MT,
    TOTAL) and MB (UL, DL, TOTAL) by technology bucket. Rows are dealt out by the key once; the plain
    measures are summed by key and technology and spread to the 60 buckets on the same partitioning, so
    the buckets are never shuffled."""
    j = _with_tech(usage_dly, cells, ["site_id"])
    keys = ["date_of_call", "call_date", "msisdn", "imei", "imsi", "exbr_account_num", "site_id"]
    sums = j.repartition(*keys).groupBy(*keys, "interp_tech").agg(*_plain_sums(_PLAIN))
    return sums.groupBy(*keys).agg(*_spread(_PLAIN))


#: Buckets of the stored site marts and of the site dimension that is joined to them.
SITE_BUCKETS = 16


def store_site_usage(mart: DataFrame, sites: DataFrame, table: str, path: str) -> tuple[DataFrame, DataFrame]:
    """The site mart stored by month and clustered by site, and the site dimension in the same buckets."""
    mart = mart.withColumn("month_date", F.trunc("call_date", "MM"))
    return (writers.store_clustered(mart, table, f"{path}/mart", ["month_date"], "site_id", SITE_BUCKETS, ["call_date", "msisdn"]),
            writers.store_clustered(sites.withColumn("layer", F.lit("site")), f"{table}_sites", f"{path}/sites", ["layer"], "site_id", SITE_BUCKETS))


def monthly_site_totals(mart: DataFrame, sites: DataFrame) -> DataFrame:
    """Per month and site of the stored mart: its place, rows and 4G calls. Join and group run within the
    buckets."""
    j = mart.join(sites, "site_id")
    return j.groupBy("month_date", "site_id", "latitude", "longitude").agg(
        F.count(F.lit(1)).alias("mart_rows"), F.sum("TOTAL_CALLS_4G").alias("calls_4g"))


def protocol_site_usage(usage_mth: DataFrame, cells: DataFrame, devices: DataFrame,
                        subscribers: DataFrame) -> DataFrame:
    """Per month x site x subscriber x handset: totals by technology, handset attributes and
    3G / 4G usage flags ('Y' when any 3G / 4G usage was summed). Usage is summed by month, cell,
    number, handset, SIM and account before the dimensions are joined; an attribute row that
    matches twice counts the sums twice, as it would count the rows."""
    return protocol_of_sums(usage_mth.groupBy(*PROTOCOL_KEYS).agg(*_plain_sums(TOTALS)), cells, devices, subscribers)


#: Keys by which usage is summed before the dimensions are joined.
PROTOCOL_KEYS = ["month_date", "first_cell_data_id", "msisdn", "imei", "imsi", "exbr_account_num"]
SITE_KEYS = ["date_of_call", "call_date", "first_cell_data_id", "msisdn", "imei", "imsi", "exbr_account_num"]


def site_mart(cells: DataFrame, period: Column | None = None) -> IncrementalMart:
    """``site_usage`` kept up to date by month from a usage table of daily rows, stored by day or, with its month
    as ``period``, by month."""
    period = F.trunc("call_date", "MM") if period is None else period
    own = ["date_of_call", "call_date", "msisdn", "imei", "imsi", "exbr_account_num", "site_id"]

    # Dealt out by month before the sums are spread: the 60 buckets are not shuffled, and are written where they are.
    def derive(sums, periods):
        dealt = dealt_by_period(_with_bounded_tech(sums, cells, ["site_id"]), "period", own, periods)
        return dealt.groupBy("period", *own, "part").agg(*_spread(_PLAIN)).drop("part")

    return IncrementalMart("site_usage", SITE_KEYS, _sums_of(_PLAIN), period, derive, dealt=True, apart=True, measures=_measures(_PLAIN),
                           adds=True, subject=("msisdn", "msisdn"))


def protocol_mart(cells: DataFrame, devices: DataFrame, subscribers: DataFrame) -> IncrementalMart:
    """``protocol_site_usage`` kept up to date by month from the monthly usage table."""
    return IncrementalMart("protocol_site_usage", PROTOCOL_KEYS, _sums_of(TOTALS), F.col("month_date"),
                           lambda sums, periods: protocol_of_sums(sums, cells, devices, subscribers, periods)
                           .withColumn("period", F.col("date_of_call_month_date")), dealt=True, apart=True, measures=_measures(TOTALS),
                           adds=True, subject=("msisdn", "MSISDN"))


def protocol_of_sums(sums: DataFrame, cells: DataFrame, devices: DataFrame, subscribers: DataFrame, periods=None) -> DataFrame:
    """The protocol mart of summed usage. With ``periods``, the months of the sums, the joined sums are dealt out by
    month before they are spread to the buckets, and the mart's rows stay there."""
    j = (_with_tech if periods is None else _with_bounded_tech)(sums, cells, ["site_id", "latitude", "longitude"])
    dev = devices.select(F.col("tac").alias("__dtac"), F.col("protocol").alias("DEVICE_PROTOCOL"),
                         F.col("device_type").alias("DEVICE_TYPE"), F.col("model").alias("MODEL"),
                         F.col("marketing_name").alias("MARKETING_NAME"), F.col("volte_flag").alias("VOLTE_FLAG"))
    j = prefix_join(j, dev, "imei", "__dtac", 8)
    sub = subscribers.select(F.col("msisdn").alias("__smsisdn"), F.col("business_name").alias("BUSINESS_NAME"),
                             F.col("segment").alias("SEGMENT"), F.col("brand").alias("BRAND"))
    j = attribute_join(j, sub, [(j["msisdn"], sub["__smsisdn"])])
    keys = [F.col("month_date").alias("date_of_call_month_date"), F.col("site_id").alias("SITE_ID"),
            F.col("latitude").alias("LATITUDE"), F.col("latitude").cast("double").alias("LATDD"),
            F.col("longitude").alias("LONGITUDE"), F.col("longitude").cast("double").alias("LONGDD"),
            F.col("msisdn").alias("MSISDN"), "imei", "imsi", F.col("exbr_account_num").alias("ACCOUNT_NUM"),
            "BUSINESS_NAME", "SEGMENT", "BRAND", "DEVICE_PROTOCOL", "DEVICE_TYPE", "MODEL", "MARKETING_NAME",
            "VOLTE_FLAG"]
    if periods is None:
        g = j.groupBy(*keys).agg(*_spread(TOTALS))
    else:
        own = ["site_id", "msisdn", "imei", "imsi", "exbr_account_num"]
        g = dealt_by_period(j, "month_date", own, periods).groupBy(*keys, "part").agg(*_spread(TOTALS)).drop("part")

    def flag(sfx):
        used = (F.coalesce(F.col(f"TOTAL_CALLS_{sfx}"), F.lit(0)) + F.coalesce(F.col(f"TOTAL_MINS_{sfx}"), F.lit(0))
                + F.coalesce(F.col(f"TOTAL_SMS_{sfx}"), F.lit(0)) + F.coalesce(F.col(f"TOTAL_DATA_MB_{sfx}"), F.lit(0)))
        return F.when(used > 0, F.lit("Y")).otherwise(F.lit("N"))

    return g.withColumn("FLAG_3G_USAGE", flag("3G")).withColumn("FLAG_4G_USAGE", flag("4G"))
