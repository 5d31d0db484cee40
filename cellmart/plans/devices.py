"""Device marts: best device and most recent device of each subscriber last month.

Inputs use the reference's column names: monthly / daily usage facts (``msisdn``, ``imei``,
``month_id`` / ``date_of_call``, usage counters) and the device catalogue keyed on ``tac``
(the first 8 characters of the handset id).

Plan: scan (month filter pushed into parquet) -> partial/final hash aggregate per
subscriber x device type code -> join to the device catalogue (broadcast only if the
planner's size check allows; the join sees aggregated rows, not usage rows) -> shuffle on
``msisdn`` -> rank with a partial WindowGroupLimit before that shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellmart.functions.calendar import in_prev_month, prev_month_start
from cellmart.operators.aggregates import pair_sum
from cellmart.operators.rank import rank_first

TAC_LENGTH = 8
DEVICE_ATTRS = ["tac", "protocol", "device_type", "model", "manufacturer", "marketing_name",
                "volte_flag", "vowifi_flag"]
USAGE_COLS = ["home_data_duration_secs", "work_data_duration_secs", "home_mo_count",
              "home_mt_count", "work_mo_count", "work_mt_count", "home_mo_sms_count",
              "home_mt_sms_count", "work_mo_sms_count", "work_mt_sms_count"]


def _usage_sums():
    return [
        F.sum(pair_sum("home_data_duration_secs", "work_data_duration_secs")).alias("data_secs"),
        F.sum(pair_sum("home_mo_count", "home_mt_count", "work_mo_count", "work_mt_count")).alias("calls"),
        F.sum(pair_sum("home_mo_sms_count", "home_mt_sms_count", "work_mo_sms_count",
                       "work_mt_sms_count")).alias("sms"),
    ]


def _device_order():
    # DESC puts NULL last, as the warehouse does: unmatched devices rank behind known ones.
    return [F.desc("protocol"), F.desc("data_secs"), F.desc("calls"), F.desc("sms"), F.desc("tac")]


def _with_devices(aggregated: DataFrame, devices: DataFrame) -> DataFrame:
    """Attach catalogue attributes to per-(subscriber, type code) aggregates.

    Every grouping attribute of the reference query comes from the catalogue row matched by
    the code, so aggregating usage per code first and joining afterwards gives the same
    groups while the join sees one row per subscriber-device instead of one per usage row.
    A code listed twice with different attributes fans out into separate groups either way;
    identical catalogue rows would have multiplied the joined usage rows, so the sums are
    scaled by that multiplicity (counted in a small aggregate over the catalogue)."""
    dev = devices.groupBy(*DEVICE_ATTRS).agg(F.count(F.lit(1)).alias("__copies"))
    j = aggregated.join(dev, aggregated["imei8"] == dev["tac"], "left")
    copies = F.coalesce(F.col("__copies"), F.lit(1))
    return (j.withColumn("data_secs", F.col("data_secs") * copies)
             .withColumn("calls", F.col("calls") * copies)
             .withColumn("sms", F.col("sms") * copies)
             .drop("__copies"))


def best_device(usage_mth: DataFrame, devices: DataFrame, as_of) -> DataFrame:
    """Best device of each subscriber in the month before ``as_of`` (ties all kept,
    then duplicates removed)."""
    t = usage_mth.select("month_id", "msisdn", "imei", "month_date", *USAGE_COLS) \
                 .filter(F.col("month_date") == prev_month_start(as_of))
    g = t.groupBy("month_id", "msisdn", F.substring("imei", 1, TAC_LENGTH).alias("imei8")).agg(*_usage_sums())
    best = rank_first(_with_devices(g, devices), ["msisdn"], _device_order())
    return best.select("month_id", "msisdn", *DEVICE_ATTRS).distinct()


def recent_device(usage_dly: DataFrame, devices: DataFrame, as_of) -> DataFrame:
    """Most recently used device of each subscriber in the month before ``as_of``; the last
    call date (``YYYYMMDD``) orders first, then the best-device keys."""
    t = usage_dly.select("msisdn", "imei", "call_date", "date_of_call", *USAGE_COLS) \
                 .filter(in_prev_month("call_date", as_of))
    g = t.groupBy("msisdn", F.substring("imei", 1, TAC_LENGTH).alias("imei8")).agg(
        F.max("date_of_call").alias("last_date"), *_usage_sums())
    recent = rank_first(_with_devices(g, devices), ["msisdn"], [F.desc("last_date")] + _device_order())
    return recent.select("msisdn", F.col("imei8").alias("tac"), *DEVICE_ATTRS[1:], "last_date")


def best_device_history(usage_mth: DataFrame, devices: DataFrame, as_of, record_ts) -> DataFrame:
    """Rows appended to the best-device history: the best-device mart stamped with the load
    time (a parameter, so a re-run is reproducible)."""
    b = best_device(usage_mth, devices, as_of)
    return b.select(
        F.col("month_id").alias("MONTH_ID"), F.col("msisdn").alias("MSISDN"), F.col("tac").alias("TAC"),
        F.col("protocol").alias("PROTOCOL"), F.col("device_type").alias("DEVICE_TYPE"),
        F.col("model").alias("MODEL"), F.col("manufacturer").alias("MANUFACTURER"),
        F.col("marketing_name").alias("MARKETING_NAME"), F.col("volte_flag").alias("VOLTE_FLAG"),
        F.col("vowifi_flag").alias("VOWIFI_FLAG"), F.lit(record_ts).alias("RECORD_TS"))
