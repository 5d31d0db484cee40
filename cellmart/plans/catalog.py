"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per mart / operator,
run on the driver tables through the role adapter. Every query reads whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart import schemas
from cellmart.functions import rules
from cellmart.functions.calendar import (date_from_day_key, date_window, day_key, month_key, month_key_str,
                                         month_key_window, month_start)
from cellmart.operators import quality
from cellmart.operators.changes import stamp_missing, upsert
from cellmart.session import scratch_path
from cellmart.sinks import writers
from cellmart.sinks.keyed import KeyedTable
from cellmart.sinks.snapshots import Snapshots
from cellmart.sources import delimited, files
from cellmart.streaming.landing import landing_stream, run_once
from cellmart.operators.joins import effective_dated_join
from cellmart.operators.pivot import conditional_sums
from cellmart.operators.rank import rank_first
from cellmart.plans import close, devices, ledger, loads, network, roles, subscribers, text_flows, usage, views
from cellmart.plans.roles import EVENTS_AS_OF, LOAD_TS, ORDERS_AS_OF

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---- device marts ------------------------------------------------------------------------

@register("best_device")
def q_best_device(spark, d):
    return devices.best_device(roles.usage(spark, d), roles.devices(spark, d), ORDERS_AS_OF)


@register("recent_device")
def q_recent_device(spark, d):
    return devices.recent_device(roles.usage(spark, d), roles.devices(spark, d), ORDERS_AS_OF)


@register("best_device_history")
def q_best_device_history(spark, d):
    """The stamped rows appended to the history; the query returns the stored history."""
    path = scratch_path(spark, "device_history")
    rows = devices.best_device(roles.usage(spark, d), roles.devices(spark, d), ORDERS_AS_OF)
    rows = rows.select(*[F.col(c).alias(c.upper()) for c in rows.columns])
    writers.history_append(rows, path, "RECORD_TS", LOAD_TS)
    return spark.read.parquet(path)


# ---- contracts, catalogues and rules ------------------------------------------------------

def _attrs(spark, d):
    return usage.contract_attributes(roles.base(spark, d), roles.products(spark, d),
                                     roles.products2(spark, d), ORDERS_AS_OF)


@register("earliest_contract")
def q_earliest_contract(spark, d):
    b = roles.base(spark, d).select("subscriber_num", "agg_mth", "price_plan", "sub_id",
                                    "contract_start_date")
    first = rank_first(b, ["agg_mth", "subscriber_num"], [F.asc_nulls_first("contract_start_date")])
    return first


@register("effective_dated_join")
def q_effective_dated_join(spark, d):
    b = roles.base(spark, d).select("subscriber_num", "agg_mth", "price_plan", "sub_id") \
        .withColumn("month_date", F.to_date("agg_mth", "yyyyMM"))
    p = roles.products(spark, d).select("product_code", "effective_date", "expiration_date", "protocol")
    j = effective_dated_join(b, p, fact_key=F.col("price_plan"), dim_key=F.col("product_code"),
                             fact_date=F.col("month_date"), start=F.col("effective_date"),
                             end=F.col("expiration_date"))
    return j.select("subscriber_num", "agg_mth", "sub_id", "price_plan", "product_code",
                    "effective_date", "expiration_date", "protocol")


@register("second_catalogue_switch")
def q_second_catalogue_switch(spark, d):
    return _attrs(spark, d).select("subscriber_num", "agg_mth", "price_plan", "contract_start_date",
                                   "current_brand", "product_code", "product_description", "product_group")


@register("tariff_rules")
def q_tariff_rules(spark, d):
    return _attrs(spark, d).select("subscriber_num", "agg_mth", "price_plan", "contract_start_date",
                                   "current_brand", "billing_base", F.col("tar_p2").alias("tar_protocol"))


@register("base_type_rules")
def q_base_type_rules(spark, d):
    return _attrs(spark, d).select("subscriber_num", "agg_mth", "price_plan", "contract_start_date",
                                   "current_brand", "base_type")


@register("tech_interpretation")
def q_tech_interpretation(spark, d):
    c = roles.cells(spark, d)
    return c.select("cell_data_id", "technology", "cell", "global_cell_id",
                    usage.tech_of_cell().alias("interp_tech"))


# ---- usage --------------------------------------------------------------------------------

@register("usage_by_tech")
def q_usage_by_tech(spark, d):
    return usage.usage_by_tech(roles.usage(spark, d), roles.cells(spark, d), ORDERS_AS_OF)


@register("identity_list")
def q_identity_list(spark, d):
    return usage.identity_list(roles.usage(spark, d))


def _mart(spark, d):
    return usage.usage_mart(roles.base(spark, d), roles.products(spark, d), roles.products2(spark, d),
                            roles.usage(spark, d), roles.cells(spark, d), ORDERS_AS_OF)


@register("usage_mart")
def q_usage_mart(spark, d):
    return _mart(spark, d)


@register("usage_mart_published")
def q_usage_mart_published(spark, d):
    return usage.publish(_mart(spark, d))


@register("update_from_aggregate")
def q_update_from_aggregate(spark, d):
    """The published mart is written partitioned by month; the flag's aggregate reads three of its
    months and the update replaces one partition. The query returns the stored table."""
    return usage.publish_and_flag(_mart(spark, d), scratch_path(spark, "usage_agg_mth"), ORDERS_AS_OF)


@register("usage_pivot")
def q_usage_pivot(spark, d):
    """The conditional-sum pivot on the event stream: event type = technology bucket,
    EVENTS counted on the voice buckets, VALUE_CENTS summed on the data buckets."""
    ev = roles.table(spark, d, "events")
    tech = None
    for k, v in roles.EVENT_TECHNOLOGY.items():
        tech = F.when(F.col("event_type") == k, v) if tech is None else tech.when(F.col("event_type") == k, v)
    ev = ev.select("user_id", F.trunc(F.to_date("ts"), "MM").alias("month_date"),
                   tech.otherwise("Other").alias("tech"),
                   F.round(F.col("value") * 100).cast("long").alias("value_cents"))
    return conditional_sums(ev, ["user_id", "month_date"], F.col("tech"),
                            {"EVENTS": F.lit(1).cast("long"), "VALUE_CENTS": F.col("value_cents")},
                            {"EVENTS": rules.VOICE_BUCKETS, "VALUE_CENTS": rules.DATA_BUCKETS})




# ---- subscriber base ----------------------------------------------------------------------

@register("subscriber_base")
def q_subscriber_base(spark, d):
    return subscribers.subscriber_base(roles.daily_base(spark, d), roles.legacy_base(spark, d), ORDERS_AS_OF)


@register("union_distinct")
def q_union_distinct(spark, d):
    return subscribers.combined_feed(roles.daily_base(spark, d), roles.legacy_base(spark, d), ORDERS_AS_OF)


@register("subscriber_category")
def q_subscriber_category(spark, d):
    return subscribers.subscriber_category(q_subscriber_base(spark, d))


# ---- row-changing statements ----------------------------------------------------------------

# Fixed adapter choice: the dimension held before the load covers the 2G/3G/4G/WIFI layers,
# the landed feed the 4G/WIFI/unknown layers (so rows are matched, new and untouched).
UPSERT_TARGET_TECH = ("2G GSM", "3G UMTS", "4G", "WIFI")
UPSERT_SOURCE_TECH = ("4G", "WIFI", "-1")
INITIAL_TS = dt.datetime(2001, 1, 1)


def _cell_target_source(spark, d):
    c = roles.cells(spark, d)
    target = c.filter(F.col("technology").isin(*UPSERT_TARGET_TECH)).withColumn("record_ts", F.lit(INITIAL_TS))
    source = c.filter(F.col("technology").isin(*UPSERT_SOURCE_TECH)) \
              .withColumn("site_name", F.concat(F.col("site_name"), F.lit(" v2")))
    return target, source


@register("upsert_dim")
def q_upsert_dim(spark, d):
    target, source = _cell_target_source(spark, d)
    return upsert(target, source, ["cell_data_id"], stamp_col="record_ts", stamp=LOAD_TS)


def _full_cells(df: DataFrame) -> DataFrame:
    """Cells in the declared 74-column layout; NUMERIC columns hold fractions, others that the role
    lacks are NULL."""
    own = {"antenna_bearing": F.expr("cell_data_id * 1.25"), "radius": F.expr("cell_data_id / 8"),
           "begin_angle": F.expr("-0.5"), "node_id": F.col("cell_data_id") * 10, "cell_generation": F.substring("technology", 1, 2)}
    extra = [c for c in df.columns if c not in schemas.CELL_FEED.fieldNames()]
    return df.select(*[(own[c] if c in own else F.col(c) if c in df.columns else F.lit(None)).cast(schemas.CELL_FEED[c].dataType).alias(c)
                       for c in schemas.CELL_FEED.fieldNames()], *extra)


@register("cell_upsert")
def q_cell_upsert(spark, d):
    """Cell dimension in its full layout upserted from landed pipe-delimited gz files through a
    staging table; the query reads the stored dimension (NUMERIC as double, for the comparison)."""
    target, source = _cell_target_source(spark, d)
    landing = scratch_path(spark, "cell_landing")
    writers.write_csv(_full_cells(source), landing, schemas.CELL_FEED.fieldNames(), sep="|", compression="gzip")
    table = scratch_path(spark, "cell_dim")
    merged = loads.cell_upsert(spark, _full_cells(target), f"{landing}/*.csv.gz", scratch_path(spark, "cell_staging"), LOAD_TS)
    writers.refresh(merged, table)
    stored = spark.read.parquet(table)
    return stored.select(*[F.col(c).cast("double") if t.startswith("decimal") else c for c, t in stored.dtypes])


#: Buckets of the stored cell dimension, and the share of its feed that comes in a second delivery.
CELL_BUCKETS, LATE_CELLS = 8, 5


@register("cell_merge")
def q_cell_merge(spark, d):
    """Cell dimension stored in key buckets; its feed lands in two deliveries, which are merged into the buckets
    they touch and archived, and a third run finds nothing. The query reads the stored dimension."""
    target, source = _cell_target_source(spark, d)
    landing, archive, staging = (scratch_path(spark, n) for n in ("cell_landing", "cell_archive", "cell_staging"))
    dim = KeyedTable(Snapshots(spark, scratch_path(spark, "dimensions")), "cells", ["cell_data_id"])
    dim.create(_full_cells(target), CELL_BUCKETS)
    late = F.col("cell_data_id") % LATE_CELLS == 0
    for k, feed in enumerate((source.filter(~late), source.filter(late))):
        writers.write_csv(_full_cells(feed), f"{landing}/{k}", schemas.CELL_FEED.fieldNames(), sep="|", compression="gzip")
        loads.load_cells(spark, dim, landing, staging, LOAD_TS, archive=archive)
    loads.load_cells(spark, dim, landing, staging, LOAD_TS, archive=archive)
    stored = dim.read()
    return stored.select(*[F.col(c).cast("double") if t.startswith("decimal") else c for c, t in stored.dtypes])


def _padded_usage(spark, d):
    u = roles.usage(spark, d)
    padded = F.when(F.col("work_mo_count") % 2 == 0, F.concat(F.lit(" "), F.col("msisdn"), F.lit("\t"))) \
              .otherwise(F.col("msisdn"))
    return u.withColumn("msisdn", padded) \
            .withColumn("record_ts", F.date_add("call_date", 1).cast("timestamp"))


@register("conditional_trim")
def q_conditional_trim(spark, d):
    u = _padded_usage(spark, d).select("month_id", "date_of_call", "imei", "imsi", "msisdn")
    return loads.key_backfill_monthly(u, 200001)


@register("key_backfill")
def q_key_backfill(spark, d):
    u = _padded_usage(spark, d).select("date_of_call", "imei", "imsi", "msisdn", "record_ts")
    return loads.key_backfill_daily(u, dt.date(2000, 7, 12))


EVENTS_STAMP = dt.datetime(2024, 2, 10, 3, 0, 0)


@register("stamp_missing")
def q_stamp_missing(spark, d):
    ev = roles.table(spark, d, "events")
    ev = ev.select("event_id", "user_id", "event_type",
                   F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("ts")).alias("record_ts"))
    return stamp_missing(ev, "record_ts", EVENTS_STAMP)


# ---- windows, keys, retention --------------------------------------------------------------

@register("three_month_slice")
def q_three_month_slice(spark, d):
    return network.three_month_slice(roles.usage(spark, d), ORDERS_AS_OF)


@register("thirteen_month_window")
def q_thirteen_month_window(spark, d):
    u = roles.usage(spark, d).select("month_id", "month_date")
    w = u.filter(month_key_window("month_id", ORDERS_AS_OF, 13, 0) & date_window("month_date", ORDERS_AS_OF, 13))
    return w.groupBy("month_id", "month_date").agg(F.count(F.lit(1)).alias("usage_rows"))


@register("month_keys")
def q_month_keys(spark, d):
    o = roles.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.select(
        "o_orderkey", month_key("d").alias("month_id"), month_key_str("d").alias("agg_mth"),
        month_start(month_key_str("d")).alias("month_date"), day_key("d").alias("day_key"),
        date_from_day_key(day_key("d")).alias("order_day"),
        F.add_months(F.trunc("d", "MM"), -1).alias("prev_month_start"),
        F.last_day("d").alias("month_end"), F.year("d").alias("order_year"), F.month("d").alias("order_month"))


EVENT_TTL_DAYS = 30


@register("retain_partitions")
def q_retain_partitions(spark, d):
    """A table stored by day whose expired partitions were dropped."""
    ev = roles.table(spark, d, "events").select("event_id", "user_id", "event_type",
                                                F.to_date("ts").alias("event_date"))
    path = scratch_path(spark, "events_stored")
    writers.append(ev, path, partition_by=["event_date"])
    writers.expire_partitions(spark, path, "event_date", EVENT_TTL_DAYS, EVENTS_AS_OF)
    return spark.read.parquet(path).select(*ev.columns)


@register("partition_guard_read")
def q_partition_guard_read(spark, d):
    ev = roles.table(spark, d, "events").select("event_id", "user_id", "event_type", "value",
                                                F.to_date("ts").alias("event_date"))
    path = scratch_path(spark, "events_by_day")
    writers.append(ev, path, partition_by=["event_date"])
    return writers.read_period(spark, path, "event_date", dt.date(2024, 1, 8), dt.date(2024, 1, 14)) \
                  .select("event_id", "user_id", "event_type", "value", "event_date")


# ---- files, loads and reconciliation ------------------------------------------------------

PART_SCHEMA = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@register("delimited_roundtrip")
def q_delimited_roundtrip(spark, d):
    part = roles.table(spark, d, "part")
    path = scratch_path(spark, "part_pipe")
    writers.write_csv(part, path, part.columns, sep="|", compression="gzip")
    return delimited.read_delimited(spark, f"{path}/*.csv.gz", PART_SCHEMA, sep="|")


CLEANSE_IN = "p_partkey,p_name,p_brand,p_type,p_size"
CLEANSE_OUT = "p_partkey,p_name,p_type,p_size,p_flag"


@register("csv_cleanse")
def q_csv_cleanse(spark, d):
    part = roles.table(spark, d, "part")
    lines = part.select(F.col("p_partkey").cast("string").alias("p_partkey"),
                        F.when(F.col("p_size") % 10 == 0, F.lit("")).otherwise(F.col("p_name")).alias("p_name"),
                        "p_brand", "p_type", F.col("p_size").cast("string").alias("p_size"))
    path = scratch_path(spark, "cleanse_in")
    writers.write_csv(lines, path, lines.columns, sep=",", compression="gzip")
    return delimited.cleanse_csv(spark, f"{path}/*.csv.gz", CLEANSE_IN, CLEANSE_OUT,
                                 primary_key="p_name", drop="p_brand", sep=",")


@register("full_refresh")
def q_full_refresh(spark, d):
    src = roles.products2(spark, d)
    path = scratch_path(spark, "ref_product2")
    writers.refresh(src.withColumn("record_ts", F.lit(INITIAL_TS)), path)   # the stale content
    loads.declared_refresh(src, schemas.PRODUCT2_EXTRACT, path, LOAD_TS, keep=F.col("product_line") == "BT Mobile")
    return spark.read.parquet(path)


@register("device_refresh")
def q_device_refresh(spark, d):
    path = scratch_path(spark, "ref_device")
    loads.declared_refresh(roles.devices(spark, d), schemas.DEVICE_EXTRACT, path, LOAD_TS)
    return spark.read.parquet(path)


@register("product_refresh")
def q_product_refresh(spark, d):
    """The first catalogue; its dates come as datetimes and are narrowed."""
    path = scratch_path(spark, "ref_product")
    src = roles.products(spark, d)
    src = src.withColumns({c: F.col(c).cast("timestamp") for c in ("effective_date", "expiration_date")})
    loads.declared_refresh(src, schemas.PRODUCT_EXTRACT, path, LOAD_TS)
    return spark.read.parquet(path)


@register("refresh_drift")
def q_refresh_drift(spark, d):
    """A device extract with one column renamed and one retyped is refused: the drift, and the rows that
    the table has after it (those of the refresh before)."""
    path = scratch_path(spark, "ref_device")
    devices_ = roles.devices(spark, d)
    loads.declared_refresh(devices_, schemas.DEVICE_EXTRACT, path, LOAD_TS)
    changed = devices_.withColumnRenamed("model", "model_name").withColumn("tac", F.col("tac").cast("long"))
    try:
        loads.declared_refresh(changed.limit(1), schemas.DEVICE_EXTRACT, path, LOAD_TS)
        drift = []
    except quality.LayoutDrift as refused:
        drift = refused.drift
    kept = spark.read.parquet(path).count()
    return spark.createDataFrame([(*x, kept) for x in drift], "column_name string, problem string, declared string, found string, rows_kept long")


DELIVERIES_REQUIRED = 5


@register("file_gate")
def q_file_gate(spark, d):
    """Files landed per month against a minimum that some months miss. A month comes in three to
    six deliveries (a fixture rule on the month and the account), each one file."""
    u = roles.usage(spark, d).select("month_id", "msisdn", "imei", "imsi", F.pmod(
        "exbr_account_num", 3 + F.col("month_id") % 4).alias("delivery"))
    landing = scratch_path(spark, "usage_landing")
    (u.repartition("month_id", "delivery").write.partitionBy("month_id", "delivery").option("sep", "|")
     .option("header", True).option("compression", "gzip").csv(landing))
    listed = files.list_files(spark, landing, "*.csv.gz", recursive=True)
    per_month = listed.select(F.regexp_extract("path", r"month_id=(\d+)", 1).cast("long").alias("month_id")) \
                      .groupBy("month_id").agg(F.count(F.lit(1)).alias("files"))
    return quality.gate_frame(per_month, DELIVERIES_REQUIRED).select("month_id", "files", "minimum", "ok")


LOAD_MONTH = 200107
STAGED_MONTHLY = ["month_id"] + schemas.USAGE_COLUMNS


def _landed_rows(spark, d, columns, layout, by_month=False):
    """The usage rows in a landing layout, with padded numbers as the feeds have them."""
    u = roles.usage(spark, d, by_month)
    rows = u.select(*[F.col(c) if c in u.columns else F.lit(None).cast(layout[c].dataType).alias(c) for c in columns])
    return rows.withColumn("msisdn", F.concat(F.lit(" "), F.col("msisdn")))


def _manifest(rows: DataFrame, path: str, surplus: int = 0) -> None:
    """The sender's manifest: a header line and the number of rows it sent, counted at the source."""
    rows.agg(F.concat(F.lit("ROWS\n"), (F.count(F.lit(1)) + surplus).cast("string")).alias("value")).write.text(path)


def _land_month(spark, d, surplus: int = 0) -> str:
    """Landing folder of LOAD_MONTH: its files and its manifest."""
    landing = scratch_path(spark, "mth_landing")
    rows = _landed_rows(spark, d, STAGED_MONTHLY, schemas.MONTHLY_STAGING).filter(F.col("month_id") == LOAD_MONTH)
    writers.write_csv(rows, f"{landing}/{LOAD_MONTH}", STAGED_MONTHLY, sep="|", compression="gzip")
    _manifest(roles.usage(spark, d).filter(F.col("month_id") == LOAD_MONTH), f"{landing}/manifest", surplus)
    return landing


def _prior_table(spark, d) -> str:
    """The monthly table before the load: every month but LOAD_MONTH."""
    table = scratch_path(spark, "t_agg_mth")
    prior = _landed_rows(spark, d, STAGED_MONTHLY, schemas.MONTHLY_STAGING).filter(F.col("month_id") != LOAD_MONTH)
    first = {"path": "initial", "length": 0, "modified": LOAD_TS}
    ledger.publish(spark, loads.monthly_final_rows(prior, LOAD_TS), [first], table, LOAD_TS, partition_by=["month_date"],
                   columns=loads.MONTHLY_COLUMNS)
    return table


def _checked_load(spark, landing: str, table: str) -> loads.MonthlyLoadReport:
    return loads.monthly_load_with_checks(
        spark, landing_dir=landing, month=str(LOAD_MONTH), table_path=table, record_ts=LOAD_TS, min_files=0,
        manifest_glob="manifest/*.txt", data_glob=f"{LOAD_MONTH}/*.csv.gz")


@register("reconcile_load")
def q_reconcile_load(spark, d):
    """A load whose manifest is three rows too long is refused and changes nothing; the same load
    with the right manifest passes. One row for each, with counts taken before and after it."""
    table = _prior_table(spark, d)
    out = []
    for attempt, surplus in ((1, 3), (2, 0)):
        landing = _land_month(spark, d, surplus)
        before = ledger.read_loaded(spark, table).count()
        expected = files.manifest_counts(spark, f"{landing}/manifest/*.txt").select("expected_rows").head()[0]
        try:
            _checked_load(spark, landing, table)
            ok = True
        except quality.GateError:
            ok = False
        after = ledger.read_loaded(spark, table).count()
        out.append((attempt, before, after, after - before, expected, ok))
    return spark.createDataFrame(out, "attempt long, rows_before long, rows_after long, rows_loaded long, rows_expected long, ok boolean")


@register("monthly_load_checked")
def q_monthly_load_checked(spark, d):
    """Gate, staging, reconciliation and publishing of a month, run twice: the table has each row once."""
    table = _prior_table(spark, d)
    landing = _land_month(spark, d)
    for _ in range(2):
        _checked_load(spark, landing, table)
    return ledger.read_loaded(spark, table).select("month_id", *MONTHLY_OUT[2:])


MONTHLY_OUT = ["month_date", "month_id", "msisdn", "imei", "imsi", "first_cell_data_id",
               "home_mo_count", "work_mo_count", "home_data_in_volume_kb", "record_ts"]


@register("monthly_close")
def q_monthly_close(spark, d):
    """The month-end sequence, run three times: with a manifest that refuses the load, with the right one,
    and once more, when the journal skips every step. Per step: how often it was finished, and the rows
    that it stored."""
    path = scratch_path(spark, "close")
    t = close.CloseTables(**{name: f"{path}/{name}" for name in close.CloseTables.__dataclass_fields__})
    for name, rows in (("daily_base", roles.daily_base), ("legacy_base", roles.legacy_base), ("devices", roles.devices),
                       ("products", roles.products), ("products2", roles.products2), ("cells", roles.cells)):
        writers.refresh(rows(spark, d), getattr(t, name))
    for surplus in (3, 0, 0):
        t.landing = _land_month(spark, d, surplus)
        try:
            close.monthly_close(spark, t, ORDERS_AS_OF, LOAD_TS, min_files=0, data_glob=f"{LOAD_MONTH}/*.csv.gz",
                                manifest_glob="manifest/*.txt", journal=f"{path}/journal")
        except quality.GateError:
            continue
    stored = {"load": ledger.read_loaded(spark, t.usage), "base": spark.read.parquet(t.base), "history": spark.read.parquet(t.device_history)}
    rows = spark.createDataFrame([(step, df.count()) for step, df in stored.items()], "step string, rows long")
    runs = spark.read.parquet(f"{path}/journal").groupBy("step").agg(F.count(F.lit(1)).alias("finished"))
    return runs.join(rows, "step", "left")


@register("monthly_usage_load")
def q_monthly_usage_load(spark, d):
    """All months landed as pipe-delimited files and loaded."""
    landing = scratch_path(spark, "mth_landing")
    writers.write_csv(_landed_rows(spark, d, STAGED_MONTHLY, schemas.MONTHLY_STAGING), landing, STAGED_MONTHLY, sep="|", compression="gzip")
    table = scratch_path(spark, "t_agg_mth")
    loads.load_monthly(spark, landing, table, LOAD_TS)
    return ledger.read_loaded(spark, table).select(*MONTHLY_OUT)


@register("monthly_export_load")
def q_monthly_export_load(spark, d):
    """The comma-delimited monthly export, all months, loaded into the temp table."""
    landing = scratch_path(spark, "export_landing")
    writers.write_csv(_landed_rows(spark, d, STAGED_MONTHLY, schemas.MONTHLY_STAGING), landing, STAGED_MONTHLY, sep=",", compression="gzip")
    table = scratch_path(spark, "t_agg_mth_temp")
    loads.load_monthly_export(spark, landing, table, LOAD_TS)
    return ledger.read_loaded(spark, table).select(*MONTHLY_OUT)


DAILY_OUT = ["call_date", "date_of_call", "msisdn", "imei", "imsi", "first_cell_data_id", "exbr_account_num",
             "home_mo_count", "work_mo_count", "home_mo_duration_secs", "home_data_out_volume_kb", "record_ts"]


@register("daily_usage_load")
def q_daily_usage_load(spark, d):
    """All days landed and loaded."""
    columns = ["date_of_call"] + schemas.USAGE_COLUMNS
    landing = scratch_path(spark, "dly_landing")
    writers.write_csv(_landed_rows(spark, d, columns, schemas.DAILY_STAGING), landing, columns, sep="|", compression="gzip")
    table = scratch_path(spark, "t_agg_dly")
    loads.load_daily(spark, landing, table, LOAD_TS)
    return ledger.read_loaded(spark, table).select(*DAILY_OUT)


# A fixture rule: the rows of these accounts come in a later delivery, and some numbers are blank.
LATE_ACCOUNTS = 40


def _delivered_rows(spark, d, columns, layout):
    """The landed rows, and whether a row comes late."""
    rows = _landed_rows(spark, d, columns, layout)
    rows = rows.withColumn("msisdn", F.when(F.col("work_mo_count") != 3, F.col("msisdn")))
    return rows, F.col("exbr_account_num") % LATE_ACCOUNTS == 0


def _deliveries(spark, d, columns, layout):
    rows, late = _delivered_rows(spark, d, columns, layout)
    return rows.filter(~late), rows.filter(late)


def _send(spark, d, columns, layout) -> list[str]:
    """Folders with the files of both deliveries: one pass over the usage writes them, before any has arrived."""
    sent = scratch_path(spark, "sent")
    rows, late = _delivered_rows(spark, d, columns, layout)
    rows = rows.filter(late.isNotNull()).withColumn("delivery", late.cast("int"))
    writers.write_csv(rows, sent, columns, sep="|", compression="gzip", partition_by=["delivery"])
    return [f"{sent}/delivery={k}" for k in range(2)]


def _land(spark, sent: str, landing: str) -> None:
    """The files of a delivery, if it has any, arrive in the landing folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(sent)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(landing))
    if fs.exists(place):
        files = ledger.landed_files(spark, sent, "*.gz").select("path").collect()
        ledger.move_files(spark, [f["path"] for f in files], sent, landing)


@register("daily_load_twice")
def q_daily_load_twice(spark, d):
    """All days are loaded, then late files of the same days, then the same landing again, which adds
    nothing. The query returns the committed table."""
    columns = ["date_of_call"] + schemas.USAGE_COLUMNS
    landing, table = scratch_path(spark, "dly_landing"), scratch_path(spark, "t_agg_dly")
    for k, rows in enumerate(_deliveries(spark, d, columns, schemas.DAILY_STAGING)):
        writers.write_csv(rows, f"{landing}/{k}", columns, sep="|", compression="gzip")
        loads.load_daily(spark, landing, table, LOAD_TS)
    loads.load_daily(spark, landing, table, LOAD_TS)
    return ledger.read_loaded(spark, table).select(*DAILY_OUT)


@register("load_audit")
def q_load_audit(spark, d):
    """The audit of two monthly loads: rows before, loaded and after, rows without a number, and the sum of a
    counter, all counted while the load was written."""
    landing, table = scratch_path(spark, "mth_landing"), scratch_path(spark, "t_agg_mth")
    for k, rows in enumerate(_deliveries(spark, d, STAGED_MONTHLY, schemas.MONTHLY_STAGING)):
        writers.write_csv(rows, f"{landing}/{k}", STAGED_MONTHLY, sep="|", compression="gzip")
        loads.load_monthly(spark, landing, table, LOAD_TS)
    return ledger.loads_of(spark, table).select(
        "load_number", "rows_before", "rows_loaded", (F.col("rows_before") + F.col("rows_loaded")).alias("rows_after"),
        "null_keys", F.col("measure").alias("home_mo_count"), "record_ts")


@register("landing_archive")
def q_landing_archive(spark, d):
    """One file a month lands; the months up to LOAD_MONTH are loaded and moved to the archive, the others
    wait. Per month: where its file is, and its rows in the table."""
    landing, table, archive = (scratch_path(spark, n) for n in ("mth_landing", "t_agg_mth", "mth_archive"))
    # A task has all rows of its months, so a month is one file; a state is a function of the month.
    rows = _landed_rows(spark, d, STAGED_MONTHLY, schemas.MONTHLY_STAGING, by_month=True)
    rows = rows.withColumn("state", F.when(F.col("month_id") <= LOAD_MONTH, "due").otherwise("later")).withColumn("month", F.col("month_id"))
    (rows.write.partitionBy("state", "month").option("sep", "|").option("header", True)
     .option("compression", "gzip").option(*writers.FAST_GZIP).csv(landing))
    loads.load_monthly(spark, f"{landing}/state=due", table, LOAD_TS, archive=f"{archive}/state=due")
    found = None
    for place, folder in (("archive", archive), ("landing", landing)):
        listed = files.list_files(spark, folder, "*.csv.gz", recursive=True).select(
            F.regexp_extract("path", r"month=(\d+)", 1).cast("long").alias("month_id"), F.lit(place).alias("place"))
        found = listed if found is None else found.unionByName(listed)
    loaded = ledger.read_loaded(spark, table).groupBy("month_id").agg(F.count(F.lit(1)).alias("rows_loaded"))
    return found.join(loaded, "month_id", "left").select("month_id", "place", F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"))


BACKFILL_DAILY_SINCE, BACKFILL_FROM_MONTH = dt.date(2000, 7, 12), 200001


@register("backfill_stored")
def q_backfill_stored(spark, d):
    """The key backfill on the stored daily and monthly tables: one rewrite of the partitions that it
    touches, both tables together. The query reads both back."""
    u = _padded_usage(spark, d)
    tables = Snapshots(spark, scratch_path(spark, "usage_tables"))
    tables.rewrite({
        "daily": (u.select("call_date", "imei", "imsi", "msisdn", "record_ts"), ["call_date"]),
        "monthly": (u.select("month_date", "month_id", "imei", "imsi", "msisdn"), ["month_date"])})
    loads.backfill_keys(tables, BACKFILL_DAILY_SINCE, BACKFILL_FROM_MONTH)
    out = [tables.read(name).select(F.lit(name).alias("table_name"), F.col(day).alias("period"), "imei", "imsi", "msisdn")
           for name, day in (("daily", "call_date"), ("monthly", "month_date"))]
    return out[0].unionByName(out[1])


@register("period_cursor")
def q_period_cursor(spark, d):
    latest = roles.usage(spark, d).agg(F.max("month_id").alias("m"))
    control = latest.select(F.explode(F.array(
        F.struct(F.lit("latest_mthly_file_mon").alias("property_name"), F.col("m").cast("string").alias("property_value")),
        F.struct(F.lit("next_mthly_file_mon").alias("property_name"),
                 month_key_str(F.add_months(month_start("m"), 1)).alias("property_value")))).alias("p")).select("p.*")
    path = scratch_path(spark, "control")
    writers.refresh(control, path)
    due = files.control_value(spark.read.parquet(path), "next_mthly_file_mon")
    return spark.createDataFrame([(due, quality.next_period(due))], "next_month string, following_month string")


@register("staging_copy")
def q_staging_copy(spark, d):
    staging = scratch_path(spark, "cell_staging")
    writers.refresh(roles.cells(spark, d), staging)
    cols = ["cell_data_id", "technology", "cell", "global_cell_id", "site_id"]
    return loads.staging_copy(spark, spark.read.parquet(staging), cols, scratch_path(spark, "cell_temp"))


# ---- text flows ---------------------------------------------------------------------------

RATING_HEADERS = ["event_id", "user_id", "value", "event_type"]


@register("ratings_filter")
def q_ratings_filter(spark, d):
    ev = roles.table(spark, d, "events").select(*RATING_HEADERS)
    path = scratch_path(spark, "ratings")
    writers.write_csv(ev, path, RATING_HEADERS, sep=",")
    kept = text_flows.ratings_above(spark, f"{path}/*.csv", RATING_HEADERS, rating_field=2, threshold=4.0)
    out = scratch_path(spark, "ratings_out")
    writers.write_text(kept, out, ["event_id", "user_id", "value"])
    fields = F.split("value", ",")
    return spark.read.text(out).select(fields[0].cast("long").alias("event_id"), fields[1].cast("long").alias("user_id"),
                                       fields[2].cast("double").alias("rating"))


@register("word_extract")
def q_word_extract(spark, d):
    return text_flows.word_counts(roles.table(spark, d, "documents"))


@register("view_scan")
def q_view_scan(spark, d):
    """The recent-device mart read as a view by SQL."""
    views.register_views(spark, {
        "base": roles.base(spark, d), "products": roles.products(spark, d), "products2": roles.products2(spark, d),
        "usage": roles.usage(spark, d), "cells": roles.cells(spark, d), "devices": roles.devices(spark, d)}, ORDERS_AS_OF)
    return spark.sql("SELECT device_type, count(*) AS subscribers, max(last_date) AS last_date FROM recent_device GROUP BY device_type")


# ---- network marts ------------------------------------------------------------------------

@register("site_usage")
def q_site_usage(spark, d):
    return network.site_usage(roles.usage(spark, d), roles.cells(spark, d))


@register("site_usage_clustered")
def q_site_usage_clustered(spark, d):
    """The site mart stored by month in buckets of its site, then read and joined to the sites by bucket."""
    cells = roles.cells(spark, d)
    sites = cells.groupBy("site_id").agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"))
    path = scratch_path(spark, "site_usage")
    stored = network.store_site_usage(network.site_usage(roles.usage(spark, d), cells), sites, "site_usage_" + path[-12:], path)
    return network.monthly_site_totals(*stored).select(
        "month_date", "site_id", F.col("latitude").cast("double"), F.col("longitude").cast("double"), "mart_rows", "calls_4g")


@register("site_usage_incremental")
def q_site_usage_incremental(spark, d):
    """Daily usage is loaded in two deliveries into a table stored by month; after each the stored site mart
    takes the new load."""
    columns = ["date_of_call"] + schemas.USAGE_COLUMNS
    landing, table = scratch_path(spark, "dly_landing"), scratch_path(spark, "t_agg_dly")
    tables, mart = Snapshots(spark, scratch_path(spark, "marts")), network.site_mart(roles.cells(spark, d), F.col("month_date"))

    def rows_of(paths):
        rows = loads.daily_final_rows(loads.staged_daily(spark, paths), LOAD_TS)
        return rows.withColumn("month_date", F.trunc("call_date", "MM"))

    for k, sent in enumerate(_send(spark, d, columns, schemas.DAILY_STAGING)):
        _land(spark, sent, f"{landing}/{k}")
        ledger.load_new(spark, landing, "*.gz", table, LOAD_TS, rows_of, partition_by=["month_date"])
        mart.refresh(tables, table)
    return mart.read(tables)


@register("protocol_site_usage_incremental")
def q_protocol_site_usage_incremental(spark, d):
    """Monthly usage is loaded in two deliveries; after each the stored protocol mart takes the new load."""
    landing, table = scratch_path(spark, "mth_landing"), scratch_path(spark, "t_agg_mth")
    tables = Snapshots(spark, scratch_path(spark, "marts"))
    mart = network.protocol_mart(roles.cells(spark, d), roles.devices(spark, d), roles.subscribers(spark, d))
    for k, sent in enumerate(_send(spark, d, STAGED_MONTHLY, schemas.MONTHLY_STAGING)):
        _land(spark, sent, f"{landing}/{k}")
        loads.load_monthly(spark, landing, table, LOAD_TS)
        mart.refresh(tables, table)
    return mart.read(tables)


@register("usage_mart_incremental")
def q_usage_mart_incremental(spark, d):
    """Monthly usage is loaded in two deliveries; after each the stored published mart takes the new load. Months
    of the base that have no usage are derived once."""
    landing, table = scratch_path(spark, "mth_landing"), scratch_path(spark, "t_agg_mth")
    tables, base, done = Snapshots(spark, scratch_path(spark, "marts")), roles.base(spark, d), set()
    mart = usage.published_mart(base, roles.products(spark, d), roles.products2(spark, d), roles.cells(spark, d), ORDERS_AS_OF)
    for k, sent in enumerate(_send(spark, d, STAGED_MONTHLY, schemas.MONTHLY_STAGING)):
        _land(spark, sent, f"{landing}/{k}")
        loads.load_monthly(spark, landing, table, LOAD_TS)
        done.update(mart.refresh(tables, table))
    # One row a month comes to the driver.
    months = {r["m"] for r in base.select(month_start("agg_mth").alias("m")).distinct().collect()}
    if months - done:
        mart.derive_again(tables, sorted(months - done, key=str))
    return mart.read(tables)


@register("protocol_site_usage")
def q_protocol_site_usage(spark, d):
    return network.protocol_site_usage(roles.usage(spark, d), roles.cells(spark, d), roles.devices(spark, d),
                                       roles.subscribers(spark, d))


# ---- streaming ----------------------------------------------------------------------------

LANDING_SCHEMA = "event_id long, ts_text string, user_id long, event_type string, value double"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@register("landing_stream")
def q_landing_stream(spark, d):
    ev = roles.table(spark, d, "events").select("event_id", F.date_format("ts", TS_FORMAT).alias("ts_text"),
                                                "user_id", "event_type", "value")
    landing = scratch_path(spark, "events_landing")
    # Quoted text that holds the separator and a quote.
    ev = ev.withColumn("event_type", F.concat(F.lit('"'), F.col("event_type"), F.lit('" | n')))
    writers.write_csv(ev, landing, ev.columns, sep="|")
    target = scratch_path(spark, "events_final")

    def transform(rows):
        ts = F.to_timestamp_ntz(F.col("ts_text"), F.lit(TS_FORMAT))
        return rows.select("event_id", ts.alias("ts"), "user_id", F.split_part("event_type", F.lit('"'), F.lit(2)).alias("event_type"), "value",
                           F.to_date(ts).alias("event_date"))

    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(LANDING_SCHEMA)
    q = landing_stream(spark, landing, schema, target, scratch_path(spark, "events_ckpt"),
                       scratch_path(spark, "events_archive"), transform=transform)
    run_once(q)
    return spark.read.parquet(target)
