"""Loads: landing files -> staging -> final tables, reference refreshes, the cell dimension
upsert, key backfills, staging copies and the monthly close sequence.

Each load is a scan with a declared schema, column expressions, and one write. Usage loads append:
a ledger (``plans/ledger``) says which landed files are in the table, so a later file of a loaded day
or month adds its rows and none is taken twice. Tables are parquet folders partitioned by their date column
(``call_date`` / ``month_date``) and load; a period read lists and scans only its partition folders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellmart import schemas
from cellmart.functions.calendar import date_from_day_key, month_start, month_start_datetime, month_start_of_long
from cellmart.functions.text import trim_ws
from cellmart.operators import quality
from cellmart.operators.changes import conditional_update, stamp_missing, upsert
from cellmart.plans import ledger
from cellmart.session import scratch_path
from cellmart.sinks import writers
from cellmart.sinks.keyed import KeyedTable, MergeReport
from cellmart.sinks.snapshots import Snapshots
from cellmart.sources.delimited import read_delimited
from cellmart.sources.files import count_files, manifest_counts

DAILY_COLUMNS = ["call_date", "date_of_call"] + schemas.USAGE_COLUMNS + ["record_ts"]
MONTHLY_COLUMNS = ["month_date", "month_id"] + schemas.USAGE_COLUMNS + ["record_ts"]
# Clustering keys of the monthly usage table (the month is the partition folder).
MONTHLY_CLUSTER = ["msisdn", "imei", "imsi"]


def staged_daily(spark: SparkSession, paths: str | Sequence[str], sep: str = "|") -> DataFrame:
    """Daily staging scan: declared 60-column layout, header skipped, FAILFAST."""
    return read_delimited(spark, paths, schemas.DAILY_STAGING, sep=sep)


def staged_monthly(spark: SparkSession, paths: str | Sequence[str], sep: str = "|") -> DataFrame:
    return read_delimited(spark, paths, schemas.MONTHLY_STAGING, sep=sep)


def daily_final_rows(staging: DataFrame, record_ts) -> DataFrame:
    """Staging -> final: call date parsed from ``YYYYMMDD``, number trimmed, load stamp."""
    out = staging.select(date_from_day_key("date_of_call").alias("call_date"), "date_of_call",
                         *[trim_ws(c).alias(c) if c == "msisdn" else F.col(c) for c in schemas.USAGE_COLUMNS],
                         F.lit(None).cast("timestamp").alias("record_ts"))
    return stamp_missing(out, "record_ts", record_ts)


def monthly_final_rows(staging: DataFrame, record_ts) -> DataFrame:
    out = staging.select(month_start_of_long("month_id", month_start("month_id")).alias("month_date"), "month_id",
                         *[trim_ws(c).alias(c) if c == "msisdn" else F.col(c) for c in schemas.USAGE_COLUMNS],
                         F.lit(None).cast("timestamp").alias("record_ts"))
    return stamp_missing(out, "record_ts", record_ts)


def export_final_rows(staging: DataFrame, record_ts) -> DataFrame:
    """Monthly export -> temp table: the month parsed as a datetime and narrowed to its date,
    number trimmed, load stamp."""
    parsed = month_start_datetime("month_id").cast("date")
    out = staging.select(month_start_of_long("month_id", parsed).alias("month_date"), "month_id",
                         *[trim_ws(c).alias(c) if c == "msisdn" else F.col(c) for c in schemas.USAGE_COLUMNS],
                         F.lit(None).cast("timestamp").alias("record_ts"))
    return stamp_missing(out, "record_ts", record_ts)


def load_monthly_export(spark: SparkSession, landing: str, table_path: str, record_ts, glob: str = "*.gz") -> ledger.LoadReport:
    """New files of the comma-delimited monthly export appended to the temp table."""
    return ledger.load_new(
        spark, landing, glob, table_path, record_ts,
        lambda paths: export_final_rows(staged_monthly(spark, paths, sep=","), record_ts),
        partition_by=["month_date"], columns=MONTHLY_COLUMNS, cluster_by=MONTHLY_CLUSTER, measure="home_mo_count")


def load_daily(spark: SparkSession, landing: str, table_path: str, record_ts, sep: str = "|", glob: str = "*.gz",
               archive: str | None = None) -> ledger.LoadReport:
    """Daily usage load: the rows of files that landed since the last load are appended to their days;
    loaded files are moved to ``archive`` after the commit."""
    report = ledger.load_new(
        spark, landing, glob, table_path, record_ts,
        lambda paths: daily_final_rows(staged_daily(spark, paths, sep), record_ts),
        partition_by=["call_date"], columns=DAILY_COLUMNS, measure="home_mo_count")
    if archive:
        ledger.archive_loaded(spark, landing, glob, table_path, archive)
    return report


def load_monthly(spark: SparkSession, landing: str, table_path: str, record_ts, sep: str = "|", glob: str = "*.gz",
                 archive: str | None = None) -> ledger.LoadReport:
    """Monthly usage load: as ``load_daily``, by month."""
    report = ledger.load_new(
        spark, landing, glob, table_path, record_ts,
        lambda paths: monthly_final_rows(staged_monthly(spark, paths, sep), record_ts),
        partition_by=["month_date"], columns=MONTHLY_COLUMNS, cluster_by=MONTHLY_CLUSTER, measure="home_mo_count")
    if archive:
        ledger.archive_loaded(spark, landing, glob, table_path, archive)
    return report


@dataclass
class MonthlyLoadReport:
    month: str
    files: int
    rows_before: int       # rows of the other months, before the load
    rows_loaded: int       # rows of the month: loaded before and by this load
    rows_expected: int     # what the manifests say
    rows_after: int        # rows of the table, after the load

    @property
    def ok(self) -> bool:
        return self.rows_loaded == self.rows_expected and self.rows_after == self.rows_before + self.rows_loaded


def monthly_load_with_checks(spark: SparkSession, *, landing_dir: str, month: str, table_path: str,
                             record_ts, min_files: int, manifest_glob: str, data_glob: str,
                             name_glob: str = "*") -> MonthlyLoadReport:
    """File gate -> staging -> reconciliation with the manifest -> publish, for one month.

    The month's new files are parsed into a staging folder. Only when the month's rows, with those loaded
    before, are the manifest's number and all of the month are they appended, so a failed check leaves
    the table as it was and a repeated load adds nothing. ``name_glob`` and the month in a file's name say
    which files the gate counts."""
    files = quality.require_files(count_files(spark, landing_dir, name_glob, recursive=True, contains=month), min_files)
    expected = int(manifest_counts(spark, f"{landing_dir}/{manifest_glob}").agg(F.sum("expected_rows")).head()[0] or 0)
    here, _, glob = data_glob.rpartition("/")
    new = ledger.new_files(spark, f"{landing_dir}/{here}".rstrip("/"), glob, table_path).collect()
    earlier, others = _loaded(spark, table_path, int(month))
    loaded = 0
    if new:
        staging = scratch_path(spark, f"staged-{month}")
        rows, seen = quality.observed_count(monthly_final_rows(staged_monthly(spark, [f["path"] for f in new]), record_ts))
        writers.append(rows, staging, MONTHLY_COLUMNS)
        loaded = int(seen.get["rows"])
    if earlier + loaded != expected:
        raise quality.GateError(f"{earlier + loaded} rows landed for {month}, the manifest says {expected}; nothing was published")
    if new:
        staged = spark.read.parquet(staging)
        if wrong := staged.filter(~F.col("month_id").eqNullSafe(int(month))).count():
            raise quality.GateError(f"{wrong} landed rows are not of month {month}; nothing was published")
        ledger.publish(spark, staged, new, table_path, record_ts, partition_by=["month_date"], columns=MONTHLY_COLUMNS,
                       cluster_by=MONTHLY_CLUSTER, measure="home_mo_count")
    report = MonthlyLoadReport(month, files, others, earlier + loaded, expected, sum(_loaded(spark, table_path, int(month))))
    if not report.ok:
        raise quality.GateError(f"the table has {report.rows_after} rows, {others} + {earlier} + {loaded} were to be there")
    return report


def _loaded(spark: SparkSession, path: str, month: int) -> tuple[int, int]:
    """Committed rows of the month and of all others; none before the first load."""
    if ledger.ledger(spark, path).isEmpty():
        return 0, 0
    own = F.count(F.when(F.col("month_id") == month, 1)).alias("own")
    own, rows = ledger.read_loaded(spark, path).agg(own, F.count(F.lit(1)).alias("rows")).head()
    return own, rows - own


def reference_refresh(source: DataFrame, table_path: str, record_ts, *, keep: Column | None = None,
                      date_cols=()) -> None:
    """Full refresh of a reference extract: optional row filter, datetime -> date narrowing,
    stamp, overwrite."""
    df = source.filter(keep) if keep is not None else source
    for c in date_cols:
        df = df.withColumn(c, F.col(c).cast("date"))
    if "record_ts" not in df.columns:
        df = df.withColumn("record_ts", F.lit(None).cast("timestamp"))
    writers.refresh(stamp_missing(df, "record_ts", record_ts), table_path)


def declared_refresh(source: DataFrame, declared: StructType, table_path: str, record_ts, *, keep: Column | None = None) -> None:
    """Full refresh of an extract with a declared layout. Missing, added or retyped columns refuse it
    before anything is written; columns are taken by name, datetimes narrowed to declared dates."""
    if drift := quality.layout_drift(source.schema, declared):
        raise quality.LayoutDrift(drift)
    dates = [f.name for f in declared if f.dataType.simpleString() == "date"]
    reference_refresh((source if keep is None else source.filter(keep)).select(*declared.fieldNames()), table_path, record_ts, date_cols=dates)


def cell_upsert(spark: SparkSession, dim: DataFrame, landing_glob: str, staging_path: str, stamp, sep: str = "|") -> DataFrame:
    """Cell dimension upsert (keyed on ``cell_data_id``): the landed feed in its 74-column layout replaces
    the staging table, which is then merged into the dimension."""
    writers.refresh(read_delimited(spark, landing_glob, schemas.CELL_FEED, sep=sep), staging_path)
    staging = spark.read.schema(schemas.CELL_FEED).parquet(staging_path)
    return upsert(dim, staging, ["cell_data_id"], stamp_col="record_ts", stamp=stamp)


def load_cells(spark: SparkSession, dim: KeyedTable, landing: str, staging_path: str, stamp, sep: str = "|", glob: str = "*.gz",
               archive: str | None = None) -> MergeReport:
    """Cell dimension load: the feed files that landed since the last load replace the staging table and are
    merged into the buckets that they touch; files are committed to the dimension's ledger after the merge
    and then moved to ``archive``. A run that broke between merge and commit merges the same rows again,
    which changes nothing."""
    report = MergeReport(0, 0, 0)
    if files := ledger.new_files(spark, landing, glob, dim.path).collect():
        writers.refresh(read_delimited(spark, [f["path"] for f in files], schemas.CELL_FEED, sep=sep), staging_path)
        staging = spark.read.schema(schemas.CELL_FEED).parquet(staging_path)
        earlier = ledger.loads_of(spark, dim.path).agg(F.max("load_number").alias("n"), F.sum("rows_loaded").alias("rows")).head()
        report = dim.merge(staging, stamp_col="record_ts", stamp=stamp)
        m = staging.agg(F.count(F.lit(1)), F.count(F.when(F.col("cell_data_id").isNull(), 1)), F.approx_count_distinct("cell_data_id")).head()
        ledger.commit(spark, dim.path, files, ((earlier["n"] or 0) + 1, earlier["rows"] or 0, m[0], m[1], None, m[2], stamp))
    if archive:
        ledger.archive_loaded(spark, landing, glob, dim.path, archive)
    return report


def key_backfill_daily(df: DataFrame, since: dt.date) -> DataFrame:
    """Trim the number on daily rows loaded after ``since``."""
    return conditional_update(df, F.to_date("record_ts") > F.lit(since), {"msisdn": trim_ws("msisdn")})


def key_backfill_monthly(df: DataFrame, from_month: int) -> DataFrame:
    """Trim the number on monthly rows from month ``from_month`` on."""
    return conditional_update(df, F.col("month_id") >= F.lit(from_month), {"msisdn": trim_ws("msisdn")})


def backfill_keys(tables: Snapshots, since: dt.date, from_month: int) -> int:
    """The key backfill on the stored tables, daily then monthly, as one rewrite: both change or neither.
    Only partitions that hold a row under the condition are written again."""
    daily, monthly = tables.read("daily"), tables.read("monthly")
    days = daily.filter(F.to_date("record_ts") > F.lit(since)).select("call_date").distinct()
    months = monthly.filter(F.col("month_id") >= F.lit(from_month)).select("month_date").distinct()
    return tables.rewrite({
        "daily": (key_backfill_daily(daily.join(days, "call_date", "left_semi"), since), ["call_date"]),
        "monthly": (key_backfill_monthly(monthly.join(months, "month_date", "left_semi"), from_month), ["month_date"])})


def staging_copy(spark: SparkSession, staging: DataFrame, columns, target_path: str) -> DataFrame:
    """Explicit projection of a staging table appended to a temp table (created if absent)."""
    writers.append(staging.select(*columns), target_path)
    return spark.read.parquet(target_path)
