"""Monthly close: the month-end sequence as one driver function.

    file gate -> manifest -> monthly usage load -> reconciliation
    -> subscriber base of the month -> best-device history -> published usage mart
    -> rolling activity flag

Scheduling, retries between runs and cross-run triggers belong to an external scheduler and
are not built. Every step boundary is a written table, so each step reads its inputs from
storage (lineage is cut there; a failed step is re-run alone) and a lost executor only
re-runs tasks of the step in flight. The flag update stages last month's rows and replaces that
partition of the published mart; a close that runs again replaces what it wrote.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellmart.plans import devices, ledger, loads, subscribers, usage
from cellmart.sinks import writers
from cellmart.sources.files import manifest_counts


@dataclass
class CloseTables:
    landing: str           # folder of the month's landed usage files and manifest
    usage: str             # monthly usage table, partitioned by month_date
    daily_base: str        # daily billing snapshot (input)
    legacy_base: str       # legacy monthly base (input)
    base: str              # subscriber base, partitioned by agg_mth
    devices: str           # device catalogue
    products: str          # first tariff catalogue
    products2: str         # second tariff catalogue
    cells: str             # cell dimension
    device_history: str    # best-device history (appended)
    mart: str              # published usage mart with the rolling activity flag, partitioned by AGG_MTH


def month_of(as_of: dt.date) -> str:
    first = (as_of.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    return f"{first.year:04d}{first.month:02d}"


class Journal:
    """Finished steps of one run, a small table in the shared folder. A rerun skips them and repeats
    the step that broke; a step is entered after its tables are written, so a step that broke between
    the two is repeated (every step writes over its own remains)."""

    SCHEMA = "run string, step string, finished timestamp"

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.path, self.run = spark, path, run
        try:
            rows = spark.read.schema(self.SCHEMA).parquet(path).filter(F.col("run") == run)
            self.done = {r["step"] for r in rows.collect()}
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            self.done = set()

    def step(self, name: str, work: Callable[[], None]) -> None:
        if name in self.done:
            return
        work()
        row = self.spark.createDataFrame([(self.run, name, dt.datetime.now())], self.SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)
        self.done.add(name)


STEPS = ("load", "base", "history", "mart")


def monthly_close(spark: SparkSession, t: CloseTables, as_of: dt.date, record_ts, *, min_files: int = 102,
                  data_glob: str = "*.dat.gz", manifest_glob: str = "*HASH*", journal: str | None = None) -> dict:
    """Run the month-end steps. With ``journal`` (a folder), steps that an earlier run of the same month
    finished are skipped."""
    month = month_of(as_of)
    finished = Journal(spark, journal, month) if journal else None

    def load():
        loads.monthly_load_with_checks(
            spark, landing_dir=t.landing, month=month, table_path=t.usage, record_ts=record_ts,
            min_files=min_files, manifest_glob=manifest_glob, data_glob=data_glob)

    def base():
        rows = subscribers.subscriber_base(spark.read.parquet(t.daily_base), spark.read.parquet(t.legacy_base), as_of)
        writers.replace_partitions(rows.withColumn("record_ts", F.lit(record_ts)), t.base, ["agg_mth"])

    def history():
        # The month's history replaces itself when the close runs again.
        rows = devices.best_device_history(ledger.read_loaded(spark, t.usage), spark.read.parquet(t.devices), as_of, record_ts)
        writers.replace_partitions(rows, t.device_history, ["MONTH_ID"])

    def mart():
        rows = usage.publish(usage.usage_mart(
            spark.read.parquet(t.base), spark.read.parquet(t.products), spark.read.parquet(t.products2),
            ledger.read_loaded(spark, t.usage), spark.read.parquet(t.cells), as_of))
        usage.publish_and_flag(rows, t.mart, as_of)

    for name, work in zip(STEPS, (load, base, history, mart)):
        if finished:
            finished.step(name, work)
        else:
            work()
    loaded = ledger.read_loaded(spark, t.usage).filter(F.col("month_id") == int(month)).count()
    expected = int(manifest_counts(spark, f"{t.landing}/{manifest_glob}").agg(F.sum("expected_rows")).head()[0] or 0)
    return {"month": month, "rows_loaded": loaded, "rows_expected": expected,
            "base_rows": spark.read.parquet(t.base).filter(F.col("agg_mth") == month).count(),
            "mart_rows": spark.read.parquet(t.mart).count(), "period_start": dt.date(int(month[:4]), int(month[4:]), 1)}
