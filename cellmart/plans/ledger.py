"""Append loads that take every landed file once.

A load writes its rows into partitions of their own, ``<table>/<date>=.../load_id=...``, and then commits
by one row per file in the ledger beside the table (``<table>__ledger``): path, length and time of the
file, and what the load counted. Readers see committed loads only. The load id comes from the
files, so a load that broke before its commit writes over its own remains when it runs again, a file
that was loaded is never taken twice, and a later file of a loaded day adds its rows to that day.

File lists and ledgers are metadata: they grow with the number of files, not with their rows. One load of
a table runs at a time.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cellmart.operators.quality import GateError
from cellmart.session import FREE_SHUFFLES, sql_conf
from cellmart.sinks import writers
from cellmart.sources.files import list_files

LEDGER_SCHEMA = ("load_id string, path string, length long, modified timestamp, load_number long, rows_before long, "
                 "rows_loaded long, null_keys long, measure long, keys long, record_ts timestamp")
FILE = ["path", "length", "modified"]


@dataclass
class LoadReport:
    files: int             # files taken by this load
    rows_before: int       # committed rows before it
    rows_loaded: int
    null_keys: int

    @property
    def rows_after(self) -> int:
        return self.rows_before + self.rows_loaded


def ledger_path(table: str) -> str:
    return table.rstrip("/") + "__ledger"


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """One row per loaded file; none when the table has no load yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(ledger_path(table))
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path(table))


def loads_of(spark: SparkSession, table: str) -> DataFrame:
    """The audit: one row per load, in order."""
    return ledger(spark, table).groupBy("load_number", "load_id", "rows_before", "rows_loaded", "null_keys", "measure", "keys", "record_ts") \
        .agg(F.count(F.lit(1)).alias("files"))


def read_loaded(spark: SparkSession, table: str) -> DataFrame:
    """The rows of committed loads. The load ids are literals, so other loads' folders are pruned."""
    ids = [r["load_id"] for r in ledger(spark, table).select("load_id").distinct().collect()]
    rows = spark.read.parquet(table)
    return rows.filter(F.col("load_id").isin(ids)).drop("load_id")


def landed_files(spark: SparkSession, landing: str, glob: str = "*") -> DataFrame:
    """Path, length and time of the landed files below a folder."""
    found = list_files(spark, landing, glob, recursive=True, columns=("path", "length", "modificationTime"))
    return found.withColumnRenamed("modificationTime", "modified")


def new_files(spark: SparkSession, landing: str, glob: str, table: str) -> DataFrame:
    """Landed files that no committed load has taken."""
    return landed_files(spark, landing, glob).join(ledger(spark, table), FILE, "left_anti")


def load_id_of(files: Sequence) -> str:
    lines = sorted(f"{f['path']}|{f['length']}|{f['modified']}" for f in files)
    return "L" + hashlib.sha256("\n".join(lines).encode()).hexdigest()[:20]


def publish(spark: SparkSession, rows: DataFrame, files: Sequence, table: str, record_ts, *, partition_by: Sequence[str],
            columns: Sequence[str] | None = None, cluster_by: Sequence[str] = (), key: str = "msisdn",
            measure: str | None = None, check: Callable[[LoadReport], None] | None = None) -> LoadReport:
    """Write ``rows`` as the load of ``files`` and commit it. The load's metrics are observed during the
    write; ``check`` may refuse it before the commit (by raising), then no reader sees its rows."""
    load_id = load_id_of(files)
    earlier = loads_of(spark, table).agg(F.max("load_number").alias("n"), F.sum("rows_loaded").alias("rows")).head()
    number, before = (earlier["n"] or 0) + 1, earlier["rows"] or 0
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(key).isNull(), 1)).alias("null_keys"),
               F.approx_count_distinct(key).alias("keys")]
    if measure:
        metrics.append(F.sum(F.col(measure).cast("long")).alias("measure"))
    rows = (rows.select(*columns) if columns else rows).observe(seen, *metrics).withColumn("load_id", F.lit(load_id))
    with sql_conf(spark, FREE_SHUFFLES):
        writers.replace_partitions(rows, table, [*partition_by, "load_id"], cluster_by=cluster_by)
    m = seen.get
    report = LoadReport(len(files), before, int(m["rows"]), int(m["null_keys"]))
    if check:
        check(report)
    total = m["measure"] if measure else None
    commit(spark, table, files, (number, before, report.rows_loaded, report.null_keys, total, int(m["keys"]), record_ts))
    return report


def commit(spark: SparkSession, table: str, files: Sequence, counted: tuple) -> None:
    """The load's rows in the ledger, one a file: from here on the files are taken."""
    load_id = load_id_of(files)
    rows = [(load_id, f["path"], f["length"], f["modified"], *counted) for f in files]
    spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(ledger_path(table))


def load_new(spark: SparkSession, landing: str, glob: str, table: str, record_ts,
             rows_of: Callable[[list[str]], DataFrame], **layout) -> LoadReport:
    """Take the files that landed since the last load; without any, nothing is written."""
    files = new_files(spark, landing, glob, table).collect()
    if not files:
        before = loads_of(spark, table).agg(F.sum("rows_loaded")).head()[0] or 0
        return LoadReport(0, before, 0, 0)
    return publish(spark, rows_of([f["path"] for f in files]), files, table, record_ts, **layout)


def archive_loaded(spark: SparkSession, landing: str, glob: str, table: str, archive: str) -> int:
    """Move landed files that are committed in the ledger to the archive. A run that broke between
    commit and move is made up by the next one: the files are known, so they are only moved."""
    done = landed_files(spark, landing, glob).join(ledger(spark, table).select(*FILE).distinct(), FILE, "left_semi").collect()
    return move_files(spark, [f["path"] for f in done], landing, archive)


def move_files(spark: SparkSession, paths: Sequence[str], root: str, target: str) -> int:
    """Rename files below ``root`` to the same place below ``target``; a name that the target has already
    gets the time of the move before it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    base = fs.makeQualified(hadoop.Path(root)).toString().rstrip("/") + "/"
    for path in paths:
        source = fs.makeQualified(hadoop.Path(path))
        name = source.toString().removeprefix(base)
        place = hadoop.Path(target, name)
        if fs.exists(place):
            place = hadoop.Path(place.getParent(), f"{dt.datetime.now():%Y%m%dT%H%M%S%f}-{place.getName()}")
        fs.mkdirs(place.getParent())
        if not fs.rename(source, place):
            raise GateError(f"{path} could not be moved to {place}")
    return len(paths)
