"""Table writes and text sinks.

Tables are parquet folders. ``append`` / ``refresh`` / ``replace_partitions`` are the
reference's insert-select, delete-then-insert and truncate-load; partitioning by a date
column replaces the warehouse's DAY/MONTH time partitioning, and clustering becomes a sort
within partitions. Every write is one Spark job, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.functions.calendar import lit_date
from cellmart.session import FREE_SHUFFLES, OPEN_FILES, sql_conf

# Fixed value: the folder of rows without a partition date. They never expire.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Text sinks: the default level takes half of the time of a wide text sink, for files a fifth smaller.
FAST_GZIP = ("zlib.compress.level", "BEST_SPEED")


def _layout(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]):
    if partition_by:
        # Rows of one partition value go to the same tasks, so each folder gets a few large
        # files instead of one small file per writing task. REBALANCE (unlike a plain
        # repartition on the partition column) lets AQE split a month that is larger than
        # the advisory partition size over several tasks and merge small ones.
        df = df.hint("rebalance", *partition_by)
    if cluster_by:
        # Clustering: sorted by the cluster keys within each file, so parquet row-group
        # statistics prune reads on those keys.
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def append(df: DataFrame, path: str, columns: Sequence[str] | None = None,
           partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    """INSERT INTO t(cols) SELECT ...: columns are matched by name, never by position."""
    if columns:
        df = df.select(*columns)
    _layout(df, partition_by, cluster_by).mode("append").parquet(path)


def refresh(df: DataFrame, path: str, partition_by: Sequence[str] = (),
            cluster_by: Sequence[str] = ()) -> None:
    """Full refresh (delete all + insert) as one overwrite. The new content must not be
    computed from ``path`` itself: write to a new path and swap instead. The overwrite is static:
    partitions that the new content lacks go, whatever the session's overwrite mode."""
    _layout(df, partition_by, cluster_by).mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       columns: Sequence[str] | None = None, cluster_by: Sequence[str] = ()) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition overwrite): a load that
    runs again replaces what it wrote before. The table is created when absent."""
    if columns:
        df = df.select(*columns)
    (_layout(df, partition_by, cluster_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))


def store_clustered(df: DataFrame, table: str, path: str, partition_by: Sequence[str], bucket_by: str, buckets: int,
                    sort_by: Sequence[str] = ()) -> DataFrame:
    """A catalogued table at ``path``: partitioned, dealt into ``buckets`` by the hash of ``bucket_by`` and sorted within
    each file. Rows are shuffled once, by partition and bucket, and a bucket of a partition that is larger than the
    advisory size goes to several tasks, each with a file of its own; reads for a key open its bucket
    alone, and joins and groups on the key of tables with equal buckets need no exchange. The old
    content goes."""
    # Spark's own bucket number: the rows of a bucket meet, however many keys it has.
    bucket = F.pmod(F.hash(bucket_by), F.lit(buckets))
    rows = df.withColumn("__bucket", bucket).hint("rebalance", *partition_by, "__bucket").drop("__bucket")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by)
     .bucketBy(buckets, bucket_by).sortBy(bucket_by, *sort_by).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def stamp(df: DataFrame, col: str, value) -> DataFrame:
    """Add a load stamp column (``current_timestamp()`` in the reference; a parameter here)."""
    return df.withColumn(col, F.lit(value))


def history_append(df: DataFrame, path: str, stamp_col: str, stamp_value) -> None:
    append(stamp(df, stamp_col, stamp_value), path)


def in_order(df: DataFrame, order: Sequence[str], fill: str = "") -> DataFrame:
    """Columns of a text file in the given order, missing ones and NULL filled. With an empty fill, integers and texts
    stay as they are: the writer prints them as a cast does, and NULL as nothing."""
    plain = {c for c, t in df.dtypes if fill == "" and t in ("tinyint", "smallint", "int", "bigint", "string")}
    return df.select(*[F.col(c) if c in plain else F.coalesce(F.col(c).cast("string"), F.lit(fill)).alias(c) if c in df.columns
                       else F.lit(fill).alias(c) for c in order])


def write_csv(df: DataFrame, path: str, order: Sequence[str] | None = None, sep: str = ",",
              header: bool = True, fill: str = "", compression: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Delimited text sink: given column order, missing columns filled, quotes doubled
    (``"a""b"``), fields with the separator or a quote quoted. ``partition_by`` names columns that are not in the
    files: each of their values, a few, has files in a folder of its own."""
    if order:
        df = in_order(df, [*order, *partition_by], fill)
    w = (df.write.mode("overwrite").option("sep", sep).option("header", header)
         .option("quote", '"').option("escape", '"').option("emptyValue", ""))
    if compression:
        w = w.option("compression", compression).option(*FAST_GZIP)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with sql_conf(df.sparkSession, FREE_SHUFFLES | OPEN_FILES):
        w.csv(path)


def write_text(df: DataFrame, path: str, columns: Sequence[str], sep: str = ",",
               compression: str | None = None) -> None:
    """Plain text sink: one line per row, fields joined by ``sep``."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value")
    w = df.select(line).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def expire_partitions(spark: SparkSession, path: str, date_col: str, ttl_days: int, as_of) -> list[str]:
    """Drop the folders of expired date partitions; returns their dates. Only folder names are read: no row
    of the table is read or rewritten, and a run that broke is finished by the next one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    last = (as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of)[:10])) - dt.timedelta(days=ttl_days)
    gone = []
    for status in fs.globStatus(hadoop.Path(f"{path.rstrip('/')}/{date_col}=*")):
        value = status.getPath().getName().split("=", 1)[1]
        if value != NULL_PARTITION and dt.date.fromisoformat(value) <= last:
            fs.delete(status.getPath(), True)
            gone.append(value)
    return sorted(gone)


def retain(df: DataFrame, date_col: str, ttl_days: int, as_of) -> DataFrame:
    """Partition expiry: keep rows whose partition date is less than ``ttl_days`` old at
    ``as_of`` (a partition expires when its date + ttl has passed)."""
    return df.filter(F.col(date_col) > F.date_sub(lit_date(as_of), ttl_days))


def read_period(spark: SparkSession, path: str, date_col: str, start, end) -> DataFrame:
    """Read a partitioned table for a mandatory [start, end] period. The filter is on the
    partition column, so only those partition folders are listed and scanned."""
    if start is None or end is None:
        raise ValueError(f"a partition filter on {date_col} is required")
    return spark.read.parquet(path).filter(F.col(date_col).between(lit_date(start), lit_date(end)))
