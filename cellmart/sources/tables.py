"""Table scans."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Schemas read once for each session and path: reading footers again is a Spark job of its own.
# Files are listed anew by every scan.
_SCHEMAS: WeakKeyDictionary = WeakKeyDictionary()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan. How many splits it has is left to the file layout and
    ``spark.sql.files.maxPartitionBytes``."""
    schemas = _SCHEMAS.setdefault(spark, {})
    if path not in schemas:
        schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(schemas[path]).parquet(path)
