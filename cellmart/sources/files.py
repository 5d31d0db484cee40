"""File-level sources: landed-file counts, manifests, control tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, directory: str, glob: str = "*", recursive: bool = False,
               contains: str | None = None, columns: Sequence[str] = ("path", "length")) -> DataFrame:
    """Paths and sizes (or other ``columns`` of file metadata) of files matching ``glob`` below ``directory``; with ``contains``, only
    files whose own name holds that marker, not as part of a longer number (a folder named
    like the month, or a day of it, does not count). Only file metadata is read: the ``binaryFile`` source is pruned to ``path`` /
    ``length``, so no content is loaded. Hidden files (``_SUCCESS``, ``.crc``) and empty
    (zero-byte) files are not counted."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(directory)
             .select(*columns))
    if not contains:
        return files
    name = F.element_at(F.split("path", "/"), -1)
    return files.filter(F.regexp_like(name, F.lit(rf"(?<![0-9])\Q{contains}\E(?![0-9])")))


def count_files(spark: SparkSession, directory: str, glob: str = "*", recursive: bool = False,
                contains: str | None = None) -> int:
    return list_files(spark, directory, glob, recursive, contains).count()


def manifest_counts(spark: SparkSession, paths: str) -> DataFrame:
    """Expected row count of each manifest file: its last non-empty line, as a long.

    Each manifest is read whole (it is a few lines); a bad last line gives NULL."""
    raw = spark.read.text(paths, wholetext=True)
    body = F.regexp_replace(F.col("value"), r"\s+$", "")      # trailing blank lines and spaces
    last = F.element_at(F.split(body, r"\r?\n"), -1)
    return raw.select(F.col("_metadata.file_path").alias("manifest"),
                      F.trim(last).try_cast("long").alias("expected_rows"))


def read_manifest(spark: SparkSession, path: str) -> int:
    row = manifest_counts(spark, path).select("expected_rows").head()
    if row is None or row[0] is None:
        raise ValueError(f"manifest {path} has no row count")
    return int(row[0])


def control_value(control: DataFrame, name: str, name_col: str = "property_name",
                  value_col: str = "property_value") -> str:
    """Scalar lookup in a key/value control table; fails when the key is absent."""
    row = control.filter(F.col(name_col) == name).select(value_col).head()
    if row is None:
        raise KeyError(f"control property {name!r} not found")
    return row[0]
