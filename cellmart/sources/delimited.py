"""Scans of delimited landing files.

Two readers, as in the reference's two load paths:

* ``read_delimited`` — a warehouse-style load: declared schema, header row skipped, quotes
  honoured, one bad row fails the load (``FAILFAST``).
* ``read_lines`` + ``split_fields`` — the cleanse job's raw path: each line is one string,
  the first line of every file is dropped, cells are split on the literal separator with no
  quote handling, extra cells are dropped and missing cells are absent.

gzip files are not splittable, so each one is a single task; a landing of many files is read
in parallel file by file. The wide usage files come as >= 100 files a month, which is the
unit of parallelism of the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellmart.functions.text import split_cells
from cellmart.operators.projection import conform, drop_columns

# A separator that does not occur in text lines (three control characters in a row): lets
# the CSV reader return whole lines while still dropping the header line of every file.
_LINE_SEP_SENTINEL = "\u0000\u0001\u0002"


def delimited_options(reader, sep: str = "|", header: bool = True, strict: bool = True):
    """The dialect of landed files, for batch and stream readers alike: RFC 4180 quoting as the
    warehouse load expects (a quote inside a quoted field is doubled)."""
    return (reader.option("sep", sep).option("header", header).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST" if strict else "PERMISSIVE"))


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str,
                   sep: str = "|", header: bool = True, strict: bool = True) -> DataFrame:
    """Typed scan with a declared schema; ``strict`` fails on a malformed row.

    A pruned ``count()`` does not parse all columns and so cannot see malformed rows:
    reconcile on a materialised (written) table, not on a bare count of this scan.
    """
    reader = delimited_options(spark.read.schema(schema), sep, header, strict)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_lines(spark: SparkSession, paths: str | Sequence[str], skip_header: bool = True) -> DataFrame:
    """Raw lines in a ``value`` column; the first line of each file is dropped.
    Blank lines are skipped by the reader."""
    reader = (spark.read.schema("value string").option("sep", _LINE_SEP_SENTINEL)
              .option("quote", "").option("escape", "").option("comment", "")
              .option("header", skip_header).option("mode", "PERMISSIVE")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
              .option("nullValue", "\u0001\u0002"))
    return reader.csv(list(paths) if not isinstance(paths, str) else paths) \
        .select(F.coalesce(F.col("value"), F.lit("")).alias("value"))


CELL_COUNT = "__cells"


def split_fields(df: DataFrame, headers: Sequence[str], sep: str = ",",
                 value_col: str = "value", keep_count: bool = True) -> DataFrame:
    """Name the cells of each line by position. Cells beyond ``headers`` are dropped; a short
    line leaves its last fields absent (NULL), and ``__cells`` records how many were present."""
    cells = split_cells(F.col(value_col), sep)
    out = df.select(cells.alias("__c"))
    cols = [F.get(F.col("__c"), i).alias(h) for i, h in enumerate(headers)]
    if keep_count:
        cols.append(F.size(F.col("__c")).alias(CELL_COUNT))
    return out.select(*cols)


def null_key_filter(df: DataFrame, primary_key: str | None, headers: Sequence[str]) -> DataFrame:
    """Drop rows whose key cell is present and empty. Rows are kept when the key column
    does not exist or the key cell is absent from a short line."""
    if not primary_key or primary_key not in df.columns:
        return df
    idx = list(headers).index(primary_key)
    key = F.col(primary_key)
    present = F.col(CELL_COUNT) > idx if CELL_COUNT in df.columns else F.lit(True)
    return df.filter(~present | (key.isNotNull() & (key != "")))


def cleanse_csv(spark: SparkSession, paths: str | Sequence[str], in_headers: Sequence[str] | str,
                out_headers: Sequence[str] | str, primary_key: str | None = None,
                drop: Sequence[str] | str = (), sep: str = ",", fill: str = "") -> DataFrame:
    """The CSV cleanse job: lines -> named cells -> drop columns -> key check -> output order.

    The key check runs after column removal, so removing the key column disables it.
    Every step is a column expression of one narrow stage: no shuffle at all.
    """
    if isinstance(in_headers, str):
        in_headers = in_headers.split(",")
    if isinstance(out_headers, str):
        out_headers = out_headers.split(",")
    fields = split_fields(read_lines(spark, paths), in_headers, sep)
    kept = drop_columns(fields, drop)
    checked = null_key_filter(kept, primary_key, in_headers)
    return conform(checked.drop(CELL_COUNT), out_headers, fill)
