"""Data-quality gates and load reconciliation.

Counts are distributed jobs (``count()`` / ``DataFrame.observe``); only the resulting
numbers reach the driver, never the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class GateError(ValueError):
    """A landing gate was not met (too few files, failed reconciliation)."""


def require_files(count: int, minimum: int) -> int:
    """Raise when fewer than ``minimum`` files have landed; return the count otherwise."""
    if count < minimum:
        raise GateError(f"{count} files landed, at least {minimum} required")
    return count


def gate_frame(counts: DataFrame, minimum: int) -> DataFrame:
    """Per-group file counts with a pass/fail flag (``counts`` has a ``files`` column)."""
    return counts.withColumn("minimum", F.lit(minimum).cast("long")) \
                 .withColumn("ok", F.col("files") >= F.col("minimum"))


def reconcile(before: DataFrame, after: DataFrame, expected: DataFrame | int) -> DataFrame:
    """One row: rows before, rows after, rows loaded, rows expected, ok = loaded == expected.

    ``before`` / ``after`` are the table before and after the load, ``expected`` is the
    manifest count (a one-column DataFrame from ``read_manifest`` or a number). Everything
    is one aggregate over a tagged union, so the check is a single distributed job.
    """
    tag = lambda df, name: df.select(F.lit(name).alias("part"), F.lit(1).cast("long").alias("v"))
    parts = tag(before, "before").unionByName(tag(after, "after"))
    if isinstance(expected, DataFrame):
        exp = expected.select(F.lit("expected").alias("part"),
                              F.col(expected.columns[0]).cast("long").alias("v"))
        parts = parts.unionByName(exp)
    exp_col = (F.max(F.when(F.col("part") == "expected", F.col("v"))) if isinstance(expected, DataFrame)
               else F.lit(int(expected)).cast("long"))
    agg = parts.agg(
        F.coalesce(F.sum(F.when(F.col("part") == "before", F.col("v"))), F.lit(0)).cast("long").alias("rows_before"),
        F.coalesce(F.sum(F.when(F.col("part") == "after", F.col("v"))), F.lit(0)).cast("long").alias("rows_after"),
        exp_col.alias("rows_expected"))
    loaded = F.col("rows_after") - F.col("rows_before")
    return agg.select("rows_before", "rows_after", loaded.alias("rows_loaded"), "rows_expected",
                      (loaded == F.col("rows_expected")).alias("ok"))


class LayoutDrift(GateError):
    """An extract does not have its declared layout; ``drift`` says where."""

    def __init__(self, drift: list[tuple[str, str, str | None, str | None]]):
        super().__init__("; ".join(f"{column} {problem}: declared {declared}, found {found}" for column, problem, declared, found in drift))
        self.drift = drift


def layout_drift(found: StructType, declared: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, problem, declared type, found type) of columns that are missing, added or retyped. Order and
    nullability are free; a timestamp may stand for a date, which the load narrows."""
    have = {f.name: f.dataType.simpleString() for f in found}
    want = {f.name: f.dataType.simpleString() for f in declared}
    out = [(c, "missing", t, None) for c, t in want.items() if c not in have]
    out += [(c, "added", None, t) for c, t in have.items() if c not in want]
    narrows = {("date", "timestamp"), ("date", "timestamp_ntz")}
    out += [(c, "retyped", t, have[c]) for c, t in want.items() if c in have and have[c] != t and (t, have[c]) not in narrows]
    return sorted(out, key=lambda x: x[:2])


def observed_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row-count metric that is filled in when the DataFrame is written."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def next_period(key: str) -> str:
    """``YYYYMM`` of the month after ``key``."""
    y, m = int(key[:4]), int(key[4:6])
    y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return f"{y:04d}{m:02d}"
