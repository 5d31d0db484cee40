"""Joins of facts to reference data.

No operator here forces a broadcast of rows that it has not measured (``bounded``). Dimension sides are joined plainly and the planner
decides: it compares its size estimate of the build side with
``spark.sql.autoBroadcastJoinThreshold`` (broadcast hash join below it, sort-merge join
above), and AQE re-checks with the real shuffle sizes at run time. A catalogue that grows
with the data (cells, devices, products at 100 TB) therefore never gets broadcast by
accident, and a skewed key on the fact side is split by AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellmart.functions.text import trim_ws

#: A table whose rows, as they lie in memory, take no more than this is sent to every executor by ``bounded``.
SENT_BYTES = 64 << 20


def bounded(dim: DataFrame) -> DataFrame:
    """A dimension marked for a broadcast when its rows, measured by a scan, stay below a bound; else as it is. The
    planner's own check of a join comes when both sides are shuffled already."""
    fixed = 16 + sum(24 if t == "string" else 8 for _, t in dim.dtypes)
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in dim.dtypes if t == "string"]
    size = dim.agg(F.sum(sum(texts, F.lit(fixed).cast("long")))).head()[0] or 0
    return F.broadcast(dim) if size <= SENT_BYTES else dim


def prefix_join(fact: DataFrame, dim: DataFrame, fact_col: str, dim_key: str, length: int,
                how: str = "left", prefix_col: str | None = None) -> DataFrame:
    """Join on the first ``length`` characters of ``fact_col`` = ``dim_key``
    (device type code = first 8 characters of the handset id)."""
    prefix_col = prefix_col or f"{fact_col}_{length}"
    f = fact.withColumn(prefix_col, F.substring(F.col(fact_col), 1, length))
    return f.join(dim, f[prefix_col] == dim[dim_key], how)


def effective_dated_join(fact: DataFrame, dim: DataFrame, *, fact_key: Column, dim_key: Column,
                         fact_date: Column, start: Column, end: Column,
                         how: str = "left", trim_keys: bool = True) -> DataFrame:
    """Temporal join: keys equal and ``fact_date BETWEEN start AND end``.

    Rows of the dimension whose validity windows overlap all match (fan-out), as in SQL.
    The planner turns the key equality into the hash/sort key and keeps the range as a
    residual condition, so no cartesian product is formed.
    """
    if trim_keys:
        fact_key, dim_key = trim_ws(fact_key), trim_ws(dim_key)
    cond = (fact_key == dim_key) & fact_date.between(start, end)
    return fact.join(dim, cond, how)


def attribute_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[Column, Column]],
                   how: str = "left") -> DataFrame:
    """Equi-join on pairs of (left expression, right expression)."""
    cond = None
    for lc, rc in on:
        term = lc == rc
        cond = term if cond is None else cond & term
    return left.join(right, cond, how)
