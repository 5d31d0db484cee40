"""Aggregation helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_sum(*cols: str) -> Column:
    """``a + b (+ ...)`` without coalescing: a NULL addend makes the row NULL, as in SQL."""
    expr = F.col(cols[0])
    for c in cols[1:]:
        expr = expr + F.col(c)
    return expr


def sign_of_sum(values: Column) -> Column:
    """1 / -1 / 0 by the sign of SUM(values); NULL when the sum is NULL."""
    s = F.sum(values)
    return (F.when(s > 0, F.lit(1)).when(s < 0, F.lit(-1)).when(s == 0, F.lit(0))).cast("int")


def sign_flag(df: DataFrame, keys: Sequence[str], col: str, flag_col: str = "flag",
              sum_col: str | None = None) -> DataFrame:
    aggs = [sign_of_sum(F.col(col)).alias(flag_col)]
    if sum_col:
        aggs.append(F.sum(col).alias(sum_col))
    return df.groupBy(*keys).agg(*aggs)
