"""Conditional-sum pivot: one output column per (measure, bucket).

``groupBy().pivot()`` yields NULL for an empty bucket; the reference semantics is
``SUM(CASE WHEN bucket = b THEN m ELSE 0 END)``, i.e. 0 for a bucket with no rows. The
columns are generated from parameter lists, evaluated in one hash aggregate with partial
(map-side) aggregation, so a hot key is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_columns(bucket: Column, measures: Mapping[str, Column],
                  buckets: Mapping[str, Sequence[tuple[str, str]]], else_value=0) -> list[Column]:
    """SUM(CASE WHEN bucket = b THEN measure ELSE else_value END) AS <measure>_<suffix>."""
    cols = []
    for name, measure in measures.items():
        for value, suffix in buckets[name]:
            cols.append(F.sum(F.when(bucket == value, measure).otherwise(F.lit(else_value)))
                        .alias(f"{name}_{suffix}"))
    return cols


def conditional_sums(df: DataFrame, keys: Sequence[str | Column], bucket: Column,
                     measures: Mapping[str, Column],
                     buckets: Mapping[str, Sequence[tuple[str, str]]],
                     else_value=0) -> DataFrame:
    return df.groupBy(*keys).agg(*pivot_columns(bucket, measures, buckets, else_value))
