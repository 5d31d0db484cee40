"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_distinct(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """UNION DISTINCT by name over ``cols`` (both sides projected first).

    The distinct is a hash aggregate with partial aggregation on each side before the
    shuffle, so duplicates inside one input never cross the network.
    """
    cols = list(cols or a.columns)
    return a.select(*cols).unionByName(b.select(*cols)).distinct()
