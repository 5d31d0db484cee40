"""Top-1-per-group with ties (``RANK() OVER (...) = 1``).

Spark plans ``rank() = 1`` as a partial ``WindowGroupLimit`` before the shuffle and a final
one after it, so each map task ships at most the tied leaders of every key: one key holding a
third of all rows costs one sorted map-side pass, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_first(df: DataFrame, partition_by: Sequence[str | Column], order_by: Sequence[Column],
               keep_ties: bool = True, rank_col: str | None = None) -> DataFrame:
    """Rows ranked first within each partition. ``keep_ties`` uses RANK (several rows may
    share first place), otherwise ROW_NUMBER (one arbitrary winner)."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    fn = F.rank() if keep_ties else F.row_number()
    name = rank_col or "__rank"
    out = df.withColumn(name, fn.over(w)).filter(F.col(name) == 1)
    return out if rank_col else out.drop(name)
