"""Projections of the cleanse job: drop columns, conform to an output header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, names: Sequence[str] | str | None) -> DataFrame:
    """Drop listed columns; unknown names are ignored, an empty list is a no-op.
    A comma-separated string is accepted, as the job's parameter is one."""
    if isinstance(names, str):
        names = [n for n in names.split(",") if n != ""]
    return df.drop(*(names or []))


def conform(df: DataFrame, order: Sequence[str], fill: str = "") -> DataFrame:
    """Columns in ``order``; a missing column or an absent (NULL) cell becomes ``fill``,
    columns not in ``order`` are dropped."""
    return df.select(*[F.coalesce(F.col(c), F.lit(fill)).alias(c) if c in df.columns
                       else F.lit(fill).alias(c) for c in order])
