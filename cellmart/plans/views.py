"""Analytic marts registered as temporary views, so they can be queried with Spark SQL.

A view is the mart function applied to the given tables for one ``as_of`` date; the view is
lazy (a named logical plan), so each query against it runs the mart with Catalyst pruning
whatever columns and rows the query does not need.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from cellmart.plans import devices, usage


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], as_of) -> list[str]:
    """Register ``usage_mart``, ``best_device`` and ``recent_device`` over ``tables``
    (keys: base, products, products2, usage, cells, devices)."""
    t = tables
    views = {
        "usage_mart": usage.usage_mart(t["base"], t["products"], t["products2"], t["usage"], t["cells"], as_of),
        "best_device": devices.best_device(t["usage"], t["devices"], as_of),
        "recent_device": devices.recent_device(t["usage"], t["devices"], as_of),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
