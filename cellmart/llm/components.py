"""Connected components of a large edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction. Large: every larger neighbour of a node is linked to the smallest node
    of the neighbourhood; small: the smaller neighbours and the node itself are."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # The minima combine in the map tasks; they are written so that the join back to a node of
    # very many neighbours can be split.
    least = written(near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star-minima")
    joined = near.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return written(out.where("a <> b").distinct(), "star-edges")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (the smallest node of its component) for every node of an edge. ``edges`` has
    long columns ``a`` and ``b``; the result is a written table."""
    edges = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    state = None
    while True:
        edges = _star(_star(edges, large=True), large=False)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = pairs.select(F.col("label").alias("node"), "label").distinct()
    return written(pairs.unionByName(roots), "components")
