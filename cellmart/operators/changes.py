"""Row-changing statements (MERGE / UPDATE) as DataFrame operators.

Plain parquet tables take no MERGE or UPDATE, so each statement is a pure function from the
old table (and its source) to the new table; the caller writes the result to a new path or
partition. Each is one join at most, shuffled on the statement's key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class AmbiguousMatchError(ValueError):
    """A target row matched more than one source row (MERGE / UPDATE must match at most one)."""


def assert_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key that exists in the target occurs twice in the source.

    Runs as one distributed job: the per-key count is partially aggregated before the
    shuffle, and only duplicated keys (normally none) reach the semi join.
    """
    dup = (source.groupBy(*keys).count().filter(F.col("count") > 1).drop("count")
           .join(target.select(*keys), list(keys), "left_semi"))
    if dup.limit(1).count() > 0:
        raise AmbiguousMatchError(f"source has duplicate keys {list(keys)} that match the target")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
           stamp_col: str | None = None, stamp=None, check: bool = True) -> DataFrame:
    """MERGE: matched target rows take every non-key value from the source row, unmatched
    source rows are inserted, target rows absent from the source stay as they are.

    The target is left-joined to the source and the source rows without a target key are added, so a
    small feed is broadcast under the checked bound and the target is not shuffled. Rows with a
    NULL key never match (SQL equality), so a NULL-key target row is kept and a NULL-key source
    row is inserted. Duplicate target keys are all updated, as MERGE does.
    """
    if check:
        assert_single_match(target, source, keys)
    if stamp_col is not None:
        source = source.withColumn(stamp_col, F.lit(stamp).cast(target.schema[stamp_col].dataType)
                                   if stamp_col in target.columns else F.lit(stamp))
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    t = target.alias("t")
    s = source.select(*cols).withColumn("__in_source", F.lit(True)).alias("s")
    cond = None
    for k in keys:
        term = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = term if cond is None else cond & term
    hit = F.col("s.__in_source").isNotNull()
    kept = t.join(s, cond, "left").select(*[F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols])
    new = s.join(target.select(*keys).alias("t"), cond, "left_anti").select(*cols)
    return kept.unionByName(new)


def stamp_missing(df: DataFrame, col: str, stamp) -> DataFrame:
    """UPDATE t SET col = stamp WHERE col IS NULL."""
    value = F.lit(stamp).cast(df.schema[col].dataType)
    return df.withColumn(col, F.coalesce(F.col(col), value))


def conditional_update(df: DataFrame, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """UPDATE t SET c = expr WHERE predicate; rows where the predicate is NULL stay as they are."""
    out = df
    cols = {name: F.when(predicate, expr).otherwise(F.col(name)) for name, expr in assignments.items()}
    for name, expr in cols.items():
        out = out.withColumn(name, expr)
    return out


def update_from(target: DataFrame, updates: DataFrame, keys: Sequence[str], predicate: Column,
                assignments: Mapping[str, str]) -> DataFrame:
    """UPDATE a SET a.x = b.y FROM updates b WHERE predicate(a) AND a.key = b.key.

    ``updates`` must be unique on ``keys``: a target row that several update rows match fails the
    job. (The check is an aggregate on the keys within the same plan; updates that come from a
    GROUP BY on them need no further shuffle.) A left join on the keys keeps every target row;
    matched rows under the predicate take the new values, the rest keep theirs.
    """
    renamed = {src: f"__u_{src}" for src in set(assignments.values())}
    u = updates.groupBy(*keys).agg(*[F.first(src).alias(dst) for src, dst in renamed.items()],
                                   F.count(F.lit(1)).alias("__u_rows"))
    u = u.withColumn("__u_hit", F.when(F.col("__u_rows") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"several update rows for one key of {list(keys)}")).cast("boolean")))
    joined = target.join(u, list(keys), "left")
    hit = predicate & F.col("__u_hit").isNotNull()
    out = joined
    for col, src in assignments.items():
        new = F.col(renamed[src])
        if col in target.columns:
            new = F.when(hit, new).otherwise(F.col(col))
        else:
            new = F.when(hit, new)
        out = out.withColumn(col, new)
    keep = list(target.columns) + [c for c in assignments if c not in target.columns]
    return out.select(*keep)
