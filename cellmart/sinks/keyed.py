"""A dimension stored in key buckets, merged without reading or writing the buckets that a feed does not touch.

The table is one of a ``Snapshots`` folder, partitioned by ``bucket_of_<n>`` = hash of the key modulo n. A merge
reads the touched buckets once, in one full outer join with the feed, and writes them again as one
snapshot: bytes read and written follow the feed, readers see the old dimension or the new one, and a
merge that breaks or is repeated does no harm. Take n so that a bucket is a few files at most.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cellmart.sinks.snapshots import Snapshots

#: Rows without a key match nothing; they are spread over this many values in the join.
NULL_KEY_SPREAD = 1024


@dataclass
class MergeReport:
    buckets: int           # buckets read and written again
    updated: int           # rows of the dimension that took the feed's values
    inserted: int


class KeyedTable:
    def __init__(self, tables: Snapshots, name: str, keys: Sequence[str]):
        self.tables, self.name, self.keys = tables, name, list(keys)

    @property
    def path(self) -> str:
        return f"{self.tables.base}/{self.name}"

    def _in_buckets(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.withColumn(f"bucket_of_{buckets}", F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int"))

    def create(self, rows: DataFrame, buckets: int) -> None:
        column = f"bucket_of_{buckets}"
        self.tables.rewrite({self.name: (self._in_buckets(rows, buckets), [column])})

    def read(self) -> DataFrame:
        stored = self.tables.read(self.name)
        return stored.select(*stored.columns[:-1])

    def merge(self, source: DataFrame, *, stamp_col: str | None = None, stamp=None) -> MergeReport:
        """MERGE by key: matched rows take every value of the feed, feed rows without a match are inserted, other
        rows stay. A NULL in the key matches nothing (the row is kept, or inserted). Stored rows that
        repeat a key are all updated; a stored row that several feed rows match fails the merge, and the
        dimension stays as it was. ``source`` is read three times: give a written table."""
        stored = self.tables.read(self.name)
        bucket = stored.columns[-1]
        columns = stored.columns[:-1]
        if stamp_col is not None:
            source = source.withColumn(stamp_col, F.lit(stamp))
        if missing := [c for c in columns if c not in source.columns]:
            raise ValueError(f"source lacks target columns {missing}")
        feed = source.select(*[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in columns])
        feed = self._in_buckets(feed, int(bucket.removeprefix("bucket_of_")))
        touched = [r[0] for r in feed.select(bucket).distinct().collect()]
        if not touched:
            return MergeReport(0, 0, 0)

        no_key = F.greatest(*[F.col(k).isNull() for k in self.keys], F.lit(False))
        spread = F.when(no_key, F.pmod(F.xxhash64(*columns), F.lit(NULL_KEY_SPREAD))).otherwise(0)
        several = feed.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1")
        s = feed.join(several, self.keys, "left").withColumn("__spread", spread).withColumn("__here", F.lit(True)).alias("s")
        t = stored.filter(F.col(bucket).isin(touched)).withColumn("__spread", spread).withColumn("__here", F.lit(True)).alias("t")
        match = F.col("t.__spread") == F.col("s.__spread")
        for k in self.keys:
            match = match & (F.col(f"t.{k}") == F.col(f"s.{k}"))
        new, old = F.col("s.__here").isNotNull(), F.col("t.__here").isNotNull()
        refuse = F.raise_error(F.lit(f"several feed rows match one row of {self.name} by {self.keys}")).cast("boolean")
        seen = Observation()
        merged = (t.join(s, match, "full_outer")
                  .filter(F.when(new & old & F.col("s.__rows").isNotNull(), refuse).otherwise(F.lit(True)))
                  .observe(seen, F.count(F.when(new & old, 1)).alias("updated"), F.count(F.when(new & ~old, 1)).alias("inserted"))
                  .select(*[F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in [*columns, bucket]]))
        self.tables.rewrite({self.name: (merged, [bucket])})
        return MergeReport(len(touched), int(seen.get["updated"]), int(seen.get["inserted"]))
