"""Marts kept up to date by period.

A mart is a function of sums of usage rows by keys. The sums are stored by period; when loads were
committed since the last refresh, only their rows are summed, added to the stored sums of the periods they
touch, and the mart is derived again for these periods. Sums, mart and the names of the loads taken
change in one snapshot, so a load is never counted twice and a refresh that breaks leaves the old state.

The work of a refresh follows its loads: their sums are a layer of their own beside the stored ones, and layers are
merged when a period has many. Of a mart whose rows belong to one subject each, only the rows of subjects that the
loads name are derived again, if these are few; the other rows of the periods are copied.

The sums hold no attribute of a dimension: after a change of cells, devices, subscribers or a month of the
subscriber base ``derive_again`` builds the mart of all periods, or of those named, from them, without reading usage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellmart.plans import ledger
from cellmart.session import initial_partitions, sql_conf
from cellmart.sinks.snapshots import Snapshots
from cellmart.sinks.writers import NULL_PARTITION

#: Layers of sums that a period may have; the next load merges them.
LAYERS = 8
#: Subjects, sent to every executor, of which a refresh derives rows; with more of them it derives the whole periods.
SUBJECTS = 1 << 18
#: Rows of sums whose periods are derived at once, if periods can be derived apart: what a turn has shuffled goes from the disks
#: before the next one.
TURN_ROWS = 1 << 25


def _within(periods: Sequence[dt.date | None]) -> Column:
    """Rows of these periods; None is the period of rows without a date."""
    own = F.col("period").isin([p for p in periods if p is not None])
    return own | F.col("period").isNull() if None in periods else own


def _folders(periods: Sequence[dt.date | None]) -> list[str]:
    return [f"period={NULL_PARTITION if p is None else p}" for p in periods]


def dealt_by_period(rows: DataFrame, period: str, keys: Sequence[str], periods: Sequence) -> DataFrame:
    """Rows dealt out once by period and ``part``, a share of its keys: groups by ``period``, ``part`` and the keys, and the
    write by period, need no further shuffle. A period has so many parts that all periods together have the
    partitions of the session, which follow the input: a task's share and the files of a period do not grow."""
    parts = -(-initial_partitions(rows.sparkSession) // max(len(periods), 1))
    return rows.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(parts))).repartition(period, "part")


@dataclass(frozen=True)
class IncrementalMart:
    name: str
    keys: Sequence[str]                         # keys of the sums
    sums: Sequence[Column]                      # named sums over usage rows
    period: Column                              # date of the period, from partition columns of the usage table
    derive: Callable[[DataFrame, Sequence], DataFrame]  # sums with their period, the periods -> mart with its period
    dealt: bool = False                         # derive gives rows dealt out by period
    apart: bool = False                         # periods derived one after the other take no more work
    measures: Sequence[Column] = ()             # values of a usage row that are summed, by the names of their sums
    adds: bool = False                          # derive adds up several sums of a key
    subject: tuple[str, str] | None = None      # key of the sums, column of the mart: each mart row is of one subject's sums

    def _summed(self, rows: DataFrame, sums: Sequence[Column], periods: Sequence) -> DataFrame:
        """Rows summed by period and keys, dealt out by period."""
        dealt = dealt_by_period(rows, "period", self.keys, periods)
        return dealt.groupBy("period", *self.keys, "part").agg(*sums).drop("part")

    def _merged(self, sums: DataFrame, periods: Sequence) -> DataFrame:
        """Several layers of sums as one."""
        names = [c for c in sums.columns if c != "period" and c not in self.keys]
        return self._summed(sums, [F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in names], periods)

    def _turns(self, sums: DataFrame, periods: Sequence) -> list[Sequence]:
        """The periods in groups that are derived at once. One row a period comes to the driver."""
        if not self.apart:
            return [periods]
        rows = {r["period"]: r["count"] for r in sums.groupBy("period").count().collect()}
        turns, taken = [[]], 0
        for p in sorted(periods, key=str):
            if turns[-1] and taken + rows.get(p, 0) > TURN_ROWS:
                turns.append([])
                taken = 0
            turns[-1].append(p)
            taken += rows.get(p, 0)
        return turns

    def _derived(self, sums: DataFrame, periods: Sequence, kept: DataFrame | None = None) -> Iterator[DataFrame]:
        """The mart of ``periods``, turn by turn: what is derived from ``sums``, and rows that are ``kept``. The partitions of a
        turn are its share of the session's."""
        spark, turns = sums.sparkSession, self._turns(sums, periods)
        whole = initial_partitions(spark)
        for turn in turns:
            own = sums if len(turns) == 1 else sums.filter(_within(turn))
            share = -(-whole * len(turn) // max(len(periods), 1)) or whole
            with sql_conf(spark, {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(share)}):
                mart = self.derive(own if self.adds else self._merged(own, turn), turn)
                yield mart if kept is None else kept.filter(_within(turn)).unionByName(mart)

    def _refreshed(self, tables: Snapshots, sums: DataFrame, added: DataFrame, periods: Sequence) -> Iterator[DataFrame]:
        """The mart of ``periods`` after ``added`` has come to the sums."""
        stored = tables.state()[1].get(self.name)
        if self.subject and stored:
            key, own = self.subject
            named = added.select(F.col(key).alias("__subject")).distinct()
            if named.count() <= SUBJECTS:
                named = F.broadcast(named)
                mart = tables.read(self.name).filter(_within(periods))
                kept = mart.join(named, F.col(own).eqNullSafe(F.col("__subject")), "left_anti")
                again = sums.join(named, F.col(key).eqNullSafe(F.col("__subject")), "left_semi")
                return self._derived(again, periods, kept)
        return self._derived(sums, periods)

    def refresh(self, tables: Snapshots, usage_table: str) -> list:
        """Take the committed loads that the mart lacks; returns the periods derived again."""
        spark, state = tables.spark, tables.state()[1]
        sums_name, loads_name = f"{self.name}__sums", f"{self.name}__loads"
        committed = {r["load_id"] for r in ledger.ledger(spark, usage_table).select("load_id").distinct().collect()}
        taken = {r["load_id"] for r in tables.read(loads_name).select("load_id").collect()} if loads_name in state else set()
        fresh = sorted(committed - taken)
        if not fresh:
            return []
        rows = spark.read.parquet(usage_table).filter(F.col("load_id").isin(fresh)).withColumn("period", self.period)
        # Periods come from partition columns alone; there is one row a month.
        periods = [r["period"] for r in rows.select("period").distinct().collect()]
        if self.measures:
            rows = rows.select("period", *self.keys, *self.measures)
        added = self._summed(rows, self.sums, periods)
        stored = tables.read(sums_name).filter(_within(periods)) if sums_name in state else None
        layered = stored is None or tables.layers(sums_name, _folders(periods)) < LAYERS
        loads = spark.createDataFrame([(i, len(periods)) for i in fresh], "load_id string, periods long").coalesce(1)

        def mart(written):
            new = written[sums_name]
            if not layered:
                return self._derived(new, periods)
            return self._refreshed(tables, new if stored is None else stored.unionByName(new), new, periods)

        tables.rewrite({sums_name: (added if layered else self._merged(stored.unionByName(added), periods), ["period"]),
                        self.name: (mart, ["period"]), loads_name: (loads, ["load_id"])},
                       {self.name: _folders(periods)}, {sums_name, *([self.name] if self.dealt else [])},
                       {sums_name} if layered else ())
        return sorted(periods, key=str)

    def derive_again(self, tables: Snapshots, periods: Sequence[dt.date | None] | None = None) -> None:
        """Build the mart of ``periods``, by default of all that have usage, from the stored sums. A period that
        has no usage yet may be named: its mart is what the dimensions alone give."""
        sums = tables.read(f"{self.name}__sums")
        if periods is None:
            periods = [r["period"] for r in sums.select("period").distinct().collect()]
        else:
            sums = sums.filter(_within(periods))
        tables.rewrite({self.name: (self._derived(sums, periods), ["period"])}, {self.name: _folders(periods)},
                       {self.name} if self.dealt else ())

    def read(self, tables: Snapshots) -> DataFrame:
        return tables.read(self.name).drop("period")
