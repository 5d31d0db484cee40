"""Rewrites of several tables that become visible together.

Tables lie below one folder. A rewrite puts the partitions that it changes into new folders,
``<base>/<table>/snapshot_version=<version>/<partition>``; then one small file in ``<base>/_snapshots`` names the folders that
make up every table. Readers resolve the latest of these files, so they see all tables of a rewrite
or none. A rewrite that breaks leaves the old state; a second writer is refused, as the file's
number is taken. Only changed partitions are written, and retention only leaves folders out.

A rewrite may add its rows to a partition instead, which is then made of several folders, its layers.

The snapshot file holds folder names: metadata that grows with the number of partitions.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cellmart.session import FREE_SHUFFLES, OPEN_FILES, sql_conf


def _places(folders: str | list[str]) -> list[str]:
    """Where a partition lies: one folder, or several when rewrites have added layers to it."""
    return [folders] if isinstance(folders, str) else folders


class Snapshots:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.hadoop.Path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        folder = self.hadoop.Path(f"{self.base}/_snapshots")
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def state(self) -> tuple[int, dict]:
        """Number of the latest snapshot and its tables; 0 and none before the first."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        text = self.spark.read.text(f"{self.base}/_snapshots/{numbers[-1]:012d}", wholetext=True).head()[0]
        return numbers[-1], json.loads(text)

    def _commit(self, number: int, tables: dict) -> int:
        """Write the next snapshot under a name of its own and rename it to its number."""
        part = self.hadoop.Path(f"{self.base}/_snapshots/.{uuid.uuid4().hex}")
        out = self.fs.create(part)
        out.write(json.dumps(tables).encode())
        out.close()
        place = self.hadoop.Path(f"{self.base}/_snapshots/{number + 1:012d}")
        if self.fs.exists(place) or not self.fs.rename(part, place):
            raise RuntimeError(f"snapshot {number + 1} of {self.base} exists: another rewrite was first")
        return number + 1

    def rewrite(self, changed: Mapping[str, tuple[DataFrame | Iterable[DataFrame] | Callable, Sequence[str]]],
                emptied: Mapping[str, Sequence[str]] | None = None, dealt: Collection[str] = (),
                layered: Collection[str] = ()) -> int:
        """Replace the partitions that the rows of each table hold (rows, partition columns); the
        other partitions stay as they are. All tables change at once. Rows may be given as a function of
        the rows that this rewrite has written for the tables before it, by name, and as frames that are written one after
        the other. ``emptied`` names
        partitions by table, as folders, that hold nothing but the new rows, and go when there are none. ``dealt`` names
        tables whose rows come dealt out by partition: they are written by the tasks that have them. ``layered`` names
        tables whose rows are added to those that their partitions hold."""
        number, tables = self.state()
        written: dict[str, DataFrame] = {}
        for name, (rows, partition_by) in changed.items():
            rows = rows(written) if callable(rows) else rows
            version = f"snapshot_version=w{uuid.uuid4().hex[:12]}"
            for turn in [rows] if isinstance(rows, DataFrame) else rows:
                laid = turn if name in dealt else turn.hint("rebalance", *partition_by)
                with sql_conf(self.spark, FREE_SHUFFLES | (OPEN_FILES if name in dealt else {})):
                    laid.write.mode("append").partitionBy(*partition_by).parquet(f"{self.base}/{name}/{version}")
                rows = turn
            found = self.fs.globStatus(self.hadoop.Path(f"{self.base}/{name}/{version}/" + "/".join(f"{c}=*" for c in partition_by)))
            root = self.fs.makeQualified(self.hadoop.Path(f"{self.base}/{name}/{version}")).toString() + "/"
            new = {s.getPath().toString().removeprefix(root): f"{name}/{version}" for s in found}
            gone = set((emptied or {}).get(name, ()))
            kept = {p: v for p, v in tables.get(name, {"folders": {}})["folders"].items() if p not in gone}
            if name in layered:
                new = {p: [*_places(kept[p]), v] if p in kept else v for p, v in new.items()}
            tables[name] = {"schema": rows.schema.json(), "folders": {**kept, **new}}
            written[name] = self.spark.read.schema(rows.schema).parquet(f"{self.base}/{name}/{version}").select(*rows.columns)
        return self._commit(number, tables)

    def read(self, name: str) -> DataFrame:
        entry = self.state()[1][name]
        schema = StructType.fromJson(json.loads(entry["schema"]))
        paths = [f"{self.base}/{place}/{part}" for part, folders in sorted(entry["folders"].items()) for place in _places(folders)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.base}/{name}").parquet(*paths)
        return rows.select(*schema.fieldNames())

    def layers(self, name: str, partitions: Collection[str]) -> int:
        """The most layers that one of these partitions has."""
        folders = self.state()[1].get(name, {"folders": {}})["folders"]
        return max([len(_places(folders[p])) for p in partitions if p in folders], default=0)

    def expire(self, name: str, ttl_days: int, as_of: dt.date) -> list[str]:
        """Leave out the partitions (first partition column: a date) that are ``ttl_days`` old or older. No row is
        read or written; the folders stay for readers of earlier snapshots."""
        number, tables = self.state()
        last = as_of - dt.timedelta(days=ttl_days)
        folders = tables[name]["folders"]
        old = [p for p in folders if dt.date.fromisoformat(p.split("/")[0].split("=")[1]) <= last]
        if old:
            tables[name]["folders"] = {p: v for p, v in folders.items() if p not in set(old)}
            self._commit(number, tables)
        return sorted(old)
