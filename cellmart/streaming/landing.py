"""Incremental landing ingest with Structured Streaming.

The reference polls a landing folder daily, loads what arrived and moves the consumed files
to a backup prefix. The Spark form is one file-source stream: each file is read exactly
once (tracked in the checkpoint), rows are transformed with the same column expressions as
the batch load and appended to the final table, and consumed files are archived by the
source (``cleanSource=archive``). ``trigger(availableNow=True)`` turns it into a scheduled
job that processes everything landed so far and stops; the checkpoint makes a restarted or
repeated run pick up only new files, and a lost executor only replays its micro-batch.

Archiving runs one micro-batch behind: files of the last batch move on the next run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cellmart.sources.delimited import delimited_options


def landing_stream(spark: SparkSession, directory: str, schema: StructType, target: str,
                   checkpoint: str, archive: str | None = None, *, sep: str = "|",
                   transform: Callable[[DataFrame], DataFrame] | None = None,
                   partition_by=(), max_files_per_trigger: int = 100) -> StreamingQuery:
    reader = delimited_options(spark.readStream.schema(schema), sep).option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = reader.csv(directory)
    if transform is not None:
        rows = transform(rows)
    writer = (rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .outputMode("append").trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(target)


def run_once(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
