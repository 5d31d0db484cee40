"""Reading inputs and cutting lineage for the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.session import scratch_path


#: Bytes of the record batches that tasks exchange with Python: with blocks of text this bounds a task.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared scratch space and read it back: later steps
    start from the files, also after the loss of executors, and know no partitioning that would
    keep adaptive execution from splitting a skewed join."""
    bounded_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Words of 64 marks that stand for the keys of a table: a fixed number, so their broadcast is bounded.
MARK_WORDS = 1 << 18


def _bit(key: Column) -> Column:
    return F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(63)).cast("int")


def sifted(rows: DataFrame, key: Column, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose ``key`` (64-bit hash) may be among the keys of ``wanted`` (its
    column ``key``), and the others, which are not. Marks of the wanted keys are broadcast, so neither part is shuffled; a
    join that must meet the wanted rows then shuffles the first part alone. Marks are shared by several keys
    when there are very many, so the first part can only be too large."""
    word, bit = F.pmod(key, F.lit(MARK_WORDS)), _bit(key)
    marks = wanted.select(F.pmod("key", F.lit(MARK_WORDS)).alias("__mark_word"),
                          F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("key"))).alias("__mark"))
    marks = F.broadcast(written(marks.groupBy("__mark_word").agg(F.bit_or("__mark").alias("__marks")), "marks"))
    marked = (word == F.col("__mark_word")) & F.call_function("getbit", F.col("__marks"), bit).cast("boolean")
    return rows.join(marks, marked, "left_semi"), rows.join(marks, marked, "left_anti")
