"""Incremental landing ingest: each file is loaded once across runs; consumed files are archived."""

import glob
import os

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cellmart.streaming.landing import landing_stream, run_once

SCHEMA = StructType([StructField("date_of_call", LongType()), StructField("msisdn", StringType()),
                     StructField("calls", LongType())])


def _land(d, name, lines):
    with open(os.path.join(d, name), "w") as f:
        f.write("date_of_call|msisdn|calls\n" + "".join(line + "\n" for line in lines))


def _transform(rows):
    return rows.select(F.to_date(F.col("date_of_call").cast("string"), "yyyyMMdd").alias("call_date"),
                       "date_of_call", F.trim("msisdn").alias("msisdn"), "calls")


def test_each_file_once_across_runs(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    ckpt, archive = str(tmp_path / "ckpt"), str(tmp_path / "archive")
    os.makedirs(landing)
    _land(landing, "day1.dat", ["20210701| 071|3", "20210701|072|4"])

    def run():
        run_once(landing_stream(spark, landing, SCHEMA, target, ckpt, archive, transform=_transform))
        return spark.read.parquet(target)

    first = run()
    assert first.count() == 2
    _land(landing, "day2.dat", ["20210702|073|5"])
    second = run()
    assert second.count() == 3
    assert sorted(r.msisdn for r in second.collect()) == ["071", "072", "073"]
    third = run()                      # nothing new landed
    assert third.count() == 3
    # The file source archives consumed files one micro-batch later.
    archived = glob.glob(os.path.join(archive, "**", "*.dat"), recursive=True)
    assert any(p.endswith("day1.dat") for p in archived)
