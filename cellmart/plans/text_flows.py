"""Text flows: the CSV cleanse job, the ratings filter and word extraction.

All three are narrow, per-line column expressions (no shuffle) except the word count,
which aggregates with map-side combining, so a very frequent word is summed per task first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.functions.text import tokenise
from cellmart.sinks.writers import write_csv, write_text
from cellmart.sources.delimited import cleanse_csv, read_lines, split_fields


def run_cleanse(spark: SparkSession, input_glob: str, output: str, input_file_headers: str,
                output_file_header: str, primary_key: str = "", columns_to_remove: str = "",
                delimeter: str = ",", fill: str = "") -> DataFrame:
    """The cleanse job with its public parameters; writes a header + rows CSV and returns
    the cleansed frame."""
    df = cleanse_csv(spark, input_glob, input_file_headers, output_file_header,
                     primary_key=primary_key or None, drop=columns_to_remove, sep=delimeter, fill=fill)
    write_csv(df, output, sep=",", header=True)
    return df


def ratings_above(spark: SparkSession, input_glob: str, headers: Sequence[str], rating_field: int = 2,
                  threshold: float = 4.0) -> DataFrame:
    """Skip the header, split on commas, keep records whose rating field exceeds the
    threshold (a non-numeric rating fails the job, as ``float()`` does)."""
    fields = split_fields(read_lines(spark, input_glob), headers, ",", keep_count=False)
    return fields.filter(F.col(headers[rating_field]).cast("double") > F.lit(threshold))


def write_ratings(df: DataFrame, output: str) -> None:
    write_text(df, output, df.columns, sep=",")


def words(docs: DataFrame, text_col: str = "text", keep=()) -> DataFrame:
    """One row per word occurrence (letters and apostrophes)."""
    return docs.select(*keep, F.explode(tokenise(text_col)).alias("word"))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return words(docs, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))
