"""Exact deduplication by progressive refinement (DataFrame functions only).

Texts are equal when they are identical after deleting ASCII white space. Three filters of
rising cost decide which rows can have a copy at all:

1. rows are grouped by the length of the normalised text,
2. rows of a shared length by a hash of its first characters,
3. rows that share both are read again in full and grouped by SHA-256.

Only rows that pass one filter reach the next; the full text is hashed for survivors alone.
Counts combine in the map tasks, so a group that holds a third of all rows costs one record
per task. Group tables are written and read back before rows are joined to them: the joins then
sit on two plain exchanges and adaptive execution splits a hot key over many tasks.

Defined results: a null text counts as empty; all empty texts are equal. Among equal texts the
row with the most code points in the original text stays, then the smallest id; a null id comes
after all others. Rows that repeat an id and a text are one document: they stay or go together
and each counts in the group's size. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import sifted, written

#: ASCII white space, 20 and 09-0D.
SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """The text without its ASCII white space; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for char in SPACE:
        out = F.replace(out, F.lit(char), F.lit(""))
    return out


def _signature(df: DataFrame, id_col: str, text_col: str, prefix_chars: int) -> DataFrame:
    return df.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), normalised(F.col(text_col)).alias("_norm"),
    ).select(
        "_id", "_norm", F.coalesce(F.length("_text"), F.lit(0)).alias("_chars"), F.length("_norm").alias("_len"),
        F.xxhash64(F.substring("_norm", 1, prefix_chars)).alias("_prefix"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: the id, ``keep_id``, ``group_size``, ``kept``, the key columns
    ``norm_chars`` and ``prefix_hash``, and the columns of ``carry`` (expressions over the
    normalised text, given as functions of the column ``_norm``)."""
    carry = carry or {}
    extra = [column.alias(name) for name, column in carry.items()]
    keys = ["_len", "_prefix"]

    rows = _signature(df, id_col, text_col, prefix_chars)
    thin = written(rows.select("_id", *keys, *extra), "dedup-signatures")

    # 1: lengths that occur more than once; 2: prefixes that do so within such a length.
    lengths = thin.groupBy("_len").agg(F.count("*").alias("_n")).where("_n > 1").select("_len")
    prefixes = (thin.join(written(lengths, "dedup-lengths"), "_len", "left_semi")
                .groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys))
    prefixes = written(prefixes, "dedup-prefixes")

    # 3: full content of the survivors.
    survivors = thin.join(prefixes, keys, "left_semi").select("_id", *keys)
    same = (F.col("r._id").eqNullSafe(F.col("s._id")) & (F.col("r._len") == F.col("s._len"))
            & (F.col("r._prefix") == F.col("s._prefix")))
    # Texts of other rows are not shuffled.
    near, _ = sifted(rows, F.xxhash64(*keys), prefixes.select(F.xxhash64(*keys).alias("key")))
    full = near.alias("r").join(survivors.alias("s"), same, "left_semi").select(
        "_id", *keys, "_chars", F.sha2("_norm", 256).alias("_hash"), *extra)
    full = written(full, "dedup-survivors")
    most = full.groupBy("_hash").agg(F.count("*").alias("_size"), F.max("_chars").alias("_chars")).where("_size > 1")
    most = written(most, "dedup-groups")
    # A null id comes last, so it stays only where no other row of the same length could.
    keep = (full.join(most, ["_hash", "_chars"]).groupBy("_hash")
            .agg(F.min("_id").alias("_keep"), F.max("_size").alias("_size")))
    keep = written(keep, "dedup-keepers")

    out = ["_id", "_keep", "_size", *keys, *carry]
    single = thin.join(prefixes, keys, "left_anti").select(
        "*", F.col("_id").alias("_keep"), F.lit(1).cast("long").alias("_size")).select(*out)
    grouped = full.join(keep, "_hash", "left").select(
        "_id", F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep")).alias("_keep"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("_size"), *keys, *carry)
    return single.unionByName(grouped).select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.col("_len").alias("norm_chars"), F.col("_prefix").alias("prefix_hash"), *carry)


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with the columns of ``df``. Rows are judged by id and text: an id
    may be null or stand at other texts too."""
    gone = exact_dedup(df, id_col, text_col, carry={"__dedup_gone_hash": F.sha2("_norm", 256)}).where("NOT kept").select(
        F.col(id_col).alias("__dedup_gone"), "__dedup_gone_hash")
    gone = written(gone.distinct(), "dedup-dropped")
    # Rows whose id has no dropped text stay where they are.
    maybe, rest = sifted(df, F.xxhash64(id_col), gone.select(F.xxhash64("__dedup_gone").alias("key")))
    rows = maybe.withColumn("__dedup_hash", F.sha2(normalised(F.col(text_col)), 256))
    hit = F.col(id_col).eqNullSafe(F.col("__dedup_gone")) & (F.col("__dedup_hash") == F.col("__dedup_gone_hash"))
    return rest.unionByName(rows.join(gone, hit, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns]))
