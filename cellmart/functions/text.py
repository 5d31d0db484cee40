"""Text helpers (Column -> Column). All are built-in expressions that stay inside
whole-stage codegen; none starts a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set that warehouse TRIM removes (space, tab, LF, CR, FF, VT).
WHITESPACE = " \t\n\r\f\u000b"

# Fixed value: the word pattern of the word-extraction step.
WORD_PATTERN = r"[A-Za-z']+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Strip whitespace at both ends. Spark's ``trim`` strips spaces only."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def zero_prefix(c: Column | str) -> Column:
    """Prefix ``0`` unless the value already starts with it; NULL stays NULL."""
    c = _col(c)
    return F.when(~c.like("0%"), F.concat(F.lit("0"), c)).otherwise(c)


def safe_long(c: Column | str) -> Column:
    """SAFE_CAST(c AS INT64): NULL instead of an error on bad input."""
    return _col(c).try_cast("long")


def tokenise(c: Column | str) -> Column:
    """Array of the words of a text."""
    return F.regexp_extract_all(_col(c), F.lit(WORD_PATTERN), F.lit(0))


def quote_regex(sep: str) -> str:
    """Regex that matches ``sep`` literally (split takes a pattern)."""
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def split_cells(c: Column | str, sep: str) -> Column:
    """Split a raw line on a literal separator; quotes are not interpreted."""
    return F.split(_col(c), quote_regex(sep), -1)
