"""Calendar keys and date windows (Column -> Column).

Every window is computed from an explicit ``as_of`` date, never from the clock, so a run can
be reproduced. The ``as_of`` literal is folded to a constant by Catalyst, which lets the
resulting predicates reach the parquet scan (PushedFilters) and partition pruning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_date(as_of: dt.date | str) -> Column:
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def month_key(d: Column | str) -> Column:
    """``YYYYMM`` as a long (``FORMAT_DATE('%Y%m', d)`` cast to INT64)."""
    d = F.col(d) if isinstance(d, str) else d
    return (F.year(d) * 100 + F.month(d)).cast("long")


def month_key_str(d: Column | str) -> Column:
    """``YYYYMM`` as a string."""
    d = F.col(d) if isinstance(d, str) else d
    return F.date_format(d, "yyyyMM")


def day_key(d: Column | str) -> Column:
    """``YYYYMMDD`` as a long."""
    d = F.col(d) if isinstance(d, str) else d
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long")


def month_start(key: Column | str) -> Column:
    """First day of the month of a ``YYYYMM`` key (string or long)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.to_date(key.cast("string"), "yyyyMM")


def month_start_of_long(key: Column | str, parsed: Column) -> Column:
    """``parsed``, the date of a ``YYYYMM`` key; of a valid long key it comes from its digits, without parsing a text."""
    key = F.col(key) if isinstance(key, str) else key
    year, month = (key / 100).cast("int"), (key % 100).cast("int")
    return F.when(key.between(100000, 999999) & month.between(1, 12), F.make_date(year, month, F.lit(1))).otherwise(parsed)


def month_start_datetime(key: Column | str) -> Column:
    """First instant of the month of a ``YYYYMM`` key as a timestamp without zone
    (``PARSE_DATETIME('%Y%m', key)``)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.to_timestamp_ntz(key.cast("string"), F.lit("yyyyMM"))


def date_from_day_key(key: Column | str) -> Column:
    """Date of a ``YYYYMMDD`` key (string or long)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.to_date(key.cast("string"), "yyyyMMdd")


def prev_month_start(as_of) -> Column:
    """First day of the month before ``as_of``."""
    return F.add_months(F.trunc(lit_date(as_of), "MM"), -1)


def prev_month_end(as_of) -> Column:
    """Last day of the month before ``as_of``."""
    return F.last_day(F.add_months(lit_date(as_of), -1))


def months_back(as_of, n: int) -> Column:
    """``as_of`` moved ``n`` months back; end of month clamps (31 Mar - 1 month = 28/29 Feb)."""
    return F.add_months(lit_date(as_of), -n)


def in_prev_month(d: Column | str, as_of) -> Column:
    """Whole previous month, first..last day inclusive."""
    d = F.col(d) if isinstance(d, str) else d
    start = prev_month_start(as_of)
    return d.between(start, F.last_day(start))


def trailing_whole_months(d: Column | str, as_of, n: int) -> Column:
    """``n`` whole months ending with the month before ``as_of``."""
    d = F.col(d) if isinstance(d, str) else d
    return d.between(F.trunc(months_back(as_of, n), "MM"), prev_month_end(as_of))


def month_key_window(key: Column | str, as_of, back: int, forward_to: int = 0) -> Column:
    """``YYYYMM`` key between month(as_of - back months) and month(as_of - forward_to months)."""
    key = F.col(key) if isinstance(key, str) else key
    return key.cast("long").between(month_key(months_back(as_of, back)),
                                     month_key(months_back(as_of, forward_to)))


def date_window(d: Column | str, as_of, back_months: int) -> Column:
    """Date between ``as_of - back_months`` and ``as_of`` inclusive."""
    d = F.col(d) if isinstance(d, str) else d
    return d.between(months_back(as_of, back_months), lit_date(as_of))
