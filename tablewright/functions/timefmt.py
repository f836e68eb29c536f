"""Epoch-millisecond text formatting (F6) and the year sanity filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference behaviour:
#   text layout: yyyy-MM-dd'T'HH:mm:ss.SSS followed by "+" and the
#   millisecond-of-second padded to four digits (e.g. 20.123+0123);
#   earliest accepted year of the sanity filter: 1990
EPOCH_TEXT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS"
FIRST_VALID_YEAR = 1990


def _as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis(ts: str | Column) -> Column:
    """Epoch milliseconds of a timestamp (microseconds truncated)."""
    return F.unix_millis(_as_column(ts).cast("timestamp"))


def epoch_millis_text(millis: str | Column) -> Column:
    """epoch milliseconds → ``yyyy-MM-dd'T'HH:mm:ss.SSS+0SSS``.

    The tail after ``+`` is not a zone offset: it repeats the millisecond of
    the second, padded to four digits.  Wall time is in the session zone.
    """
    m = _as_column(millis).cast("long")
    head = F.date_format(F.timestamp_millis(m), EPOCH_TEXT_PATTERN)
    tail = F.lpad(F.pmod(m, F.lit(1000)).cast("string"), 4, "0")
    return F.concat(head, F.lit("+"), tail)


def filter_year_range(df: DataFrame, cols: Iterable[str | Column], first_year: int = FIRST_VALID_YEAR) -> DataFrame:
    """Keep rows whose every given timestamp lies in [first_year, current year].

    A NULL timestamp drops the row (the predicate is NULL, not true).
    """
    cols = list(cols)
    if not cols:
        return df
    last = F.year(F.current_date())
    conds = [F.year(_as_column(c)).between(F.lit(first_year), last) for c in cols]
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return df.filter(cond)
