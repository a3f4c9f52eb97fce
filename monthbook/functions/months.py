"""Months as ``yyyyMM`` text: trailing windows, lags and the previous calendar month.

Text months of this form sort in time order, so ``>=`` and ``between`` are safe on them.
Every rule exists twice: on plain values for the driver, where windows and lags become
literals that prune partitions, and as a column expression.
"""

from __future__ import annotations

import datetime as dt
import re
import warnings

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, IntegralType

_MONTH = re.compile(r"\d{6}")
_LAG = re.compile(r"\s*m\s*-\s*(\d+)\s*", re.IGNORECASE)


def shift_month(month: str | int, by: int) -> str:
    """``month`` moved ``by`` months; text that is no ``yyyyMM`` month is returned as it is."""
    text = str(month)
    if not _MONTH.fullmatch(text):
        return text
    year, zero_month = divmod(int(text[:4]) * 12 + int(text[4:]) - 1 + by, 12)
    return f"{year:04d}{zero_month + 1:02d}"


def window_start(ref: str | int, months: int) -> str:
    """First month of the window of ``months`` months that ends at, and includes, ``ref``."""
    return shift_month(ref, 1 - months)


def parse_lag(text: str | None) -> int:
    """Months of delay in ``'m-2'``; ``''``, ``None`` and ``'m'`` are 0, case is ignored."""
    if text is None or text.strip().lower() in ("", "m"):
        return 0
    found = _LAG.fullmatch(text)
    if found is None:
        warnings.warn(f"month lag {text!r} not understood, using 0", stacklevel=2)
        return 0
    return int(found.group(1))


def previous_month(today: dt.date | None = None) -> str:
    """The calendar month before ``today``."""
    return shift_month((today or dt.date.today()).strftime("%Y%m"), -1)


def month_literal(month: str | int, dtype: DataType) -> Column:
    """``month`` in the type of the column it is compared with, so that the scan can prune."""
    if isinstance(dtype, IntegralType):
        return F.lit(int(month)).cast(dtype)
    return F.lit(str(month))


def month_of(ts: Column | str) -> Column:
    """``yyyyMM`` of a date or timestamp column."""
    return F.date_format(ts, "yyyyMM")


def shift_month_col(month: Column, by: Column | int) -> Column:
    """Column form of :func:`shift_month`, in integer arithmetic (no date parsing)."""
    by = F.lit(by) if isinstance(by, int) else by
    text = month.cast("string")
    index = (F.substring(text, 1, 4).cast("int") * 12
             + F.substring(text, 5, 2).cast("int") - 1 + by)
    year = F.floor(index / 12).cast("int")
    shifted = F.lpad((year * 100 + F.pmod(index, F.lit(12)) + 1).cast("string"), 6, "0")
    return F.when(text.rlike("^[0-9]{6}$"), shifted).otherwise(text)


def window_start_col(month: Column, months: int) -> Column:
    """Column form of :func:`window_start`."""
    return shift_month_col(month, 1 - months)


def parse_lag_col(lag: Column) -> Column:
    """Column form of :func:`parse_lag` (no warning)."""
    digits = F.regexp_extract(lag, r"(?i)^\s*m\s*-\s*(\d+)\s*$", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).cast("int"), F.lit(0))


def previous_month_col(date: Column) -> Column:
    """Calendar month before each date."""
    return month_of(F.add_months(F.to_date(date), -1))
