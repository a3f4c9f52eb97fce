"""Books from stored months: a book for the next month reads one new month of the source.

The state of a month holds, per customer, the few parts that all features are made of (sums, counts,
extremes, centred squares, hits, sketches) and one row per distinct value of each categorical column.
It is written in a folder per month.  A book for any reference month is put together from the state of
its widest window; only months that the state lacks, or that are to be made again because late rows
came, are read from the source.  The results are those of :func:`~monthbook.operators.book.feature_book`.

A month is replaced as a whole, so making it twice changes nothing.  Features added to a specification
later are NULL or 0 for months whose state was made before; make those months again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.functions.months import month_literal, window_start, shift_month
from monthbook.operators.book import (
    _WHICH, BookSpec, _counts_values, _exploded, _finish_items, _FROM_MONTHS, _month_features,
    _Rollup, _smallest, _stamps, _windows, check_aggregations)
from monthbook.sources.tables import replace_partitions


def _check(spec: BookSpec) -> None:
    check_aggregations(spec.aggregations)
    lost = [a for a in spec.aggregations if a not in _FROM_MONTHS]
    if lost or spec.extra:
        raise ValueError(f"not made of months: {lost or 'extra features'}")


def _prepared(spec: BookSpec, df: DataFrame, ref: str, flags: bool, sums: dict) -> tuple:
    """The rollup with all its parts, the windows and the features of a book."""
    rollup, windows = _Rollup([spec.key], sums), _windows(df, spec, ref)
    return rollup, windows, _month_features(rollup, spec, windows, flags)


def month_state(df: DataFrame, spec: BookSpec) -> DataFrame:
    """The state of every month in ``df``: parts per customer, and the values seen.

    One read and one aggregate; ``__which`` is -1 for parts and the column's number for values.
    """
    _check(spec)
    rows = df
    if spec.where is not None:
        rows = rows.where(F.expr(spec.where) if isinstance(spec.where, str) else spec.where)
    rollup, _, _ = _prepared(spec, df, "200001", True, {})
    rollup.parts.rows()  # a customer may have rows without any measure
    if not _counts_values(spec):
        return rollup.monthly(rows, [spec.key, spec.month]).withColumns(
            {_WHICH: F.lit(-1), "__value": F.lit(None).cast("string")})
    items = _exploded(rows, spec, F.lit(0), keep=[spec.month])
    return rollup.monthly(items, [spec.key, spec.month, _WHICH, "__value"])


def save_state(df: DataFrame, spec: BookSpec, path: str, months: Sequence[str | int]) -> None:
    """Makes the state of some months (again); nothing else is read or changed."""
    dtype = df.schema[spec.month].dataType
    rows = df.where(F.col(spec.month).isin([month_literal(m, dtype) for m in months]))
    replace_partitions(month_state(rows, spec), path, spec.month, list(months))


def state_months(spark: SparkSession, path: str, month: str = "anomes") -> list[str]:
    """The months a state holds, in order."""
    try:
        found = spark.read.parquet(path).select(F.col(month).cast("string")).distinct().collect()  # months
    except AnalysisException:
        return []
    return sorted(r[0] for r in found)


def book_from_state(state: DataFrame, spec: BookSpec, ref: str, flags: bool = False) -> DataFrame:
    """One row per key with every feature of ``spec`` as of month ``ref``, from stored months."""
    _check(spec)
    known = {f.name: f.dataType for f in state.schema.fields}
    sums = {v: known[f"__s_{v}"] for v in spec.numeric if f"__s_{v}" in known}
    rollup, windows, features = _prepared(spec, state, ref, flags, sums)
    dtype = state.schema[spec.month].dataType
    first = month_literal(window_start(ref, max(spec.windows)), dtype)
    names = rollup.parts.columns
    rows = state.where(F.col(spec.month).between(first, month_literal(ref, dtype))).select(
        spec.key, spec.month, _WHICH, "__value", *[F.col(f"`{n}`") for n in names])
    if _counts_values(spec):
        raw = F.col(_WHICH) < 0
        marked = rows.select(spec.key, _WHICH, "__value", *[F.col(f"`{n}`") for n in names],
                             F.when(raw, F.col(spec.month)).alias(spec.month),
                             F.when(~raw, _smallest(windows)).alias("__w"))
        # A (key, month) has one row of parts; a value may have one for each month it was seen in.
        reduced = marked.groupBy(spec.key, spec.month, _WHICH, "__value").agg(
            *[F.first(f"`{n}`", ignorenulls=True).alias(n) for n in names], F.min("__w").alias("__w"))
        book = _finish_items(rollup, reduced, spec, windows, features, ref)
    elif features:
        book = rollup.finish(rows.drop(_WHICH, "__value"), features)
    else:
        book = rows.select(spec.key).distinct()
    made = [F.col(f"`{c}`") for c in book.columns if c != spec.key]
    return book.select(spec.key, *_stamps(spec, ref), *made)


def advance(df: DataFrame, spec: BookSpec, path: str, ref: str, again: Sequence[str] = (),
            flags: bool = False) -> DataFrame:
    """The book of month ``ref``; brings the state below ``path`` up to it first.

    Of the source only the months of the window that the state lacks are read, ``ref`` and the
    months listed in ``again``.
    """
    spark = df.sparkSession
    window = [shift_month(ref, -k) for k in range(max(spec.windows))]
    known = set(state_months(spark, path, spec.month))
    wanted = {str(ref), *map(str, again)} | {m for m in window if m not in known}
    save_state(df, spec, path, sorted(wanted))
    return book_from_state(spark.read.parquet(path), spec, ref, flags)
