"""Book of the latest month: choose the month, validate, build, check, write."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from monthbook.functions.months import previous_month
from monthbook.operators.book import BookSpec, feature_book
from monthbook.operators.quality import (
    duplicate_keys, latest_partition, null_percent, validation_report)
from monthbook.session import cut_lineage
from monthbook.sources.tables import read_written, write_book


@dataclass(frozen=True)
class BookRun:
    """A built book with its quality tables."""

    ref: str
    book: DataFrame
    validation: DataFrame
    duplicates: DataFrame
    mostly_null: DataFrame


def reference_month(df: DataFrame, month: str = "anomes", ref: str | None = None,
                    latest: bool = False, today: dt.date | None = None) -> str:
    """The newest month of the table, the given one, or the previous calendar month."""
    if latest:
        return str(latest_partition(df, month).first()[0])
    return ref or previous_month(today)


def run_book(df: DataFrame, spec: BookSpec, ref: str | None = None, *, latest: bool = False,
             out: str | None = None, null_limit: float = 50.0,
             today: dt.date | None = None) -> BookRun:
    """Builds a book once, then checks it; with ``out`` it is written and read back."""
    chosen = reference_month(df, spec.month, ref, latest, today)
    book = feature_book(df, spec, chosen)
    if out is None:
        built = cut_lineage(book)
    else:
        write_book(book, out)
        built = read_written(df.sparkSession, out, book.schema)
        built = built.where(built.dt_referencia == chosen).select(*book.columns)
    return BookRun(chosen, built, validation_report(df, spec.key, spec.month, chosen),
                   duplicate_keys(built, spec.key), null_percent(built, over=null_limit))
