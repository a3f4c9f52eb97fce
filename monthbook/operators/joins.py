"""Lagged left joins of a population with feature tables.

For a lag of K months a population row of month M takes the features of month M - K.
Here the *feature* month is moved forward by K instead, so every feature table is joined on
the same two columns.  The population is shuffled once, and stays where it is through a
whole chain of joins.  Months are handled all in one job; a list of months becomes a
literal filter on each table's own month column, so only the needed partitions are read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from monthbook.functions.months import month_literal, shift_month, shift_month_col
from monthbook.operators.skew import (
    MIN_ROWS, each_copy, left_join, level, look, salted_join, spread_rows)
from monthbook.sources.tables import FeatureKeys, numeric_columns, resolve_keys

_KEYS = ["__doc", "__month"]


def _only_months(df: DataFrame, column: str, months: Sequence[str | int] | None,
                 lag: int = 0) -> DataFrame:
    if months is None:
        return df
    dtype = df.schema[column].dataType
    wanted = [month_literal(shift_month(m, -lag), dtype) for m in months]
    return df.where(F.col(column).isin(wanted))


def feature_columns(df: DataFrame, keys: FeatureKeys,
                    wanted: Sequence[str] | None = None) -> list[str]:
    """Features to take: all but the keys, or the wanted ones that exist."""
    present = [c for c in df.columns if c not in (keys.doc, keys.month)]
    if wanted is None:
        return present
    unknown = [c for c in wanted if c not in df.columns]
    if unknown:
        warnings.warn(f"{keys.table}: no such features {unknown}, left out", stacklevel=2)
    return [c for c in wanted if c in df.columns]


def _feature_side(df: DataFrame, keys: FeatureKeys, months: Sequence[str | int] | None,
                  doc: Column, columns: Sequence[str]) -> DataFrame:
    month = shift_month_col(F.col(keys.month), keys.lag) if keys.lag else (
        F.col(keys.month).cast("string"))
    return _only_months(df, keys.month, months, keys.lag).select(
        doc.alias("__doc"), month.alias("__month"),
        *[F.col(c).alias(f"{keys.table}_{c}") for c in columns])


def _join_all(population: DataFrame, doc: str, month: str,
              tables: Iterable[tuple[DataFrame, FeatureKeys, Sequence[str]]],
              months: Sequence[str | int] | None, **skew: int) -> DataFrame:
    """Left joins in a row; ``min_rows`` sets when a key is hot, see ``look``."""
    tables = list(tables)
    kinds = {population.schema[doc].dataType,
             *[df.schema[k.doc].dataType for df, k, _ in tables]}
    # One key type for the whole chain: the native one if all agree, else text.
    def key(c: str) -> Column:
        return F.col(c) if len(kinds) == 1 else F.col(c).cast("string")

    left = _only_months(population, month, months).select(
        key(doc).alias("__doc"), F.col(month).cast("string").alias("__month"), "*")
    sides = [(_feature_side(df, keys, months, key(keys.doc), columns), keys.unique)
             for df, keys, columns in tables]
    kept = [c for c in population.columns if c != month]
    added = [f"{k.table}_{c}" for _, k, columns in tables for c in columns]
    return _join_sides(left, sides, [*kept, *added, month], skew)


def _join_sides(left: DataFrame, sides: Sequence[tuple[DataFrame, bool]],
                out: Sequence[str], skew: Mapping[str, int]) -> DataFrame:
    min_rows = skew.get("min_rows", MIN_ROWS)
    seen = look(left, _KEYS, min_rows)
    lost = None
    if seen.without_key >= min_rows:
        # Rows without a key match nothing.  Many of them must not meet in one task.
        missing = F.col("__doc").isNull() | F.col("__month").isNull()
        lost = left.where(missing).select(*[c for c in out if c in left.columns])
        left = left.where(~missing)
    if not seen:
        joined = _chain(left, sides, _KEYS, skew).select(*out)
    else:
        # Hot documents of the population go their own way, shared out over salts.
        salt, copies = level(_KEYS)
        cold_left, warm_left = seen.split(left, _KEYS, min_rows)
        cold = _chain(cold_left, sides, _KEYS, skew)
        warm = spread_rows(warm_left, salt, copies)
        for side, unique in sides:
            warm = salted_join(warm, seen.split(side, _KEYS, min_rows)[1], _KEYS, salt,
                               right_unique=unique, min_rows=min_rows)
        joined = cold.select(*out).unionByName(each_copy(warm, out, copies))
    return joined if lost is None else joined.unionByName(lost, allowMissingColumns=True)


def _chain(left: DataFrame, sides: Sequence[tuple[DataFrame, bool]], keys: Sequence[str],
           skew: Mapping[str, int]) -> DataFrame:
    for side, unique in sides:
        left = left_join(left, side, keys, right_unique=unique, **skew)
    return left


def lagged_join(population: DataFrame, features: DataFrame, keys: FeatureKeys, *,
                doc: str, month: str, months: Sequence[str | int] | None = None,
                columns: Sequence[str] | None = None, **skew: int) -> DataFrame:
    """The population with one feature table at its lag.

    Every population row is kept; several feature rows for one key give several rows.
    """
    keys = resolve_keys(features, keys)
    chosen = feature_columns(features, keys, columns)
    return _join_all(population, doc, month, [(features, keys, chosen)], months, **skew)


def master_table(population: DataFrame, features: Mapping[str, DataFrame],
                 keys: Sequence[FeatureKeys], feature_map: Mapping[str, Sequence[str]], *,
                 doc: str, month: str, months: Sequence[str | int] | None = None,
                 **skew: int) -> DataFrame:
    """The population with the listed features of many tables, each at its own lag.

    Tables that are not in both the control table and the feature map are skipped.
    """
    chosen = []
    for k in keys:
        if k.table in feature_map:
            table = features[k.table]
            known = resolve_keys(table, k)
            chosen.append((table, known, feature_columns(table, known, feature_map[k.table])))
    return _join_all(population, doc, month, chosen, months, **skew)


def document_root(document: Column, digits: int = 8, pad: bool = False) -> Column:
    """First digits of a document number; ``pad`` first restores 11 digits."""
    text = document.cast("string")
    return F.substring(F.lpad(text, 11, "0") if pad else text, 1, digits)


def numeric_feature_join(population: DataFrame, features: DataFrame, keys: FeatureKeys, *,
                         doc: str = "cpf", target: str = "y", month: str = "anomes",
                         months: Sequence[str | int] | None = None,
                         pad: bool = False, **skew: int) -> DataFrame:
    """Document, target and all number columns of a feature table as doubles.

    With ``doc_digits`` 8 the table is keyed by the first eight digits of the document,
    with 11 by the whole of it; any other length raises ``ValueError``.
    """
    keys = resolve_keys(features, keys)
    numbers = numeric_columns(features, (keys.doc, keys.month))
    if keys.doc_digits == 8:
        left_key, right_key = document_root(F.col(doc), pad=pad), F.col(keys.doc).cast("string")
    elif keys.doc_digits == 11:
        same = population.schema[doc].dataType == features.schema[keys.doc].dataType
        kind = population.schema[doc].dataType if same else "string"
        left_key, right_key = F.col(doc).cast(kind), F.col(keys.doc).cast(kind)
    else:
        raise ValueError(f"{keys.table}: no join for documents of {keys.doc_digits} digits")
    left = _only_months(population, month, months).select(
        left_key.alias("__doc"), F.col(month).cast("string").alias("__month"),
        F.col(doc).alias("cpf_publico_target"), target, month)
    right = _only_months(features, keys.month, months, keys.lag).select(
        right_key.alias("__doc"),
        shift_month_col(F.col(keys.month), keys.lag).alias("__month"),
        *[F.col(c).cast("double").alias(f"__f_{c}") for c in numbers])
    made = [f"__f_{c}" for c in numbers]
    joined = _join_sides(left, [(right, keys.unique)],
                         ["cpf_publico_target", target, *made, month], skew)
    return joined.withColumnsRenamed(dict(zip(made, numbers)))
