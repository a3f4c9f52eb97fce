"""Join pipelines: many feature tables, many months, re-runnable outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from monthbook.operators.joins import lagged_join, master_table, numeric_feature_join
from monthbook.operators.quality import master_validation
from monthbook.sources.tables import (
    FeatureKeys, numeric_columns, read_written, replace_partitions, resolve_keys, store)


def join_pipeline(population: DataFrame, features: Mapping[str, DataFrame],
                  keys: Sequence[FeatureKeys], *, doc: str, month: str,
                  months: Sequence[str | int] | None, out: str,
                  prefix: str = "ft", database: str | None = None) -> dict[str, str]:
    """One month-partitioned output per feature table: ``{table: path}``.

    The months of a table are replaced at once; a month that comes out empty loses what an earlier
    run wrote.  With a ``database`` the outputs are tables of the catalogue, with their files below
    ``out``, and their names are returned; new features become new columns.  Paths are read with
    ``mergeSchema`` if features were added between runs.
    """
    made = {}
    for k in keys:
        joined = lagged_join(population, features[k.table], k, doc=doc, month=month,
                             months=months)
        name = f"{prefix}_{k.table}_joined"
        if database is not None:
            made[k.table] = f"{database}.{name}"
            store(joined, made[k.table], month, f"{out}/{name}", months)
            continue
        made[k.table] = f"{out}/{name}"
        replace_partitions(joined, made[k.table], month, months)
    return made


def master_pipeline(population: DataFrame, features: Mapping[str, DataFrame],
                    keys: Sequence[FeatureKeys], feature_map: Mapping[str, Sequence[str]], *,
                    doc: str, month: str, months: Sequence[str | int] | None,
                    out: str, table: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes the master table; returns it, read back, with its validation row.

    With ``table`` it is a table of the catalogue, with its files in ``out``.
    """
    joined = master_table(population, features, keys, feature_map, doc=doc, month=month,
                          months=months)
    if table is not None:
        written = store(joined, table, month, out, months)
        return written, master_validation(written, month)
    replace_partitions(joined, out, month, months)
    written = read_written(population.sparkSession, out, joined.schema)
    return written, master_validation(written, month)


def output_name(population: str, table: str) -> str:
    """``population_table``, without the database of the table."""
    return f"{population}_{table.rsplit('.', 1)[-1]}"


def numeric_join_pipeline(population: DataFrame, features: Mapping[str, DataFrame],
                          keys: Sequence[FeatureKeys], *,
                          months: Sequence[str | int] | None, out: str, name: str, doc: str = "cpf", target: str = "y",
                          month: str = "anomes") -> DataFrame:
    """Numeric feature joins of many tables; a failure stops neither month nor table.

    Returns one row per table and month: ``table, output, month, status, rows, error``.
    Each table is one job.  Only if that fails are its months tried one at a time.  Without
    ``months`` all months of the population are joined.  A month that comes out empty has 0
    rows, and loses what an earlier run wrote for it.
    """
    spark = population.sparkSession
    if months is None:
        months = sorted(r[0] for r in population.select(F.col(month).cast("string")).distinct()
                        .collect() if r[0] is not None)
    reports = []
    for k in keys:
        path = f"{out}/{output_name(name, k.table)}"
        groups, note = [list(months)], None
        if k.table not in features:
            note = ("failed", "no such table")
        elif not numeric_columns(features[k.table], _key_columns(features[k.table], k)):
            note = ("skipped", "no numeric column")
        elif k.doc_digits not in (8, 11):
            note = ("skipped", f"documents of {k.doc_digits} digits")
        if note is None:
            try:
                reports.append(_write_months(population, features[k.table], k, groups[0],
                                             path, doc, target, month))
                continue
            except Exception:  # noqa: BLE001 - find out which months are at fault
                groups = [[m] for m in months]
        for group in groups:
            state = note
            if state is None:
                try:
                    reports.append(_write_months(population, features[k.table], k, group,
                                                 path, doc, target, month))
                    continue
                except Exception as error:  # noqa: BLE001 - reported, not raised
                    state = ("failed", str(error))
            rows = [(k.table, path, str(m), state[0], None, state[1]) for m in group]
            reports.append(spark.createDataFrame(rows, _STATUS))
    status = reports[0]
    for one in reports[1:]:
        status = status.unionByName(one)
    return status


def _key_columns(df: DataFrame, keys: FeatureKeys) -> tuple[str, str]:
    known = resolve_keys(df, keys)
    return known.doc, known.month


_STATUS = "table string, output string, month string, status string, rows long, error string"


def _write_months(population: DataFrame, features: DataFrame, k: FeatureKeys,
                  months: Sequence[str | int], path: str, doc: str, target: str,
                  month: str) -> DataFrame:
    joined = numeric_feature_join(population, features, k, doc=doc, target=target,
                                  month=month, months=months)
    replace_partitions(joined, path, month, months)
    spark = population.sparkSession
    counted = (read_written(spark, path, joined.schema)
               .where(F.col(month).cast("string").isin([str(m) for m in months]))
               .groupBy(F.col(month).cast("string").alias("month"))
               .agg(F.count(F.lit(1)).alias("rows")))
    asked = spark.createDataFrame([(str(m),) for m in months], "month string")
    return asked.join(counted, "month", "left").select(
        F.lit(k.table).alias("table"), F.lit(path).alias("output"), "month",
        F.lit("done").alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"),
        F.lit(None).cast("string").alias("error"))
