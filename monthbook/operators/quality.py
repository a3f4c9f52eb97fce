"""Data quality: validation reports, duplicates, missing values, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from monthbook.functions.months import month_literal
from monthbook.functions.scalars import safe_divide

# Texts of the duplicate check.
DUPLICATES_FOUND = "ALERTA: Existem registros duplicados"
NO_DUPLICATES = "OK: Sem duplicados"


def validation_report(df: DataFrame, key: str = "cpf", month: str = "anomes",
                      ref: str | None = None) -> DataFrame:
    """One row: rows, distinct keys, duplicates, months; of one month if ``ref`` is given.

    The two distinct counts run as one aggregate each, so no row is copied.
    """
    rows = df.select(key, month)
    if ref is not None:
        rows = rows.where(F.col(month) == month_literal(ref, df.schema[month].dataType))
    nothing = F.lit(None)
    by_month = rows.groupBy(month).agg(F.count(F.lit(1)).alias("n")).agg(
        nothing.cast("long").alias("keys"), F.sum("n").alias("n"),
        F.min(month).alias("first"), F.max(month).alias("last"), F.count(month).alias("months"))
    kind = rows.schema[month].dataType
    keys = rows.select(key).distinct().agg(F.count(key).alias("keys")).select(
        "keys", nothing.cast("long").alias("n"), nothing.cast(kind).alias("first"),
        nothing.cast(kind).alias("last"), nothing.cast("long").alias("months"))
    one = by_month.union(keys).agg(
        *[F.max(c).alias(c) for c in ("keys", "n", "first", "last", "months")])
    n, unique = F.coalesce("n", F.lit(0)), F.col("keys")
    return one.select(
        F.lit(ref).cast("string").alias("dt_referencia"),
        unique.alias("qtd_cpfs_unicos"), n.alias("qtd_total_registros"),
        (n - unique).alias("qtd_duplicados"),
        F.col("first").alias("primeira_particao"), F.col("last").alias("ultima_particao"),
        F.col("months").alias("qtd_particoes"),
        F.when(n - unique > 0, DUPLICATES_FOUND).otherwise(NO_DUPLICATES)
        .alias("status_duplicados"))


def latest_partition(df: DataFrame, month: str = "anomes") -> DataFrame:
    """The newest month, NULL months aside."""
    return df.where(F.col(month).isNotNull()).agg(F.max(month).alias("ultima_particao"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    counted = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
               for name, df in tables.items()]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out


def master_validation(df: DataFrame, month: str) -> DataFrame:
    """Total rows and number of months."""
    return (df.groupBy(month).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
                 F.count(month).alias("partitions")))


def partition_stats(df: DataFrame, doc: str, month: str) -> DataFrame:
    """Rows and distinct documents per month, in month order."""
    return (df.groupBy(F.col(month).alias("partition_date"))
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.countDistinct(doc).alias("unique_docs"))
            .orderBy("partition_date"))


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once (NULL keys count as equal).

    Keys are counted with map-side partial sums; the rows are then matched with the few
    keys that repeat, so no window ever holds all rows of one key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    repeated = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                .where(F.col("__n") > 1)
                .select(*[F.col(k).alias(f"__{k}") for k in keys]))
    same = [df[k].eqNullSafe(repeated[f"__{k}"]) for k in keys]
    return df.join(repeated, same, "left_semi")


def null_percent(df: DataFrame, columns: Sequence[str] | None = None,
                 over: float | None = None) -> DataFrame:
    """Share of NULLs per column in percent; only columns above ``over`` if given."""
    names = list(columns or df.columns)
    shares = df.agg(*[safe_divide(F.count_if(F.col(c).isNull()) * 100.0, F.count(F.lit(1)))
                      .alias(c) for c in names])
    long = shares.unpivot([], names, "column_name", "null_pct")
    return long if over is None else long.where(F.col("null_pct") > over)


def null_total(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All missing values together."""
    missing = sum((F.col(c).isNull().cast("long") for c in columns or df.columns), F.lit(0))
    return df.agg(F.coalesce(F.sum(missing), F.lit(0)).alias("missing_values"))


def schema_profile(df: DataFrame) -> DataFrame:
    """Columns per type, with the number of rows and of columns."""
    types: dict[str, int] = {}
    for f in df.schema.fields:
        name = f.dataType.simpleString()
        types[name] = types.get(name, 0) + 1
    entries = F.array(*[F.struct(F.lit(t).alias("data_type"), F.lit(n).alias("n_columns"))
                        for t, n in sorted(types.items())])
    return (df.agg(F.count(F.lit(1)).alias("n_rows"))
            .select("n_rows", F.lit(len(df.columns)).alias("total_columns"),
                    F.inline(entries)))

