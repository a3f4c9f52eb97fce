"""Rankings and reports over model results (one row per table, metric or feature)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import MapType, VariantType

from monthbook.functions.scalars import safe_divide


def compare_models(metrics: DataFrame, name: str = "table") -> DataFrame:
    """Dense ranks by accuracy and by F1, and their mean, best first.

    ``metrics`` has one row per model, so the ranking windows stay small.
    """
    auc = F.coalesce(F.col("roc_auc"), F.lit(0.0))
    def ranked(c: str) -> F.Column:
        return F.dense_rank().over(Window.orderBy(F.desc(c)))
    return (metrics.select(F.col(name), F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"),
                           F.coalesce("f1", F.lit(0.0)).alias("f1_score"), auc.alias("roc_auc"))
            .withColumn("rank_accuracy", ranked("accuracy"))
            .withColumn("rank_f1", ranked("f1_score"))
            .withColumn("rank_overall", (F.col("rank_accuracy") + F.col("rank_f1")) / 2)
            .orderBy("rank_overall", name))


def importance_normalised(importances: DataFrame, table: str = "table",
                          value: str = "importance") -> DataFrame:
    """Importances that sum to 1 per table, largest first; an all-zero table is left as is."""
    total = F.sum(value).over(Window.partitionBy(table))
    share = F.coalesce(safe_divide(F.col(value), total), F.col(value).cast("double"))
    return importances.withColumn(value, share).orderBy(table, F.desc(value))


def topk_features(importances: DataFrame, k: int, table: str = "table",
                  feature: str = "feature", value: str = "importance") -> DataFrame:
    """The ``k`` most important features per table, with their rank."""
    order = Window.partitionBy(table).orderBy(F.desc(value), F.asc(feature))
    return (importances.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k))


def feature_dictionary(top: DataFrame, tables: DataFrame, table: str = "table",
                       feature: str = "feature") -> DataFrame:
    """Every table with the list of its top features in order, empty for a failed table."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", feature)))
    lists = top.groupBy(table).agg(F.transform(pairs, lambda p: p[feature]).alias("features"))
    none = F.array().cast("array<string>")
    return tables.select(table).join(lists, table, "left").select(
        table, F.coalesce("features", none).alias("features"))


def top_rows(df: DataFrame, by: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest ``by``; ties follow by the other columns."""
    rest = [f.name for f in df.schema.fields if f.name != by and not isinstance(
        f.dataType, (MapType, VariantType))]
    return df.orderBy(F.desc(by), *[F.col(f"`{c}`") for c in rest]).limit(n)


def summary_report(results: DataFrame, top: DataFrame, table: str = "table",
                   feature: str = "feature") -> DataFrame:
    """Result rows of the tables that worked, with their three best features, by accuracy."""
    best = top.groupBy(table).agg(
        *[F.max(F.when(F.col("rank") == i, F.col(feature))).alias(f"top_feature_{i}")
          for i in (1, 2, 3)])
    return (results.where(F.col("status") == "done").drop("status", "error")
            .join(best, table, "left").orderBy(F.desc("accuracy"), table))


def union_rows(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of several small results under one schema."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
