"""Classification metrics as aggregates; nothing but counts per class or score is shuffled.

Every function takes ``by``: columns (a table name, a fold) to report separately.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from monthbook.functions.scalars import safe_divide
from monthbook.operators.ranks import cut_points, running_sums


def class_distribution(df: DataFrame, target: str, is_train: Column) -> DataFrame:
    """Train and test rows of every class that occurs in either."""
    return df.groupBy(F.col(target).alias("class")).agg(
        F.count_if(is_train).alias("train_rows"), F.count_if(~is_train).alias("test_rows"))


def confusion_matrix(df: DataFrame, label: str, prediction: str,
                     classes: Sequence[object]) -> DataFrame:
    """One row per true class, one column ``predicted_{class}`` per given class."""
    counted = df.groupBy(F.col(label).alias("actual")).pivot(prediction, list(classes)).agg(
        F.count(F.lit(1)))
    return counted.select("actual", *[F.coalesce(F.col(f"`{c}`"), F.lit(0))
                                      .alias(f"predicted_{c}") for c in classes])


def classification_metrics(df: DataFrame, label: str, prediction: str,
                           by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and precision, recall and F1 weighted by class size; 0 where undefined."""
    by = list(by)
    cells = df.groupBy(*by, F.col(label).cast("string").alias("a"),
                       F.col(prediction).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    # Each cell counts once for its true and once for its predicted class.
    hit = F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    roles = F.inline(F.array(
        F.struct(F.col("a").alias("class"), F.col("n").alias("actual"),
                 zero.alias("predicted"), hit.cast("long").alias("hits")),
        F.struct(F.col("p").alias("class"), zero.alias("actual"),
                 F.col("n").alias("predicted"), zero.alias("hits"))))
    classes = cells.select(*by, roles).groupBy(*by, "class").agg(
        *[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    precision = F.coalesce(safe_divide(F.col("hits"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(safe_divide(F.col("hits"), F.col("actual")), F.lit(0.0))
    f1 = F.coalesce(safe_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    rows = F.sum("actual")
    weighted = {"precision": precision, "recall": recall, "f1": f1}
    return classes.groupBy(*by).agg(
        safe_divide(F.sum("hits"), rows).alias("accuracy"),
        *[safe_divide(F.sum(value * F.col("actual")), rows).alias(name)
          for name, value in weighted.items()])


def _score_curve(df: DataFrame, label: Column, score: str, by: Sequence[str],
                 buckets: int | None) -> DataFrame:
    """Positives and negatives per score, with their running sums and totals."""
    rows = (df.select(*by, F.col(score).cast("double").alias("__score"), label.alias("__y"))
            .where(F.col("__score").isNotNull() & F.col("__y").isNotNull()))
    counted = rows.groupBy(*by, "__score").agg(F.count_if(F.col("__y")).alias("__pos"),
                                               F.count_if(~F.col("__y")).alias("__neg"))
    return running_sums(counted, "__score", {"__cp": "__pos", "__cn": "__neg"}, by,
                        cut_points(rows, "__score", buckets))


def binary_curve_metrics(df: DataFrame, label: Column, score: str,
                         by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Exact area under the ROC curve and KS distance from one pass over ranked scores.

    A tie between a positive and a negative counts one half.  Both are NULL if a class is
    missing.
    """
    curve = _score_curve(df, label, score, list(by), buckets)
    # Pairs in halves, so the sum stays in whole numbers; 38 digits hold any table.
    wide = "decimal(38,0)"
    half_pairs = F.col("__pos").cast("decimal(19,0)") * (
        2 * F.col("__cn") - F.col("__neg")).cast("decimal(18,0)")
    gap = F.abs(safe_divide(F.col("__cp"), F.col("__cp_total"))
                - safe_divide(F.col("__cn"), F.col("__cn_total")))
    both = (F.max("__cp_total").cast("double") * F.max("__cn_total").cast("double"))
    return curve.groupBy(*by).agg(
        safe_divide(F.sum(half_pairs.cast(wide)).cast("double") / 2.0, both).alias("roc_auc"),
        F.max(gap).alias("ks"),
        F.max("__cp_total").alias("positives"), F.max("__cn_total").alias("negatives"))


def roc_auc(df: DataFrame, label: Column, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve."""
    return binary_curve_metrics(df, label, score, by).select(*by, "roc_auc")


def ks_statistic(df: DataFrame, label: Column, score: str,
                 by: Sequence[str] = ()) -> DataFrame:
    """Largest gap between the score distributions of the two classes."""
    return binary_curve_metrics(df, label, score, by).select(*by, "ks")


def roc_auc_ovr(df: DataFrame, label: str, scores: dict[object, str]) -> DataFrame:
    """One-against-the-rest area under the ROC curve, weighted by class size.

    ``scores`` maps each class to the column with its score.
    """
    cells = [F.struct(F.lit(str(c)).alias("class"), F.col(s).cast("double").alias("score"),
                      (F.col(label) == F.lit(c)).alias("is_class"))
             for c, s in scores.items()]
    long = df.select(F.inline(F.array(*cells)))
    per_class = binary_curve_metrics(long, F.col("is_class"), "score", by=["class"])
    return per_class.agg(safe_divide(F.sum(F.col("roc_auc") * F.col("positives")),
                                     F.sum("positives")).alias("roc_auc_ovr"))


# Limits of the overfit labels, by report.
GAP_LIMITS = {"chart": (0.03, 0.07), "summary": (0.05, 0.10)}


def gap_label(gap: Column, limits: tuple[float, float] = GAP_LIMITS["summary"]) -> Column:
    """``Low``, ``Moderate`` or ``High``."""
    low, high = limits
    return (F.when(gap.isNull(), F.lit(None).cast("string")).when(gap < low, "Low")
            .when(gap < high, "Moderate").otherwise("High"))


def overfit_gap(df: DataFrame, train: str, test: str, name: str,
                limits: tuple[float, float] = GAP_LIMITS["summary"]) -> DataFrame:
    """Adds ``overfitting_{name}``, the distance of train and test metric, and its label."""
    gap = F.abs(F.col(train) - F.col(test))
    return df.withColumns({f"overfitting_{name}": gap,
                           f"overfitting_{name}_level": gap_label(gap, limits)})
