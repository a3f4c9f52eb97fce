"""Credit-risk book: limit use, lateness, payment spread and a composite score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from monthbook.functions.scalars import safe_divide
from monthbook.operators.book import BookSpec, feature_book

# Weights of the composite score, and the days late that count as 1.
LATE_WEIGHT = 0.4
USE_WEIGHT = 0.3
DAYS_WEIGHT = 0.3
DAYS_SCALE = 90.0


def utilisation(inside: Column, months: int) -> list[Column]:
    """Mean share of the limit in use; a zero limit counts as missing."""
    use = safe_divide(F.col("vl_utilizado"), F.col("vl_limite"))
    return [F.avg(F.when(inside, use)).alias(f"taxa_utilizacao_{months}m")]


def late_frequency(inside: Column, months: int) -> list[Column]:
    """Rows flagged late."""
    late = F.when(inside & (F.col("fl_atraso") == 1), 1).otherwise(0)
    return [F.sum(late).alias(f"freq_atrasos_{months}m")]


def max_days_late(inside: Column, months: int) -> list[Column]:
    return [F.max(F.when(inside, F.col("dias_atraso"))).alias(f"max_dias_atraso_{months}m")]


def payment_spread(inside: Column, months: int) -> list[Column]:
    paid = F.when(inside, F.col("vl_pagamento").cast("double"))
    return [F.stddev_samp(paid).alias(f"std_pagamentos_{months}m")]


def composite_score(widest: int):
    """Score over the whole widest window, as a feature factory."""
    def make(inside: Column, months: int) -> list[Column]:
        if months != widest:
            return []
        flag = F.when(F.col("fl_atraso") == 1, 1.0).otherwise(0.0)
        late = F.avg(F.when(inside, flag))
        use = F.avg(F.when(inside, safe_divide(F.col("vl_utilizado"), F.col("vl_limite"))))
        days = F.max(F.when(inside, F.col("dias_atraso"))) / DAYS_SCALE
        score = (F.coalesce(late, F.lit(0.0)) * LATE_WEIGHT
                 + F.coalesce(use, F.lit(0.0)) * USE_WEIGHT
                 + F.coalesce(days, F.lit(0.0)) * DAYS_WEIGHT)
        return [score.alias("score_risco_composto")]
    return make


def risk_book(df: DataFrame, ref: str, windows: Sequence[int] = (1, 3, 6, 12),
              key: str = "cpf", month: str = "anomes", stamp_time: bool = True) -> DataFrame:
    """Every risk feature per customer."""
    spec = BookSpec(windows=windows, key=key, month=month, stamp_time=stamp_time,
                    extra=[utilisation, late_frequency, max_days_late, payment_spread,
                           composite_score(max(windows))])
    return feature_book(df, spec, ref)
