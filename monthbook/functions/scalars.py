"""Column arithmetic: safe division, clipping, linear and logistic scores, loan economics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def safe_divide(num: Column, den: Column) -> Column:
    """Double division that gives NULL for a zero or missing divisor."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def clip(x: Column, low: float, high: float) -> Column:
    """``x`` held inside ``[low, high]``; NULL stays NULL."""
    held = F.least(F.greatest(x, F.lit(low)), F.lit(high))
    return F.when(x.isNotNull(), held)


def logistic(z: Column) -> Column:
    """``1 / (1 + exp(-z))``."""
    return 1.0 / (1.0 + F.exp(-z))


def linear_score(intercept: float, weights: Mapping[str, float],
                 *terms: Column) -> Column:
    """Linear score of named columns, plus any further (quadratic, crossed, log) terms."""
    z = F.lit(float(intercept))
    for name, weight in weights.items():
        z = z + F.col(name) * float(weight)
    for term in terms:
        z = z + term
    return z


def loan_economics(price: Column, down_payment: Column, rate: Column, base_rate: Column,
                   months: Column, default_rate: Column) -> dict[str, Column]:
    """Financed value, interest income, expected loss, cost of capital and NPV of a loan."""
    financed = price * (1 - down_payment)
    income = financed * rate / 100 * months / 12
    loss = financed * default_rate * 0.5
    capital = financed * base_rate / 100 * months / 12
    return {"financed": financed, "interest_income": income, "expected_loss": loss,
            "capital_cost": capital, "npv": income - loss - capital}
