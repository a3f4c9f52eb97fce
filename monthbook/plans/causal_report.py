"""The whole causal run over one table of residuals."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from monthbook.operators import causal, effects
from monthbook.operators.bins import effect_by_bin
from monthbook.operators.parallel import side_by_side
from monthbook.session import written


@dataclass(frozen=True)
class CausalReport:
    """Tables of a causal run."""

    estimates: dict[str, causal.Estimate]
    by_bin: DataFrame
    drivers: DataFrame
    policy: DataFrame
    scenarios: DataFrame
    comparison: DataFrame
    summary: DataFrame
    second_outcome: causal.Estimate | None


def causal_report(df: DataFrame, spec: causal.CausalSpec, bin_by: str,
                  second_outcome: str | None = None, replicates: int = 100) -> CausalReport:
    """All estimators, then bins, drivers, policy and scenarios of the forest's effect.

    Residuals are written out once: every later step reads them instead of refitting.
    """
    df = written(df, "causal-rows")
    residuals = written(causal.crossfit_residuals(df, spec), "residuals")
    work = {"linear_dml": lambda: causal.linear_dml(residuals, spec, replicates=replicates),
            "forest_dml": lambda: causal.forest_dml(residuals, spec),
            "kernel_dml": lambda: causal.kernel_dml(residuals, spec),
            "dr_learner": lambda: causal.dr_learner(df, spec),
            "s_learner": lambda: causal.s_learner(df, spec),
            "t_learner": lambda: causal.t_learner(df, spec),
            "x_learner": lambda: causal.x_learner(df, spec)}
    # None needs another: they are fitted side by side.
    estimates = side_by_side(df.sparkSession, work, spec.at_once)
    linear, forest = estimates["linear_dml"], estimates["forest_dml"]
    rows = forest.rows
    by_bin = effect_by_bin(rows, "effect", bin_by)
    drivers = effects.effect_drivers(rows, spec.features)
    policy, _ = effects.policy_tree(rows, spec.features)
    second = None
    if second_outcome:
        other = replace(spec, outcome=second_outcome)
        second = causal.linear_dml(written(causal.crossfit_residuals(df, other), "residuals"), other,
                                   replicates=replicates)
    judged = second or linear
    return CausalReport(
        estimates, by_bin, drivers, policy, effects.scenarios(replace(forest, rows=rows), spec),
        effects.compare_ate(list(estimates.values())),
        effects.effect_summary(by_bin, drivers, judged.ate, judged.low, judged.high), second)
