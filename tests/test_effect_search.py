"""Policy trees, intervals per row, and tables trained side by side."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthbook.operators import causal as c, effects as e
from monthbook.operators.training import BoosterSettings
from monthbook.plans.model_pipeline import run_models


def _frame(spark, n=4000, seed=1):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 16, n), rng.integers(0, 16, n)
    effect = np.where(a <= 7, np.where(b <= 3, 2.0, -1.0), -0.5) + rng.normal(0, 0.01, n)
    return spark.createDataFrame([(k, float(x), float(y), float(z)) for k, (x, y, z) in enumerate(zip(a, b, effect))],
                                 "id long, a double, b double, effect double")


def test_policy_finds_the_planted_rule(spark):
    rows = _frame(spark)
    chosen, text = e.policy_tree(rows, ["b", "a"], cost=0.01, depth=2)
    assert chosen.where((F.col("treat") == 1) != ((F.col("a") <= 7) & (F.col("b") <= 3))).count() == 0
    assert "a <= 7" in text and "b <= 3" in text and "treat: " in text


def test_policy_depth_one_is_the_best_cut(spark):
    rows = _frame(spark, 500, 2)
    chosen, _ = e.policy_tree(rows, ["a", "b"], cost=0.2, depth=1, leaf=20)
    gain = F.col("effect") - 0.2
    got = chosen.agg(F.sum(F.when(F.col("treat") == 1, gain).otherwise(0))).first()[0]
    pdf = rows.toPandas()
    best = max(pdf.effect.sub(0.2).sum(), 0.0)
    for name in ("a", "b"):
        for cut in range(16):
            for side in (pdf[name] <= cut, pdf[name] > cut):
                if 20 <= side.sum() <= len(pdf) - 20:
                    best = max(best, max(pdf.effect[side].sub(0.2).sum(), 0.0)
                               + max(pdf.effect[~side].sub(0.2).sum(), 0.0))
    assert got == pytest.approx(best)


def test_policy_of_odd_rows(spark):
    rows = _frame(spark, 300).withColumn("a", F.when(F.col("a") > 12, None).otherwise(F.col("a")))
    chosen, _ = e.policy_tree(rows, ["a", "b"], leaf=10)
    assert chosen.where("treat IS NULL").count() == 0 and chosen.count() == 300
    none, text = e.policy_tree(rows.where("false"), ["a", "b"])
    assert none.collect() == [] and "leave" in text
    nothing, _ = e.policy_tree(rows.withColumn("effect", F.lit(-1.0)), ["a", "b"])
    assert nothing.where("treat = 1").count() == 0
    every, _ = e.policy_tree(rows.withColumn("effect", F.lit(1.0)), ["a", "b"])
    assert every.where("treat = 0").count() == 0


def _simulated(spark, n=6000, seed=3):
    rng = np.random.default_rng(seed)
    x, w = rng.uniform(-1, 1, n), rng.normal(size=n)
    t = 0.5 * w + rng.normal(size=n)
    y = (1 + 2 * x) * t + w + rng.normal(size=n)
    rows = [(k, *map(float, r)) for k, r in enumerate(zip(x, w, t, y))]
    return spark.createDataFrame(rows, "id long, x double, w double, t double, y double")


SPEC = c.CausalSpec(id="id", outcome="y", treatment="t", features=("x",), controls=("w",),
                    nuisance="linear", folds=3)


def test_linear_bands_cover_the_effect(spark):
    residuals = c.crossfit_residuals(_simulated(spark), SPEC)
    found = c.linear_dml(residuals, SPEC, final="linear", replicates=200)
    truth = 1 + 2 * F.col("x")
    row = found.rows.agg(F.avg(truth.between(F.col("effect_low"), F.col("effect_high")).cast("int")).alias("in_"),
                         F.avg(F.col("effect_high") - F.col("effect_low")).alias("width")).first()
    assert row.in_ > 0.9 and 0.02 < row.width < 0.5
    assert found.low < 1.0 < found.high
    # Without replicates there is no band; a constant effect has a constant one.
    assert "effect_low" not in c.linear_dml(residuals, SPEC, final="linear").rows.columns
    flat = c.linear_dml(residuals, SPEC, replicates=50).rows
    assert flat.select("effect_low").distinct().count() == 1


def test_tables_are_trained_side_by_side(spark):
    rng = np.random.default_rng(5)
    rows = [(202300 + k % 6 + 1, int(v > 0.4), float(v)) for k, v in enumerate(rng.uniform(size=600))]
    df = spark.createDataFrame(rows, "month int, target int, v double")
    small = BoosterSettings(trees=3, stop_gain=None)
    runs = run_models(spark, {"a": df, "b": df, "broken": df.drop("target")}, target="target", month="month",
                      cutoff=202304, settings=small)
    found = {r["table"]: r for r in runs.results.collect()}
    assert [found[k]["status"] for k in ("a", "b", "broken")] == ["done", "done", "failed"]
    assert found["a"]["roc_auc"] > 0.95 and found["a"]["roc_auc"] == found["b"]["roc_auc"]
    late = run_models(spark, {"a": df}, target="target", month="month", cutoff=202304,
                      settings=BoosterSettings(trees=200, stop_gain=None), seconds=0.5)
    row = late.results.first()
    assert row["status"] == "failed" and "over 0.5 s" in row["error"]
