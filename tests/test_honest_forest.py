"""Honest forest: intervals of the effect of a row cover planted effects."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from monthbook.operators import causal as c
from monthbook.operators.honest import _above_zero, effects_of, honest_forest

SPEC = c.CausalSpec(id="id", outcome="y", treatment="t", features=("x1", "x2"), trees=100,
                    treatment_depth=4, leaf=20)


def _residuals(spark, effect, n=6000, seed=3):
    rng = np.random.default_rng(seed)
    x1, x2, t = rng.uniform(-1, 1, n), rng.uniform(-1, 1, n), rng.normal(0, 1, n)
    truth = effect(x1)
    pdf = pd.DataFrame({"id": np.arange(n), "x1": x1, "x2": x2, "t_res": t, "truth": truth,
                        "y_res": truth * t + rng.normal(0, 1, n)})
    return spark.createDataFrame(pdf)


def _covered(found, keep=None):
    pdf = found.rows.toPandas()
    if keep is not None:
        pdf = pdf[keep(pdf)]
    return ((pdf.effect_low <= pdf.truth) & (pdf.truth <= pdf.effect_high)).mean(), pdf


def test_intervals_cover_a_constant_effect(spark):
    found = honest_forest(_residuals(spark, lambda x: np.full(len(x), 2.0)), SPEC)
    share, pdf = _covered(found)
    assert len(pdf) == 6000 and list(pdf.columns)[-3:] == ["effect", "effect_low", "effect_high"]
    assert share > 0.85
    assert found.low < 2.0 < found.high and found.high - found.low < 0.12
    # As wide as the spread of the estimates asks for, not just wide.
    width = (pdf.effect_high - pdf.effect_low).mean() / (2 * 1.959964)
    off = np.sqrt(((pdf.effect - 2.0) ** 2).mean())
    assert 0.5 < width / off < 2.5


def test_intervals_cover_a_step_away_from_it(spark):
    found = honest_forest(_residuals(spark, lambda x: np.where(x > 0, 3.0, 1.0)), SPEC)
    share, pdf = _covered(found, lambda p: p.x1.abs() > 0.15)
    assert share > 0.8
    assert pdf.effect[pdf.x1 > 0].mean() == pytest.approx(3.0, abs=0.15)
    assert pdf.effect[pdf.x1 < 0].mean() == pytest.approx(1.0, abs=0.15)
    assert found.importances[0][0] == "x1"
    again = found.predict(found.rows.select("x1", "x2", "id")).toPandas().set_index("id").effect
    first = found.rows.toPandas().set_index("id").effect
    np.testing.assert_allclose(again.sort_index(), first.sort_index())


def test_effects_by_hand():
    # Two groups, one leaf a tree: products 2, 2, 4, 4 over squares 1.
    table = np.ones((3, 4, 1))
    table[1, :, 0] = 2, 2, 4, 4
    effect, error = effects_of(np.zeros((1, 4), int), table, 2, 1)
    assert effect[0] == 3 and error[0] > 0
    empty = np.zeros((3, 4, 1))
    assert np.isnan(effects_of(np.zeros((1, 4), int), empty, 2, 1)[0][0])
    np.testing.assert_allclose(_above_zero(np.array([5.0, 0.0]), np.array([0.1, 1.0])),
                               [5.0, np.sqrt(2 / np.pi)], rtol=1e-2)


def test_odd_numbers_of_groups_and_rows(spark):
    with pytest.raises(ValueError):
        honest_forest(_residuals(spark, np.abs, 50), SPEC, groups=1)
    with pytest.raises(ValueError, match="too few rows"):
        honest_forest(_residuals(spark, np.abs, 1), SPEC, groups=2)


def test_intervals_cover_on_average_and_no_model_is_trained_on_rows(spark, monkeypatch):
    """Over several tables, away from a step; 40 forests of MLlib took some 600 jobs each time."""
    from monthbook.operators import honest

    def refused(*_, **__):
        raise AssertionError("trained on rows")

    monkeypatch.setattr(honest, "training_rows", refused)
    shares = []
    for seed in (6, 7, 9):
        found = honest_forest(_residuals(spark, lambda x: np.where(x > 0, 3.0, 1.0), seed=seed), SPEC)
        share, pdf = _covered(found, lambda p: p.x1.abs() > 0.15)
        shares.append(share)
        assert pdf.effect.sub(pdf.truth).pow(2).mean() ** 0.5 < 0.07
    assert np.mean(shares) > 0.85
    # A row without a treatment of its own has an effect, too, and a missing feature has none.
    rows = _residuals(spark, np.abs).withColumn("t_res", F.when(F.col("id") > 9, F.col("t_res")).otherwise(0.0))
    found = honest_forest(rows, SPEC)
    assert found.rows.where("effect IS NULL OR effect_low > effect_high").count() == 0
    other = found.predict(spark.createDataFrame([(0.5, 0.1), (None, 0.1)], "x1 double, x2 double")).collect()
    assert other[0].effect_low < other[0].effect < other[0].effect_high and other[1].effect is None
