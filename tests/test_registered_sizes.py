"""The registered model queries run with the library's sizes and give their estimates."""

import __spark_entry__ as contract
from monthbook.operators.training import BoosterSettings
from suite import causals, models
from tests.conftest import SMALL


def test_registered_trees_and_folds():
    assert models.FULL == BoosterSettings() and models.FULL.trees == 100
    assert (causals.TREES.trees, causals.TREES.folds, causals.TREES.treatment_depth) == (100, 5, 10)


def test_causal_estimates(spark):
    rows = contract.queries()["causal_estimates"](spark, SMALL).collect()
    assert len({r["model"] for r in rows}) == 7 and all(r["ate"] is not None for r in rows)
