"""Trees grown on cells say what MLlib's say, and take a few jobs however many trees there are."""

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from monthbook.operators import causal as c, cells as ce, effects as e
from monthbook.plans.causal_report import causal_report

SPEC = c.CausalSpec(id="id", outcome="y", treatment="t", features=("x1", "x2", "x3"), folds=3,
                    trees=20, outcome_depth=4, treatment_depth=6)


def _pandas(n=4000, seed=7, few=False):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    if few:  # so few values that MLlib cuts between all of them, too
        x1, x2 = np.round(x1 * 3).clip(-7, 7), np.round(x2 * 2).clip(-5, 5)
    x3 = rng.integers(0, 5, n).astype(float)
    t = 0.5 * x1 - 0.3 * x2 + rng.normal(size=n)
    y = (2 + x1) * t + x1 - x2 * x3 + rng.normal(0, 0.3, n)
    return pd.DataFrame({"id": np.arange(n), "x1": x1, "x2": x2, "x3": x3, "t": t, "y": y,
                         "treated": (t > 0).astype(int)})


@pytest.fixture(scope="module")
def few(spark):
    return spark.createDataFrame(_pandas(few=True)).repartition(3).cache()


def _vector(df):
    return VectorAssembler(inputCols=["x1", "x2", "x3"], outputCol="v").transform(df)


def _jobs(spark, work):
    """What ``work`` gives, and how many Spark jobs it took, in all threads."""
    count = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = count()
    return work(), count() - before


def test_a_tree_equals_the_library_s(spark, few):
    cells = ce.find_cells(few, SPEC.features)
    sums = ce.plain_sums(few, cells, [F.col("y")], 1, F.lit(0))[:, 0]
    tree = ce.grow(cells.bins(), cells.sizes, sums[0], sums[0], sums[1], 5, 20)
    found = cells.add(few, {"p": tree.value[tree.leaf]}).select("id", "p").toPandas().set_index("id").p
    model = DecisionTreeRegressor(featuresCol="v", labelCol="y", predictionCol="p", maxDepth=5,
                                  minInstancesPerNode=20).fit(_vector(few))
    known = model.transform(_vector(few)).select("id", "p").toPandas().set_index("id").p
    np.testing.assert_allclose(found.sort_index(), known.sort_index(), rtol=1e-9)
    np.testing.assert_allclose(tree.importance / tree.importance.sum(),
                               model.featureImportances.toArray(), rtol=1e-6)


def test_boosters_equal_the_library_s(spark, few):
    cells = ce.find_cells(few, SPEC.features)
    sums = ce.plain_sums(few, cells, [F.col("y"), F.col("treated")], 1, F.lit(0))[:, 0]
    made = ce.grow_boosters(spark, cells, {"y": ce.Booster(sums[0], sums[1]),
                                           "p": ce.Booster(sums[0], sums[2], True)}, 12, 4)
    found = cells.add(few, made).select("id", F.col("y").alias("b"), "p").toPandas().set_index("id")
    ready = _vector(few)
    y = GBTRegressor(featuresCol="v", labelCol="y", predictionCol="b", maxIter=12, maxDepth=4).fit(ready)
    p = GBTClassifier(featuresCol="v", labelCol="treated", maxIter=12, maxDepth=4).fit(ready)
    known = p.transform(y.transform(ready)).select(
        "id", "b", vector_to_array("probability")[1].alias("p")).toPandas().set_index("id")
    np.testing.assert_allclose(found.b.sort_index(), known.b.sort_index(), rtol=1e-8)
    np.testing.assert_allclose(found.p.sort_index(), known.p.sort_index(), rtol=1e-8)


def test_dr_learner_with_trees_takes_few_jobs(spark):
    """Fifteen boosted models and a forest: hundreds of jobs when each level of a tree was one."""
    rows = spark.createDataFrame(_pandas())
    found, jobs = _jobs(spark, lambda: c.dr_learner(rows, SPEC))
    assert found.rows.count() == 4000 and found.low < found.ate < found.high
    assert jobs < 60


def test_estimators_agree_with_models_trained_on_rows(spark, monkeypatch):
    rows = spark.createDataFrame(_pandas()).cache()

    def all_of_them():
        residuals = c.crossfit_residuals(rows, SPEC)
        made = {"t_hat": residuals.select("id", F.col("t_hat").alias("effect"))}
        made["y_hat"] = residuals.select("id", F.col("y_hat").alias("effect"))
        for found in (c.forest_dml(residuals, SPEC), c.dr_learner(rows, SPEC), c.s_learner(rows, SPEC),
                      c.t_learner(rows, SPEC), c.x_learner(rows, SPEC)):
            assert found.rows.columns[-1] == "effect"
            made[found.name] = found.rows.select("id", "effect")
        return {k: v.toPandas().set_index("id").effect.sort_index() for k, v in made.items()}

    found = all_of_them()
    monkeypatch.setattr(c, "find_cells", lambda *a, **k: None)
    known = all_of_them()
    for name, effect in known.items():
        assert len(found[name]) == 4000 and found[name].notna().all()
        assert np.corrcoef(found[name], effect)[0, 1] > 0.9, name
        assert found[name].mean() == pytest.approx(effect.mean(), abs=0.15), name


def test_sums_do_not_depend_on_how_rows_are_dealt_out(spark):
    rows = spark.createDataFrame(_pandas(few=True))
    def sums(df, parts):
        cells = replace(ce.find_cells(df, SPEC.features), rows=parts * ce.ROWS_PER_TASK)
        made = ce.cell_sums(df, cells, [F.col("y")], 2, 42, F.col("id") % 2, ["id"]).toPandas()
        return cells, [ce.dense(part, 1, 2, cells) for _, part in made.groupby("block")]
    cells, first = sums(rows.coalesce(1), 1)
    _, second = sums(rows.repartition(5), 4)
    for a, b in zip(first, second, strict=True):
        assert a.shape == (2, ce.BLOCK, 2, cells.count)
        np.testing.assert_array_equal(a[0], b[0])
        np.testing.assert_allclose(a[1], b[1], rtol=1e-9, atol=1e-9)
    weights = np.stack([a[0].sum(axis=(1, 2)) for a in first]).ravel()
    assert np.all(np.abs(weights - 4000) < 5 * np.sqrt(4000)) and len(set(weights)) == len(weights)


def test_bootstrap_weights_are_poisson():
    drawn = ce.bootstrap(np.arange(200_000, dtype=np.uint64) * np.uint64(2654435761), 3)
    assert drawn.shape == (4, 200_000)
    assert drawn.mean() == pytest.approx(1.0, abs=0.01) and drawn.var() == pytest.approx(1.0, abs=0.02)
    assert np.abs(np.corrcoef(drawn) - np.eye(4)).max() < 0.01


def test_cells_of_odd_features(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(1.0, 5, None), (2.0, 5, 1.0), (nan, 5, 2.0), (3.0, 5, 2.0)],
                                 "a double, b int, c double")
    cells = ce.find_cells(rows, ["a", "b", "c"])
    assert cells.cuts == ((1.5, 2.5), (), (1.5,)) and cells.count == 6
    got = cells.add(rows, {"p": np.arange(6.0)}).collect()
    assert [r.p for r in got] == [None, 2.0, None, 5.0]
    assert ce.find_cells(rows.limit(0), ["a", "b"]).count == 1
    wide = spark.range(200).select(*[(F.col("id") * k % 199).alias(f"x{k}") for k in range(1, 6)])
    assert ce.find_cells(wide, wide.columns[:3]).count == 32 ** 3
    assert ce.find_cells(wide, wide.columns) is None


def test_cuts_are_quantiles(spark):
    rows = spark.range(100_000).select((F.col("id") * 7919 % 100_000).cast("double").alias("x"))
    cuts = np.array(ce.find_cells(rows.repartition(4), ["x"]).cuts[0])
    assert len(cuts) == 31
    np.testing.assert_allclose(cuts, np.arange(1, 32) * 100_000 / 32, atol=100)


def test_a_causal_report_takes_few_jobs(spark):
    """All seven estimators, bins, drivers and policy: thousands of jobs when forests grew on rows."""
    rows = spark.createDataFrame(_pandas()).withColumn("y2", F.col("y") * 2)
    spec = replace(SPEC, nuisance="linear", trees=100, treatment_depth=10, folds=5)
    found, jobs = _jobs(spark, lambda: causal_report(rows, spec, "x1", "y2"))
    assert found.comparison.where("ate IS NOT NULL").count() == 7
    assert jobs < 200


def test_policy_levels_read_sums_not_rows(spark):
    """A million rows of six kinds: the same choice, and the text has all rows."""
    rows = spark.range(1_000_000).select(
        (F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.when(F.col("id") % 2 == 0, 0.5).otherwise(-1.0))
        .alias("effect"))
    chosen, text = e.policy_tree(rows, ["a", "b"], cost=0.0, depth=2)
    sums = chosen.groupBy("effect").agg(F.min("treat").alias("a"), F.max("treat").alias("b")).collect()
    assert all(r.a == r.b == int(r.effect > 0) for r in sums)
    assert sum(int(line.split(": ")[1].split(" rows")[0]) for line in text.splitlines() if ": " in line) == 1_000_000
