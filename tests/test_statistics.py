"""Ranks, metrics, bins, preparation, training and causal estimates."""

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from monthbook.operators import bins, causal as c, effects as e, metrics as m, prep, quality, reports
from monthbook.operators.linear import fit_groups
from monthbook.operators.ranks import (
    cut_points, quantile_values, quantiles, row_index, running_sums)
from monthbook.operators.training import BoosterSettings
from monthbook.plans.causal_report import causal_report
from monthbook.plans.model_pipeline import run_models, save_runs
from monthbook.sources.tables import load_feature_map


def _skewed(n=4000, seed=3):
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 6, n).astype(str))
    v = np.where(rng.random(n) < 0.3, 5.0, np.round(rng.normal(0, 50, n), 1))
    return pd.DataFrame({"g": g, "v": v})


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_running_sums_and_quantiles_equal_pandas(spark, buckets):
    pdf = _skewed()
    df = spark.createDataFrame(pdf)
    counted = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    cuts = cut_points(df, "v", buckets)
    got = running_sums(counted, "v", {"upto": "n"}, ["g"], cuts).toPandas()
    got = got.sort_values(["g", "v"]).reset_index(drop=True)
    expected = pdf.groupby(["g", "v"]).size().groupby("g").cumsum()
    assert got["upto"].tolist() == expected.tolist()
    assert set(zip(got.g, got.upto_total)) == set(pdf.groupby("g").size().items())

    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    q = quantiles(df, "v", probs, ["g"], buckets).toPandas().set_index("g").sort_index()
    wanted = pdf.groupby("g").v.quantile(probs).unstack().sort_index()
    np.testing.assert_allclose(q.to_numpy(), wanted.to_numpy(), atol=1e-9)


def test_quantiles_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "v double")
    assert quantile_values(df, "v", [0.0, 0.5, 1.0]) == [2.0, 2.0, 2.0]
    assert quantile_values(df.where("v > 3"), "v", [0.5]) == [None]


@pytest.mark.parametrize("buckets", [2, 16])
def test_row_index_with_a_hot_moment(spark, buckets):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": rng.permutation(3000),
                        "t": np.where(rng.random(3000) < 0.4, 50, rng.integers(0, 100, 3000))})
    df = spark.createDataFrame(pdf).withColumn("time", F.timestamp_seconds("t"))
    got = row_index(df, "time", "id", buckets=buckets).toPandas().sort_values(["t", "id"])
    assert got["row_index"].tolist() == list(range(3000))


def test_auc_and_ks_by_brute_force(spark):
    rng = np.random.default_rng(2)
    score, label = np.round(rng.normal(size=600), 1), rng.random(600) < 0.3
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": label, "neg": -score}))
    got = m.binary_curve_metrics(df, F.col("y"), "s").first()
    p, n = score[label], score[~label]
    pairs = (p[:, None] > n).mean() + (p[:, None] == n).mean() / 2
    gap = max(abs((p <= x).mean() - (n <= x).mean()) for x in score)
    assert got.roc_auc == pytest.approx(pairs, abs=1e-12)
    assert got.ks == pytest.approx(gap, abs=1e-12)
    other = m.roc_auc(df, F.col("y"), "neg").first()[0]
    assert got.roc_auc + other == pytest.approx(1.0, abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, True), (0.2, True)], "s double, y boolean")
    assert m.roc_auc(df, F.col("y"), "s").first()[0] is None


def test_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")],
                               "y string, p string")
    got = m.classification_metrics(df, "y", "p").first()
    assert got.accuracy == 0.5
    assert got.precision == pytest.approx((1.0 * 2 + 1 / 3) / 4)
    assert got.recall == pytest.approx((0.5 * 2 + 1.0) / 4)


def test_gap_labels(spark):
    df = spark.createDataFrame([(0.9, 0.88), (0.9, 0.84), (0.9, 0.7), (0.9, None)],
                               "a double, b double")
    got = [r.overfitting_x_level for r in m.overfit_gap(df, "a", "b", "x").collect()]
    assert got == ["Low", "Moderate", "High", None]


def test_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "v double")
    got = bins.quantile_bins(df, "v", 5).groupBy("bin").count().collect()
    assert {r.bin: r["count"] for r in got} == {"Q1": 21, "Q2": 20, "Q3": 20, "Q4": 20, "Q5": 20}
    with pytest.raises(ValueError):
        bins.quantile_bins(spark.createDataFrame([(1.0,)] * 9, "v double"), "v", 3)
    fixed = {r.v: r.bin for r in bins.fixed_bins(df.selectExpr("v * 6 AS v"), "v").collect()}
    assert [fixed[x] for x in (0.0, 180.0, 186.0, 300.0, 498.0, 504.0)] == [
        None, "Curto", "Médio", "Médio", "Longo", None]
    hist = bins.histogram(df, "v", 10).orderBy("bin").collect()
    assert [r.n_rows for r in hist] == [10] * 9 + [11]
    flat = bins.histogram(df.selectExpr("1.0D AS v"), "v", 4).collect()
    assert sum(r.n_rows for r in flat) == 101


def test_time_folds_leave_out_the_remainder(spark):
    df = spark.range(23).select("id", F.timestamp_seconds(F.col("id") * 60).alias("time"))
    indexed = bins.temporal_index(df, "time", "id", 5)
    train, test = bins.fold_parts(indexed, 1)
    assert [r.id for r in train.orderBy("id").collect()] == list(range(8))
    assert [r.id for r in test.orderBy("id").collect()] == [8, 9, 10, 11]
    assert indexed.where("block IS NULL").count() == 3


def test_split_drops_null_months_and_keeps_the_rest(spark):
    df = spark.createDataFrame([("202312",), ("202401",), (None,)], "month string")
    a, b = prep.split_by_date(df, "month", 202312)
    assert (a.count(), b.count()) == (1, 1)


def test_model_frame_roles(spark):
    df = spark.sql("SELECT 1.9D AS target, 202401 AS month, DATE'2024-01-01' AS d, 'a' AS s, "
                   "CAST(1.5 AS DECIMAL(9,2)) AS m, 3 AS n, TIMESTAMP'2024-01-01 00:00:00' AS ts")
    roles = prep.model_columns(df, "target", "month")
    assert roles == prep.ModelColumns(("s", "m", "n"), ("s",), ("m",), ("d", "ts"))
    frame = prep.model_frame(df, "target", "month")
    assert dict(frame.dtypes) == {"s": "string", "m": "double", "n": "int", "target": "int",
                                  "month": "int"}
    assert frame.first().target == 1


def test_encoding_handles_unseen_missing_and_many_values(spark):
    train = spark.createDataFrame([("a", f"v{i}", float(i)) for i in range(60)]
                                  + [("b", "v1", None)], "s string, many string, x double")
    cols = prep.ModelColumns(("s", "many", "x"), ("s", "many"), (), ())
    fitted = prep.fit_encoding(train, cols, max_bins=32)
    assert fitted.categorical == ("s", "many")
    other = spark.createDataFrame([("zz", "new", float("nan")), (None, None, 1.0)], train.schema)
    got = fitted.transform(other).collect()
    assert [r.s_index for r in got] == [3.0, 2.0]  # unseen; missing
    assert [(r.x_filled, r.x_is_null) for r in got] == [(prep.MISSING, 1.0), (1.0, 0.0)]
    assert [r.many_index for r in got] == [33.0, 32.0]
    seen = {r.many: r.many_index for r in fitted.transform(train).collect()}
    assert seen["v1"] == 0.0 and sorted(set(seen.values())) == [*range(32), 33]
    kind = fitted.transform(train).schema["many_index"].metadata["ml_attr"]["type"]
    assert kind == "nominal"


def test_standardise_constant_and_one_hot(spark):
    df = spark.createDataFrame([(1.0, 7.0, "b"), (3.0, 7.0, "a"), (5.0, 7.0, None)],
                               "x double, k double, s string")
    got = prep.standardise(df, ["x", "k"]).collect()
    assert [r.k for r in got] == [0.0, 0.0, 0.0]
    assert got[0].x == pytest.approx(-np.sqrt(1.5))
    hot = prep.one_hot(df, ["s"])
    assert hot.columns == ["x", "k", "s_b"] and [r.s_b for r in hot.collect()] == [1, 0, 0]


def test_quality_reports(spark):
    df = spark.createDataFrame([("a", "202401"), ("a", "202401"), ("b", "202402"), (None, None)],
                               "cpf string, anomes string")
    row = quality.validation_report(df).first()
    assert (row.qtd_cpfs_unicos, row.qtd_total_registros, row.qtd_duplicados,
            row.qtd_particoes) == (2, 4, 2, 2)
    assert row.dt_referencia is None and row.status_duplicados == quality.DUPLICATES_FOUND
    empty = quality.validation_report(df, ref="209901").first()
    assert empty.qtd_total_registros == 0 and empty.status_duplicados == quality.NO_DUPLICATES
    assert quality.duplicate_keys(df, "cpf").count() == 2
    twice = df.union(df)
    assert quality.duplicate_keys(twice, "cpf").count() == 8  # NULL keys are equal too
    assert quality.null_total(df).first()[0] == 2


def test_reports_rank_and_list(spark):
    metrics = spark.createDataFrame(
        [("a", 0.9, 0.5, 0.7), ("b", 0.9, 0.6, None), ("c", 0.8, 0.4, 0.6)],
        "table string, accuracy double, f1 double, roc_auc double")
    got = [(r.table, r.rank_accuracy, r.rank_f1, r.rank_overall, r.roc_auc)
           for r in reports.compare_models(metrics).collect()]
    assert got == [("b", 1, 1, 1.0, 0.0), ("a", 1, 2, 1.5, 0.7), ("c", 2, 3, 2.5, 0.6)]
    imp = spark.createDataFrame([("a", "x", 3.0), ("a", "y", 1.0), ("z", "q", 0.0)],
                                "table string, feature string, importance double")
    norm = {(r.table, r.feature): r.importance
            for r in reports.importance_normalised(imp).collect()}
    assert norm == {("a", "x"): 0.75, ("a", "y"): 0.25, ("z", "q"): 0.0}
    tables = spark.createDataFrame([("a",), ("failed",)], "table string")
    listed = reports.feature_dictionary(reports.topk_features(imp, 2), tables)
    assert {r.table: r.features for r in listed.collect()} == {"a": ["x", "y"], "failed": []}


def test_model_pipeline_learns_and_isolates_failures(spark, tmp_path):
    rng = np.random.default_rng(0)
    n = 6000
    x, s = rng.normal(size=n), rng.choice(["a", "b", "c"], n)
    y = (x + (s == "a") + rng.normal(0, 0.5, n) > 0.3).astype(int)
    pdf = pd.DataFrame({"month": np.where(np.arange(n) % 3, 202311, 202401), "target": y,
                        "x": np.where(rng.random(n) < 0.1, np.nan, x), "s": s,
                        "noise": rng.normal(size=n)})
    good = spark.createDataFrame(pdf)
    runs = run_models(spark, {"good": good, "bad": good.withColumn("target", F.lit(1))},
                      target="target", month="month", cutoff=202312, top_k=2,
                      settings=BoosterSettings(trees=8, depth=3))
    got = {r.table: r for r in runs.results.collect()}
    assert got["bad"].status == "failed" and "classes" in got["bad"].error
    assert got["good"].roc_auc > 0.8 and got["good"].train_samples == 4000
    assert got["good"].overfitting_roc_auc == pytest.approx(
        abs(got["good"].train_roc_auc - got["good"].roc_auc))
    assert {r.table: r.features for r in runs.dictionary().collect()} == {
        "good": ["x", "s"], "bad": []}
    assert runs.importances.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    save_runs(runs, str(tmp_path))
    assert spark.read.json(str(tmp_path / "results")).count() == 2
    assert load_feature_map(spark, str(tmp_path / "features")) == {"good": ["x", "s"], "bad": []}
    assert spark.read.json(str(tmp_path / "importances")).count() == 3
    assert runs.summary().first().top_feature_1 == "x"


def test_models_from_paths_report_what_cannot_be_read(spark, tmp_path):
    rows = [(202311 if i % 3 else 202401, i % 2, float(i % 2) + i % 5 / 9) for i in range(400)]
    path = str(tmp_path / "good.parquet")
    spark.createDataFrame(rows, "month int, target int, x double").write.parquet(path)
    runs = run_models(spark, [path, str(tmp_path / "gone.parquet"), "odd.txt"], target="target",
                      month="month", cutoff=202312, settings=BoosterSettings(trees=2, depth=2))
    got = {r.table: r for r in runs.results.collect()}
    assert {k: r.status for k, r in got.items()} == {
        "good": "done", "gone": "failed", "odd": "failed"}
    assert "unsupported" in got["odd"].error


def test_rows_without_a_time_are_kept(spark):
    rows = [(1, 20.0), (2, None), (3, 10.0), (4, 30.0), (5, None)]
    df = spark.createDataFrame(rows, "id long, t double")
    got = {r.id: r.row_index for r in row_index(df, "t", "id").collect()}
    assert got == {3: 0, 1: 1, 4: 2, 2: None, 5: None}
    blocks = {r.id: r.block for r in bins.temporal_index(df, "t", "id", 3).collect()}
    assert blocks == {3: 0, 1: 1, 4: 2, 2: None, 5: None}


def test_charts_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, "a")], "v double, g string")
    assert [(r.bin, r.lower, r.n_rows) for r in bins.histogram(df, "v", 2).collect()] == [
        (0, None, 0), (1, None, 0)]
    assert bins.density_2d(df, "v", "v").collect() == []
    assert bins.box_stats(df, "v", "g").collect() == []


# --- causal -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def trial(spark):
    """Known effect: 2 + x1 per unit of t."""
    rng = np.random.default_rng(5)
    n = 3000
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    t = 0.5 * x1 - 0.3 * x2 + rng.normal(size=n)
    y = (2 + x1) * t + x1 - x2 + rng.normal(0, 0.3, n)
    pdf = pd.DataFrame({"id": np.arange(n), "x1": x1, "x2": x2, "t": t, "y": y,
                        "s": np.where(x1 > 0, "p", "q"),
                        "y2": -1.5 * t + x2 + rng.normal(0, 0.1, n)})
    return spark.createDataFrame(pdf).withColumn("time", F.timestamp_seconds("id")).cache()


SPEC = c.CausalSpec(id="id", outcome="y", treatment="t", features=("x1", "x2"), strata="s",
                    nuisance="linear", folds=3, trees=10, outcome_depth=4, treatment_depth=5)


def test_least_squares_equals_numpy(trial):
    pdf = trial.toPandas()
    fit = fit_groups(trial, ["x1", "x2", "t"], ["y"], "s")[("p",)]["y"]
    part = pdf[pdf.s == "p"]
    a = np.c_[np.ones(len(part)), part.x1, part.x2, part.t]
    beta = np.linalg.lstsq(a, part.y.to_numpy(), rcond=None)[0]
    np.testing.assert_allclose([fit.intercept, *fit.slopes], beta, rtol=1e-8)


def test_dml_finds_the_effect(trial):
    res = c.crossfit_residuals(trial, SPEC).cache()
    linear = c.linear_dml(res, SPEC, final="linear")
    assert linear.ate == pytest.approx(2.0, abs=0.25)
    slope = linear.rows.agg(F.regr_slope("effect", "x1")).first()[0]
    assert slope == pytest.approx(1.0, abs=0.2)
    assert c.linear_dml(res, SPEC, final="lasso").ate == pytest.approx(2.0, abs=0.25)
    kernel = c.kernel_dml(res, SPEC)
    assert kernel.rows.agg(F.corr("effect", "x1")).first()[0] > 0.8
    forest = c.forest_dml(res, SPEC)
    assert forest.low < 2.0 < forest.high or abs(forest.ate - 2.0) < 0.3
    assert forest.importances[0][0] == "x1"


def test_bootstrap_interval_matches_theory(trial):
    from dataclasses import replace
    spec = replace(SPEC, outcome="y2")
    res = c.crossfit_residuals(trial, spec)
    row = c.bootstrap_ci(res, spec, 200).first()
    pdf = res.select("y_res", "t_res").toPandas()
    theta = (pdf.y_res * pdf.t_res).sum() / (pdf.t_res ** 2).sum()
    left = pdf.y_res - theta * pdf.t_res
    se = np.sqrt(((left * pdf.t_res) ** 2).sum()) / (pdf.t_res ** 2).sum()
    assert row.ate == pytest.approx(theta) and row.replicates == 200
    assert (row.high - row.low) / (2 * 1.96 * se) == pytest.approx(1.0, abs=0.25)
    assert row.low < -1.5 < row.high or abs(theta + 1.5) < 3 * se
    again = c.bootstrap_ci(res, spec, 200).first()
    assert (again.low, again.high) == (row.low, row.high)


def test_learners_agree_in_sign(trial):
    from dataclasses import replace
    for learner in (c.s_learner, c.t_learner, c.x_learner):
        est = learner(trial, SPEC)
        assert est.ate > 1.0, est.name
        assert est.rows.count() == 3000
    strata = c.dr_learner(trial, replace(SPEC, nuisance="strata"))
    trees = c.dr_learner(trial, replace(SPEC, nuisance="gbt"))
    assert strata.low < strata.ate < strata.high
    assert trees.ate > 1.0


def test_temporal_effect_equals_refitting(trial):
    from dataclasses import replace
    fast = [r.ate for r in e.temporal_ate(trial, SPEC, "time").orderBy("period").collect()]
    indexed = bins.temporal_index(trial, "time", "id", 5)
    slow = [c.linear_dml(c.crossfit_residuals(indexed.where(F.col("block") <= i), SPEC),
                         SPEC).ate for i in range(4)]
    np.testing.assert_allclose(fast, slow, rtol=1e-6)
    other = e.temporal_ate(trial, replace(SPEC, nuisance="strata"), "time", folds=2)
    assert other.count() == 1


def test_causal_report_is_complete(trial):
    from dataclasses import replace
    spec = replace(SPEC, trees=4, treatment_depth=3)
    report = causal_report(trial, spec, "x1", "y2", replicates=20)
    assert {r.model for r in report.comparison.collect()} == {
        "linear_dml", "forest_dml", "kernel_dml", "dr_learner", "s_learner", "t_learner",
        "x_learner"}
    summary = report.summary.first()
    assert summary.main_driver == "x1" and summary.significant
    assert report.scenarios.count() == 9 and report.policy.count() == 3000
    assert report.second_outcome.ate == pytest.approx(-1.5, abs=0.1)


def test_roles(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "id int, t int, y int, a int, b int")
    assert c.choose_roles(df, "t", ["y"], ["b", "zz"], drop=["id"]) == (["a", "b"], ["b"])


def test_lasso_and_linear_find_the_effect(trial):
    residuals = c.crossfit_residuals(trial, SPEC)
    for final in ("linear", "lasso"):
        found = c.linear_dml(residuals, SPEC, final=final, replicates=50)
        assert found.low < found.ate < found.high and found.high - found.low < 0.5
        row = found.rows.agg(F.avg("effect").alias("m"), F.corr("effect", "x1").alias("r")).first()
        assert row.m == pytest.approx(found.ate, abs=1e-6) and row.r > 0.95
    strong = c._final_stage(np.array([[4.0, 0, 8.0], [0, 9.0, 0.9], [8.0, 0.9, 20.0]]), 2, 0.2)
    assert strong[1] == 0.0 and 0 < strong[0] < 2.0  # soft thresholds: the weak term goes


def _outcomes(spark):
    rng = np.random.default_rng(11)
    n = 3000
    x, z = rng.normal(1e6, 1.0, n), rng.normal(size=n)  # one column far from 0
    t = 0.5 * (x - 1e6) + z + rng.normal(size=n)
    y = 2.0 * t + (x - 1e6) + rng.normal(size=n)
    pdf = pd.DataFrame({"id": range(n), "x": x, "z": z, "t": t, "y": y, "y2": -t + z})
    rows = spark.createDataFrame(pdf)
    return rows.withColumn("y2", F.when(F.col("id") % 3 != 0, F.col("y2")))


def test_many_outcomes_from_one_pass_equal_one_by_one(spark):
    """A missing outcome, a column far from 0, and the interval of redrawn blocks."""
    rows = _outcomes(spark)
    spec = c.CausalSpec(id="id", outcome="y", treatment="t", features=("x", "z"), nuisance="linear")
    together = c.linear_effects(rows, spec, ["y", "y2"], replicates=50)
    for outcome, truth, size in (("y", 2.0, 3000), ("y2", -1.0, 2000)):
        own = replace(spec, outcome=outcome)
        alone = c.linear_dml(c.crossfit_residuals(rows, own), own, replicates=50)
        made = together[outcome]
        assert made.ate == pytest.approx(alone.ate, abs=1e-6) == pytest.approx(truth, abs=0.1)
        assert (made.low, made.high) == pytest.approx((alone.low, alone.high), abs=1e-6)
        sums = made.rows.selectExpr("count(*) AS n", "sum(y_res * t_res) / sum(t_res * t_res) AS b"
                                    ).first()
        assert sums.n == size and sums.b == pytest.approx(made.ate, abs=1e-6)
    assert c.linear_effects(rows.limit(0), spec, ["y"])["y"].rows.count() == 0


def test_linear_effects_read_their_rows_once(spark):
    rows = _outcomes(spark).repartition(3).cache()
    rows.count()
    spec = c.CausalSpec(id="id", outcome="y", treatment="t", features=("x", "z"), nuisance="linear")
    spark.sparkContext.setJobGroup("linear-effects", "")
    try:
        c.linear_effects(rows, spec, ["y", "y2"])
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("linear-effects")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        rows.unpersist()
    assert 1 <= len(jobs) < 5


def _counted(spark, n=3000):
    """A causal table, and how many of its rows have been made so far."""
    made = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def noise(ids: pd.Series) -> pd.Series:
        made.add(len(ids))
        return pd.Series(np.sin(ids * 12.9898) * 43758.5453 % 1.0)

    a, b, t = noise.asNondeterministic()(F.col("id")), (F.col("id") * 7919 % 1000) / 500.0, (F.col("id") * 104729 % 997) / 997.0
    rows = spark.range(n).select("id", a.alias("x1"), b.alias("x2")).withColumn(
        "t", t + F.col("x1") * 0.5).withColumn("y", F.col("t") * (1 + F.col("x2")) + F.col("x1"))
    return rows.withColumn("s", F.col("id") % 3), made


COUNTED = c.CausalSpec(id="id", outcome="y", treatment="t", features=("x1", "x2"), nuisance="linear", strata="s")


def test_kernel_effects_make_their_rows_once(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    rows, made = _counted(spark)
    residual = c.crossfit_residuals(rows, COUNTED)
    found = c.kernel_dml(residual, COUNTED, size=20)
    got = found.rows.select("id", "effect").toPandas().sort_values("id")
    assert made.value == 3000
    # The same coefficients as the library's normal equations.
    known = residual.select("id", "t_res", "y_res", "x1", "x2").toPandas().sort_values("id")
    width = c.silverman_bandwidth(residual, COUNTED.features)
    rng = np.random.default_rng(COUNTED.seed)
    direction = (rng.normal(size=(20, 2)) / np.array([width["x1"], width["x2"]])).T
    waves = np.cos(known[["x1", "x2"]].to_numpy() @ direction + rng.uniform(0.0, 2 * np.pi, 20))
    basis = np.column_stack([np.ones(len(known)), waves * np.sqrt(2.0 / 20)])
    table = spark.createDataFrame(
        [((basis[i] * t).tolist(), float(y)) for i, (t, y) in enumerate(zip(known.t_res, known.y_res))],
        "z array<double>, y_res double").select(array_to_vector("z").alias("z"), "y_res")
    model = LinearRegression(featuresCol="z", labelCol="y_res", fitIntercept=False, standardization=False,
                             regParam=1e-3, solver="normal").fit(table)
    assert np.allclose(got.effect, basis @ model.coefficients.toArray(), atol=1e-8)
    assert found.ate == pytest.approx(got.effect.mean(), abs=1e-9)


def test_compared_models_make_their_rows_once(spark):
    from monthbook.session import written

    for estimate in (lambda df: c.t_learner(df, COUNTED, learner="linear"),
                     lambda df: c.dr_learner(df, replace(COUNTED, nuisance="strata"), final=False)):
        rows, made = _counted(spark)
        estimate(rows).rows.write.format("noop").mode("overwrite").save()
        assert made.value == 3000
    rows, made = _counted(spark)
    once = written(rows, "causal")
    found = [c.linear_dml(c.crossfit_residuals(once, COUNTED), COUNTED, final="linear"),
             c.t_learner(once, COUNTED, learner="linear")]
    assert e.compare_ate(found).count() == 2 and made.value == 3000


def test_models_of_classes_are_fitted_side_by_side(spark, monkeypatch):
    from monthbook.operators import training

    asked = []
    real = training.side_by_side
    monkeypatch.setattr(training, "side_by_side", lambda s, work, *a: asked.append(list(work)) or real(s, work, *a))
    rows = spark.range(900).select(F.lit(202401).alias("month"), (F.col("id") % 3).cast("int").alias("target"),
                                   (F.col("id") % 3 * 1000 + F.col("id")).cast("double").alias("x"))
    trained = training.train(rows, "target", "month", BoosterSettings(trees=20))
    assert asked == [["0", "1", "2"]] and len(trained.model.models) == 3
    assert training.score(rows, trained, "month").where("prediction != target").count() == 0
