"""Causal estimates, bins, chart tables and the score formulas behind them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.functions.scalars import (
    linear_score, loan_economics, logistic)
from monthbook.operators import bins, causal as c, effects as e
from monthbook.operators.honest import honest_forest
from monthbook.plans.causal_report import causal_report
from monthbook.session import written
from suite import fixtures as fx
from suite.registry import plain, query

LINEAR = c.CausalSpec(id="id", outcome="y", treatment="t", features=("balance",),
                      nuisance="linear", folds=5, fold="pmod(id, 5)")
TREES = c.CausalSpec(id="id", outcome="y", treatment="t",
                     features=("balance", "quantity", "lines"), nuisance="gbt")
STRATA = replace(LINEAR, strata="segment", nuisance="strata")


def _residual_sql(y: str = "y") -> str:
    return f"""
, fits AS (SELECT k, regr_slope({y}, balance) AS by1, regr_intercept({y}, balance) AS by0,
    regr_slope(t, balance) AS bt1, regr_intercept(t, balance) AS bt0
  FROM causal, (SELECT unnest(range(5)) AS k) WHERE id % 5 <> k GROUP BY k)
, res AS (SELECT c.*, k AS fold, {y} - (by0 + by1 * balance) AS y_res,
    t - (bt0 + bt1 * balance) AS t_res FROM causal c JOIN fits ON id % 5 = k)"""


BASE = f"WITH {fx.CAUSAL}"


@query("crossfit_residuals", BASE + _residual_sql() + " SELECT id, fold, "
       "round(y_res, 6) AS y_res, round(t_res, 6) AS t_res FROM res")
def residuals(spark: SparkSession, sf: str) -> DataFrame:
    rows = c.crossfit_residuals(fx.causal(spark, sf), LINEAR)
    return plain(rows.select("id", "fold", "y_res", "t_res"), 6, ("y_res", "t_res"))


@query("crossfit_strata", BASE + """
, cell AS (SELECT segment, id % 5 AS fold, sum(y) AS sy, sum(t) AS st, count(*) AS n
  FROM causal GROUP BY ALL)
, rest AS (SELECT a.segment, a.fold, sum(b.sy) / sum(b.n) AS my, sum(b.st) / sum(b.n) AS mt
  FROM cell a JOIN cell b ON a.segment = b.segment AND a.fold <> b.fold GROUP BY ALL)
SELECT id, fold, round(y - my, 6) AS y_res, round(t - mt, 6) AS t_res
FROM causal c JOIN rest r ON c.segment = r.segment AND c.id % 5 = r.fold""")
def strata_residuals(spark: SparkSession, sf: str) -> DataFrame:
    rows = c.crossfit_residuals(fx.causal(spark, sf), STRATA)
    return plain(rows.select("id", "fold", "y_res", "t_res"), 6, ("y_res", "t_res"))


def _one(spark: SparkSession, *parts: tuple[str, float | None]) -> DataFrame:
    """Rows (outcome, ate) of finished estimates."""
    return spark.createDataFrame(list(parts), "outcome string, ate double")


@query("linear_dml", BASE + _residual_sql("y") + _residual_sql("y2")
       .replace("fits", "fits2").replace("res AS", "res2 AS") +
       " SELECT 'y' AS outcome, round(sum(y_res * t_res) / sum(t_res * t_res), 6) AS ate FROM res "
       "UNION ALL SELECT 'y2', round(sum(y_res * t_res) / sum(t_res * t_res), 6) FROM res2")
def dml(spark: SparkSession, sf: str) -> DataFrame:
    """Both outcomes from one pass over the rows."""
    found = c.linear_effects(fx.causal(spark, sf), LINEAR, ["y", "y2"])
    return plain(_one(spark, *[(y, made.ate) for y, made in found.items()]), 6, ("ate",))


# Effect a + b * balance: the two normal equations of the final stage, written out.
_HETERO = _residual_sql() + """
, g AS (SELECT sum(t_res * t_res) AS a, sum(t_res * t_res * balance) AS b,
    sum(t_res * t_res * balance * balance) AS d, sum(y_res * t_res) AS p,
    sum(y_res * t_res * balance) AS q FROM res)
, theta AS (SELECT (p * d - q * b) / (a * d - b * b) AS c0,
    (a * q - b * p) / (a * d - b * b) AS c1 FROM g)"""


@query("linear_dml_effects", BASE + _HETERO + " SELECT id, round(c0 + c1 * balance, 6) "
       "AS effect FROM causal, theta")
def dml_effects(spark: SparkSession, sf: str) -> DataFrame:
    residual = c.crossfit_residuals(fx.causal(spark, sf), LINEAR)
    rows = c.linear_dml(residual, LINEAR, final="linear").rows
    return plain(rows.select("id", "effect"), 6, ("effect",))


_STEPS = ", ".join(f"{p!r}::DOUBLE" for p in c._poisson())


# The normal equations of each block of rows, redrawn 100 times.
_BANDS = _HETERO + f"""
, blocks AS (SELECT CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 2) AS BIGINT) AS blk,
    sum(t_res * t_res) AS a, sum(t_res * t_res * balance) AS b,
    sum(t_res * t_res * balance * balance) AS d, sum(y_res * t_res) AS p,
    sum(y_res * t_res * balance) AS q FROM res GROUP BY 1)
, weighted AS (SELECT blocks.*, r, CAST('0x' || substr(md5(blk || '-' || r || '-{LINEAR.seed}'), 1, 8)
    AS BIGINT) / 4294967296.0::DOUBLE AS u FROM blocks, (SELECT unnest(range(1, 101)) AS r))
, redrawn AS (SELECT r, sum(w * a) AS a, sum(w * b) AS b, sum(w * d) AS d, sum(w * p) AS p,
    sum(w * q) AS q FROM (SELECT *, len(list_filter([{_STEPS}], lambda x: u > x)) AS w
    FROM weighted) GROUP BY r)
, spread AS (SELECT var_samp(c0) AS v0, var_samp(c1) AS v1, covar_samp(c0, c1) AS v01
  FROM (SELECT (p * d - q * b) / (a * d - b * b) AS c0,
    (a * q - b * p) / (a * d - b * b) AS c1 FROM redrawn))"""


@query("linear_dml_bands", BASE + _BANDS + """
, bands AS (SELECT id, c0 + c1 * balance AS effect,
    1.959964 * sqrt(greatest(v0 + 2 * v01 * balance + v1 * balance * balance, 0)) AS reach
  FROM causal, theta, spread)
SELECT id, round(effect, 6) AS effect, round(effect - reach, 5) AS effect_low,
  round(effect + reach, 5) AS effect_high FROM bands""")
def dml_bands(spark: SparkSession, sf: str) -> DataFrame:
    """The effect of every row with its 95 % interval."""
    residual = c.crossfit_residuals(fx.causal(spark, sf), LINEAR)
    rows = c.linear_dml(residual, LINEAR, final="linear", replicates=100).rows
    rows = plain(rows.select("id", "effect", "effect_low", "effect_high"), 6, ("effect",))
    return plain(rows, 5, ("effect_low", "effect_high"))


_RATES = ", ".join(f"({r}::DOUBLE)" for r in e.SCENARIO_RATES)


@query("scenarios", BASE + _HETERO + f"""
, m AS (SELECT quantile_cont(balance, 0.5) AS x, avg(y) AS my, avg(t) AS mt FROM causal)
SELECT rate, round((c0 + c1 * x) * (rate - mt), 6) AS outcome_effect,
  round(my + (c0 + c1 * x) * (rate - mt), 6) AS expected_outcome
FROM theta, m, (VALUES {_RATES}) v(rate)""")
def scenario_table(spark: SparkSession, sf: str) -> DataFrame:
    residual = c.crossfit_residuals(fx.causal(spark, sf), LINEAR)
    table = e.scenarios(c.linear_dml(residual, LINEAR, final="linear"), LINEAR)
    return plain(table, 6, ("outcome_effect", "expected_outcome"))


@query("sensitivity", BASE + _residual_sql() + """
, a AS (SELECT sum(y_res * t_res) / sum(t_res * t_res) AS ate FROM res)
SELECT gamma, round(ate * gamma, 6) AS adjusted_ate,
  round((ate * gamma / ate - 1) * 100, 6) AS change_pct
FROM a, (VALUES (0.8::DOUBLE), (1.0::DOUBLE), (1.2::DOUBLE), (1.5::DOUBLE)) v(gamma)""")
def confounding(spark: SparkSession, sf: str) -> DataFrame:
    ate = c.linear_dml(c.crossfit_residuals(fx.causal(spark, sf), LINEAR), LINEAR).ate
    return plain(e.sensitivity(spark, ate), 6, ("adjusted_ate", "change_pct"))


_TREATED = """
, cut AS (SELECT quantile_cont(t, 0.5) AS m FROM causal)
, arms AS (SELECT causal.*, CASE WHEN t > m THEN 1 ELSE 0 END AS treated FROM causal, cut)"""
_T_EFFECT = _TREATED + """
, f AS (SELECT treated, regr_slope(y, balance) AS s, regr_intercept(y, balance) AS i
  FROM arms GROUP BY treated)
, te AS (SELECT id, (a.i + a.s * balance) - (b.i + b.s * balance) AS effect
  FROM causal, f a, f b WHERE a.treated = 1 AND b.treated = 0)"""


@query("t_learner", BASE + _T_EFFECT + " SELECT id, round(effect, 6) AS effect FROM te")
def t_linear(spark: SparkSession, sf: str) -> DataFrame:
    rows = c.t_learner(fx.causal(spark, sf), LINEAR, learner="linear").rows
    return plain(rows.select("id", "effect"), 6, ("effect",))


_DR = _TREATED + """
, cell AS (SELECT segment, id % 5 AS fold, count(*) AS n, sum(treated) AS n1,
    sum(y) FILTER (treated = 1) AS s1, sum(y) FILTER (treated = 0) AS s0
  FROM arms GROUP BY ALL)
, rest AS (SELECT a.segment, a.fold, sum(b.n1) / sum(b.n) AS p, sum(b.s1) / sum(b.n1) AS m1,
    sum(b.s0) / (sum(b.n) - sum(b.n1)) AS m0
  FROM cell a JOIN cell b ON a.segment = b.segment AND a.fold <> b.fold GROUP BY ALL)
, dr AS (SELECT id, m1 - m0 + treated * (y - m1) / p - (1 - treated) * (y - m0) / (1 - p)
    AS effect FROM arms JOIN rest ON arms.segment = rest.segment AND id % 5 = fold)"""


@query("dr_learner", BASE + _DR + " SELECT id, round(effect, 6) AS effect FROM dr")
def dr_strata(spark: SparkSession, sf: str) -> DataFrame:
    rows = c.dr_learner(fx.causal(spark, sf), STRATA, final=False).rows
    return plain(rows.select("id", "effect"), 6, ("effect",))


@query("compare_ate", BASE + _HETERO + _T_EFFECT + _DR.replace(_TREATED, "") + """
SELECT 'linear_dml' AS model, round(avg(c0 + c1 * balance), 6) AS ate FROM causal, theta
UNION ALL SELECT 't_learner', round(avg(effect), 6) FROM te
UNION ALL SELECT 'dr_learner', round(avg(effect), 6) FROM dr""")
def compare(spark: SparkSession, sf: str) -> DataFrame:
    rows = written(fx.causal(spark, sf), "causal")  # joined once for all three
    found = [c.linear_dml(c.crossfit_residuals(rows, LINEAR), LINEAR, final="linear"),
             c.t_learner(rows, LINEAR, learner="linear"),
             c.dr_learner(rows, STRATA, final=False)]
    return plain(e.compare_ate(found), 6, ("ate",))


_BLOCKS = """
, numbered AS (SELECT *, row_number() OVER (ORDER BY time, id) - 1 AS i,
    (SELECT count(*) // 5 FROM causal) AS size FROM causal)
, blocks AS (SELECT *, i // size AS block FROM numbered WHERE i < 5 * size)"""


@query("temporal_splits", BASE + _BLOCKS + """
SELECT CAST(p AS BIGINT) AS fold, part, count(*) AS n_rows, min(time) AS first_time,
  max(time) AS last_time
FROM blocks, (SELECT unnest(range(4)) AS p), (VALUES ('train'), ('test')) v(part)
WHERE CASE WHEN part = 'train' THEN block <= p ELSE block = p + 1 END GROUP BY ALL""")
def splits(spark: SparkSession, sf: str) -> DataFrame:
    return plain(bins.temporal_splits(fx.causal(spark, sf), "time", "id", 5))


_PERIODS = BASE + _BLOCKS + """
, f AS (SELECT p, k, regr_slope(y, balance) AS y1, regr_intercept(y, balance) AS y0,
    regr_slope(t, balance) AS t1, regr_intercept(t, balance) AS t0
  FROM blocks, (SELECT unnest(range(4)) AS p), (SELECT unnest(range(5)) AS k)
  WHERE block <= p AND id % 5 <> k GROUP BY p, k)
, r AS (SELECT p, y - (y0 + y1 * balance) AS yr, t - (t0 + t1 * balance) AS tr
  FROM blocks JOIN f ON block <= p AND id % 5 = k)
, periods AS (SELECT p, sum(yr * tr) / sum(tr * tr) AS ate FROM r GROUP BY p)"""


@query("temporal_ate", _PERIODS + " SELECT CAST(p AS BIGINT) AS period, round(ate, 6) AS ate "
       "FROM periods")
def over_time(spark: SparkSession, sf: str) -> DataFrame:
    ates = e.temporal_ate(fx.causal(spark, sf), LINEAR, "time")
    return plain(ates, 6, ("ate",))


@query("stability", _PERIODS + " SELECT round(avg(ate), 6) AS mean_ate, "
       "round(stddev_pop(ate), 6) AS std_ate, count(*) AS periods FROM periods")
def stable(spark: SparkSession, sf: str) -> DataFrame:
    ates = e.temporal_ate(fx.causal(spark, sf), LINEAR, "time")
    return plain(e.stability(ates), 6, ("mean_ate", "std_ate"))


# --- bins and chart tables --------------------------------------------------------------

EFF = f"WITH {fx.EFFECTS}"


def _edges_sql(column: str, n: int) -> str:
    marks = ", ".join(f"quantile_cont({column}, {i / n!r}) AS q{i}" for i in range(n + 1))
    return f", edges AS (SELECT {marks} FROM effects)"


def _bin_sql(column: str, n: int) -> str:
    cases = " ".join(f"WHEN {column} <= q{i} THEN 'Q{i}'" for i in range(1, n + 1))
    return f"CASE {cases} END"


@query("quantile_bins", EFF + _edges_sql("balance", 5) + f" SELECT id, {_bin_sql('balance', 5)} "
       "AS bin FROM effects, edges")
def quantile_bin(spark: SparkSession, sf: str) -> DataFrame:
    return bins.quantile_bins(fx.effects(spark, sf), "balance", 5).select("id", "bin")


@query("effect_by_bin", EFF + _edges_sql("balance", 5) + f"""
, binned AS (SELECT effect, {_bin_sql('balance', 5)} AS bin, edges.* FROM effects, edges)
SELECT bin, round(avg(effect), 6) AS mean, round(stddev_samp(effect), 6) AS std,
  count(effect) AS count,
  round(any_value(CASE bin {' '.join(f"WHEN 'Q{i + 1}' THEN q{i}" for i in range(5))} END), 6)
    AS lower,
  round(any_value(CASE bin {' '.join(f"WHEN 'Q{i + 1}' THEN q{i + 1}" for i in range(5))} END),
    6) AS upper FROM binned GROUP BY bin""")
def by_bin(spark: SparkSession, sf: str) -> DataFrame:
    table = bins.effect_by_bin(fx.effects(spark, sf), "effect", "balance", 5)
    return plain(table, 6, ("lower", "upper", "mean", "std"))


_TERM = """CASE WHEN quantity * 2 > 0 AND quantity * 2 <= 180 THEN 'Curto'
  WHEN quantity * 2 > 180 AND quantity * 2 <= 300 THEN 'Médio'
  WHEN quantity * 2 > 300 AND quantity * 2 <= 500 THEN 'Longo' END"""


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.effects(spark, sf).withColumn("term", F.col("quantity") * 2)
    return bins.fixed_bins(rows, "term")


@query("fixed_bins", EFF + f" SELECT id, {_TERM} AS bin FROM effects")
def fixed_bin(spark: SparkSession, sf: str) -> DataFrame:
    return _terms(spark, sf).select("id", "bin")


@query("box_stats", EFF + f"""
, terms AS (SELECT effect, {_TERM} AS bin FROM effects)
, box AS (SELECT bin, quantile_cont(effect, 0.25) AS q1, quantile_cont(effect, 0.5) AS median,
    quantile_cont(effect, 0.75) AS q3 FROM terms WHERE bin IS NOT NULL GROUP BY bin)
, marked AS (SELECT t.*, q1, median, q3, effect BETWEEN q1 - (q3 - q1) * 1.5
    AND q3 + (q3 - q1) * 1.5 AS inside FROM terms t JOIN box USING (bin))
SELECT bin, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
  round(any_value(q3), 6) AS q3, round(min(effect) FILTER (inside), 6) AS whisker_low,
  round(max(effect) FILTER (inside), 6) AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers, count(*) AS n_rows FROM marked GROUP BY bin""")
def boxes(spark: SparkSession, sf: str) -> DataFrame:
    table = bins.box_stats(_terms(spark, sf), "effect", "bin")
    return plain(table, 6, ("q1", "median", "q3", "whisker_low", "whisker_high"))


@query("histogram", EFF + """
, lim AS (SELECT min(t) AS lo, max(t) AS hi FROM effects)
, h AS (SELECT least(CAST(floor((t - lo) / ((hi - lo) / 30)) AS BIGINT), 29) AS bin,
    count(*) AS n FROM effects, lim GROUP BY 1)
SELECT b AS bin, round(lo + b * ((hi - lo) / 30), 6) AS lower,
  round(lo + (b + 1) * ((hi - lo) / 30), 6) AS upper, coalesce(n, 0) AS n_rows
FROM (SELECT unnest(range(30)) AS b), lim LEFT JOIN h ON h.bin = b""")
def hist(spark: SparkSession, sf: str) -> DataFrame:
    table = bins.histogram(fx.effects(spark, sf), "t", 30)
    return plain(table, 6, ("lower", "upper"))


@query("density_2d", EFF + """
, p AS (SELECT log10(y * 1000) AS x, effect FROM effects)
, lim AS (SELECT min(x) AS x0, max(x) AS x1, min(effect) AS e0, max(effect) AS e1 FROM p)
SELECT least(CAST(floor((x - x0) / ((x1 - x0) / 25)) AS BIGINT), 24) AS x_bin,
  least(CAST(floor((effect - e0) / ((e1 - e0) / 25)) AS BIGINT), 24) AS y_bin,
  count(*) AS n_rows FROM p, lim GROUP BY 1, 2""")
def density(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.effects(spark, sf).withColumn("x", F.log10(F.col("y") * 1000))
    return plain(bins.density_2d(rows, "x", "effect", 25))


@query("scatter_sample", EFF + " SELECT id, t, round(effect, 8) AS effect, balance FROM effects "
       "WHERE CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) "
       "< CAST(0.1 * 4294967296 AS BIGINT)")
def scatter(spark: SparkSession, sf: str) -> DataFrame:
    points = bins.scatter_sample(fx.effects(spark, sf), "id", ["t", "effect", "balance"], 0.1)
    return plain(points, 8, ("effect",))


@query("effect_summary", EFF + _edges_sql("balance", 5) + f"""
, b AS (SELECT {_bin_sql('balance', 5)} AS bin, avg(effect) AS mean FROM effects, edges
    GROUP BY 1)
, a AS (SELECT avg(effect) AS ate, stddev_samp(effect) / sqrt(count(*)) AS se FROM effects)
, d AS (SELECT CASE WHEN abs(corr(effect, balance)) >= abs(corr(effect, quantity))
    THEN 'balance' ELSE 'quantity' END AS main_driver FROM effects)
SELECT round((SELECT max(mean) - min(mean) FROM b), 6) AS effect_range, main_driver,
  round(ate, 6) AS ate, (ate - 1.959964 * se) * (ate + 1.959964 * se) > 0 AS significant
FROM a, d""")
def summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.effects(spark, sf)
    row = rows.agg(F.avg("effect").alias("m"), F.stddev_samp("effect").alias("s"),
                   F.count("effect").alias("n")).first()
    drivers = rows.agg(*[F.abs(F.corr("effect", x)).alias(x) for x in ("balance", "quantity")]
                       ).unpivot([], ["balance", "quantity"], "feature", "importance")
    reach = 1.959964 * row.s / row.n ** 0.5
    table = e.effect_summary(bins.effect_by_bin(rows, "effect", "balance", 5), drivers, row.m,
                             row.m - reach, row.m + reach)
    return plain(table, 6, ("effect_range", "ate"))


# --- score formulas ---------------------------------------------------------------------

_SCORE = "-1.5 + rate * 0.2 + down_payment * -3.0 + base_rate * 0.1 + ln(abs(balance) + 1) * 0.05"
LOAN = f"WITH {fx.LOANS}"


def _scored(rows: DataFrame) -> DataFrame:
    score = linear_score(-1.5, {"rate": 0.2, "down_payment": -3.0, "base_rate": 0.1},
                         F.log(F.abs("balance") + 1) * 0.05)
    return rows.withColumn("chance", logistic(score))


@query("logistic_score",
       LOAN + f" SELECT id, round(1 / (1 + exp(-({_SCORE}))), 8) AS chance FROM loans")
def logistic_scores(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_scored(fx.loans(spark, sf)).select("id", "chance"), 8, ("chance",))


@query("loan_npv", LOAN + f"""
, s AS (SELECT *, price * (1 - down_payment) AS financed,
  1 / (1 + exp(-({_SCORE}))) AS d FROM loans)
, n AS (SELECT id, financed, financed * rate / 100 * months / 12 AS interest_income,
  financed * d * 0.5 AS expected_loss, financed * base_rate / 100 * months / 12 AS capital_cost
  FROM s)
SELECT id, financed, interest_income, round(expected_loss, 3) AS expected_loss, capital_cost,
  round(interest_income - expected_loss - capital_cost, 3) AS npv FROM n""")
def npv(spark: SparkSession, sf: str) -> DataFrame:
    rows = _scored(fx.loans(spark, sf))
    made = loan_economics(F.col("price"), F.col("down_payment"), F.col("rate"),
                          F.col("base_rate"), F.col("months"), F.col("chance"))
    table = rows.select("id", *[v.alias(k) for k, v in made.items()])
    return plain(table, 3, ("expected_loss", "npv"))


# --- tree-based estimators (rows only) --------------------------------------------------

def _tree_residuals(spark: SparkSession, sf: str) -> DataFrame:
    return c.crossfit_residuals(fx.causal(spark, sf), TREES)


@query("crossfit_trees", BASE + " SELECT id, round(y, 6) AS y, round(t, 6) AS t, "
       "true AS in_range FROM causal")
def tree_residuals(spark: SparkSession, sf: str) -> DataFrame:
    """Prediction and residual of every row add up; trees predict means of other folds' rows."""
    rows = _tree_residuals(spark, sf)
    low, high = rows.agg(F.min("t"), F.max("t")).first()
    return plain(rows.select("id", (F.col("y_hat") + F.col("y_res")).alias("y"),
                             (F.col("t_hat") + F.col("t_res")).alias("t"),
                             F.col("t_hat").between(low, high).alias("in_range")), 6, ("y", "t"))


@query("bootstrap_ci", BASE + _residual_sql() + f"""
, blocks AS (SELECT CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 2) AS BIGINT) AS b,
    sum(y_res * t_res) AS p, sum(t_res * t_res) AS q FROM res GROUP BY 1)
, drawn AS (SELECT r, p, q, CAST('0x' || substr(md5(b || '-' || r || '-{LINEAR.seed}'), 1, 8)
    AS BIGINT) / 4294967296.0::DOUBLE AS u FROM blocks, (SELECT unnest(range(1, 101)) AS r))
, thetas AS (SELECT r, sum(w * p) / sum(w * q) AS theta FROM (
    SELECT r, p, q, len(list_filter([{_STEPS}], lambda x: u > x)) AS w FROM drawn) GROUP BY r)
SELECT (SELECT round(sum(p) / sum(q), 6) FROM blocks) AS ate,
  round(quantile_cont(theta, 0.025), 6) AS low, round(quantile_cont(theta, 0.975), 6) AS high,
  count(*) AS replicates FROM thetas""")
def interval(spark: SparkSession, sf: str) -> DataFrame:
    found = c.bootstrap_ci(c.crossfit_residuals(fx.causal(spark, sf), LINEAR), LINEAR)
    return plain(found, 6, ("ate", "low", "high"))


# What trees say has no counterpart in SQL; who is scored, and into which arm a row falls, has.
_KNOWN = "(effect IS NOT NULL AND NOT isnan(effect)) AS known"


@query("forest_dml", BASE + " SELECT id, true AS known FROM causal")
def forest(spark: SparkSession, sf: str) -> DataFrame:
    return c.forest_dml(_tree_residuals(spark, sf), TREES).rows.selectExpr("id", _KNOWN)


THREE = replace(LINEAR, features=("balance", "quantity", "lines"))


@query("forest_intervals")
def forest_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Every row's effect and its interval, on linear residuals; trees have no SQL."""
    residual = c.crossfit_residuals(fx.causal(spark, sf), THREE)
    found = honest_forest(residual, replace(TREES, nuisance="linear"))
    return found.rows.select("id", "effect", "effect_low", "effect_high")


@query("kernel_dml", BASE + " SELECT id, true AS known FROM causal")
def kernel(spark: SparkSession, sf: str) -> DataFrame:
    residual = c.crossfit_residuals(fx.causal(spark, sf), THREE)
    return c.kernel_dml(residual, THREE).rows.selectExpr("id", _KNOWN)


@query("lasso_dml", BASE + " SELECT count(*) AS n_rows, true AS inside, true AS known FROM causal")
def lasso(spark: SparkSession, sf: str) -> DataFrame:
    """Three features, the penalty chosen by folds, and the interval of the mean effect."""
    residual = c.crossfit_residuals(fx.causal(spark, sf), THREE)
    found = c.linear_dml(residual, THREE, final="lasso", replicates=100)
    return found.rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(found.low <= found.ate <= found.high).alias("inside"),
        (F.abs(F.avg("effect") - F.lit(found.ate)) < 1e-6).alias("known"))


# Three terms of unit length: coordinate descent for each penalty on all rows and without each
# fold; no penalty is solved by determinants.  The penalty that misses left-out folds least wins.
_SUMS = ", ".join(f"sum({v}) AS {n}" for n, v in {
    "a00": "t_res * t_res", "a01": "t_res * t_res * balance", "a02": "t_res * t_res * quantity",
    "a11": "t_res * balance * t_res * balance", "a12": "t_res * balance * t_res * quantity",
    "a22": "t_res * quantity * t_res * quantity", "b0": "t_res * y_res",
    "b1": "t_res * balance * y_res", "b2": "t_res * quantity * y_res", "yy": "y_res * y_res",
}.items())
_PARTS = ("a00", "a01", "a02", "a11", "a12", "a22", "b0", "b1", "b2", "yy")
_SHRINK = "sign({0}) * greatest(abs({0}) - size, 0)"
_LASSO = _residual_sql() + f"""
, parts AS (SELECT fold, {_SUMS} FROM res GROUP BY fold)
, whole AS (SELECT {", ".join(f"sum({n}) AS {n}" for n in _PARTS)} FROM parts)
, train AS (SELECT -1 AS fold, * FROM whole UNION ALL
  SELECT p.fold, {", ".join(f"w.{n} - p.{n}" for n in _PARTS)} FROM parts p, whole w)
, unit AS (SELECT fold, sqrt(a00) AS s0, sqrt(a11) AS s1, sqrt(a22) AS s2,
    a01 / sqrt(a00) / sqrt(a11) AS g01, a02 / sqrt(a00) / sqrt(a22) AS g02,
    a12 / sqrt(a11) / sqrt(a22) AS g12, b0 / sqrt(a00) AS c0, b1 / sqrt(a11) AS c1,
    b2 / sqrt(a22) AS c2 FROM train)
, tries AS (SELECT unit.*, penalty, penalty * greatest(abs(c0), abs(c1), abs(c2)) AS size
  FROM unit, (VALUES {", ".join(f"({q!r}::DOUBLE)" for q in c._PENALTIES if q)}) v(penalty))
, descent AS (SELECT fold, penalty, 0 AS i, 0.0::DOUBLE AS x0, 0.0::DOUBLE AS x1, 0.0::DOUBLE AS x2
  FROM tries UNION ALL
  SELECT fold, penalty, i + 1, x0, x1, {_SHRINK.format("(c2 - g02 * x0 - g12 * x1)")} FROM (
    SELECT fold, penalty, i, x0, {_SHRINK.format("(c1 - g01 * x0 - g12 * x2)")} AS x1, x2, size,
      g02, g12, c2 FROM (
      SELECT fold, penalty, i, {_SHRINK.format("(c0 - g01 * x1 - g02 * x2)")} AS x0, x1, x2, size,
        g01, g02, g12, c1, c2 FROM descent JOIN tries USING (fold, penalty) WHERE i < 1000)))
, solved AS (SELECT fold, penalty, x0, x1, x2 FROM descent WHERE i = 1000 UNION ALL
  SELECT fold, 0, (c0 * (1 - g12 * g12) - g01 * (c1 - g12 * c2) + g02 * (c1 * g12 - c2)) / det,
    (c1 - g12 * c2 - c0 * (g01 - g12 * g02) + g02 * (g01 * c2 - c1 * g02)) / det,
    (c2 - c1 * g12 - g01 * (g01 * c2 - c1 * g02) + c0 * (g01 * g12 - g02)) / det
  FROM (SELECT *, 1 - g12 * g12 - g01 * (g01 - g12 * g02) + g02 * (g01 * g12 - g02) AS det FROM unit))
, beta AS (SELECT fold, penalty, x0 / s0 AS x0, x1 / s1 AS x1, x2 / s2 AS x2
  FROM solved JOIN unit USING (fold))
, miss AS (SELECT penalty, sum(yy - 2 * (x0 * b0 + x1 * b1 + x2 * b2) + x0 * x0 * a00
    + x1 * x1 * a11 + x2 * x2 * a22 + 2 * (x0 * x1 * a01 + x0 * x2 * a02 + x1 * x2 * a12)) AS m
  FROM beta JOIN parts USING (fold) GROUP BY penalty)
, best AS (SELECT * FROM beta WHERE fold = -1
  AND penalty = (SELECT penalty FROM miss ORDER BY m, penalty LIMIT 1))"""


@query("lasso_dml_effects", BASE.replace("WITH", "WITH RECURSIVE", 1) + _LASSO + """
SELECT id, round(x0 + x1 * balance + x2 * quantity, 6) AS effect FROM causal, best""")
def lasso_effects(spark: SparkSession, sf: str) -> DataFrame:
    """The effect of every row, sparse in two features, with the penalty chosen by folds."""
    spec = replace(LINEAR, features=("balance", "quantity"))
    residual = c.crossfit_residuals(fx.causal(spark, sf), LINEAR)
    rows = c.linear_dml(residual, spec, final="lasso").rows
    return plain(rows.select("id", "effect"), 6, ("effect",))


def _register_learner(key: str, learner) -> None:
    @query(key, BASE + " SELECT id, CAST(t > (SELECT quantile_cont(t, 0.5) FROM causal) AS BIGINT) "
           "AS treated, true AS known FROM causal")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return plain(learner(fx.causal(spark, sf), TREES).rows.selectExpr("id", "treated", _KNOWN))


for _key, _learner in (("s_learner", c.s_learner), ("t_learner_forest", c.t_learner),
                       ("x_learner", c.x_learner), ("dr_learner_trees", c.dr_learner)):
    _register_learner(_key, _learner)


@query("effect_drivers", "SELECT CAST(3 AS BIGINT) AS features, 1.0::DOUBLE AS total, "
       "'balance' AS main_driver")
def drivers(spark: SparkSession, sf: str) -> DataFrame:
    """The effect is mostly made of the balance: that is what its tree must find."""
    found = e.effect_drivers(fx.effects(spark, sf), ["balance", "quantity", "lines"])
    return plain(found.agg(F.countDistinct("feature").alias("features"),
                           F.round(F.sum("importance"), 6).alias("total"),
                           F.max_by("feature", "importance").alias("main_driver")))


@query("policy_tree", EFF + " SELECT count(*) AS n_rows, round(avg(effect), 6) AS mean_effect, "
       "true AS treats_the_better FROM effects")
def policy(spark: SparkSession, sf: str) -> DataFrame:
    """All rows get a choice, and those chosen have at least the others' mean effect."""
    chosen, _ = e.policy_tree(fx.effects(spark, sf), ["balance", "quantity", "lines"])
    treated = F.avg(F.when(F.col("treat") == 1, F.col("effect")))
    others = F.avg(F.when(F.col("treat") == 0, F.col("effect")))
    return plain(chosen.agg(F.count(F.lit(1)).alias("n_rows"), F.avg("effect").alias("mean_effect"),
                            F.coalesce(treated >= others, F.lit(True)).alias("treats_the_better")),
                 6, ("mean_effect",))


_CUTS = ", ".join(repr(i / e.POLICY_BINS) for i in range(1, e.POLICY_BINS))
_POLICY = EFF + f"""
, gains AS (SELECT id, balance, quantity, lines, effect - {e.TREATMENT_COST!r} AS gain FROM effects)
, cuts AS (SELECT DISTINCT f, cut FROM (
    SELECT 0 AS f, unnest(quantile_cont(balance, [{_CUTS}])) AS cut FROM gains UNION ALL
    SELECT 1, unnest(quantile_cont(quantity, [{_CUTS}])) FROM gains UNION ALL
    SELECT 2, unnest(quantile_cont(lines, [{_CUTS}])) FROM gains))
, level0 AS (SELECT id, gain, [balance, quantity, lines] AS x, 0 AS node FROM gains)"""


def _level_sql(k: int) -> str:
    """The best cut of each group of level ``k``, and the groups below it."""
    return f"""
, split{k} AS (SELECT node, f, cut, sum(gain) FILTER (x[f + 1] <= cut) AS l,
    sum(gain) FILTER (x[f + 1] > cut) AS r FROM level{k}, cuts GROUP BY node, f, cut
  HAVING count(*) FILTER (x[f + 1] <= cut) >= {e.TREE_LEAF}
    AND count(*) FILTER (x[f + 1] > cut) >= {e.TREE_LEAF})
, best{k} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY
    greatest(l, 0) + greatest(r, 0) DESC, f, cut) AS place FROM split{k})
  WHERE place = 1 AND greatest(l, 0) + greatest(r, 0) > greatest(l + r, 0)
    + 1e-9 * greatest(1, greatest(l + r, 0)))
, level{k + 1} AS (SELECT id, gain, x, CASE WHEN f IS NULL THEN a.node
    WHEN x[f + 1] <= cut THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node
  FROM level{k} a LEFT JOIN best{k} b ON a.node = b.node)"""


def _register_policy(depth: int) -> None:
    levels = "".join(_level_sql(k) for k in range(depth))

    @query(f"policy_tree_{depth}", _POLICY + levels + f"""
SELECT id, CAST(sum(gain) OVER (PARTITION BY node) > 0 AS BIGINT) AS treat FROM level{depth}""")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        chosen, _ = e.policy_tree(fx.effects(spark, sf), ["balance", "quantity", "lines"], depth=depth)
        return plain(chosen.select("id", "treat"))


_register_policy(1)
_register_policy(2)


@query("causal_report", """SELECT m AS model, true AS known FROM (VALUES ('linear_dml'),
  ('forest_dml'), ('kernel_dml'), ('dr_learner'), ('s_learner'), ('t_learner'), ('x_learner')) v(m)""")
def report(spark: SparkSession, sf: str) -> DataFrame:
    """All seven estimators, each with a mean effect."""
    spec = replace(TREES, nuisance="linear")
    found = causal_report(fx.causal(spark, sf), spec, "balance", "y2").comparison
    return found.select("model", F.col("ate").isNotNull().alias("known"))


# No SQL: what trees and kernels find has no counterpart there.
@query("causal_estimates")
def estimates(spark: SparkSession, sf: str) -> DataFrame:
    """The mean effect that each of the seven estimators finds, with its interval."""
    spec = replace(TREES, nuisance="linear")
    return causal_report(fx.causal(spark, sf), spec, "balance", "y2").comparison
