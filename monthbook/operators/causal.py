"""Effect of a treatment on an outcome: cross-fitted residuals and meta-learners.

Partially linear model by residual-on-residual regression (Robinson 1988; Chernozhukov et
al. 2018), R-learner (Nie and Wager 2021), S-, T- and X-learner (Kuenzel et al. 2019),
doubly robust learner (Kennedy 2023), random Fourier features (Rahimi and Recht 2007).

Nuisance models: ``linear`` (least squares), ``strata`` (group means) or ``gbt`` (trees).
All rows stay on the executors; effects are a column of the input rows.

Trees grow on sums per cell of the binned features (:mod:`~monthbook.operators.cells`), made in one or
two passes for all models; with too many features for that, each model is MLlib's, trained on rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from monthbook.functions.scalars import clip, safe_divide
from monthbook.operators.cells import (
    BLOCK, Booster, Cells, Forest, Grown, cell_sums, find_cells, grow_boosters, grow_forests, plain_sums)
from monthbook.operators.linear import (
    Scaling, fit_groups, fits_of, gram, per_group, scaled_gram, solve)
from monthbook.operators.parallel import MOST, side_by_side, training_rows
from monthbook.operators.ranks import quantile_values
from monthbook.session import is_written, written

_VECTOR = "__features"


@dataclass(frozen=True)
class CausalSpec:
    """Roles of the columns, and how the nuisance models are made."""

    id: str
    outcome: str
    treatment: str
    #: Features the effect may vary with.
    features: tuple[str, ...]
    #: Further controls of the nuisance models.
    controls: tuple[str, ...] = ()
    strata: str | None = None
    nuisance: str = "gbt"
    folds: int = 5
    #: Fold number of a row as SQL; by default a hash of the id.
    fold: str | None = None
    # Sizes of the tree models.
    trees: int = 100
    outcome_depth: int = 5
    treatment_depth: int = 10
    leaf: int = 10
    seed: int = 42
    #: Models fitted at the same time; each keeps a binned copy of its rows while it is fitted.
    at_once: int = MOST

    @property
    def inputs(self) -> list[str]:
        return list(dict.fromkeys([*self.features, *self.controls]))

    def fold_number(self) -> Column:
        """The fold of a row: ``fold`` modulo ``folds``, so no more than ``folds`` of them."""
        if self.fold is not None:
            return F.pmod(F.expr(self.fold).cast("int"), F.lit(self.folds)).cast("int")
        return F.pmod(F.xxhash64(self.id), F.lit(self.folds)).cast("int")


@dataclass(frozen=True)
class Estimate:
    """Input rows with ``effect``, the mean effect and a 95 % interval where there is one."""

    name: str
    rows: DataFrame
    ate: float
    low: float | None = None
    high: float | None = None
    importances: tuple[tuple[str, float], ...] = ()
    #: Mean of ``effect``; ``ate`` may be that of a corrected score instead.
    mean: float | None = None
    #: Adds ``effect`` to other rows that have the features.
    predict: Callable[[DataFrame], DataFrame] | None = None


def choose_roles(df: DataFrame, treatment: str, outcomes: Sequence[str],
                 controls: Sequence[str], drop: Sequence[str] = ()
                 ) -> tuple[list[str], list[str]]:
    """Features (all but treatment, outcomes and ``drop``) and the controls among them."""
    features = [c for c in df.columns if c not in {treatment, *outcomes, *drop}]
    return features, [c for c in controls if c in features]


def complete_rows(df: DataFrame, spec: CausalSpec) -> DataFrame:
    """Rows without a missing value in any role."""
    needed = [spec.outcome, spec.treatment, *spec.inputs]
    return df.dropna(subset=needed + ([spec.strata] if spec.strata else []))


def _held(df: DataFrame, spec: CausalSpec) -> DataFrame:
    """:func:`complete_rows`, made once: estimators pass over them several times.

    Rows that are :func:`~monthbook.session.written` already are read from there.
    """
    rows = complete_rows(df, spec)
    return rows if is_written(df) else written(rows, "causal")


def _vector(df: DataFrame, columns: Sequence[str], name: str = _VECTOR) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def _forest(spec: CausalSpec, label: str, depth: int | None = None,
            weight: str | None = None) -> RandomForestRegressor:
    forest = RandomForestRegressor(
        featuresCol=_VECTOR, labelCol=label, predictionCol="__prediction",
        numTrees=spec.trees, maxDepth=depth or spec.treatment_depth,
        minInstancesPerNode=spec.leaf, seed=spec.seed, maxMemoryInMB=512)
    return forest.setWeightCol(weight) if weight else forest


def _booster(spec: CausalSpec, label: str) -> GBTRegressor:
    return GBTRegressor(featuresCol=_VECTOR, labelCol=label, predictionCol="__prediction",
                        maxIter=spec.trees, maxDepth=spec.outcome_depth, stepSize=0.1,
                        seed=spec.seed, maxMemoryInMB=512)


def _sums(rows: DataFrame, cells: Cells, spec: CausalSpec, values: Sequence[Column],
          group: Column | None = None) -> DataFrame:
    """What the trees of forests need of the rows, per cell (and group)."""
    key = [spec.id] if spec.id in rows.columns else []
    return cell_sums(rows, cells, values, -(-spec.trees // BLOCK), spec.seed, group, key)


def _grown(sums: DataFrame, cells: Cells, spec: CausalSpec, jobs: dict[str, Forest], values: int = 1,
           groups: int = 1) -> dict[str, Grown]:
    return grow_forests(sums, cells, jobs, values, groups, spec.treatment_depth, spec.leaf, spec.seed)


def _by_cell(cells: Cells, effect: np.ndarray) -> Callable[[DataFrame], DataFrame]:
    def predict(other: DataFrame) -> DataFrame:
        return cells.add(other, {"effect": effect})
    return predict


def _effect_forest(df: DataFrame, spec: CausalSpec, label: Column, weight: Column | None = None
                   ) -> tuple[Callable[[DataFrame], DataFrame], tuple[tuple[str, float], ...]]:
    """A forest for the effect: how to add ``effect`` to rows, and the importances."""
    cells = find_cells(df, spec.features)
    if cells is not None:
        values = [label] if weight is None else [weight, label * weight]
        made = _grown(_sums(df, cells, spec, values), cells, spec, {
            "effect": Forest((0,), len(values), spec.trees, len(values) - 1)}, len(values))["effect"]
        return _by_cell(cells, made.cell), _ranked(spec.features, made.importance)
    known = training_rows(_vector(df, spec.features).select(
        _VECTOR, label.alias("__label"), *([] if weight is None else [weight.alias("__weight")])))
    model = _forest(spec, "__label", weight=None if weight is None else "__weight").fit(known)
    known.unpersist()
    def predict(other: DataFrame) -> DataFrame:
        return (model.transform(_vector(other, spec.features))
                .withColumnRenamed("__prediction", "effect").drop(_VECTOR))
    return predict, _ranked(spec.features, model.featureImportances.toArray())


# --- residuals --------------------------------------------------------------------------

def crossfit_residuals(df: DataFrame, spec: CausalSpec) -> DataFrame:
    """Adds ``fold``, out-of-fold predictions ``y_hat``, ``t_hat`` and residuals."""
    rows = _held(df, spec).withColumn("fold", spec.fold_number())
    if spec.nuisance == "linear":
        fits = fit_groups(rows, spec.inputs, [spec.outcome, spec.treatment], "fold",
                          leave_out=True)
        fitted = rows.withColumns({
            name: per_group({g: f[c] for g, f in fits.items()}, "fold")
            for name, c in (("y_hat", spec.outcome), ("t_hat", spec.treatment))})
    elif spec.nuisance == "strata":
        fitted = _out_of_fold_means(rows, spec, {
            "y_hat": (F.col(spec.outcome), F.lit(True)),
            "t_hat": (F.col(spec.treatment), F.lit(True))})
    elif spec.nuisance == "gbt":
        fitted = _crossfit_trees(rows, spec, [
            ("y_hat", "boosted", spec.outcome, None), ("t_hat", "forest", spec.treatment, None)])
    else:
        raise ValueError(f"unknown nuisance {spec.nuisance!r}")
    return fitted.withColumns({
        "y_res": F.col(spec.outcome).cast("double") - F.col("y_hat"),
        "t_res": F.col(spec.treatment).cast("double") - F.col("t_hat")})


def _out_of_fold_means(rows: DataFrame, spec: CausalSpec,
                       means: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Means over the other folds of a row's stratum; ``{name: (value, rows used)}``."""
    sums = [agg for name, (value, used) in means.items() for agg in (
        F.sum(F.when(used, value.cast("double"))).alias(f"__s_{name}"),
        F.count(F.when(used, value)).alias(f"__n_{name}"))]
    cells = rows.groupBy(spec.strata, "fold").agg(*sums)
    whole = Window.partitionBy(spec.strata)  # one row per fold
    def others(c: str) -> Column:
        return F.sum(c).over(whole) - F.coalesce(F.col(c), F.lit(0))
    left_out = cells.select(spec.strata, "fold", *[
        safe_divide(others(f"__s_{n}"), others(f"__n_{n}")).alias(n) for n in means])
    return rows.join(left_out, [spec.strata, "fold"])


#: Name, kind (``boosted``, ``forest`` or ``chance``), label, and the arm it is trained on.
_Model = tuple[str, str, str, int | None]


def _crossfit_trees(rows: DataFrame, spec: CausalSpec, models: Sequence[_Model]) -> DataFrame:
    """Adds out-of-fold predictions of several models; each row is scored once per model."""
    cells = find_cells(rows, spec.inputs)
    return _crossfit_rows(rows, spec, models) if cells is None else _crossfit_cells(
        rows, spec, models, cells)


def _crossfit_cells(rows: DataFrame, spec: CausalSpec, models: Sequence[_Model], cells: Cells) -> DataFrame:
    """One pass sums up rows per fold, arm and cell: a fold is left out by not adding its sums."""
    folds = range(spec.folds)
    arms = 2 if "treated" in rows.columns else 1
    group = F.col("fold") * arms + (F.col("treated") if arms > 1 else F.lit(0))
    def used(k: int, arm: int | None) -> list[int]:
        return [f * arms + a for f in folds if f != k for a in range(arms) if arm in (None, a)]

    boosted = [m for m in models if m[1] != "forest"]
    labels = list(dict.fromkeys(m[2] for m in boosted))
    sums = plain_sums(rows, cells, [F.col(c) for c in labels], spec.folds * arms, group)
    found = grow_boosters(rows.sparkSession, cells, {
        f"{name}-{k}": Booster(sums[0, used(k, arm)].sum(axis=0),
                               sums[1 + labels.index(label), used(k, arm)].sum(axis=0), kind == "chance")
        for name, kind, label, arm in boosted for k in folds}, spec.trees, spec.outcome_depth)
    forests = [m for m in models if m[1] == "forest"]
    if forests:
        labels = list(dict.fromkeys(m[2] for m in forests))
        drawn = _sums(rows, cells, spec, [F.col(c) for c in labels], group)
        made = _grown(drawn, cells, spec, {
            f"{name}-{k}": Forest(tuple(used(k, arm)), 1 + labels.index(label), spec.trees)
            for name, _, label, arm in forests for k in folds}, len(labels), spec.folds * arms)
        found |= {name: grown.cell for name, grown in made.items()}
    return cells.add(rows, {m[0]: np.stack([found[f"{m[0]}-{k}"] for k in folds]) for m in models}, "fold")


def _crossfit_rows(rows: DataFrame, spec: CausalSpec, models: Sequence[_Model]) -> DataFrame:
    # Written once and held: all models read their rows from there.
    ready = training_rows(written(_vector(rows, spec.inputs), "crossfit"))
    chance = GBTClassifier(featuresCol=_VECTOR, seed=spec.seed, predictionCol="__prediction",
                           maxIter=spec.trees, maxDepth=spec.outcome_depth)
    makers = {"boosted": partial(_booster, spec), "forest": partial(_forest, spec),
              "chance": chance.setLabelCol}

    def fit(kind: str, label: str, k: int, arm: int | None) -> Callable[[], Model]:
        known = ready.where(F.col("fold") != k)
        estimator = makers[kind](label)
        return lambda: estimator.fit(known if arm is None else known.where(F.col("treated") == arm))

    fitted = _fit_all(rows, spec, {f"{name}-{k}": fit(kind, label, k, arm) for k in range(spec.folds)
                                   for name, kind, label, arm in models})
    parts = []
    for k in range(spec.folds):
        own = ready.where(F.col("fold") == k)
        for name, *_ in models:
            scored = fitted[f"{name}-{k}"].transform(own)
            if "probability" in scored.columns:
                scored = scored.withColumn(
                    name, vector_to_array("probability")[1]).drop("probability", "rawPrediction")
                own = scored.drop("__prediction")
            else:
                own = scored.withColumnRenamed("__prediction", name)
        parts.append(own.drop(_VECTOR))
    # Scored once, and read from there by every later step.
    scored = written(reduce(DataFrame.unionByName, parts), "out-of-fold")
    ready.unpersist()
    return scored


def _fit_all(df: DataFrame, spec: CausalSpec, work: dict[str, Callable[[], Model]]) -> dict[str, Model]:
    return side_by_side(df.sparkSession, work, spec.at_once)


def _mean_effect(name: str, rows: DataFrame, score: Column | None = None, **more) -> Estimate:
    """Mean effect; with per-row ``score`` also the interval of its mean."""
    value = score if score is not None else F.col("effect")
    row = rows.agg(F.avg(value).alias("m"), F.stddev_samp(value).alias("s"),
                   F.count(value).alias("n"), F.avg("effect").alias("e")).first()
    if score is None or not row.n:
        return Estimate(name, rows, row.m, mean=row.e, **more)
    reach = 1.959964 * (row.s or 0.0) / np.sqrt(row.n)
    return Estimate(name, rows, row.m, row.m - reach, row.m + reach, mean=row.e, **more)


# --- residual-on-residual estimators ----------------------------------------------------

def linear_dml(residuals: DataFrame, spec: CausalSpec, final: str = "constant",
               replicates: int = 0) -> Estimate:
    """Effect that is constant, ``linear`` in the features, or a sparse (``lasso``) one.

    With ``replicates`` a bootstrap interval of the mean effect is added, in every form, and
    the 95 % interval of each row's effect as ``effect_low`` and ``effect_high``.
    """
    if final not in ("constant", "linear", "lasso"):
        raise ValueError(f"unknown final stage {final!r}")
    on = [] if final == "constant" else list(spec.features)
    # t and t * x explain y; 1 and x are there for the mean effect of a replicate.
    t, one = F.col("t_res"), F.lit(1.0)
    terms = [t, *[t * F.col(c) for c in on], F.col("y_res"), one, *[F.col(c) for c in on]]
    k = len(on) + 1
    parts = gram(residuals.withColumn("__block", block_number(spec)), terms, ["fold", "__block"])
    sums = {f: sum(m for key, m in parts.items() if key[0] == f) for f, _ in parts}
    whole = sum(sums.values(), np.zeros((len(terms),) * 2))
    penalty = _choose_penalty(sums, k) if final == "lasso" else 0.0
    theta = _final_stage(whole, k, penalty)
    effect = F.lit(float(theta[0]))
    for c, b in zip(on, theta[1:]):
        effect = effect + F.col(c).cast("double") * F.lit(float(b))

    def mean_effect(matrix: np.ndarray) -> float:
        return float(_final_stage(matrix, k, penalty) @ matrix[k + 1, k + 1:] / matrix[k + 1, k + 1])

    low = high = None
    band: dict[str, Column] = {}
    if replicates and parts:
        drawn = _redrawn(parts, replicates, spec.seed)
        low, high = _percentiles([mean_effect(m) for m in drawn])
        # The spread of the redrawn coefficients is a quadratic form of a row's features.
        thetas = np.array([_final_stage(m, k, penalty) for m in drawn])
        reach = F.lit(1.959964) * F.sqrt(_quadratic(np.cov(thetas.T).reshape(k, k), on))
        band = {"effect_low": effect - reach, "effect_high": effect + reach}

    def predict(other: DataFrame) -> DataFrame:
        return other.withColumns({"effect": effect, **band})

    return Estimate("linear_dml", predict(residuals), mean_effect(whole)
                    if whole[k + 1, k + 1] else float(theta[0]), low, high, predict=predict)


def linear_effects(df: DataFrame, spec: CausalSpec, outcomes: Sequence[str],
                   replicates: int = 0) -> dict[str, Estimate]:
    """:func:`linear_dml` with a constant effect on linear residuals, for many outcomes at once.

    One pass over the rows: residuals are linear in the columns, so their sums of products
    follow from those of the columns, per fold and, with ``replicates``, block.  A row without a
    value of some outcome counts for the others.
    """
    rows = df.dropna(subset=[spec.treatment, *spec.inputs]).withColumn("fold", spec.fold_number())
    known = sum((F.when(F.col(y).isNotNull(), 1 << i).otherwise(0) for i, y in enumerate(outcomes)),
                F.lit(0))
    drawn = block_number(spec) if replicates else F.lit(0)
    parts, scaling = scaled_gram(rows.withColumns({"__known": known, "__block": drawn}),
                                 [*spec.inputs, spec.treatment, *outcomes],
                                 ["fold", "__known", "__block"])
    xs, at = list(spec.inputs), list(range(len(spec.inputs) + 1))
    return {y: _effect_from_sums(
        {key: m[np.ix_(*[[*at, at[-1] + 1, at[-1] + 2 + i]] * 2)] for key, m in parts.items()
         if key[1] >> i & 1},
        scaling, rows, replace(spec, outcome=y), xs, replicates) for i, y in enumerate(outcomes)}


def _effect_from_sums(parts: dict[tuple, np.ndarray], scaling: Scaling, rows: DataFrame,
                      spec: CausalSpec, xs: list[str], replicates: int) -> Estimate:
    """``parts`` by (fold, ..., block): products of 1, ``xs``, treatment and outcome."""
    p, ys = len(xs) + 1, [spec.treatment, spec.outcome]
    sums = _by_fold(parts, p + 2)
    total = sum(sums.values(), np.zeros((p + 2,) * 2))
    residual: dict[tuple, np.ndarray] = {}  # products of the two residuals
    for key, matrix in parts.items():
        used = total - sums[key[:1]]
        v = np.zeros((p + 2, 2))
        for k in (0, 1):
            v[:p, k], v[p + k, k] = -solve(used, range(p), p + k), 1.0
        v *= [scaling.scale[c] for c in ys]
        place = (key[0], key[-1])
        residual[place] = residual.get(place, np.zeros((2, 2))) + v.T @ matrix @ v

    def theta(m: np.ndarray) -> float:
        return float(m[0, 1] / m[0, 0]) if m[0, 0] else 0.0

    ate = theta(sum(residual.values(), np.zeros((2, 2))))
    low = high = None
    if replicates and residual:
        low, high = _percentiles([theta(m) for m in _redrawn(residual, replicates, spec.seed)])
    fits = fits_of(sums, scaling, xs, ys, True)
    hats = {name: per_group({g: f[c] for g, f in fits.items()}, "fold") if fits else F.lit(None)
            for name, c in (("t_hat", spec.treatment), ("y_hat", spec.outcome))}
    scored = rows.dropna(subset=[spec.outcome]).withColumns(hats).withColumns({
        "y_res": F.col(spec.outcome).cast("double") - F.col("y_hat"),
        "t_res": F.col(spec.treatment).cast("double") - F.col("t_hat"), "effect": F.lit(ate)})
    return Estimate("linear_dml", scored, ate, low, high, mean=ate,
                    predict=lambda other: other.withColumn("effect", F.lit(ate)))


def _by_fold(parts: dict[tuple, np.ndarray], size: int) -> dict[tuple, np.ndarray]:
    out: dict[tuple, np.ndarray] = {}
    for key, matrix in parts.items():
        out[key[:1]] = out.get(key[:1], np.zeros((size, size))) + matrix
    return out


def _quadratic(matrix: np.ndarray, features: Sequence[str]) -> Column:
    """``z' M z`` of every row, where ``z`` is 1 and the features; not below 0."""
    z = [F.lit(1.0), *[F.col(c).cast("double") for c in features]]
    total = F.lit(0.0)
    for i in range(len(z)):
        for j in range(i, len(z)):
            total = total + F.lit(float(matrix[i, j]) * (1 if i == j else 2)) * z[i] * z[j]
    return F.greatest(total, F.lit(0.0))


def _final_stage(matrix: np.ndarray, k: int, penalty: float) -> np.ndarray:
    """Coefficients of y on the first ``k`` terms, from their sums of products.

    With a penalty: coordinate descent for the lasso on terms of unit length; the penalty is a
    share of the one that leaves no term.
    """
    if not penalty:
        return solve(matrix, range(k), k)
    scale = np.sqrt(np.maximum(matrix.diagonal()[:k], 1e-300))
    g, c = matrix[:k, :k] / np.outer(scale, scale), matrix[:k, k] / scale
    limit, beta = penalty * np.abs(c).max(), np.zeros(k)
    for _ in range(1000):
        before = beta.copy()
        for j in range(k):
            rest = c[j] - g[j] @ beta + g[j, j] * beta[j]
            beta[j] = np.sign(rest) * max(abs(rest) - limit, 0.0) / g[j, j]
        if np.abs(beta - before).max() < 1e-12 * max(1.0, np.abs(beta).max()):
            break
    return beta / scale


#: Penalties tried, as shares of the one that leaves no term.
_PENALTIES = (0.0, 0.001, 0.01, 0.1)


def _choose_penalty(sums: dict[int, np.ndarray], k: int) -> float:
    """The penalty with the least squared error on folds that were left out."""
    whole = sum(sums.values())
    def miss(penalty: float) -> float:
        total = 0.0
        for own in sums.values():
            v = np.zeros(len(own))
            v[:k], v[k] = -_final_stage(whole - own, k, penalty), 1.0
            total += v @ own @ v
        return total
    return min(_PENALTIES, key=miss)


#: Blocks of rows that are drawn together.
BLOCKS = 256


def block_number(spec: CausalSpec) -> Column:
    """The block of a row: the first two hex digits of the md5 of its id."""
    return F.conv(F.substring(F.md5(F.col(spec.id).cast("string")), 1, 2), 16, 10).cast("int")


def _poisson(limit: int = 14) -> list[float]:
    """P(count <= k) of a Poisson count with mean 1, until nothing is left at 32 bits."""
    out, p, total = [], float(np.exp(-1.0)), 0.0
    for k in range(limit):
        total += p
        out.append(total)
        p /= k + 1
    return out


def _weight(block: int, replicate: int, seed: int, steps: list[float]) -> int:
    text = f"{block}-{replicate}-{seed}"
    u = int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2.0 ** 32
    return sum(u > p for p in steps)


def _redrawn(parts: dict[tuple, np.ndarray], replicates: int, seed: int) -> list[np.ndarray]:
    """Sums of products over redrawn blocks; ``parts`` are by fold or arm and block."""
    blocks: dict[int, np.ndarray] = {}
    for key, matrix in parts.items():
        blocks[key[-1]] = blocks.get(key[-1], 0.0) + matrix
    numbers, steps = sorted(blocks), _poisson()
    stack = np.stack([blocks[b] for b in numbers])
    found = []
    for r in range(1, replicates + 1):
        weights = np.array([_weight(b, r, seed, steps) for b in numbers], float)
        if weights.any():
            found.append(np.tensordot(weights, stack, 1))
    return found


def _percentiles(values: Sequence[float], alpha: float = 0.05) -> tuple[float, float]:
    low, high = np.quantile(values, [alpha / 2, 1 - alpha / 2])
    return float(low), float(high)


def bootstrap_ci(residuals: DataFrame, spec: CausalSpec, replicates: int = 100,
                 alpha: float = 0.05) -> DataFrame:
    """Percentile interval of the constant effect: ``ate, low, high, replicates``.

    Rows fall into ``BLOCKS`` blocks by a hash of their id, and each block gets a Poisson
    weight per replicate: the table is read once, no row is copied, and a rerun draws alike.
    """
    products = gram(residuals.withColumn("__block", block_number(spec)),
                    [F.col("t_res"), F.col("y_res")], ["__block"])
    def ratio(m: np.ndarray) -> float:
        return float(m[0, 1] / m[0, 0]) if m[0, 0] else float("nan")
    row: tuple = (None, None, None, replicates)
    if products:
        row = (ratio(sum(products.values())),
               *_percentiles([ratio(m) for m in _redrawn(products, replicates, spec.seed)], alpha),
               replicates)
    return residuals.sparkSession.createDataFrame(
        [row], "ate double, low double, high double, replicates bigint")


def forest_dml(residuals: DataFrame, spec: CausalSpec) -> Estimate:
    """Forest for the effect: residual ratio as label, squared treatment residual as weight.

    The interval comes from the effects corrected by what they leave unexplained.
    """
    t, y = F.col("t_res"), F.col("y_res")
    predict, importances = _effect_forest(residuals.where(F.abs("t_res") > 1e-9), spec, y / t, t * t)
    rows = written(predict(residuals), "forest-effects")
    spread = residuals.agg(F.avg(F.col("t_res") * F.col("t_res"))).first()[0]
    left = F.col("y_res") - F.col("effect") * F.col("t_res")
    score = F.col("effect") + left * F.col("t_res") / F.lit(spread)
    return _mean_effect("forest_dml", rows, score, predict=predict, importances=importances)


def _ranked(features: Sequence[str], weight: np.ndarray) -> tuple[tuple[str, float], ...]:
    """Features with their importance, the greatest first."""
    return tuple(sorted(zip(features, np.asarray(weight).tolist()), key=lambda p: (-p[1], p[0])))


def silverman_bandwidth(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Rule-of-thumb bandwidth per feature, from one aggregate."""
    d = len(features)
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(features)]).first()
    factor = (4.0 / ((d + 2.0) * row.n)) ** (1.0 / (d + 4.0))
    return {c: (row[f"s{i}"] or 1.0) * factor for i, c in enumerate(features)}


def kernel_dml(residuals: DataFrame, spec: CausalSpec, size: int = 100,
               ridge: float = 1e-3) -> Estimate:
    """Effect as a smooth function of the features: random Fourier features, ridge fit.

    Features of the kernel are made batch by batch.  The normal equations, and what the mean effect
    needs, are summed up in one pass, inside the tasks.
    """
    width = silverman_bandwidth(residuals, spec.features)
    rng = np.random.default_rng(spec.seed)
    scale = np.array([width[c] for c in spec.features])
    direction = (rng.normal(size=(size, len(spec.features))) / scale).T
    phase = rng.uniform(0.0, 2 * np.pi, size)

    def basis(columns: tuple[pd.Series, ...]) -> np.ndarray:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        waves = np.cos(x @ direction + phase) * np.sqrt(2.0 / size)
        return np.column_stack([np.ones(len(x)), waves])

    inputs = [F.col(c).cast("double") for c in spec.features]
    k = size + 1  # terms: basis times t, then y and 1

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k + 2, 2 * k + 2))
        for batch in batches:
            t, y, *columns = (batch[c] for c in batch.columns)
            waves = basis(tuple(columns))
            ones = np.ones(len(batch))
            terms = np.column_stack([waves * t.to_numpy()[:, None], y, ones])
            total += terms.T @ np.column_stack([terms, waves])
        yield pd.DataFrame({"place": np.arange(total.size, dtype=np.int32), "value": total.ravel()})

    # As many rows as the fit has sums, whatever the table.
    sums = residuals.select(F.col("t_res"), F.col("y_res"), *[
        c.alias(f"x{i}") for i, c in enumerate(inputs)]).mapInPandas(
            products, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    whole = np.zeros((k + 2) * (2 * k + 2))
    whole[[r["place"] for r in sums]] = [r["value"] for r in sums]
    whole = whole.reshape(k + 2, 2 * k + 2)
    n, matrix = whole[k + 1, k + 1], whole[:, :k + 2] / (whole[k + 1, k + 1] or 1.0)
    # The penalty is relative to the spread of the outcome, as in Spark's linear regression.
    spread = float(np.sqrt(max(matrix[k, k] - matrix[k, k + 1] ** 2, 0.0)))
    weights = solve(matrix, range(k), k, ridge / (spread or 1.0))
    mean = float(whole[k + 1, k + 2:] @ weights / n) if n else None

    @F.pandas_udf("double")
    def effect(*columns: pd.Series) -> pd.Series:
        return pd.Series(basis(columns) @ weights)

    def predict(other: DataFrame) -> DataFrame:
        return other.withColumn("effect", effect(*inputs))
    return Estimate("kernel_dml", predict(residuals), mean, mean=mean, predict=predict)


# --- learners for a two-valued treatment ------------------------------------------------

def binarise(df: DataFrame, spec: CausalSpec, threshold: float | None = None) -> DataFrame:
    """Adds ``treated``: 1 above the threshold (the exact median by default), else 0."""
    if threshold is None:
        threshold = quantile_values(df, spec.treatment, [0.5])[0]
    return df.withColumn("treated", (F.col(spec.treatment) > F.lit(threshold)).cast("int"))


def dr_learner(df: DataFrame, spec: CausalSpec, threshold: float | None = None,
               trim: float = 0.01, final: bool = True) -> Estimate:
    """Doubly robust scores from out-of-fold propensity and outcome models.

    The mean effect and its interval are those of the scores.  ``final`` fits a forest to
    them for the effect per row; without it ``effect`` is the score itself.
    """
    rows = binarise(_held(df, spec), spec, threshold).withColumn(
        "fold", spec.fold_number())
    arm = F.col("treated") == 1
    if spec.nuisance == "linear":
        # A linear chance, held inside (trim, 1 - trim) below.
        fits = {"p_hat": (rows, "treated"), "y1_hat": (rows.where(arm), spec.outcome),
                "y0_hat": (rows.where(~arm), spec.outcome)}
        fitted = rows.withColumns({
            name: per_group({g: f[c] for g, f in fit_groups(
                used, spec.inputs, [c], "fold", leave_out=True).items()}, "fold")
            for name, (used, c) in fits.items()})
    elif spec.nuisance == "strata":
        fitted = _out_of_fold_means(rows, spec, {
            "p_hat": (F.col("treated"), F.lit(True)),
            "y1_hat": (F.col(spec.outcome), arm), "y0_hat": (F.col(spec.outcome), ~arm)})
    elif spec.nuisance == "gbt":
        fitted = _crossfit_trees(rows, spec, [
            ("y1_hat", "boosted", spec.outcome, 1), ("y0_hat", "boosted", spec.outcome, 0),
            ("p_hat", "chance", "treated", None)])
    else:
        raise ValueError(f"unknown nuisance {spec.nuisance!r}")
    p, y = clip(F.col("p_hat"), trim, 1 - trim), F.col(spec.outcome)
    score = (F.col("y1_hat") - F.col("y0_hat")
             + F.col("treated") * (y - F.col("y1_hat")) / p
             - (1 - F.col("treated")) * (y - F.col("y0_hat")) / (1 - p))
    scored = fitted.withColumn("dr_score", score)
    if not final:
        return _mean_effect("dr_learner", scored.withColumn("effect", F.col("dr_score")),
                            F.col("dr_score"))
    # Long formulas (of every fold, arm and model): once, not in each pass of the forest.
    scored = written(scored, "dr-scores")
    predict, importances = _effect_forest(
        scored.where(F.col("dr_score").isNotNull()), spec, F.col("dr_score"))
    return _mean_effect("dr_learner", written(predict(scored), "dr-effects"), F.col("dr_score"),
                        predict=predict, importances=importances)


def s_learner(df: DataFrame, spec: CausalSpec, threshold: float | None = None) -> Estimate:
    """One forest on features and treatment; effect is the change when treated flips."""
    inputs = [*spec.features, "treated"]
    rows = binarise(_held(df, spec), spec, threshold)
    cells = find_cells(rows, inputs)
    if cells is not None:
        made = _grown(_sums(rows, cells, spec, [F.col(spec.outcome)]), cells, spec,
                      {"outcome": Forest((0,), 1, spec.trees)})["outcome"]
        by_arm = made.cell.reshape(-1, cells.sizes[-1])  # the last feature is the treatment
        predict = _by_cell(Cells(cells.features[:-1], cells.cuts[:-1], cells.rows),
                           by_arm[:, -1] - by_arm[:, 0])
        return _mean_effect("s_learner", written(predict(rows), "s-effects"), predict=predict)
    ready = training_rows(_vector(rows, inputs))
    model = _forest(spec, spec.outcome).fit(ready)
    ready.unpersist()
    def predict(other: DataFrame) -> DataFrame:
        kept = other.columns
        for arm in (1, 0):
            flipped = other.withColumn("__t", F.lit(arm))
            scored = model.transform(_vector(flipped, [*spec.features, "__t"]))
            other = scored.withColumnRenamed("__prediction", f"__y{arm}").drop(_VECTOR, "__t")
        return other.select(*kept, (F.col("__y1") - F.col("__y0")).alias("effect"))
    return _mean_effect("s_learner", written(predict(rows), "s-effects"), predict=predict)


def t_learner(df: DataFrame, spec: CausalSpec, threshold: float | None = None,
              learner: str = "forest") -> Estimate:
    """One model per arm; effect is the difference of their predictions."""
    rows = binarise(_held(df, spec), spec, threshold)
    if learner == "linear":
        fits = fit_groups(rows, list(spec.features), [spec.outcome], "treated")
        effect = fits[(1,)][spec.outcome].column() - fits[(0,)][spec.outcome].column()
        def predict(other: DataFrame) -> DataFrame:
            return other.withColumn("effect", effect)
        return _mean_effect("t_learner", predict(rows), predict=predict)
    cells = find_cells(rows, spec.features)
    if cells is not None:
        sums = _sums(rows, cells, spec, [F.col(spec.outcome)], F.col("treated"))
        made = _grown(sums, cells, spec, _outcome_forests(spec), groups=2)
        predict = _by_cell(cells, made["1"].cell - made["0"].cell)
    else:
        ready = training_rows(_vector(rows, spec.features))
        models = _fit_all(rows, spec, _outcome_models(ready, spec))
        ready.unpersist()
        def predict(other: DataFrame) -> DataFrame:
            return _difference(other, spec, models["1"], models["0"])
    return _mean_effect("t_learner", written(predict(rows), "t-effects"), predict=predict)


def _outcome_forests(spec: CausalSpec) -> dict[str, Forest]:
    """One forest for the outcome of each arm, by the name of the arm."""
    return {str(arm): Forest((arm,), 1, spec.trees) for arm in (0, 1)}


def _outcome_models(ready: DataFrame, spec: CausalSpec) -> dict[str, Callable[[], Model]]:
    """The same as MLlib's models, trained on rows."""
    def fit(arm: int) -> Callable[[], Model]:
        return lambda: _forest(spec, spec.outcome).fit(ready.where(F.col("treated") == arm))
    return {str(arm): fit(arm) for arm in (0, 1)}


def _difference(df: DataFrame, spec: CausalSpec, first, second) -> DataFrame:
    out = first.transform(_vector(df, spec.features)).withColumnRenamed("__prediction", "__a")
    out = second.transform(out).withColumnRenamed("__prediction", "__b")
    return out.select(*df.columns, (F.col("__a") - F.col("__b")).alias("effect"))


def x_learner(df: DataFrame, spec: CausalSpec, threshold: float | None = None) -> Estimate:
    """Effects imputed from the other arm's model, mixed by the chance of treatment."""
    rows = binarise(_held(df, spec), spec, threshold)
    cells = find_cells(rows, spec.features)
    if cells is not None:
        predict = _by_cell(cells, _x_effect(rows, spec, cells))
        return _mean_effect("x_learner", written(predict(rows), "x-effects"), predict=predict)
    ready = training_rows(_vector(rows, spec.features))
    half = replace(spec, trees=max(1, spec.trees // 2))
    first = _fit_all(rows, spec, _outcome_models(ready, spec) | {
        "chance": lambda: _forest(half, "treated").fit(ready)})

    def gains(arm: int) -> Callable[[], Model]:
        crossed = first[str(1 - arm)].transform(ready.where(F.col("treated") == arm))
        gain = F.col(spec.outcome) - F.col("__prediction")
        known = crossed.withColumn("__gain", gain if arm else -gain).drop("__prediction")
        return lambda: _forest(spec, "__gain").fit(known)

    imputed = _fit_all(rows, spec, {str(arm): gains(arm) for arm in (0, 1)})
    ready.unpersist()
    def predict(other: DataFrame) -> DataFrame:
        out = _vector(other, spec.features)
        for model, name in ((imputed["0"], "__e0"), (imputed["1"], "__e1"),
                            (first["chance"], "__p")):
            out = model.transform(out).withColumnRenamed("__prediction", name)
        mixed = F.col("__p") * F.col("__e0") + (1 - F.col("__p")) * F.col("__e1")
        return out.select(*other.columns, mixed.alias("effect"))
    return _mean_effect("x_learner", written(predict(rows), "x-effects"), predict=predict)


def _x_effect(rows: DataFrame, spec: CausalSpec, cells: Cells) -> np.ndarray:
    """The effect in each cell.  What the other arm's model says is the same for all rows of a cell."""
    arm = F.col("treated")
    sums = written(_sums(rows, cells, spec, [F.col(spec.outcome), arm], arm), "x-sums")
    first = _grown(sums, cells, spec, _outcome_forests(spec) | {
        "chance": Forest((0, 1), 2, max(1, spec.trees // 2))}, 2, 2)
    gains = _grown(sums, cells, spec, {
        "1": Forest((1,), 1, spec.trees, less=first["0"].cell),
        "0": Forest((0,), 1, spec.trees, less=first["1"].cell, sign=-1.0)}, 2, 2)
    chance = first["chance"].cell
    return chance * gains["0"].cell + (1 - chance) * gains["1"].cell
