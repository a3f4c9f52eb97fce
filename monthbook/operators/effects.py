"""What an estimated effect means: drivers, policy, scenarios, stability, summary."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthbook.operators.bins import temporal_index
from monthbook.operators.causal import (
    CausalSpec, Estimate, complete_rows, crossfit_residuals, linear_dml)
from monthbook.operators.linear import scaled_gram, solve
from monthbook.operators.ranks import quantiles
from monthbook.session import cut_lineage

# Shape of the explaining trees, scenario rates and confounding factors.
TREE_DEPTH = 5
TREE_LEAF = 50
POLICY_BINS = 32
SCENARIO_RATES = (4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0, 12.0)
GAMMAS = (0.8, 1.0, 1.2, 1.5)
TREATMENT_COST = 0.01


def effect_drivers(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Importance of each feature in one tree that explains the effect, largest first."""
    ready = VectorAssembler(inputCols=list(features), outputCol="__x").transform(rows)
    tree = DecisionTreeRegressor(featuresCol="__x", labelCol="effect", maxDepth=TREE_DEPTH,
                                 minInstancesPerNode=TREE_LEAF).fit(ready)
    pairs = [(c, float(v)) for c, v in zip(features, tree.featureImportances.toArray())]
    return rows.sparkSession.createDataFrame(
        pairs, "feature string, importance double").orderBy(F.desc("importance"), "feature")


@dataclass
class _Node:
    """A group of rows: what treating them all gains, and how the group is cut."""

    gain: float
    rows: int
    feature: int | None = None
    cut: int | None = None


def policy_tree(rows: DataFrame, features: Sequence[str], cost: float = TREATMENT_COST,
                depth: int = TREE_DEPTH, leaf: int = TREE_LEAF,
                bins: int = POLICY_BINS) -> tuple[DataFrame, str]:
    """Adds ``treat``, the choice of the tree with the most welfare, and returns the tree as text.

    Welfare is the sum of ``effect - cost`` over the rows that are treated.  Features are cut at
    quantiles; one aggregate sums the gains of rows with the same bins, one per level those of every
    (group, feature, bin), and each group is cut where treating one side, both or none gains most, if that is more than before.
    The first feature and the lowest cut win a tie.  A missing feature counts as above every cut.
    """
    gain = F.col("effect") - F.lit(cost)
    edges = _edges(rows, features, bins)
    places = [F.coalesce(sum(((F.col(c) > F.lit(e)).cast("int") for e in edges[c]), F.lit(0)),
                         F.lit(len(edges[c]))) for c in features]
    names = [f"b{i}" for i in range(len(features))]
    held = rows.select(gain.alias("gain"), *[p.alias(b) for b, p in zip(names, places)])
    # Rows with the same bins stay together: their sums are all that the levels need.
    held = held.where("gain IS NOT NULL").groupBy(*names).agg(
        F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    tree: dict[int, _Node] = {}
    try:
        for level in range(depth + 1):
            cells = [F.struct(F.lit(i).alias("f"), F.col(f"b{i}").alias("b")) for i in range(len(features))]
            sums = held.select(_group(tree, [F.col(f"b{i}") for i in range(len(features))]).alias("node"),
                               "gain", "n", F.inline(F.array(*cells)))
            found = sums.where(F.col("node") >= 2 ** level - 1).groupBy("node", "f", "b").agg(
                F.sum("gain").alias("gain"), F.sum("n").alias("n")).collect()  # groups x bins
            if not _grow(tree, found, level < depth, leaf):
                break
    finally:
        held.unpersist()
    chosen = F.lit(False)
    at = _group(tree, places)
    for number, node in tree.items():
        if node.feature is None and node.gain > 0:
            chosen = chosen | (at == number)
    return rows.withColumn("treat", chosen.cast("int")), _written(tree, features, edges)


def _edges(rows: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Distinct inner quantiles of each feature."""
    long = rows.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        [], list(features), "name", "v")
    marks = [i / bins for i in range(1, bins)]
    found = {r["name"]: r for r in quantiles(long, "v", marks, by=["name"]).collect()}
    return {c: sorted({float(found[c][f"q{i}"]) for i in range(len(marks))}) if c in found else []
            for c in features}


def _group(tree: dict[int, _Node], places: Sequence[Column]) -> Column:
    """The number of the group a row is in: 0, and 2 n + 1 and 2 n + 2 below group n."""
    def below(number: int) -> Column:
        node = tree.get(number)
        if node is None or node.feature is None:
            return F.lit(number)
        return F.when(places[node.feature] <= node.cut, below(2 * number + 1)).otherwise(
            below(2 * number + 2))
    return below(0)


def _grow(tree: dict[int, _Node], found: Sequence, may_cut: bool, leaf: int) -> bool:
    """Adds the groups of a level and cuts them; whether any was cut."""
    cells: dict[int, dict[int, dict[int, tuple[float, int]]]] = {}
    for r in found:
        cells.setdefault(r["node"], {}).setdefault(r["f"], {})[r["b"]] = (r["gain"], r["n"])
    cut = False
    for number in sorted(cells):
        by_feature = cells[number]
        first = by_feature[min(by_feature)].values()
        whole = _Node(math.fsum(g for g, _ in first), sum(n for _, n in first))
        tree[number] = whole
        best = max(whole.gain, 0.0)
        for f in sorted(by_feature if may_cut else ()):
            left, size = 0.0, 0
            for b in sorted(by_feature[f]):
                left, size = left + by_feature[f][b][0], size + by_feature[f][b][1]
                welfare = max(left, 0.0) + max(whole.gain - left, 0.0)
                if (min(size, whole.rows - size) >= max(leaf, 1)
                        and welfare > best + 1e-9 * max(1.0, abs(best))):
                    best, whole.feature, whole.cut = welfare, f, b
        cut |= whole.feature is not None
    return cut


def _written(tree: dict[int, _Node], features: Sequence[str], edges: dict[str, list[float]]) -> str:
    lines = []

    def write(number: int, indent: str) -> None:
        node = tree.get(number)
        if node is None or node.feature is None:
            gain, rows = (node.gain, node.rows) if node else (0.0, 0)
            lines.append(f"{indent}{'treat' if gain > 0 else 'leave'}: {rows} rows, gain {gain:.6g}")
            return
        name = features[node.feature]
        lines.append(f"{indent}{name} <= {edges[name][node.cut]:.6g}")
        write(2 * number + 1, indent + "  ")
        lines.append(f"{indent}{name} > {edges[name][node.cut]:.6g}")
        write(2 * number + 2, indent + "  ")

    write(0, "")
    return "\n".join(lines)


def scenarios(estimate: Estimate, spec: CausalSpec,
              rates: Sequence[float] = SCENARIO_RATES) -> DataFrame:
    """Expected outcome at each treatment level for the median row.

    The effect per unit at the median features, times the distance to the mean treatment.
    """
    rows = estimate.rows
    long = rows.select(*[F.col(c).cast("double").alias(c) for c in spec.features]).unpivot(
        [], list(spec.features), "name", "v")
    medians = {r["name"]: r["q0"] for r in quantiles(long, "v", [0.5], by=["name"]).collect()}
    centre = [medians.get(c) for c in spec.features]
    base = rows.agg(F.avg(spec.outcome).alias("y"), F.avg(spec.treatment).alias("t")).first()
    frame = rows.sparkSession.createDataFrame(
        [(float(r), *centre) for r in rates],
        "rate double, " + ", ".join(f"`{c}` double" for c in spec.features))
    change = F.col("effect") * (F.col("rate") - F.lit(base.t))
    return estimate.predict(frame).select(
        "rate", change.alias("outcome_effect"), (F.lit(base.y) + change)
        .alias("expected_outcome"))


def sensitivity(spark: SparkSession, ate: float,
                gammas: Sequence[float] = GAMMAS) -> DataFrame:
    """Mean effect under unseen confounding of several strengths."""
    return spark.createDataFrame([(float(g),) for g in gammas], "gamma double").select(
        "gamma", (F.lit(ate) * F.col("gamma")).alias("adjusted_ate"),
        ((F.lit(ate) * F.col("gamma") / F.nullif(F.lit(ate), F.lit(0.0)) - 1) * 100)
        .alias("change_pct"))


def temporal_ate(df: DataFrame, spec: CausalSpec, time: str, folds: int = 5) -> DataFrame:
    """Mean effect learned on all time blocks up to each point, for the block after it.

    With linear nuisance models all folds come from one aggregate per (block, fold).
    """
    indexed = temporal_index(complete_rows(df, spec), time, spec.id, folds)
    # Sorted once: every later step reads what is written here.
    indexed = cut_lineage(indexed.where(F.col("block").isNotNull())
                          .withColumn("fold", spec.fold_number()))
    if spec.nuisance == "linear":
        ates = _temporal_linear(indexed, spec, folds)
    else:
        ates = [linear_dml(crossfit_residuals(indexed.where(F.col("block") <= i), spec),
                           spec).ate for i in range(folds - 1)]
    return df.sparkSession.createDataFrame(
        [(i, float(a)) for i, a in enumerate(ates)], "period int, ate double")


def _temporal_linear(indexed: DataFrame, spec: CausalSpec, folds: int) -> list[float]:
    columns = [*spec.inputs, spec.treatment, spec.outcome]
    sums, scaling = scaled_gram(indexed, columns, ["block", "fold"])
    xs = list(range(len(spec.inputs) + 1))
    t, y = len(xs), len(xs) + 1
    out = []
    for last in range(folds - 1):
        known = {k: m for k, m in sums.items() if k[0] <= last}
        total = sum(known.values())
        above = below = 0.0
        for number in {k[1] for k in known}:
            own = sum(m for k, m in known.items() if k[1] == number)
            bt, by = (solve(total - own, xs, c) for c in (t, y))
            # Sums of residual products, from the sums of products alone.
            vt = np.zeros(own.shape[0])
            vy = np.zeros(own.shape[0])
            vt[xs], vt[t], vy[xs], vy[y] = -bt, 1.0, -by, 1.0
            above += vt @ own @ vy
            below += vt @ own @ vt
        out.append(above / below * scaling.scale[spec.outcome] / scaling.scale[spec.treatment])
    return out


def stability(ates: DataFrame) -> DataFrame:
    """Mean and population deviation of the effect over the periods."""
    return ates.agg(F.avg("ate").alias("mean_ate"), F.stddev_pop("ate").alias("std_ate"),
                    F.count("ate").alias("periods"))


def compare_ate(estimates: Sequence[Estimate]) -> DataFrame:
    """Mean of the effects of every model.  Rows are only read where it is not known yet."""
    spark = estimates[0].rows.sparkSession
    means = [(e.name, e.mean if e.mean is not None else
              e.rows.agg(F.avg("effect")).first()[0]) for e in estimates]
    return spark.createDataFrame(means, "model string, ate double")


def effect_summary(by_bin: DataFrame, drivers: DataFrame, ate: float, low: float | None,
                   high: float | None) -> DataFrame:
    """Spread of the bin means, main driver, and whether the interval leaves out zero."""
    main = drivers.orderBy(F.desc("importance"), "feature").first().feature
    significant = None if low is None or high is None else low * high > 0
    return by_bin.agg((F.max("mean") - F.min("mean")).alias("effect_range")).select(
        "effect_range", F.lit(main).alias("main_driver"), F.lit(ate).alias("ate"),
        F.lit(significant).cast("boolean").alias("significant"))
