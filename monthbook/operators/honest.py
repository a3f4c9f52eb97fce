"""Honest forest for the effect, with an interval for the effect of every row.

Generalised random forest on residuals (Athey, Tibshirani and Wager 2019), its variance by bags of
little bootstraps: trees come in groups, and all trees of a group see the same half of the rows, drawn
by a hash of the id.  A group's half is cut in two by another hash.  Trees grown on one quarter get
their leaves from the other, and the other way round: no row shapes a leaf and fills it, and a group
uses its half evenly.

The effect of a row is the mean over trees of its leaves' treatment-outcome products, over that of
their squared treatments.  How far the means of the groups lie apart is the variance of a half-sample,
which is that of the whole; what they differ by because each has few trees is taken off, and the
rest is known to be positive (mean of a normal cut at zero).

Trees grow on sums per cell of the binned features: one pass over the rows makes these, and what fills
the leaves, for all groups, and each group grows in a task of its own.  The cuts between bins lie elsewhere
in each group, or what a cut misses would be missed by all and not seen as variance.  With too many features for that, the forests of all groups are fitted
side by side on rows written once, and leaves are filled by one aggregate; its result, at most
``trees * 2 ** depth`` rows, is all that reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from monthbook.operators.causal import (
    _VECTOR, CausalSpec, Estimate, _forest, _mean_effect, _ranked, _vector)
from monthbook.operators.cells import (
    BLOCK, ROWS_PER_TASK, Cells, bootstrap, by_block, dense, grow, drawn_cells)
from monthbook.operators.parallel import side_by_side, training_rows
from monthbook.session import written

#: Halves of the rows that are drawn; the variance of a row's effect has ``GROUPS - 1`` degrees of freedom.
GROUPS = 20
MOST_GROUPS = 60  # bits of a hash
_Z = 1.959964
_PARTS = ("__in", "__part")


def _draws(df: DataFrame, spec: CausalSpec) -> DataFrame:
    """Two hashes of the id: bit ``g`` says whether a row is in half ``g``, and in which part."""
    seed, key = F.lit(spec.seed), F.col(spec.id)
    return df.withColumns({name: F.xxhash64(seed, F.lit(name), key) for name in _PARTS})


def _leaves(df: DataFrame, models: list, features: tuple[str, ...]) -> DataFrame:
    """``df`` with ``__leaves``: the number of the row's leaf in every tree."""
    rows = _vector(df, features)
    for k, model in enumerate(models):
        rows = model.setPredictionCol("").setLeafCol(f"__leaf{k}").transform(rows)
    found = [vector_to_array(F.col(f"__leaf{k}")) for k in range(len(models))]
    return rows.select(*df.columns, F.concat(*found).cast("array<int>").alias("__leaves"))


def _fill(rows: DataFrame, per_half: int, trees: int) -> np.ndarray:
    """3 x trees x leaves: rows, mean product and mean squared treatment of every leaf."""
    one = rows.select("t_res", "y_res", *_PARTS, F.posexplode("__leaves").alias("tree", "leaf"))
    group = F.floor(F.col("tree") / (2 * per_half)).cast("int")
    part = F.floor(F.col("tree") / per_half).cast("int") % 2
    mine = (F.getbit("__in", group) == 1) & (F.getbit("__part", group) != part)
    sums = one.where(mine).groupBy("tree", "leaf").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("t_res") * F.col("y_res")).alias("ty"),
        F.sum(F.col("t_res") * F.col("t_res")).alias("tt")).collect()  # a row per leaf
    table = np.zeros((3, trees, 1 + max((r["leaf"] for r in sums), default=0)))
    for r in sums:
        if r["tt"] > 0:
            table[:, r["tree"], r["leaf"]] = r["n"], r["ty"] / r["n"], r["tt"] / r["n"]
    return table


def _above_zero(value: np.ndarray, error: np.ndarray) -> np.ndarray:
    """Mean of a normal variable that is known to be positive."""
    z = np.maximum(value / np.where(error > 0, error, 1.0), -8.0)
    under = 0.5 * np.array([math.erfc(-x / math.sqrt(2.0)) for x in z])
    return np.where(error > 0, error * (z + np.exp(-z * z / 2) / math.sqrt(2 * math.pi) / under),
                    np.maximum(value, 0.0))


def _mean(values: np.ndarray, there: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance (of a single value: 0) of the values that are there."""
    n = there.sum(axis=axis)
    mean = np.where(there, values, 0.0).sum(axis=axis) / np.maximum(n, 1)
    off = np.where(there, values - np.expand_dims(mean, axis), 0.0)
    return mean, (off * off).sum(axis=axis) / np.maximum(n - 1, 1)


def effects_of(leaves: np.ndarray, table: np.ndarray, groups: int, per_half: int
               ) -> tuple[np.ndarray, np.ndarray]:
    """Effect and standard error of rows, from their leaves (rows x trees)."""
    tree = np.arange(leaves.shape[1])[None, :]
    known = leaves < table.shape[2]
    n, product, square = (np.where(known, part[tree, np.where(known, leaves, 0)], 0.0)
                          for part in table)
    there = n > 0
    used = np.maximum(there.sum(axis=1), 1)
    total = square.sum(axis=1) / used
    safe = np.where(total > 0, total, np.nan)
    effect = product.sum(axis=1) / used / safe
    off = (product - square * effect[:, None]) / safe[:, None]
    shape = (len(leaves), groups, 2, per_half)
    off, there = np.where(there, off, 0.0).reshape(shape), there.reshape(shape)
    halves, noise = _mean(off, there, 3)
    trees = there.sum(axis=3)
    means, _ = _mean(halves, trees > 0, 2)
    _, between = _mean(means, (trees > 0).any(axis=2), 1)
    # Noise of a group's mean: that of its two halves, each a mean of a few trees.
    few = (noise / np.maximum(trees, 1)).sum(axis=2) / np.maximum((trees > 0).sum(axis=2), 1) ** 2
    few, _ = _mean(few, (trees > 0).any(axis=2), 1)
    spread = _above_zero(between - few, between * math.sqrt(2.0 / max(groups - 1, 1)))
    return effect, np.sqrt(spread)


def _score(batches: Iterator[pd.DataFrame], table: np.ndarray, groups: int, per_half: int
           ) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            effect, error = effects_of(np.stack(pdf.pop("__leaves").to_numpy()), table, groups,
                                       per_half)
            yield pdf.assign(effect=effect, effect_low=effect - _Z * error,
                             effect_high=effect + _Z * error)


def honest_forest(residuals: DataFrame, spec: CausalSpec, groups: int = GROUPS) -> Estimate:
    """Effects with ``effect_low`` and ``effect_high``, the 95 % interval of each.

    ``spec.trees`` are shared out over ``2 * groups`` forests of two trees or more.
    """
    if not 2 <= groups <= MOST_GROUPS:
        raise ValueError(f"groups must be 2 to {MOST_GROUPS}")
    per_half = max(2, math.ceil(spec.trees / (2 * groups)))
    spark = residuals.sparkSession
    # Trees weigh rows by their squared treatment: about as sure as a third as many equal ones.
    cells = drawn_cells(residuals, spec.features, [
        np.random.default_rng([spec.seed, g]) for g in range(groups)], share=1 / 12)
    if cells is not None:
        return _honest_cells(residuals, spec, cells, per_half)
    drawn = _draws(residuals, spec)
    ready = training_rows(_vector(drawn.where(F.abs("t_res") > 1e-9), spec.features).select(
        _VECTOR, *_PARTS, (F.col("y_res") / F.col("t_res")).alias("__ratio"),
        (F.col("t_res") * F.col("t_res")).alias("__weight")))

    def part_of(group: int, part: int) -> DataFrame:
        return ready.where((F.getbit("__in", F.lit(group)) == 1)
                           & (F.getbit("__part", F.lit(group)) == part))

    def grow(group: int, part: int):
        small = replace(spec, trees=per_half, seed=spec.seed + 2 * group + part)
        rows = part_of(group, part)
        if rows.isEmpty():
            raise ValueError("too few rows for these groups")
        return _forest(small, "__ratio", weight="__weight").fit(rows)

    try:
        grown = side_by_side(spark, {f"group {g}, part {p}": partial(grow, g, p)
                                     for g in range(groups) for p in (0, 1)}, spec.at_once)
    finally:
        ready.unpersist()
    models = list(grown.values())
    placed = written(_leaves(drawn, models, spec.features), "honest-leaves")
    table = _fill(placed, per_half, per_half * len(models))

    def scored(rows: DataFrame) -> DataFrame:
        schema = rows.drop("__leaves", *_PARTS).select("*", *[
            F.lit(0.0).cast("double").alias(c) for c in ("effect", "effect_low", "effect_high")])
        return rows.drop(*_PARTS).mapInPandas(
            partial(_score, table=table, groups=groups, per_half=per_half), schema.schema)

    rows = written(scored(placed), "honest-effects")
    weight = np.mean([m.featureImportances.toArray() for m in models], axis=0)
    return _finished(residuals, rows, spec, weight,
                     lambda other: scored(_leaves(other, models, spec.features)))


def _finished(residuals: DataFrame, rows: DataFrame, spec: CausalSpec, weight: np.ndarray,
              predict: Callable[[DataFrame], DataFrame]) -> Estimate:
    spread = residuals.agg(F.avg(F.col("t_res") * F.col("t_res"))).first()[0]
    left = F.col("y_res") - F.col("effect") * F.col("t_res")
    score = F.col("effect") + left * F.col("t_res") / F.lit(spread)
    return _mean_effect("honest_forest", rows, score, importances=_ranked(spec.features, weight),
                        predict=predict)


# --- the same on cells ------------------------------------------------------------------

def _weights(row: np.ndarray, group: int, more: list[np.ndarray], per_half: int) -> np.ndarray:
    """Bootstrap weights of a group's trees, part 0 first, then whether a row is in either part."""
    inside, part = ((bits >> np.int64(group)) & 1 for bits in more[:2])
    mine = [((inside == 1) & (part == p)).astype(float) for p in (0, 1)]
    blocks = -(-2 * per_half // BLOCK)
    drawn = np.concatenate([bootstrap(row, group * blocks + b) for b in range(blocks)])[:2 * per_half]
    drawn[:per_half] *= mine[0] * more[2]
    drawn[per_half:] *= mine[1] * more[2]
    return np.vstack([drawn, *mine])


def _group_sums(batches: Iterator[pa.RecordBatch], cells: list[Cells], per_half: int
                ) -> Iterator[pa.RecordBatch]:
    """``block, keys, sums`` of every group, as :func:`~monthbook.operators.cells.dense` reads them."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= 4 * ROWS_PER_TASK:
            yield from _group_rows(held, cells, per_half)
            held, size = [], 0
    if size:
        yield from _group_rows(held, cells, per_half)


def _group_rows(held: list[pa.RecordBatch], cells: list[Cells], per_half: int
                ) -> Iterator[pa.RecordBatch]:
    pdf = pa.Table.from_batches(held).to_pandas()
    row, t, y = pdf["row"].to_numpy().view(np.uint64), pdf["t"].to_numpy(float), pdf["y"].to_numpy(float)
    more = [pdf[c].to_numpy() for c in _PARTS] + [(np.abs(t) > 1e-9).astype(float)]
    features = [pdf[f"x{i}"] for i in range(len(cells[0].features))]
    for group, own in enumerate(cells):
        at, known = own.place(features)
        at = at[known]
        keys = np.unique(at)
        place = np.searchsorted(keys, at)
        sums = [[np.bincount(place, w[known] * v[known], len(keys)) for w in _weights(row, group, more, per_half)]
                for v in (np.ones(len(t)), t * t, y * t)]
        if len(keys):
            yield pa.RecordBatch.from_arrays(
                [pa.array([group], pa.int32()), pa.array([keys.astype(np.int32).tobytes()], pa.binary()),
                 pa.array([np.array(sums).tobytes()], pa.binary())], ["block", "keys", "sums"])


def _grow_group(pieces: pd.DataFrame, cells: list[Cells], spec: CausalSpec, per_half: int) -> pd.DataFrame:
    """Leaves of a group's trees: of every cell, and their rows, products and squares."""
    group = int(pieces["block"].iloc[0])
    own = cells[group]
    n, square, product = dense(pieces, 2, 1, own)[:, :, 0]
    bins, rows = own.bins(), []
    for k in range(2 * per_half):
        there = (n[k] > 0) & (square[k] > 0)
        if not there.any():
            rows.append((2 * per_half * group + k, b"", b"", b""))
            continue
        rng = np.random.default_rng([spec.seed, group, k])
        tree = grow(bins, own.sizes, n[k], square[k], product[k], spec.treatment_depth, spec.leaf,
                    math.ceil(len(bins) / 3), rng, in_turn=True)
        other = 2 * per_half + (0 if k >= per_half else 1)  # the part the tree was not grown on
        filled = np.stack([np.bincount(tree.leaf, x[other], len(tree.value)) for x in (n, product, square)])
        filled[:, filled[2] <= 0] = 0.0
        filled[1:] /= np.maximum(filled[0], 1)
        share = tree.importance / (tree.importance.sum() or 1.0)
        rows.append((2 * per_half * group + k, tree.leaf.tobytes(), filled.tobytes(), share.tobytes()))
    return pd.DataFrame(rows, columns=["tree", "leaf", "filled", "importance"])


def _honest_cells(residuals: DataFrame, spec: CausalSpec, cells: list[Cells], per_half: int) -> Estimate:
    groups = len(cells)
    drawn = _draws(residuals, spec).select(
        F.xxhash64(F.lit(spec.seed), spec.id, *spec.features, "t_res", "y_res").alias("row"),
        F.col("t_res").alias("t"), F.col("y_res").alias("y"), *_PARTS,
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(spec.features)])
    sums = drawn.mapInArrow(partial(_group_sums, cells=cells, per_half=per_half),
                            "block int, keys binary, sums binary")
    grown = by_block(sums, groups, partial(_grow_group, cells=cells, spec=spec, per_half=per_half),
                     "tree int, leaf binary, filled binary, importance binary")
    trees = 2 * groups * per_half
    if len(grown) < trees or any(not r["leaf"] for r in grown):
        raise ValueError("too few rows for these groups")
    grown.sort(key=lambda r: r["tree"])
    filled = [np.frombuffer(r["filled"]).reshape(3, -1) for r in grown]
    table = np.zeros((3, trees, max(f.shape[1] for f in filled)))
    for k, part in enumerate(filled):
        table[:, k, :part.shape[1]] = part
    of_cell = [np.stack([np.frombuffer(r["leaf"], np.int32) for r in grown[g * 2 * per_half:][:2 * per_half]],
                        axis=1).astype(np.int16 if table.shape[2] < 1 << 15 else np.int32)
               for g in range(groups)]  # cells x trees of the group
    weight = np.mean([np.frombuffer(r["importance"]) for r in grown], axis=0)

    @F.pandas_udf("effect double, effect_low double, effect_high double")
    def score(*features: pd.Series) -> pd.DataFrame:
        placed = [own.place(features) for own in cells]
        leaves = np.concatenate([leaf[at] for leaf, (at, _) in zip(of_cell, placed)], axis=1)
        effect, error = effects_of(leaves, table, groups, per_half)
        effect = np.where(placed[0][1], effect, np.nan)
        return pd.DataFrame({"effect": effect, "effect_low": effect - _Z * error,
                             "effect_high": effect + _Z * error})

    def predict(other: DataFrame) -> DataFrame:
        kept = [c for c in other.columns if c not in ("effect", "effect_low", "effect_high")]
        found = other.select(*kept, score(*[F.col(c).cast("double") for c in spec.features]).alias("__found"))
        return found.select(*kept, "__found.*")

    return _finished(residuals, written(predict(residuals), "honest-effects"), spec, weight, predict)
