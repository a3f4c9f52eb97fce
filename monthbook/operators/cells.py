"""Tree ensembles grown on cells: the combinations of the bins of a few features.

Trees see features only through their bins (32 each, as in MLlib), so rows in one cell stay together
in every tree.  What a tree needs of them are sums: of bootstrap weights, of weights times labels.
One pass over the rows, dealt out by cell, makes these sums for all trees, folds and arms at once;
trees then grow on as many numbers as there are cells, however many rows there are.  A prediction
is a number per cell.

The trees are those of MLlib: cuts between quantiles, variance reduction, Poisson bootstrap and a third
of the features per node in forests; squared or logistic loss in boosters.  A bootstrap weight is
a hash of the row and the tree, so a retried task draws the same.

The number of cells is fixed by parameters and bounded by :data:`CELLS`; :func:`find_cells` gives None
above that, and callers train on rows instead.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Most bins of a feature, as in MLlib, and most cells.
BINS = 32
CELLS = 1 << 16
#: Trees whose weights come from one hash: 16 bits each.
BLOCK = 4
#: Rows a task should have while sums are made, and values that stand for a feature's rows there.
ROWS_PER_TASK = 500_000
_KEEP = 4096


# --- bins and cells ---------------------------------------------------------------------

@dataclass(frozen=True)
class Cells:
    """Ascending cuts of each feature: a value up to the first cut is in bin 0, and so on."""

    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    rows: int

    @property
    def sizes(self) -> tuple[int, ...]:
        return tuple(len(c) + 1 for c in self.cuts)

    @property
    def count(self) -> int:
        return math.prod(self.sizes)

    def place(self, columns: Sequence[pd.Series]) -> tuple[np.ndarray, np.ndarray]:
        """The cells of rows, and whether all features are there."""
        total, known = np.zeros(len(columns[0]), np.int32), np.ones(len(columns[0]), bool)
        for column, cuts in zip(columns, self.cuts):
            value = column.to_numpy(dtype=float, na_value=np.nan)
            known &= ~np.isnan(value)
            total = total * np.int32(len(cuts) + 1) + np.searchsorted(cuts, value).astype(np.int32)
        return total, known

    def _inputs(self) -> list[Column]:
        return [F.col(c).cast("double") for c in self.features]

    def number(self) -> Column:
        """The cell of a row; NULL where a feature is missing."""
        @F.pandas_udf("int")
        def cell(*columns: pd.Series) -> pd.Series:
            at, known = self.place(columns)
            return pd.Series(at, dtype="Int32").where(pd.Series(known))

        return cell(*self._inputs())

    def bins(self) -> tuple[np.ndarray, ...]:
        """The bin of every cell in each feature."""
        return tuple(b.astype(np.int32) for b in np.unravel_index(np.arange(self.count), self.sizes))

    def add(self, df: DataFrame, columns: Mapping[str, np.ndarray], group: str | None = None
            ) -> DataFrame:
        """``df`` with a column per array: its value for the cell (and the group) of a row.

        With ``group``, a column of whole numbers from 0, arrays have a line for every group.  Where a
        feature or the group is missing, the value is NULL.
        """
        made = {n: np.asarray(v, float).reshape(-1) for n, v in columns.items()}

        @F.pandas_udf(", ".join(f"`{n}` double" for n in made))
        def look_up(line: pd.Series, *features: pd.Series) -> pd.DataFrame:
            at, known = self.place(features)
            line = line.to_numpy(dtype=float, na_value=np.nan)
            known &= ~np.isnan(line)
            at = np.where(known, np.where(known, line, 0).astype(np.int64) * self.count + at, 0)
            return pd.DataFrame({n: np.where(known, v[at], np.nan) for n, v in made.items()})

        line = F.lit(0) if group is None else F.col(group)
        kept = [c for c in df.columns if c not in made]
        found = df.select(*kept, look_up(line, *self._inputs()).alias("__found"))
        return found.select(*kept, *[F.col("__found")[n].alias(n) for n in made])


def find_cells(df: DataFrame, features: Sequence[str], bins: int = BINS) -> Cells | None:
    """Cells of the rows of ``df``, from one pass; None if there could be more than ``CELLS``.

    A feature with up to ``bins`` values is cut between all of them, any other at quantiles (to a
    4,096th of the rows of each task).
    """
    found = drawn_cells(df, features, [None], bins)
    return found and found[0]


def drawn_cells(df: DataFrame, features: Sequence[str], draws: Sequence[np.random.Generator | None],
                bins: int = BINS, share: float = 1.0) -> list[Cells] | None:
    """:func:`find_cells` several times, each with the quantiles of another sample of the rows.

    Quantiles lie as those of up to 10,000 rows do (the sample from which MLlib takes cuts), or of a
    ``share`` of the rows if these are fewer; None stands for all rows.
    """
    named = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(features)])
    found = named.mapInArrow(_summaries, "feature int, n bigint, kept binary, counts binary").collect()
    cuts, rows = [], 0
    for i in range(len(features)):
        own = [r for r in found if r["feature"] == i]
        rows = max(rows, sum(r["n"] for r in own))
        values = np.concatenate([np.frombuffer(r["kept"]) for r in own] or [np.zeros(0)])
        counts = np.concatenate([np.frombuffer(r["counts"]) for r in own] or [np.zeros(0)])
        sample = max(bins, min(10_000, int(rows * share)))
        cuts.append([_cuts(values, counts, bins, _ranks(bins, rng, sample)) for rng in draws])
    made = [Cells(tuple(features), tuple(c[k] for c in cuts), rows) for k in range(len(draws))]
    return made if all(m.count <= CELLS for m in made) else None


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 4 * ROWS_PER_TASK:
            yield _summary(held)
            held = []
    if held:
        yield _summary(held)


def _summary(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = []
    for i in range(held[0].num_columns):
        values = np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held])
        values, counts = np.unique(values[~np.isnan(values)], return_counts=True)
        total = int(counts.sum())
        if len(values) > _KEEP:
            ranks = (np.arange(_KEEP) + 0.5) / _KEEP * total
            values = values[np.searchsorted(np.cumsum(counts), ranks)]
            counts = np.full(_KEEP, total / _KEEP)
        rows.append((i, total, values.tobytes(), counts.astype(float).tobytes()))
    feature, n, kept, counts = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(feature, pa.int32()), pa.array(n, pa.int64()), pa.array(kept, pa.binary()),
         pa.array(counts, pa.binary())], ["feature", "n", "kept", "counts"])


def _ranks(bins: int, rng: np.random.Generator | None, sample: int) -> np.ndarray:
    """Shares of the rows below each cut: even ones, or those of the quantiles of a sample."""
    even = np.arange(1, bins) / bins
    return even if rng is None else np.sort(rng.random(sample))[(even * sample).astype(int)]


def _cuts(values: np.ndarray, counts: np.ndarray, bins: int, ranks: np.ndarray) -> tuple[float, ...]:
    """Middles between values: all of them, or those nearest to the given shares of the rows."""
    if not len(values):
        return ()
    known, place = np.unique(values, return_inverse=True)
    middle = known[:-1] + (known[1:] - known[:-1]) / 2
    if len(known) <= bins:
        return tuple(middle.tolist())
    below = np.cumsum(np.bincount(place, counts))
    at = np.searchsorted(below, ranks * below[-1]).clip(1, len(known) - 1)
    nearer = np.abs(below[at - 1] - ranks * below[-1]) < np.abs(below[at] - ranks * below[-1])
    return tuple(middle[np.unique((at - nearer).clip(0, len(middle) - 1))].tolist())


# --- sums per cell ----------------------------------------------------------------------

def _poisson_steps() -> np.ndarray:
    """The weight that each of 65,536 equally likely draws stands for."""
    below = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(12)])
    return np.searchsorted(below, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


_STEPS = _poisson_steps()


def _mixed(rows: np.ndarray, block: int) -> np.ndarray:
    """A hash of the row's hash and a number (the finaliser of splitmix64)."""
    x = rows + np.uint64((block + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def bootstrap(rows: np.ndarray, block: int) -> np.ndarray:
    """Poisson weights of the trees of a block: a line per tree."""
    out = np.empty((BLOCK, len(rows)))
    for at in range(0, len(rows), 1 << 15):  # small enough to stay in the cache
        drawn = _mixed(rows[at:at + (1 << 15)], block).view(np.uint16).reshape(-1, BLOCK)
        out[:, at:at + (1 << 15)] = _STEPS[drawn.T]
    return out


def cell_sums(df: DataFrame, cells: Cells, values: Sequence[Column], blocks: int, seed: int,
              group: Column | None = None, key: Sequence[str] = ()) -> DataFrame:
    """``block, keys, sums``: for each block of trees, sums of weights and of weights times values.

    ``keys`` are ``group * cells + cell``; ``sums`` has an array (1 + values) x trees x keys.  Rows
    are dealt out by key, and those of a frequent key over several tasks.
    """
    at = cells.number() if group is None else group * F.lit(cells.count) + cells.number()
    row = F.xxhash64(F.lit(seed), *[F.col(c) for c in [*key, *cells.features]], *values)
    parts = max(1, math.ceil(cells.rows / ROWS_PER_TASK))
    rows = df.select(at.cast("int").alias("__at"), row.alias("__row"),
                     *[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)])
    rows = rows.where(F.col("__at").isNotNull()).repartitionByRange(parts, "__at", "__row")
    return rows.mapInArrow(partial(_summed, values=len(values), blocks=blocks),
                           "block int, keys binary, sums binary")


def _summed(batches: Iterator[pa.RecordBatch], values: int, blocks: int
            ) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= 4 * ROWS_PER_TASK:
            yield from _summed_rows(held, values, blocks)
            held, size = [], 0
    if size:
        yield from _summed_rows(held, values, blocks)


def _summed_rows(held: list[pa.RecordBatch], values: int, blocks: int
                 ) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held)
    at, row, *rest = (table.column(i).to_numpy() for i in range(table.num_columns))
    order = np.lexsort((row, at))  # sums are added in the same order by every run
    at, row = at[order], row[order].view(np.uint64)
    rest = [c[order] for c in rest]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    keys = at[starts].astype(np.int32).tobytes()
    for block in range(blocks):
        weights = bootstrap(row, block)
        out = np.empty((1 + values, len(weights), len(starts)))
        for i, weight in enumerate(weights):
            np.add.reduceat(weight, starts, out=out[0, i])
            for j in range(values):
                np.add.reduceat(weight * rest[j], starts, out=out[1 + j, i])
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([keys], pa.binary()),
             pa.array([out.tobytes()], pa.binary())], ["block", "keys", "sums"])


def plain_sums(df: DataFrame, cells: Cells, values: Sequence[Column], groups: int,
               group: Column) -> np.ndarray:
    """(1 + values) x groups x cells: rows and sums of values, from one aggregate."""
    found = df.select(
        group.alias("__g"), cells.number().alias("__c"),
        *[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)]).groupBy("__g", "__c").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(len(values))]
        ).where("__g IS NOT NULL AND __c IS NOT NULL").toArrow()  # groups x cells rows at most
    out = np.zeros((1 + len(values), groups, cells.count))
    place = found["__g"].to_numpy(), found["__c"].to_numpy()
    out[0][place] = found["n"].to_numpy()
    for i in range(len(values)):
        out[1 + i][place] = found[f"v{i}"].to_numpy()
    return out


# --- trees ------------------------------------------------------------------------------

@dataclass
class Tree:
    """What a tree says of every cell: the number of its leaf, and each leaf's mean label."""

    leaf: np.ndarray
    value: np.ndarray
    importance: np.ndarray


def grow(bins: Sequence[np.ndarray], sizes: Sequence[int], rows: np.ndarray, weight: np.ndarray,
         label: np.ndarray, depth: int, least: int, per_node: int | None = None,
         rng: np.random.Generator | None = None, in_turn: bool = False) -> Tree:
    """A regression tree on sums per cell: ``rows``, their weights, and weights times labels.

    Each node is cut where the variance falls most, with ``least`` rows on both sides; with
    ``per_node`` it looks at so many features only, drawn by ``rng``; ``in_turn`` draws those first that
    no node above it has looked at.
    """
    there = np.flatnonzero((rows > 0) & (weight > 0))
    total = weight[there].sum()
    mean = label[there].sum() / total
    n, w = rows[there], weight[there]
    s = label[there] - mean * w  # about the mean: no digits are lost to a far one
    least_gain = 1e-12 * float((s * s / w).sum())
    own = [b[there] for b in bins]
    leaf = np.zeros(len(bins[0]), np.int32)  # of every cell, also of those without rows
    value = [mean]
    importance = np.zeros(len(bins))
    node = np.zeros(len(there), np.int64)  # place among the open nodes, of the cells in them
    open_ = np.array([0])
    seen = np.zeros((1, len(bins)), bool)
    for _ in range(depth):
        m = len(open_)
        allowed = np.ones((m, len(bins)), bool)
        if per_node is not None and per_node < len(bins):
            rank = (rng.random((m, len(bins))) + (seen & in_turn)).argsort(axis=1).argsort(axis=1)
            allowed = rank < per_node
            seen |= allowed
            seen[seen.all(axis=1)] = False
        best = np.full(m, least_gain)
        feature, cut = np.full(m, -1), np.zeros(m, np.int64)
        left, right = np.zeros(m), np.zeros(m)
        for f, size in enumerate(sizes):
            if size < 2 or not allowed[:, f].any():
                continue
            at = node * size + own[f]
            nl, wl, sl = (np.bincount(at, x, m * size).reshape(m, size).cumsum(axis=1)
                          for x in (n, w, s))
            nt, wt, st = nl[:, -1:], wl[:, -1:], sl[:, -1:]
            nl, wl, sl = nl[:, :-1], wl[:, :-1], sl[:, :-1]
            fits = (nl >= least) & (nt - nl >= least) & (wl > 0) & (wt - wl > 0) & allowed[:, f:f + 1]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(fits, sl * sl / wl + (st - sl) ** 2 / (wt - wl) - st * st / wt, -1.0)
                k = gain.argmax(axis=1)
                line = np.arange(m)
                better = gain[line, k] > best
                best = np.where(better, gain[line, k], best)
                feature[better], cut[better] = f, k[better]
                lm, rm = sl[line, k] / wl[line, k], ((st - sl) / (wt - wl))[line, k]
            left, right = np.where(better, lm, left), np.where(better, rm, right)
        parted = np.flatnonzero(feature >= 0)
        if not len(parted):
            break
        np.add.at(importance, feature[parted], best[parted])
        # The node keeps its number for the left side; the right one gets a new number.
        fresh = len(value) + np.arange(len(parted))
        for i, k in enumerate(parted):
            value[open_[k]] = mean + left[k]
            value.append(mean + right[k])
        goes = np.full(len(value), -1)  # number of a node to its place among those cut
        goes[open_[parted]] = np.arange(len(parted))
        place = goes[leaf]
        hit = np.flatnonzero(place >= 0)
        hit_place = place[hit]
        above = np.zeros(len(hit), bool)
        for f in np.unique(feature[parted]):
            mine = feature[parted][hit_place] == f
            above[mine] = bins[f][hit[mine]] > cut[parted][hit_place[mine]]
        leaf[hit[above]] = fresh[hit_place[above]]
        open_ = np.concatenate([open_[parted], fresh])
        seen = np.concatenate([seen[parted], seen[parted]])
        back = np.full(len(value), -1)
        back[open_] = np.arange(len(open_))
        node = back[leaf[there]]
        inside = node >= 0
        if not inside.all():
            there, n, w, s = there[inside], n[inside], w[inside], s[inside]
            own, node = [b[inside] for b in own], node[inside]
    return Tree(leaf, np.array(value), importance)


@dataclass(frozen=True)
class Forest:
    """One forest to be grown: on which groups, which value is the label, and which the weight.

    ``label`` and ``weight`` count from 1, and 0 is the bootstrap weight itself; a weighted label is
    the value times the weight already.  ``less`` (a number per cell) is taken off the label, and
    ``sign`` turns it round.
    """

    groups: tuple[int, ...]
    label: int
    trees: int
    weight: int = 0
    less: np.ndarray | None = field(default=None, compare=False)
    sign: float = 1.0


@dataclass(frozen=True)
class Grown:
    """Prediction per cell, and the importance of each feature."""

    cell: np.ndarray
    importance: np.ndarray


def dense(pieces: pd.DataFrame, values: int, groups: int, cells: Cells) -> np.ndarray:
    """(1 + values) x trees x groups x cells, from all pieces of a block."""
    out = None
    keys = [np.frombuffer(k, np.int32) for k in pieces["keys"]]
    for i in sorted(range(len(keys)), key=lambda i: (int(keys[i][0]), len(keys[i]), pieces["sums"].iloc[i])):
        piece = np.frombuffer(pieces["sums"].iloc[i]).reshape(1 + values, -1, len(keys[i]))
        if out is None:
            out = np.zeros((1 + values, piece.shape[1], groups * cells.count))
        out[:, :, keys[i]] += piece
    return out.reshape(1 + values, -1, groups, cells.count)


def by_block(sums: DataFrame, blocks: int, work: Callable[[pd.DataFrame], pd.DataFrame],
             schema: str) -> list:
    """The rows that ``work`` gives for the pieces of each block, blocks side by side."""
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        return work(pieces)

    return sums.repartition(max(1, blocks), "block").groupBy("block").applyInPandas(run, schema).collect()


def grow_forests(sums: DataFrame, cells: Cells, jobs: Mapping[str, Forest], values: int, groups: int,
                 depth: int, least: int, seed: int) -> dict[str, Grown]:
    """Several forests from the same sums; a tree of each draws the same weights."""
    blocks = math.ceil(max(j.trees for j in jobs.values()) / BLOCK)
    made = by_block(sums.where(F.col("block") < blocks), blocks, partial(
        _grow_block, cells=cells, jobs=dict(jobs), values=values, groups=groups, depth=depth,
        least=least, seed=seed), "job string, block int, trees int, cell binary, importance binary")
    out = {}
    for name, job in jobs.items():
        own = sorted((r for r in made if r["job"] == name and r["trees"]), key=lambda r: r["block"])
        if not own:
            raise ValueError(f"no rows to train {name} on")
        cell = sum(np.frombuffer(r["cell"]) for r in own) / sum(r["trees"] for r in own)
        importance = sum(np.frombuffer(r["importance"]) for r in own)
        out[name] = Grown(cell, importance / (importance.sum() or 1.0))
    return out


def _grow_block(pieces: pd.DataFrame, cells: Cells, jobs: dict[str, Forest], values: int, groups: int,
                depth: int, least: int, seed: int) -> pd.DataFrame:
    block = int(pieces["block"].iloc[0])
    sums, bins, sizes = dense(pieces, values, groups, cells), cells.bins(), cells.sizes
    rows = []
    for number, (name, job) in enumerate(jobs.items()):
        cell, importance, trees = np.zeros(cells.count), np.zeros(len(sizes)), 0
        for i in range(min(BLOCK, job.trees - block * BLOCK)):
            n, w, s = (sums[k, i, list(job.groups)].sum(axis=0) for k in (0, job.weight, job.label))
            if not ((n > 0) & (w > 0)).any():
                continue  # a bootstrap of very few rows can be empty
            trees += 1
            if job.less is not None:
                s = s - job.less * w
            rng = np.random.default_rng([seed, number, block * BLOCK + i])
            tree = grow(bins, sizes, n, w, job.sign * s, depth, least, math.ceil(len(sizes) / 3), rng)
            cell += tree.value[tree.leaf]
            importance += tree.importance / (tree.importance.sum() or 1.0)
        rows.append((name, block, trees, cell.tobytes(), importance.tobytes()))
    return pd.DataFrame(rows, columns=["job", "block", "trees", "cell", "importance"])


@dataclass(frozen=True)
class Booster:
    """One boosted model: rows and sums of labels per cell.

    With ``chance`` the labels are 0 or 1, and the model gives the chance of a 1.
    """

    rows: np.ndarray
    label: np.ndarray
    chance: bool = False


def grow_boosters(spark: SparkSession, cells: Cells, jobs: Mapping[str, Booster], trees: int,
                  depth: int, step: float = 0.1) -> dict[str, np.ndarray]:
    """Predictions per cell of several boosters, each trained in a task of its own."""
    names, work = list(jobs), list(jobs.values())
    for name, job in jobs.items():
        if not (job.rows > 0).any():
            raise ValueError(f"no rows to train {name} on")

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = cells.bins()
        for batch in batches:
            for i in batch["id"]:
                made = boost(work[i], bins, cells.sizes, trees, depth, step)
                yield pd.DataFrame({"id": [i], "cell": [made.tobytes()]})

    found = spark.range(len(names), numPartitions=len(names)).mapInPandas(
        train, "id bigint, cell binary").collect()
    return {names[r["id"]]: np.frombuffer(r["cell"]) for r in found}


def boost(job: Booster, bins: Sequence[np.ndarray], sizes: Sequence[int], trees: int, depth: int,
          step: float) -> np.ndarray:
    """Gradient boosting; gradients of rows in one cell differ by their labels only."""
    n, ones = job.rows.astype(float), job.label
    out = np.zeros(len(n))
    for k in range(trees):
        if job.chance and k:  # logistic loss of labels -1 and 1
            label = 4 * (ones / (1 + np.exp(2 * out)) - (n - ones) / (1 + np.exp(-2 * out)))
        elif job.chance:
            label = 2 * ones - n
        else:
            label = 2 * (ones - n * out) if k else ones
        tree = grow(bins, sizes, n, n, label, depth, 1)
        out += (step if k else 1.0) * tree.value[tree.leaf]
    return 1 / (1 + np.exp(-2 * out)) if job.chance else out
