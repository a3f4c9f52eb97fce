"""Quantile and fixed bins, time folds, and the tables behind charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from monthbook.operators.ranks import quantile_values, quantiles, row_index


def _right_closed(value: Column, edges: Sequence[float], labels: Sequence[str],
                  lowest: bool) -> Column:
    """Label of the bin ``(edge, next edge]``; NULL outside."""
    first = value >= edges[0] if lowest else value > edges[0]
    out = F.when(first & (value <= edges[1]), labels[0])
    for upper, label in zip(edges[2:], labels[1:]):
        out = out.when(first & (value <= upper), label)
    return out


def quantile_edges(df: DataFrame, value: str, n: int) -> list[float]:
    """The ``n + 1`` exact edges of ``n`` bins of equal size."""
    edges = quantile_values(df, value, [i / n for i in range(n + 1)])
    if len(set(edges)) != len(edges):
        raise ValueError(f"bin edges of {value} repeat: {edges}")
    return edges


def quantile_bins(df: DataFrame, value: str, n: int, name: str = "bin",
                  edges: Sequence[float] | None = None) -> DataFrame:
    """Adds ``Q1`` … ``Qn``: equal-size bins, closed on the right, equal values together."""
    edges = edges or quantile_edges(df, value, n)
    labels = [f"Q{i + 1}" for i in range(n)]
    return df.withColumn(name, _right_closed(F.col(value).cast("double"), edges, labels, True))


# Term bins in months.
TERM_EDGES = (0, 180, 300, 500)
TERM_LABELS = ("Curto", "Médio", "Longo")


def fixed_bins(df: DataFrame, value: str, edges: Sequence[float] = TERM_EDGES,
               labels: Sequence[str] = TERM_LABELS, name: str = "bin") -> DataFrame:
    """Adds the label of ``(edge, next edge]``; NULL outside all of them."""
    return df.withColumn(name, _right_closed(F.col(value), edges, labels, False))


def effect_by_bin(df: DataFrame, effect: str, by: str, n: int = 5) -> DataFrame:
    """Mean, sample deviation and count of an effect per quantile bin, with the edges."""
    edges = quantile_edges(df, by, n)
    binned = quantile_bins(df, by, n, "bin", edges)
    lower = F.element_at(F.array(*[F.lit(e) for e in edges]), F.col("i"))
    upper = F.element_at(F.array(*[F.lit(e) for e in edges]), F.col("i") + 1)
    return (binned.where(F.col("bin").isNotNull()).groupBy("bin")
            .agg(F.avg(effect).alias("mean"), F.stddev_samp(effect).alias("std"),
                 F.count(effect).alias("count"))
            .withColumn("i", F.substring("bin", 2, 9).cast("int"))
            .select("bin", lower.alias("lower"), upper.alias("upper"), "mean", "std", "count"))


# --- time folds -------------------------------------------------------------------------

def temporal_index(df: DataFrame, time: str, tie: str, folds: int) -> DataFrame:
    """Adds ``row_index`` in time order and ``block``, 0 … ``folds - 1`` of equal length.

    The remainder rows at the end, and rows without a time, have a NULL block: they belong to
    no fold.
    """
    indexed = row_index(df, time, tie)
    size = df.where(F.col(time).isNotNull()).count() // folds
    block = F.floor(F.col("row_index") / F.lit(max(size, 1)))
    return indexed.withColumn("block", F.when(block < folds, block.cast("int")))


def fold_parts(indexed: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Training rows (all blocks up to ``fold``) and test rows (the next block)."""
    return indexed.where(F.col("block") <= fold), indexed.where(F.col("block") == fold + 1)


def temporal_splits(df: DataFrame, time: str, tie: str, folds: int = 5) -> DataFrame:
    """Rows and time range of the train and test part of every fold, in one pass.

    Blocks are summed up first; the folds are then made from those few rows.
    """
    blocks = (temporal_index(df, time, tie, folds).where(F.col("block").isNotNull())
              .groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("first"),
                                    F.max(time).alias("last")))
    uses = F.array(*[F.struct(F.lit(i).alias("fold"), F.lit(part).alias("part"), use.alias("u"))
                     for i in range(folds - 1)
                     for part, use in (("train", F.col("block") <= i),
                                       ("test", F.col("block") == i + 1))])
    return (blocks.select("*", F.inline(uses)).where("u").groupBy("fold", "part")
            .agg(F.sum("n").alias("n_rows"), F.min("first").alias("first_time"),
                 F.max("last").alias("last_time")))


# --- tables behind charts ---------------------------------------------------------------

def _limits(df: DataFrame, columns: Sequence[str]) -> list[tuple[float, float]]:
    row = df.agg(*[f(F.col(c).cast("double")) for c in columns for f in (F.min, F.max)]).first()
    out = []
    for i in range(len(columns)):
        low, high = row[2 * i], row[2 * i + 1]
        if low is not None and low == high:
            low, high = low - 0.5, high + 0.5
        out.append((low, high))
    return out


def _bin_number(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based bin of equal width; the top edge belongs to the last bin."""
    at = F.floor((value.cast("double") - F.lit(low)) / F.lit((high - low) / bins))
    return F.least(at, F.lit(bins - 1).cast("long"))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Rows per bin of equal width, empty bins included.

    Without any value all bins are empty and have no edges.
    """
    (low, high), = _limits(df, [value])
    if low is None:
        none = F.lit(None).cast("double")
        return df.sparkSession.range(bins).select(
            F.col("id").alias("bin"), none.alias("lower"), none.alias("upper"),
            F.lit(0).cast("bigint").alias("n_rows"))
    width = (high - low) / bins
    counted = (df.where(F.col(value).isNotNull())
               .groupBy(_bin_number(F.col(value), low, high, bins).alias("bin"))
               .agg(F.count(F.lit(1)).alias("n_rows")))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(counted, "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def density_2d(df: DataFrame, x: str, y: str, grid: int = 25) -> DataFrame:
    """Rows per cell of a grid over two columns; empty cells are left out."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    (x0, x1), (y0, y1) = _limits(both, [x, y])
    if x0 is None:
        x0, x1, y0, y1 = 0.0, 1.0, 0.0, 1.0  # no rows, so no cells
    return (both
            .groupBy(_bin_number(F.col(x), x0, x1, grid).alias("x_bin"),
                     _bin_number(F.col(y), y0, y1, grid).alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 times the box) and outliers per group."""
    rows = df.where(F.col(by).isNotNull() & F.col(value).isNotNull()).select(
        by, F.col(value).cast("double").alias("__v"))
    box = quantiles(rows, "__v", [0.25, 0.5, 0.75], by=[by])
    reach = (F.col("q2") - F.col("q0")) * 1.5
    inside = F.col("__v").between(F.col("q0") - reach, F.col("q2") + reach)
    return (rows.join(box, by).groupBy(by)
            .agg(F.first("q0").alias("q1"), F.first("q1").alias("median"),
                 F.first("q2").alias("q3"),
                 F.min(F.when(inside, F.col("__v"))).alias("whisker_low"),
                 F.max(F.when(inside, F.col("__v"))).alias("whisker_high"),
                 F.count_if(~inside).alias("outliers"), F.count(F.lit(1)).alias("n_rows")))


def scatter_sample(df: DataFrame, id: str, columns: Sequence[str],
                   share: float = 0.1) -> DataFrame:
    """A repeatable sample by the hash of the id, for drawing points."""
    number = F.conv(F.substring(F.md5(F.col(id).cast("string")), 1, 8), 16, 10).cast("long")
    return df.where(number < int(share * 2 ** 32)).select(id, *columns)
