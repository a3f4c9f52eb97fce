"""Mixing sources to target weights by the cube method.

Each source gets a target of words.  With ratio r = target / words of the source, every document
is taken floor(r) times for certain, and once more with probability r - floor(r).  The extra copies
are drawn by the cube method: the vector of probabilities moves, at random and without drift,
inside the null space of the balancing constraints (number of documents, number of words) until
all but a few of its entries are 0 or 1, so that the drawn totals equal the expected ones.

The flight is a stream: with two constraints three undecided documents are enough for a move,
and each move decides at least one of them.  A task reads its blocks (a hash of doc_id and text within
the source) in order and holds three documents.  The two or fewer that a block leaves undecided go, in
a second flight, with those of the other blocks of the source; a thousand blocks become one, until
one is left.  Of that one the last ``LAND`` documents stay out of the flight; with the undecided ones they
are the landing problem, and that outcome is taken whose words come nearest to the target.

Defined results: a null text or one without words has size 0 and takes part in the count only; a
null source is a source and comes last; rows that share a doc_id and a text share a block and are
drawn one by one; an empty table gives no rows.  Draws depend on source, block and the
seed alone, so a rerun or a retried task draws the same.
"""

from __future__ import annotations

import random
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from monthbook.llm.common import WORD, partitions, read, saved, unit

WEIGHTS = (3, 1, 2)
FACTOR = 1.5
MOST_COPIES = 2.0
BLOCK = 4096
LAND = 12


def _version() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, version (a hash of the text), source and size: the number of words."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), _version().alias("version"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0))
        .cast("bigint").alias("size"))


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   factor: float = FACTOR, most: float = MOST_COPIES) -> DataFrame:
    """source, source_size, docs, target: one row per source.

    Sources weigh ``weights`` in turn, by code point, null last.  ``factor`` times all sizes is
    shared by weight; a target stops at ``most`` times its source's size, and the excess is shared
    again.  The sources that stop are those with the least room per weight, so one pass over the
    sources in that order finds the level at which the rest share.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                         F.count(F.lit(1)).alias("docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
    room = (F.col("source_size") * F.lit(float(most)))
    ranked = ranked.withColumn("room", room).withColumn("level", F.col("room") / F.col("weight"))
    below = Window.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("level", "rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    tested = (ranked.withColumn("spent", F.coalesce(F.sum("room").over(below), F.lit(0.0)))
              .withColumn("left", F.sum("weight").over(rest))
              .withColumn("all", F.sum("source_size").over(every) * F.lit(float(factor)))
              # the level if this source and all above it share what those below leave
              .withColumn("share", (F.col("all") - F.col("spent")) / F.col("left"))
              .withColumn("open", F.when(F.col("share") <= F.col("level"), F.col("share"))))
    level = F.max("open").over(every)  # closing more sources only lowers the share
    return tested.select("source", "source_size", "docs", F.coalesce(
        F.least("room", F.col("weight") * level), "room").alias("target"))


class _Flight:
    """The moves of one block.  ``free`` holds the undecided documents, three at most."""

    def __init__(self, seed: object) -> None:
        self.draw = random.Random(unit(seed)).random
        self.free: list[list] = []

    def add(self, row: tuple, prob: float) -> Iterator[tuple[tuple, int]]:
        if prob <= 1e-12 or prob >= 1 - 1e-12:
            yield row, int(prob > 0.5)
            return
        self.free.append([row, prob, row[3]])
        if len(self.free) == 3:
            yield from self.move(self._plane())

    def _plane(self) -> list[float]:
        """A direction that leaves the count and the words of the three as they are."""
        a, b, c = (x[2] for x in self.free)
        u = [float(c - b), float(a - c), float(b - a)]
        return u if any(u) else [1.0, -1.0, 0.0]

    def move(self, u: list[float]) -> Iterator[tuple[tuple, int]]:
        """As far as the cube allows, one way or the other, so that the mean stays."""
        ahead = back = float("inf")
        for (_, p, _), d in zip(self.free, u):
            if d:
                up, down = ((1 - p) / d, p / d) if d > 0 else (p / -d, (1 - p) / -d)
                ahead, back = min(ahead, up), min(back, down)
        step = ahead if self.draw() * (ahead + back) < back else -back
        left = []
        for x, d in zip(self.free, u):
            x[1] += step * d
            if x[1] <= 1e-9 or x[1] >= 1 - 1e-9:
                yield x[0], int(x[1] > 0.5)
            else:
                left.append(x)
        self.free = left

    def land(self, held: list[list]) -> Iterator[tuple[tuple, int]]:
        """Of all outcomes of the last few, the one nearest to what was expected."""
        last = self.free + held
        outcomes = (np.arange(1 << len(last))[:, None] >> np.arange(len(last))) & 1
        prob, size = (np.array([x[k] for x in last], float) for k in (1, 2))
        off = outcomes - prob
        miss = np.abs(off @ size) + 0.05 * size.mean() * np.abs(off.sum(axis=1))
        for x, extra in zip(last, outcomes[int(np.argmin(miss))]):
            yield x[0], int(extra)
        self.free = []


def _fly(seed: object):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, flight, held, out = None, None, deque(), []

        def close() -> None:
            if flight is not None:
                if key[2] == 1 and (flight.free or held):
                    out.extend((*row, extra, None) for row, extra in flight.land(list(held)))
                out.extend((*row, None, prob) for row, prob, _ in flight.free)
            held.clear()

        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for doc_id, version, source, size, prob, blocks, block in zip(*cols):
                if key != (source, block, blocks):
                    close()
                    key, flight = (source, block, blocks), _Flight((seed, source, block, blocks))
                row = (doc_id, version, source, size)
                if blocks == 1 and 0 < prob < 1:  # the last flight of the source
                    held.append([row, prob, size])
                    if len(held) <= LAND:
                        continue
                    row, prob, _ = held.popleft()
                out.extend((*row, extra, None) for row, extra in flight.add(row, prob))
            if len(out) > 20_000:
                yield _batch(out)
                out = []
        close()
        yield _batch(out)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
        names=["doc_id", "version", "source", "size", "extra", "prob"])


def cube_sample(units: DataFrame, block: int = BLOCK, seed: int = 1) -> DataFrame:
    """doc_id, version, source, size, extra (0 or 1) for units (the same with ``prob``).

    Without a ``version`` rows are told apart by doc_id alone.

    Within each source the number of chosen units and their words come as near to what ``prob``
    makes expect as one undecided unit allows.
    """
    if "version" not in units.columns:
        units = units.withColumn("version", F.lit(0).cast("bigint"))
    counts = units.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    here = units.alias("u").join(counts.alias("c"), F.expr("u.source <=> c.source")).select(
        "u.doc_id", "u.version", "u.source", "u.size", "u.prob",
        F.ceil(F.col("n") / block).cast("bigint").alias("blocks"))
    decided = None
    spread = 1
    while True:
        # the block of the first flight, of which the later ones join `block / 4` at a time
        at = F.floor(F.pmod(F.xxhash64("doc_id", "version"), F.col("blocks")) / spread)
        blocks = F.ceil(F.col("blocks") / spread)
        flown = (here.select("doc_id", "version", "source", "size", "prob", blocks.alias("now"),
                             at.cast("bigint").alias("block"))
                 .repartition(partitions(units.sparkSession), "source", "block")
                 .sortWithinPartitions("source", "block", "doc_id", "version")
                 .select("doc_id", "version", "source", "size", "prob",
                         F.col("now").cast("bigint").alias("blocks"), "block")
                 .mapInArrow(_fly((seed, spread)),
                             "doc_id bigint, version bigint, source string, size bigint, extra bigint, "
                             "prob double"))
        flown = saved(flown, "flight")
        done = flown.where("extra IS NOT NULL").drop("prob")
        decided = done if decided is None else decided.union(done)
        rest = flown.where("extra IS NULL").drop("extra")
        if rest.isEmpty():
            return decided
        here = rest.alias("u").join(counts.alias("c"), F.expr("u.source <=> c.source")).select(
            "u.doc_id", "u.version", "u.source", "u.size", "u.prob",
            F.ceil(F.col("n") / block).cast("bigint").alias("blocks"))
        spread *= max(2, block // 4)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, factor: float = FACTOR,
        most: float = MOST_COPIES, block: int = BLOCK, seed: int = 1) -> DataFrame:
    """doc_id, version, source, size, source_size, target, copies, taken: a row per document."""
    sized = saved(sizes(docs), "sizes")
    goals = source_targets(sized, weights, factor, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = saved(goals.withColumn("whole", F.floor(ratio).cast("bigint"))
                  .withColumn("prob", ratio - F.floor(ratio)), "targets")
    units = sized.alias("s").join(goals.alias("g"), F.expr("s.source <=> g.source")).select(
        "s.doc_id", "s.version", "s.source", "s.size", "g.prob")
    drawn = cube_sample(units, block, seed)
    out = drawn.alias("d").join(goals.alias("g"), F.expr("d.source <=> g.source"))
    copies = F.col("g.whole") + F.col("d.extra")
    return out.select("d.doc_id", "d.version", "d.source", "d.size", "g.source_size", "g.target",
                      copies.alias("copies"), (copies * F.col("d.size")).alias("taken"))


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns.

    Rows are matched by doc_id, text and source.  Rows that share all three are one document given
    several times: each stays as often as they are taken on average, rounded down, and what
    is left over is taken from one of them, so that the mix holds the words that were drawn.
    """
    key = ["doc_id", "version", "source"]
    copies = saved(mix(docs, **options).groupBy(*key).agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n")).where("copies > 0"), "copies")
    rows = docs.alias("d").join(copies.alias("c"), (
        F.col("d.doc_id").cast("bigint").eqNullSafe(F.col("c.doc_id"))
        & (F.xxhash64(F.coalesce(F.col("d.text").cast("string"), F.lit(""))) == F.col("c.version"))
        & F.col("d.source").cast("string").eqNullSafe(F.col("c.source"))))

    def times(number: Column) -> Column:
        return F.explode(F.sequence(F.lit(1), number.cast("int")))

    each = F.floor(F.col("c.copies") / F.col("c.n"))
    out = rows.where(each > 0).select("d.*", times(each).alias("__time")).drop("__time")
    left = copies.where("copies % n > 0")
    if left.isEmpty():
        return out
    one = rows.where("c.copies % c.n > 0").groupBy("c.doc_id", "c.version", "c.source").agg(
        F.any_value(F.struct("d.*")).alias("row"), F.max(F.expr("c.copies % c.n")).alias("more"))
    return out.unionByName(one.select("row", times(F.col("more")).alias("__time")).select("row.*"))
