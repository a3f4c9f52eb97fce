"""Near-duplicate documents by SimHash, linked with a generalised pigeonhole search.

Fingerprint.  A-Z are lower-cased, words are runs of anything but ASCII white space, and a shingle
is ``shingle`` words joined by blanks (the whole sequence if there are fewer).  Bit b of the
fingerprint is 1 if bit b is set in more than half of the XXH64 values (seed 42) of all shingles.

Search.  Documents with one fingerprint are one node.  The 64 bits are put into groups, correlated
bits together; a group g gets a threshold t(g), with sum(t(g) + 1) = distance + 1.  Two nodes
within ``distance`` then agree on some group up to its threshold.  Each node is stored under its
value of each group and probes with all values within the group's threshold.  Number of groups and
thresholds come from dynamic programming on the expected cost: probes, and candidate pairs, which
are estimated from the histograms of eight-bit blocks over all nodes.

Dense keys.  A key that more than ``dense`` nodes share would give about dense**2 pairs.  Its nodes
meet in two-step links instead: nodes within ``distance`` have a common point that is
ceil(distance / 2) away from the one and floor(distance / 2) from the other, so each dense node
names all such points and hangs on the least node of each.  That is exact and grows in proportion.

Defined results: null and empty texts have fingerprint 0 and link like any other; repeated rows
and ties share a node; rows with a null doc_id get a fingerprint and may connect others, and a
component without any doc_id has a null component_id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthbook.llm.common import doc_texts, read, saved, slices
from monthbook.llm.graph import components

SHINGLE = 4
DISTANCE = 4
DENSE = 4096
BITS = 64
BLOCKS = 8
#: Probes of one node in one group: thresholds that need more are not considered.
MOST_PROBES = 5000
#: What a shuffled probe costs against a compared pair.
PROBE_COST = 4.0
_SEED = 42


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a whole text; 0 if it has no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, seed = xxhash.xxh64_intdigest, _SEED
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())),
                         np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at: at + (1 << 16)].astype(">u8").view(np.uint8))
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, version (a hash of the text) and fp, the fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [_signed(fingerprint(t, shingle)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.int64())],
                                             names=["doc_id", "version", "fp"])
    rows = doc_texts(docs).select("doc_id", F.xxhash64("text").alias("version"), "text")
    return rows.mapInArrow(run, "doc_id bigint, version bigint, fp bigint")


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each pair of bits is set together, over one partition's nodes."""
    total = np.zeros((BITS, BITS))
    for batch in batches:
        raw = np.asarray(batch.column(0), dtype=np.int64).view(np.uint64)
        bits = np.unpackbits(raw.astype(">u8").view(np.uint8)).reshape(-1, BITS)[:, ::-1]
        total += bits.T.astype(np.float64) @ bits.astype(np.float64)
    yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS), pa.int32()),
                                      pa.array(total.ravel())], names=["cell", "n"])


def _order(together: np.ndarray, n: float) -> list[int]:
    """Bits in an order that puts correlated ones side by side: always the nearest to the last."""
    p = together.diagonal() / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    close = np.abs((together / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(close, -1)
    order = [int(np.argmax(close.max(axis=1)))]
    rest = set(range(BITS)) - set(order)
    while rest:
        order.append(max(sorted(rest), key=lambda b: close[order[-8:], b].sum()))
        rest.remove(order[-1])
    return order


def _gather(fp: Column, bits: list[int]) -> Column:
    """The given bits of a fingerprint, side by side in one number."""
    out = F.lit(0).cast("bigint")
    for k, b in enumerate(bits):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1)), k))
    return out


def _near(histogram: np.ndarray) -> np.ndarray:
    """The shares of node pairs at distance 0, 1, ... in a block, from the counts of its values."""
    h = histogram.astype(np.float64)
    step = 1
    while step < len(h):  # Walsh-Hadamard transform, squared and taken back: pairs by xor
        h = h.reshape(-1, 2, step)
        h = np.stack([h[:, 0] + h[:, 1], h[:, 0] - h[:, 1]], axis=1).ravel()
        step *= 2
    h, step = h * h, 1
    while step < len(h):
        h = h.reshape(-1, 2, step)
        h = np.stack([h[:, 0] + h[:, 1], h[:, 0] - h[:, 1]], axis=1).ravel()
        step *= 2
    pairs = h / len(h)
    weight = np.array([bin(v).count("1") for v in range(len(pairs))])
    return np.bincount(weight, weights=pairs) / max(pairs.sum(), 1.0)


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with ``radius`` bits set at most."""
    return [sum(1 << b for b in picked) for r in range(radius + 1)
            for picked in combinations(range(width), r)]


def allocate(near: list[np.ndarray], n: float, distance: int) -> list[tuple[list[int], int]]:
    """Groups of blocks with their thresholds, at the least expected cost.

    For each number of groups the blocks are shared out evenly, in order.  The cost of a group at
    a threshold is its probes plus its expected candidates; thresholds of -1 leave a group out.
    Dynamic programming over the groups finds thresholds with sum(t + 1) = distance + 1.
    """
    best = None
    for m in range(2, len(near) + 1):
        cuts = [round(k * len(near) / m) for k in range(m + 1)]
        groups = [list(range(a, b)) for a, b in zip(cuts, cuts[1:])]
        table = {0: (0.0, [])}
        for group in groups:
            dist = np.ones(1)
            for b in group:
                dist = np.convolve(dist, near[b])
            width = BITS // len(near) * len(group)
            grown: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, chosen) in table.items():
                for t in range(-1, distance - spent + 1):
                    probes = 0.0 if t < 0 else 1 + sum(comb(width, r) for r in range(t + 1))
                    if probes > MOST_PROBES:
                        break
                    here = cost + n * probes * PROBE_COST + (n * n * dist[:t + 1].sum()
                                                             if t >= 0 else 0.0)
                    at = spent + t + 1
                    if at not in grown or here < grown[at][0]:
                        grown[at] = (here, [*chosen, t])
            table = grown
        if distance + 1 in table and (best is None or table[distance + 1][0] < best[0]):
            best = (table[distance + 1][0], [(g, t) for g, t in
                                             zip(groups, table[distance + 1][1]) if t >= 0])
    if best is None:
        raise ValueError(f"no thresholds for a distance of {distance}")
    return best[1]


def plan(nodes: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds, from statistics of all nodes."""
    n = nodes.count()
    cells = (nodes.select("fp").mapInArrow(_moments, "cell int, n double")
             .groupBy("cell").agg(F.sum("n").alias("n")).collect())  # 64 x 64 numbers
    together = np.zeros(BITS * BITS)
    for row in cells:
        together[row["cell"]] = row["n"]
    order = _order(together.reshape(BITS, BITS), max(n, 1))
    width = BITS // BLOCKS
    blocks = [order[k * width: (k + 1) * width] for k in range(BLOCKS)]
    values = F.array(*[F.struct(F.lit(k).alias("block"), _gather(F.col("fp"), b).alias("value"))
                       for k, b in enumerate(blocks)])
    counts = (nodes.select(F.explode(values).alias("v")).groupBy("v").count()
              .select("v.block", "v.value", "count").collect())  # 8 x 256 counts
    near = np.zeros((BLOCKS, 1 << width))
    for block, value, count in counts:
        near[block, value] = count
    return [([bit for b in group for bit in blocks[b]], t)
            for group, t in allocate([_near(h) for h in near], max(n, 1), distance)]


def links(nodes: DataFrame, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """(a, b) for nodes (fp): enough links of at most ``distance`` bits to connect all such pairs."""
    groups = plan(nodes, distance)
    keys = F.array(*[F.struct(F.lit(k).alias("g"), _gather(F.col("fp"), bits).alias("value"))
                     for k, (bits, _) in enumerate(groups)])
    stored = nodes.select("fp", F.explode(keys).alias("key"))
    reach = F.array(*[F.struct(F.lit(k).alias("g"), _gather(F.col("fp"), bits).alias("value"),
                               F.array(*[F.lit(m).cast("bigint") for m in ball(len(bits), t)])
                               .alias("masks")) for k, (bits, t) in enumerate(groups)])
    probes = (nodes.select("fp", F.explode(reach).alias("r"))
              .select("fp", "r.g", "r.value", F.explode("r.masks").alias("mask"))
              .select("fp", F.struct("g", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
                      .alias("key")))
    crowded = stored.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > dense)
    crowded = saved(crowded.select("key"), "crowded")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    if crowded.isEmpty():
        return (probes.withColumnRenamed("fp", "a").join(stored.withColumnRenamed("fp", "b"), "key")
                .where((F.col("a") > F.col("b")) & apart).select("a", "b"))
    sparse = stored.join(crowded, "key", "left_anti")
    pairs = (probes.withColumnRenamed("fp", "a").join(sparse.withColumnRenamed("fp", "b"), "key")
             .where((F.col("a") > F.col("b")) & apart).select("a", "b"))
    # Whoever is stored under a crowded key, or probes it, may have partners there.
    around = probes.join(crowded, "key", "left_semi").select("fp").distinct()
    near, far = ball(BITS, distance // 2), ball(BITS, distance - distance // 2)

    def points(masks: list[int]) -> DataFrame:
        return around.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))
                             .alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("p"))

    hubs = points(near).groupBy("p").agg(F.min("fp").alias("hub"))
    hung = points(far).join(hubs, "p").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return pairs.union(hung.where("a != b").distinct())


def _classes(docs: DataFrame, shingle: int, distance: int, dense: int
             ) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and (fp, root, least) of all fingerprints.

    ``least`` orders rows: those with a doc_id first, by doc_id, then by version.
    """
    marked = saved(fingerprints(docs, shingle), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")
    nodes = saved(marked.groupBy("fp").agg(F.min(row).alias("least")), "nodes")
    roots = components(links(nodes, distance, dense))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    return marked, saved(rooted, "rooted")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    dense: int = DENSE) -> DataFrame:
    """doc_id, fp and component_id: the least doc_id that links of ``distance`` bits reach."""
    marked, rooted = _classes(docs, shingle, distance, dense)
    least = rooted.groupBy("root").agg(F.min("least.doc_id").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(of, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                dense: int = DENSE) -> DataFrame:
    """``docs`` with one row of each component: the least doc_id, then the least hash of the text."""
    _, rooted = _classes(docs, shingle, distance, dense)
    stay = saved(rooted.groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.doc_id").alias("__id"), F.col("least.version").alias("__version")), "stay")
    version = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.withColumn("__v", version)
    same = rows["doc_id"].cast("bigint").eqNullSafe(stay["__id"]) & (
        rows["__v"] == stay["__version"])
    kept = rows.join(stay, same, "left_semi")
    # Repeated rows of one document are left: one of them stays.
    again = saved(kept.groupBy("doc_id", "__v").count().where("count > 1").drop("count"), "again")
    if again.isEmpty():
        return kept.drop("__v")
    twice = rows["doc_id"].eqNullSafe(again["doc_id"]) & (rows["__v"] == again["__v"])
    many = kept.join(again, twice, "left_semi")
    one = many.groupBy("doc_id", "__v").agg(F.any_value(F.struct(*docs.columns)).alias("__row"))
    return (kept.join(again, twice, "left_anti").drop("__v")
            .unionByName(one.select("__row.*")))


def hex16(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
