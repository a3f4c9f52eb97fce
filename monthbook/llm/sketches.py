"""Document fingerprints: bottom-k sketches of word shingles.

A text is lower-cased and cut into words; a shingle is ``SHINGLE`` words (all words if there are
fewer) and is hashed to 48 bits.  The sketch of a text is the ``k`` least distinct hashes, sorted.
Sketches are mergeable: the sketch of two parts together is the ``k`` least of both sketches
(:func:`merge`, :func:`merge_all`), and a copy of a part changes nothing.  From two sketches follow
the resemblance, the containment and, from one, the number of distinct shingles; for texts with at
most ``k`` distinct shingles these are exact.

Everything is DataFrame functions: words, hashes and sketches are array expressions inside a row.

Defined results: null and empty texts (and texts without words) have an empty sketch; two empty
sketches resemble each other fully, an empty and another one not at all; repeated rows repeat their
sketch; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from monthbook.llm.common import doc_texts, partitions, read

SHINGLE = 5
K = 128
_TOP = float(1 << 48)


def words(text: Column) -> Column:
    """The lower-case words of a text; empty for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"),
                    lambda w: w != "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """A 48-bit hash of every shingle of a text.

    Words are hashed once; a shingle's hash is that of its words' hashes.
    """
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        last = F.greatest(F.size(h) - F.lit(size - 1), F.lit(1))
        return F.when(F.size(h) > 0, F.transform(F.sequence(F.lit(1), last), lambda i: (
            F.shiftrightunsigned(F.xxhash64(*[F.get(h, i + (k - 1)) for k in range(size)]),
                                 16)))).otherwise(F.array().cast("array<bigint>"))
    # Bound to a name by an outer transform, the array of word hashes is made once per text.
    return F.transform(F.array(hashed), windows)[0]


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    """The bottom-k sketch of a text: its ``k`` least distinct shingle hashes, ascending."""
    return F.slice(F.array_distinct(F.sort_array(shingle_hashes(text, size))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(parts: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group from the sketches of its parts.

    Each task passes on the ``k`` least distinct hashes of a group at most, so a group of any
    size is no burden.  A group without any hash keeps an empty sketch.
    """
    hashes = parts.select(*by, F.explode_outer(column).alias("__h")).distinct()
    rank = Window.partitionBy(*by).orderBy(F.col("__h").asc_nulls_last())
    least = hashes.withColumn("__r", F.row_number().over(rank)).where(F.col("__r") <= k)
    return least.groupBy(*by).agg(F.sort_array(F.collect_list("__h")).alias(column))


def distinct_shingles(s: Column, k: int = K) -> Column:
    """The number of distinct shingles: exact below ``k``, else (k - 1) / the k-th least share."""
    kth = (F.element_at(s, -1) + 1) / F.lit(_TOP)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / kth)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Shared part of the shingles of both texts, from 0 to 1."""
    both = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
            .when(F.size(both) == 0, 0.0).otherwise(shared / F.size(both)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The part of a's shingles that b has too, from 0 to 1.

    From the resemblance r and the numbers of shingles: r / (1 + r) * (|a| + |b|) / |a|.
    """
    r = resemblance(a, b, k)
    na, nb = distinct_shingles(a, k), distinct_shingles(b, k)
    return (F.when(F.size(a) == 0, 1.0)
            .otherwise(F.least(F.lit(1.0), r / (1 + r) * (na + nb) / na)))


def as_text(s: Column) -> Column:
    """A sketch as a string: 12 hex digits per hash."""
    return F.lower(F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 12, "0")), ""))


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, sketch and n_shingles (distinct, estimated) of every document."""
    made = doc_texts(docs).select("doc_id", sketch(F.col("text"), k).alias("sketch"))
    return made.withColumn("n_shingles", distinct_shingles(F.col("sketch"), k))


def in_ranges(texts: DataFrame) -> DataFrame:
    """``texts`` with ``part``: even ranges of doc_id, in order; -1 for a null doc_id."""
    n = 4 * partitions(texts.sparkSession)  # several ranges a task, so that tasks come out even
    bounds = texts.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.1 / n) if n > 1 else []
    edges = [float("-inf"), *sorted(set(bounds)), float("inf")]
    if len(edges) < 3:
        return texts.withColumn("part", F.when(F.col("doc_id").isNull(), -1).otherwise(0))
    ranged = texts.withColumn("__at", F.coalesce(F.col("doc_id"), F.lit(0)).cast("double"))
    ranged = Bucketizer(splits=edges, inputCol="__at", outputCol="part").transform(ranged)
    return ranged.withColumn("part", F.when(F.col("doc_id").isNull(), -1).otherwise(
        F.col("part").cast("int"))).drop("__at")


def with_next(texts: DataFrame, also: dict[str, Column]) -> DataFrame:
    """doc_id, text, next_text: the text of the next doc_id; the last one's next is the first.

    ``also`` names expressions over ``text`` that are made once per row, and whose value at the
    next row comes along as ``next_...``.  Rows are cut into ranges of doc_id; the text breaks
    ties.  Inside a range the next row is the next of a window, and the first row of each range is
    also handed to the range before it, so every text is shuffled once.
    """
    placed = in_ranges(texts)
    order = Window.orderBy("part")  # one row per range
    firsts = placed.groupBy("part").agg(F.min("doc_id").alias("first"))
    heads = firsts.select("part", "first", F.coalesce(
        F.lag("part").over(order), F.max("part").over(Window.partitionBy())).alias("to"))
    # Broadcast: one row per range, so four times the shuffle partitions at most.
    copies = (placed.alias("p").join(F.broadcast(heads.alias("h")), F.expr(
        "p.part = h.part AND p.doc_id <=> h.first"))
        .groupBy(F.col("h.to").alias("part")).agg(F.min("p.text").alias("text")))
    both = placed.select("part", "doc_id", "text", F.lit(False).alias("copy")).unionByName(
        copies.select("part", F.lit(None).cast("bigint").alias("doc_id"), "text",
                      F.lit(True).alias("copy")))
    made = both.select("*", *[c.alias(name) for name, c in also.items()])
    ahead = Window.partitionBy("part").orderBy("copy", "doc_id", "text")
    nexts = [F.lead(c).over(ahead).alias(f"next_{c}") for c in ("text", *also)]
    return (made.select("copy", "doc_id", "text", *also, *nexts).where("NOT copy").drop("copy"))


def fingerprint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all texts and of their edited texts, and how near they are to each other.

    Edited: the last half of a text (rounded down, in code points) is replaced by as much of the
    beginning of the next document.
    """
    docs = doc_texts(read(spark, sf_dir, "documents"))
    half = F.floor(F.length("text") / 2).cast("int")
    near = with_next(docs, {"sketch": sketch(F.col("text"))}).select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), "sketch", "next_sketch",
        F.concat(F.substring("text", F.lit(1), F.length("text") - half),
                 F.substring("next_text", F.lit(1), half)).alias("edited"))
    made = near.select("doc_id", "n_chars", "sketch", "next_sketch",
                       F.sha2("edited", 256).alias("edited_sha256"),
                       sketch(F.col("edited")).alias("edited_sketch"))
    own = F.col("sketch")
    return made.select(
        "doc_id", "n_chars", "edited_sha256", as_text(own).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(own, F.col("edited_sketch")).alias("near_edited"),
        resemblance(own, F.col("next_sketch")).alias("near_next"),
        distinct_shingles(own).alias("n_shingles"),
        containment(own, F.col("edited_sketch")).alias("kept_part"))
