"""Exact ranks, running sums and quantiles without a one-task window.

Rows are reduced to one row per distinct value.  The values are cut into buckets at
approximate quantiles of all rows (a few numbers, found in one pass without a shuffle and
then fixed, so a retried task sees the same cut).  Running sums inside a bucket plus the
totals of the buckets before it are the exact running sums.  Between two cuts lie about
``1 / buckets`` of all rows, so no bucket has more distinct values than that, not even
inside one hot group; a hot value is a single row by then.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import NumericType

_BUCKET = "__bucket"


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as shuffle partitions: those follow the cluster and its data."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def cut_points(df: DataFrame, column: str, buckets: int | None = None) -> list[float]:
    """Up to ``buckets - 1`` increasing cuts, each an existing value of ``column``."""
    buckets = buckets or bucket_count(df.sparkSession)
    probs = [i / buckets for i in range(1, buckets)]
    return sorted(set(df.approxQuantile(column, probs, 1.0 / (4 * buckets))))


def with_bucket(df: DataFrame, value: str, cuts: Sequence[float], name: str) -> DataFrame:
    """Adds the bucket of a double column: 0 below the first cut, 1 from there on, ..."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [float("-inf"), *map(float, cuts), float("inf")]
    cut = Bucketizer(splits=splits, inputCol=value, outputCol=name).transform(df)
    return cut.withColumn(name, F.col(name).cast("int"))


def running_sums(df: DataFrame, value: str, sums: Mapping[str, str],
                 by: Sequence[str] = (), cuts: Sequence[float] | None = None) -> DataFrame:
    """Adds, per group, running sums in increasing order of ``value``.

    ``df`` has one row per (group, value), ``value`` is numeric and not NULL.  ``sums``
    maps new columns to the summed ones.  Each new column includes the row itself, and
    ``{new}_total`` is the total of the group.  ``cuts`` are those of the rows that ``df``
    was reduced from; without them they are looked up in ``df``.
    """
    by = list(by)
    keyed = df.withColumn("__at", F.col(value).cast("double"))
    if cuts is None:
        cuts = cut_points(keyed, "__at")
    cut = with_bucket(keyed, "__at", cuts, _BUCKET)

    inside = (Window.partitionBy(*by, _BUCKET).orderBy(value)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = cut.select("*", *[F.sum(c).over(inside).alias(new) for new, c in sums.items()])

    # One row per (group, bucket): this window holds no more rows than there are cuts.
    before = (Window.partitionBy(*by).orderBy(_BUCKET)
              .rowsBetween(Window.unboundedPreceding, -1))
    totals = cut.groupBy(*by, _BUCKET).agg(
        *[F.sum(c).alias(f"{new}_total") for new, c in sums.items()])
    offsets = totals.select(
        *[F.col(c).alias(f"__{c}") for c in [*by, _BUCKET]],
        *[F.coalesce(F.sum(f"{n}_total").over(before), F.lit(0)).alias(f"{n}_before")
          for n in sums],
        *[F.sum(f"{n}_total").over(Window.partitionBy(*by)).alias(f"{n}_total")
          for n in sums])
    if not by:
        offsets = F.broadcast(offsets)  # one row per cut, and one more
    same = [rows[c].eqNullSafe(offsets[f"__{c}"]) for c in by]
    joined = rows.join(offsets, [rows[_BUCKET] == offsets[f"__{_BUCKET}"], *same])
    return joined.select(
        *df.columns,
        *[(F.col(n) + F.col(f"{n}_before")).alias(n) for n in sums],
        *[F.col(f"{n}_total") for n in sums])


def quantiles(df: DataFrame, value: str, probs: Sequence[float],
              by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: columns ``q0, q1, ...`` per group."""
    by = list(by)
    rows = (df.select(*by, F.col(value).cast("double").alias("__v"))
            .where(F.col("__v").isNotNull()))
    counted = rows.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_sums(counted, "__v", {"__upto": "__n"}, by,
                          cut_points(rows, "__v", buckets))
    total = F.col("__upto_total")
    first, last = F.col("__upto") - F.col("__n"), F.col("__upto") - 1
    picked, made = [], []
    for i, p in enumerate(probs):
        position = (total - 1) * F.lit(float(p))
        low, high = F.floor(position), F.ceil(position)
        for tag, rank in (("lo", low), ("hi", high)):
            hit = F.when((first <= rank) & (rank <= last), F.col("__v"))
            picked.append(F.max(hit).alias(f"__{tag}{i}"))
        picked.append(F.max(position - low).alias(f"__part{i}"))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        made.append((lo + (hi - lo) * F.col(f"__part{i}")).alias(f"q{i}"))
    return ranked.groupBy(*by).agg(*picked).select(*by, *made)


def quantile_values(df: DataFrame, value: str, probs: Sequence[float]) -> list[float]:
    """Exact quantiles of a whole column as plain numbers."""
    row = quantiles(df, value, probs).first()
    return list(row) if row is not None else [None] * len(probs)


def row_index(df: DataFrame, time: str, tie: str, name: str = "row_index",
              buckets: int | None = None) -> DataFrame:
    """Adds the 0-based position of each row in the order of (``time``, ``tie``).

    ``tie`` is a numeric id, unique within one ``time``.  A moment that holds many rows is
    cut again by ``tie``, so one hot moment does not end in one task.  Rows without a time
    are kept; their position is NULL and they move no other row.
    """
    timeless = df.where(F.col(time).isNull()).withColumn(name, F.lit(None).cast("bigint"))
    df = df.where(F.col(time).isNotNull())
    buckets = buckets or bucket_count(df.sparkSession)
    at = F.col(time)
    if not isinstance(df.schema[time].dataType, NumericType):
        at = F.unix_micros(at.cast("timestamp"))
    keyed = df.select("*", at.cast("double").alias("__t"),
                      F.col(tie).cast("double").alias("__id"))
    probs = [i / buckets for i in range(1, buckets)]
    at_time, at_tie = keyed.approxQuantile(["__t", "__id"], probs, 1.0 / (4 * buckets))
    # A moment met by two cuts in a row is hot.  It comes first in its bucket.
    hot = sorted({a for a, b in zip(at_time, at_time[1:]) if a == b})
    is_hot = F.col("__t").isin(hot) if hot else F.lit(False)
    cut = with_bucket(keyed, "__t", sorted(set(at_time)), "__b0")
    if hot:
        cut = with_bucket(cut, "__id", sorted(set(at_tie)), "__b2")
    else:
        cut = cut.withColumn("__b2", F.lit(0))
    cut = (cut.withColumn("__b1", F.when(is_hot, 0).otherwise(1))
           .withColumn("__b2", F.when(is_hot, F.col("__b2")).otherwise(0)))
    names = ["__b0", "__b1", "__b2"]
    inside = Window.partitionBy(*names).orderBy("__t", tie)
    rows = cut.select("*", F.row_number().over(inside).alias("__pos"))
    # The number of buckets is bounded by the cuts, not by the data.
    before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows"))
               .select(*[F.col(c).alias(f"_{c}") for c in names],
                       F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before")))
    joined = rows.join(offsets if hot else F.broadcast(offsets),
                       [rows[c] == offsets[f"_{c}"] for c in names])
    return joined.select(
        *df.columns, (F.col("__pos") - 1 + F.col("__before")).alias(name)).unionByName(timeless)
