"""Left joins that survive a hot key.

Hot keys are found before the join.  They get a join of their own: on the side
that is hot, equal rows are counted and each count is shared out over salts; the rows of
those keys on the other side are repeated once per salt.  A key gets as many salts as its
rows need, so that no salt holds many more than ``min_rows``, but no more than ``SALTS`` for
each shuffle partition, as more would not spread its rows any further.  No row is lost and none is
doubled, and salts depend on nothing but the row, so a retried task makes the same ones.

Where a key is hot on both sides, equal rows of the other side meet the first as one row with a
count, and become rows again after the join.

A few hot keys are written into the plan as values; many are a table that both sides are marked
from.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType, StructType

from monthbook.session import written

#: Fewer rows than this are no burden for one task.
MIN_ROWS = 1_000_000
#: How many hot keys are written into a plan, and how many a sketch of frequent keys names.
TRACKED = 4096
#: A key with a smaller part of all rows than one in so many is never hot.
MOST_HOT = 1_000_000
#: Most salts of a key for each shuffle partition.
SALTS = 4
#: Most equal rows that one row with a count stands for.
PACK = 4096
#: The table of hot keys is broadcast up to this many bytes of keys.
BROADCAST_BYTES = 128 << 20


@dataclass(frozen=True)
class Look:
    """What one pass over the keys of a table found.

    ``hot`` holds the rows of each hot key; where there are more than ``TRACKED``, it is empty
    and ``many`` is a table of the keys and ``__n``, their rows.
    """

    rows: int
    without_key: int
    hot: Mapping[tuple, int]
    many: DataFrame | None = None

    def __bool__(self) -> bool:
        return bool(self.hot) or self.many is not None

    def split(self, df: DataFrame, keys: Sequence[str], min_rows: int
              ) -> tuple[DataFrame, DataFrame]:
        """The rows of all other keys, and those of hot keys with ``__salts``."""
        if self.many is None:
            hit = is_one_of(df, keys, list(self.hot))
            return df.where(~hit), df.where(hit).withColumn(
                "__salts", salts_of(df, keys, self.hot, min_rows))
        salts = F.least(F.greatest(F.lit(2), F.ceil(F.col("__n") / F.lit(min_rows))),
                        F.lit(most_salts(df))).cast("int")
        marked = df.join(self.many.select(*keys, salts.alias("__salts")), list(keys), "left")
        marked = marked.select(*df.columns, "__salts")
        return (marked.where(F.col("__salts").isNull()).drop("__salts"),
                marked.where(F.col("__salts").isNotNull()))


def look(df: DataFrame, keys: Sequence[str], min_rows: int = MIN_ROWS) -> Look:
    """Rows, rows with a NULL in their key, and the keys with at least ``min_rows`` rows.

    One aggregate gives both numbers and a bounded sketch of frequent keys.  The sketch errs by
    less than a 16,000th of the rows and names ``TRACKED`` keys, so it misses none with twice a
    ``TRACKED``-th of them.  If ``min_rows`` is less than that, all keys are counted, with partial
    counts in every task; else only the candidates, if there are any.
    """
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    hashed = df.select(*keys, F.when(~missing, F.xxhash64(*keys)).alias("__h"))
    found = hashed.agg(
        F.count(F.lit(1)).alias("n"), F.count("__h").alias("with_key"),
        F.expr(f"approx_top_k(__h, {TRACKED}, {8 * TRACKED})").alias("top")).first()
    sizes = found["n"], found["n"] - found["with_key"]
    if found["with_key"] // min_rows <= TRACKED // 2:
        often = [r["item"] for r in found["top"]
                 if r["item"] is not None and r["count"] >= min_rows]
        if not often:
            return Look(*sizes, {})
        return Look(*sizes, _values(_counts(hashed.where(F.col("__h").isin(often)), keys, min_rows),
                                    keys))
    least = max(min_rows, found["n"] // MOST_HOT)
    many = written(_counts(hashed.where(F.col("__h").isNotNull()), keys, least), "hot-keys")
    size = many.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(
        (F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(16))).alias("b")).first()
    if size["n"] <= TRACKED:
        return Look(*sizes, _values(many, keys))
    return Look(*sizes, {}, F.broadcast(many) if size["b"] <= BROADCAST_BYTES else many)


def _counts(rows: DataFrame, keys: Sequence[str], least: int) -> DataFrame:
    return (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") >= least))


def _values(counted: DataFrame, keys: Sequence[str]) -> dict[tuple, int]:
    return {tuple(r[k] for k in keys): r["__n"] for r in counted.collect()}  # TRACKED at most


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = MIN_ROWS) -> dict[tuple, int]:
    """Keys with at least ``min_rows`` rows, and how many they have; for up to ``TRACKED``."""
    return dict(look(df, keys, min_rows).hot)


def _packed(schema: StructType, keys: Sequence[str], value: tuple) -> Column:
    return F.struct(*[F.lit(v).cast(schema[k].dataType).alias(k) for k, v in zip(keys, value)])


def is_one_of(df: DataFrame, keys: Sequence[str], values: Sequence[tuple]) -> Column:
    """Whether the key of a row is among the given ones."""
    hit = F.struct(*[F.col(k) for k in keys]).isin(
        [_packed(df.schema, keys, value) for value in values])
    return F.coalesce(hit, F.lit(False))


def most_salts(df: DataFrame) -> int:
    """As many salts as can still spread the rows of a key over more tasks."""
    return max(2, SALTS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def salts_of(df: DataFrame, keys: Sequence[str], hot: Mapping[tuple, int],
             min_rows: int) -> Column:
    """How many salts the key of a row gets: enough for about ``min_rows`` rows each."""
    most = most_salts(df)
    pairs = [c for value, n in hot.items()
             for c in (_packed(df.schema, keys, value), F.lit(min(max(2, -(-n // min_rows)), most)))]
    return F.element_at(F.create_map(*pairs), F.struct(*[F.col(k) for k in keys]))


def level(keys: Sequence[str]) -> tuple[str, str]:
    """Names of the salt and the copies; a join inside a salted one gets its own."""
    return f"__salt{len(keys)}", f"__copies{len(keys)}"


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *,
              right_unique: bool = False, min_rows: int = MIN_ROWS) -> DataFrame:
    """``left`` with the columns of ``right``, every left row kept.

    ``right_unique`` says that no key repeats on the right; nothing is then looked up.
    A hot key does exist on the right, so its part is an inner join.
    """
    keys = list(keys)
    seen = None if right_unique else look(right, keys, min_rows)
    if not seen:
        return left.join(right, keys, "left")
    salt, copies = level(keys)
    payload = [c for c in right.columns if c not in keys]
    columns = [*left.columns, *payload]
    cold_left, mine = seen.split(left, keys, min_rows)
    cold_right, other = seen.split(right, keys, min_rows)
    cold = cold_left.join(cold_right, keys, "left")
    warm = repeat_rows(mine, salt).join(spread_rows(other, salt, copies), [*keys, salt])
    return cold.select(*columns).unionByName(each_copy(warm, columns, copies))


def repeat_rows(df: DataFrame, salt: str) -> DataFrame:
    """Every row once for each of its ``__salts``."""
    return df.select("*", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)).alias(salt)).drop(
        "__salts")


def spread_rows(df: DataFrame, salt: str, copies: str) -> DataFrame:
    """Rows shared out over their ``__salts``.

    ``n`` equal rows become up to ``salts`` rows that stand for ``n // salts`` copies, or
    one more.  The salts depend on nothing but the row.  Maps, which cannot be compared, are
    compared as sorted lists of their entries.
    """
    columns = [c for c in df.columns if c != "__salts"]
    counted, maps = _counted(df, [*columns, "__salts"])
    share = F.floor(F.col("__n") / F.col("__salts")) + F.when(
        F.col("__s") < F.col("__n") % F.col("__salts"), 1).otherwise(0)
    shared = F.least(F.col("__n"), F.col("__salts")).cast("int")  # the others get no row
    out = (counted.select("*", F.explode(F.sequence(F.lit(0), shared - 1)).alias("__s"))
           .select(*columns, share.alias(copies),
                   F.pmod(F.xxhash64(*columns) + F.col("__s"), F.col("__salts"))
                   .cast("int").alias(salt)))
    return out.withColumns({c: F.map_from_entries(c) for c in maps}) if maps else out


def _counted(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Different rows with ``__n``, how many there are; and which columns were maps."""
    maps = _maps(df)
    flat = df.withColumns({c: F.array_sort(F.map_entries(c)) for c in maps}) if maps else df
    return flat.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")), maps


def pack_rows(df: DataFrame, copies: str) -> DataFrame:
    """Equal rows as one row for each ``PACK`` of them, with their number."""
    counted, maps = _counted(df, df.columns)
    last = F.floor((F.col("__n") - 1) / F.lit(PACK)).cast("int")
    out = (counted.select("*", F.explode(F.sequence(F.lit(0), last)).alias("__s"))
           .select(*df.columns, F.least(F.lit(PACK), F.col("__n") - F.col("__s") * F.lit(PACK))
                   .cast("int").alias(copies)))
    return out.withColumns({c: F.map_from_entries(c) for c in maps}) if maps else out


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], salt: str, *,
                right_unique: bool = False, min_rows: int = MIN_ROWS) -> DataFrame:
    """``left``, shared out over ``salt``, with the rows of its hot keys on the right.

    The right rows have ``__salts``.  If a key has many different rows there, too, these are shared out
    over salts of their own.
    """
    if right_unique:
        return left.join(repeat_rows(right, salt), [*keys, salt], "left")
    inner, copies = level([*keys, salt])
    payload = [c for c in right.columns if c not in (*keys, "__salts")]
    columns = [*left.columns, *payload]
    packed = pack_rows(right.withColumnRenamed("__salts", "__outer"), copies)
    seen = look(packed, keys, min_rows)

    def repeated(rows: DataFrame) -> DataFrame:
        return repeat_rows(rows.withColumnRenamed("__outer", "__salts"), salt)

    if not seen:
        joined = left.join(repeated(packed), [*keys, salt], "left").select(*columns, copies)
    else:
        cold_left, mine = seen.split(left, keys, min_rows)
        cold_right, other = seen.split(packed, keys, min_rows)
        cold = cold_left.join(repeated(cold_right), [*keys, salt], "left")
        hashed = F.xxhash64(copies, *[c for c in payload if c not in _maps(right)])
        dealt = other.withColumn(inner, F.pmod(hashed, F.col("__salts")).cast("int")).drop("__salts")
        warm = repeat_rows(mine, inner).join(repeated(dealt), [*keys, salt, inner])
        joined = cold.select(*columns, copies).unionByName(warm.select(*columns, copies))
    return each_copy(joined.withColumn(copies, F.coalesce(copies, F.lit(1))), columns, copies)


def _maps(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, MapType)]


def each_copy(df: DataFrame, columns: Sequence[str], copies: str) -> DataFrame:
    """One row per copy again."""
    return df.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
                     .alias("__copy")).drop("__copy")
