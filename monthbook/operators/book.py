"""Feature books: one row per customer, conditional aggregates over trailing month windows.

All windows end at the reference month, so they are nested and one filtered scan serves
them all.  Up to about a hundred features a book is one ``groupBy(key).agg(...)``.  Wider
aggregates fall out of generated code and shuffle wide partial rows, so they are made in two
steps, and so are exact distinct counts in several windows:

1. a rollup to one row per (key, month) with the few parts every feature is made of: sums,
   counts, extremes, centred squares, hits of counted values.  Partial aggregates reduce
   each task's rows before a shuffle, so a hot customer costs no more than any other;
2. the windows, over at most as many rows per key as the widest window has months.  The
   several hundred feature columns only exist here, after the last shuffle.

Distinct counts would make Spark copy every row once per (column, window).  Instead a row becomes
one item that carries its measures and one item per column value, and a single aggregate reduces
both: measures to their parts, values to the smallest window in which each (key, column, value) was
seen.  The source is read once, and the number of values per (key, window) is a count of items.

Sketches (``approx_distinct``, ``approx_median``) are parts as well: HyperLogLog and KLL sketches
per month, merged per window.

Features that cannot be put together from months (your own factories, skewness) are
aggregated straight from the rows, with the same results.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType

from monthbook.functions.months import month_literal, window_start
from monthbook.functions.scalars import safe_divide
from monthbook.functions.text import feature_name, normalize_text

#: ``f(in_window, months) -> [aliased aggregate columns]``
ExtraFeatures = Callable[[Column, int], Sequence[Column]]

_WHICH = "__which"


@dataclass(frozen=True)
class BookSpec:
    """What a book holds.

    ``ratios`` maps a numerator to one or several denominators.  ``value_counts`` maps a
    column to the values to count.  ``where`` is an extra row filter (SQL text or Column).
    ``extra`` holds feature factories of your own.
    """

    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    windows: Sequence[int] = (1, 3, 6, 12)
    aggregations: Sequence[str] = ("sum", "avg", "max", "min", "count")
    ratios: Mapping[str, str | Sequence[str]] = field(default_factory=dict)
    value_counts: Mapping[str, Sequence[str]] = field(default_factory=dict)
    where: str | Column | None = None
    extra: Sequence[ExtraFeatures] = ()
    key: str = "cpf"
    month: str = "anomes"
    #: Distinct counts from HyperLogLog sketches of ``2 ** DISTINCT_BITS`` registers.
    approx_distinct: bool = False
    stamp_time: bool = True
    #: Whether to roll rows up by month first; by default for wide books and for distinct counts.
    by_month: bool | None = None


def _avg(v: Column) -> Column:
    # Sum and count are shared with the other features of the window.
    return safe_divide(F.sum(v), F.count(v))


#: Size of the sketches: a relative error of about 1.6 % of a distinct count (one deviation) and of
#: about 0.7 % of the rank of a median (99 of 100 times).
DISTINCT_BITS = 12
MEDIAN_K = 400


def _distinct_sketch(v: Column) -> Column:
    return F.hll_sketch_agg(v.cast("string"), DISTINCT_BITS)


def _median_sketch(v: Column) -> Column:
    return F.kll_sketch_agg_double(v.cast("double"), MEDIAN_K)


def _sketch_median(sketch: Column, count: Column) -> Column:
    return F.when(count > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(0.5)))


#: Aggregates by name; each gets the value inside the window and NULL outside.
#: ``sum`` is handled apart because it gives 0 outside.
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "avg": _avg,
    "max": F.max,
    "min": F.min,
    "count": F.count,
    "std": lambda v: F.stddev_samp(v.cast("double")),
    "stddev": lambda v: F.stddev_samp(v.cast("double")),
    "stddev_pop": lambda v: F.stddev_pop(v.cast("double")),
    "variance": lambda v: F.var_samp(v.cast("double")),
    "var_samp": lambda v: F.var_samp(v.cast("double")),
    "var_pop": lambda v: F.var_pop(v.cast("double")),
    "skewness": lambda v: F.skewness(v.cast("double")),
    "kurtosis": lambda v: F.kurtosis(v.cast("double")),
    "approx_count_distinct": F.approx_count_distinct,
    "approx_median": lambda v: _sketch_median(_median_sketch(v), F.count(v)),
    "bool_and": F.bool_and,
    "bool_or": F.bool_or,
}


def check_aggregations(names: Sequence[str], also: Sequence[str] = ()) -> None:
    """Raise ``ValueError`` for an aggregate this toolkit does not know."""
    unknown = [n for n in names if n not in ("sum", *AGGREGATES, *also)]
    if unknown:
        raise ValueError(f"unknown aggregations: {unknown}")


def _denominators(value: str | Sequence[str]) -> Sequence[str]:
    return [value] if isinstance(value, str) else value


def cross_ratios(nums: Sequence[str], dens: Sequence[str]) -> dict[str, list[str]]:
    """Every numerator over every denominator, in the form :class:`BookSpec` takes."""
    return {n: list(dens) for n in nums}


def windowed_rows(df: DataFrame, spec: BookSpec, ref: str) -> DataFrame:
    """Rows of the widest window that pass the extra filter."""
    dtype = df.schema[spec.month].dataType
    first = month_literal(window_start(ref, max(spec.windows)), dtype)
    rows = df.where(F.col(spec.month).between(first, month_literal(ref, dtype)))
    if spec.where is not None:
        rows = rows.where(F.expr(spec.where) if isinstance(spec.where, str) else spec.where)
    return rows


@dataclass(frozen=True)
class _Window:
    """One trailing window over rows already cut to the widest one."""

    months: int
    inside: Column
    is_widest: bool

    def value(self, v: Column) -> Column:
        """``v`` inside the window, NULL outside."""
        return v if self.is_widest else F.when(self.inside, v)


def _windows(df: DataFrame, spec: BookSpec, ref: str) -> list[_Window]:
    dtype = df.schema[spec.month].dataType
    widest = max(spec.windows)
    made = []
    for n in spec.windows:
        start = month_literal(window_start(ref, n), dtype)
        inside = F.lit(True) if n == widest else F.col(spec.month) >= start
        made.append(_Window(n, inside, n == widest))
    return made


def _numeric(spec: BookSpec, windows: list[_Window], zero_sum: bool = True,
             prefix: str | None = None) -> list[Column]:
    """Aggregates of the numeric columns; ``prefix`` gives the names of a break book."""
    def name(var: str, agg: str, n: int) -> str:
        return feature_name(var, agg, n) if prefix is None else f"{prefix}_{var}_{agg}_{n}m"

    out = []
    for var in spec.numeric:
        for w in windows:
            for agg in spec.aggregations:
                if agg == "median":
                    continue  # joined on later, see _medians
                if agg != "sum":
                    made = AGGREGATES[agg](w.value(F.col(var)))
                elif zero_sum:
                    made = F.sum(F.when(w.inside, F.col(var)).otherwise(0))
                else:
                    made = F.sum(w.value(F.col(var)))
                out.append(made.alias(name(var, agg, w.months)))
    return out


def _categorical(spec: BookSpec, windows: list[_Window]) -> list[Column]:
    """Counts of the categorical columns, and their distinct counts if sketches will do."""
    out = []
    for var in spec.categorical:
        for w in windows:
            inside = w.value(F.col(var))
            if spec.approx_distinct:
                out.append(F.hll_sketch_estimate(_distinct_sketch(inside))
                           .alias(feature_name(var, "nunique", w.months)))
            out.append(F.count(inside).alias(feature_name(var, "count", w.months)))
    return out


def _value_features(spec: BookSpec, windows: list[_Window], flag: bool) -> list[Column]:
    out = []
    for var, values in spec.value_counts.items():
        for value in values:
            stem = f"{normalize_text(var)}_{normalize_text(value)}"
            for w in windows:
                hit = F.when(w.inside & (F.col(var) == F.lit(value)), 1).otherwise(0)
                rows = F.count(F.when(w.inside, 1))
                out.append(F.sum(hit).alias(f"{stem}_count_{w.months}m"))
                out.append(safe_divide(F.sum(hit) * 100.0, rows)
                           .alias(f"{stem}_pct_{w.months}m"))
                if flag:
                    out.append(F.max(hit).alias(f"{stem}_flag_{w.months}m"))
    return out


def _ratios(spec: BookSpec, windows: list[_Window]) -> list[Column]:
    out = []
    for num, dens in spec.ratios.items():
        for den in _denominators(dens):
            stem = f"ratio_{normalize_text(num)}_{normalize_text(den)}"
            for w in windows:
                ratio = safe_divide(F.sum(w.value(F.col(num))), F.sum(w.value(F.col(den))))
                out.append(ratio.alias(f"{stem}_{w.months}m"))
    return out


def _items(rows: DataFrame, spec: BookSpec, windows: list[_Window]) -> DataFrame:
    """Every row as items: number -1 is the row itself, number i the value of categorical column i.

    Value items hold the smallest window the row is in (``__w``) and NULL in all other columns, so
    they touch no feature.  A whole number stands for the window because rows are reduced to the
    least one, which text could not do in a hash aggregate.
    """
    return _exploded(rows, spec, _smallest(windows))


def _smallest(windows: list[_Window]) -> Column:
    """The number of the smallest window a row is in."""
    by_size = sorted(windows, key=lambda w: w.months)
    smallest = F.lit(len(by_size) - 1)
    for i in reversed(range(len(by_size) - 1)):
        smallest = F.when(by_size[i].inside, i).otherwise(smallest)
    return smallest


def _exploded(rows: DataFrame, spec: BookSpec, mark: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The items of all rows; value items have only the key, the columns ``keep`` and their mark.

    A row becomes several items, so what a task may read without harm can be too much once it is
    items: the rows are dealt out first, over all shuffle partitions.  Rows of a key that lie together
    stay together, and a hot key is spread as widely as it was.
    """
    rows = rows.repartition(_tasks(rows), F.col(spec.key), F.spark_partition_id())
    numbers = F.array(*[F.lit(i) for i in range(-1, len(spec.categorical))])
    which = F.col(_WHICH)
    value = F.lit(None).cast("string")
    for i, c in enumerate(spec.categorical):
        value = F.when(which == i, F.col(f"`{c}`").cast("string")).otherwise(value)
    return (rows.select("*", F.explode(numbers).alias(_WHICH))
            .select(spec.key, _WHICH, value.alias("__value"), F.when(which >= 0, mark).alias("__w"),
                    *[(F.col(f"`{c}`") if c in keep else F.when(which < 0, F.col(f"`{c}`"))).alias(c)
                      for c in rows.columns if c != spec.key])
            .where((which < 0) | F.col("__value").isNotNull()))


def _tasks(df: DataFrame) -> int:
    """The cluster's number of shuffle partitions; a number that is asked for is not cut down again."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _starts(windows: list[_Window], ref: str, dtype: DataType) -> Column:
    """The first month of the window that ``__w`` numbers."""
    sizes = sorted(w.months for w in windows)
    return F.element_at(F.array(*[month_literal(window_start(ref, n), dtype) for n in sizes]),
                        F.col("__w") + 1)


def _stamps(spec: BookSpec, ref: str) -> list[Column]:
    stamps = [F.lit(ref).alias("dt_referencia")]
    if spec.stamp_time:
        stamps.append(F.current_timestamp().alias("dt_processamento"))
    return stamps


def _medians(rows: DataFrame, spec: BookSpec, windows: list[_Window]) -> DataFrame:
    """Exact medians per key, one row per key.

    Values are counted once per (key, column, value), with one count per window: the windows
    are nested, so no row is copied for them.  Ranks come from bucketed running counts, so the
    values of one key are never held together in one task.
    """
    from monthbook.operators.ranks import cut_points, running_sums

    cells = [F.struct(F.lit(i).alias("__which"), F.col(v).cast("double").alias("__value"))
             for i, v in enumerate(spec.numeric)]
    long = (rows.select(spec.key, spec.month, F.inline(F.array(*cells)))
            .where(F.col("__value").isNotNull()))
    counted = long.groupBy(spec.key, "__which", "__value").agg(
        *[F.count(F.when(w.inside, 1)).alias(f"__n{w.months}") for w in windows])
    ranked = running_sums(counted, "__value", {f"__u{w.months}": f"__n{w.months}" for w in windows},
                          [spec.key, "__which"], cut_points(long, "__value"))
    picked, made = [], []
    for i, v in enumerate(spec.numeric):
        for w in windows:
            upto, n = F.col(f"__u{w.months}"), F.col(f"__n{w.months}")
            middle = (F.col(f"__u{w.months}_total") - 1) / 2
            ends = []
            for rank in (F.floor(middle), F.ceil(middle)):
                name = f"__p{len(picked)}"
                hit = (F.col("__which") == i) & (upto - n <= rank) & (rank < upto)
                picked.append(F.max(F.when(hit, F.col("__value"))).alias(name))
                ends.append(F.col(name))
            made.append(((ends[0] + ends[1]) / 2).alias(feature_name(v, "median", w.months)))
    return ranked.groupBy(spec.key).agg(*picked).select(spec.key, *made)


def feature_book(df: DataFrame, spec: BookSpec, ref: str, flags: bool = False) -> DataFrame:
    """One row per key with every feature of ``spec`` as of month ``ref``."""
    check_aggregations(spec.aggregations, also=("median",))
    rows = windowed_rows(df, spec, ref)
    windows = _windows(df, spec, ref)
    pieces = (len(spec.numeric) * len(spec.aggregations) + 2 * len(spec.categorical)
              + sum((3 if flags else 2) * len(v) for v in spec.value_counts.values())
              + sum(len(_denominators(d)) for d in spec.ratios.values()))
    if not spec.extra and _use_months(spec, pieces * len(windows)):
        book = _book_from_months(rows, spec, windows, flags, ref)
    else:
        book = _book_from_rows(rows, spec, windows, flags, ref)
    if "median" in spec.aggregations:
        medians = _medians(rows, spec, windows).withColumnRenamed(spec.key, "__key")
        same = F.col(spec.key).eqNullSafe(F.col("__key"))
        book = book.join(medians, same, "left").drop("__key")
    made = [F.col(c) for c in book.columns if c != spec.key]
    return book.select(spec.key, *_stamps(spec, ref), *made)


#: Widest aggregate made straight from the rows; the default limit of generated code.
WIDE = 100


def _use_months(spec: BookSpec, width: int) -> bool:
    """Whether a book of ``width`` features should be, and can be, made from months."""
    # A value's item has room for all that is summed up: parts take less than features per window.
    costly = _counts_values(spec) and len(spec.windows) > 1
    wanted = spec.by_month if spec.by_month is not None else width > WIDE or costly
    return wanted and set(spec.aggregations) <= {*_FROM_MONTHS, "median"}


def _book_from_rows(rows: DataFrame, spec: BookSpec, windows: list[_Window],
                    flags: bool, ref: str) -> DataFrame:
    """All features in one aggregate over the rows themselves."""
    features = [*_numeric(spec, windows), *_categorical(spec, windows),
                *_value_features(spec, windows, flags), *_ratios(spec, windows)]
    for factory in spec.extra:
        for w in windows:
            features += factory(w.inside, w.months)
    if not features:
        return rows.select(spec.key).distinct()
    if not spec.categorical or spec.approx_distinct:
        return rows.groupBy(spec.key).agg(*features)
    # One row per key with the features of its rows, and one per value; then both are one row.
    made = _items(rows, spec, windows).groupBy(spec.key, _WHICH, "__value").agg(
        *features, F.min("__w").alias("__w"))
    names = [c for c in made.columns if c not in (spec.key, _WHICH, "__value", "__w")]
    whole = [F.first(F.when(F.col(_WHICH) < 0, F.col(f"`{c}`")), ignorenulls=True).alias(c)
             for c in names]
    by_size = sorted(w.months for w in windows)
    distinct = [F.count_if((F.col(_WHICH) == i) & (F.col("__w") <= by_size.index(w.months)))
                .alias(feature_name(v, "nunique", w.months))
                for i, v in enumerate(spec.categorical) for w in windows]
    book = made.groupBy(spec.key).agg(*whole, *distinct)
    return book.select(spec.key, *_book_order(spec, windows, names))


def _book_order(spec: BookSpec, windows: list[_Window], names: Sequence[str]) -> list[Column]:
    """Columns of a book in their usual order: distinct counts stand before the counts."""
    before = {feature_name(v, "count", w.months): feature_name(v, "nunique", w.months)
              for v in spec.categorical for w in windows}
    out = []
    for name in names:
        if name in before:
            out.append(F.col(f"`{before.pop(name)}`"))
        out.append(F.col(f"`{name}`"))
    return out


# --- from monthly parts -----------------------------------------------------------------

_SPREADS = {"std": (1, True), "stddev": (1, True), "variance": (1, False),
            "var_samp": (1, False), "stddev_pop": (0, True), "var_pop": (0, False)}
_FROM_MONTHS = ("sum", "avg", "max", "min", "count", "approx_median", *_SPREADS)


class _Parts:
    """Monthly parts, each made once however many features ask for it."""

    def __init__(self) -> None:
        self.made: dict[tuple, Column] = {}
        self.names: dict[tuple, Column] = {}
        self.columns: list[str] = []

    def __call__(self, kind: str, what: object, make: Callable[[], Column]) -> Column:
        if (kind, what) not in self.made:
            # A name that files and catalogues take, and that stays when other features come.
            name = f"__{kind}_{re.sub(r'[^A-Za-z0-9]+', '_', str(what))}"
            if name != f"__{kind}_{what}":
                name += f"_{zlib.crc32(str(what).encode()):08x}"
            self.columns.append(name)
            self.made[kind, what] = make().alias(name)
            self.names[kind, what] = F.col(f"`{name}`")
        return self.names[kind, what]

    def sum(self, v: str) -> Column:
        return self("s", v, lambda: F.sum(v))

    def count(self, v: str) -> Column:
        return self("n", v, lambda: F.count(v))

    def low(self, v: str) -> Column:
        return self("lo", v, lambda: F.min(v))

    def high(self, v: str) -> Column:
        return self("hi", v, lambda: F.max(v))

    def squares(self, v: str) -> Column:
        """Squared distances from the mean of the month."""
        return self("m2", v, lambda: F.var_pop(F.col(v).cast("double")) * F.count(v))

    def mean(self, v: str) -> Column:
        return self("mean", v, lambda: F.avg(F.col(v).cast("double")))

    def rows(self) -> Column:
        return self("rows", "", lambda: F.count(F.lit(1)))

    def distinct(self, v: str) -> Column:
        return self("hll", v, lambda: _distinct_sketch(F.col(v)))

    def ranks(self, v: str) -> Column:
        return self("kll", v, lambda: _median_sketch(F.col(v)))

    def hits(self, v: str, value: object) -> Column:
        return self("hit", f"{v}={value}", lambda: F.count_if(F.col(v) == F.lit(value)))


def _total(w: _Window, part: Column) -> Column:
    """Sum of a count over the months of a window, 0 if there are none."""
    return F.sum(F.when(w.inside, part).otherwise(0))


def _sum_types(rows: DataFrame, numeric: Sequence[str]) -> dict[str, DataType]:
    """The type of each column's sum over rows."""
    if not numeric:
        return {}
    plain = rows.select(*[F.sum(F.when(F.lit(True), F.col(v)).otherwise(0)).alias(f"s{i}")
                          for i, v in enumerate(numeric)])
    return {v: plain.schema[f"s{i}"].dataType for i, v in enumerate(numeric)}


class _Rollup:
    """Numeric features put together from monthly parts; ``group`` are the keys of the book."""

    def __init__(self, group: Sequence[str], sums: Mapping[str, DataType]) -> None:
        self.parts = _Parts()
        self.centres: dict[tuple, Column] = {}
        self.group = list(group)
        # A sum of monthly sums has the type of a sum of rows, whatever the width of the book.
        self.sums = sums

    def feature(self, v: str, agg: str, w: _Window, zero_sum: bool = True) -> Column:
        parts = self.parts
        if agg == "sum":
            part = parts.sum(v)
            total = F.sum(F.when(w.inside, part).otherwise(0) if zero_sum else w.value(part))
            return total.cast(self.sums[v]) if v in self.sums else total
        if agg == "avg":
            return safe_divide(F.sum(w.value(parts.sum(v))), _total(w, parts.count(v)))
        if agg == "count":
            return _total(w, parts.count(v))
        if agg == "max":
            return F.max(w.value(parts.high(v)))
        if agg == "min":
            return F.min(w.value(parts.low(v)))
        if agg == "approx_median":
            merged = F.kll_merge_agg_double(w.value(parts.ranks(v)), MEDIAN_K)
            return _sketch_median(merged, _total(w, parts.count(v)))
        less, root = _SPREADS[agg]
        # Two passes over the months of a key: the mean of the window, then the distances.
        n, mean = parts.count(v), parts.mean(v)
        total, key = _total(w, n), (v, w.months)
        if key not in self.centres:
            over = Window.partitionBy(*self.group)
            known = F.when(mean.isNotNull(), n)
            self.centres[key] = safe_divide(F.sum(w.value(n * mean)).over(over),
                                            F.sum(w.value(known)).over(over))
        away = mean - F.col(f"__centre_{list(self.centres).index(key)}")
        squares = F.sum(w.value(parts.squares(v) + n * away * away))
        value = F.when(total > less, squares / (total - less))
        return F.sqrt(value) if root else value

    def monthly(self, rows: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
        """The parts per key and month."""
        return rows.groupBy(*keys).agg(
            *(self.parts.made.values() or [F.lit(1).alias("__any")]), *more)

    def finish(self, monthly: DataFrame, features: Sequence[Column]) -> DataFrame:
        """The features of each group; its few rows are moved as they are, once."""
        local = monthly.repartition(*[F.col(c) for c in self.group])
        if self.centres:
            local = local.select("*", *[c.alias(f"__centre_{i}")
                                        for i, c in enumerate(self.centres.values())])
        return local.groupBy(*self.group).agg(*features)


def _book_from_months(rows: DataFrame, spec: BookSpec, windows: list[_Window],
                      flags: bool, ref: str) -> DataFrame:
    rollup = _Rollup([spec.key], _sum_types(rows, spec.numeric))
    features = _month_features(rollup, spec, windows, flags)
    if not features:
        return rows.select(spec.key).distinct()
    if not _counts_values(spec):
        return rollup.finish(rollup.monthly(rows, [spec.key, spec.month]), features)
    reduced = rollup.monthly(_items(rows, spec, windows), [spec.key, spec.month, _WHICH, "__value"],
                             F.min("__w").alias("__w"))
    return _finish_items(rollup, reduced, spec, windows, features, ref)


def _counts_values(spec: BookSpec) -> bool:
    return bool(spec.categorical) and not spec.approx_distinct


def _finish_items(rollup: _Rollup, reduced: DataFrame, spec: BookSpec, windows: list[_Window],
                  features: Sequence[Column], ref: str) -> DataFrame:
    """The book from items that are reduced to one per (key, month) and one per (key, value).

    The values of a key, as many as there may be, are counted per window before the rows of a key
    come together.
    """
    month = F.coalesce(F.col(spec.month), _starts(windows, ref, reduced.schema[spec.month].dataType))
    names = [n for n in reduced.columns if n not in (spec.key, spec.month, _WHICH, "__value", "__w")]
    by_month = reduced.withColumn(spec.month, month).groupBy(spec.key, spec.month).agg(
        *[F.first(F.when(F.col(_WHICH) < 0, F.col(f"`{n}`")), ignorenulls=True).alias(n) for n in names],
        *[F.count_if(F.col(_WHICH) == i).alias(f"__distinct_{i}") for i in range(len(spec.categorical))])
    return rollup.finish(by_month, features)


def _month_features(rollup: _Rollup, spec: BookSpec, windows: list[_Window],
                    flags: bool) -> list[Column]:
    """All features of a book as aggregates over monthly parts."""
    parts = rollup.parts
    features = [rollup.feature(v, agg, w).alias(feature_name(v, agg, w.months))
                for v in spec.numeric for w in windows for agg in spec.aggregations
                if agg != "median"]  # medians are joined on later
    for i, v in enumerate(spec.categorical):
        for w in windows:
            if spec.approx_distinct:
                merged = F.hll_union_agg(w.value(parts.distinct(v)))
                distinct = F.hll_sketch_estimate(merged)
            else:
                distinct = F.sum(F.when(w.inside, F.col(f"__distinct_{i}")).otherwise(0))
            features += [
                F.coalesce(distinct, F.lit(0)).alias(feature_name(v, "nunique", w.months)),
                _total(w, parts.count(v)).alias(feature_name(v, "count", w.months))]
    rows_in = {w.months: _total(w, parts.rows()) for w in windows if spec.value_counts}
    for v, values in spec.value_counts.items():
        for value in values:
            stem = f"{normalize_text(v)}_{normalize_text(value)}"
            for w in windows:
                hits = _total(w, parts.hits(v, value))
                share = safe_divide(hits * 100.0, rows_in[w.months])
                features += [hits.alias(f"{stem}_count_{w.months}m"),
                             share.alias(f"{stem}_pct_{w.months}m")]
                if flags:
                    features.append(F.when(hits > 0, 1).otherwise(0)
                                    .alias(f"{stem}_flag_{w.months}m"))
    for num, dens in spec.ratios.items():
        for den in _denominators(dens):
            stem = f"ratio_{normalize_text(num)}_{normalize_text(den)}"
            for w in windows:
                ratio = safe_divide(F.sum(w.value(parts.sum(num))),
                                    F.sum(w.value(parts.sum(den))))
                features.append(ratio.alias(f"{stem}_{w.months}m"))
    return features


def category_book(df: DataFrame, spec: BookSpec, ref: str) -> DataFrame:
    """Only counts, percentages and flags of the listed values."""
    only = BookSpec(value_counts=spec.value_counts, windows=spec.windows, where=spec.where,
                    key=spec.key, month=spec.month, stamp_time=spec.stamp_time)
    return feature_book(df, only, ref, flags=True)


def break_book(df: DataFrame, spec: BookSpec, ref: str, by: str) -> DataFrame:
    """One row per (key, value of ``by``); sums are NULL where the window has no row."""
    check_aggregations(spec.aggregations)
    rows, windows = windowed_rows(df, spec, ref), _windows(df, spec, ref)
    if not _use_months(spec, len(spec.numeric) * len(spec.aggregations) * len(windows)):
        features = _numeric(spec, windows, zero_sum=False, prefix=by)
        return rows.groupBy(spec.key, by).agg(*features)
    rollup = _Rollup([spec.key, by], _sum_types(rows, spec.numeric))
    features = [rollup.feature(v, agg, w, zero_sum=False).alias(f"{by}_{v}_{agg}_{w.months}m")
                for v in spec.numeric for w in windows for agg in spec.aggregations]
    return rollup.finish(rollup.monthly(rows, [spec.key, by, spec.month]), features)


def break_books(df: DataFrame, spec: BookSpec, ref: str, by: Sequence[str],
                shape: str = "wide",
                values: Mapping[str, Sequence[object]] | None = None,
                most_values: int | None = None) -> DataFrame:
    """The book with further books broken down by category.

    ``wide``    one row per key; break values become columns (the default).  Without
                ``values`` the distinct values of each break are looked up first: they are
                column names, so all are known to the driver.  ``most_values`` refuses more.
    ``joined``  left joins on the key: a key with several break values gives several rows,
                and several breaks multiply.
    """
    base_spec = BookSpec(numeric=spec.numeric, windows=spec.windows, where=spec.where,
                         aggregations=spec.aggregations, key=spec.key, month=spec.month,
                         stamp_time=spec.stamp_time)
    if shape == "joined":
        from monthbook.operators.skew import left_join

        base = feature_book(df, base_spec, ref)
        # Base features first, then the stamps, then each break.
        stamps = ["dt_referencia", "dt_processamento"][:1 + spec.stamp_time]
        base = base.select(*[c for c in base.columns if c not in stamps], *stamps)
        return reduce(
            lambda left, b: left_join(left, break_book(df, spec, ref, b), [spec.key]),
            by, base)
    if shape != "wide":
        raise ValueError(f"shape must be 'wide' or 'joined', not {shape!r}")

    check_aggregations(spec.aggregations)
    rows, windows = windowed_rows(df, spec, ref), _windows(df, spec, ref)
    known = {b: (values or {}).get(b) or break_values(rows, b, most_values) for b in by}
    book = _wide_breaks(rows, base_spec, windows, known)
    made = [F.col(c) for c in book.columns if c != spec.key]
    return book.select(spec.key, *_stamps(spec, ref), *made)


def _wide_breaks(rows: DataFrame, spec: BookSpec, windows: list[_Window],
                 known: Mapping[str, Sequence[object]]) -> DataFrame:
    """Base and break features side by side.

    Each row counts once for the base (item 0) and once per break, under the number of its
    value.  Features are made per (key, item); the items of a key, no more than there are values,
    are then set next to each other.
    """
    names = [(v, agg, w) for v in spec.numeric for w in windows for agg in spec.aggregations]
    items, stems = [F.lit(0)], [""]
    for b, values in known.items():
        numbers = []
        missing = F.lit(None).cast("int")
        for value in values:
            if value is None:
                missing = F.when(F.col(b).isNull(), len(stems))
            else:
                numbers += [F.lit(value).cast(rows.schema[b].dataType), F.lit(len(stems))]
            stems.append(f"{b}_{normalize_text(value)}_")
        known_number = F.element_at(F.create_map(*numbers), F.col(b)) if numbers else missing
        items.append(F.coalesce(known_number, missing))
    tagged = (rows.select("*", F.explode(F.array(*items)).alias("__item"))
              .where(F.col("__item").isNotNull()))

    group = [spec.key, "__item"]
    rollup = _Rollup(group, _sum_types(rows, spec.numeric)) if _use_months(spec, len(names)) else None

    def feature(v: str, agg: str, w: _Window, zero_sum: bool) -> Column:
        if rollup is not None:
            return rollup.feature(v, agg, w, zero_sum)
        if agg != "sum":
            return AGGREGATES[agg](w.value(F.col(v)))
        return F.sum(F.when(w.inside, F.col(v)).otherwise(0) if zero_sum
                     else w.value(F.col(v)))

    made = [feature(*name, zero_sum=False).alias(f"f{i}") for i, name in enumerate(names)]
    made += [feature(*name, zero_sum=True).alias(f"z{i}") for i, name in enumerate(names)
             if name[1] == "sum"]
    if rollup is not None:
        long = rollup.finish(rollup.monthly(tagged, [*group, spec.month]), made)
    else:
        long = tagged.groupBy(*group).agg(*made)
    columns = [c for c in long.columns if c not in group]
    # The few items of a key are moved as they are, and only those it has are kept until the wide
    # row is made: an aggregate as wide as the book would spill every one of its columns.
    pair = F.struct("__item", F.struct(*columns).alias("made"))
    wide = (long.repartition(F.col(spec.key)).groupBy(spec.key)
            .agg(F.map_from_entries(F.collect_list(pair)).alias("__items")))
    wide = wide.select(spec.key, F.transform(
        F.sequence(F.lit(0), F.lit(len(stems) - 1)), lambda j: F.element_at("__items", j)).alias("__items"))
    out = []
    for j, stem in enumerate(stems):
        item = F.col("__items")[j]
        for i, (v, agg, w) in enumerate(names):
            source = "z" if agg == "sum" and j == 0 else "f"
            value = item[f"{source}{i}"]
            if agg in ("count", "approx_count_distinct"):
                value = F.coalesce(value, F.lit(0))
            name = f"{stem}{v}_{agg}_{w.months}m" if stem else feature_name(v, agg, w.months)
            out.append(value.alias(name))
    return wide.select(spec.key, *out)


def break_values(rows: DataFrame, by: str, most: int | None = None) -> list[object]:
    """Distinct values of a break column, sorted; more than ``most`` are refused."""
    values = rows.select(by).distinct()
    found = [r[0] for r in (values if most is None else values.limit(most + 1)).collect()]
    if most is not None and len(found) > most:
        raise ValueError(f"{by} has over {most} values; use the 'joined' shape")
    return sorted(found, key=lambda v: (v is None, str(v)))
