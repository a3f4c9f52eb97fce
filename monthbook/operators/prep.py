"""From a feature table to a model table: split, select, encode, scale."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DateType, DayTimeIntervalType, DecimalType, IntegralType, NumericType, StringType,
    TimestampNTZType, TimestampType)

from monthbook.functions.scalars import clip

try:  # a type of newer Spark versions
    from pyspark.sql.types import TimeType
    _TIME_TYPES: tuple = (TimeType,)
except ImportError:
    _TIME_TYPES = ()

TEMPORAL_TYPES = (DateType, TimestampType, TimestampNTZType, DayTimeIntervalType, *_TIME_TYPES)

#: Stands for a missing number in a feature vector, next to an ``…_is_null`` column.
MISSING = -999999.0


def split_by_date(df: DataFrame, month: str, cutoff: int) -> tuple[DataFrame, DataFrame]:
    """Months up to the cutoff, and later ones; a NULL month is in neither."""
    at = F.col(month)
    if not isinstance(df.schema[month].dataType, IntegralType):
        at = at.cast("int")
    return df.where(at <= cutoff), df.where(at > cutoff)


def split_ranges(df: DataFrame, month: str, cutoff: int) -> DataFrame:
    """First and last month of the train and test part."""
    parts = split_by_date(df, month, cutoff)
    made = [part.agg(F.min(F.col(month).cast("int")).alias("first_month"),
                     F.max(F.col(month).cast("int")).alias("last_month"))
            .select(F.lit(name).alias("part"), "first_month", "last_month")
            for name, part in zip(("train", "test"), parts)]
    return made[0].unionByName(made[1])


@dataclass(frozen=True)
class ModelColumns:
    """Roles of the columns of a model table."""

    features: tuple[str, ...]
    categorical: tuple[str, ...]
    decimals: tuple[str, ...]
    dropped: tuple[str, ...]

    @property
    def numeric(self) -> tuple[str, ...]:
        return tuple(c for c in self.features if c not in self.categorical)


def model_columns(df: DataFrame, target: str, month: str) -> ModelColumns:
    """All columns but target, month and those of a time type are features."""
    fields = [f for f in df.schema.fields if f.name not in (target, month)]
    dropped = tuple(f.name for f in fields if isinstance(f.dataType, TEMPORAL_TYPES))
    kept = [f for f in fields if f.name not in dropped]
    return ModelColumns(
        features=tuple(f.name for f in kept),
        categorical=tuple(f.name for f in kept if isinstance(f.dataType, StringType)),
        decimals=tuple(f.name for f in kept if isinstance(f.dataType, DecimalType)),
        dropped=dropped)


def model_frame(df: DataFrame, target: str, month: str) -> DataFrame:
    """Features with decimals as doubles, the target as a whole number (cut off), the month."""
    columns = model_columns(df, target, month)
    label = F.col(target)
    if not isinstance(df.schema[target].dataType, IntegralType):
        label = label.cast("double").cast("int") if isinstance(
            df.schema[target].dataType, NumericType) else label.cast("int")
    return df.select(
        *[F.col(c).cast("double").alias(c) if c in columns.decimals else F.col(c)
          for c in columns.features],
        label.alias(target), month)


# --- encoding ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Encoding:
    """Fitted encoding of a model table."""

    indexers: tuple[StringIndexerModel, ...]
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]

    @property
    def inputs(self) -> list[str]:
        """Encoded columns, in order."""
        return ([f"{c}_index" for c in self.categorical]
                + [n for c in self.numeric for n in (f"{c}_filled", f"{c}_is_null")])

    @staticmethod
    def source_of(encoded: str) -> str:
        """The table column an encoded column stands for."""
        for tail in ("_index", "_filled", "_is_null"):
            if encoded.endswith(tail):
                return encoded[: -len(tail)]
        return encoded

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumns({f"__{c}": _category(c) for c in self.categorical})
        for indexer in self.indexers:
            out = indexer.transform(out)
        out = out.drop(*[f"__{c}" for c in self.categorical])
        filled = {}
        for c in self.numeric:
            value = F.col(c).cast("double")
            missing = value.isNull() | F.isnan(value)
            filled[f"{c}_filled"] = F.when(missing, MISSING).otherwise(value)
            filled[f"{c}_is_null"] = F.when(missing, 1.0).otherwise(0.0)
        return out.withColumns(filled)


#: The category of missing values; all others begin with an equals sign.
_NO_CATEGORY = "missing"


def _category(column: str) -> Column:
    value = F.col(column).cast("string")
    return F.when(value.isNull(), _NO_CATEGORY).otherwise(F.concat(F.lit("="), value))


def fit_encoding(train: DataFrame, columns: ModelColumns, max_bins: int = 256) -> Encoding:
    """Category indexes by frequency, the same way at any size.

    The ``max_bins`` commonest categories of a column get an index each, ties in the order of
    their text.  Missing values have the next index, and all rarer and unseen categories share
    the one after it.  Indexes are nominal: trees split on sets of them, not on their order.
    No more than ``max_bins`` categories of a column reach the driver.
    """
    indexers = []
    for c in columns.categorical:
        common = (train.where(F.col(c).isNotNull()).groupBy(_category(c).alias("c")).count()
                  .orderBy(F.desc("count"), "c").limit(max_bins).collect())
        labels = [*[r["c"] for r in common], _NO_CATEGORY]
        indexers.append(StringIndexerModel.from_labels(
            labels, inputCol=f"__{c}", outputCol=f"{c}_index", handleInvalid="keep"))
    return Encoding(tuple(indexers), columns.categorical, columns.numeric)


def one_hot(df: DataFrame, columns: Sequence[str], most: int | None = None) -> DataFrame:
    """0/1 columns ``{column}_{value}`` for every sorted value but the first.

    The values become column names, so they are all known to the driver; ``most`` refuses a
    column with more of them.
    """
    made: list[Column] = []
    for c in columns:
        found = df.select(c).where(F.col(c).isNotNull()).distinct()
        values = sorted(r[0] for r in (found if most is None else found.limit(most + 1)).collect())
        if most is not None and len(values) > most:
            raise ValueError(f"{c} has over {most} values")
        made += [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
                 for v in values[1:]]
    return df.select(*[c for c in df.columns if c not in columns], *made)


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column, from one aggregate."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}")
                   for i, c in enumerate(columns)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def standardise(df: DataFrame, columns: Sequence[str],
                by: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """Columns with mean 0 and population deviation 1; a constant column becomes 0.

    ``by`` takes the moments of another (training) table.
    """
    known = by or moments(df, columns)
    scaled = {}
    for c in columns:
        mean, spread = known[c]
        scaled[c] = (F.col(c).cast("double") - F.lit(mean)) / F.lit(spread or 1.0)
    return df.withColumns(scaled)


def clip_columns(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Columns held inside their limits."""
    return df.withColumns({c: clip(F.col(c), lo, hi) for c, (lo, hi) in limits.items()})
