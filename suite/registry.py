"""Where the query modules register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, IntegralType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with the SQL that must give the same rows."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def plain(df: DataFrame, digits: int | None = None, rounded: tuple[str, ...] = ()) -> DataFrame:
    """Whole numbers as bigint, decimals as double; ``rounded`` columns to ``digits``."""
    def one(field) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, IntegralType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, DecimalType):
            c = c.cast("double")
        if digits is not None and field.name in rounded:
            c = F.round(c.cast("double"), digits)
        return c.alias(field.name)
    return df.select(*[one(f) for f in df.schema.fields])
