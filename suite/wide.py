"""Books of the widths that are benchmarked, and books by months and by many values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.functions.months import month_of
from monthbook.operators.book import BookSpec, break_book, break_books, category_book, feature_book
from suite import fixtures as fx
from suite.books import (
    PRIORITIES, STATUSES, V, WINDOWS, _agg_sql, _book_sql, _in, _nunique_sql, _ratio_sql,
    _value_sql)
from suite.fixtures import REF, TX, tx
from suite.registry import plain, query

NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
TEXTS = ("l_returnflag", "l_linestatus", "o_orderpriority", "o_orderstatus")
FLAGS = ("A", "N", "R")
LINES = tuple(str(i) for i in range(1, 8))
SIX = ("sum", "avg", "max", "min", "count", "std")
FIVE = ("sum", "avg", "max", "min", "count")

_ROWS = """rows_ AS (SELECT o_custkey AS cpf, strftime(l_shipdate, '%Y%m') AS anomes,
  CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice,
  CAST(l_discount AS DECIMAL(18,2)) AS l_discount, CAST(l_tax AS DECIMAL(18,2)) AS l_tax,
  l_returnflag, l_linestatus, o_orderpriority, o_orderstatus,
  CAST(l_linenumber AS VARCHAR) AS line
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def line_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with the texts of their orders."""
    return fx._lines(spark, sf).select(
        F.col("o_custkey").alias("cpf"), month_of("l_shipdate").alias("anomes"),
        *[F.col(c).cast("decimal(18,2)").alias(c) for c in NUMERIC], *TEXTS,
        F.col("l_linenumber").cast("string").alias("line"))


def _std(windows: tuple[int, ...]) -> tuple[str, ...]:
    return tuple(f"{v}_std_{n}m" for v in NUMERIC for n in windows)


@query("book_128", _book_sql(
    [_agg_sql(v, a, n) for v in NUMERIC for n in WINDOWS for a in SIX]
    + [c for t in TEXTS for c in _nunique_sql(t)], _ROWS, "rows_"))
def book_128(spark: SparkSession, sf: str) -> DataFrame:
    spec = BookSpec(numeric=NUMERIC, categorical=TEXTS, aggregations=SIX, stamp_time=False)
    return plain(feature_book(line_rows(spark, sf), spec, REF), 4, _std(WINDOWS))


_LONG = (1, 3, 6, 12, 24)


@query("book_130", _book_sql(
    [_agg_sql(v, a, n) for v in NUMERIC for n in _LONG for a in FIVE]
    + [c for t in TEXTS[:3] for c in _nunique_sql(t, windows=_LONG)], _ROWS, "rows_",
    windows=_LONG))
def book_130(spark: SparkSession, sf: str) -> DataFrame:
    spec = BookSpec(numeric=NUMERIC, categorical=TEXTS[:3], windows=_LONG, stamp_time=False)
    return plain(feature_book(line_rows(spark, sf), spec, REF))


_CHURN = {"o_orderpriority": PRIORITIES, "o_orderstatus": STATUSES, "line": LINES}
_CHURN_RATIOS = {"l_quantity": ["l_extendedprice", "l_tax"],
                 "l_extendedprice": ["l_quantity", "l_tax"], "l_discount": ["l_tax"]}


@query("book_220", _book_sql(
    [_agg_sql(v, a, n) for v in NUMERIC for n in WINDOWS for a in FIVE]
    + [c for k, v in _CHURN.items() for c in _value_sql(k, v, k, ("count", "pct"))]
    + [c for n, ds in _CHURN_RATIOS.items() for d in ds for c in _ratio_sql(n, d)],
    _ROWS, "rows_"))
def book_220(spark: SparkSession, sf: str) -> DataFrame:
    spec = BookSpec(numeric=NUMERIC, value_counts=_CHURN, ratios=_CHURN_RATIOS, stamp_time=False)
    return plain(feature_book(line_rows(spark, sf), spec, REF))


def _register_counts(key: str, values: dict, windows: tuple[int, ...]) -> None:
    columns = [c for k, v in values.items()
               for c in _value_sql(k, v, k, ("count", "pct", "flag"), windows)]

    @query(key, _book_sql(columns, _ROWS, "rows_", windows=windows))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spec = BookSpec(value_counts=values, windows=windows, stamp_time=False)
        return plain(category_book(line_rows(spark, sf), spec, REF))


_register_counts("counts_207", _CHURN | {"l_returnflag": FLAGS,
                                         "l_linestatus": ("F", "O", "X", "Y", "Z")}, (1, 7, 30))
_register_counts("counts_171", _CHURN | {"l_returnflag": FLAGS, "l_linestatus": ("F",)},
                 (3, 6, 12))


def _types(df: DataFrame) -> list[tuple[str, str]]:
    return [(c, k) for c, k in df.dtypes if c.endswith("m")]


@query("book_by_month", _book_sql([_agg_sql(V, a, n) for n in WINDOWS for a in SIX]))
def book_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """A narrow book made from months: the same numbers, in the same types."""
    narrow, monthly = (feature_book(tx(spark, sf), BookSpec(
        numeric=[V], aggregations=SIX, stamp_time=False, by_month=m), REF) for m in (False, True))
    if _types(narrow) != _types(monthly):
        raise AssertionError("types differ with the way a book is made")
    return plain(monthly, 4, tuple(f"{V}_std_{n}m" for n in WINDOWS))


@query("book_breaks_by_month", f"WITH {TX} SELECT cpf, canal, " + ", ".join(
    f"CAST(sum(CASE WHEN {_in(n)} THEN {V} END) AS DOUBLE) AS canal_{V}_sum_{n}m, "
    f"round(stddev_samp(CAST(CASE WHEN {_in(n)} THEN {V} END AS DOUBLE)), 4) "
    f"AS canal_{V}_std_{n}m" for n in WINDOWS)
    + f" FROM tx WHERE {_in(max(WINDOWS))} GROUP BY cpf, canal")
def book_breaks_by_month(spark: SparkSession, sf: str) -> DataFrame:
    spec = BookSpec(numeric=[V], aggregations=("sum", "std"), stamp_time=False, by_month=True)
    return plain(break_book(tx(spark, sf), spec, REF, "canal"), 4,
                 tuple(f"canal_{V}_std_{n}m" for n in WINDOWS))


@query("book_breaks_many", f"""WITH {TX}, cut AS (SELECT *, 'f' || (cpf * 13 % 1500) AS faixa FROM tx)
SELECT cpf, 'faixa_' || faixa || '_{V}_sum_12m' AS name, CAST(sum({V}) AS DOUBLE) AS value
FROM cut WHERE {_in(12)} GROUP BY cpf, faixa""")
def book_breaks_many(spark: SparkSession, sf: str) -> DataFrame:
    """A break with as many values as the data has: every one becomes a column."""
    cut = tx(spark, sf).withColumn(
        "faixa", F.concat(F.lit("f"), (F.col("cpf") * 13 % 1500).cast("string")))
    book = break_books(cut, BookSpec(numeric=[V], aggregations=("sum",), windows=(12,),
                                     stamp_time=False), REF, ["faixa"])
    made = [c for c in book.columns if c.startswith("faixa_")]
    long = book.select("cpf", *[F.col(c).cast("double").alias(c) for c in made]).unpivot(
        ["cpf"], made, "name", "value")
    return plain(long.where(F.col("value").isNotNull()))
