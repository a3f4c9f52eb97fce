"""Books from stored months, and books of sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthbook.functions.months import shift_month, window_start
from monthbook.operators.book import BookSpec, feature_book
from monthbook.operators.book_state import advance
from monthbook.session import scratch_path
from monthbook.sources.tables import write_partitions
from suite.books import STATUSES, V, slug
from suite.fixtures import REF, TX, tx
from suite.registry import plain, query

WINDOWS = (1, 3, 6, 12)
BEFORE = shift_month(REF, -1)
SPEC = BookSpec(numeric=[V], categorical=["tipo_transacao", "canal"], windows=WINDOWS,
                aggregations=("sum", "avg", "max", "min", "count", "std"),
                value_counts={"canal": STATUSES}, stamp_time=False)


def _book_sql(ref: str) -> str:
    columns = []
    for n in WINDOWS:
        w = f"anomes >= '{window_start(ref, n)}'"
        hit = f"CASE WHEN {w} THEN {V} END"
        columns += [
            f"CAST(sum(CASE WHEN {w} THEN {V} ELSE 0 END) AS DOUBLE) AS {V}_sum_{n}m",
            f"CAST(sum({hit}) AS DOUBLE) / nullif(count({hit}), 0) AS {V}_avg_{n}m",
            f"CAST(max({hit}) AS DOUBLE) AS {V}_max_{n}m", f"CAST(min({hit}) AS DOUBLE) AS {V}_min_{n}m",
            f"count({hit}) AS {V}_count_{n}m",
            f"round(stddev_samp(CAST({hit} AS DOUBLE)), 4) AS {V}_std_{n}m"]
        for c in SPEC.categorical:
            columns += [f"count(DISTINCT CASE WHEN {w} THEN {c} END) AS {c}_nunique_{n}m",
                        f"count(CASE WHEN {w} THEN {c} END) AS {c}_count_{n}m"]
        for value in STATUSES:
            hits = f"sum(CASE WHEN {w} AND canal = '{value}' THEN 1 ELSE 0 END)"
            columns += [f"CAST({hits} AS BIGINT) AS canal_{slug(value)}_count_{n}m",
                        f"CAST({hits} AS DOUBLE) * 100 / nullif(count(CASE WHEN {w} THEN 1 END), 0) "
                        f"AS canal_{slug(value)}_pct_{n}m"]
    return (f"SELECT cpf, '{ref}' AS dt_referencia, {', '.join(columns)} FROM tx "
            f"WHERE anomes BETWEEN '{window_start(ref, max(WINDOWS))}' AND '{ref}' GROUP BY cpf")


@query("book_incremental", f"WITH {TX} {_book_sql(BEFORE)} UNION ALL {_book_sql(REF)}")
def incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two consecutive books; the second reads one month of the source, the rest is state."""
    source, state = (scratch_path(spark, name) for name in ("transactions", "book-state"))
    write_partitions(tx(spark, sf), source, "anomes")
    rows = spark.read.schema(tx(spark, sf).schema).parquet(source)
    first = advance(rows, SPEC, state, BEFORE)
    both = first.unionByName(advance(rows, SPEC, state, REF))
    return plain(both, 4, tuple(f"{V}_std_{n}m" for n in WINDOWS))


def _sketch_sql() -> str:
    columns = []
    for n in WINDOWS:
        w = f"anomes >= '{window_start(REF, n)}'"
        hit = f"CASE WHEN {w} THEN CAST({V} AS DOUBLE) END"
        columns += [f"quantile_disc({hit}, 0.5) AS {V}_approx_median_{n}m",
                    f"count(DISTINCT CASE WHEN {w} THEN tipo_transacao END) AS tipo_transacao_nunique_{n}m",
                    f"count(CASE WHEN {w} THEN tipo_transacao END) AS tipo_transacao_count_{n}m"]
    return (f"WITH {TX} SELECT cpf, '{REF}' AS dt_referencia, {', '.join(columns)} FROM tx "
            f"WHERE anomes BETWEEN '{window_start(REF, max(WINDOWS))}' AND '{REF}' GROUP BY cpf")


def _register_sketches(key: str, by_month: bool) -> None:
    @query(key, _sketch_sql())
    def run(spark: SparkSession, sf: str) -> DataFrame:
        """Sketches hold every value of a group this small, so they are exact here."""
        spec = BookSpec(numeric=[V], categorical=["tipo_transacao"], windows=WINDOWS, by_month=by_month,
                        aggregations=("approx_median",), approx_distinct=True, stamp_time=False)
        return plain(feature_book(tx(spark, sf), spec, REF))


_register_sketches("book_sketches", True)
_register_sketches("book_sketches_by_row", False)
