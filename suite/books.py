"""Feature books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.functions.months import window_start
from monthbook.operators.book import (
    BookSpec, break_book, break_books, category_book, cross_ratios, feature_book)
from suite.fixtures import REF, TX, TX_LINES, tx, tx_lines
from suite.registry import plain, query

WINDOWS = (1, 3, 6, 12)
V = "valor_transacao"
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATUSES = ("F", "O", "P")


def _in(n: int) -> str:
    return f"anomes >= '{window_start(REF, n)}' AND anomes <= '{REF}'"


def _range(windows=WINDOWS) -> str:
    return _in(max(windows))


def _book_sql(columns: list[str], cte: str = TX, source: str = "tx", where: str = "",
              windows=WINDOWS) -> str:
    extra = f" AND ({where})" if where else ""
    return (f"WITH {cte} SELECT cpf, '{REF}' AS dt_referencia, {', '.join(columns)} "
            f"FROM {source} WHERE {_range(windows)}{extra} GROUP BY cpf")


def _agg_sql(var: str, agg: str, n: int) -> str:
    hit = f"CASE WHEN {_in(n)} THEN {var} END"
    sql = {
        "sum": f"CAST(sum(CASE WHEN {_in(n)} THEN {var} ELSE 0 END) AS DOUBLE)",
        "avg": f"CAST(sum({hit}) AS DOUBLE) / nullif(count({hit}), 0)",
        "max": f"CAST(max({hit}) AS DOUBLE)",
        "min": f"CAST(min({hit}) AS DOUBLE)",
        "count": f"count({hit})",
        "std": f"round(stddev_samp(CAST({hit} AS DOUBLE)), 4)",
        "variance": f"round(var_samp(CAST({hit} AS DOUBLE)), -3)",
        "median": f"round(quantile_cont(CAST({hit} AS DOUBLE), 0.5), 4)",
    }[agg]
    return f"{sql} AS {var}_{agg}_{n}m"


def _value_sql(column: str, values: tuple[str, ...], name, kinds: tuple[str, ...],
               windows=WINDOWS) -> list[str]:
    out = []
    for value in values:
        for n in windows:
            hit = f"CASE WHEN {_in(n)} AND {column} = '{value}' THEN 1 ELSE 0 END"
            rows = f"nullif(count(CASE WHEN {_in(n)} THEN 1 END), 0)"
            sql = {"count": f"CAST(sum({hit}) AS BIGINT)",
                   "pct": f"CAST(sum({hit}) AS DOUBLE) * 100 / {rows}",
                   "flag": f"CAST(max({hit}) AS BIGINT)"}
            out += [f"{sql[k]} AS {name}_{slug(value)}_{k}_{n}m" for k in kinds]
    return out


def slug(value: str) -> str:
    return value.lower().replace("-", "_").replace(" ", "_")


def _spec(**kw) -> BookSpec:
    return BookSpec(**{"windows": WINDOWS, "stamp_time": False, **kw})


def _register_aggregate(key: str, agg: str, digits: int | None) -> None:
    sql = _book_sql([_agg_sql(V, agg, n) for n in WINDOWS])

    @query(key, sql)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        book = feature_book(tx(spark, sf), _spec(numeric=[V], aggregations=[agg]), REF)
        return plain(book, digits, tuple(f"{V}_{agg}_{n}m" for n in WINDOWS if digits is not None))


for _key, _agg, _digits in (
        ("book_sum", "sum", None), ("book_avg", "avg", None), ("book_max", "max", None),
        ("book_min", "min", None), ("book_count", "count", None), ("book_std", "std", 4)):
    _register_aggregate(_key, _agg, _digits)


@query("book_extra_agg", _book_sql(
    [_agg_sql(V, a, n) for n in WINDOWS for a in ("variance", "median")]))
def book_extra_agg(spark: SparkSession, sf: str) -> DataFrame:
    spec = _spec(numeric=[V], aggregations=["variance", "median"])
    book = plain(feature_book(tx(spark, sf), spec, REF), -3,
                 tuple(f"{V}_variance_{n}m" for n in WINDOWS))
    return plain(book, 4, tuple(f"{V}_median_{n}m" for n in WINDOWS))


def _nunique_sql(column: str, kinds=("nunique", "count"), windows=WINDOWS) -> list[str]:
    out = []
    for n in windows:
        hit = f"CASE WHEN {_in(n)} THEN {column} END"
        sql = {"nunique": f"count(DISTINCT {hit})", "count": f"count({hit})"}
        out += [f"{sql[k]} AS {column}_{k}_{n}m" for k in kinds]
    return out


@query("book_nunique", _book_sql(_nunique_sql("tipo_transacao", ("nunique",))
                                 + _nunique_sql("canal", ("nunique",))))
def book_nunique(spark: SparkSession, sf: str) -> DataFrame:
    book = feature_book(tx(spark, sf), _spec(categorical=["tipo_transacao", "canal"]), REF)
    return plain(book.select("cpf", "dt_referencia",
                             *[c for c in book.columns if "_nunique_" in c]))


@query("book_cat_count", _book_sql(_nunique_sql("canal", ("count",))))
def book_cat_count(spark: SparkSession, sf: str) -> DataFrame:
    book = feature_book(tx(spark, sf), _spec(categorical=["canal"]), REF)
    return plain(book.select("cpf", "dt_referencia", *[c for c in book.columns if "_count_" in c]))


def _register_values(key: str, kind: str) -> None:
    @query(key, _book_sql(_value_sql("tipo_transacao", PRIORITIES, "tipo_transacao", (kind,))))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spec = _spec(value_counts={"tipo_transacao": PRIORITIES})
        book = category_book(tx(spark, sf), spec, REF)
        return plain(book.select("cpf", "dt_referencia",
                                 *[c for c in book.columns if f"_{kind}_" in c]))


for _key, _kind in (("value_counts", "count"), ("value_pct", "pct"), ("value_flag", "flag")):
    _register_values(_key, _kind)


@query("category_book", _book_sql(
    _value_sql("tipo_transacao", PRIORITIES, "tipo_transacao", ("count", "pct", "flag"))
    + _value_sql("canal", STATUSES, "canal", ("count", "pct", "flag"))))
def category_book_query(spark: SparkSession, sf: str) -> DataFrame:
    spec = _spec(value_counts={"tipo_transacao": PRIORITIES, "canal": STATUSES})
    return plain(category_book(tx(spark, sf), spec, REF))


def _ratio_sql(num: str, den: str) -> list[str]:
    return [f"CAST(sum(CASE WHEN {_in(n)} THEN {num} END) AS DOUBLE) / "
            f"nullif(CAST(sum(CASE WHEN {_in(n)} THEN {den} END) AS DOUBLE), 0) "
            f"AS ratio_{num}_{den}_{n}m" for n in WINDOWS]


@query("book_ratio", _book_sql(
    _ratio_sql("valor_pago", "valor_fatura") + _ratio_sql("qtd_transacoes", "qtd_dias")
    + _ratio_sql("qtd_transacoes", "valor_fatura"), TX_LINES, "tx_lines"))
def book_ratio(spark: SparkSession, sf: str) -> DataFrame:
    spec = _spec(ratios={"valor_pago": "valor_fatura",
                         "qtd_transacoes": ["qtd_dias", "valor_fatura"]})
    return plain(feature_book(tx_lines(spark, sf), spec, REF))


@query("book_ratio_cross", _book_sql(
    [c for num in ("valor_pago", "qtd_transacoes") for den in ("valor_fatura", "qtd_dias")
     for c in _ratio_sql(num, den)], TX_LINES, "tx_lines"))
def book_ratio_cross(spark: SparkSession, sf: str) -> DataFrame:
    ratios = cross_ratios(["valor_pago", "qtd_transacoes"], ["valor_fatura", "qtd_dias"])
    return plain(feature_book(tx_lines(spark, sf), _spec(ratios=ratios), REF))


_FILTER = "valor_transacao > 100000 OR canal = 'F'"


@query("book_filtered", _book_sql([_agg_sql(V, a, n) for n in WINDOWS for a in ("sum", "count")],
                                  where=_FILTER))
def book_filtered(spark: SparkSession, sf: str) -> DataFrame:
    spec = _spec(numeric=[V], aggregations=["sum", "count"], where=_FILTER)
    return plain(feature_book(tx(spark, sf), spec, REF))


FULL_AGGS = ("sum", "avg", "max", "min", "count", "std")
FULL = dict(numeric=[V], categorical=["tipo_transacao", "canal"], aggregations=FULL_AGGS,
            value_counts={"tipo_transacao": PRIORITIES, "canal": STATUSES},
            ratios={V: "unidades"})


def _tx_units(spark: SparkSession, sf: str) -> DataFrame:
    return tx(spark, sf).withColumn("unidades", F.when(F.col("canal") == "P", 0).otherwise(1))


_TX_UNITS = TX + (", tx_units AS (SELECT *, CASE WHEN canal = 'P' THEN 0 ELSE 1 END "
                  "AS unidades FROM tx)")

FULL_SQL = _book_sql(
    [_agg_sql(V, a, n) for n in WINDOWS for a in FULL_AGGS]
    + _nunique_sql("tipo_transacao") + _nunique_sql("canal")
    + _value_sql("tipo_transacao", PRIORITIES, "tipo_transacao", ("count", "pct"))
    + _value_sql("canal", STATUSES, "canal", ("count", "pct"))
    + _ratio_sql(V, "unidades"), _TX_UNITS, "tx_units")


@query("feature_book", FULL_SQL)
def feature_book_query(spark: SparkSession, sf: str) -> DataFrame:
    book = feature_book(_tx_units(spark, sf), _spec(**FULL), REF)
    return plain(book, 4, tuple(f"{V}_std_{n}m" for n in WINDOWS))


def _break_sql(by: str, aggs, windows=WINDOWS) -> list[str]:
    out = []
    for n in windows:
        for a in aggs:
            hit = f"CASE WHEN {_in(n)} THEN {V} END"
            sql = {"sum": f"CAST(sum({hit}) AS DOUBLE)", "count": f"count({hit})",
                   "max": f"CAST(max({hit}) AS DOUBLE)",
                   "std": f"round(stddev_samp(CAST({hit} AS DOUBLE)), 4)"}[a]
            out.append(f"{sql} AS {by}_{V}_{a}_{n}m")
    return out


_BREAK_AGGS = ("sum", "max", "count", "std")


@query("book_breaks_long",
       f"WITH {TX} SELECT cpf, canal, {', '.join(_break_sql('canal', _BREAK_AGGS))} FROM tx "
       f"WHERE {_range()} GROUP BY cpf, canal")
def book_breaks_long(spark: SparkSession, sf: str) -> DataFrame:
    spec = _spec(numeric=[V], aggregations=_BREAK_AGGS)
    return plain(break_book(tx(spark, sf), spec, REF, "canal"), 4,
                 tuple(f"canal_{V}_std_{n}m" for n in WINDOWS))


def _wide_sql() -> str:
    columns = [_agg_sql(V, a, n) for n in WINDOWS for a in ("sum", "count")]
    for column, values in (("canal", STATUSES), ("tipo_transacao", PRIORITIES)):
        for value in values:
            for n in WINDOWS:
                hit = f"CASE WHEN {_in(n)} AND {column} = '{value}' THEN {V} END"
                stem = f"{column}_{slug(value)}_{V}"
                columns.append(f"CAST(sum({hit}) AS DOUBLE) AS {stem}_sum_{n}m")
                columns.append(f"count({hit}) AS {stem}_count_{n}m")
    return _book_sql(columns)


@query("book_breaks", _wide_sql())
def book_breaks(spark: SparkSession, sf: str) -> DataFrame:
    spec = _spec(numeric=[V], aggregations=("sum", "count"))
    return plain(break_books(tx(spark, sf), spec, REF, ["canal", "tipo_transacao"]))


def _joined_sql() -> str:
    base = ", ".join(_agg_sql(V, a, n) for n in WINDOWS for a in ("sum", "count"))
    parts = [f"WITH {TX}, base AS (SELECT cpf, {base} FROM tx WHERE {_range()} GROUP BY cpf)"]
    for b in ("canal", "tipo_transacao"):
        made = ", ".join(_break_sql(b, ("sum", "count")))
        parts.append(f", by_{b} AS (SELECT cpf, {b}, {made} FROM tx WHERE {_range()} "
                     f"GROUP BY cpf, {b})")
    parts.append(f" SELECT base.*, '{REF}' AS dt_referencia, by_canal.* EXCLUDE (cpf), "
                 "by_tipo_transacao.* EXCLUDE (cpf) FROM base "
                 "LEFT JOIN by_canal ON base.cpf = by_canal.cpf "
                 "LEFT JOIN by_tipo_transacao ON base.cpf = by_tipo_transacao.cpf")
    return "".join(parts)


@query("book_breaks_joined", _joined_sql())
def book_breaks_joined(spark: SparkSession, sf: str) -> DataFrame:
    spec = _spec(numeric=[V], aggregations=("sum", "count"))
    return plain(break_books(tx(spark, sf), spec, REF, ["canal", "tipo_transacao"],
                             shape="joined"))
