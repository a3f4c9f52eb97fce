"""Risk and preset books, the book pipeline, quality reports, months, text and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.functions.months import (
    month_of, parse_lag_col, previous_month_col, shift_month_col, window_start,
    window_start_col)
from monthbook.functions.text import normalize_text_col
from monthbook.operators import risk
from monthbook.operators.book import BookSpec, feature_book
from monthbook.operators.quality import (
    duplicate_keys, latest_partition, null_percent, null_total, schema_profile,
    validation_report)
from monthbook.plans.book_pipeline import run_book
from monthbook.plans.presets import BEHAVIOUR_PRESETS, MODEL_PRESETS, preset_book
from monthbook.session import scratch_path
from monthbook.sources.tables import read_table, read_written, sql_table, write_book
from suite import fixtures as fx
from suite.books import FULL_SQL, FULL, WINDOWS, V, _spec, _tx_units, slug
from suite.registry import plain, query

REF = fx.REF


def _in(n: int) -> str:
    return f"anomes >= '{window_start(REF, n)}' AND anomes <= '{REF}'"


# --- risk -------------------------------------------------------------------------------

_USE = "vl_utilizado / nullif(vl_limite, 0)"
_RISK = {
    "risk_utilisation": (risk.utilisation, [
        f"round(avg(CASE WHEN {_in(n)} THEN {_USE} END), 8) AS taxa_utilizacao_{n}m"
        for n in WINDOWS]),
    "risk_late_freq": (risk.late_frequency, [
        f"CAST(sum(CASE WHEN {_in(n)} AND fl_atraso = 1 THEN 1 ELSE 0 END) AS BIGINT) "
        f"AS freq_atrasos_{n}m" for n in WINDOWS]),
    "risk_max_days": (risk.max_days_late, [
        f"CAST(max(CASE WHEN {_in(n)} THEN dias_atraso END) AS BIGINT) "
        f"AS max_dias_atraso_{n}m" for n in WINDOWS]),
    "risk_payment_std": (risk.payment_spread, [
        f"round(stddev_samp(CASE WHEN {_in(n)} THEN vl_pagamento END), 4) "
        f"AS std_pagamentos_{n}m" for n in WINDOWS]),
    "risk_score": (risk.composite_score(max(WINDOWS)), [
        "round(coalesce(avg(CASE WHEN fl_atraso = 1 THEN 1 ELSE 0 END), 0) * 0.4 + "
        f"coalesce(avg({_USE}), 0) * 0.3 + coalesce(max(dias_atraso) / 90.0, 0) * 0.3, 8) "
        "AS score_risco_composto"]),
}


def _risk_sql(columns: list[str]) -> str:
    return (f"WITH {fx.CARTAO} SELECT cpf, '{REF}' AS dt_referencia, {', '.join(columns)} "
            f"FROM cartao WHERE {_in(max(WINDOWS))} GROUP BY cpf")


def _risk_plain(book: DataFrame) -> DataFrame:
    std = tuple(c for c in book.columns if c.startswith("std_"))
    share = tuple(c for c in book.columns if c.startswith(("taxa_", "score_")))
    return plain(plain(book, 4, std), 8, share)


def _register_risk(key: str) -> None:
    factory, columns = _RISK[key]

    @query(key, _risk_sql(columns))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spec = BookSpec(windows=WINDOWS, extra=[factory], stamp_time=False)
        return _risk_plain(feature_book(fx.cartao(spark, sf), spec, REF))


for _key in _RISK:
    _register_risk(_key)


@query("risk_book", _risk_sql([c for _, columns in _RISK.values() for c in columns]))
def risk_all(spark: SparkSession, sf: str) -> DataFrame:
    return _risk_plain(risk.risk_book(fx.cartao(spark, sf), REF, WINDOWS, stamp_time=False))


# --- presets ----------------------------------------------------------------------------

_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_TEXTS = ("l_returnflag", "l_linestatus", "o_orderpriority", "o_orderstatus")


def _preset_columns(spec: BookSpec) -> tuple[dict[str, str], dict[str, str]]:
    """Number and text columns a preset needs, each as SQL over line items and orders."""
    wanted = list(dict.fromkeys(
        [*spec.numeric, *spec.ratios, *spec.ratios.values()]))
    numbers = {c: f"CAST({_NUMBERS[i % 4]} AS DECIMAL(18,2))" for i, c in enumerate(wanted)}
    texts = {c: _TEXTS[i % 4] for i, c in enumerate(spec.categorical)}
    for c, values in spec.value_counts.items():
        cases = " ".join(f"WHEN {i + 1} THEN '{v}'" for i, v in enumerate(values))
        texts[c] = f"CASE l_linenumber {cases} ELSE 'OUTRO' END"
    return numbers, texts


def _preset_sql(spec: BookSpec) -> str:
    numbers, texts = _preset_columns(spec)
    made = ", ".join(f"{sql} AS {c}" for c, sql in {**numbers, **texts}.items())
    out = []
    for c in spec.numeric:
        for n in spec.windows:
            hit = f"CASE WHEN {_in(n)} THEN {c} END"
            for a in spec.aggregations:
                sql = {"sum": f"CAST(sum(CASE WHEN {_in(n)} THEN {c} ELSE 0 END) AS DOUBLE)",
                       "avg": f"CAST(sum({hit}) AS DOUBLE) / nullif(count({hit}), 0)",
                       "max": f"CAST(max({hit}) AS DOUBLE)",
                       "min": f"CAST(min({hit}) AS DOUBLE)", "count": f"count({hit})",
                       "std": f"round(stddev_samp(CAST({hit} AS DOUBLE)), 4)"}[a]
                out.append(f"{sql} AS {c}_{a}_{n}m")
    for c in spec.categorical:
        for n in spec.windows:
            hit = f"CASE WHEN {_in(n)} THEN {c} END"
            out += [f"count(DISTINCT {hit}) AS {c}_nunique_{n}m", f"count({hit}) AS {c}_count_{n}m"]
    for c, values in spec.value_counts.items():
        for v in values:
            for n in spec.windows:
                hit = f"CASE WHEN {_in(n)} AND {c} = '{v}' THEN 1 ELSE 0 END"
                rows = f"nullif(count(CASE WHEN {_in(n)} THEN 1 END), 0)"
                out += [f"CAST(sum({hit}) AS BIGINT) AS {c}_{slug(v)}_count_{n}m",
                        f"CAST(sum({hit}) AS DOUBLE) * 100 / {rows} AS {c}_{slug(v)}_pct_{n}m"]
    for num, den in spec.ratios.items():
        for n in spec.windows:
            top, bottom = (f"CAST(sum(CASE WHEN {_in(n)} THEN {c} END) AS DOUBLE)"
                           for c in (num, den))
            out.append(f"{top} / nullif({bottom}, 0) AS ratio_{num}_{den}_{n}m")
    return (f"WITH src AS (SELECT o_custkey AS cpf, strftime(l_shipdate, '%Y%m') AS anomes, "
            f"{made} FROM lineitem JOIN orders ON l_orderkey = o_orderkey) "
            f"SELECT cpf, '{REF}' AS dt_referencia, {', '.join(out)} FROM src "
            f"WHERE {_in(max(spec.windows))} GROUP BY cpf")


def _register_preset(key: str, name: str, presets: dict[str, BookSpec]) -> None:
    @query(key, _preset_sql(presets[name]))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        numbers, texts = _preset_columns(presets[name])
        rows = fx._lines(spark, sf).select(
            F.col("o_custkey").alias("cpf"), month_of("l_shipdate").alias("anomes"),
            *[F.expr(sql).alias(c) for c, sql in {**numbers, **texts}.items()])
        book = preset_book(rows, name, REF, presets).drop("dt_processamento")
        return plain(book, 4, tuple(c for c in book.columns if "_std_" in c))


for _name in BEHAVIOUR_PRESETS:
    _register_preset("preset_book" if _name == "cross_sell" else f"preset_behaviour_{_name}",
                     _name, BEHAVIOUR_PRESETS)
for _name in MODEL_PRESETS:
    _register_preset(f"preset_model_{_name}", _name, MODEL_PRESETS)


# --- book pipeline ----------------------------------------------------------------------

_LAST = "(SELECT max(strftime(o_orderdate, '%Y%m')) FROM orders)"


@query("book_latest", f"""WITH {fx.TX}, r AS (SELECT {_LAST} AS ref)
SELECT cpf, ref AS dt_referencia,
  CAST(sum(valor_transacao) AS DOUBLE) AS valor_transacao_sum_24m,
  count(valor_transacao) AS valor_transacao_count_24m,
  count(DISTINCT canal) AS canal_nunique_24m, count(canal) AS canal_count_24m
FROM tx, r WHERE anomes >= strftime(strptime(ref, '%Y%m') - INTERVAL 23 MONTH, '%Y%m')
  AND anomes <= ref GROUP BY cpf, ref""")
def book_latest(spark: SparkSession, sf: str) -> DataFrame:
    spec = BookSpec(numeric=[V], categorical=["canal"], windows=[24],
                    aggregations=["sum", "count"], stamp_time=False)
    run = run_book(fx.tx(spark, sf), spec, latest=True, out=scratch_path(spark, "book"))
    return plain(run.book)


@query("write_book", FULL_SQL)
def write_and_read_book(spark: SparkSession, sf: str) -> DataFrame:
    book = feature_book(_tx_units(spark, sf), _spec(**FULL), REF)
    path = scratch_path(spark, "book")
    write_book(book, path)
    return plain(read_written(spark, path, book.schema), 4,
                 tuple(f"{V}_std_{n}m" for n in WINDOWS))


# --- quality ----------------------------------------------------------------------------

def _report_sql(ref: str | None) -> str:
    shown = f"'{ref}'" if ref else "CAST(NULL AS VARCHAR)"
    where = f"WHERE anomes = '{ref}'" if ref else ""
    return f"""WITH {fx.TX} SELECT {shown} AS dt_referencia,
  count(DISTINCT cpf) AS qtd_cpfs_unicos, count(*) AS qtd_total_registros,
  count(*) - count(DISTINCT cpf) AS qtd_duplicados, min(anomes) AS primeira_particao,
  max(anomes) AS ultima_particao, count(DISTINCT anomes) AS qtd_particoes,
  CASE WHEN count(*) - count(DISTINCT cpf) > 0 THEN 'ALERTA: Existem registros duplicados'
       ELSE 'OK: Sem duplicados' END AS status_duplicados FROM tx {where}"""


@query("validation_report", _report_sql(REF))
def report(spark: SparkSession, sf: str) -> DataFrame:
    return plain(validation_report(fx.tx(spark, sf), ref=REF))


@query("validation_report_all", _report_sql(None))
def report_all(spark: SparkSession, sf: str) -> DataFrame:
    return plain(validation_report(fx.tx(spark, sf)))


@query("latest_partition", f"WITH {fx.TX} SELECT max(anomes) AS ultima_particao FROM tx "
       "WHERE anomes IS NOT NULL")
def newest(spark: SparkSession, sf: str) -> DataFrame:
    return latest_partition(fx.tx(spark, sf))


@query("duplicate_keys", f"""WITH {fx.TX} SELECT cpf, anomes,
  CAST(valor_transacao AS DOUBLE) AS valor_transacao, tipo_transacao, canal FROM tx
WHERE (cpf, anomes) IN (SELECT (cpf, anomes) FROM tx GROUP BY cpf, anomes HAVING count(*) > 1)""")
def duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return plain(duplicate_keys(fx.tx(spark, sf), ["cpf", "anomes"]))


_SPARSE = f"""sparse AS (SELECT m.document_id, m.y, f.score, f.category, f.amount
FROM main_documents m LEFT JOIN feature_table_1 f ON f.doc = m.document_id
  AND f.mes = strftime(strptime(m.date_yyyymm, '%Y%m') - INTERVAL 1 MONTH, '%Y%m'))"""
_SPARSE_SQL = f"WITH {fx.MAIN_DOCUMENTS}, {fx.FEATURE_TABLE_1}, {_SPARSE} "


def _sparse(spark: SparkSession, sf: str) -> DataFrame:
    from monthbook.operators.joins import lagged_join
    from suite.joins import DOC, FT1, MONTH

    joined = lagged_join(fx.main_documents(spark, sf), fx.feature_table_1(spark, sf), FT1,
                         doc=DOC, month=MONTH, columns=["score", "category", "amount"])
    return joined.select("document_id", "y",
                         *[F.col(f"feature_table_1_{c}").alias(c)
                           for c in ("score", "category", "amount")])


_NULLS = ("document_id", "y", "score", "category", "amount")


@query("null_percent", _SPARSE_SQL + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS DOUBLE) * 100 / count(*) "
    f"AS null_pct FROM sparse" for c in _NULLS) + ") WHERE null_pct > 50")
def null_shares(spark: SparkSession, sf: str) -> DataFrame:
    return null_percent(_sparse(spark, sf), _NULLS, over=50.0)


@query("null_total", _SPARSE_SQL + "SELECT CAST(" + " + ".join(
    f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in _NULLS)
    + " AS BIGINT) AS missing_values FROM sparse")
def null_sum(spark: SparkSession, sf: str) -> DataFrame:
    return plain(null_total(_sparse(spark, sf), _NULLS))


@query("schema_profile", "SELECT n AS n_rows, CAST(6 AS BIGINT) AS total_columns, data_type, "
       "CAST(n_columns AS BIGINT) AS n_columns FROM (SELECT count(*) AS n FROM orders) "
       "CROSS JOIN (VALUES ('bigint', 2), ('string', 2), ('double', 1), ('timestamp_ntz', 1)) "
       "v(data_type, n_columns)")
def profile(spark: SparkSession, sf: str) -> DataFrame:
    return plain(schema_profile(fx.table(spark, sf, "orders")))


# --- months, text, sources --------------------------------------------------------------

def _ym(sql: str) -> str:
    return f"strftime({sql}, '%Y%m')"


@query("month_window_start", "SELECT o_orderkey, " + ", ".join(
    _ym(f"date_trunc('month', o_orderdate) - INTERVAL {n - 1} MONTH") + f" AS start_{n}m"
    for n in (1, 3, 6, 12, 24)) + " FROM orders")
def starts(spark: SparkSession, sf: str) -> DataFrame:
    month = month_of("o_orderdate")
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", *[window_start_col(month, n).alias(f"start_{n}m")
                        for n in (1, 3, 6, 12, 24)])


@query("month_lag", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, "
       + _ym("date_trunc('month', l_shipdate) - to_months(l_linenumber)") + " AS lagged "
       "FROM lineitem")
def lags(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber")
    text = F.concat(F.when(F.col("l_returnflag") == "R", "M-").otherwise("m-"),
                    line.cast("string"))
    return plain(fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        shift_month_col(month_of("l_shipdate"), -parse_lag_col(text)).alias("lagged")))


@query("previous_month", "SELECT event_id, "
       + _ym("date_trunc('month', ts) - INTERVAL 1 MONTH") + " AS previous FROM events")
def previous(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "events").select(
        "event_id", previous_month_col(F.col("ts")).alias("previous"))


@query("normalize_text", "SELECT doc_id, lower(trim(regexp_replace(strip_accents(text), "
       "'[^a-zA-Z0-9]+', '_', 'g'), '_')) AS normalized FROM documents")
def normalized(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "documents").select(
        "doc_id", normalize_text_col(F.col("text")).alias("normalized"))


@query("read_table", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, "
       "c_acctbal, c_mktsegment FROM customer")
def read_by_suffix(spark: SparkSession, sf: str) -> DataFrame:
    return plain(read_table(spark, f"{sf}/customer.parquet"))


@query("sql_table", "SELECT o_orderstatus, count(*) AS n, "
       "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders "
       "GROUP BY o_orderstatus")
def run_sql(spark: SparkSession, sf: str) -> DataFrame:
    return plain(sql_table(
        spark, "SELECT o_orderstatus, count(*) AS n, "
        "sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM {t} GROUP BY o_orderstatus",
        t=fx.table(spark, sf, "orders")))
