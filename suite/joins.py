"""Lagged joins, master tables and their pipelines."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.operators.joins import (
    document_root, lagged_join, master_table, numeric_feature_join)
from monthbook.operators.quality import (
    master_validation, partition_stats, table_counts)
from monthbook.plans.join_pipelines import (
    join_pipeline, master_pipeline, numeric_join_pipeline)
from monthbook.session import scratch_path
from monthbook.sources.tables import (
    LAG_METADATA, ROOT_METADATA, FeatureKeys, feature_keys, load_feature_map,
    numeric_columns, read_output, read_partitions, read_written, store_by_document, write_partitions)
from suite import fixtures as fx
from suite.registry import plain, query

DOC, MONTH = "document_id", "date_yyyymm"
FT1 = FeatureKeys("feature_table_1", "doc", "mes", 1, unique=True)
FT2 = FeatureKeys("feature_table_2", "id_cliente", "safra", 2, "bigint", "int", unique=True)
FT3 = FeatureKeys("feature_table_3", "doc", "mes", 0)
MONTHS = ["200001", "200002", "200003", "200004", "200005", "200006"]
FEATURE_MAP = {"feature_table_1": ["score", "flag", "amount", "category"],
               "feature_table_2": ["risk_level", "priority", "status"]}


def _back(column: str, k: int) -> str:
    return f"strftime(strptime({column}, '%Y%m') - INTERVAL {k} MONTH, '%Y%m')"


_ON1 = f"f.doc = m.document_id AND f.mes = {_back('m.date_yyyymm', 1)}"
_ON2 = (f"CAST(g.id_cliente AS VARCHAR) = m.document_id "
        f"AND CAST(g.safra AS VARCHAR) = {_back('m.date_yyyymm', 2)}")
_POP = "m.document_id, CAST(m.y AS BIGINT) AS y, m.date_yyyymm"
_F1 = ("CAST(f.score AS DOUBLE) AS feature_table_1_score, "
       "CAST(f.flag AS BIGINT) AS feature_table_1_flag, "
       "f.amount AS feature_table_1_amount, f.category AS feature_table_1_category")
_F2 = ("g.risk_level AS feature_table_2_risk_level, "
       "CAST(g.priority AS BIGINT) AS feature_table_2_priority, "
       "g.status AS feature_table_2_status")
_LAGGED1 = (f"SELECT {_POP}, {_F1} FROM main_documents m LEFT JOIN feature_table_1 f "
            f"ON {_ON1}")
_LAGGED2 = (f"SELECT {_POP}, {_F2} FROM main_documents m LEFT JOIN feature_table_2 g "
            f"ON {_ON2}")
_MASTER = (f"SELECT {_POP}, {_F1}, {_F2} FROM main_documents m LEFT JOIN feature_table_1 f "
           f"ON {_ON1} LEFT JOIN feature_table_2 g ON {_ON2}")
_IN_MONTHS = "m.date_yyyymm IN (" + ", ".join(f"'{m}'" for m in MONTHS) + ")"


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


@query("lagged_join", _with(fx.MAIN_DOCUMENTS, fx.FEATURE_TABLE_1) + _LAGGED1)
def lagged(spark: SparkSession, sf: str) -> DataFrame:
    return plain(lagged_join(fx.main_documents(spark, sf), fx.feature_table_1(spark, sf), FT1,
                             doc=DOC, month=MONTH))


@query("lagged_join_cast", _with(fx.MAIN_DOCUMENTS, fx.FEATURE_TABLE_2) + _LAGGED2)
def lagged_cast(spark: SparkSession, sf: str) -> DataFrame:
    return plain(lagged_join(fx.main_documents(spark, sf), fx.feature_table_2(spark, sf), FT2,
                             doc=DOC, month=MONTH))


@query("lagged_join_fanout", _with(fx.MAIN_DOCUMENTS, fx.FEATURE_TABLE_3) + f"""
SELECT {_POP}, CAST(h.value AS DOUBLE) AS feature_table_3_value,
  h.rating AS feature_table_3_rating, h.type AS feature_table_3_type
FROM main_documents m LEFT JOIN feature_table_3 h
ON h.doc = m.document_id AND h.mes = m.date_yyyymm""")
def lagged_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return plain(lagged_join(fx.main_documents(spark, sf), fx.feature_table_3(spark, sf), FT3,
                             doc=DOC, month=MONTH))


def _features(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"feature_table_1": fx.feature_table_1(spark, sf),
            "feature_table_2": fx.feature_table_2(spark, sf)}


@query("master_table",
       _with(fx.MAIN_DOCUMENTS, fx.FEATURE_TABLE_1, fx.FEATURE_TABLE_2) + _MASTER)
def master(spark: SparkSession, sf: str) -> DataFrame:
    return plain(master_table(fx.main_documents(spark, sf), _features(spark, sf), [FT1, FT2],
                              load_feature_map(spark, FEATURE_MAP), doc=DOC, month=MONTH))


@query("master_table_bucketed",
       _with(fx.MAIN_DOCUMENTS, fx.FEATURE_TABLE_1, fx.FEATURE_TABLE_2) + _MASTER)
def master_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The master table of tables that are stored by document: no shuffle with ``COLOCATED``."""
    prefix, out = "b" + uuid.uuid4().hex[:8], scratch_path(spark, "by-document")

    def stored(df: DataFrame, keys: FeatureKeys) -> DataFrame:
        return store_by_document(df, f"default.{prefix}_{keys.table}", keys.doc, keys.month, 8,
                                 f"{out}/{keys.table}")

    population = FeatureKeys("population", DOC, MONTH)
    features = _features(spark, sf)
    return plain(master_table(
        stored(fx.main_documents(spark, sf), population),
        {k.table: stored(features[k.table], k) for k in (FT1, FT2)}, [FT1, FT2],
        load_feature_map(spark, FEATURE_MAP), doc=DOC, month=MONTH))


def _lag_metadata(spark: SparkSession) -> DataFrame:
    rows = [("feature_table_1", "doc", "string", "mes", "string", "m-1"),
            ("feature_table_2", "id_cliente", "bigint", "safra", "int", "m-2")]
    return spark.createDataFrame(rows, list(LAG_METADATA))


@query("join_pipeline", _with(fx.MAIN_DOCUMENTS, fx.FEATURE_TABLE_1, fx.FEATURE_TABLE_2) + f"""
, rows1 AS ({_LAGGED1} WHERE {_IN_MONTHS}), rows2 AS ({_LAGGED2} WHERE {_IN_MONTHS})
SELECT 'feature_table_1' AS table_name, count(*) AS row_count FROM rows1
UNION ALL SELECT 'feature_table_2', count(*) FROM rows2""".replace(") \n,", "),"))
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    paths = join_pipeline(fx.main_documents(spark, sf), _features(spark, sf),
                          feature_keys(_lag_metadata(spark)), doc=DOC, month=MONTH,
                          months=MONTHS, out=scratch_path(spark, "joins"))
    return table_counts({t: spark.read.parquet(p) for t, p in paths.items()})


@query("join_pipeline_tables", _with(fx.MAIN_DOCUMENTS, fx.FEATURE_TABLE_1, fx.FEATURE_TABLE_2) + f"""
, rows1 AS ({_LAGGED1} WHERE {_IN_MONTHS}), rows2 AS ({_LAGGED2} WHERE {_IN_MONTHS})
SELECT 'feature_table_1' AS table_name, count(*) AS row_count FROM rows1
UNION ALL SELECT 'feature_table_2', count(*) FROM rows2""".replace(") \n,", "),"))
def pipeline_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The same into tables of the catalogue, twice: the second run replaces the first."""
    prefix, out = "t" + uuid.uuid4().hex[:8], scratch_path(spark, "catalogue")
    for _ in range(2):
        names = join_pipeline(fx.main_documents(spark, sf), _features(spark, sf),
                              feature_keys(_lag_metadata(spark)), doc=DOC, month=MONTH,
                              months=MONTHS, out=out, prefix=prefix, database="default")
    return table_counts({t: spark.table(n) for t, n in names.items()})


@query("join_pipeline_evolving", _with(fx.MAIN_DOCUMENTS, fx.FEATURE_TABLE_1) + f"""
, rows1 AS ({_LAGGED1})
SELECT document_id, y, date_yyyymm, feature_table_1_score, feature_table_1_flag,
  CASE WHEN substr(date_yyyymm, 5) > '06' THEN feature_table_1_amount END AS feature_table_1_amount,
  CASE WHEN substr(date_yyyymm, 5) > '06' THEN feature_table_1_category END
    AS feature_table_1_category
FROM rows1 WHERE substr(date_yyyymm, 5) <> '03'""")
def evolving(spark: SparkSession, sf: str) -> DataFrame:
    """All months with two features; then, with four, the second half of every year again, while March
    is asked for and comes out empty."""
    population, features = fx.main_documents(spark, sf), fx.feature_table_1(spark, sf)
    part = F.substring(MONTH, 5, 2)
    args = dict(doc=DOC, month=MONTH, out=scratch_path(spark, "evolving"),
                prefix="e" + uuid.uuid4().hex[:8], database="default")
    join_pipeline(population, {FT1.table: features.drop("amount", "category")}, [FT1],
                  months=None, **args)
    again = [r[0] for r in population.select(MONTH).distinct()
             .where((part > "06") | (part == "03")).collect()]  # a few months
    names = join_pipeline(population.where(part != "03"), {FT1.table: features}, [FT1],
                          months=again, **args)
    return plain(spark.table(names[FT1.table]))


@query("table_counts", "SELECT 'orders' AS table_name, count(*) AS row_count FROM orders "
       "UNION ALL SELECT 'lineitem', count(*) FROM lineitem "
       "UNION ALL SELECT 'documents', count(*) FROM documents")
def counts(spark: SparkSession, sf: str) -> DataFrame:
    return table_counts({n: fx.table(spark, sf, n) for n in ("orders", "lineitem", "documents")})


_ALL = _with(fx.MAIN_DOCUMENTS, fx.FEATURE_TABLE_1, fx.FEATURE_TABLE_2)


@query("master_pipeline", _ALL + _MASTER + f" WHERE {_IN_MONTHS}")
def master_run(spark: SparkSession, sf: str) -> DataFrame:
    written, _ = master_pipeline(
        fx.main_documents(spark, sf), _features(spark, sf),
        feature_keys(_lag_metadata(spark)), FEATURE_MAP, doc=DOC, month=MONTH,
        months=MONTHS, out=scratch_path(spark, "master"))
    return plain(written)


@query("master_validation", _with(fx.MAIN_DOCUMENTS) +
       "SELECT count(*) AS total_rows, count(DISTINCT date_yyyymm) AS partitions "
       "FROM main_documents")
def validation(spark: SparkSession, sf: str) -> DataFrame:
    return master_validation(fx.main_documents(spark, sf), MONTH)


@query("partition_stats", _with(fx.FEATURE_TABLE_3) +
       "SELECT mes AS partition_date, count(*) AS row_count, "
       "count(DISTINCT doc) AS unique_docs FROM feature_table_3 GROUP BY mes")
def stats(spark: SparkSession, sf: str) -> DataFrame:
    return partition_stats(fx.feature_table_3(spark, sf), "doc", "mes")


def _written_tx(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.tx(spark, sf)
    path = scratch_path(spark, "tx")
    write_partitions(rows, path, "anomes")
    return read_written(spark, path, rows.schema)


_TX_ROWS = ("SELECT cpf, anomes, CAST(valor_transacao AS DOUBLE) AS valor_transacao, "
            "tipo_transacao, canal FROM tx")


@query("write_partitions", _with(fx.TX) + _TX_ROWS)
def write_twice(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.tx(spark, sf)
    path = scratch_path(spark, "tx")
    for _ in range(2):  # a second run must change nothing
        write_partitions(rows, path, "anomes")
    return plain(read_written(spark, path, rows.schema))


@query("read_partitions", _with(fx.TX) + "SELECT cpf, anomes, CAST(valor_transacao AS DOUBLE) "
       "AS valor_transacao FROM tx WHERE anomes IN ('200001', '200002', '200003')")
def partitions(spark: SparkSession, sf: str) -> DataFrame:
    return plain(read_partitions(_written_tx(spark, sf), "anomes",
                                 ["200001", "200002", "200003"],
                                 ["cpf", "anomes", "valor_transacao"]))


@query("read_master", _with(fx.TX) + "SELECT cpf, CAST(valor_transacao AS DOUBLE) "
       "AS valor_transacao FROM tx WHERE anomes >= '200001' AND canal = 'F'")
def read_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return plain(read_output(_written_tx(spark, sf), "anomes >= '200001' AND canal = 'F'",
                             ["cpf", "valor_transacao"]))


ROOT = FeatureKeys("db.feat_root", "raiz", "safra", 1, "numeric", "int", 8, unique=True)
FULL = FeatureKeys("db.feat_full", "cpf", "safra", 0, "numeric", "int", 11, unique=True)
_ON_ROOT = ("substr(CAST(a.cpf AS VARCHAR), 1, 8) = CAST(b.raiz AS VARCHAR) AND CAST(b.safra "
            f"AS VARCHAR) = {_back('CAST(a.anomes AS VARCHAR)', 1)}")
_A = "a.cpf AS cpf_publico_target, CAST(a.y AS BIGINT) AS y, CAST(a.anomes AS BIGINT) AS anomes"


@query("root_join", _with(fx.TARGET_CPF, fx.FEAT_ROOT) + f"""
SELECT {_A}, CAST(b.total AS DOUBLE) AS total, CAST(b.pedidos AS DOUBLE) AS pedidos
FROM target_cpf a LEFT JOIN feat_root b ON {_ON_ROOT}""")
def root(spark: SparkSession, sf: str) -> DataFrame:
    return plain(numeric_feature_join(fx.target_cpf(spark, sf), fx.feat_root(spark, sf), ROOT))


@query("full_doc_join", _with(fx.TARGET_CPF, fx.FEAT_FULL) + f"""
SELECT {_A}, CAST(b.y_max AS DOUBLE) AS y_max, CAST(b.linhas AS DOUBLE) AS linhas
FROM target_cpf a LEFT JOIN feat_full b ON a.cpf = b.cpf AND a.anomes = b.safra""")
def full(spark: SparkSession, sf: str) -> DataFrame:
    return plain(numeric_feature_join(fx.target_cpf(spark, sf), fx.feat_full(spark, sf), FULL))


_ROOT_MONTHS = [200001, 200002, 200003]
_IN_ROOT = "a.anomes IN (200001, 200002, 200003)"


@query("numeric_feature_join", _with(fx.TARGET_CPF, fx.FEAT_ROOT) + f"""
SELECT {_A}, CAST(b.total AS DOUBLE) AS total, CAST(b.pedidos AS DOUBLE) AS pedidos
FROM target_cpf a LEFT JOIN feat_root b ON {_ON_ROOT} WHERE {_IN_ROOT}""")
def numeric_join(spark: SparkSession, sf: str) -> DataFrame:
    return plain(numeric_feature_join(fx.target_cpf(spark, sf), fx.feat_root(spark, sf), ROOT,
                                      months=_ROOT_MONTHS))


@query("numeric_join_pipeline", _with(fx.TARGET_CPF, fx.FEAT_ROOT, fx.FEAT_FULL) + f""",
a AS (SELECT t AS "table", s AS status, a.anomes, cpf FROM target_cpf a
  CROSS JOIN (VALUES ('db.feat_root', 'done'), ('db.feat_full', 'done'),
                     ('db.feat_text', 'skipped')) v(t, s) WHERE {_IN_ROOT})
SELECT "table", CAST(anomes AS VARCHAR) AS month, status,
  CASE WHEN status = 'done' THEN count(*) END AS rows FROM a GROUP BY "table", anomes, status
""".replace(") ,", "),"))
def numeric_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    rows = [("db.feat_root", "RAIZ", 8, "SAFRA", "int", "M-1"),
            ("db.feat_full", "CPF", 11, "SAFRA", "int", "M"),
            ("db.feat_text", "RAIZ", 8, "SAFRA", "int", "M-1")]
    features = {"db.feat_root": fx.feat_root(spark, sf), "db.feat_full": fx.feat_full(spark, sf),
                "db.feat_text": fx.feat_root(spark, sf).select("raiz", "safra", "prioridade")}
    status = numeric_join_pipeline(
        fx.target_cpf(spark, sf), features,
        feature_keys(spark.createDataFrame(rows, list(ROOT_METADATA))), months=_ROOT_MONTHS,
        out=scratch_path(spark, "numeric"), name="publico")
    return status.select("table", "month", "status", "rows")


@query("numeric_columns", _with(fx.TARGET_CPF, fx.FEAT_ROOT) +
       "SELECT CAST(total AS DOUBLE) AS total, pedidos FROM feat_root")
def numbers(spark: SparkSession, sf: str) -> DataFrame:
    features = fx.feat_root(spark, sf)
    return plain(features.select(*numeric_columns(features, ("raiz", "safra"))))


@query("document_root", _with(fx.TARGET_CPF) +
       "SELECT cpf, substr(CAST(cpf AS VARCHAR), 1, 8) AS root, "
       "substr(lpad(CAST(cpf // 1000 AS VARCHAR), 11, '0'), 1, 8) AS padded FROM target_cpf")
def roots(spark: SparkSession, sf: str) -> DataFrame:
    short = F.floor(F.col("cpf") / 1000)
    return fx.target_cpf(spark, sf).select(
        "cpf", document_root(F.col("cpf")).alias("root"),
        document_root(short, pad=True).alias("padded"))
