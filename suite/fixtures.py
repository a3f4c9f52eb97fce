"""Input tables of the queries, derived from the given tables; each also as a SQL CTE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.functions.months import month_of

REF = "200012"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def money(column: str) -> F.Column:
    return F.col(column).cast("decimal(18,2)")


def tx(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as customer transactions."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("cpf"), month_of("o_orderdate").alias("anomes"),
        money("o_totalprice").alias("valor_transacao"),
        F.col("o_orderpriority").alias("tipo_transacao"),
        F.col("o_orderstatus").alias("canal"))


TX = """tx AS (SELECT o_custkey AS cpf, strftime(o_orderdate, '%Y%m') AS anomes,
  CAST(o_totalprice AS DECIMAL(18,2)) AS valor_transacao,
  o_orderpriority AS tipo_transacao, o_orderstatus AS canal FROM orders)"""


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    # Both sides of this join grow with the data; it is left to adaptive execution.
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def tx_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as payments and invoices."""
    price, rate = money("l_extendedprice"), lambda c: F.col(c).cast("decimal(4,2)")
    return _lines(spark, sf).select(
        F.col("o_custkey").alias("cpf"), month_of("l_shipdate").alias("anomes"),
        (price * (1 - rate("l_discount"))).alias("valor_pago"),
        (price * (1 + rate("l_tax"))).alias("valor_fatura"),
        F.col("l_quantity").cast("decimal(18,2)").alias("qtd_transacoes"),
        F.col("l_linenumber").alias("qtd_dias"))


TX_LINES = """tx_lines AS (SELECT o_custkey AS cpf, strftime(l_shipdate, '%Y%m') AS anomes,
  CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS valor_pago,
  CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS valor_fatura,
  CAST(l_quantity AS DECIMAL(18,2)) AS qtd_transacoes, l_linenumber AS qtd_dias
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def cartao(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as credit-card months: use, limit, payment and days late."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return _lines(spark, sf).select(
        F.col("o_custkey").alias("cpf"), month_of("l_shipdate").alias("anomes"),
        (price * discount).alias("vl_utilizado"),
        F.when(F.col("l_tax") == 0, 0.0).otherwise(price).alias("vl_limite"),
        (price * (1 - discount)).alias("vl_pagamento"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("fl_atraso"),
        F.greatest(F.datediff("l_shipdate", "o_orderdate"), F.lit(0)).alias("dias_atraso"))


CARTAO = """cartao AS (SELECT o_custkey AS cpf, strftime(l_shipdate, '%Y%m') AS anomes,
  l_extendedprice * l_discount AS vl_utilizado,
  CASE WHEN l_tax = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS vl_limite,
  l_extendedprice * (1 - l_discount) AS vl_pagamento,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS fl_atraso,
  greatest(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)), 0)
    AS dias_atraso
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def main_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Population: one row per customer and month, all months."""
    orders = table(spark, sf, "orders")
    return orders.groupBy(F.col("o_custkey").cast("string").alias("document_id"),
                          month_of("o_orderdate").alias("date_yyyymm")).agg(
        F.max(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("y"))


MAIN_DOCUMENTS = """main_documents AS (SELECT CAST(o_custkey AS VARCHAR) AS document_id,
  strftime(o_orderdate, '%Y%m') AS date_yyyymm,
  max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS y FROM orders GROUP BY ALL)"""


def feature_table_1(spark: SparkSession, sf: str) -> DataFrame:
    """Order features per customer and month; text keys."""
    return table(spark, sf, "orders").groupBy(
        F.col("o_custkey").cast("string").alias("doc"),
        month_of("o_orderdate").alias("mes")).agg(
        F.sum(money("o_totalprice")).alias("score"),
        F.max(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("flag"),
        F.count(F.lit(1)).alias("amount"), F.max("o_orderpriority").alias("category"))


FEATURE_TABLE_1 = """feature_table_1 AS (SELECT CAST(o_custkey AS VARCHAR) AS doc,
  strftime(o_orderdate, '%Y%m') AS mes, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS score,
  max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS flag, count(*) AS amount,
  max(o_orderpriority) AS category FROM orders GROUP BY ALL)"""


def feature_table_2(spark: SparkSession, sf: str) -> DataFrame:
    """Line-item features per customer and ship month; number keys."""
    return _lines(spark, sf).groupBy(
        F.col("o_custkey").alias("id_cliente"),
        month_of("l_shipdate").cast("int").alias("safra")).agg(
        F.max("l_discount").alias("risk_level"), F.max("l_linenumber").alias("priority"),
        F.max("l_returnflag").alias("status"))


FEATURE_TABLE_2 = """feature_table_2 AS (SELECT o_custkey AS id_cliente,
  CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS safra, max(l_discount) AS risk_level,
  max(l_linenumber) AS priority, max(l_returnflag) AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""


def feature_table_3(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order: several per customer and month."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("doc"), month_of("o_orderdate").alias("mes"),
        money("o_totalprice").alias("value"), F.col("o_orderpriority").alias("rating"),
        F.col("o_orderstatus").alias("type"))


FEATURE_TABLE_3 = """feature_table_3 AS (SELECT CAST(o_custkey AS VARCHAR) AS doc,
  strftime(o_orderdate, '%Y%m') AS mes, CAST(o_totalprice AS DECIMAL(18,2)) AS value,
  o_orderpriority AS rating, o_orderstatus AS type FROM orders)"""


def target_cpf(spark: SparkSession, sf: str) -> DataFrame:
    """Population with an 11-digit document per order."""
    return table(spark, sf, "orders").select(
        (F.lit(10_000_000_000) + F.col("o_custkey") * 1000 + F.col("o_orderkey") % 1000)
        .alias("cpf"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"),
        month_of("o_orderdate").cast("int").alias("anomes"))


TARGET_CPF = """target_cpf AS (SELECT 10000000000 + o_custkey * 1000 + o_orderkey % 1000 AS cpf,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
  CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS anomes FROM orders)"""


def feat_root(spark: SparkSession, sf: str) -> DataFrame:
    """Features by the first eight digits of the document; one text column."""
    return table(spark, sf, "orders").groupBy(
        (F.lit(10_000_000) + F.col("o_custkey")).alias("raiz"),
        month_of("o_orderdate").cast("int").alias("safra")).agg(
        F.sum(money("o_totalprice")).alias("total"), F.count(F.lit(1)).alias("pedidos"),
        F.max("o_orderpriority").alias("prioridade"))


FEAT_ROOT = """feat_root AS (SELECT 10000000 + o_custkey AS raiz,
  CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS safra,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS pedidos,
  max(o_orderpriority) AS prioridade FROM orders GROUP BY ALL)"""


def feat_full(spark: SparkSession, sf: str) -> DataFrame:
    """Features by the whole document."""
    return target_cpf(spark, sf).groupBy("cpf", F.col("anomes").alias("safra")).agg(
        F.max("y").alias("y_max"), F.count(F.lit(1)).alias("linhas"))


FEAT_FULL = """feat_full AS (SELECT cpf, anomes AS safra, max(y) AS y_max, count(*) AS linhas
  FROM target_cpf GROUP BY ALL)"""


def model_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer as a model table; month int, target 0/1."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        month_of("o_orderdate").cast("int").alias("month"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("target"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"),
        "c_acctbal", "c_nationkey", money("o_totalprice").alias("price_decimal"),
        "o_orderpriority", "c_mktsegment", "o_orderdate")


MODEL_TABLE = """model_table AS (SELECT
  CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price,
  c_acctbal, c_nationkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price_decimal,
  o_orderpriority, c_mktsegment, o_orderdate
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""

CUTOFF = 199912


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a score, a label, and a train part by time."""
    return table(spark, sf, "events").select(
        "event_id", F.col("value").alias("score"), "event_type",
        (F.col("event_type") == "purchase").alias("label"),
        (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")).alias("is_train"))


SCORES = """scores AS (SELECT event_id, value AS score, event_type,
  event_type = 'purchase' AS label, ts < TIMESTAMP '2024-01-20' AS is_train FROM events)"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their true status, a rule's prediction and a score, per nation."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    price = F.col("o_totalprice")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("c_nationkey").cast("bigint").alias("table"),
        F.col("o_orderstatus").alias("actual"),
        F.when(price > 300000, "F").when(price > 150000, "O").otherwise("P").alias("predicted"),
        price.alias("score"))


PREDICTIONS = """predictions AS (SELECT CAST(c_nationkey AS BIGINT) AS "table",
  o_orderstatus AS actual, CASE WHEN o_totalprice > 300000 THEN 'F'
    WHEN o_totalprice > 150000 THEN 'O' ELSE 'P' END AS predicted, o_totalprice AS score
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def causal(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as loans: discount as treatment, price and tax as outcomes."""
    def mean(c: str) -> F.Column:
        return F.sum(F.col(c).cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))

    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        (mean("l_discount") * 100).alias("t"), mean("l_tax").alias("y2"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"),
        F.count(F.lit(1)).cast("double").alias("lines"))
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return (lines.join(orders, lines.id == orders.o_orderkey)
            .join(customer, orders.o_custkey == customer.c_custkey)
            .select("id", (F.col("o_totalprice") / 1000).alias("y"), "t", "y2",
                    F.col("c_acctbal").alias("balance"), "quantity", "lines",
                    F.col("c_mktsegment").alias("segment"),
                    F.col("o_orderdate").alias("time")))


CAUSAL = """causal AS (SELECT id, o_totalprice / 1000 AS y, t, y2, c_acctbal AS balance,
  quantity, lines, c_mktsegment AS segment, o_orderdate AS time
  FROM (SELECT l_orderkey AS id,
      CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 100 AS t,
      CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS y2,
      CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
      CAST(count(*) AS DOUBLE) AS lines FROM lineitem GROUP BY l_orderkey) l
  JOIN orders ON id = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def effects(spark: SparkSession, sf: str) -> DataFrame:
    """The causal table with an effect per row, as a formula of its columns."""
    return causal(spark, sf).withColumn(
        "effect", F.col("t") * 0.3 - F.col("balance") / 1000 + F.col("quantity") / 50)


EFFECTS = CAUSAL + """, effects AS (SELECT *,
  t * 0.3::DOUBLE - balance / 1000 + quantity / 50 AS effect FROM causal)"""


def loans(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as loans: price, part paid, rate and length from the order's own columns."""
    return causal(spark, sf).select(
        "id", F.round(F.col("y") * 1000, 2).alias("price"),
        F.round("y2", 4).alias("down_payment"), F.round("t", 4).alias("rate"), F.col("lines").alias("base_rate"),
        F.col("quantity").alias("months"), "balance")


LOANS = CAUSAL + """, loans AS (SELECT id, round(y * 1000, 2) AS price,
  round(y2, 4) AS down_payment, round(t, 4) AS rate,
  lines AS base_rate, quantity AS months, balance FROM causal)"""
