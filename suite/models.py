"""Model preparation, metrics, rankings, training and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthbook.operators import metrics as m
from monthbook.operators import prep, reports
from monthbook.operators.training import BoosterSettings, feature_importance, score, train
from monthbook.operators.joins import master_table
from monthbook.plans.model_pipeline import ModelRuns, run_models, save_runs
from monthbook.session import scratch_path
from monthbook.sources.tables import FeatureKeys, load_feature_map
from suite import fixtures as fx
from suite.registry import plain, query

MODEL = f"WITH {fx.MODEL_TABLE} "
_DIRECT = ("price", "c_acctbal", "o_orderpriority", "c_mktsegment")


@query("split_by_date", MODEL + f"""SELECT 'train' AS part, CAST(month AS BIGINT) AS month,
  count(*) AS n FROM model_table WHERE month <= {fx.CUTOFF} GROUP BY month
UNION ALL SELECT 'test', month, count(*) FROM model_table WHERE month > {fx.CUTOFF}
GROUP BY month""")
def split(spark: SparkSession, sf: str) -> DataFrame:
    parts = prep.split_by_date(fx.model_table(spark, sf), "month", fx.CUTOFF)
    made = [p.groupBy("month").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(name).alias("part"), "month", "n")
            for name, p in zip(("train", "test"), parts)]
    return plain(made[0].unionByName(made[1]))


@query("split_ranges", MODEL + f"""SELECT 'train' AS part, CAST(min(month) AS BIGINT)
  AS first_month, CAST(max(month) AS BIGINT) AS last_month FROM model_table
  WHERE month <= {fx.CUTOFF}
UNION ALL SELECT 'test', min(month), max(month) FROM model_table WHERE month > {fx.CUTOFF}""")
def ranges(spark: SparkSession, sf: str) -> DataFrame:
    return plain(prep.split_ranges(fx.model_table(spark, sf), "month", fx.CUTOFF))


@query("feature_selection", MODEL + "SELECT price, c_acctbal, CAST(c_nationkey AS BIGINT) "
       "AS c_nationkey, CAST(price_decimal AS DOUBLE) AS price_decimal, o_orderpriority, "
       "c_mktsegment, CAST(target AS BIGINT) AS target, CAST(month AS BIGINT) AS month "
       "FROM model_table")
def selection(spark: SparkSession, sf: str) -> DataFrame:
    return plain(prep.model_frame(fx.model_table(spark, sf), "target", "month"))


def _index_sql(column: str) -> str:
    return (f"(SELECT {column} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) "
            f"- 1 AS DOUBLE) AS i FROM model_table GROUP BY {column})")


@query("encode_features", MODEL + f"""SELECT CAST(month AS BIGINT) AS month,
  CAST(target AS BIGINT) AS target, p.i AS o_orderpriority_index, s.i AS c_mktsegment_index,
  coalesce(price, -999999.0::DOUBLE) AS price_filled,
  CASE WHEN price IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS price_is_null
FROM model_table JOIN {_index_sql('o_orderpriority')} p ON p.v = o_orderpriority
JOIN {_index_sql('c_mktsegment')} s ON s.v = c_mktsegment""")
def encode(spark: SparkSession, sf: str) -> DataFrame:
    frame = prep.model_frame(fx.model_table(spark, sf), "target", "month")
    fitted = prep.fit_encoding(frame, prep.model_columns(frame, "target", "month"))
    return plain(fitted.transform(frame).select(
        "month", "target", "o_orderpriority_index", "c_mktsegment_index", "price_filled",
        "price_is_null"))


_MANY = """WITH rows_ AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL
  ELSE 'c' || (o_custkey * 7 % 331) END AS c FROM orders)"""


@query("encode_many_categories", _MANY + """, ranked AS (
  SELECT c, row_number() OVER (ORDER BY count(*) DESC, c) - 1 AS i FROM rows_
  WHERE c IS NOT NULL GROUP BY c), size AS (SELECT least(count(*), 256) AS n FROM ranked)
SELECT o_orderkey, CAST(CASE WHEN r.c IS NULL THEN n WHEN i < 256 THEN i ELSE n + 1 END AS DOUBLE)
  AS c_index FROM rows_ r LEFT JOIN ranked k ON r.c = k.c CROSS JOIN size""")
def encode_many(spark: SparkSession, sf: str) -> DataFrame:
    """More categories than bins, and missing ones: the commonest keep an index of their own."""
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.concat(
            F.lit("c"), (F.col("o_custkey") * 7 % 331).cast("string"))).alias("c"))
    fitted = prep.fit_encoding(rows, prep.ModelColumns(("c",), ("c",), (), ()))
    return plain(fitted.transform(rows).select("o_orderkey", "c_index"))


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("one_hot", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1::BIGINT ELSE 0::BIGINT END AS \"c_mktsegment_{s}\""
    for s in _SEGMENTS[1:]) + " FROM customer")
def dummies(spark: SparkSession, sf: str) -> DataFrame:
    customers = fx.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return plain(prep.one_hot(customers, ["c_mktsegment"]))


@query("standardise", "SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / "
       "stddev_pop(c_acctbal) OVER (), 8) AS c_acctbal FROM customer")
def scaled(spark: SparkSession, sf: str) -> DataFrame:
    customers = fx.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return plain(prep.standardise(customers, ["c_acctbal"]), 8, ("c_acctbal",))


@query("clip_columns", "SELECT event_id, least(greatest(value, 3.5), 18.0) AS value FROM events")
def clipped(spark: SparkSession, sf: str) -> DataFrame:
    events = fx.table(spark, sf, "events").select("event_id", "value")
    return prep.clip_columns(events, {"value": (3.5, 18.0)})


# --- metrics ----------------------------------------------------------------------------

@query("class_distribution", MODEL + f"""SELECT CAST(target AS BIGINT) AS class,
  count(*) FILTER (month <= {fx.CUTOFF}) AS train_rows,
  count(*) FILTER (month > {fx.CUTOFF}) AS test_rows FROM model_table GROUP BY target""")
def classes(spark: SparkSession, sf: str) -> DataFrame:
    return plain(m.class_distribution(fx.model_table(spark, sf), "target",
                                      F.col("month") <= fx.CUTOFF))


PRED = f"WITH {fx.PREDICTIONS}"


@query("confusion_matrix", PRED + " SELECT actual, " + ", ".join(
    f"count(*) FILTER (predicted = '{c}') AS \"predicted_{c}\"" for c in "FOP")
    + " FROM predictions GROUP BY actual")
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return m.confusion_matrix(fx.predictions(spark, sf), "actual", "predicted", list("FOP"))


def _class_metrics_sql(by: str = "") -> str:
    keys, using = (f"{by}, ", f"USING ({by}, class)") if by else ("", "USING (class)")
    group = f"GROUP BY {by}" if by else ""
    return f"""
, a AS (SELECT {keys}actual AS class, count(*) AS actual,
    count(*) FILTER (actual = predicted) AS hits FROM predictions GROUP BY {keys}actual)
, p AS (SELECT {keys}predicted AS class, count(*) AS predicted FROM predictions
    GROUP BY {keys}predicted)
, c AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS precision_,
    coalesce(hits / nullif(actual, 0), 0) AS recall_ FROM a LEFT JOIN p {using})
, class_metrics AS (SELECT {keys}sum(hits) / sum(actual) AS accuracy,
    sum(precision_ * actual) / sum(actual) AS "precision",
    sum(recall_ * actual) / sum(actual) AS recall,
    sum(coalesce(2 * precision_ * recall_ / nullif(precision_ + recall_, 0), 0) * actual)
      / sum(actual) AS f1 FROM c {group})"""


@query("classification_metrics", PRED + _class_metrics_sql() + """
SELECT round(accuracy, 10) AS accuracy, round("precision", 10) AS "precision",
  round(recall, 10) AS recall, round(f1, 10) AS f1 FROM class_metrics""")
def class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    got = m.classification_metrics(fx.predictions(spark, sf), "actual", "predicted")
    return plain(got, 10, ("accuracy", "precision", "recall", "f1"))


def _curve_sql(source: str, label: str, by: str = "", score_: str = "score") -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
, by_score AS (SELECT {keys}{score_} AS s, count(*) FILTER ({label}) AS pos,
    count(*) FILTER (NOT ({label})) AS neg FROM {source} GROUP BY {keys}{score_})
, running AS (SELECT *, sum(pos) OVER ({part}ORDER BY s) AS cp,
    sum(neg) OVER ({part}ORDER BY s) AS cn FROM by_score)
, total AS (SELECT {keys}sum(pos) AS np, sum(neg) AS nn FROM by_score {group})
, curve AS (SELECT {keys}sum(pos * (cn - neg / 2.0)) / (max(np) * max(nn)) AS roc_auc,
    max(abs(cp / np - cn / nn)) AS ks, max(np) AS np
    FROM running {'JOIN total USING (' + by + ')' if by else 'CROSS JOIN total'} {group})"""


SCORE = f"WITH {fx.SCORES}"


@query("roc_auc", SCORE + _curve_sql("scores", "label")
       + " SELECT round(CAST(roc_auc AS DOUBLE), 10) AS roc_auc FROM curve")
def auc(spark: SparkSession, sf: str) -> DataFrame:
    return plain(m.roc_auc(fx.scores(spark, sf), F.col("label"), "score"), 10, ("roc_auc",))


@query("ks_statistic", SCORE + _curve_sql("scores", "label")
       + " SELECT round(CAST(ks AS DOUBLE), 10) AS ks FROM curve")
def ks(spark: SparkSession, sf: str) -> DataFrame:
    return plain(m.ks_statistic(fx.scores(spark, sf), F.col("label"), "score"), 10, ("ks",))


_TYPES = ("click", "error", "purchase", "signup", "view")


@query("roc_auc_ovr", SCORE + f""", long AS (SELECT t AS class,
  abs(score - k * 10) AS score, event_type = t AS label FROM scores,
  (VALUES {', '.join(f"('{t}', {i})" for i, t in enumerate(_TYPES))}) v(t, k))"""
       + _curve_sql("long", "label", "class") + " SELECT round(CAST(sum(roc_auc * np) / sum(np) "
       "AS DOUBLE), 10) AS roc_auc_ovr FROM curve")
def auc_ovr(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.scores(spark, sf)
    for i, t in enumerate(_TYPES):
        rows = rows.withColumn(f"s_{t}", F.abs(F.col("score") - F.lit(i * 10)))
    got = m.roc_auc_ovr(rows, "event_type", {t: f"s_{t}" for t in _TYPES})
    return plain(got, 10, ("roc_auc_ovr",))


@query("overfit_gap", SCORE + _curve_sql("scores", "label", "is_train") + """
, pair AS (SELECT max(roc_auc) FILTER (is_train) AS train_roc_auc,
    max(roc_auc) FILTER (NOT is_train) AS test_roc_auc, max(ks) FILTER (is_train) AS train_ks,
    max(ks) FILTER (NOT is_train) AS test_ks FROM curve)
, gaps AS (SELECT abs(train_roc_auc - test_roc_auc) AS g, abs(train_ks - test_ks) AS h FROM pair)
SELECT round(CAST(g AS DOUBLE), 10) AS overfitting_roc_auc, CASE WHEN g < 0.05 THEN 'Low'
    WHEN g < 0.1 THEN 'Moderate' ELSE 'High' END AS overfitting_roc_auc_level,
  round(CAST(h AS DOUBLE), 10) AS overfitting_ks, CASE WHEN h < 0.03 THEN 'Low'
    WHEN h < 0.07 THEN 'Moderate' ELSE 'High' END AS overfitting_ks_level FROM gaps""")
def gaps(spark: SparkSession, sf: str) -> DataFrame:
    curve = m.binary_curve_metrics(fx.scores(spark, sf), F.col("label"), "score", ["is_train"])
    pair = curve.agg(*[F.max(F.when(F.col("is_train") == part, F.col(v))).alias(f"{name}_{v}")
                       for v in ("roc_auc", "ks")
                       for name, part in (("train", True), ("test", False))])
    wide = m.overfit_gap(pair, "train_roc_auc", "test_roc_auc", "roc_auc")
    wide = m.overfit_gap(wide, "train_ks", "test_ks", "ks", m.GAP_LIMITS["chart"])
    wide = wide.select(*[c for c in wide.columns if c.startswith("overfitting_")])
    return plain(wide, 10, ("overfitting_roc_auc", "overfitting_ks"))


# --- rankings ---------------------------------------------------------------------------

def _model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of a price rule, one row per nation; half the nations have no AUC."""
    rows = fx.predictions(spark, sf)
    classed = m.classification_metrics(rows, "actual", "predicted", ["table"])
    curve = m.roc_auc(rows, F.col("actual") == "F", "score", ["table"])
    return classed.join(curve, "table").select(
        "table", F.round("accuracy", 2).alias("accuracy"), F.round("f1", 2).alias("f1"),
        F.when(F.col("table") > 11, F.round("roc_auc", 8)).alias("roc_auc"))


@query("compare_models", PRED + _class_metrics_sql('"table"')
       + _curve_sql("predictions", "actual = 'F'", '"table"') + """
, metrics AS (SELECT "table", round(accuracy, 2) AS accuracy, round(f1, 2) AS f1_score,
    CASE WHEN "table" > 11 THEN round(CAST(roc_auc AS DOUBLE), 8) ELSE 0.0 END AS roc_auc
    FROM class_metrics JOIN curve USING ("table"))
, ranked AS (SELECT *, dense_rank() OVER (ORDER BY accuracy DESC) AS rank_accuracy,
    dense_rank() OVER (ORDER BY f1_score DESC) AS rank_f1 FROM metrics)
SELECT *, (rank_accuracy + rank_f1) / 2 AS rank_overall FROM ranked""")
def compare(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.compare_models(_model_metrics(spark, sf)))


IMPORTANCES = """importances AS (SELECT c_mktsegment AS "table", n_name AS feature,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS importance
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL)"""


def _importances(spark: SparkSession, sf: str) -> DataFrame:
    """Turnover by segment and nation, standing in for importances by table and feature."""
    orders, customer = fx.table(spark, sf, "orders"), fx.table(spark, sf, "customer")
    nation = fx.table(spark, sf, "nation")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, customer.c_nationkey == nation.n_nationkey)
            .groupBy(F.col("c_mktsegment").alias("table"), F.col("n_name").alias("feature"))
            .agg(F.sum(fx.money("o_totalprice")).cast("double").alias("importance")))


@query("importance_normalised", f"""WITH {fx.TX}, {IMPORTANCES} SELECT "table", feature,
  round(importance / sum(importance) OVER (PARTITION BY "table"), 10) AS importance
FROM importances""")
def normalised(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.importance_normalised(_importances(spark, sf)), 10, ("importance",))


_TOP = f"""WITH {IMPORTANCES}, top AS (SELECT *, row_number() OVER (PARTITION BY "table"
  ORDER BY importance DESC, feature) AS rank FROM importances)"""


@query("topk_features", _TOP + " SELECT * FROM top WHERE rank <= 10")
def topk(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.topk_features(_importances(spark, sf), 10))


@query("feature_dictionary", _TOP + """
, names AS (SELECT DISTINCT c_mktsegment AS "table" FROM customer
    UNION SELECT DISTINCT o_orderpriority FROM orders)
SELECT "table", coalesce(string_agg(feature, ',' ORDER BY rank) FILTER (rank <= 5), '')
  AS features FROM names LEFT JOIN top USING ("table") GROUP BY "table" """)
def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    top = reports.topk_features(_importances(spark, sf), 5)
    tables = (fx.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("table"))
              .union(fx.table(spark, sf, "orders").select("o_orderpriority")).distinct())
    return reports.feature_dictionary(top, tables).select(
        "table", F.array_join("features", ",").alias("features"))


@query("top_rows", "SELECT o_orderkey, o_totalprice FROM orders "
       "ORDER BY o_totalprice DESC LIMIT 10")
def largest(spark: SparkSession, sf: str) -> DataFrame:
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return reports.top_rows(orders, "o_totalprice", 10)


# --- training (rows only) ---------------------------------------------------------------

FULL = BoosterSettings()


# What the trees find has no counterpart in SQL.  The parts around it have: rows, classes,
# features, failures, and scores that add up.
_SIZES = f"""count(*) FILTER (month <= {fx.CUTOFF}) AS train_samples,
  count(*) FILTER (month > {fx.CUTOFF}) AS test_samples"""


def _judged(results: DataFrame) -> DataFrame:
    inside = " AND ".join(f"{m} BETWEEN 0 AND 1" for m in ("accuracy", "f1", "roc_auc"))
    return plain(results.selectExpr(
        "table", "status", "n_classes", "train_samples", "test_samples", "total_features",
        f"CASE WHEN status = 'done' THEN {inside} END AS plausible"))


@query("train_gbt", MODEL + f"""SELECT 'orders' AS "table", 'done' AS status,
  CAST(2 AS BIGINT) AS n_classes, {_SIZES}, CAST(6 AS BIGINT) AS total_features,
  true AS plausible FROM model_table""")
def train_gbt(spark: SparkSession, sf: str) -> DataFrame:
    runs = run_models(spark, {"orders": fx.model_table(spark, sf)}, target="target",
                      month="month", cutoff=fx.CUTOFF, settings=FULL)
    return _judged(runs.results)


def _three_classes(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "orders")
    return rows.select(
        F.date_format("o_orderdate", "yyyyMM").cast("int").alias("month"),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1)
        .otherwise(2).alias("target"), "o_totalprice", "o_orderpriority")


@query("train_multiclass", f"""SELECT 'orders' AS "table", 'done' AS status,
  CAST(3 AS BIGINT) AS n_classes, {_SIZES}, CAST(2 AS BIGINT) AS total_features,
  true AS plausible
FROM (SELECT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month FROM orders)""")
def train_multiclass(spark: SparkSession, sf: str) -> DataFrame:
    runs = run_models(spark, {"orders": _three_classes(spark, sf)}, target="target",
                      month="month", cutoff=fx.CUTOFF,
                      settings=FULL)
    return _judged(runs.results)


@query("score_table", MODEL + f"""SELECT CAST(month AS BIGINT) AS month,
  CAST(target AS BIGINT) AS target, count(*) AS n, CAST(count(*) AS DOUBLE) AS total,
  count(*) AS of_a_class FROM model_table WHERE month > {fx.CUTOFF} GROUP BY month, target""")
def score_table(spark: SparkSession, sf: str) -> DataFrame:
    """Every later row gets a class and scores that add up to one."""
    early, late = prep.split_by_date(fx.model_table(spark, sf), "month", fx.CUTOFF)
    scored = score(late, train(early, "target", "month", FULL), "month")
    return plain(scored.groupBy("month", "target").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("score_0") + F.col("score_1")), 4)
        .alias("total"), F.count_if(F.col("prediction").isin(0, 1)).alias("of_a_class")))


@query("feature_importance", "SELECT CAST(6 AS BIGINT) AS features, 1.0::DOUBLE AS total, "
       "true AS positive")
def importance(spark: SparkSession, sf: str) -> DataFrame:
    early, _ = prep.split_by_date(fx.model_table(spark, sf), "month", fx.CUTOFF)
    rows = feature_importance(train(early, "target", "month", FULL))
    found = spark.createDataFrame(rows, "feature string, importance double")
    return found.agg(F.countDistinct("feature").alias("features"),
                     F.round(F.sum("importance"), 6).alias("total"),
                     F.bool_and(F.col("importance") >= 0).alias("positive"))


# Where the target is a rule of one column, trees must find exactly that rule: SQL knows the
# class of every row, the metrics and the feature.
def _ruled(spark: SparkSession, sf: str, target: Column) -> DataFrame:
    return fx.table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").cast("int").alias("month"), target.alias("target"),
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"))


def _rule(spark: SparkSession, sf: str) -> DataFrame:
    return _ruled(spark, sf, F.col("o_orderpriority").isin("1-URGENT", "4-NOT SPECIFIED").cast("int"))


def _confusion(rows: DataFrame) -> DataFrame:
    early, late = prep.split_by_date(rows, "month", fx.CUTOFF)
    scored = score(late, train(early, "target", "month", FULL), "month")
    return plain(scored.groupBy("month", "target", F.col("prediction").cast("int").alias(
        "prediction")).agg(F.count(F.lit(1)).alias("n")))


_RULE = "CAST(o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') AS BIGINT)"
_THREE = ("CASE o_orderpriority WHEN '3-MEDIUM' THEN 0 WHEN '1-URGENT' THEN 1 "
          "WHEN '5-LOW' THEN 1 ELSE 2 END")


def _confusion_sql(rule: str) -> str:
    return f"""SELECT month, target, target AS prediction, count(*) AS n FROM (
  SELECT CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS month, CAST({rule} AS BIGINT) AS target
  FROM orders) WHERE month > {fx.CUTOFF} GROUP BY month, target"""


@query("train_rule", _confusion_sql(_RULE))
def train_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Trained on a rule, the booster gives every later row its class."""
    return _confusion(_rule(spark, sf))


@query("train_rule_classes", _confusion_sql(_THREE))
def train_rule_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The same with three classes."""
    return _confusion(_ruled(spark, sf, F.expr(_THREE)))


@query("run_models_rule", f"""SELECT 'rule' AS "table", CAST(2 AS BIGINT) AS n_classes,
  count(*) FILTER (month <= {fx.CUTOFF}) AS train_samples,
  count(*) FILTER (month > {fx.CUTOFF}) AS test_samples, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS f1,
  1.0::DOUBLE AS roc_auc, 'priority' AS top_feature_1 FROM (
  SELECT CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS month FROM orders)""")
def run_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics and the best feature of a model that can be right everywhere."""
    runs = run_models(spark, {"rule": _rule(spark, sf)}, target="target", month="month",
                      cutoff=fx.CUTOFF, settings=FULL)
    return plain(runs.results.join(runs.summary().select("table", "top_feature_1"), "table").select(
        "table", "n_classes", "train_samples", "test_samples", "accuracy", "f1", "roc_auc",
        "top_feature_1"), 9, ("accuracy", "f1", "roc_auc"))


def _runs(spark: SparkSession, sf: str) -> ModelRuns:
    tables = {"orders": fx.model_table(spark, sf),
              "prices": fx.model_table(spark, sf).select("month", "target", "price"),
              "broken": fx.model_table(spark, sf).select("month", "price")}
    return run_models(spark, tables, target="target", month="month", cutoff=fx.CUTOFF,
                      settings=FULL)


@query("run_models", MODEL + f""", sizes AS (SELECT {_SIZES} FROM model_table)
SELECT t AS "table", s AS status, CAST(c AS BIGINT) AS n_classes,
  CASE WHEN s = 'done' THEN train_samples END AS train_samples,
  CASE WHEN s = 'done' THEN test_samples END AS test_samples,
  CAST(f AS BIGINT) AS total_features, CASE WHEN s = 'done' THEN true END AS plausible
FROM sizes CROSS JOIN (VALUES ('orders', 'done', 2, 6), ('prices', 'done', 2, 1),
                              ('broken', 'failed', NULL, NULL)) v(t, s, c, f)""")
def models(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(_runs(spark, sf).results)


@query("summary_report", """SELECT t AS "table", f AS top_features FROM (VALUES
  ('orders', CAST(3 AS BIGINT)), ('prices', CAST(1 AS BIGINT))) v(t, f)""")
def summary(spark: SparkSession, sf: str) -> DataFrame:
    """The tables that worked, with as many best features as they have, up to three."""
    made = _runs(spark, sf).summary()
    named = sum((F.col(f"top_feature_{i}").isNotNull().cast("bigint") for i in (1, 2, 3)),
                F.lit(0).cast("bigint"))
    return made.select("table", named.alias("top_features"))


@query("model_chain", f"""WITH {fx.MAIN_DOCUMENTS}, {fx.FEATURE_TABLE_1}
SELECT m.document_id, CAST(m.y AS BIGINT) AS y, m.date_yyyymm,
  CAST(f.score AS DOUBLE) AS ft_score, f.amount AS ft_amount
FROM main_documents m LEFT JOIN feature_table_1 f ON f.doc = m.document_id
  AND f.mes = strftime(strptime(m.date_yyyymm, '%Y%m') - INTERVAL 1 MONTH, '%Y%m')""")
def chain(spark: SparkSession, sf: str) -> DataFrame:
    """Trains on a feature table, saves the best features, loads them, builds a master table."""
    features = fx.feature_table_1(spark, sf)
    ready = features.select(F.col("mes").cast("int").alias("month"), F.col("flag").alias("target"),
                            F.col("score").cast("double").alias("score"), "amount")
    runs = run_models(spark, {"ft": ready}, target="target", month="month", cutoff=fx.CUTOFF,
                      settings=FULL)
    out = scratch_path(spark, "runs")
    save_runs(runs, out)
    table = master_table(
        fx.main_documents(spark, sf), {"ft": features},
        [FeatureKeys("ft", "doc", "mes", 1, unique=True)],
        load_feature_map(spark, f"{out}/features"), doc="document_id", month="date_yyyymm")
    return plain(table)
