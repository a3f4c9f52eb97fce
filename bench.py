"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of local threads.
Each query is built and run to the end (every row and column is made, none is kept).
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.functions.months import month_of
from monthbook.operators.book import BookSpec, category_book, feature_book
from monthbook.session import build_session, clear_scratch
from suite import all_queries
from suite.fixtures import REF, _lines

NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
TEXTS = ("l_returnflag", "l_linestatus", "o_orderpriority", "o_orderstatus")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATUSES = ("F", "O", "P")
FLAGS = ("A", "N", "R")
LINES = tuple(str(i) for i in range(1, 8))


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select(
        F.col("o_custkey").alias("cpf"), month_of("l_shipdate").alias("anomes"), *NUMERIC,
        *TEXTS, F.col("l_linenumber").cast("string").alias("line"))


def wide_books() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = BookSpec(numeric=NUMERIC, categorical=TEXTS,
                     aggregations=("sum", "avg", "max", "min", "count", "std"))
    pipeline = BookSpec(numeric=NUMERIC, categorical=TEXTS[:3], windows=(1, 3, 6, 12, 24))
    churn = BookSpec(
        numeric=NUMERIC,
        value_counts={"o_orderpriority": PRIORITIES, "o_orderstatus": STATUSES, "line": LINES},
        ratios={"l_quantity": ["l_extendedprice", "l_tax"],
                "l_extendedprice": ["l_quantity", "l_tax"], "l_discount": "l_tax"})
    fraud = BookSpec(
        windows=(1, 7, 30),
        value_counts={"o_orderpriority": PRIORITIES, "o_orderstatus": STATUSES, "line": LINES,
                      "l_returnflag": FLAGS, "l_linestatus": ("F", "O", "X", "Y", "Z")})
    segments = BookSpec(
        windows=(3, 6, 12),
        value_counts={"o_orderpriority": PRIORITIES, "line": LINES, "o_orderstatus": STATUSES,
                      "l_returnflag": FLAGS, "l_linestatus": ("F",)})
    return {
        "book_128": lambda s, sf: feature_book(_rows(s, sf), every, REF),
        "book_130": lambda s, sf: feature_book(_rows(s, sf), pipeline, REF),
        "book_220": lambda s, sf: feature_book(_rows(s, sf), churn, REF),
        "counts_207": lambda s, sf: category_book(_rows(s, sf), fraud, REF),
        "counts_171": lambda s, sf: category_book(_rows(s, sf), segments, REF),
    }


HEADLINE = ("feature_book", "book_nunique", "book_breaks", "book_extra_agg", "risk_book",
            "master_table", "lagged_join_fanout", "root_join", "validation_report_all",
            "duplicate_keys", "roc_auc", "roc_auc_ovr", "classification_metrics",
            "quantile_bins", "linear_dml", "dr_learner", "temporal_ate", "normalize_text")
#: Tree models and the other slow ones; timed after the headline and not part of its total.
TREES = ("train_gbt", "run_models", "forest_dml", "x_learner", "lasso_dml", "bootstrap_ci",
         "causal_report")


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    jobs = {**wide_books(), **{name: known[name] for name in HEADLINE}}
    spark.read.parquet(f"{sf}/orders.parquet").groupBy("o_orderstatus").count().collect()

    def timed(names: dict) -> dict[str, float]:
        times = {}
        for name, run in names.items():
            start = time.perf_counter()
            run(spark, sf).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
            print(name, times[name], file=sys.stderr, flush=True)
            clear_scratch(spark)
        return times

    first, again = timed(jobs), timed(jobs)
    trees = timed({name: known[name] for name in TREES})
    print(json.dumps({"metric": "headline_total", "value": round(sum(first.values()), 3),
                      "unit": "sec", "queries": first, "again": again, "trees": trees,
                      "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
