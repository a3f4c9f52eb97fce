"""Model pipeline: one classifier per table, with metrics, importances and reports."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.operators.metrics import GAP_LIMITS, overfit_gap
from monthbook.operators.parallel import side_by_side
from monthbook.operators.prep import model_columns, split_by_date
from monthbook.operators.reports import (
    compare_models, feature_dictionary, summary_report, topk_features)
from monthbook.operators.training import (
    BoosterSettings, evaluate, feature_importance, score, train)
from monthbook.sources.tables import read_table, table_stem, write_csv, write_json

_RESULTS = ("table string, status string, error string, train_samples long, "
            "test_samples long, total_features int, n_categorical int, n_classes int, "
            "best_iteration int, accuracy double, precision double, recall double, f1 double, "
            "roc_auc double, test_ks double, train_roc_auc double, train_ks double")
_IMPORTANCES = "table string, feature string, importance double"


@dataclass(frozen=True)
class ModelRuns:
    """Results of all tables; each frame has one row per table or per feature."""

    results: DataFrame
    importances: DataFrame
    top: DataFrame

    def dictionary(self) -> DataFrame:
        """``{table: top features}``, empty for failed tables."""
        return feature_dictionary(self.top, self.results)

    def summary(self) -> DataFrame:
        """One row per table that worked, best accuracy first."""
        return summary_report(self.results, self.top)


def run_models(spark: SparkSession, tables: Mapping[str, DataFrame] | Sequence[str], *,
               target: str, month: str, cutoff: int, top_k: int = 10,
               settings: BoosterSettings = BoosterSettings(), at_once: int = 4,
               seconds: float | None = None) -> ModelRuns:
    """Trains and judges a model per table; a failing table is reported, not raised.

    ``at_once`` tables are trained side by side, each with its own scheduler pool and job group.
    A table that takes longer than ``seconds`` is cancelled and reported as failed.

    ``tables`` are DataFrames by name, or paths (CSV or Parquet) that are named by their file
    and read here, so that a file that cannot be read is reported too.  Only metrics and importances come back to the driver: a few numbers per table.
    """
    rows, importances = [], []
    named = (tables if isinstance(tables, Mapping)
             else {table_stem(path): path for path in tables})

    def run(source: DataFrame | str) -> tuple[dict, list[tuple[str, float]]]:
        df = read_table(spark, source) if isinstance(source, str) else source
        return _run_one(df, target, month, cutoff, settings)

    done = side_by_side(spark, {name: (lambda source=source: run(source))
                                for name, source in named.items()}, at_once, seconds, isolate=True)
    for name, result in done.items():
        if isinstance(result, Exception):  # one table must not stop the rest
            rows.append({"table": name, "status": "failed", "error": str(result)})
            continue
        row, found = result
        rows.append({"table": name, "status": "done", "error": None, **row})
        importances += [(name, feature, value) for feature, value in found]
    names = [part.split()[0] for part in _RESULTS.split(", ")]
    results = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], _RESULTS)
    for metric in ("roc_auc", "ks"):
        test = "roc_auc" if metric == "roc_auc" else "test_ks"
        results = overfit_gap(results, f"train_{metric}", test, metric, GAP_LIMITS["summary"])
    found = spark.createDataFrame(importances, _IMPORTANCES)
    return ModelRuns(results, found, topk_features(found, top_k))


def _run_one(df: DataFrame, target: str, month: str, cutoff: int,
             settings: BoosterSettings) -> tuple[dict, list[tuple[str, float]]]:
    train_rows, test_rows = split_by_date(df, month, cutoff)
    trained = train(train_rows, target, month, settings)
    columns = model_columns(df, target, month)
    test = evaluate(score(test_rows, trained, month), trained)
    seen = evaluate(score(train_rows, trained, month), trained)
    at = F.col(month).cast("int")
    sizes = df.agg(F.count_if(at <= cutoff).alias("a"), F.count_if(at > cutoff).alias("b")).first()
    return {
        "train_samples": sizes.a, "test_samples": sizes.b,
        "total_features": len(columns.features), "n_categorical": len(columns.categorical),
        "n_classes": len(trained.classes), "best_iteration": trained.rounds,
        **{k: test[k] for k in ("accuracy", "precision", "recall", "f1", "roc_auc")},
        "test_ks": test["ks"], "train_roc_auc": seen["roc_auc"], "train_ks": seen["ks"],
    }, feature_importance(trained)


def save_runs(runs: ModelRuns, out: str) -> None:
    """Results, importances and the comparison as JSON, the summary as CSV, and the feature map.

    ``features`` holds one JSON object ``{table: [features]}``, which ``load_feature_map`` reads.
    """
    write_json(runs.results, f"{out}/results")
    write_json(runs.importances, f"{out}/importances")
    write_json(compare_models(runs.results.where(F.col("status") == "done")),
               f"{out}/comparison")
    write_csv(runs.summary(), f"{out}/summary")
    # One row per table.
    found = {r["table"]: list(r["features"]) for r in runs.dictionary().collect()}
    text = runs.results.sparkSession.createDataFrame([(json.dumps(found),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{out}/features")
