"""Books from stored months, and sketches."""

import re

import pytest
from pyspark.sql import functions as F

from monthbook.functions.months import shift_month
from monthbook.operators.book import BookSpec, feature_book
from monthbook.operators.book_state import advance, month_state, save_state, state_months
from monthbook.operators.parallel import side_by_side, training_rows
from monthbook.sources.tables import write_partitions
from tests.test_books import AGGS, ROWS, _close

SPEC = BookSpec(numeric=["v", "w"], categorical=["c"], aggregations=AGGS, windows=(1, 3, 6),
                value_counts={"c": ["x", "q"]}, ratios={"v": ["w"]}, stamp_time=False,
                where="v IS NULL OR v > 0")


@pytest.fixture()
def many(spark):
    rows = [(None if i % 17 == 0 else "hot" if i % 3 == 0 else f"k{i % 40}", f"2023{i * 7 % 12 + 1:02d}",
             None if i % 11 == 0 else (i * 7919) % 1000 / 7, "xyz"[i % 3] if i % 5 else None,
             float(i % 4)) for i in range(3000)]
    return spark.createDataFrame(rows, "cpf string, anomes string, v double, c string, w double")


@pytest.fixture()
def source(spark, many, tmp_path):
    write_partitions(many, str(tmp_path / "tx"), "anomes")
    return spark.read.schema(many.schema).parquet(str(tmp_path / "tx"))


@pytest.mark.parametrize("sketches", [False, True])
def test_books_from_state_equal_books_from_rows(source, many, tmp_path, sketches):
    spec = SPEC if not sketches else BookSpec(
        numeric=["v"], categorical=["c"], windows=(1, 3), aggregations=("sum", "approx_median"),
        approx_distinct=True, stamp_time=False)
    state = str(tmp_path / "state")
    for ref in ("202308", "202309", "202312"):
        got = advance(source, spec, state, ref, flags=True)
        _close(got, feature_book(many, spec, ref, flags=True))
    # Only months of some window were made.
    widest = max(spec.windows)
    assert state_months(source.sparkSession, state)[0] == shift_month("202308", 1 - widest)


def test_next_book_reads_one_month(spark, source, many, tmp_path):
    state = str(tmp_path / "state")
    advance(source, SPEC, state, "202309")
    # Only October is there to be read.
    october = many.where("anomes = '202310'")
    _close(advance(october, SPEC, state, "202310"), feature_book(many, SPEC, "202310"))
    plan = month_state(source.where("anomes IN ('202310')"), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*anomes#\d+ = 202310", plan)
    assert plan.count("FileScan parquet") == 1


def test_months_made_again(spark, source, many, tmp_path):
    state = str(tmp_path / "state")
    early = source.where("c <> 'x' OR anomes <> '202309'")
    advance(early, SPEC, state, "202310")
    advance(source, SPEC, state, "202310")  # September is known, its late rows are not seen
    late = advance(source, SPEC, state, "202310", again=["202309"])
    _close(late, feature_book(many, SPEC, "202310"))
    # A month that is made again without rows is gone.
    save_state(source.where("false"), SPEC, state, ["202309"])
    gone = advance(source.where("anomes <> '202309'"), SPEC, state, "202310")
    _close(gone, feature_book(many.where("anomes <> '202309'"), SPEC, "202310"))


def test_integer_months_and_null_keys(spark, tmp_path):
    tx = spark.createDataFrame(ROWS, "cpf string, anomes string, v double, c string")
    spec = BookSpec(numeric=["v"], categorical=["c"], windows=(1, 3), stamp_time=False)
    for k, rows in enumerate((tx, tx.withColumn("anomes", F.col("anomes").cast("int")))):
        got = advance(rows, spec, str(tmp_path / f"state{k}"), "202402")
        _close(got, feature_book(rows, spec, "202402"))


def test_state_refuses_what_months_cannot_give(many):
    for spec in (BookSpec(numeric=["v"], aggregations=("skewness",)),
                 BookSpec(numeric=["v"], extra=[lambda inside, n: []])):
        with pytest.raises(ValueError):
            month_state(many, spec)


@pytest.mark.parametrize("by_month", [True, False])
def test_books_read_the_source_once(source, by_month):
    for spec in (SPEC, BookSpec(categorical=["c"], windows=(1, 3), by_month=by_month),
                 BookSpec(numeric=["v"], categorical=["c"], by_month=by_month, approx_distinct=True,
                          aggregations=("sum", "approx_median"), windows=(1, 3))):
        plan = feature_book(source, spec, "202312")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1


@pytest.mark.parametrize("by_month", [True, False])
def test_sketch_errors(spark, by_month):
    rows = spark.range(120_000).select(
        F.lit("hot").alias("cpf"), F.format_string("2023%02d", F.col("id") % 12 + 1).alias("anomes"),
        (F.col("id") * 7919 % 60_000).cast("double").alias("v"),
        (F.col("id") * 7919 % 60_000).cast("string").alias("c"))
    spec = BookSpec(numeric=["v"], categorical=["c"], windows=(1, 12), aggregations=("approx_median",),
                    approx_distinct=True, stamp_time=False, by_month=by_month)
    row = feature_book(rows, spec, "202312").first()
    assert abs(row.c_nunique_12m / 60_000 - 1) < 0.05
    exact = rows.where("anomes = '202312'").select("c").distinct().count()
    assert abs(row.c_nunique_1m / exact - 1) < 0.05
    # The values are even, so a value is its rank.
    assert abs(row.v_approx_median_12m / 60_000 - 0.5) < 0.015


def test_side_by_side(spark):
    assert side_by_side(spark, {}) == {}
    work = {str(k): (lambda k=k: spark.range(k).count()) for k in range(6)}
    assert side_by_side(spark, work, most=3) == {str(k): k for k in range(6)}

    def fail():
        raise KeyError("no")

    with pytest.raises(KeyError):
        side_by_side(spark, work | {"bad": fail})
    found = side_by_side(spark, {"bad": fail, **work}, isolate=True)
    assert isinstance(found["bad"], KeyError) and found["5"] == 5


def test_stragglers_are_cancelled(spark):
    def slow():
        wait = F.udf(lambda k: __import__("time").sleep(60) or k, "bigint")
        return spark.range(1).select(wait("id")).collect()

    found = side_by_side(spark, {"slow": slow, "quick": lambda: spark.range(3).count()},
                         seconds=2.0, isolate=True)
    assert isinstance(found["slow"], TimeoutError) and found["quick"] == 3


def test_training_rows_are_packed(spark):
    rows = training_rows(spark.range(1000).repartition(8))
    assert rows.rdd.getNumPartitions() == 1 and rows.count() == 1000
    wide = training_rows(spark.range(1000).repartition(8), rows_per_task=200)
    assert wide.rdd.getNumPartitions() == 5
    whole = training_rows(spark.range(1000).repartition(8), rows_per_task=1)
    assert whole.rdd.getNumPartitions() == 8
