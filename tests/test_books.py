"""Feature books: edge cases that the big queries do not reach."""

import datetime as dt
from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

from monthbook.operators.book import (
    BookSpec, break_book, break_books, category_book, cross_ratios, feature_book)
from monthbook.plans.book_pipeline import reference_month, run_book
from monthbook.plans.presets import BEHAVIOUR_PRESETS, MODEL_PRESETS, preset_book

ROWS = [
    ("a", "202401", 10.0, "x"), ("a", "202401", None, "x"), ("a", "202402", 5.0, None),
    ("b", "202402", None, "y"), (None, "202402", 7.0, "x"), (None, "202401", 1.0, "z"),
    ("c", "202312", 3.0, "x"), ("d", "202301", 9.0, "x"), ("e", "202403", 9.0, "x"),
    ("c", "202402", None, "x"), ("f", "202401", None, "w"),
]


@pytest.fixture()
def tx(spark):
    return spark.createDataFrame(ROWS, "cpf string, anomes string, v double, c string")


def _duck():
    con = duckdb.connect()
    con.execute("CREATE TABLE tx (cpf VARCHAR, anomes VARCHAR, v DOUBLE, c VARCHAR)")
    con.executemany("INSERT INTO tx VALUES (?, ?, ?, ?)", ROWS)
    return con


def test_null_keys_null_values_and_distinct_counts(tx):
    spec = BookSpec(numeric=["v"], categorical=["c"], windows=(1, 3), stamp_time=False,
                    aggregations=("sum", "avg", "count"), value_counts={"c": ["x", "z"]})
    got = feature_book(tx, spec, "202402")
    columns = []
    for n, start in ((1, "202402"), (3, "202312")):
        w = f"anomes >= '{start}' AND anomes <= '202402'"
        columns += [
            f"sum(CASE WHEN {w} THEN v ELSE 0 END) AS v_sum_{n}m",
            f"avg(CASE WHEN {w} THEN v END) AS v_avg_{n}m",
            f"count(CASE WHEN {w} THEN v END) AS v_count_{n}m",
            f"count(DISTINCT CASE WHEN {w} THEN c END) AS c_nunique_{n}m",
            f"count(CASE WHEN {w} THEN c END) AS c_count_{n}m"]
        for value in ("x", "z"):
            hit = f"sum(CASE WHEN {w} AND c = '{value}' THEN 1 ELSE 0 END)"
            rows = f"nullif(count(CASE WHEN {w} THEN 1 END), 0)"
            columns += [f"{hit} AS c_{value}_count_{n}m",
                        f"100.0 * {hit} / {rows} AS c_{value}_pct_{n}m"]
    found = _duck().execute(
        f"SELECT cpf, '202402' AS dt_referencia, {', '.join(columns)} FROM tx "
        "WHERE anomes >= '202312' AND anomes <= '202402' GROUP BY cpf")
    names = [d[0] for d in found.description]
    expected = {r[0]: dict(zip(names, r)) for r in found.fetchall()}
    assert {r.cpf: r.asDict() for r in got.collect()} == expected


def test_distinct_counts_need_no_expand(tx):
    spec = BookSpec(categorical=["c"], windows=(1, 3, 6))
    plan = feature_book(tx, spec, "202402")._jdf.queryExecution().toString()
    assert "Expand" not in plan


def test_month_range_and_filter_reach_the_scan(spark, tx, tmp_path):
    tx.write.partitionBy("anomes").parquet(str(tmp_path / "tx"))
    stored = spark.read.schema(tx.schema).parquet(str(tmp_path / "tx"))
    spec = BookSpec(numeric=["v"], windows=(1, 3), where="c = 'x' OR v > 6")
    plan = feature_book(stored, spec, "202402")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(anomes" in plan
    assert "(anomes#" in plan and ">= 202312" in plan


def test_integer_months(tx):
    spec = BookSpec(numeric=["v"], categorical=["c"], windows=(1, 3), stamp_time=False)
    as_int = tx.withColumn("anomes", F.col("anomes").cast("int"))
    a = feature_book(tx, spec, "202402").collect()
    b = feature_book(as_int, spec, "202402").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_sums_grow_with_the_window(spark):
    rows = [(str(i % 7), f"2023{i % 12 + 1:02d}", float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "cpf string, anomes string, v double")
    book = feature_book(df, BookSpec(numeric=["v"], windows=(1, 3, 6, 12)), "202312")
    for r in book.collect():
        assert r.v_sum_1m <= r.v_sum_3m <= r.v_sum_6m <= r.v_sum_12m


def test_exact_median_per_key(spark):
    rows = [("hot" if i % 3 else str(i % 5), "202401", float((i * 7919) % 1000))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "cpf string, anomes string, v double")
    book = feature_book(df, BookSpec(numeric=["v"], windows=(1,), aggregations=["median"]),
                        "202401")
    pdf = df.toPandas().groupby("cpf").v.median()
    assert {r.cpf: r.v_median_1m for r in book.collect()} == pdf.to_dict()


def test_unknown_aggregate_and_preset_are_refused(tx):
    with pytest.raises(ValueError):
        feature_book(tx, BookSpec(numeric=["v"], aggregations=["nope"]), "202402")
    with pytest.raises(ValueError):
        preset_book(tx, "nope", "202402")


def test_preset_widths():
    assert set(BEHAVIOUR_PRESETS) == {"churn", "cross_sell", "fraude"}
    assert set(MODEL_PRESETS) == {"credito", "fraude", "churn"}


def test_percent_is_between_0_and_100(tx):
    book = category_book(tx, BookSpec(value_counts={"c": ["x", "y", "z"]}, windows=(1, 3)),
                         "202402")
    shares = [r[c] for r in book.collect() for c in book.columns if "_pct_" in c]
    assert all(s is None or 0 <= s <= 100 for s in shares)


def test_breaks_joined_multiply_and_wide_does_not(tx):
    spec = BookSpec(numeric=["v"], windows=(3,), aggregations=["sum"], stamp_time=False)
    wide = break_books(tx, spec, "202402", ["c"])
    assert wide.count() == wide.select("cpf").distinct().count()
    joined = break_books(tx, spec, "202402", ["c"], shape="joined")
    a = [r for r in joined.collect() if r.cpf == "a"]
    assert {(r.c, r.c_v_sum_3m) for r in a} == {("x", 10.0), (None, 5.0)}
    with pytest.raises(ValueError):
        break_books(tx, spec, "202402", ["c"], shape="tall")


def test_ratios_are_double_and_null_safe(spark):
    df = spark.createDataFrame([("a", "202401", 1, 2, 0), ("a", "202401", 2, 2, 0)],
                               "cpf string, anomes string, n int, d int, z int")
    spec = BookSpec(ratios=cross_ratios(["n"], ["d", "z"]), windows=(1,))
    row = feature_book(df, spec, "202401").first()
    assert (row.ratio_n_d_1m, row.ratio_n_z_1m) == (0.75, None)


def test_extra_features_see_only_real_rows(tx):
    def rows(inside, n):
        return [F.count(F.when(inside, 1)).alias(f"rows_{n}m")]
    spec = BookSpec(categorical=["c"], extra=[rows], windows=(1, 3))
    got = {r.cpf: (r.rows_1m, r.rows_3m) for r in feature_book(tx, spec, "202402").collect()}
    assert got["a"] == (1, 3) and got[None] == (1, 2) and got["f"] == (0, 1)


def test_reference_month_choices(tx):
    assert reference_month(tx, latest=True) == "202403"
    assert reference_month(tx, ref="202401") == "202401"
    assert reference_month(tx, today=dt.date(2024, 1, 5)) == "202312"


def test_run_book_twice_keeps_one_snapshot(spark, tx, tmp_path):
    spec = BookSpec(numeric=["v"], windows=(1, 3))
    first = run_book(tx, spec, "202402", out=str(tmp_path / "book"))
    n = first.book.count()
    run_book(tx, spec, "202401", out=str(tmp_path / "book"))
    again = run_book(tx, spec, "202402", out=str(tmp_path / "book"))
    assert again.book.count() == n and again.duplicates.count() == 0
    assert again.validation.first().qtd_total_registros == 4
    names = {r.column_name for r in again.mostly_null.collect()}
    assert "v_avg_1m" in names


AGGS = ("sum", "avg", "max", "min", "count", "std", "var_pop")


def _close(a, b):
    assert a.columns == b.columns
    key = lambda r: tuple(str(x) for x in (r[0], r[1]))
    for x, y in zip(sorted(a.collect(), key=key), sorted(b.collect(), key=key), strict=True):
        for c in a.columns:
            assert x[c] == (pytest.approx(y[c], rel=1e-7, abs=1e-9)
                            if isinstance(y[c], float) else y[c]), c


@pytest.fixture()
def many(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 40}", f"2023{i * 7 % 12 + 1:02d}",
             None if i % 11 == 0 else 1e9 + (i * 7919) % 1000 / 7, "xyz"[i % 3] if i % 5 else None,
             float(i % 4)) for i in range(3000)]
    return spark.createDataFrame(rows, "cpf string, anomes string, v double, c string, w double")


def test_months_and_rows_give_the_same_book(many):
    """The rollup against the plain one-pass aggregate.

    Values near 1e9 test the spreads; doubles of that size carry about 8 digits of them.
    """
    def books(by_month):
        spec = BookSpec(numeric=["v", "w"], categorical=["c"], aggregations=AGGS,
                        windows=(1, 3, 12), value_counts={"c": ["x", "q"]},
                        ratios={"v": ["w"]}, stamp_time=False, by_month=by_month,
                        where="v IS NULL OR v > 0")
        return [feature_book(many, spec, "202312", flags=True),
                break_book(many, spec, "202312", "c"),
                break_books(many, spec, "202312", ["c", "w"])]

    months, rows = books(True), books(False)
    assert "__centre_0" in months[0]._jdf.queryExecution().toString()
    assert "__centre_0" not in rows[0]._jdf.queryExecution().toString()
    for a, b in zip(months, rows, strict=True):
        _close(a, b)


def test_wide_breaks_equal_conditional_sums(many):
    spec = BookSpec(numeric=["v"], aggregations=("sum", "count", "max"), windows=(1, 12),
                    stamp_time=False)
    got = break_books(many, spec, "202312", ["c"])
    inside = {1: F.col("anomes") >= "202312", 12: F.lit(True)}
    columns = []
    for value in ("x", "y", "z", None):
        hit = F.col("c").eqNullSafe(F.lit(value))
        stem = f"c_{'none' if value is None else value}_v"
        for n, w in inside.items():
            v = F.when(w & hit, F.col("v"))
            columns += [F.sum(v).alias(f"{stem}_sum_{n}m"), F.count(v).alias(f"{stem}_count_{n}m"),
                        F.max(v).alias(f"{stem}_max_{n}m")]
    base = feature_book(many, spec, "202312").drop("dt_referencia")
    wanted = (many.where("anomes >= '202301'").groupBy("cpf").agg(*columns).join(base, "cpf"))
    _close(got.select(*wanted.columns), wanted)


def test_wide_books_shuffle_narrow_rows(many):
    spec = BookSpec(numeric=["v", "w"], aggregations=AGGS, windows=(1, 3, 6, 9, 12, 24, 36, 48))
    plan = feature_book(many, spec, "202312")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    narrow = feature_book(many, BookSpec(numeric=["v"], windows=(1, 3)), "202312")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_distinct_counts_are_made_of_months_from_rows_dealt_out(many):
    spec = BookSpec(numeric=["v"], categorical=["c"], aggregations=("sum", "std"), windows=(1, 12), stamp_time=False)
    book = feature_book(many, spec, "202312")
    plan = book._jdf.queryExecution().toString()
    assert "__centre_0" in plan and "SPARK_PARTITION_ID" in plan
    _close(book, feature_book(many, replace(spec, by_month=False), "202312"))


def test_wide_breaks_keep_only_the_items_of_a_key(spark):
    """An aggregate as wide as the book spilled every column of every key."""
    rows = spark.range(600).select((F.col("id") % 40).alias("cpf"), F.lit("202401").alias("anomes"),
                                   F.when(F.col("id") % 7 > 0, F.concat(F.lit("f"), F.col("id") % 300)).alias("b"),
                                   F.col("id").cast("double").alias("v"))
    spec = BookSpec(numeric=["v"], aggregations=("sum", "count"), windows=(1,), stamp_time=False)
    book = break_books(rows, spec, "202401", ["b"])
    plan = book._jdf.queryExecution().optimizedPlan().toString()
    assert "pivotfirst" not in plan.lower() and len(book.columns) > 500
    pdf = rows.toPandas()
    found = {r.cpf: r.asDict() for r in book.collect()}
    assert len(found) == 40
    for cpf, own in pdf.groupby("cpf"):
        assert found[cpf]["v_sum_1m"] == own.v.sum() and found[cpf]["v_count_1m"] == len(own)
        sums = own.dropna(subset=["b"]).groupby("b").v.agg(["sum", "count"])
        made = {k: v for k, v in found[cpf].items() if k.startswith("b_f") and k.endswith("_sum_1m") and v is not None}
        assert made == {f"b_{b}_v_sum_1m": s for b, s in sums["sum"].items()}
        assert sum(v for k, v in found[cpf].items() if k.startswith("b_") and k.endswith("_count_1m")) == len(own)
