"""Lagged joins, hot keys, pipelines, sources."""

import json

import pytest
from pyspark.sql import functions as F

from monthbook.operators.joins import lagged_join, master_table, numeric_feature_join
from monthbook.operators.skew import hot_keys, left_join
from monthbook.plans.join_pipelines import (
    join_pipeline, master_pipeline, numeric_join_pipeline, output_name)
from monthbook.session import COLOCATED
from monthbook.sources import tables as t


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def hot(spark):
    """A right side where one key holds a third of the rows, many of them equal."""
    left = spark.createDataFrame(
        [(k, "m1", i) for i, k in enumerate(["hot", "hot", "a", "b", None, "gone"])],
        "doc string, mon string, l int")
    rows = [("hot", "m1", i % 3) for i in range(400)] + [
        (f"k{i}", "m1", i) for i in range(790)] + [("a", "m1", 1), ("a", "m1", 1)]
    rows += [(None, "m1", 5)] * 8
    return left, spark.createDataFrame(rows, "doc string, mon string, r int")


def test_hot_keys_are_found(hot):
    _, right = hot
    assert list(hot_keys(right, ["doc", "mon"], min_rows=100)) == [("hot", "m1")]
    assert hot_keys(right, ["doc", "mon"]) == {}


@pytest.mark.parametrize("min_rows", [10, 33, 100])
def test_salted_left_join_equals_plain_one(hot, min_rows):
    left, right = hot
    plain = left.join(right, ["doc", "mon"], "left").select("doc", "mon", "l", "r")
    salted = left_join(left, right, ["doc", "mon"], min_rows=min_rows)
    assert "__copies" in salted._jdf.queryExecution().toString()
    assert _rows(salted.select("doc", "mon", "l", "r")) == _rows(plain)


@pytest.fixture()
def world(spark):
    pop = spark.createDataFrame(
        [("1", "202401", 0), ("2", "202401", 1), ("1", "202402", 1), ("9", "202402", 0)],
        "document_id string, date_yyyymm string, y int")
    ft1 = spark.createDataFrame(
        [("1", "202312", 5.0, "x"), ("1", "202401", 6.0, "y"), ("2", "202312", 7.0, None),
         ("2", "202312", 8.0, "z")], "doc string, mes string, score double, cat string")
    ft2 = spark.createDataFrame([(1, 202311, 1), (9, 202312, 2)],
                                "id long, safra int, level int")
    keys = [t.FeatureKeys("ft1", "doc", "mes", 1),
            t.FeatureKeys("ft2", "id", "safra", 2, "bigint", "int")]
    return pop, {"ft1": ft1, "ft2": ft2}, keys


def test_lagged_join_keeps_rows_and_fans_out(world):
    pop, tables, keys = world
    got = lagged_join(pop, tables["ft1"], keys[0], doc="document_id", month="date_yyyymm")
    assert got.columns == ["document_id", "y", "ft1_score", "ft1_cat", "date_yyyymm"]
    found = sorted((r.document_id, r.date_yyyymm, r.ft1_score or 0) for r in got.collect())
    assert found == [("1", "202401", 5.0), ("1", "202402", 6.0), ("2", "202401", 7.0),
                     ("2", "202401", 8.0), ("9", "202402", 0)]


def test_months_become_a_filter_on_the_feature_table(world, spark, tmp_path):
    pop, tables, keys = world
    tables["ft1"].write.partitionBy("mes").parquet(str(tmp_path / "ft1"))
    stored = spark.read.schema(tables["ft1"].schema).parquet(str(tmp_path / "ft1"))
    got = lagged_join(pop, stored, keys[0], doc="document_id", month="date_yyyymm",
                      months=["202402"])
    plan = got._jdf.queryExecution().toString()
    assert "202401" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.ft1_score for r in got.collect()} == {6.0, None}


def test_master_table_skips_tables_and_warns_on_unknown_features(world):
    pop, tables, keys = world
    with pytest.warns(UserWarning, match="no such features"):
        got = master_table(pop, tables, keys, {"ft2": ["level", "nope"]}, doc="document_id",
                           month="date_yyyymm")
    assert got.columns == ["document_id", "y", "ft2_level", "date_yyyymm"]
    assert {(r.document_id, r.date_yyyymm): r.ft2_level for r in got.collect()} == {
        ("1", "202401"): 1, ("2", "202401"): None, ("1", "202402"): None, ("9", "202402"): 2}


def test_master_joins_shuffle_the_population_once(world, spark):
    pop, tables, keys = world
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = master_table(pop, tables, keys, {"ft1": ["score"], "ft2": ["level"]},
                           doc="document_id", month="date_yyyymm")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3  # population and two tables


def test_hot_documents_on_both_sides(world, spark):
    pop, tables, keys = world
    many = pop.union(spark.createDataFrame([("2", "202401", 1)] * 300, pop.schema))
    tables["ft1"] = tables["ft1"].union(
        spark.createDataFrame([("2", "202312", float(i % 4), "q") for i in range(150)],
                              tables["ft1"].schema))
    args = dict(doc="document_id", month="date_yyyymm")
    feature_map = {"ft1": ["score", "cat"], "ft2": ["level"]}
    plain = master_table(many, tables, keys, feature_map, **args)
    salted = master_table(many, tables, keys, feature_map, min_rows=100, **args)
    assert "__copies" in salted._jdf.queryExecution().toString()
    assert plain.count() == 301 * 152 + 3
    assert plain.exceptAll(salted).count() == 0 == salted.exceptAll(plain).count()


def test_many_rows_without_a_document(world, spark):
    pop, tables, keys = world
    many = pop.union(spark.createDataFrame([(None, "202401", 1)] * 200, pop.schema))
    args = dict(doc="document_id", month="date_yyyymm")
    feature_map = {"ft1": ["score"], "ft2": ["level"]}
    plain = master_table(many, tables, keys, feature_map, **args)
    split = master_table(many, tables, keys, feature_map, min_rows=100, **args)
    assert "Union" in split._jdf.queryExecution().toString()
    assert split.columns == plain.columns and split.count() == 205
    assert plain.exceptAll(split).count() == 0


def test_join_pipeline_can_be_run_again(world, spark, tmp_path):
    pop, tables, keys = world
    args = dict(doc="document_id", month="date_yyyymm", months=["202401", "202402"],
                out=str(tmp_path))
    first = join_pipeline(pop, tables, keys, **args)
    assert first["ft1"].endswith("ft_ft1_joined")
    n = {k: spark.read.parquet(p).count() for k, p in first.items()}
    join_pipeline(pop, tables, keys, **{**args, "months": ["202402"]})
    assert {k: spark.read.parquet(p).count() for k, p in first.items()} == n


def test_master_pipeline_validates(world, tmp_path):
    pop, tables, keys = world
    written, report = master_pipeline(pop, tables, keys, {"ft2": ["level"]}, doc="document_id",
                                      month="date_yyyymm", months=None,
                                      out=str(tmp_path / "m"))
    assert report.first().asDict() == {"total_rows": 4, "partitions": 2}
    assert dict(written.dtypes)["date_yyyymm"] == "string"


def test_root_join_and_unsupported_length(spark):
    pop = spark.createDataFrame([(12345678901, 1, 202401), (1234567890, 0, 202401)],
                                "cpf long, y int, anomes int")
    feats = spark.createDataFrame([("12345678", 202312, 3, "t"), ("01234567", 202312, 4, "t")],
                                  "raiz string, safra int, n int, s string")
    keys = t.FeatureKeys("db.f", "raiz", "safra", 1, doc_digits=8)
    got = {r.cpf_publico_target: r.n for r in numeric_feature_join(pop, feats, keys).collect()}
    assert got == {12345678901: 3.0, 1234567890: 3.0}
    got = {r.cpf_publico_target: r.n
           for r in numeric_feature_join(pop, feats, keys, pad=True).collect()}
    assert got == {12345678901: 3.0, 1234567890: 4.0}
    with pytest.raises(ValueError):
        numeric_feature_join(pop, feats, t.FeatureKeys("f", "raiz", "safra", doc_digits=14))


def test_numeric_pipeline_isolates_errors(spark, tmp_path):
    pop = spark.createDataFrame([(12345678901, 1, 202401), (12345678902, 0, 202402)],
                                "cpf long, y int, anomes int")
    good = spark.createDataFrame([(12345678901, 202401, 3.0)], "cpf long, safra int, n double")
    bad = good.withColumn("n", F.when(F.col("safra") == 202401, F.raise_error(F.lit("broken")))
                          .cast("double"))
    key = lambda n, d=11: t.FeatureKeys(n, "cpf", "safra", 0, doc_digits=d)
    status = numeric_join_pipeline(
        pop, {"db.good": good, "db.bad": bad, "db.odd": good,
              "db.text": good.select("cpf", "safra", F.lit("a").alias("a"))},
        [key("db.bad"), key("db.good"), key("db.odd", 9), key("db.text"), key("db.lost")],
        months=[202401, 202402], out=str(tmp_path), name="pub")
    got = {(r.table, r.month): (r.status, r.rows) for r in status.collect()}
    assert got == {
        ("db.good", "202401"): ("done", 1), ("db.good", "202402"): ("done", 1),
        ("db.bad", "202401"): ("failed", None), ("db.bad", "202402"): ("done", 1),
        ("db.odd", "202401"): ("skipped", None), ("db.odd", "202402"): ("skipped", None),
        ("db.text", "202401"): ("skipped", None), ("db.text", "202402"): ("skipped", None),
        ("db.lost", "202401"): ("failed", None), ("db.lost", "202402"): ("failed", None)}
    assert output_name("pub", "db.good") == "pub_good"


# --- sources ----------------------------------------------------------------------------

def test_read_table_by_suffix(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    df.write.parquet(str(tmp_path / "x.parquet"))
    t.write_csv(df, str(tmp_path / "x.csv"))
    assert _rows(t.read_table(spark, str(tmp_path / "x.parquet"))) == _rows(df)
    assert _rows(t.read_table(spark, str(tmp_path / "x.csv"))) == _rows(df)
    assert t.table_stem("a/b/x.parquet") == "x"
    with pytest.raises(ValueError):
        t.read_table(spark, "x.xlsx")


def test_metadata_of_both_forms(spark, tmp_path):
    rows = [("ft", "doc", "bigint", "mes", "string", "m-2")]
    t.write_csv(spark.createDataFrame(rows, list(t.LAG_METADATA)), str(tmp_path / "m.csv"))
    read = t.read_metadata(spark, str(tmp_path / "m.csv"))
    assert t.feature_keys(read) == [t.FeatureKeys("ft", "doc", "mes", 2, "bigint", "string")]
    other = spark.createDataFrame([("db.f", "RAIZ", 8, "SAFRA", "int", "M-1")],
                                  list(t.ROOT_METADATA))
    got, = t.feature_keys(other)
    assert (got.doc, got.month, got.lag, got.doc_digits) == ("raiz", "safra", 1, 8)
    with pytest.raises(ValueError, match="tipo_safra"):
        t.feature_keys(other.drop("tipo_safra"))


def test_feature_map_from_dict_and_json(spark, tmp_path):
    wanted = {"ft1": ["a", "b"], "ft2": ["c"]}
    path = tmp_path / "map.json"
    path.write_text(json.dumps(wanted, indent=2))
    assert t.load_feature_map(spark, wanted) == t.load_feature_map(spark, str(path)) == wanted


def test_empty_table_then_insert_twice(spark):
    df = spark.createDataFrame([("a", 1, "202401"), ("b", 2, "202402")],
                               "k string, n int, mes string")
    empty = t.create_empty_table(spark, "made_empty", df.schema, "mes")
    assert empty.count() == 0 and empty.columns == ["k", "n", "mes"]
    for _ in range(2):
        t.insert_partitions(df, "made_empty", "mes")
    t.insert_partitions(df.where("mes = '202402'"), "made_empty", "mes")
    assert _rows(spark.table("made_empty")) == _rows(df)
    assert t.schema_of(df, ["mes"]) == [("k", "string"), ("n", "int")]
    spark.sql("DROP TABLE made_empty")


def test_write_sample_and_partitions(spark, tmp_path):
    df = spark.range(100).withColumn("mes", F.lit("202401"))
    t.write_sample(df, str(tmp_path / "s"), 7)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 7
    t.write_partitions(df, str(tmp_path / "p"), "mes")
    read = t.read_written(spark, str(tmp_path / "p"), df.schema)
    assert t.read_partitions(read, "mes", ["202401"], ["id"]).count() == 100
    assert t.read_partitions(read, "mes", ["202402"]).count() == 0


def test_scratch_outputs_can_be_cleared(spark):
    from monthbook.session import clear_scratch, scratch_path
    path = scratch_path(spark, "kept")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert clear_scratch(spark) >= 1 and clear_scratch(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def _months(spark, path):
    return {(r.mes, r.k) for r in t.read_written(
        spark, path, t.StructType().add("k", "long").add("mes", "string")).collect()}


def test_a_failed_run_leaves_the_months_as_they_were(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "202401"), (2, "202402")], "k long, mes string")
    t.replace_partitions(df, path, "mes")
    broken = df.select(F.when(F.col("k") == 2, F.raise_error(F.lit("no")).cast("long"))
                       .otherwise(F.col("k") + 10).alias("k"), "mes")
    with pytest.raises(Exception, match="no"):
        t.replace_partitions(broken, path, "mes")
    assert _months(spark, path) == {("202401", 1), ("202402", 2)}
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("steps", range(4))
def test_a_swap_that_was_decided_is_finished_by_the_next_reader(spark, tmp_path, monkeypatch, steps):
    """The driver is lost after some of the renames."""
    from monthbook.sources import swap
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "202401"), (2, "202402"), (3, "202403"), (9, None)],
                               "k long, mes string")
    t.replace_partitions(df, path, "mes")
    real, left = swap._rename, [steps + 1]  # the manifest itself is the first

    def rename(*args):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        real(*args)

    monkeypatch.setattr(swap, "_rename", rename)
    new = df.where("k < 3").withColumn("k", F.col("k") + 10)
    if steps < 2:
        with pytest.raises(KeyboardInterrupt):
            t.replace_partitions(new, path, "mes", ["202401", "202402", "202403"])
    else:
        t.replace_partitions(new, path, "mes", ["202401", "202402", "202403"])
    monkeypatch.undo()
    assert _months(spark, path) == {("202401", 11), ("202402", 12), (None, 9)}
    assert spark.read.parquet(path).count() == 3


def test_catalogue_outputs_lose_empty_months_and_gain_columns(world, spark, tmp_path):
    pop, tables, keys = world
    args = dict(doc="document_id", month="date_yyyymm", out=str(tmp_path), database="default",
                prefix="evolve")
    name = join_pipeline(pop, tables, keys[:1], months=None, **args)["ft1"]
    try:
        assert {r[0] for r in spark.table(name).select("date_yyyymm").collect()} == {
            "202401", "202402"}
        more = {"ft1": tables["ft1"].withColumn("extra", F.lit(7))}
        join_pipeline(pop.where("date_yyyymm = '202402'"), more, keys[:1],
                      months=["202401", "202402"], **args)
        got = spark.table(name)
        assert got.columns == ["document_id", "y", "ft1_score", "ft1_cat", "ft1_extra",
                               "date_yyyymm"]
        assert {(r.document_id, r.date_yyyymm, r.ft1_extra) for r in got.collect()} == {
            ("1", "202402", 7), ("9", "202402", None)}
        join_pipeline(pop, tables, keys[:1], months=["202401"], **args)  # without the new column
        assert {(r.date_yyyymm, r.ft1_extra) for r in spark.table(name).collect()} == {
            ("202401", None), ("202402", 7), ("202402", None)}
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_tables_stored_by_document_join_without_a_shuffle(world, spark):
    pop, tables, keys = world
    lost = pop.union(spark.createDataFrame([(None, "202401", 1)] * 3, pop.schema))
    names = {"pop": "by_doc_pop", "ft1": "by_doc_ft1", "ft2": "by_doc_ft2"}
    unique = [t.replace(k, unique=True) for k in keys]
    args = dict(doc="document_id", month="date_yyyymm")
    feature_map = {"ft1": ["score", "cat"], "ft2": ["level"]}
    settings = {**COLOCATED, "spark.sql.autoBroadcastJoinThreshold": "-1"}
    try:
        for _ in range(2):  # a second run replaces the months it has
            stored = t.store_by_document(lost, names["pop"], "document_id", "date_yyyymm", 4)
        made = {k.table: t.store_by_document(tables[k.table], names[k.table], k.doc, k.month, 4)
                for k in keys}
        for name, value in settings.items():
            spark.conf.set(name, value)
        got = master_table(stored, made, unique, feature_map, **args)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        rows = _rows(got)
        more = tables["ft2"].withColumn("extra", F.lit(1))
        wide = t.store_by_document(more, names["ft2"], keys[1].doc, keys[1].month, 4)
        assert {r.extra for r in wide.collect()} == {1}
    finally:
        for name in settings:
            spark.conf.unset(name)
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    want = master_table(lost, tables, keys, feature_map, **args)
    assert rows == _rows(want)


@pytest.mark.parametrize("most_bytes", [1 << 20, 0])
def test_more_hot_keys_than_a_plan_holds_are_a_table(spark, hot, monkeypatch, most_bytes):
    """Ninety hot keys where two are written into a plan: counted, and split by a join."""
    from monthbook.operators import skew
    monkeypatch.setattr(skew, "TRACKED", 2)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", most_bytes)
    left, right = hot
    more = spark.range(1800).selectExpr("concat('k', id % 90) AS doc", "'m1' AS mon",
                                        "CAST(id % 7 AS INT) AS r")
    right = right.unionByName(more)
    left = left.unionByName(spark.range(95).selectExpr("concat('k', id) AS doc", "'m1' AS mon",
                                                       "CAST(id AS INT) AS l"))
    seen = skew.look(right, ["doc", "mon"], 10)
    assert not seen.hot and seen.without_key == 8
    assert {r["doc"]: r["__n"] for r in seen.many.collect()} == {
        "hot": 400, **{f"k{i}": 21 for i in range(90)}}
    salted = left_join(left, right, ["doc", "mon"], min_rows=10)
    plain = left.join(right, ["doc", "mon"], "left").select("doc", "mon", "l", "r")
    assert _rows(salted.select("doc", "mon", "l", "r")) == _rows(plain)


def test_many_hot_documents_on_both_sides_of_a_lagged_join(spark, monkeypatch):
    from monthbook.operators import skew
    population = spark.range(600).selectExpr(
        "concat('d', id % 40) AS doc", "'202402' AS mes", "CAST(id % 3 AS INT) AS y")
    features = spark.range(400).selectExpr(
        "concat('d', id % 50) AS doc", "'202401' AS safra", "CAST(id % 4 AS INT) AS v")
    keys = t.FeatureKeys("f", "doc", "safra", 1)
    plain = lagged_join(population, features, keys, doc="doc", month="mes")
    monkeypatch.setattr(skew, "TRACKED", 2)
    split = lagged_join(population, features, keys, doc="doc", month="mes", min_rows=5)
    assert _rows(split) == _rows(plain)


def test_keys_hot_on_both_sides_meet_packed(spark):
    """Equal rows with a map, different ones, a left document without a match, and few salts."""
    from monthbook.operators import skew
    salts = skew.most_salts(spark.range(1))
    assert salts == 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    one = spark.range(10_000).select(F.lit("a").alias("doc"), F.create_map(F.lit("k"), F.lit(1)).alias("m"))
    packed = skew.pack_rows(one, "__copies").collect()
    assert sorted(r["__copies"] for r in packed) == [1808, 4096, 4096] and packed[0].m == {"k": 1}
    spread = skew.spread_rows(one.drop("m").withColumn("id", F.monotonically_increasing_id())
                              .withColumn("__salts", F.lit(salts)), "__salt", "__copies")
    assert spread.count() == 10_000 and spread.agg(F.countDistinct("__salt")).first()[0] == salts
    population = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "none").when(F.col("id") % 3 == 1, "hot").otherwise("both").alias("doc"),
        F.lit("202002").alias("mes"), "id")
    features = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise("both").alias("DOC"), F.lit("202001").alias("SAFRA"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 8).otherwise(F.col("id")).alias("v"),
        F.create_map(F.lit("k"), F.col("id") % 2).alias("m"))
    keys = t.FeatureKeys("f", "DOC", "SAFRA", 1)
    for min_rows in (5, 50, 200):
        got = lagged_join(population, features, keys, doc="doc", month="mes", min_rows=min_rows)
        plain = lagged_join(population, features, keys, doc="doc", month="mes", min_rows=10 ** 9)
        assert got.columns == plain.columns and got.schema["f_m"].dataType == plain.schema["f_m"].dataType
        def counted(df):
            return {tuple(r[:-1]): r.n for r in df.groupBy(
                "doc", "id", "f_v", F.col("f_m")["k"].alias("k"), "mes").agg(F.count("*").alias("n")).collect()}
        assert counted(got) == counted(plain) and sum(counted(got).values()) == 300 + 2 * 300 * 200
