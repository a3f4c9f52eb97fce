"""Shared and missing ids, templates with many members, odd roles, other partitionings."""

import random

from pyspark.sql import functions as F

from monthbook.llm import chat, decontam, mixing, pii, suffixes
from tests.conftest import SMALL
from tests.llm.test_texts import CHAT

QUESTION = "A farmer has {} sheep and buys {} more sheep at the market so how many does he own"


def test_items_that_share_an_id_or_have_none(spark, table):
    bench = spark.createDataFrame(
        [(1, "please name the longest river there"), (1, "which of these seven birds can sing"),
         (None, "why does the moon look so large")], "item_id bigint, text string")
    texts = ["well please name the longest river there now", "so which of these seven birds can sing",
             "but why does the moon look so large today", "nothing of the kind is in here"]
    docs = table(texts)
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
    assert got == {(0, 1), (1, 1), (2, None)}
    assert [r["doc_id"] for r in decontam.clean(docs, bench).collect()] == [3]


def test_one_row_for_a_template_with_many_members(spark, table):
    bench = spark.createDataFrame([(k, QUESTION.format(k + 100, k + 500)) for k in range(60)]
                                  + [(99, QUESTION.format(7, 7))], "item_id bigint, text string")
    texts = [QUESTION.format(k + 120, k + 520) for k in range(60)] + [QUESTION.format(3, 3)]
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontam.contaminated(table(texts), bench).collect()}
    # The first 40 documents are members; equal values fit both classes.
    assert {k: v for k, v in got.items() if k[0] < 60} == {
        (k, 0): "verbatim" if k < 40 else "reparameterised" for k in range(60)}
    assert got[60, 0] == got[60, 99] == "reparameterised"
    members = {r["item_id"]: r["represented_by"] for r in decontam.item_classes(bench).collect()}
    assert members == {**dict.fromkeys(range(60), 0), 99: 99}


def test_templates_against_brute_force(spark, table):
    """Every document holds one question; it is found exactly if its values are a function of the item's."""
    rng = random.Random(8)
    shape = "first take {} coins then take {} stones then take {} coins and then put back {} stones please"
    items = [tuple(rng.randint(1, 3) for _ in range(4)) for _ in range(12)]
    docs = [tuple(rng.randint(1, 3) for _ in range(4)) for _ in range(60)]
    bench = spark.createDataFrame([(k, shape.format(*v)) for k, v in enumerate(items)],
                                  "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontam.contaminated(
        table(["so " + shape.format(*v) + " ok" for v in docs]), bench).collect()}

    def pattern(v):
        return tuple(v.index(x) for x in v)

    least = {}
    for k, v in enumerate(items):
        least.setdefault(pattern(v), k)
    expected = {}
    for d, values in enumerate(docs):
        for k in least.values():
            if len(set(zip(items[k], values))) == len(set(items[k])):
                same = any(pattern(v) == pattern(items[k]) and v == values for v in items)
                expected[d, k] = "verbatim" if same else "reparameterised"
    assert got == expected


def _words(df):
    return {r["source"]: r["n"] for r in mixing.sizes(df).groupBy("source").agg(
        F.sum("size").alias("n")).collect()}


def test_mixed_holds_the_drawn_words(spark, table):
    rng = random.Random(9)
    texts = [" ".join("abc"[: rng.randint(1, 3)] for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += texts[:3] * 20
    n = len(texts)
    for ids in ([7] * n, [None] * n, [k // 3 for k in range(n)]):
        docs = table(texts, ids=ids, sources=[("s", "t", None)[k % 3] for k in range(n)]).repartition(4)
        rows = mixing.mix(docs)
        goals = {r["source"]: r["target"] for r in rows.select("source", "target").distinct().collect()}
        taken = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.sum("taken").alias("n")).collect()}
        assert _words(mixing.mixed(docs)) == taken
        for source, goal in goals.items():
            assert abs(taken[source] - goal) <= 80


def test_newlines_in_roles(spark):
    rows = [(1, 0, "a\nb", "c", 0, 0), (1, 1, "a", "b\nc", 0, 0), (2, 0, "\\n", "x\\n", 0, 0),
            (2, 1, "\n", "\n", 0, 0), (2, 2, "<s>\n\\", "[INST]", 0, 0)]
    parts = chat.format_chats(spark.createDataFrame(rows, CHAT)).collect()
    for conv in (1, 2):
        whole = "".join(p["formatted"] for p in sorted(parts, key=lambda p: p["part"]) if p["conv_id"] == conv)
        assert list(chat.parse(whole)) == [(r[2], r[3]) for r in rows if r[0] == conv]


def test_texts_are_no_part_of_chat_ranges(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x", 0, 0)], CHAT)
    plan = chat.format_chats(rows)._jdf.queryExecution().executedPlan().toString()
    ranges = plan[plan.index("rangepartitioning"):].split("\n")[0]
    assert "text" not in ranges and "turn" in ranges


def test_personal_data_under_any_partitioning(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one = pii.find(docs.coalesce(1), sample=60).collect()
    many = pii.find(docs.repartition(7, F.rand(3)), sample=60).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_more_packs_than_buckets(spark, table):
    rng = random.Random(10)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(200))
    texts = ["".join(rng.choice("ijklm ") for _ in range(400)) + passage for _ in range(40)]
    few = suffixes.remove_repeats(table(texts), pack=1000, buckets=3).collect()
    many = suffixes.remove_repeats(table(texts), pack=1000).collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, many))
    assert all((r["n_bytes"] - len(r["kept"]) >= 200) == (r["doc_id"] > 0) for r in few)
