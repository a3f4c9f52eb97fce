"""Chat, language, mixing, personal data, token files, decontamination and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from monthbook.llm import chat, decontam, langid, mixing, pii, tokens
from tests.conftest import SMALL

CHAT = "conv_id bigint, turn bigint, role string, text string, part int, formatted int"


def _chat_rows():
    rng = random.Random(1)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<", "[", "é", "\n", " ", "x", " [/INST]</s>"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "[INST]"]),
             "".join(rng.choice(bits) for _ in range(rng.randint(0, 9))), 1, 2)
            for c in range(8) for t in range(rng.randint(1, 6))]
    return rows + [(None, 0, "user", None, 1, 2), (3, None, "assistant", "", 1, 2), rows[0],
                   (9, 0, "assistant", "long " * 50_000, 1, 2)]


def test_chats_come_back_whole(spark):
    rows = _chat_rows()
    parts = chat.format_chats(spark.createDataFrame(rows, CHAT).repartition(3))
    kept = parts.collect()
    got = {r["conv_id"]: r for r in chat.read_back(parts).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "",
                                        (r[3] or "").encode()))
    for conv in {r[0] for r in rows}:
        said = [(r[2] or "", r[3] or "") for r in order if r[0] == conv]
        whole = "".join(p["formatted"] for p in sorted(
            (p for p in kept if p["conv_id"] == conv), key=lambda p: p["part"]))
        assert list(chat.parse(whole)) == said
        loss = "".join(t for r, t in said if r == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(said) and row["formatted_chars"] == len(whole)
        assert row["loss_chars"] == len(loss)
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert row["turns_sha256"] == hashlib.sha256(
            "".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()


def test_no_chats(spark):
    empty = spark.createDataFrame([], CHAT)
    assert chat.read_back(chat.format_chats(empty)).collect() == []


def test_codewords_are_apart():
    for n in range(2, 20):
        code = langid.codewords(n)
        assert (abs(code.sum(axis=0)) < n).all()
        least = min((code[a] != code[b]).sum() for a in range(n) for b in range(a))
        assert least >= max(1, code.shape[1] // 2)


def test_trigrams_do_not_span_texts():
    texts = ["abc", "", "x", "Größe"]
    buckets, starts = langid.trigrams(texts)
    alone = [langid.trigrams([t])[0].tolist() for t in texts]
    ends = [*starts[1:], len(buckets)]
    assert [buckets[a:b].tolist() for a, b in zip(starts, ends)] == alone
    assert alone[0] == langid.trigrams(["ABC"])[0].tolist()


def test_language_accuracy_on_held_out(spark):
    got = langid.language_query(spark, SMALL).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(docs) and len(held) > 10
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_rows(odd, odd_rows, none):
    model = langid.learn(odd.where(~langid.held_out()))
    got = langid.identify(odd, model, ("l", "s", "a")).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert (r["l"] == langid.UNKNOWN) == (not langid.has_letter(r["text"]))
    kept = langid.accepted(odd)
    assert kept.columns == odd.columns
    assert langid.learn(none) is None
    assert langid.accepted(none).collect() == []
    assert {r["l"] for r in langid.identify(odd, None, ("l", "s", "a")).collect()} == {"und"}


def _targets(sizes, weights=(3, 1, 2), factor=1.5, most=2.0):
    """Water filling by repeated sharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, open_, out = factor * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_the_commonest_labels_are_learnt(table):
    texts = [f"the cat and the dog {k}" for k in range(20)] + [f"der hund und die katze {k}" for k in range(12)]
    texts += [f"free text {k}" for k in range(30)]
    langs = ["en"] * 20 + ["de"] * 12 + [f"note {k}" for k in range(30)]
    docs = table(texts, langs=langs)
    model = langid.learn(docs, languages=2)
    assert model.langs == ("de", "en")
    got = {r["lang"]: r["l"] for r in langid.identify(docs, model, ("l", "s", "a")).collect()}
    assert got["en"] == "en" and got["de"] == "de" and set(got.values()) == {"en", "de"}
    assert len(langid.learn(docs, languages=5).langs) == 5


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    once = sorted(map(tuple, mixing.mixing_query(spark, SMALL).collect()))
    again = sorted(map(tuple, mixing.mixing_query(spark, SMALL).collect()))
    assert once == again and len(once) == docs.count()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    size, taken, target = {}, {}, {}
    for i, n, _, goal, took in once:
        s = source[i]
        size[s], taken[s], target[s] = size.get(s, 0) + n, taken.get(s, 0) + took, goal
        assert took in (0, n, 2 * n)
    want = _targets(size)
    for s in size:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 30


def test_cube_balances_over_many_blocks(spark):
    rng = random.Random(6)
    rows = [(k, "s", int(rng.expovariate(1 / 300)), 0.37) for k in range(6000)]
    units = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, prob double")
    got = mixing.cube_sample(units, block=64).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(6000))
    words = sum(r["size"] for r in got if r["extra"])
    assert abs(words / (0.37 * sum(r[2] for r in rows)) - 1) < 0.002
    assert abs(sum(r["extra"] for r in got) / (0.37 * 6000) - 1) < 0.01
    one = mixing.cube_sample(units, block=64, seed=2).collect()
    assert {r["doc_id"] for r in one if r["extra"]} != {r["doc_id"] for r in got if r["extra"]}


def test_mix_of_odd_rows(odd, odd_rows, none):
    got = mixing.mix(odd).collect()
    assert len(got) == len(odd_rows)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mix(none).collect() == [] and mixing.mixed(none).collect() == []


def _luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


_PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+",
     lambda m: 14 <= len(d := re.sub("[ -]", "", m)) <= 19 and _luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15))


def _base(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, good) in enumerate(_PATTERNS)
             for m in re.finditer(p, text or "") if good(m[0])]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def test_base_spans_equal_plain_searches():
    rng = random.Random(9)
    bits = ["a", "Z.", "@", "b@c.d", "@x", "+1", " ", "-", "(", ")", ".", "1.2.3.4", "300", "5",
            "4111 1111 1111 1111", "4111-1111-1111-1111", "é", "+44 20 7946 0958", "00012", "%", "٣"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == _base(text), text


def test_personal_data_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: r for r in pii.find(docs).collect()}
    for row in docs.collect():
        base = _base(row["text"])
        found = got[row["doc_id"]]
        said = pii.written(base)
        assert found["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [found[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in base)
                                                      for k in pii.BASE]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(found["spans"].split(","))


def test_trees_add_what_looks_alike(spark):
    rng = random.Random(4)

    def key():
        return "".join(rng.choice("0123456789abcdef") for _ in range(40))
    texts = [f"some key {key()} here and order {rng.randint(10**9, 10**11)} there, "
             f"build {rng.randint(10**15, 10**17):017d}xx" for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = pii.find(docs).collect()
    added = [r for r in got if f"secret:9:49" in r["spans"].split(",")]
    assert len(added) > 290
    assert all(r["n_added"] <= 2 for r in got)


def test_trees_add_what_the_base_does_not_hold(spark):
    rng = random.Random(8)
    texts, want = [], []
    for k in range(300):
        mail = f"user{k} (at) host{k}.example.com"
        phone = f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        six = ":".join(f"{rng.randint(1, 65535):x}" for _ in range(8))
        text = (f"write to {mail} or to a{k}@b{k}.org, from {six} of 10.0.0.{k % 256}, ring {phone} "
                f"by 2024-{k % 12 + 1:02d}-11, order {rng.randint(10**9, 10**10)}, time 12:30:45:{k % 60:02d}")
        texts.append(text)
        want.append([f"{kind}:{text.index(x)}:{text.index(x) + len(x)}" for kind, x in
                     (("email", mail), ("phone", phone), ("ip", six))])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pii.find(docs).collect()}
    for which in range(3):
        assert sum(w[which] in got[k]["spans"].split(",") for k, w in enumerate(want)) > 280
    assert sum(r["n_added"] for r in got.values()) <= 920


def test_trees_and_thresholds_know_all_candidates(spark):
    # 30,000 candidates; a kind of secret that is one in a thousand must be learnt and counted.
    rng = random.Random(6)
    rows = []
    for k in range(30_000):
        rare = k % 1000 == 0
        one = [0.0] * 30
        one[0], one[1], one[2] = 4.0, 40.0 + rng.randint(0, 400), 900.0 if rare else float(rng.randint(0, 300))
        label = 1 if rare else 0
        rows.append((k, k, "secret", 0, 40, label, False, one, k // 1000 % 2))
    cands = spark.createDataFrame(rows, "doc_id bigint, version bigint, kind string, start bigint, stop bigint, "
                                  "label int, strict boolean, features array<double>, half int")
    seen, made = [], pii._score
    try:
        pii._score = lambda rows, models: seen.append(rows.agg(F.sum("n")).first()[0]) or made(rows, models)
        models, limits, ends = pii.train(cands)
    finally:
        pii._score = made
    assert seen == [30_000]  # all of them set the thresholds
    assert len(ends[2]) <= pii.BINS and 0.5 < limits["secret"] <= 1
    scored = pii._score(cands.withColumn("bins", pii._bins(ends)), models)
    found = scored.where(F.col("score") >= limits["secret"])
    assert found.count() == found.where("label = 1").count() == 30


def test_personal_data_of_copies_is_the_same(spark):
    rng = random.Random(12)
    texts = [f"key {rng.getrandbits(160):040x} or order {rng.randint(10**9, 10**11)}" for _ in range(60)]
    docs = spark.createDataFrame([(k, texts[k % 60]) for k in range(180)], "doc_id bigint, text string")
    spans = {}
    for r in pii.find(docs).collect():
        spans.setdefault(r["doc_id"] % 60, set()).add(r["spans"])
    assert all(len(s) == 1 for s in spans.values())


def test_personal_data_that_is_only_proposed():
    for text, kind in (("mail john ( at ) example dot", "email"), ("bob {AT} example.com", "email"),
                       ("key " + "aB3" * 70, "secret")):
        assert kind in [c[0] for c in pii.candidates(text, [])], text
    batch = pa.record_batch({"doc_id": [1], "text": ["bob {at} example.com"]})
    assert len(next(pii._scan(iter([batch]))).column(2)[0]) == 1


def test_personal_data_of_odd_rows(odd, odd_rows, none):
    assert len(pii.find(odd).collect()) == len(odd_rows)
    assert pii.find(none).collect() == []
    assert pii.redact("to a@b.c now", "email:3:8") == "to <email> now"


def _ids(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids + [tokens.END]


def test_cached_words_give_the_library_s_ids():
    encoder = tokens.Encoder(tokens.vocabulary_path())
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "a", "é", ",", ".", ", ", ". ", "'s", "12", "\t", "\0", "-", "\xa0", "Ab"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    ids, sizes = encoder.encode(texts)
    ends = np.cumsum(sizes)
    for text, a, b in zip(texts, ends - sizes, ends):
        assert ids[a:b].tolist() == _ids(encoder.tok, text), repr(text)


class _Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tok):
        self.tok, self.texts = tok, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tok.encode_batch_fast(texts, **options)


def test_new_words_are_encoded_many_in_a_text():
    encoder = tokens.Encoder(tokens.vocabulary_path())
    encoder.tok = counted = _Counted(encoder.tok)
    rng = random.Random(5)
    letters = ["a", "b", "th", "ing", "é", "ж", "漢", "'", "-", "_", "\t", "\xa0", "7", "."]
    words = sorted({"x" + "".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) + "y"
                    for _ in range(20_000)})
    texts = [" ".join(words[k:k + 50]) for k in range(0, len(words), 50)]
    for _ in range(2):  # learnt, then known
        ids, sizes = encoder.encode(texts)
        ends = np.cumsum(sizes)
        for text, a, b in zip(texts, ends - sizes, ends):
            assert ids[a:b].tolist() == _ids(counted.tok, text)
    # The first word of each text has no blank before it and is a text of its own.
    assert counted.texts < len(texts) + len(words) / 100


def test_words_are_told_apart_by_all_their_bytes():
    words = sorted({c * n + end for c in "aé\0" for n in range(40) for end in ("", "a", "b", "\0", "\0\0")})
    first, second = tokens._keys(pa.array(words))
    assert len(set(zip(first.tolist(), second.tolist()))) == len(set(first.tolist())) == len(words)
    again = tokens._keys(pa.array(["x", *words]).slice(1))
    assert np.array_equal(again[0], first) and np.array_equal(again[1], second)
    encoder = tokens.Encoder(tokens.vocabulary_path())
    texts = [f"say {w} {w}{w}, twice. {w}" for w in words]
    for part in (texts, texts[::-1]):
        ids, sizes = encoder.encode(part)
        ends = np.cumsum(sizes)
        for text, a, b in zip(part, ends - sizes, ends):
            assert ids[a:b].tolist() == _ids(encoder.tok, text), repr(text)


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0, np.uint32), np.full(1000, 7, np.uint32),
                rng.integers(0, 30, 20_000).astype(np.uint32),
                rng.integers(0, tokens.FIRST, 5000).astype(np.uint32)):
        symbols, rules, lengths = tokens.repair(ids, least=8)
        assert np.array_equal(tokens.expand(symbols, rules, lengths), ids)
        row = {"width": 4, "symbols": symbols.astype("<u4").tobytes(),
               "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes()}
        for a, b in ((0, len(ids)), (len(ids) // 3, len(ids) // 2), (0, 0)):
            assert np.array_equal(tokens.decode_range(row, a, b), ids[a:b])
    assert len(tokens.repair(np.full(1000, 7, np.uint32), least=8)[0]) < 200


def test_repair_goes_on_until_pairs_are_rare():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, tokens.FIRST, 500).astype(np.uint32)
    common = rng.integers(0, 300, 600_000).astype(np.uint32)
    for ids, least in ((np.tile(passage, 100), 64), (common, 3)):
        symbols, rules, lengths = tokens.repair(ids, least=least)
        assert np.array_equal(tokens.expand(symbols, rules, lengths), ids)
        pairs = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)[1]
        assert pairs.max() < least
        width = 2 if len(rules) < (1 << 16) - tokens.FIRST else 3
        row = tokens._rows([ids], [1], [len(ids)], 0, 0).to_pylist()[0]
        assert np.array_equal(tokens.decode_range(row, 100, 900), ids[100:900])
        assert np.array_equal(tokens._from_bytes(tokens._to_bytes(rules, width), width),
                              rules.ravel())
    assert len(rules) > (1 << 16) - tokens.FIRST
    assert len(tokens.repair(np.tile(passage, 100))[0]) < 500


def test_random_access_reads_little_of_a_shard():
    rng = np.random.default_rng(7)
    passage = rng.integers(0, tokens.FIRST, 3000).astype(np.uint32)
    parts = [p for k in range(70) for p in (passage, rng.integers(0, 200, 2000 + k).astype(np.uint32))]
    ids = np.concatenate(parts)
    row = tokens._rows([ids], [1], [len(ids)], 0, 0).to_pylist()[0]
    assert len(np.frombuffer(row["offsets"], "<i8")) > 3
    old = {k: v for k, v in row.items() if k != "offsets"}
    for _ in range(200):
        a = int(rng.integers(0, len(ids)))
        b = min(len(ids), a + int(rng.integers(0, 5000)))
        assert np.array_equal(tokens.decode_range(row, a, b), ids[a:b])
    assert np.array_equal(tokens.decode_range(old, 5000, 9000), ids[5000:9000])
    assert np.array_equal(tokens.decode_range(row, 0, len(ids)), ids)
    # What lies elsewhere is not looked at: broken lengths and symbols change nothing.
    known = np.frombuffer(row["offsets"], "<i8")
    start = int(known[2])
    symbols = np.frombuffer(row["symbols"], np.uint8).copy()
    symbols[:2 * tokens.STEP * row["width"]] = 0
    broken = {**row, "symbols": symbols.tobytes()}
    assert np.array_equal(tokens.decode_range(broken, start, start + 10), ids[start:start + 10])


def test_token_index_of_odd_rows(odd, odd_rows, none):
    tok = tokens.Encoder(tokens.vocabulary_path()).tok
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"])
                 for r in tokens.token_index(odd, tokens.vocabulary_path()).collect())
    at, left = 0, [(r[0], _ids(tok, r[1])) for r in odd_rows]
    for start, doc, n, crc in got:
        assert start == at
        at += n
        left.remove(next((i, x) for i, x in left if i == doc and len(x) == n and
                         zlib.crc32(np.array(x, "<u4").tobytes()) == crc))
    assert not left
    ids = [g[1] for g in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert tokens.token_index(none, tokens.vocabulary_path()).collect() == []


ITEM = ("Tom Baker walked for 12 km and then Tom Baker paid 30 dollars to the old man who "
        "sold him 7 apples")
OTHER = ITEM.replace("Tom Baker", "Ann Lee").replace("12", "45").replace("30", "99")


def test_templates_and_slots(spark, table, none):
    bench = spark.createDataFrame(
        [(1, "Here " + ITEM), (2, "Here " + ITEM), (3, None), (4, "too short"),
         (5, "one plain item of just seven words")], "item_id bigint, text string")
    texts = ["before Here " + ITEM + " after that", "x Here " + OTHER,
             "x Here " + OTHER.replace("Ann Lee paid", "Joe Lee paid"), None, "",
             "Here Tom Baker walked for 12 km and then stopped",
             "say one plain item of just seven words again", "Here " + ITEM]
    docs = table(texts, ids=[0, 1, 2, 3, 4, 5, 6, None])
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in
           decontam.contaminated(docs, bench).collect()}
    assert got == {(0, 1): "verbatim", (1, 1): "reparameterised", (6, 5): "verbatim",
                   (None, 1): "verbatim"}
    left = decontam.clean(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 5]
    assert decontam.contaminated(none, bench).collect() == []
    assert decontam.contaminated(docs, bench.limit(0)).collect() == []


def test_short_items_in_the_middle_of_a_line(spark, table):
    bench = spark.createDataFrame(
        [(1, "What is the capital of France"), (2, "Ann Lee has 12 apples and eats 5 of them today"),
         (3, "Minutes are long when you wait for 3 buses")], "item_id bigint, text string")
    texts = ["Quiz\nWhat is the capital of France and more", "Q) What is the capital of France",
             "we ask What is the capital of Spain", "Who is the capital of France",
             "so Ann Lee has 30 apples and eats 7 of them today", "Here. What is the capital of France",
             "in 5 Minutes are long when you wait for 3 buses", "so What are the capital of France"]
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in
           decontam.contaminated(table(texts), bench).collect()}
    assert got == {(0, 1): "verbatim", (1, 1): "verbatim", (2, 1): "reparameterised",
                   (4, 2): "reparameterised", (5, 1): "verbatim", (6, 3): "verbatim"}


def test_items_without_a_template(spark, table):
    sums = "Add " + " + ".join(map(str, range(100, 130)))
    bench = spark.createDataFrame(
        [(1, "Compute 12 + 34 + 56 + 78 and 90"), (2, "7 + 5 ="), (3, sums), (4, "..."), (5, ""),
         (6, "one plain item of just seven words")], "item_id bigint, text string")
    texts = ["now Compute 12 + 34 + 56 + 78 and 90 !", "Compute 12 + 34 + 56 + 78 and 91",
             "is 7 + 5 = 12", "7 + 6 =", "x " + sums + " end", "x " + sums.replace("1", "2"), "...",
             "say one plain item of just seven words again"]
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in
           decontam.contaminated(table(texts), bench).collect()}
    assert got == {(0, 1): "verbatim", (2, 2): "verbatim", (4, 3): "verbatim", (7, 6): "verbatim"}


def test_decontamination_of_a_table(spark, con):
    got = {(r["doc_id"], r["item_id"]) for r in
           decontam.decontamination_query(spark, SMALL).collect()}
    assert got == set(con.execute("SELECT doc_id, item_id FROM documents d JOIN benchmark b "
                                  "ON contains(d.text, b.text)").fetchall())


def test_decontamination_of_odd_rows(odd, none):
    bench = odd.select("item_id", "text")
    assert decontam.contaminated(odd, bench).count() > 0
    assert decontam.clean(none, bench).collect() == []


def test_pipeline_stages(spark):
    """Each stage against a plain version over the rows that the stage before it kept."""
    from tests.llm.test_duplicates import _components, _fp
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, made = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        made[name] = sorted(map(tuple, docs.collect()))
    first = made["language_id"]
    assert len(first) == sum(langid.has_letter(r[1]) for r in first)
    groups = _components([_fp(r[1]) for r in first])
    keep = {}
    for row, g in zip(first, groups):
        keep[g] = min(keep.get(g, row), row)
    assert made["near_dedup"] == sorted(keep.values())
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert made["decontamination"] == [r for r in made["near_dedup"]
                                       if not any(x in r[1] for x in items)]
    taken = made["mixing"]
    assert set(taken) <= set(made["decontamination"])
    assert max(taken.count(r) for r in set(taken)) <= 2
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).orderBy("start").collect()
    tok = tokens.Encoder(tokens.vocabulary_path()).tok
    assert [r["doc_id"] for r in last] == [r[0] for r in taken]
    assert [r["n_tokens"] for r in last] == [len(_ids(tok, r[1])) for r in taken]


def test_pipeline_over_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.saved(stage(spark, docs, SMALL), name)
