"""SimHash, suffixes, sketches and lines against brute force."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from monthbook.llm import linededup, simhash, sketches, suffixes
from monthbook.llm.graph import components


def _fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(fps, distance=4):
    """The least member of each component of a list of fingerprints, by position."""
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(fps))]


def test_simhash_of_odd_rows(odd, odd_rows):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fp"] & (2**64 - 1), r["component_id"])
                 for r in simhash.near_duplicates(odd).collect())
    fps = [_fp(r[1]) for r in odd_rows]
    groups = _components(fps)
    least = {}
    for r, g in zip(odd_rows, groups):
        ids = [x for x in (least.get(g), r[0]) if x is not None]
        least[g] = min(ids) if ids else None
    assert got == sorted((r[0] is None, r[0] or 0, fp, least[g])
                         for r, fp, g in zip(odd_rows, fps, groups))


def test_one_row_of_each_component_stays(odd, odd_rows):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    fps = [_fp(r[1]) for r in odd_rows]
    assert kept.count() == len(set(_components(fps)))


def test_simhash_of_nothing(none):
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.one_of_each(none).collect() == []


def test_dense_keys_lose_no_link(spark):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6)))
           for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(simhash._signed(f) for f in fps)
    nodes = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    want = _components([f & (2**64 - 1) for f in fps])
    for distance, dense in ((4, 10**9), (4, 3), (3, 3)):
        found = {r["node"]: r["root"] for r in
                 components(simhash.links(nodes, distance, dense)).collect()}
        want = _components([f & (2**64 - 1) for f in fps], distance)
        assert [found.get(f, f) for f in fps] == [fps[k] for k in want]


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(5, 5)]
    edges.append((200, None))
    frame = spark.createDataFrame(edges + edges, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components(frame).collect()}
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}


def test_thresholds_cover_the_distance():
    flat = [simhash._near(simhash.np.full(256, 10.0))] * 8
    for n in (10, 1e6, 1e10):
        groups = simhash.allocate(flat, n, 4)
        assert sum(t + 1 for _, t in groups) == 5


def _brute_suffixes(rows, length=suffixes.LENGTH):
    none = 1 << 70
    first = {}
    docs = [(none if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    for k, raw in docs:
        for p in range(len(raw) - length + 1):
            w = hash(raw[p:p + length])
            first[w] = min(first.get(w, none), k)
    out = []
    for k, raw in docs:
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[hash(raw[p:p + length])] < k:
                gone[p:p + length] = b"\1" * length
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out.append((k, len(raw), bytes(c for c, g in zip(raw, gone) if not g), spans))
    return sorted(out)


def _suffixes(df, **options):
    return sorted((1 << 70 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], bytes(r["kept"]),
                   [(s["start"], s["stop"]) for s in r["spans"]])
                  for r in suffixes.remove_repeats(df, **options).collect())


def test_suffixes_of_odd_rows(odd, odd_rows):
    assert _suffixes(odd) == _brute_suffixes(odd_rows)


def test_suffixes_over_many_small_runs(table):
    rng = random.Random(3)
    word = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))) for _ in range(50)]
    said = [" ".join(rng.choice(word) for _ in range(14)) for _ in range(9)]
    texts = [" ".join(rng.choice(said if rng.random() < .3 else word) for _ in range(25))
             for _ in range(150)] + ["ab " * 100, "ab " * 50, "x" * 200, "x" * 60, "q" * 49]
    ids = [rng.randint(0, 120) for _ in texts]
    df = table(texts, ids=ids)
    assert _suffixes(df.repartition(4), pack=2000, range_bytes=20_000) == _brute_suffixes(
        [(i, t) for i, t in zip(ids, texts)])


def test_a_document_longer_than_a_slice(table):
    rng = random.Random(1)
    long = "".join(rng.choice("abcd ") for _ in range(suffixes._SLICE + 5000))
    at = suffixes._SLICE - 500
    got = _suffixes(table([long, "##" + long[at:at + 1000] + "##"]))
    assert got[0][2:] == (long.encode(), []) and got[1][2:] == (b"####", [(2, 1002)])


def _lines(rng, number):
    """Lines with one constant part, different surroundings, and some equal stretches."""
    tails = ["".join(rng.choice("0123456789abcdef") for _ in range(30)) for _ in range(number // 4)]
    return [f"{rng.random()} GET https://example.org/static/path/{rng.choice(tails)} {k % 7}"
            for k in range(number)]


@pytest.mark.parametrize("hot", [2, 20, 1 << 17])
def test_suffixes_behind_a_hot_anchor_are_split_by_window(table, hot):
    rng = random.Random(5)
    lines = _lines(rng, 400)
    texts = ["\n".join(lines[k: k + 4]) for k in range(0, 400, 4)]
    texts += [texts[3] * 5, texts[3], "", "é" + texts[8]]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = _suffixes(table(texts).repartition(4), pack=3000, range_bytes=4000, hot=hot)
    assert got == _brute_suffixes(rows)


def test_a_hot_anchor_reaches_all_ranges():
    """One range without the split; as many as there are with it, each window in one of them."""
    import numpy as np
    rng, ranges = random.Random(6), 16
    data = "".join(_lines(rng, 3000)).encode()
    row = {"run": 0, "ids": suffixes._zip(np.array([1], "<i8").tobytes()),
           "ends": suffixes._zip(np.array([len(data)], "<i8").tobytes()),
           "bytes": suffixes._zip(data)}
    sizes = []
    for split in (False, True):
        pack = suffixes.Pack(row, ranges)
        pack.anchors()
        counts = np.diff(np.append(pack.new, len(pack.at)))
        common = counts > 1000  # the anchor of the constant part
        places, numbers = pack.surroundings()
        assert common.any() and (numbers[np.isin(places, np.flatnonzero(common))] > 900).all()
        pack.keep(common, common & split)
        sizes.append(np.bincount(pack.where, minlength=ranges))
        windows = {bytes(r): w for r, w in zip(pack.rows, pack.where)}
        assert len(windows) == len(pack.rows)
    assert (sizes[0] > 0).sum() <= common.sum() and (sizes[1] > 0).all()
    assert sizes[1].max() < 2 * sizes[1].mean()


def test_suffixes_of_nothing(none):
    assert _suffixes(none) == []


def test_loser_tree_merges_and_keeps_prefixes():
    rng = random.Random(4)
    lists = [sorted(bytes(rng.choice(b"ab") for _ in range(8)) for _ in range(rng.randint(1, 40)))
             for _ in range(7)]
    prefix = [suffixes.common_prefixes(suffixes.np.array([list(s) for s in x], "u1")).tolist()
              for x in lists]
    which, place, common = suffixes.merge(lists, prefix)
    merged = [lists[a][b] for a, b in zip(which, place)]
    assert merged == sorted(s for x in lists for s in x)
    assert common[1:] == [next((k for k in range(8) if x[k] != y[k]), 8)
                          for x, y in zip(merged, merged[1:])]


def test_front_coding_round_trip():
    strings = suffixes.np.array(sorted([list(b"aabb"), list(b"aabc"), list(b"abcc"), list(b"abcc")]),
                                "u1")
    prefix, rest = suffixes.front_code(strings)
    back = suffixes.front_decode(prefix, suffixes.np.frombuffer(rest, "u1"), 4)
    assert (back == strings).all() and len(rest) < strings.size


def _shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    return {tuple(words[k:k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()


def test_small_sketches_are_exact_and_mergeable(spark):
    pairs = [("a b c d e f g", "a b c d e f h"), ("", None), ("a", ""), ("a b", "a b"),
             ("q " * 50, "q " * 50 + "r"), ("A b C d e f", "a B c d e f z")]
    got = (spark.createDataFrame(pairs, "x string, y string")
           .select("x", "y", sketches.sketch(F.col("x")).alias("a"),
                   sketches.sketch(F.col("y")).alias("b"))
           .select("x", "y", sketches.resemblance(F.col("a"), F.col("b")).alias("r"),
                   sketches.containment(F.col("a"), F.col("b")).alias("c"),
                   sketches.distinct_shingles(F.col("a")).alias("n"),
                   sketches.merge(F.col("a"), F.col("b")).alias("m"))).collect()
    for row in got:
        x, y = _shingles(row["x"]), _shingles(row["y"])
        assert row["r"] == (len(x & y) / len(x | y) if x | y else 1.0)
        assert row["n"] == len(x) and len(row["m"]) == len(x | y)
        assert abs(row["c"] - (len(x & y) / len(x) if x else 1.0)) < 1e-9


def test_sketches_estimate_and_merge_over_parts(spark):
    words = [f"w{k}" for k in range(6000)]
    parts = [(0, " ".join(words[:3000])), (0, " ".join(words[2996:])), (0, " ".join(words[:3000]))]
    rows = spark.createDataFrame(parts, "g int, text string").select(
        "g", sketches.sketch(F.col("text")).alias("sketch"))
    merged = sketches.merge_all(rows, ["g"])
    whole = spark.createDataFrame([(" ".join(words),)], "text string").select(
        sketches.sketch(F.col("text")).alias("s"),
        sketches.distinct_shingles(sketches.sketch(F.col("text"))).alias("n")).first()
    assert merged.first()["sketch"] == whole["s"]
    assert abs(whole["n"] / 5996 - 1) < 0.3
    empty = rows.select("g", sketches.sketch(F.lit(" ")).alias("sketch"))
    assert sketches.merge_all(empty, ["g"]).first()["sketch"] == []


def test_next_text_and_odd_rows(odd, odd_rows, none):
    docs = sketches.doc_texts(odd)
    got = [(r["doc_id"], r["text"], r["next_text"]) for r in
           sketches.with_next(docs, {}).collect()]
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    texts = [r[1] or "" for r in order]
    want = [(r[0], t, texts[(k + 1) % len(texts)])
            for k, (r, t) in enumerate(zip(order, texts))]
    key = str
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sketches.with_next(sketches.doc_texts(none), {}).collect() == []


def test_fingerprint_query(spark, con):
    from tests.conftest import SMALL
    rows = {r["doc_id"]: r for r in sketches.fingerprint_query(spark, SMALL).collect()}
    docs = con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    assert len(rows) == len(docs)
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        row = rows[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = _shingles(text), _shingles(edited)
        assert abs(row["near_edited"] - len(a & b) / len(a | b)) < 0.2


def _brute_lines(rows, run, long):
    """Removed lines by the definition: windows of ``run`` non-blank lines, and single lines of
    ``long`` code points, seen earlier."""
    docs = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows},
                  key=lambda d: (d[0], d[1], _version(d[2])))
    first, out = {}, {}
    for d in docs:
        lines = d[2].split("\n")
        seen = [k for k, x in enumerate(lines) if x.strip(" ")]
        for p in range(len(seen) - run + 1):
            first.setdefault(tuple(lines[k] for k in seen[p:p + run]), (d, p))
        for p, k in enumerate(seen):
            first.setdefault(lines[k], (d, p))
    for d in docs:
        lines = d[2].split("\n")
        seen = [k for k, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for p in range(len(seen) - run + 1):
            at, q = first[tuple(lines[k] for k in seen[p:p + run])]
            if at != d or p >= q + run:
                gone |= set(seen[p:p + run])
        gone |= {k for p, k in enumerate(seen)
                 if len(lines[k]) >= long and first[lines[k]] != (d, p)}
        out[d] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return sorted((r[0] is None, r[0] or 0, *out[(r[0] is None, r[0] or 0, r[1] or "")])
                  for r in rows)


def _version(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def test_lines_of_odd_rows_and_longer_guarantees(odd, odd_rows, table, none):
    rng = random.Random(8)
    texts = ["\n".join(rng.choice(["a", "b", "c", "", " ", "long line"]) for _ in range(
        rng.randint(0, 12))) for _ in range(60)]
    ids = [rng.randint(0, 40) for _ in texts]
    mine = [(i, t) for i, t in zip(ids, texts)]
    for gram, run, long, df, rows in (
            (1, 2, 40, odd, odd_rows), (1, 2, 40, table(texts, ids=ids), mine),
            (1, 2, 9, table(texts, ids=ids), mine), (1, 3, 9, table(texts, ids=ids), mine),
            (2, 3, 40, table(texts, ids=ids), mine), (1, 1, 40, table(texts, ids=ids), mine)):
        got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_lines"], r["n_removed"], r["kept"])
                     for r in linededup.remove_repeats(df, gram, run, long).collect())
        assert got == _brute_lines(rows, run, long)
    assert linededup.remove_repeats(none).collect() == []


def test_a_passage_on_one_line_is_found_between_any_neighbours(table):
    passage = " ".join(f"w{k}" for k in range(60))
    texts = [f"intro {k}\n{passage}\nmenu\nend {k}" for k in range(6)]
    got = {r["doc_id"]: r["kept"] for r in linededup.remove_repeats(table(texts)).collect()}
    # The line after the passage goes with it, as a run of two; it stays where it is alone.
    assert got == {0: texts[0], **{k: f"intro {k}\nend {k}" for k in range(1, 6)}}
    texts = [f"intro {k}\nmenu\nend {k}\n{passage}" for k in range(6)]
    got = {r["doc_id"]: r["kept"] for r in linededup.remove_repeats(table(texts)).collect()}
    assert got == {0: texts[0], **{k: f"intro {k}\nmenu\nend {k}" for k in range(1, 6)}}
