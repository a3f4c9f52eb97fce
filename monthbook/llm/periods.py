"""Periodic runs of words: suffix trees, constant-time longest common extensions, Lyndon roots.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal)
and at least ``max(LEAST, POWER * q)`` words that no neighbouring word extends.

Method.  Ukkonen's algorithm builds the suffix tree of a document's words and that of the reversed
words.  An Euler tour of each, with the string depth of every visited node, makes the longest common
extension of two places the least depth between their leaves, answered in constant time (blocks, and
a sparse table over blocks).  The order of the leaves gives the next smaller and the next greater
suffix of every place, hence the longest Lyndon words that begin there under both orders of the
alphabet.  The Lyndon root of every run is among these, so each is extended to both sides by two
extension queries; all queries of a document are answered in one numpy call.  Time and memory are
linear in the words.

Before that, words that can be in no run are left out (:func:`live`).  In a run of period ``q`` every
word but the last ``q`` occurs again ``q`` words later, so these words form a stretch of at least
``3 q`` words that each recur within a third of its length.  Words that fail this split their
stretch, again and again; what is left, lengthened by a third, holds every run whole.  Prose loses
nearly all of its words here, periodic text none.

Documents are rows, so nothing is shuffled.

Defined results: words are runs of anything but space, tab, newline, \\v, \\f, \\r; null and empty
texts have no words and no runs; repeated rows repeat their result; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthbook.llm.common import WORD, doc_texts, ragged, read, slices, utf8

LEAST, POWER = 6, 4
ROUNDS = 64


def suffix_tree(word: list[int], letters: int) -> tuple[list[int], list[int], dict[int, int], list[int]]:
    """Ukkonen's tree of ``word``, whose last letter occurs nowhere else.

    Returns where each node's edge starts and ends in ``word``, the child by ``node * letters +
    first letter``, and the leaves in the order of their suffixes.  Node 0 is the root.
    """
    whole = len(word)
    start, end, link, child, leaves = [0], [0], [0], {}, []
    node = edge = length = pending = 0
    for i, letter in enumerate(word):
        pending += 1
        last = 0  # the inner node made before in this phase; it still needs its link
        while pending:
            if not length:
                edge = i
            at = node * letters + word[edge]
            to = child.get(at)
            if to is None:
                child[at] = len(start)
                leaves.append(len(start))
                start.append(i)
                end.append(whole)
                link.append(0)
                if last:
                    link[last], last = node, 0
            else:
                size = min(end[to], i + 1) - start[to]
                if length >= size:
                    edge, length, node = edge + size, length - size, to
                    continue
                split = start[to] + length
                if word[split] == letter:
                    length += 1
                    if last:
                        link[last] = node
                    break
                inner = len(start)
                child[at] = inner
                start += [start[to], i]
                end += [split, whole]
                link += [0, 0]
                start[to] = split
                child[inner * letters + word[split]] = to
                child[inner * letters + letter] = inner + 1
                leaves.append(inner + 1)
                if last:
                    link[last] = inner
                last = inner
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return start, end, child, leaves


class LeastBetween:
    """The least value between two positions: blocks of 16, a sparse table over their minima."""

    SIZE = 16

    def __init__(self, values: np.ndarray):
        size = self.SIZE
        blocks = np.full((len(values) // size + 1, size), np.iinfo(np.int32).max, np.int32)
        blocks.ravel()[: len(values)] = values
        self.flat = blocks.ravel()
        self.head = np.minimum.accumulate(blocks, axis=1).ravel()
        self.tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [blocks.min(axis=1)]
        while len(self.table[-1]) > 1 << len(self.table) - 1:
            row, step = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(row[:-step], row[step:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least value of positions ``a`` to ``b``, both included; ``a <= b``."""
        first, last = a // self.SIZE, b // self.SIZE
        out = np.minimum(self.tail[a], self.head[b])
        inside = np.flatnonzero(last - first > 1)
        low, high = first[inside] + 1, last[inside]  # blocks low .. high - 1
        depth = np.frexp((high - low).astype(np.float64))[1] - 1
        for level in np.unique(depth):
            pick = depth == level
            row, rows = self.table[level], inside[pick]
            least = np.minimum(row[low[pick]], row[high[pick] - (1 << level)])
            out[rows] = np.minimum(out[rows], least)
        same = np.flatnonzero(first == last)
        x, y = a[same], b[same]
        least = self.flat[x]
        for _ in range(1, self.SIZE):
            x = np.minimum(x + 1, y)
            least = np.minimum(least, self.flat[x])
        out[same] = least
        return out


class Extensions:
    """Longest common extensions of the suffixes of a word, from the Euler tour of its tree."""

    def __init__(self, word: list[int], letters: int):
        start, end, child, leaves = suffix_tree(word, letters)
        nodes = len(start)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        kids = np.fromiter(child.values(), np.int64, len(child))
        del child
        order = np.argsort(keys)  # by node, then by first letter
        kids = kids[order].tolist()
        ends = np.cumsum(np.bincount(keys // letters, minlength=nodes))
        at = np.concatenate([[0], ends[:-1]]).tolist()
        stop = ends.tolist()
        parent, depth, first, tour = [0] * nodes, [0] * nodes, [0] * nodes, []
        node = 0
        while True:
            tour.append(depth[node])
            k = at[node]
            if k < stop[node]:
                at[node] = k + 1
                kid = kids[k]
                parent[kid] = node
                depth[kid] = depth[node] + end[kid] - start[kid]
                first[kid] = len(tour)
                node = kid
            elif node:
                node = parent[node]
            else:
                break
        #: Where in the tour each suffix has its leaf; the order of the leaves is that of suffixes.
        self.place = np.array(first, np.int64)[np.array(leaves, np.int64)]
        self.least = LeastBetween(np.array(tour, np.int32))

    def ranks(self) -> np.ndarray:
        rank = np.empty(len(self.place), np.int64)
        rank[np.argsort(self.place)] = np.arange(len(self.place))
        return rank

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many letters the suffixes at ``i`` and ``j`` share; ``i != j``."""
        a, b = self.place[i], self.place[j]
        return self.least(np.minimum(a, b), np.maximum(a, b)).astype(np.int64)


def _next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one with a smaller rank; the number of places where none follows."""
    out, waiting = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while waiting and rank[waiting[-1]] > r:
            out[waiting.pop()] = i
        waiting.append(i)
    return out


def runs(word: np.ndarray, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """(start, length, period) of all runs of some letters (0, 1, ...), by start, then period."""
    n = len(word)
    letters = int(word.max()) + 2 if n else 1
    final = letters - 1
    ahead = Extensions([*word.tolist(), final], letters)
    rank = ahead.ranks()
    # With a last letter greater than all others, the other order of the alphabet is the reverse
    # of this one on suffixes too.
    roots = np.concatenate([_next_smaller(rank.tolist())[:n], _next_smaller((-rank).tolist())[:n]])
    i = np.tile(np.arange(n), 2)
    whole = roots <= n  # other words reach over the last letter
    i, p = i[whole], roots[whole] - i[whole]
    length = p + ahead(i, i + p)
    del ahead
    back = Extensions([*word[::-1].tolist(), final], letters)
    left = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > 0)
    # The place before `i` is place `n - i` of the reversed word.
    left[inner] = back(n - i[inner], n - i[inner] - p[inner])
    length += left
    good = length >= np.maximum(least, power * p)
    found = np.unique(np.stack([i - left, p, length], axis=1)[good], axis=0)
    return found[:, [0, 2, 1]]


def live(word: np.ndarray, owner: np.ndarray, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """Which words of some documents (``owner``) may be in a run; see the module's text."""
    n = len(word)
    order = np.lexsort((word, owner))
    same = (word[order][1:] == word[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    gap = np.full(n, n + 1, np.int64)
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    at = np.flatnonzero(gap <= n)
    shortest = min(least - 1, power * 2 - 2) if power > 1 else 1
    size = np.empty(0, np.int64)
    for _ in range(ROUNDS):  # stopping early keeps more words than needed, never fewer
        split = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
        first = np.concatenate([[0], np.flatnonzero(split) + 1]) if len(at) else at
        size = np.diff(np.append(first, len(at)))
        whole = np.repeat(size, size)
        keep = (gap[at] * (power - 1) <= whole) & (whole >= shortest)
        if keep.all():
            break
        at = at[keep]
    if not len(at):
        return np.zeros(n, bool)
    split = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
    first = np.concatenate([[0], np.flatnonzero(split) + 1])
    size = np.diff(np.append(first, len(at)))
    begin = at[first]
    stop = np.minimum(begin + size + size // max(power - 1, 1), np.searchsorted(owner, owner[begin], "right"))
    mark = np.bincount(begin, minlength=n + 1) - np.bincount(stop, minlength=n + 1)
    return np.cumsum(mark)[:n] > 0


def document_runs(word: np.ndarray, keep: np.ndarray, least: int = LEAST,
                  power: int = POWER) -> np.ndarray:
    """The runs of one document; only words under ``keep`` can be in one."""
    at = np.flatnonzero(keep)
    if not len(at):
        return np.empty((0, 3), np.int64)
    # One word of all live stretches, with a letter of its own between two of them.
    cuts = np.flatnonzero(at[1:] != at[:-1] + 1) + 1
    _, letter = np.unique(word[at], return_inverse=True)
    text = np.insert(letter, cuts, letter.max() + 1 + np.arange(len(cuts)))
    place = np.insert(at, cuts, -1)
    found = runs(text, least, power)
    found[:, 0] = place[found[:, 0]]
    return found


def repeats(found: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words some run contains after its first period."""
    begin, stop = found[:, 0] + found[:, 2], found[:, 0] + found[:, 1]
    return np.cumsum(np.bincount(begin, minlength=n + 1) - np.bincount(stop, minlength=n + 1))[:n] > 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = ("doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
        "collapsed string")


def find_runs(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: a row per row of ``docs``.

    ``runs`` are in order of start, then period; ``collapsed`` are the words that no run contains
    after its first period, joined by spaces.  ``power`` is 3 at least.
    """
    if power < 3 or least < 1:
        raise ValueError("power must be 3 or more, least 1 or more")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            # `split` of bytes cuts at exactly the six separators.
            data, at = utf8(batch.column(1))
            raw = data.tobytes()
            texts = [raw[a:b].split() for a, b in zip(at[:-1], at[1:])]
            number: dict[bytes, int] = {}
            word = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64)
            sizes = np.array([len(t) for t in texts], np.int64)
            ends = np.cumsum(sizes)
            keep = live(word, np.repeat(np.arange(len(texts)), sizes), least, power)
            hit = np.add.reduceat(np.append(keep, False), np.append(ends - sizes, ends[-1]),
                                  dtype=np.int64)[:-1] * (sizes > 0)
            found, kept = [], []
            for k, text in enumerate(texts):
                rows = np.empty((0, 3), np.int64)
                if hit[k]:
                    a, b = ends[k] - sizes[k], ends[k]
                    rows = document_runs(word[a:b], keep[a:b], least, power)
                if len(rows):
                    drop = repeats(rows, len(text)).tolist()
                    text = [w for w, gone in zip(text, drop) if not gone]
                found.append(rows)
                kept.append(b" ".join(text))
            every = np.concatenate(found)
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])])
            one = pa.StructArray.from_arrays([pa.array(every[:, c], pa.int64()) for c in range(3)],
                                             fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), one),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return doc_texts(docs).mapInArrow(scan, RUNS)


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in which one document in ten repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("bigint").cast("string"))
    tenth = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)
    cut = docs.select("doc_id", "text", h.alias("h"), tenth.alias("g"),
                      F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))

    def word(i: Column) -> Column:
        return F.get("words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))

    edited = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return cut.select("doc_id", F.when(n > 0, edited).otherwise(F.col("text")).alias("text"))


def runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, after one in ten was made periodic from some word on."""
    found = find_runs(planted(doc_texts(read(spark, sf_dir, "documents"))))
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
    length = -F.col("best.less")
    return rows.select("doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"),
                       F.col("best.period").alias("period"),
                       F.floor(length * 1000 / F.col("best.period")).alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")
