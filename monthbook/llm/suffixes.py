"""Removal of repeated byte strings with a distributed, common-prefix-aware merge sort of suffixes.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller doc_id.  Strings are judged on the input and never cross documents.

Which suffixes.  Of every window of LENGTH bytes the GRAM-byte string with the least hash (the
leftmost of equal ones) is the window's anchor.  Equal windows have equal anchors at equal places,
so it is enough to sort the suffixes at anchors: about one position in eighteen.  A window is given
by its anchor and the number j of bytes that it begins before the anchor; the windows of one anchor
are a range of j.

Steps, each on *runs* (packs of whole documents, written once, bucketed by run):

1. Duplicate detection on prefixes: each run sends the sorted hashes of its anchors' GRAM bytes, by
   ranges of the hash; what comes back is one bit per hash: does another document have it?  And
   one more: is it hot, that is, are there ``HOT`` different surroundings of it or more?
2. Runs sort the suffixes at the anchors that remain.  Equal ones are one record with the least
   doc_id, so a passage that fills the corpus is one record per run.  A suffix is LENGTH bytes to
   the right and, for windows that begin earlier, up to LENGTH - GRAM bytes to the left.  Sorted
   runs are front-coded (the common prefix with the string before, and the rest), compressed and
   dealt out by the hash range of their first GRAM bytes, where all equal windows meet.  A hot
   anchor (the constant start of a log line, say) would bring a record of every place it occurs at
   to one range: it is split into one record per window, dealt out by the hash of the window.
3. Each range merges its sorted runs with a loser tree over common prefix lengths: two strings with
   different common prefixes with the last winner need no look at their bytes, others are compared
   behind the common prefix only.  The merge gives the common prefixes of neighbours in the whole
   order.  For each j, the windows with equal LENGTH - j bytes to the right (neighbours with a
   common prefix as long) and equal j bytes to the left are equal, and the least doc_id among them
   goes back to the runs that have a greater one.
4. Runs turn the answers into byte ranges and cut them out.

Memory: a task holds one pack, or one hash range of all runs; ranges grow in number with the input,
and no anchor brings more than ``HOT`` records to one, nor a window more than one per run.

Defined results: null and empty texts have no bytes; documents with a null doc_id come after all
others and take nothing from each other, like rows that share a doc_id; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.llm.common import doc_texts, large_binary, partitions, ragged, read, saved, slices, utf8
from monthbook.session import scratch_path

LENGTH = 50
GRAM = 16  # bytes of an anchor: two words of eight
PACK = 4 << 20
RANGE_BYTES = 8 << 20  # of text per hash range
BUCKETS = 50_000  # Spark takes 100,000 at most
HOT = 1 << 17  # records of one anchor
_SLICE = 1 << 18
_LAST = np.iinfo(np.int64).max  # stands for a null doc_id
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
_LOW48 = np.uint64((1 << 48) - 1)


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unzip(data: bytes, kind: str = "u1") -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


# --- packs -----------------------------------------------------------------------------------

PACKS = "run bigint, ids binary, ends binary, bytes binary"


def _pack(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 24
        ids, sizes, parts, total = [], [], [], 0

        def row() -> pa.RecordBatch:
            values = [run, _zip(np.concatenate(ids).tobytes()),
                      _zip(np.cumsum(np.concatenate(sizes)).tobytes()), _zip(b"".join(parts))]
            kinds = [pa.int64(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                              names=["run", "ids", "ends", "bytes"])

        for batch in slices(batches, 1 << 20):
            data, offsets = utf8(batch.column(1))
            ids.append(np.asarray(batch.column(0).fill_null(_LAST), dtype=np.int64))
            sizes.append(np.diff(offsets))
            parts.append(data.tobytes())
            total += len(data)
            if total >= size:
                yield row()
                ids, sizes, parts, total, run = [], [], [], 0, run + 1
        if ids:
            yield row()
    return pack


class Pack:
    """The documents of a run and the anchors in them."""

    def __init__(self, row: dict, ranges: int) -> None:
        self.run, self.ranges = row["run"], ranges
        self.ids, self.ends = _unzip(row["ids"], "<i8"), _unzip(row["ends"], "<i8")
        self.data = _unzip(row["bytes"])
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def _pieces(self) -> Iterator[tuple[int, int, int]]:
        """(first document, last document, first byte, last byte): some documents, or part of one."""
        k, n = 0, len(self.ids)
        while k < n:
            if self.ends[k] - self.starts[k] > _SLICE:
                for at in range(int(self.starts[k]), int(self.ends[k]), _SLICE):
                    yield k, k, at, min(at + _SLICE + LENGTH - 1, int(self.ends[k]))
                k += 1
            else:
                to = int(np.searchsorted(self.ends, self.starts[k] + _SLICE, "right"))
                to = max(k + 1, to)
                yield k, to - 1, int(self.starts[k]), int(self.ends[to - 1])
                k = to

    def anchors(self) -> None:
        """Sets anchor, first and last window, document and hash range / hash of each anchor."""
        found = []
        for k, last, a, b in self._pieces():
            starts = np.maximum(self.starts[k: last + 1], a) - a
            ends = np.minimum(self.ends[k: last + 1], b) - a
            one = _anchors(self.data[a:b], starts, ends)
            if one is not None:
                at, lo, hi, doc, hashed = one
                found.append((at + a, lo + a, hi + a, doc + k, hashed))
        if not found:
            found = [tuple(np.zeros(0, t) for t in (np.int64,) * 4 + (np.uint64,))]
        self.at, self.lo, self.hi, self.doc, hashed = (np.concatenate(x) for x in zip(*found))
        # Anchors have small hashes, being minima: mixed again, they fill the ranges evenly.
        hashed = hashed * _C[1]
        hashed ^= hashed >> np.uint64(32)
        hashed *= _C[0]
        where = ((hashed >> np.uint64(32)) * np.uint64(self.ranges)) >> np.uint64(32)
        self.key = (where << np.uint64(48)) | (hashed & _LOW48)
        order = np.argsort(self.key, kind="stable")
        new = np.flatnonzero(np.diff(self.key[order], prepend=~self.key[order][:1]) != 0)
        self.order, self.new = order, new
        self.keys = self.key[order][new]

    def several(self) -> np.ndarray:
        """Of each distinct hash: do two documents of this run have it?"""
        docs = self.ids[self.doc][self.order]
        return np.minimum.reduceat(docs, self.new) != np.maximum.reduceat(docs, self.new)

    def surroundings(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes with several different records, and (by hashes) how many: not too few."""
        counts = np.diff(np.append(self.new, len(self.at)))
        group = np.repeat(np.arange(len(counts)), counts)
        often = np.repeat(counts > 1, counts)
        anchor, group = self.order[often], group[often]
        # Of all bytes that a record may hold, and of its windows.
        padded = np.concatenate([np.zeros(LENGTH, np.uint8), self.data, np.zeros(2 * LENGTH, np.uint8)])
        words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        at = self.at[anchor]
        mixed = ((at - self.lo[anchor]) * LENGTH + at - self.hi[anchor]).astype(np.uint64)
        for k in range(-LEFT, LENGTH, 8):
            mixed = (mixed ^ words[at + (LENGTH + k)]) * _C[0]
            mixed ^= mixed >> np.uint64(31)
        order = np.lexsort((mixed, group))
        group, mixed = group[order], mixed[order]
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | (mixed[1:] != mixed[:-1])
        found = np.bincount(group[new], minlength=len(counts))
        several = np.flatnonzero(found > 1)
        return several, found[several]

    def keep(self, repeated: np.ndarray, hot: np.ndarray) -> None:
        """Drops the anchors whose hash is not repeated, and makes the sorted records.

        A hot anchor becomes one for each of its windows.
        """
        wanted, split = np.zeros((2, len(self.at)), bool)
        counts = np.diff(np.append(self.new, len(self.at)))
        wanted[self.order[np.repeat(repeated, counts)]] = True
        split[self.order[np.repeat(hot, counts)]] = True
        self.at, self.lo, self.hi, self.doc, self.key, split = (
            x[wanted] for x in (self.at, self.lo, self.hi, self.doc, self.key, split))
        if split.any():
            many = np.where(split, self.hi - self.lo + 1, 1)
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            self.at, self.lo, self.hi, self.doc, self.key, split = (
                np.repeat(x, many) for x in (self.at, self.lo, self.hi, self.doc, self.key, split))
            self.lo = self.lo + place
            self.hi = np.where(split, self.lo, self.hi)
        before, after = self.at - self.lo, LENGTH - (self.at - self.hi)
        self.jhi, self.jlo = before.astype(np.uint8), (self.at - self.hi).astype(np.uint8)
        rows = np.zeros((len(self.at), WIDTH), np.uint8)
        padded = np.concatenate([np.zeros(LENGTH, np.uint8), self.data, np.zeros(LENGTH, np.uint8)])
        for k in range(LENGTH):
            rows[:, k] = np.where(k < after, padded[self.at + (LENGTH + k)], 0)
        for k in range(LEFT):
            rows[:, LENGTH + k] = np.where(k < before, padded[self.at + (LENGTH - 1 - k)], 0)
        rows[:, -2], rows[:, -1] = self.jlo, self.jhi
        order = np.argsort(rows.view(f"S{WIDTH}").ravel(), kind="stable")
        where = (self.key >> np.uint64(48)).astype(np.int64)
        if split.any():
            where[split] = _window_ranges(rows[split], self.ranges)
        order = order[np.argsort(where[order], kind="stable")]
        rows = rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        self.rows, self.where = rows[first], where[order][first]
        self.record = np.empty(len(order), np.int64)  # the record of each anchor
        self.record[order] = np.cumsum(new) - 1
        docs = self.ids[self.doc][order]
        self.least = np.minimum.reduceat(docs, first) if len(first) else docs


LEFT = LENGTH - GRAM
WIDTH = LENGTH + LEFT + 2


def _window_ranges(rows: np.ndarray, ranges: int) -> np.ndarray:
    """The hash range of records that are one window each."""
    padded = np.zeros((len(rows), -(-WIDTH // 8) * 8), np.uint8)
    padded[:, :WIDTH] = rows
    hashed = np.zeros(len(rows), np.uint64)
    for word in padded.view("<u8").T:
        hashed = (hashed ^ word) * _C[0]
        hashed ^= hashed >> np.uint64(31)
    hashed *= _C[1]
    hashed ^= hashed >> np.uint64(29)
    return (((hashed >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Of each anchor: place, first and last window, document, hash of its GRAM bytes.

    The windows of the documents ``starts .. ends`` only; places count from the first byte.
    """
    good = ends - starts >= LENGTH
    if not good.any():
        return None
    m = len(data) - GRAM + 1
    hashed = np.zeros(m, np.uint64)
    for k in range(GRAM // 8):
        hashed += np.ndarray((m,), "<u8", data, offset=8 * k, strides=(1,)) * _C[k]
        hashed ^= hashed >> np.uint64(31)
    hashed *= _C[0]
    hashed ^= hashed >> np.uint64(29)
    # The place in the low bits: a minimum then names its place, the leftmost of equal hashes.
    bits = np.uint64(int(m).bit_length())
    value = (hashed >> bits << bits) | np.arange(m, dtype=np.uint64)
    span, windows = 1, LENGTH - GRAM + 1
    while span * 2 <= windows:
        value = np.minimum(value[:-span], value[span:])
        span *= 2
    if span < windows:
        value = np.minimum(value[: len(value) - (windows - span)], value[windows - span:])
    at = (value & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    change = np.empty(len(at), bool)
    change[0] = True
    np.not_equal(at[1:], at[:-1], out=change[1:])
    change[starts[good]] = True
    stop = ends[good] - LENGTH + 1
    change[stop[stop < len(at)]] = True
    lo = np.flatnonzero(change)
    hi = np.append(lo[1:], len(at)) - 1
    doc = np.searchsorted(starts, lo, side="right") - 1
    # `starts` may repeat for empty documents: the last of them holds the byte
    inside = lo + LENGTH <= ends[doc]
    at, lo, hi, doc = at[lo[inside]], lo[inside], hi[inside], doc[inside]
    return at, lo, hi, doc, hashed[at]


# --- 1: which hashes are repeated ------------------------------------------------------------

HASHES = "range int, run bigint, hashes binary, several binary, places binary, numbers binary"
REPEATS = "run bigint, range int, bits binary, hot binary"


def _rows(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def _packs(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[tuple[Pack, dict]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            pack = Pack(row, ranges)
            pack.anchors()
            yield pack, row


def _send_hashes(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, _ in _packs(batches, ranges):
            if not len(pack.keys):
                continue
            several = pack.several()
            where = (pack.keys >> np.uint64(48)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(where, prepend=-1))
            raw = (pack.keys & _LOW48).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            places, numbers = pack.surroundings()
            stops = np.append(cuts[1:], len(where))
            first, last = np.searchsorted(places, cuts), np.searchsorted(places, stops)
            out = [(int(where[a]), pack.run, raw[a:b].tobytes(), np.packbits(several[a:b]).tobytes(),
                    (places[c:d] - a).astype("<u4").tobytes(), numbers[c:d].astype("<u4").tobytes())
                   for a, b, c, d in zip(cuts, stops, first, last)]
            yield _rows(["range", "run", "hashes", "several", "places", "numbers"],
                        [pa.int32(), pa.int64(), *[pa.binary()] * 4], out)
    return run


def _repeated(least: int):
    """``least`` different surroundings make a hash hot."""
    return lambda table: _repeats_and_hot(table, least)


def _repeats_and_hot(table: pa.Table, least: int) -> pa.Table:
    """Two bits per hash of each run: two documents have it, in the run or in two runs; it is hot."""
    blobs = table.column("hashes").to_pylist()
    sizes = np.array([len(b) // 6 for b in blobs])
    wide = np.zeros((int(sizes.sum()), 8), np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
    keys = wide.view("<u8").ravel()
    several = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=n) for s, n in
                              zip(table.column("several").to_pylist(), sizes)]).astype(bool)
    order = np.argsort(keys, kind="stable")
    new = np.flatnonzero(np.diff(keys[order], prepend=~keys[order][:1]) != 0)
    counts = np.diff(np.append(new, len(keys)))
    # Runs are packs of whole rows, but a repeated doc_id may lie in two of them: that only keeps
    # a hash that could go.
    many = (counts > 1) | np.logical_or.reduceat(several[order], new)
    ends = np.cumsum(sizes)
    number = np.ones(len(keys), np.int64)
    for begin, place, count in zip(ends - sizes, table.column("places").to_pylist(),
                                   table.column("numbers").to_pylist()):
        number[begin + np.frombuffer(place, "<u4").astype(np.int64)] = np.frombuffer(count, "<u4")
    crowded = np.add.reduceat(number[order], new) >= least
    found, hot = np.empty((2, len(keys)), bool)
    found[order], hot[order] = np.repeat(many, counts), np.repeat(many & crowded, counts)
    bits = [np.packbits(found[b - n: b]).tobytes() for b, n in zip(ends, sizes)]
    # Nothing where no hash of the run is hot.
    hots = [np.packbits(hot[b - n: b]).tobytes() if hot[b - n: b].any() else b""
            for b, n in zip(ends, sizes)]
    return pa.table({"run": table.column("run"), "range": table.column("range"),
                     "bits": pa.array(bits, pa.binary()), "hot": pa.array(hots, pa.binary())})


# --- 2: sorted, front-coded runs ---------------------------------------------------------------

RUNS = "range int, run bigint, first bigint, coded binary"


def common_prefixes(strings: np.ndarray) -> np.ndarray:
    """Of each row of a byte matrix: the length of its common prefix with the row before."""
    out = np.zeros(len(strings), np.uint8)
    if len(strings) > 1:
        differ = strings[1:] != strings[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), strings.shape[1])
    return out


def front_code(strings: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Sorted strings as common prefixes and the bytes behind them."""
    prefix = common_prefixes(strings)
    return prefix, strings[np.arange(strings.shape[1]) >= prefix[:, None]].tobytes()


def front_decode(prefix: np.ndarray, rest: np.ndarray, width: int) -> np.ndarray:
    """The reverse of :func:`front_code`."""
    out = np.zeros((len(prefix), width), np.uint8)
    own = np.arange(width) >= prefix[:, None]
    out[own] = rest
    rows = np.arange(len(prefix))
    for k in range(width):  # a byte in the common prefix is that of the last row that has its own
        out[:, k] = out[np.maximum.accumulate(np.where(own[:, k], rows, 0)), k]
    return out


def _repeats_of(pack: Pack, row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Two bits per distinct hash of the pack, from the answers to its ranges in order."""
    where = (pack.keys >> np.uint64(48)).astype(np.int64)
    counts = np.bincount(where, minlength=pack.ranges)
    found = [np.zeros((0, 2), bool)]
    for x in row["repeats"] or []:
        n = counts[x["range"]]
        both = np.zeros((n, 2), bool)
        for k, bits in enumerate((x["bits"], x["hot"])):
            if bits:
                both[:, k] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n)
        found.append(both)
    return tuple(np.concatenate(found).T)


def _send_runs(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, row in _packs(batches, ranges):
            pack.keep(*_repeats_of(pack, row))
            cuts = np.flatnonzero(np.diff(pack.where, prepend=-1))
            out = []
            for a, b in zip(cuts, np.append(cuts[1:], len(pack.where))):
                prefix, rest = front_code(pack.rows[a:b, :LENGTH])
                parts = [prefix.tobytes(), pack.rows[a:b, LENGTH:].tobytes(),
                         pack.least[a:b].astype("<i8").tobytes(), rest]
                out.append((int(pack.where[a]), pack.run, int(a),
                            int(b - a).to_bytes(4, "little") + _zip(b"".join(parts))))
            if out:
                yield _rows(["range", "run", "first", "coded"],
                            [pa.int32(), pa.int64(), pa.int64(), pa.binary()], out)
    return run


# --- 3: merge -----------------------------------------------------------------------------------

def merge(strings: list[list[bytes]], prefixes: list[list[int]]) -> tuple[list[int], list[int],
                                                                         list[int]]:
    """Merges sorted lists of equally long strings with a loser tree over common prefixes.

    ``prefixes`` are the common prefixes within each list.  Returns, in merged order, the list and
    the place in it of each string, and its common prefix with the string before it.

    ``have[s]`` is the common prefix of the head of list s with the last string that beat it.  The
    greater prefix is the smaller string; only equal prefixes need bytes, and those behind them.
    """
    count = len(strings)
    size = 1 << max(0, count - 1).bit_length()
    full = len(strings[0][0])
    have = [0] * count + [-1] * (size - count)  # -1: the list is at its end
    head = [s[0] for s in strings] + [b""] * (size - count)
    place, ends = [0] * size, [len(s) for s in strings]
    tree = [0] * (2 * size)

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser, and what the loser now has in common with the winner."""
        if have[a] != have[b]:
            return (a, b) if have[a] > have[b] else (b, a)
        done = have[a]
        if done < 0 or done == full:
            return a, b
        x, y = head[a][done:], head[b][done:]
        if x == y:
            have[b] = full
            return a, b
        bits = (int.from_bytes(x) ^ int.from_bytes(y)).bit_length()
        shared = done + (8 * len(x) - bits) // 8
        if x < y:
            have[b] = shared
            return a, b
        have[a] = shared
        return b, a

    winners = list(range(size))
    node = size
    while node > 1:  # the first round, level by level
        node //= 2
        played = [play(winners[2 * k], winners[2 * k + 1]) for k in range(node)]
        tree[node: 2 * node] = [loser for _, loser in played]
        winners = [w for w, _ in played]
    best = winners[0]
    lists, places, common = [], [], []
    while have[best] >= 0:
        lists.append(best)
        places.append(place[best])
        common.append(have[best])
        at = place[best] = place[best] + 1
        if at == ends[best]:
            have[best] = -1
        else:
            have[best], head[best] = prefixes[best][at], strings[best][at]
            if have[best] == full:
                continue  # equal to the string just taken: it is next
        node = (best + size) // 2
        mine = have[best]
        while node:
            other = tree[node]
            theirs = have[other]
            if theirs > mine:
                tree[node], best, mine = best, other, theirs
            elif theirs == mine and 0 <= mine < full:
                best, tree[node] = play(best, other)
                mine = have[best]
            node //= 2
    return lists, places, common


def least_documents(common: np.ndarray, left: np.ndarray, jlo: np.ndarray, jhi: np.ndarray,
                    docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(record, first j, last j, doc_id) where equal windows of a smaller doc_id exist.

    Records are in merged order; ``common`` are their common prefixes, ``left`` the bytes to the
    left of the anchor, outwards.
    """
    found = []
    hashed = np.zeros(len(docs), np.uint64)
    none = np.full(len(docs), _LAST)
    before, since = none, np.zeros(len(docs), np.int16)  # the open range of each record

    def close(now: np.ndarray, j: int) -> None:
        """Ends the ranges whose answer is another one from ``j`` on, and opens the new ones."""
        changed = now != before
        ended = np.flatnonzero(changed & (before != _LAST))
        found.append((ended, since[ended], np.full(len(ended), j - 1, np.int16), before[ended]))
        since[changed] = j

    for j in range(LEFT + 1):
        if j:
            hashed = (hashed ^ (left[:, j - 1].astype(np.uint64) + np.uint64(1))) * _C[0]
            hashed ^= hashed >> np.uint64(32)
        # Equal to the right: neighbours with a common prefix of LENGTH - j bytes.
        group = np.cumsum(common < LENGTH - j, dtype=np.int32)
        part = np.flatnonzero((jlo <= j) & (j <= jhi))
        g = group[part]
        near = np.zeros(len(part), bool)
        near[1:] = g[1:] == g[:-1]
        near[:-1] |= near[1:]
        part, g = part[near], g[near]
        now = none
        if len(part):
            order = np.lexsort((hashed[part], g))
            part, g, h = part[order], g[order], hashed[part][order]
            new = np.ones(len(part), bool)
            new[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
            first = np.flatnonzero(new)
            least = np.repeat(np.minimum.reduceat(docs[part], first),
                              np.diff(np.append(first, len(part))))
            lower = least < docs[part]
            now = none.copy()
            now[part[lower]] = least[lower]
        close(now, j)
        before = now
    close(none, LEFT + 1)
    record, jlo, jhi, least = (np.concatenate(x) for x in zip(*found))
    return record, jlo, jhi, least


ANSWERS = "run bigint, found binary"
_ANSWER = np.dtype([("record", "<u4"), ("jlo", "u1"), ("jhi", "u1"), ("doc", "<i8")])


def _merge_range(table: pa.Table) -> pa.Table:
    runs = table.column("run").to_pylist()
    offsets = table.column("first").to_pylist()
    tails, docs, strings, prefixes = [], [], [], []
    for coded in table.column("coded").to_pylist():
        n, raw = int.from_bytes(coded[:4], "little"), _unzip(coded[4:])
        cuts = np.cumsum([n, n * (LEFT + 2), 8 * n])
        prefix, tail, least, rest = np.split(raw, cuts)
        tails.append(tail.reshape(n, LEFT + 2))
        docs.append(np.frombuffer(least.tobytes(), "<i8"))
        flat = front_decode(prefix, rest, LENGTH).tobytes()
        strings.append([flat[k: k + LENGTH] for k in range(0, len(flat), LENGTH)])
        prefixes.append(prefix.tolist())
    lists, places, common = merge(strings, prefixes)
    lists, places = np.array(lists), np.array(places)
    begins = np.cumsum([0, *[len(d) for d in docs]])[:-1]
    order = begins[lists] + places
    tail, doc = np.concatenate(tails)[order], np.concatenate(docs)[order]
    record, jlo, jhi, least = least_documents(np.array(common), tail[:, :LEFT], tail[:, -2],
                                              tail[:, -1], doc)
    out = np.zeros(len(record), _ANSWER)
    out["jlo"], out["jhi"], out["doc"] = jlo, jhi, least
    out["record"] = (np.array(offsets)[lists] + places)[record]
    owner = lists[record]
    by = np.argsort(owner, kind="stable")
    found = np.searchsorted(owner[by], np.arange(len(runs) + 1))
    return pa.table({"run": pa.array(runs, pa.int64()), "found": pa.array(
        [_zip(out[by[a:b]].tobytes()) for a, b in zip(found, found[1:])], pa.binary())})


# --- 4: cut -------------------------------------------------------------------------------------

CUT = ("doc_id bigint, n_bytes bigint, kept binary, "
       "spans array<struct<start:bigint,stop:bigint>>")


def _covered(pack: Pack, answers: np.ndarray) -> np.ndarray:
    """Which bytes of a pack go."""
    count = len(pack.least)
    # Every record also knows the least document of its own run.
    record = np.concatenate([np.arange(count), answers["record"].astype(np.int64)])
    jlo = np.concatenate([pack.rows[:, -2], answers["jlo"]]).astype(np.int64)
    jhi = np.concatenate([pack.rows[:, -1], answers["jhi"]]).astype(np.int64)
    least = np.concatenate([pack.least, answers["doc"]])
    order = np.argsort(record, kind="stable")
    number = np.bincount(record, minlength=count)
    begin = np.cumsum(number) - number
    many = number[pack.record]  # ranges of each anchor's record
    pick = order[ragged(begin[pack.record], many)]
    anchor = np.repeat(np.arange(len(pack.record)), many)
    low = least[pick] < pack.ids[pack.doc[anchor]]
    at, pick = pack.at[anchor[low]], pick[low]
    step = np.zeros(len(pack.data) + 1, np.int32)
    np.add.at(step, at - jhi[pick], 1)
    np.add.at(step, at - jlo[pick] + LENGTH, -1)
    np.cumsum(step, out=step)
    return step[:-1] > 0


def _cut(ranges: int):
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, row in _packs(batches, ranges):
            pack.keep(*_repeats_of(pack, row))
            parts = [_unzip(x) for x in row["answers"] or []]
            raw = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
            gone = _covered(pack, np.frombuffer(raw.tobytes(), _ANSWER))
            edge = np.zeros(len(gone) + 1, bool)
            edge[pack.starts] = edge[-1] = True
            opens = gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]]))
            closes = gone & (edge[1:] | ~np.concatenate([gone[1:], [False]]))
            start, stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
            owner = np.searchsorted(pack.ends, start, side="right")
            lists = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(pack.ids)))])
            left = np.zeros(len(gone) + 1, np.int32)
            np.cumsum(~gone, out=left[1:])
            left = left[np.append(pack.starts, len(gone))]
            base = pack.starts[owner]
            spans = pa.StructArray.from_arrays([pa.array(start - base), pa.array(stop - base)],
                                               fields=list(span))
            kept = large_binary(pack.data[~gone], left).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(pack.ids, mask=pack.ids == _LAST), pa.array(pack.ends - pack.starts), kept,
                 pa.ListArray.from_arrays(pa.array(lists, pa.int32()), spans)],
                names=["doc_id", "n_bytes", "kept", "spans"])
    return run


def remove_repeats(docs: DataFrame, pack: int = PACK, range_bytes: int = RANGE_BYTES,
                   buckets: int = BUCKETS, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, kept (the bytes that stay), spans (start, stop of the bytes that go).

    With more packs than ``buckets`` a bucket holds several; they are read one after the other.
    """
    spark = docs.sparkSession
    texts = doc_texts(docs)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(65_000, max(partitions(spark), total // range_bytes))
    name, path = f"packs_{uuid.uuid4().hex}", scratch_path(spark, "packs")
    # Bucketed by run: the answers come to the packs, which are never shuffled.
    (texts.mapInArrow(_pack(pack), PACKS).write.bucketBy(int(min(buckets, max(1, total // pack))), "run")
     .option("path", path).saveAsTable(name))
    packs = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the name: the files, in the shared folder, stay
    repeats = (packs.mapInArrow(_send_hashes(ranges), HASHES).groupBy("range")
               .applyInArrow(_repeated(hot), REPEATS))
    repeats = saved(repeats, "repeats").groupBy("run").agg(
        F.sort_array(F.collect_list(F.struct("range", "bits", "hot"))).alias("repeats"))
    told = packs.join(repeats, "run", "left")
    answers = (told.mapInArrow(_send_runs(ranges), RUNS).groupBy("range")
               .applyInArrow(_merge_range, ANSWERS))
    answers = saved(answers, "answers").groupBy("run").agg(
        F.collect_list("found").alias("answers"))
    return told.join(answers, "run", "left").mapInArrow(_cut(ranges), CUT)


def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document."""
    found = remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"),
                          lambda total, s: total + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("bigint").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


SUFFIX_SQL = f"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - {LENGTH - 1}, 0))) AS i
  FROM docs),
strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, {2 * LENGTH}) AS s FROM starts),
least AS (SELECT s, min(doc_id) AS first_doc FROM strings GROUP BY s),
gone AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
  FROM strings JOIN least USING (s) WHERE doc_id > first_doc),
runs AS (SELECT doc_id, i, count(*) FILTER (before IS NULL OR i > before + {LENGTH})
  OVER (PARTITION BY doc_id ORDER BY i) AS run FROM gone),
spans AS (SELECT doc_id, min(i) AS a, max(i) + {LENGTH} AS b FROM runs GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS after FROM spans
  UNION ALL SELECT doc_id, length(h) // 2, NULL, coalesce((SELECT max(b) FROM spans s
    WHERE s.doc_id = d.doc_id), 0) FROM docs d),
kept AS (SELECT c.doc_id, string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a, b)
    AS h, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed, count(b) AS n_spans
  FROM cuts c JOIN docs d ON c.doc_id = d.doc_id GROUP BY c.doc_id)
SELECT doc_id, length(d.h) // 2 AS n_bytes, n_removed, n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM kept k JOIN docs d USING (doc_id)
"""
