"""Benchmark decontamination by template canonicalisation.

Words are lower-cased and lose their outer punctuation.  Numbers, names and units become typed
placeholders, their values the slots: a number is anything that starts with a digit (after a sign
or a currency mark) and holds digits and number punctuation only, a unit is a word of ``UNITS``
behind a number, or behind digits within the word, and a name is a capitalised word that does not
begin a sentence.  The result is the template of a text.  A name or a unit is told by the word before
it, and the first word of an item has none: so a window of a document that begins with a name or a
unit is also taken with that word as it is.

Every window of ``window`` template words with enough plain words among them is hashed; an item
shorter than that is one window.  An item without such a window, or of fewer than ``SHORTEST`` words,
is searched for as it is: its windows are those of its own words, in lower case, values included.
A Bloom filter over all windows of the benchmark, sized by their number, keeps the windows of
documents that cannot match from being shuffled; the rest meet the benchmark's in a hash join.
Windows of one document and one item that lie on one diagonal (the same shift) are one occurrence.
An occurrence counts if it has ``least`` windows (all, if the item has fewer) and its slots are
consistent: within the occurrence, a value of the item always became the same value of the document
(two values may become one).  If no value changed it is ``verbatim``, else ``reparameterised``.

Items with one template whose slots repeat in the same places ask for the same documents, so they are
one class, represented by its least item_id: a document is listed once for it, however many items
it has.  :func:`item_classes` tells the members.  An occurrence is verbatim if its values are those of
any member (of the representative, where it holds only a part of the values).

Defined results: null and empty texts have no windows; repeated rows of a document count as one
document; items are told apart by their text, so several may share an item_id, and items without an
item_id are searched for and reported under null; documents with a null doc_id are reported under
null, and told apart by a hash of the text; an empty benchmark or table gives no rows; items without
a word are not searched for; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.llm.common import doc_texts, read, saved, slices

WINDOW = 8
LEAST = 6
#: At least this share of a window's words must be plain.
PLAIN = 0.5
#: Bits of the filter: 16 to 32 per window of the benchmark, within these limits.  Beyond the upper one
#: (a benchmark of eight million windows) it lets more windows through to the join.
FILTER_BITS = (1 << 16, 1 << 27)
#: Templates of fewer words tell nothing: such items are searched for as they are.
SHORTEST = 5

#: Units of measurement and money.
UNITS = frozenset(
    "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram "
    "kilograms ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros yen peso pesos percent degree degrees "
    "meter meters metre metres kilometer kilometers kilometre kilometres kmh mph".split())

_NUMBER = re.compile(r"[+\-$€£¥#]?\d[\d.,:/x()+\-]*[%‰°]?\Z")
_MEASURE = re.compile(r"([+\-$€£¥#]?\d[\d.,:/]*)([^\W\d_]+)\Z")
_EDGES = re.compile(r"^[^\w$€£¥+\-]+|[^\w%°]+$")

NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 7)


_SPACE, _WORD, _LEFT, _RIGHT, _DIGIT, _UPPER, _LOWER, _STOP = (1 << k for k in range(8))
_BASE = 0x9E3779B97F4A7C15


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point below 65,535: its class bits, and its lower case."""
    chars = [chr(c) for c in range(0xFFFF)]
    bits = [(_SPACE * c.isspace() | _WORD * (c.isalnum() or c == "_") | _LEFT * (c in "$€£¥+-")
             | _RIGHT * (c in "%°") | _DIGIT * c.isdigit() | _UPPER * c.isupper()
             | _LOWER * c.islower() | _STOP * (c in ".!?:")) for c in chars]
    low = [ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars]
    # the last entry stands for all code points above: they are letters without case
    return np.array([*bits, _WORD], np.uint8), np.array([*low, 0xFFFF], np.uint32)


@functools.lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    out = []
    for x in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(n + 1, x, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


class Template:
    """The template words of some texts.

    ``hashes`` has the hash of each template word, ``slot`` whether it is a placeholder, ``owner``
    the text it is of, and ``value(k)`` the word itself; ``own`` has the hash of the word itself, and
    ``loose`` whether it is a placeholder only because of the word before it.
    """

    def __init__(self, texts: list[str]) -> None:
        self.whole = "".join(t + "\n" for t in texts)
        codes = np.frombuffer(self.whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes, lower = _tables()
        small = np.minimum(codes, 0xFFFF)
        kind = classes[small]
        ends_of = np.cumsum([len(t) + 1 for t in texts])
        blank = np.concatenate([[True], (kind & _SPACE) > 0])
        start = np.flatnonzero(blank[:-1] & ~blank[1:])
        stop = np.flatnonzero(~blank[:-1] & blank[1:])
        # without outer punctuation: from the first to the last character that may be an edge
        left, right = (np.flatnonzero(kind & (_WORD | x)) for x in (_LEFT, _RIGHT))
        pad = np.append(left, len(codes))
        first = pad[np.searchsorted(left, start)]
        last = np.concatenate([[-1], right])[np.searchsorted(right, stop)] + 1
        owner = np.searchsorted(ends_of, start, side="right")
        opens = np.concatenate([[True], (kind[stop[:-1] - 1] & _STOP) > 0])[:len(start)]
        opens |= np.diff(owner, prepend=-1) != 0
        some = last > first
        first, last, owner, opens = first[some], last[some], owner[some], opens[some]
        power, inverse = _powers(1 << max(20, int(len(codes)).bit_length()))
        letters = np.where(codes > 0xFFFE, codes, lower[small]).astype(np.uint64)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(letters * power[:len(codes)], out=sums[1:])
        hashes = (sums[last] - sums[first]) * inverse[first]
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

        def inside(bit: int) -> np.ndarray:
            seen = np.concatenate([[0], np.cumsum((kind & bit) > 0, dtype=np.int32)])
            return seen[last] - seen[first]

        name = ((last - first > 1) & ((kind[np.minimum(first, len(kind) - 1)] & _UPPER) > 0)
                & (inside(_UPPER) == 1) & (inside(_LOWER) == last - first - 1) & ~opens)
        self.first, self.last = first, last
        number, unit, both = ([] for _ in range(3))
        for k in np.flatnonzero(inside(_DIGIT)).tolist():
            word = self.value(k)
            if _NUMBER.match(word):
                number.append(k)
                if k + 1 < len(owner) and owner[k + 1] == owner[k] and (
                        self.value(k + 1).lower() in UNITS):
                    unit.append(k + 1)
            elif (m := _MEASURE.match(word)) and m[2].lower() in UNITS:
                both.append(k)
        self.slot, self.own, self.loose = name, hashes.copy(), name.copy()
        self.loose[unit] = True
        hashes[name] = _hash(NAME)
        for found, what in ((number, NUMBER), (unit, UNIT), (both, NUMBER + UNIT)):
            hashes[found] = _hash(what)
            self.slot[found] = True
        self.hashes, self.owner = hashes, owner

    def value(self, k: int) -> str:
        return self.whole[self.first[k]: self.last[k]]


def _fold(parts: Iterator[np.ndarray], n: int) -> np.ndarray:
    """One hash of the hashes that stand at the same place of each part."""
    total = np.zeros(n, np.uint64)
    for part in parts:
        total = (total ^ part) * _MIX
        total ^= total >> np.uint64(31)
    return total


def windows(words: Template, size: int, exact: bool, both: bool
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and hash of every full window within one text: of its own words if ``exact``, else of
    its template where that has enough plain words.

    With ``both``, those that begin with a loose placeholder come once more with the word itself; the
    third array says which these are.
    """
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    total = _fold(((words.own if exact else words.hashes)[k: k + n] for k in range(size)), n)
    slots = np.concatenate([[0], np.cumsum(words.slot)])
    most = size - int(np.ceil(PLAIN * size))
    inside = words.owner[size - 1:] == words.owner[:n]
    at = np.flatnonzero(inside & (exact | (slots[size:] - slots[:n] <= most)))
    if exact or not both:
        return at, total[at], np.zeros(len(at), bool)
    more = np.flatnonzero(inside & words.loose[:n] & (slots[size:] - slots[:n] - 1 <= most))
    again = _fold(((words.hashes if k else words.own)[more + k] for k in range(size)), len(more))
    return (np.concatenate([at, more]), np.concatenate([total[at], again]),
            np.repeat([False, True], [len(at), len(more)]))


ROWS = ("doc_id bigint, version bigint, at bigint, hash bigint, size int, exact boolean, "
        "slots array<string>, codes array<int>")


def _windows(size: int, filter_: bytes | None, forms: list[tuple[int, bool]]):
    """Windows of texts (doc_id, version, text) as rows; with a filter, only those that may match.

    Without a filter (items) ``codes`` number the values of a text in the order they first occur.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if filter_ is None else np.frombuffer(filter_, np.uint8)
        for batch in slices(batches, 1 << 19):
            ids, versions, texts = (c.to_pylist() for c in batch.columns)
            words = Template(texts)
            owner, slot = words.owner, words.slot
            length = np.bincount(owner, minlength=len(ids))
            begin = np.cumsum(length) - length
            out = []
            codes: list[dict[str, int]] = [{} for _ in ids]
            for j in np.flatnonzero(slot).tolist() if bits is None else ():
                codes[owner[j]].setdefault(words.value(j), len(codes[owner[j]]))
            for n, exact in forms:
                at, found, bare = windows(words, n, exact, bits is not None)
                if bits is None and n != size:  # a short item is one window
                    whole = length[owner[at]] == n
                    at, found, bare = at[whole], found[whole], bare[whole]
                if bits is not None:
                    for place in range(2):
                        may = _test(bits, found, place)
                        at, found, bare = at[may], found[may], bare[may]
                for k, h, b in zip(at.tolist(), found.view(np.int64).tolist(), bare.tolist()):
                    who = owner[k]
                    values = [] if exact else [
                        words.value(j) for j in range(k + b, k + n) if slot[j]]
                    out.append((ids[who], versions[who], int(k - begin[who]), h, n, exact, values,
                                [codes[who][v] for v in values] if bits is None else []))
            kinds = [*[pa.int64()] * 4, pa.int32(), pa.bool_(), pa.list_(pa.string()),
                     pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)],
                names=["doc_id", "version", "at", "hash", "size", "exact", "slots", "codes"])
    return run


def _places(hashes: np.ndarray, place: int, bits: int) -> np.ndarray:
    """One of two bit numbers of a filter of ``bits`` (a power of two) for each hash."""
    return ((hashes >> np.uint64((7, 33)[place])) & np.uint64(bits - 1)).astype(np.int64)


def _test(bits: np.ndarray, hashes: np.ndarray, place: int) -> np.ndarray:
    at = _places(hashes, place, 8 * len(bits))
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _bloom(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for batch in batches:
            hashes = np.asarray(batch.column(0), dtype=np.int64).view(np.uint64)
            for place in range(2):
                bits[_places(hashes, place, size)] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["bits"])
    return run


def _filter(known: DataFrame) -> bytes:
    """The Bloom filter of all windows of the benchmark."""
    least, most = FILTER_BITS
    windows = known.count()
    size = min(most, max(least, 1 << (16 * windows).bit_length()))
    blobs = [r["bits"] for r in known.select("hash").coalesce(4)
             .mapInArrow(_bloom(size), "bits binary").collect()]  # four filters of bounded size at most
    parts = [np.frombuffer(b, np.uint8) for b in blobs] or [np.zeros(size // 8, np.uint8)]
    return np.bitwise_or.reduce(parts).tobytes()


def _forms(window: int) -> list[tuple[int, bool]]:
    return [(n, exact) for exact in (False, True)
            for n in range(1 if exact else min(SHORTEST, window), window + 1)]


def _known(benchmark: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The windows that each text of the benchmark is searched by, and the texts with their class.

    The second has version, doc_id (the item's), n, form (of the class), map (code and value of every
    slot).
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("doc_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Items that are the same text are one; short items are windows of their own length.
    items = items.groupBy("text").agg(F.min("doc_id").alias("doc_id")).select(
        "doc_id", F.xxhash64("text").alias("version"), "text")
    all_windows = saved(items.mapInArrow(_windows(window, None, _forms(window)), ROWS), "items")
    # A window of a long item is of full size; of a short item the whole is taken.  Own words count
    # where there is no template.
    best = all_windows.groupBy("version").agg(F.max(F.struct(~F.col("exact"), "size")).alias("b"))
    best = best.select("version", (~F.col("b").getField("col1")).alias("exact"), "b.size")
    parts = saved(best.join(all_windows, ["version", "exact", "size"]), "item-windows")
    pairs = F.arrays_zip("codes", "slots")
    texts = parts.groupBy("version").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"),
        F.xxhash64(F.sort_array(F.collect_list(F.struct("at", "hash", "size", "codes")))).alias("form"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list(pairs)))).alias("map"))
    return parts, saved(texts, "item-texts")


def _representatives(texts: DataFrame) -> DataFrame:
    """form, version and item_id of the least item of each class."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version"))
    return texts.groupBy("form").agg(least.alias("r")).select(
        "form", F.col("r.version").alias("version"), F.col("r.doc_id").alias("item_id"))


def item_classes(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id and the item_id that represents it; a row per text that is searched for."""
    _, texts = _known(benchmark, window)
    heads = _representatives(texts).select("form", F.col("item_id").alias("represented_by"))
    return texts.join(heads, "form").select(F.col("doc_id").alias("item_id"), "represented_by")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 least: int = LEAST) -> DataFrame:
    """doc_id, version, item_id, windows, kind for each document that holds an item of a class.

    ``version`` is a hash of the text: it tells rows with one doc_id apart.  ``item_id`` is that of
    the class's representative.
    """
    parts, members = _known(benchmark, window)
    heads = _representatives(members)
    known = saved(parts.drop("doc_id").join(heads, "version").join(
        members.select("version", "n"), "version").select(
            "form", "item_id", F.col("at").alias("item_at"), "hash", "size", "exact", "n", "codes"), "known")
    used = sorted(tuple(r) for r in  # twice `window` at most
                  known.select("size", "exact").distinct().collect())
    texts = doc_texts(docs).select("doc_id", F.xxhash64("text").alias("version"), "text")
    found = texts.mapInArrow(_windows(window, _filter(known), used), ROWS).drop("codes")
    met = found.join(known, ["hash", "size", "exact"]).select(
        "doc_id", "version", "form", "item_id", (F.col("at") - F.col("item_at")).alias("shift"),
        "item_at", "n", F.arrays_zip("codes", "slots").alias("pairs"))
    # Repeated rows of a document give equal windows: distinct ones count.
    each = met.groupBy("doc_id", "version", "form", "item_id", "shift").agg(
        F.countDistinct("item_at").alias("windows"), F.max("n").alias("n"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("pairs")))).alias("map"))
    one_value = F.size("map") == F.size(F.array_distinct("map.codes"))
    good = each.where((F.col("windows") >= F.least(F.lit(least), F.col("n"))) & one_value)
    same = members.select("form", "map").distinct().withColumn("member", F.lit(True))
    whole = members.join(heads, ["form", "version"]).select("form", F.col("map").alias("whole"))
    judged = good.join(same, ["form", "map"], "left").join(whole, "form")
    verbatim = F.coalesce("member", F.forall("map", lambda p: F.array_contains("whole", p)))
    return judged.groupBy("doc_id", "version", "form", "item_id").agg(
        F.max("windows").alias("windows"),
        F.when(F.max(verbatim), "verbatim").otherwise("reparameterised").alias("kind")).drop("form")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold an item of the benchmark."""
    bad = contaminated(docs, benchmark).select(
        F.col("doc_id").alias("__bad"), F.col("version").alias("__version")).distinct()
    version = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(bad, docs["doc_id"].cast("bigint").eqNullSafe(bad["__bad"])
                     & (version == bad["__version"]), "left_anti")


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, and the item."""
    return contaminated(read(spark, sf_dir, "documents"),
                        read(spark, sf_dir, "benchmark")).drop("version")
