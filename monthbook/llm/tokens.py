"""Token ids in a grammar-compressed, randomly accessible table of shards.

Texts are encoded with a public byte-level BPE vocabulary through the tokenizers library, and every
document ends with ``END``.  Documents are dealt out by ranges of doc_id, so the shards, taken in
order, hold one long sequence of ids in ascending doc_id order.

Each shard row is compressed by itself with Re-Pair: the frequent pairs of neighbouring symbols are
replaced by new symbols (nonterminals), again and again, until no pair occurs ``LEAST`` times.  One
round replaces all such pairs at once; which of two overlapping replacements is made depends on the
pairs close by, so that copies are replaced alike.

File format: Parquet rows ``shard, block, n_tokens, doc_ids, doc_tokens, width, rules, lengths,
symbols, offsets``.  ``symbols`` is the compressed sequence and ``rules`` the two symbols of each nonterminal,
as little-endian unsigned numbers of ``width`` bytes (2 to 4, as the rules need); rule k is symbol
``FIRST + k``; ``lengths`` is the number of ids that each rule stands for (4 bytes each), ``offsets``
the number of ids before every ``STEP``-th symbol (8 bytes each).  A search in the offsets and the
lengths of at most ``STEP`` symbols find a position; from there on only symbols that reach into the
wanted range are expanded, and of their rules only the halves that do (:func:`decode_range`).

Encoding is cached by word (:class:`Encoder`): new words are encoded by the library, many in a text;
the cache lives as long as the process and is emptied when it holds ``CACHED_WORDS`` words.

Defined results: null and empty texts are the end id alone; a null doc_id comes first; rows that
share a doc_id follow by a hash of the text; an empty table gives no shards; other columns are
ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from xxhash import xxh3_128_digest

from monthbook.llm.common import doc_texts, partitions, ragged, read, slices, utf8
from monthbook.session import scratch_path

END = 2
FIRST = 50_257  # the vocabulary's size: the first nonterminal
BLOCK_TOKENS = 4_000_000
#: A pair is replaced while it occurs at least this often in the shard row.
LEAST = 64
#: Symbols between two known positions of a shard row.
STEP = 1024
#: Overlapping replacements are told apart by so many pairs on either side.
NEAR = 8
CACHED_WORDS = 1_100_000
#: New words in one text for the library.
JOINED = 256
#: How the vocabulary writes a blank.
BLANK = "\u0120"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.array([0x7FB5D329728EA185, 0x81DADEF4BC2DD44D], np.uint64)
#: The first 0 to 8 bytes of a little-endian number.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
OTHER, MARK, ALNUM = 0, 1, 2
#: What an ASCII character at a word's edge is; white space, ``\0`` and other characters are OTHER.
_KINDS = np.array([ALNUM if chr(b).isalnum() else OTHER if chr(b).isspace() or not b else MARK
                   for b in range(128)] + [OTHER] * 128, np.uint8)

SHARD = ("shard bigint, block bigint, n_tokens bigint, doc_ids array<bigint>, "
         "doc_tokens array<bigint>, width int, rules binary, lengths binary, symbols binary, "
         "offsets binary")


def _odd(word: str) -> bool:
    """Whether a word was cut out where the pattern would not cut."""
    bare = word.lstrip("\0")
    return word not in ("\n", "\0") and (
        not bare or bare[0].isspace() or bare[-1].isspace())


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all 64-bit numbers, one to one."""
    for times in _SPREAD:
        x = (x ^ (x >> np.uint64(31))) * times
    return x ^ (x >> np.uint64(32))


def _keys(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers for each word, the first one spread evenly.

    Up to 15 bytes they are the word itself and its length, so equal only for equal words; longer
    words have 120 bits of a hash.
    """
    data, ends = utf8(words)
    begin, lengths = ends[:-1], np.diff(ends)
    data = np.append(data, np.zeros(16, np.uint8))
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the eight bytes from every byte on
    low = eight[begin] & _FIRST_BYTES[np.minimum(lengths, 8)]
    high = eight[begin + 8] & _FIRST_BYTES[np.clip(lengths - 8, 0, 7)]
    high |= np.minimum(lengths, 255).astype(np.uint64) << np.uint64(56)
    long = np.flatnonzero(lengths > 15)
    if len(long):
        digests = np.frombuffer(b"".join(
            xxh3_128_digest(w) for w in words.take(pa.array(long)).to_pylist()), "<u8")
        low[long] = digests[::2]
        high[long] = digests[1::2] | np.uint64(255 << 56)
    return _mixed(low ^ _mixed(high)), high


class Encoder:
    """Ids of texts by the tokenizers library, with a bounded, compact cache of words.

    A text is cut into words at single blanks; a newline, and a comma or full stop behind a letter
    or digit, are words of their own.  The vocabulary's pattern cuts there too, so the ids of the
    words, each encoded with the blank before it, are the ids of the text.  ``\0`` marks a word
    without a blank before it.  Where a cut would not be one of the pattern's (two blanks, other
    white space at a word's edge, more than two newlines, a comma behind other punctuation), the
    library encodes the whole text.

    New words with a blank before them are encoded ``JOINED`` at a time, as one text; the ids of each
    begin at the one token that begins with a blank.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tok.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank[[k for token, k in vocabulary.items() if token[0] == BLANK]] = True
        self._clear()

    def _clear(self) -> None:
        # Words by two numbers, sorted by the first: 20 bytes a word, not a string each.
        self.keys, self.more = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int32)
        self.ids, self.begins = np.zeros(1 << 16, np.uint16), np.zeros(1 << 14, np.int32)
        self.uncut, self.closed = np.zeros(1 << 14, bool), np.zeros(1 << 14, bool)
        self.used = 0
        self._look_up(pa.array(["\0", "\0,", "\0."]))  # numbers 0, 1 and 2

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: pa.Array, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words end to end and their numbers; those ``alone`` are texts of their own."""
        texts = [w[1:] if w[:1] == "\0" else w if w == "\n" else f" {w}"
                 for w in words.filter(pa.array(alone)).to_pylist()]
        rest = words.filter(pa.array(~alone))
        offsets = np.append(np.arange(0, len(rest), JOINED), len(rest)).astype(np.int32)
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), rest), " ")
        texts += pc.binary_join_element_wise("", lines, " ").to_pylist()
        found = self._batch(texts)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint16, int(sizes.sum()))
        ends = np.cumsum(sizes[:len(words) - len(rest)])
        begin = int(ends[-1]) if len(ends) else 0
        first, lengths = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        first[alone], lengths[alone] = ends - sizes[:len(ends)], sizes[:len(ends)]
        first[~alone] = begin + np.flatnonzero(self.blank[ids[begin:]])
        lengths[~alone] = np.diff(first[~alone], append=len(ids))
        return ids[ragged(first, lengths)], lengths

    def _learn(self, words: pa.Array) -> None:
        """Encodes new words, all in one call."""
        data, ends = utf8(words)
        data = np.append(data, np.uint8(0))
        marked = (data[ends[:-1]] == 0) & (ends[:-1] < ends[1:])
        # Words that begin and end in ASCII are judged by these bytes, others one by one.
        begins, last = _KINDS[data[ends[:-1] + marked]], _KINDS[data[ends[1:] - 1]]
        look = np.flatnonzero((begins == OTHER) | (last == OTHER) | (ends[:-1] + marked == ends[1:]))
        seen = words.take(pa.array(look)).to_pylist()
        closed, uncut = last == ALNUM, np.zeros(len(words), bool)
        closed[look] = [w[-1:].isalnum() for w in seen]
        uncut[look] = [not w.isalpha() and _odd(w) for w in seen]
        found, lengths = self._encode_words(
            words, marked | uncut | np.asarray(pc.equal(words, "\n")))
        n, m, more = len(self.numbers), len(words), len(found)
        while self.used + more > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + m + 1 > len(self.begins):
            self.begins, self.uncut, self.closed = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.begins, self.uncut, self.closed))
        self.ids[self.used: self.used + more] = found
        self.begins[n + 1: n + m + 1] = self.used + np.cumsum(lengths)
        self.used += more
        self.closed[n: n + m], self.uncut[n: n + m] = closed, uncut

    def _look_up(self, words: pa.Array) -> np.ndarray:
        """The numbers of some different words; new ones are learnt."""
        key, more = _keys(words)
        found = np.full(len(words), -1, np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (self.more[at] == more)
            found[hit] = self.numbers[at[hit]]
        new = np.flatnonzero(found < 0)
        if len(new):
            found[new] = len(self.numbers) + np.arange(len(new))
            self._learn(words.take(pa.array(new)))
            new = new[np.argsort(key[new])]
            at = np.searchsorted(self.keys, key[new])
            self.keys = np.insert(self.keys, at, key[new])
            self.more = np.insert(self.more, at, more[new])
            self.numbers = np.insert(self.numbers, at, found[new].astype(np.int32))
        return found

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, each with the end id, and their numbers.

        Cutting and counting words are Arrow kernels; Python sees each different word once.
        """
        if len(self.numbers) > CACHED_WORDS:
            self._clear()
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        cut = pc.binary_join_element_wise("\0", texts, "")
        for mark, into in (("\n", " \n \0"), (", ", " \0, "), (". ", " \0. ")):
            cut = pc.replace_substring(cut, mark, into)
        lists = pc.split_pattern(cut, " ")
        counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
        words = lists.flatten().dictionary_encode()
        picked = self._look_up(words.dictionary)[np.asarray(words.indices)]
        wrong = self.uncut[picked]
        mark = (picked == 1) | (picked == 2)
        wrong[1:] |= mark[1:] & ~self.closed[picked[:-1]]
        bad = pc.ends_with(texts, "\n\n")
        for found in ("\0", "\n\n\n", "\n\n "):
            bad = pc.or_(bad, pc.match_substring(texts, found))
        bad = np.array(bad, dtype=bool)
        if wrong.any():
            owner = np.repeat(np.arange(len(texts)), counts)
            bad |= np.bincount(owner[wrong], minlength=len(texts)) > 0
        if bad.any():
            picked, counts = picked[~np.repeat(bad, counts)], np.where(bad, 0, counts)
        first = self.begins[picked].astype(np.int64)
        lengths = self.begins[picked + 1] - first
        cut_ids = self.ids[ragged(first, lengths)]
        sums = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        taken = np.diff(sums)
        sizes = taken.copy()
        whole = np.flatnonzero(bad)
        entire = dict(zip(whole.tolist(), self._batch(texts.take(pa.array(whole)).to_pylist())))
        for k, ids in entire.items():
            sizes[k] = len(ids)
        sizes += 1
        ends = np.cumsum(sizes)
        out = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint32)
        out[ragged(ends - sizes, taken)] = cut_ids
        for k, ids in entire.items():
            out[ends[k] - sizes[k]: ends[k] - 1] = ids
        return out, sizes


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One encoder per process: its words serve all tasks that run there."""
    return Encoder(path)


def _matches(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which matches are made, of those that overlap.

    ``at`` are the places of the matches and ``rank`` their pairs, the commonest first.  Every second
    match is made, counted from the start of a row of matches and anew from each one that is commoner
    than the ``NEAR`` before and behind it.  So the copies of a passage are replaced alike, whatever
    stands around them.
    """
    start = np.diff(at, prepend=-2) != 1
    least = np.ones(len(at), bool)
    for k in range(1, NEAR + 1):
        least[k:] &= rank[k:] < rank[:-k]
        least[:-k] &= rank[:-k] <= rank[k:]
    first = np.flatnonzero(start | least)
    nth = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
    yields = np.append(least[1:] & ~start[1:], False)  # the next one overlaps it and counts anew
    return (nth % 2 == 0) & ~yields


def _find(found: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``pairs`` are among the different, sorted ``found``, and where there.

    A hashed table answers for the one pair that owns a slot; the others are searched for.
    """
    shift = np.uint64(64 - max(12, len(found).bit_length() + 4))
    slot = ((found * _MIX) >> shift).astype(np.int64)
    table = np.zeros(1 << (64 - int(shift)), np.int32)
    table[slot] = np.arange(len(found))
    lost = np.flatnonzero(table[slot] != np.arange(len(found)))
    at = ((pairs * _MIX) >> shift).astype(np.int32)
    place = table[at]
    same = found[place] == pairs
    if len(lost):
        shared = np.zeros(len(table), bool)
        shared[slot[lost]] = True
        rest = np.flatnonzero(shared[at] & ~same)
        where = lost[np.minimum(np.searchsorted(found[lost], pairs[rest]), len(lost) - 1)]
        right = found[where] == pairs[rest]
        place[rest[right]] = where[right]
        same[rest[right]] = True
    hit = np.flatnonzero(same)
    return hit, place[hit]


def repair(ids: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The compressed sequence, the rules (n, 2) and the number of ids each rule stands for.

    Rounds go on until no pair occurs ``least`` times; counts are exact.  A round leaves no match of
    a pair that it replaces: of two that overlap, the one made takes a symbol of the other.  So only
    pairs with a symbol of the last round can be frequent in the next one.
    """
    seq = ids.astype(np.uint32)
    rules: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    lengths = np.ones(FIRST, np.int64)
    last = 0  # symbols from here on are new
    while len(seq) > 1:
        pairs = (seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:]
        at = None  # all places
        if last:
            fresh = seq >= last
            at = np.flatnonzero(fresh[:-1] | fresh[1:])
            pairs = pairs[at]
        ordered = np.sort(pairs)
        begin = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)])
        often = np.diff(begin, append=len(ordered))
        chosen = np.flatnonzero(often >= least)
        found = ordered[begin[chosen]]
        if not len(found):
            break
        del ordered, begin
        order = np.argsort(-often[chosen], kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        hit, place = _find(found, pairs)
        at, new = hit if at is None else at[hit], rank[place]
        del pairs, hit, place
        made = _matches(at, new)
        at, new = at[made], new[made]
        used = np.bincount(new, minlength=len(order)) > 0
        last = len(lengths)
        fresh = found[order[used]]
        rules.append(np.ascontiguousarray(fresh).view("<u4").reshape(-1, 2)[:, ::-1].astype(np.int64))
        lengths = np.concatenate([lengths, lengths[rules[-1]].sum(axis=1)])
        seq[at] = (last - 1 + np.cumsum(used))[new]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
    return seq.astype(np.int64), np.concatenate(rules), lengths[FIRST:]


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that a sequence of symbols stands for."""
    # All rules written out, one after the other; a rule only uses symbols before it.
    size = np.concatenate([np.ones(FIRST, np.int64), lengths])
    begin = np.cumsum(size) - size
    flat = np.zeros(int(size.sum()), np.uint32)
    flat[:FIRST] = np.arange(FIRST)
    done = 0
    while done < len(rules):
        # as many rules at once as use written ones only
        late = np.flatnonzero((rules[done:] >= FIRST + done).any(axis=1))
        to = done + (int(late[0]) if len(late) else len(rules) - done)
        parts = rules[done:to].ravel()
        flat[begin[FIRST + done]: begin[FIRST + to - 1] + size[FIRST + to - 1]] = (
            flat[ragged(begin[parts], size[parts])])
        done = to
    symbols = symbols.astype(np.int64)
    return flat[ragged(begin[symbols], size[symbols])]


def _to_bytes(numbers: np.ndarray, width: int) -> bytes:
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def _from_bytes(data: bytes, width: int) -> np.ndarray:
    whole = np.zeros((len(data) // width, 4), np.uint8)
    whole[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return whole.view("<u4").ravel()


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (_from_bytes(row["symbols"], row["width"]),
            _from_bytes(row["rules"], row["width"]).reshape(-1, 2).astype(np.int64),
            np.frombuffer(row["lengths"], "<u4").astype(np.int64))


def _sizes(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The number of ids that each symbol stands for."""
    size = np.ones(len(symbols), np.int64)
    grown = symbols >= FIRST
    size[grown] = lengths[symbols[grown].astype(np.int64) - FIRST]
    return size


def _offsets(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids before every ``STEP``-th symbol."""
    size = _sizes(symbols, lengths)
    return (np.cumsum(size) - size)[::STEP]


def decode_range(row: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start .. stop`` of a shard row.

    The work grows with the ids asked for and the depth of their rules, not with the shard row.  Of a
    row without ``offsets`` the lengths of all symbols are summed.
    """
    width = row["width"]
    raw = np.frombuffer(row["symbols"], np.uint8).reshape(-1, width)
    pairs = np.frombuffer(row["rules"], np.uint8).reshape(-1, 2, width)
    lengths = np.frombuffer(row["lengths"], "<u4")

    def numbers(part: np.ndarray) -> np.ndarray:
        return _from_bytes(part.tobytes(), width).astype(np.int64)

    if start >= stop:
        return np.zeros(0, np.uint32)
    first, last, begin = 0, len(raw), 0
    if row.get("offsets") is not None:
        known = np.frombuffer(row["offsets"], "<i8")
        k = int(np.searchsorted(known, start, "right")) - 1
        first, begin = k * STEP, int(known[k])
        last = min(last, int(np.searchsorted(known, stop, "left")) * STEP)
    symbols = numbers(raw[first:last])
    while True:
        ends = begin + np.cumsum(_sizes(symbols, lengths))
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        begin = int(ends[a - 1]) if a else begin
        symbols = symbols[a:b]
        grown = np.flatnonzero(symbols >= FIRST)
        if not len(grown):
            return symbols.astype(np.uint32)
        # Every rule becomes its two symbols; those outside the range go in the next round.
        width_of = np.ones(len(symbols), np.int64)
        width_of[grown] = 2
        at = np.cumsum(width_of) - width_of
        wider = np.repeat(symbols, width_of)
        two = numbers(pairs[symbols[grown] - FIRST]).reshape(-1, 2)
        wider[at[grown]], wider[at[grown] + 1] = two[:, 0], two[:, 1]
        symbols = wider


def _rows(ids: list[np.ndarray], docs: list, sizes: list, shard: int, block: int) -> pa.RecordBatch:
    whole = np.concatenate(ids)
    symbols, rules, lengths = repair(whole)
    width = max(2, ((FIRST + len(rules) - 1).bit_length() + 7) // 8)
    values = [shard, block, len(whole), docs, sizes, width, _to_bytes(rules, width),
              lengths.astype("<u4").tobytes(), _to_bytes(symbols, width),
              _offsets(symbols, lengths).astype("<i8").tobytes()]
    kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array([v], k) for v, k in zip(values, kinds)],
        names=[c.split()[0] for c in SHARD.split(", ")])


def shards(docs: DataFrame, vocabulary: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Compressed shard rows of all documents, in the order of doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, block = encoder(vocabulary).encode, TaskContext.get().partitionId(), 0
        ids, names, sizes, total = [], [], [], 0
        for batch in slices(batches, 2 << 20):
            found, lengths = encode(batch.column(1))
            ids.append(found)
            names += batch.column(0).to_pylist()
            sizes += lengths.tolist()
            total += len(found)
            if total >= block_tokens:
                yield _rows(ids, names, sizes, shard, block)
                ids, names, sizes, total, block = [], [], [], 0, block + 1
        if names:
            yield _rows(ids, names, sizes, shard, block)

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    texts = doc_texts(docs)
    return (texts.repartitionByRange(partitions(docs.sparkSession), *order)
            .sortWithinPartitions(*order).mapInArrow(run, SHARD))


def write_tokens(docs: DataFrame, path: str, vocabulary: str) -> None:
    """Encodes all documents and writes the shards below ``path``."""
    shards(docs, vocabulary).write.mode("overwrite").parquet(path)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            raw = memoryview(expand(*_unpack(row)).astype("<u4")).cast("B")
            ends = np.cumsum(row["doc_tokens"])
            starts = ends - row["doc_tokens"]
            sums = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["shard"]] * n, pa.int64()), pa.array([row["block"]] * n, pa.int64()),
                 pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(row["doc_tokens"], pa.int64()), pa.array(sums, pa.int64())],
                names=["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    files = spark.read.schema(SHARD).parquet(path)
    # One number per shard is summed in one task, blocks within their shard.
    blocks = files.groupBy("shard", "block").agg(F.sum("n_tokens").alias("n"))
    totals = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("shard").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    bases = blocks.select("shard", "block", F.coalesce(F.sum("n").over(inside), F.lit(0))
                          .alias("more")).join(bases, "shard")
    docs = files.mapInArrow(_index, "shard bigint, block bigint, doc_id bigint, at bigint, "
                                    "n_tokens bigint, ids_crc32 bigint")
    return docs.join(bases, ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("more") + F.col("at")).alias("start"), "n_tokens",
        "ids_crc32")


def token_index(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Writes the shards of ``docs`` to the shared folder and returns their index."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary)
    return read_index(docs.sparkSession, path)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary lies."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def tokens_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written, read back and indexed."""
    return token_index(read(spark, sf_dir, "documents"), vocabulary_path())
