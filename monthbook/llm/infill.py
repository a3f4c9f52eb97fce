"""Fill-in-the-middle transformation with a wavelet matrix over character classes.

A text becomes prefix, middle and suffix, written in the order a model learns to fill gaps from:

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle
    plain  the text as it is

Cuts.  Texts stay UTF-8 bytes.  Every byte gets one of eight classes (:data:`CLASSES`), and the
classes of a slice of texts form one wavelet matrix: three bit vectors with counts per 64 bits.
``rank(class, x)`` counts a class before a byte in three steps; the boundaries of a unit (characters,
words, lines) are a set of classes, so their count is a sum of ranks (or the position less the ranks
of the other classes).  A cut after ``k`` units is found by bisection on that count, for both cuts of
all texts of the slice at once, and the same ranks tell how many code points a part has.

Draws are fixed by ``doc_id`` alone: ``h1`` to ``h4`` are the first four 8-digit groups, as unsigned
integers, of the hex sha256 of ``SEED:doc_id``.  The prefix ends after the smaller of ``h1 % (n + 1)``
and ``h2 % (n + 1)`` of the text's ``n`` units and the middle after the larger.

Units.  ``char``: code points.  ``word``: a word and the blanks behind it (blanks before the first
word go with the prefix, always).  ``line``: a line and its newline.

Defined results: null and empty texts, and texts that hold one of the three marks, stay plain; a null
``doc_id`` draws as an empty number; repeated rows (and rows that share an id and a text) repeat
their result; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthbook.llm.common import doc_texts, read, slices, utf8

#: The marks of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Byte classes.  ``FIRST`` is the first byte of a word, ``MORE`` a later byte of a character.
CLASSES = ("MORE", "BLANK", "NEWLINE", "FIRST", "LETTER", "DIGIT", "MARK", "WIDE")
MORE, BLANK, NEWLINE, FIRST, LETTER, DIGIT, MARK, WIDE = range(8)

#: Per unit: the classes at its boundaries, and whether a boundary begins a unit or ends one.
UNITS = {"char": (tuple(range(1, 8)), "begins"), "word": ((FIRST,), "begins"),
         "line": ((NEWLINE,), "ends")}


def _kinds() -> np.ndarray:
    kinds = np.full(256, MARK, np.uint8)
    kinds[0x80:0xC0] = MORE
    kinds[0xC0:] = WIDE
    kinds[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
    kinds[0x0A] = NEWLINE
    kinds[ord("0"):ord("9") + 1] = DIGIT
    kinds[ord("A"):ord("Z") + 1] = kinds[ord("a"):ord("z") + 1] = LETTER
    return kinds


_KINDS = _kinds()


def classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every byte of some texts; ``starts`` are where texts begin."""
    kind = _KINDS[data]
    blank = (kind == BLANK) | (kind == NEWLINE)
    after = np.ones(len(kind), bool)
    after[1:] = blank[:-1]
    after[starts[starts < len(kind)]] = True
    kind[after & ~blank & (kind != MORE)] = FIRST
    return kind


class WaveletMatrix:
    """Ranks of the symbols of a sequence, in one step per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, bits: int = 3):
        self.bits, self.size = bits, len(symbols)
        self.levels, self.zeros = [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1 == 1
            packed = np.zeros(len(bit) // 64 * 8 + 8, np.uint8)
            short = np.packbits(bit, bitorder="little")
            packed[: len(short)] = short
            words = packed.view("<u8")
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((words, before))
            self.zeros.append(int(len(bit) - np.count_nonzero(bit)))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        self._origin = [int(self._walk(c, np.zeros(1, np.int64))[0]) for c in range(1 << bits)]

    def _walk(self, symbol: int, at: np.ndarray) -> np.ndarray:
        for depth, (words, before) in enumerate(self.levels):
            word = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(words[word] & low)
            at = self.zeros[depth] + ones if symbol >> (self.bits - 1 - depth) & 1 else at - ones
        return at

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each position."""
        return self._walk(symbol, at) - self._origin[symbol]

    def count(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many symbols of a set lie before each position."""
        others = [s for s in range(1 << self.bits) if s not in symbols]
        if len(others) < len(symbols):
            return at - sum((self.rank(s, at) for s in others), np.zeros_like(at))
        return sum((self.rank(s, at) for s in symbols), np.zeros_like(at))


def units(matrix: WaveletMatrix, unit: str, starts: np.ndarray, ends: np.ndarray,
          last: np.ndarray) -> np.ndarray:
    """How many units each text has; ``last`` is the class of its last byte."""
    marks, side = UNITS[unit]
    n = matrix.count(marks, ends) - matrix.count(marks, starts)
    return n + ((ends > starts) & (last != NEWLINE)) if side == "ends" else n


def cut(matrix: WaveletMatrix, unit: str, starts: np.ndarray, ends: np.ndarray,
        k: np.ndarray) -> np.ndarray:
    """The byte after the first ``k`` units of each text, by bisection on the boundary count."""
    marks, side = UNITS[unit]
    goal = matrix.count(marks, starts) + k
    # begins: the last position with at most `k` boundaries before it; ends: the first with `k`.
    low, high = starts.copy(), ends.copy()
    while (low < high).any():
        if side == "begins":
            middle = (low + high + 1) >> 1
            fits = matrix.count(marks, middle) <= goal
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        else:
            middle = (low + high) >> 1
            fits = matrix.count(marks, middle) >= goal
            low, high = np.where(fits, low, middle + 1), np.where(fits, middle, high)
        low = np.minimum(low, high)
    return low


def draws(doc_id: int | None, seed: int = 1) -> list[int]:
    """The four numbers a document's cuts and form are drawn with."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]


OUTPUT = ("doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
          "output string")


def fill_in_middle(docs: DataFrame, unit: str = "char", plain: int = 10, spm: int = 20,
                   seed: int = 1) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: a row per row of ``docs``.

    ``n`` counts units; ``plain`` per cent of the texts stay as they are, and ``spm`` per cent of
    the others put the suffix first.  :func:`restored` takes an output back to its text.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    first, second, third = marks

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, at = utf8(batch.column(1))
            starts, ends = at[:-1], at[1:]
            kind = classes(data, starts)
            matrix = WaveletMatrix(kind)
            last = np.where(ends > starts, kind[np.maximum(ends - 1, 0)] if len(kind) else 0, 0)
            n = units(matrix, unit, starts, ends, last)
            h = np.array([draws(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
            cuts = [cut(matrix, unit, starts, ends, k)
                    for k in (np.minimum(one, two), np.maximum(one, two))]
            chars = [matrix.count(UNITS["char"][0], x) for x in (starts, *cuts)]
            raw, forms, made = data.tobytes(), [], []
            for row, (a, b, c, d) in enumerate(zip(starts, *cuts, ends)):
                text = raw[a:d]
                if not text or h[row, 2] % 100 >= 100 - plain or any(m in text for m in marks):
                    form, out = "plain", [text]
                elif h[row, 3] % 100 < spm:
                    form, out = "spm", [second, raw[c:d], first, raw[a:b], third, raw[b:c]]
                else:
                    form, out = "psm", [first, raw[a:b], second, raw[c:d], third, raw[b:c]]
                forms.append(form)
                made.append(b"".join(out))
            whole = np.array([f == "plain" for f in forms])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                 pa.array(chars[1] - chars[0], pa.int64(), mask=whole),
                 pa.array(chars[2] - chars[1], pa.int64(), mask=whole),
                 pa.array(made, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return doc_texts(docs).mapInArrow(transform, OUTPUT)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text an output was made from.  No part holds a mark, so the marks split it uniquely."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "<[PSM]>", 4)
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .otherwise(F.concat(parts[2], parts[3], parts[1])))


def infill_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut by code points, the digest of its output and of the text rebuilt from it."""
    made = fill_in_middle(read(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output"), 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


INFILL_SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), numbers AS (
  SELECT doc_id, text, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS one,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS two,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS three,
    CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS four FROM drawn
), parts AS (
  SELECT *, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>')
      OR contains(text, '<M>') OR three >= 90 THEN 'plain'
    WHEN four < 20 THEN 'spm' ELSE 'psm' END AS form,
    least(one, two) AS a, greatest(one, two) AS b FROM numbers
), made AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle,
    substr(text, b + 1) AS suffix FROM parts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM made
"""
