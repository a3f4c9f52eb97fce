"""Language identification with error-correcting output codes.

Every language gets a codeword of bits; one binary classifier per bit tells, from hashed character
trigrams, which half of the languages a text belongs to.  A text gets the language whose codeword
is nearest to the classifiers' margins, where a classifier's loss counts by its expected log odds: how
far apart it puts the two halves it was made for.  A text whose two nearest codewords are about as near is flagged ambiguous.

Learning: trigram counts per language over a sample of the labelled rows, about ``SAMPLE`` per
language and chosen by a hash of doc_id (``SAMPLE`` is the documented bound; a language with fewer
rows uses them all).  The ``LANGUAGES`` labels with most documents are learnt (ties: by name); rows
of other labels, as in a column of free text, count as rows without a label.  So the model, a table of
``2**BUCKET_BITS`` x code length floats, and the counts on the driver are of bounded size.  Prediction reads the whole text and nothing but the text.

Defined results: null text, empty text and text without a letter give ``und`` with score 0; with
no labelled rows at all every text gives ``und``; rows with null doc_id or null lang are not learnt
from but get a prediction; repeated rows repeat their result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from monthbook.llm.common import read, share, slices

UNKNOWN = "und"
SAMPLE = 3000
LANGUAGES = 256
BUCKET_BITS = 15
HELD_OUT_EVERY = 5
#: The nearest and second nearest codeword differ by less than this part of the mean loss.
CLOSE = 0.02


def held_out() -> Column:
    """Whether a document is kept from learning: crc32(doc_id as text) mod 5 is 0."""
    key = F.col("doc_id").cast("string").cast("binary")
    return F.coalesce(F.crc32(key) % HELD_OUT_EVERY == 0, F.lit(False))


def codewords(n: int) -> np.ndarray:
    """A row of +1 / -1 per language, no column constant, any two rows far apart.

    Up to six languages get all ways to halve them (2**(n-1) - 1 bits); more languages get
    rows of a Hadamard matrix without its constant column.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 6:
        bits = np.arange(1, 2 ** (n - 1))
        code = np.vstack([np.zeros(len(bits), np.int64)] +
                         [(bits >> k) & 1 for k in range(n - 1)])
        return 1.0 - 2.0 * code
    size = 1 << int(np.ceil(np.log2(n)))
    rows, cols = np.arange(n)[:, None], np.arange(1, size)[None, :]
    parity = np.zeros((n, size - 1), np.int64)
    for k in range(size.bit_length()):
        parity ^= ((rows & cols) >> k) & 1
    return 1.0 - 2.0 * parity


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all character trigrams of some texts, and where each text's begin.

    Texts are lower-cased and put between blanks; a trigram never spans two texts, and every text
    has one at least.
    """
    low = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in low], np.int64)
    ends = np.cumsum(lengths)
    padded = np.concatenate([codes, np.full(2, 32, np.uint32)]).astype(np.uint64)
    mixed = (padded[:-2] * np.uint64(0x9E3779B97F4A7C15) + padded[1:-1]
             * np.uint64(0xC2B2AE3D27D4EB4F) + padded[2:] * np.uint64(0x165667B19E3779F9))
    buckets = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
               >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    keep = np.ones(len(codes), bool)
    keep[ends - 1] = False
    many = lengths > 2
    keep[ends[many] - 2] = False
    starts = (ends - lengths) - np.concatenate([[0], np.cumsum(np.where(many, 2, 1))[:-1]])
    return buckets[keep], starts


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language of the partition: documents, and a dense vector of trigram counts."""
    found: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in slices(batches, 1 << 20):
        langs, texts = (batch.column(k).to_pylist() for k in (0, 1))
        kept = [(a, t) for a, t in zip(langs, texts) if has_letter(t)]
        for lang in {a for a, _ in kept}:
            buckets, starts = trigrams([t for a, t in kept if a == lang])
            found.setdefault(lang, np.zeros(1 << BUCKET_BITS))
            found[lang] += np.bincount(buckets, minlength=1 << BUCKET_BITS)
            docs[lang] = docs.get(lang, 0) + len(starts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.string()), pa.array(list(docs.values()), pa.int64()),
         pa.array([v.tobytes() for v in found.values()], pa.binary())],
        names=["lang", "docs", "counts"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the vectors that reached a task; a vector per language is held."""
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found[lang] = found.get(lang, 0) + np.frombuffer(blob)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.string()),
         pa.array([v.tobytes() for v in found.values()], pa.binary())], names=["lang", "counts"])


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    code: np.ndarray      # languages x bits, +1 / -1
    weights: np.ndarray   # buckets x bits: log odds of the two halves
    trust: np.ndarray     # per bit, sums to 1

    def margins(self, texts: list[str]) -> np.ndarray:
        """texts x bits: summed log odds over the root of the number of trigrams."""
        buckets, starts = trigrams(texts)
        lengths = np.diff(np.append(starts, len(buckets)))
        total = np.zeros((len(texts), self.weights.shape[1]))
        step = 1 << 18  # rows of weights held at once
        for at in range(0, len(buckets), step):
            to = min(at + step, len(buckets))
            first = int(np.searchsorted(starts, at, side="right")) - 1
            last = int(np.searchsorted(starts, to, side="left"))
            cuts = np.maximum(starts[first:last], at) - at
            total[first:last] += np.add.reduceat(self.weights[buckets[at:to]], cuts, axis=0,
                                                 dtype=np.float64)
        return total / np.sqrt(np.maximum(lengths, 1))[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest codeword, its score from 0 to 1, and whether another is as near."""
        if len(self.langs) == 1:
            n = len(margins)
            return np.zeros(n, np.int64), np.ones(n), np.zeros(n, bool)
        # logistic loss of every bit under every codeword
        loss = (np.logaddexp(0, -margins[:, None, :] * self.code[None]) * self.trust).sum(axis=2)
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(loss))
        near, second = loss[rows, order[:, 0]], loss[rows, order[:, 1]]
        odds = np.exp(-(loss - near[:, None]) * self.code.shape[1])
        return order[:, 0], 1 / odds.sum(axis=1), second - near < CLOSE * loss.mean(axis=1)


def learn(labelled: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES
          ) -> LanguageModel | None:
    """A model from rows (doc_id, text, lang) without null lang; None if there are none.

    It knows the ``languages`` labels with most documents.
    """
    rows = labelled.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    # One number per language, like the model; so the rows need no join and no shuffle.
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    sizes = {r["lang"]: r["count"] for r in common.collect()}
    if not sizes:
        return None
    rates = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, sample / n)])
    # An unknown label has no rate and is left out.
    picked = rows.where(share("doc_id") < F.try_element_at(rates, F.col("lang"))
                        ).select("lang", "text")
    sums = (picked.mapInArrow(_count, "lang string, docs bigint, counts binary")
            .select("lang", "counts").repartition("lang").mapInArrow(_add, "lang string, counts binary"))
    per_lang = {r["lang"]: np.frombuffer(r["counts"]) for r in sums.collect()}
    if not per_lang:
        return None
    langs = tuple(sorted(per_lang))
    counts_ = np.stack([per_lang[x] for x in langs])
    rates = (counts_ + 0.5) / (counts_ + 0.5).sum(axis=1, keepdims=True)  # languages weigh alike
    code = codewords(len(langs))
    weights = np.zeros((counts_.shape[1], code.shape[1]))
    for bit in range(code.shape[1]):
        halves = [rates[code[:, bit] == s] for s in (1, -1)]
        if all(len(h) for h in halves):
            weights[:, bit] = np.log(halves[0].mean(axis=0)) - np.log(halves[1].mean(axis=0))
    # A bit is trusted by how far apart it puts its two halves, in expected log odds.
    gap = np.array([sum(abs(rates[k] @ weights[:, b]) for k in range(len(langs)))
                    for b in range(code.shape[1])])
    trust = gap / gap.sum() if gap.sum() > 0 else np.full(len(gap), 1 / len(gap))
    return LanguageModel(langs, code, weights.astype(np.float32), trust)


OUT = ("lang_pred", "score", "ambiguous")


def identify(docs: DataFrame, model: LanguageModel | None,
             out: tuple[str, str, str] = OUT) -> DataFrame:
    """``docs`` with the language, the score and whether it is ambiguous, in columns ``out``.

    Columns of ``docs`` with one of these names are replaced.
    """
    docs = docs.drop(*out)
    names = docs.columns
    if model is None:
        return docs.select("*", *[F.lit(v).alias(n) for v, n in zip((UNKNOWN, 0.0, False), out)])
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    known = pa.array([UNKNOWN, *model.langs])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in slices(batches):
            texts = batch.column(names.index("text")).to_pylist()
            rows = [k for k, t in enumerate(texts) if has_letter(t)]
            lang = np.zeros(len(texts), np.int64)
            score, close = np.zeros(len(texts)), np.zeros(len(texts), bool)
            if rows:
                best, sure, near = model.decode(model.margins([texts[k] for k in rows]))
                lang[rows], score[rows], close[rows] = best + 1, sure, near
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, known.take(pa.array(lang)), pa.array(score), pa.array(close)],
                names=[*names, *out])

    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(out, ("string", "double", "boolean")):
        schema.add(name, kind)
    return docs.mapInArrow(predict, schema)


def accepted(docs: DataFrame) -> DataFrame:
    """The documents whose language is known and not ambiguous, with their own columns.

    The model learns from the documents that are not held out.
    """
    out = ("__lang", "__score", "__close")
    found = identify(docs, learn(docs.where(~held_out())), out)
    return found.where((F.col("__lang") != UNKNOWN) & ~F.col("__close")).drop(*out)


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out()))
    texts = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(texts, model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
