"""Personal data: fixed base patterns, and more spans chosen by boosted trees.

Base.  Emails, IPv4 addresses, payment cards (Luhn) and international phone numbers, leftmost and
non-overlapping per kind.  Base spans are always kept.

Candidates.  High-recall generators propose overlapping spans of five kinds (the base kinds and
``secret``): anything around an at sign (spelled out or not), digit groups, colon and dot groups,
long mixed strings.  Gradient boosted trees score each by its format (lengths, groups, separators,
check digits, character mix) and its context (neighbouring characters, key words before it).

Learning.  Evidence labels the candidates (:func:`evidence`): base spans are positive, and so is what
the rules of its kind confirm (a valid IPv6 address, a mailbox spelled out with a top-level domain, a
13-digit card with a right check digit, a usual grouping of a local phone number, a key of a known
format) or a key word before it; what the rules exclude is negative, and the rest has no label: it
teaches nothing, but is scored like the others.  All labelled candidates teach: each feature is cut
into ``BINS`` bins at exact quantiles of them, candidates with equal bins become one row with their
number, and weights make half of all negative, a quarter base spans and a quarter positive without
being base spans.  A hash of text and place deals the candidates into two halves, and each half is
scored by trees that learnt from the other one, so a candidate never meets trees that know it, and
copies of a text are scored alike.  The thresholds come from the scores of all labelled candidates:
per kind the lowest score at which ``PRECISION`` of the candidates from there on are positive, base
spans (which cannot be added) left out.  Candidates at or above it that do not overlap a base span
are added, the best first where they overlap each other.

Defined results: null and empty texts have no spans; repeated rows repeat their result; a table
without candidates of both labels in each half gets the base spans alone; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthbook.llm.common import doc_texts, read, saved, share, slices
from monthbook.operators.parallel import ROWS_PER_TASK, side_by_side
from monthbook.operators.ranks import running_sums

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
PRECISION = 0.98
TREES, DEPTH, BINS = 20, 4, 32
#: The library looks for cuts in ``maxBins ** 2`` rows; this is the most it takes.  The bins that
#: are made are those of the features, ``BINS`` at most.
_ALL_ROWS = 46_340

# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators: what may be a span of each kind.
_WIDE = {
    "email": re.compile(r"[\w.%+-]{1,64}(?:\s?[(\[{]\s?(?:at|@)\s?[)\]}]\s?|@)[\w.-]{2,100}"
                        r"(?:\s?[(\[{]\s?dot\s?[)\]}]\s?[\w-]{1,63}){0,4}", re.I),
    "ip": re.compile(r"(?<![\w.:])(?:\d{1,4}(?:\.\d{1,4}){3,5}|[0-9a-fA-F]{1,4}"
                     r"(?::[0-9a-fA-F]{0,4}){3,7})(?![\w:])"),
    "card": re.compile(r"(?<![\w])\d(?:[ .-]?\d){9,24}(?!\w)"),
    "phone": re.compile(r"(?<![\w.])\+?\(?\d[\d ().-]{5,22}\d(?!\w)"),
    "secret": re.compile(r"(?<![\w/+=-])(?=[\w/+=-]{0,63}\d)[A-Za-z0-9_/+=-]{16,}(?![\w/+=-])"),
}
_KNOWN_SECRET = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_\w{36,}|sk_live_\w{24,}|[0-9a-f]{40}|"
                           r"[0-9a-f]{32}|xox[abpr]-[\w-]{10,}|eyJ[\w-]{20,}")
_SPELLED = re.compile(r"[(\[{]\s?(?:at|@)\s?[)\]}]", re.I)
_MAILBOX = re.compile(r"[^@]+[\w-](?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?)[a-z]{2,10}", re.I)
_LOCAL_PHONE = re.compile(r"(?:\+?1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|"
                          r"\(0\d{2,4}\) ?\d{3,4}[ -]?\d{3,4}")
_DATE = re.compile(r"\d{4}([.-])\d{1,2}\1\d{1,2}|\d{1,2}([.-])\d{1,2}\2\d{4}")
_CUES = (
    re.compile(r"mail|contact|write", re.I), re.compile(r"\bip\b|host|server|addr", re.I),
    re.compile(r"card|visa|credit|account|iban", re.I),
    re.compile(r"tel|phone|call|fax|mobile", re.I),
    re.compile(r"key|token|secret|passw|api|auth", re.I))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As a leftmost search would find them, but in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start, then kind; code points."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if re.search("[0-9]", text):
        found += [("ip", *m.span()) for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if len(m[0]) <= 37:
                digits = re.sub(r"[^0-9]", "", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text)
                      if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    said = text[start:end]
    digits = re.sub(r"\D", "", said)
    groups = [len(g) for g in re.findall(r"\d+", said)] or [0]
    numbers = [int(g[:6]) for g in re.findall(r"\d+", said)] or [0]
    before, after = text[max(0, start - 1):start], text[end:end + 1]
    ahead = text[max(0, start - 24):start]
    n = len(said)
    return [float(x) for x in (
        KINDS.index(kind), n, len(digits), sum(map(str.isalpha, said)), sum(map(str.isupper, said)),
        len(set(said)) / n, len(groups), max(groups), min(groups), max(numbers),
        said.count("."), said.count("-"), said.count(" "), said.count(":"), said.count("("),
        said.count("@"), said.count("::"), said[:1] == "+", luhn(digits) if digits.isascii() and digits else 0,
        bool(re.search(r"\.[A-Za-z]{2,10}$", said)), sum(c in "abcdefABCDEF" for c in said) / n,
        before.isalnum(), before == " ", after.isalnum(), after == " ",
        *(bool(c.search(ahead)) for c in _CUES))]


def _is_ip(said: str) -> bool:
    try:
        ipaddress.ip_address(said)
    except ValueError:
        return False
    return True


def evidence(text: str, kind: str, start: int, end: int) -> int | None:
    """1 where a proposal outside the base is personal data, 0 where it is not, None if nothing tells."""
    said = text[start:end]
    digits = re.sub(r"[^0-9]", "", said)
    cue = bool(_CUES[KINDS.index(kind)].search(text[max(0, start - 24):start]))
    if kind == "email":
        at = _SPELLED.search(said)
        if at and _MAILBOX.fullmatch(said[at.end():].strip()):
            return 1
        return None if cue or at else 0
    if kind == "ip":
        if ":" not in said:
            return 0  # an IPv4 address is a base span
        return int(_is_ip(said))
    if kind == "card":
        if not 13 <= len(digits) <= 19 or not luhn(digits):
            return 0
        return 1 if cue or len(digits) == 13 and digits[0] == "4" else None
    if kind == "phone":
        if _LOCAL_PHONE.fullmatch(said):
            return 1
        if _DATE.fullmatch(said) or not 7 <= len(digits) <= 15:
            return 0
        return 1 if cue else 0 if said.isdigit() else None
    if _KNOWN_SECRET.fullmatch(said):
        return 1
    mixed = len(digits) >= 3 and sum(map(str.isalpha, said)) >= 3 and len(set(said)) >= 8
    return 1 if cue and mixed else None if cue or mixed else 0


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple]:
    """(kind, start, end, label, strict, features) of all proposals; they may overlap."""
    strict = set(base)
    out = []
    for kind, pattern in _WIDE.items():
        if kind == "email" and "@" not in text and not _SPELLED.search(text):
            continue
        for m in pattern.finditer(text):
            start, end = m.span()
            if kind == "email":
                end = start + len(m[0].rstrip(".-"))
            is_base = (kind, start, end) in strict
            label = 1 if is_base else evidence(text, kind, start, end)
            out.append((kind, start, end, label, is_base, features(text, kind, start, end)))
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_ONE = "struct<kind:string,start:bigint,stop:bigint,label:int,strict:boolean,features:array<double>>"
SCANNED = f"doc_id bigint, base string, cands array<{_ONE}>, version bigint"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    one = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                     ("label", pa.int32()), ("strict", pa.bool_()), ("features", pa.list_(pa.float64()))])
    for batch in slices(batches):
        base, cands, version = [], [], []
        for text in batch.column(1).to_pylist():
            version.append(xxhash.xxh64_intdigest(text) >> 1)
            spans, found = [], []
            if "@" in text or re.search(r"\d", text) or _SPELLED.search(text):
                spans = base_spans(text)
                found = candidates(text, spans)
            base.append(written(spans))
            cands.append([dict(zip(("kind", "start", "stop", "label", "strict", "features"), c))
                          for c in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(base, pa.string()), pa.array(cands, pa.list_(one)),
             pa.array(version, pa.int64())], names=["doc_id", "base", "cands", "version"])


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans, their numbers and hash, and all spans with the chosen candidates among them."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            base = [(k, int(a), int(b)) for k, a, b in
                    (s.split(":") for s in row["base"].split(",") if s)]
            taken = list(base)
            for c in sorted(row["chosen"] or [], key=lambda c: (-c["score"], c["start"], c["stop"],
                                                                c["kind"])):
                if all(c["stop"] <= a or c["start"] >= b for _, a, b in taken):
                    taken.append((c["kind"], c["start"], c["stop"]))
            taken.sort(key=lambda s: (s[1], KINDS.index(s[0])))
            rows.append((row["doc_id"], *[sum(k == kind for k, _, _ in base) for kind in BASE],
                         hashlib.sha256(row["base"].encode()).hexdigest(), written(taken),
                         len(taken) - len(base)))
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)],
            names=["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", "n_added"])


def _score(rows: DataFrame, models: list) -> DataFrame:
    """Adds the score of each row by the trees that did not learn from its half."""
    rows = rows.withColumn("vector", array_to_vector("bins"))
    for half, model in enumerate(models):
        rows = model.transform(rows).withColumn(
            f"score{half}", vector_to_array("probability")[1]).drop(
            "probability", "rawPrediction", "prediction")
    return rows.withColumn("score", F.when(F.col("half") == 0, F.col("score0")).otherwise(
        F.col("score1"))).drop("vector", "score0", "score1")


#: (label, base span) of the labelled candidates.
_CLASSES = ((0, False), (1, False), (1, True))


def _is_class(k: int) -> Column:
    label, strict = _CLASSES[k]
    return (F.col("label") == label) & (F.col("strict") == strict)


def _bin_ends(cands: DataFrame, parts: dict[int, float]) -> list[list[float]]:
    """Per feature the last value of each bin but the last, increasing.

    A feature of no more than ``BINS`` values has a bin for each.  Others are cut at exact quantiles of
    all candidates, in which each class counts by its part.
    """
    long = cands.select("label", "strict", F.posexplode("features").alias("feature", "value"))
    counted = saved(long.groupBy("feature", "value").agg(
        F.lit(1).alias("one"), *[F.count_if(_is_class(k)).alias(f"n{k}") for k in parts]), "pii-values")
    ranked = running_sums(counted, "value", {"rank": "one", **{f"upto{k}": f"n{k}" for k in parts}},
                          ["feature"])
    at = sum((F.col(f"upto{k}") / F.col(f"upto{k}_total") * part for k, part in parts.items()), F.lit(0.0))
    place = F.when(F.col("rank_total") <= BINS, F.col("rank")).otherwise(
        F.least(F.ceil(at * BINS), F.lit(BINS)))
    ends: dict[int, list[float]] = {}
    for row in ranked.groupBy("feature", place.alias("bin")).agg(  # `BINS` rows a feature at most
            F.max("value").alias("last")).collect():
        ends.setdefault(row["feature"], []).append(row["last"])
    return [sorted(ends[f])[:-1] for f in sorted(ends)]


def _bins(ends: list[list[float]]) -> Column:
    """The numbers of the bins of ``features``."""
    known = F.array(*[F.array(*map(F.lit, e)).cast("array<double>") for e in ends])
    return F.zip_with("features", known, lambda v, e: F.size(
        F.filter(e, lambda x: x < v)).cast("double"))


def _fit(table: DataFrame, half: int):
    """Trees from all rows of the other half; None if those have one label."""
    known = table.where(F.col("half") != half)
    labels, rows = known.agg(F.count_distinct("label"), F.count(F.lit(1))).first()
    if labels < 2:
        return None
    # The same rows in the same order whatever the partitioning of the documents, in as few tasks as
    # they need: every level of every tree is a job over them.
    tasks = math.ceil(rows / ROWS_PER_TASK)
    known = saved(known.orderBy("bins", "kind", "label", "strict").coalesce(tasks),
                  "pii-known").coalesce(tasks)
    return GBTClassifier(featuresCol="vector", labelCol="label", weightCol="weight", maxIter=TREES,
                         maxDepth=DEPTH, maxBins=_ALL_ROWS, seed=1, subsamplingRate=1.0,
                         stepSize=0.2).fit(known.withColumn("vector", array_to_vector("bins")))


def train(cands: DataFrame, sample: int | None = None):
    """The trees of both halves, the threshold of each kind and the ends of the bins; None where there
    is nothing to tell apart.  All labelled candidates are used, unless the caller asks for a ``sample``.
    """
    cands = cands.where("label IS NOT NULL")
    sizes = {(r["label"], r["strict"]): r["n"] for r in cands.groupBy("label", "strict").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # three rows
    if {label for label, _ in sizes} != {0, 1}:
        return None
    parts = {k: 0.5 if len([c for c in sizes if c[0] == one[0]]) == 1 else 0.25
             for k, one in enumerate(_CLASSES) if one in sizes}
    rate, weight = F.lit(0.0), F.lit(0.0)
    for k, part in parts.items():
        n = sizes[_CLASSES[k]]
        rate = F.when(_is_class(k), (sample or 0) * part / n).otherwise(rate)
        weight = F.when(_is_class(k), F.col("n") * (part * sum(sizes.values()) / n)).otherwise(weight)
    if sample is not None:
        # Drawn by what a candidate is, not by where its row lies: any partitioning draws the same.
        cands = cands.where(share("doc_id", "version", "kind", "start", "stop") < rate)
    ends = _bin_ends(cands, parts)
    if not ends:
        return None
    table = saved(cands.groupBy("half", "kind", "label", "strict", _bins(ends).alias("bins")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("weight", weight), "pii-labelled")
    fitted = side_by_side(table.sparkSession, {str(h): lambda h=h: _fit(table, h) for h in (0, 1)})
    models = [fitted["0"], fitted["1"]]
    if None in models:
        return None
    # From the highest score down: how many so far, how many of them positive.
    marks = saved(_score(table.where("NOT strict"), models).groupBy(
        "kind", (-F.col("score")).alias("down")).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("right")), "pii-marks")
    good = running_sums(marks, "down", {"of": "n", "hits": "right"}, ["kind"]).where(
        (F.col("hits") / F.col("of") >= PRECISION) & (F.col("down") < -0.5))
    limits = {r["kind"]: -r["down"] for r in good.groupBy("kind").agg(  # a row per kind
        F.max("down").alias("down")).collect()}
    return models, limits, ends


def find(docs: DataFrame, sample: int | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added: a row per document."""
    scanned = saved(doc_texts(docs).mapInArrow(_scan, SCANNED)
                    .withColumn("row", F.monotonically_increasing_id()), "pii")
    cands = scanned.select("row", "doc_id", "version", F.explode("cands").alias("c")).select(
        "row", "doc_id", "version", "c.*")
    half = F.when(share("version", "kind", "start", "stop") < 0.5, 0).otherwise(1)
    cands = cands.withColumn("half", half)
    trained = train(cands, sample)
    none = F.lit(None).cast("array<struct<score:double,kind:string,start:bigint,stop:bigint>>")
    if trained is None:
        chosen = scanned.select("doc_id", "base", none.alias("chosen"))
    else:
        models, limits, ends = trained
        limit = F.lit(2.0)
        for kind, value in limits.items():
            limit = F.when(F.col("kind") == kind, value).otherwise(limit)
        scored = _score(cands.withColumn("bins", _bins(ends)), models)
        best = (scored.where(F.col("score") >= limit).groupBy("row").agg(
            F.collect_list(F.struct("score", "kind", "start", "stop")).alias("chosen")))
        chosen = scanned.select("row", "doc_id", "base").join(best, "row", "left").select(
            "doc_id", "base", "chosen")
    counts = ", ".join(f"n_{k} bigint" for k in BASE)
    return chosen.mapInArrow(
        _choose, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_added bigint")


def redact(text: str, spans: str) -> str:
    """``text`` with every span of a ``spans`` string replaced by its kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in (s.split(":") for s in spans.split(",") if s):
        if int(a) >= at:
            out += [text[at:int(a)], f"<{kind}>"]
        at = max(at, int(b))
    return "".join(out) + text[at:]


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return find(read(spark, sf_dir, "documents"))
