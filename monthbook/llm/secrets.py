"""Secret scans: fixed base patterns, and weak parts of credentials linked by an interval join.

Base.  Assigned passwords and tokens, access keys and long hex strings, leftmost and non-overlapping
per kind.  Base spans are always kept.

Parts.  Every document is also searched for the parts a credential is made of, each too weak to be
reported alone:

    identifier  a value set for an account, a user, a client or an application; a short access key;
                the user of a URL
    secret      a mixed string with high entropy; a value set for a ``pwd``, ``pass``, ``key``, ...;
                the password of a URL
    endpoint    a URL, a host with a port, a value set for a host or an endpoint

Base spans are parts as well: an access key is an identifier, assigned values and hex strings are
secrets.

Linking.  A text falls into scopes: blocks between blank lines.  A part reaches ``REACH`` characters
to both sides inside its scope.  The interval join asks for each part which complementary roles have
a part whose interval meets its reach.  Only the nearest on either side matter, so the join is one
pass over the parts of a scope in order: the latest end of each role so far, and the first start of
each role to come.  No pairs are made, whatever the number of parts.  A weak secret is reported if an
identifier or an endpoint is in reach, an identifier if a secret is, an endpoint if both are.

The parts are rows of (document, scope); texts are never shuffled, and no scope exceeds a document.

Defined results: null and empty texts have no spans; repeated rows repeat their result; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from monthbook.llm.common import doc_texts, read, saved, slices

BASE = ("assign", "access", "hex")
ROLES = ("identifier", "secret", "endpoint")
KINDS = BASE + ROLES
REACH = 200
ENTROPY = 3.5

# The base patterns.  Each of the last two is a whole run, long enough.
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"""([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_SET = r"""["']?[\x20\t]{0,8}[:=][\x20\t]{0,8}["']?"""

# Generators of parts; group 1 is the span.  The first ones need a colon or an equals sign.
_ASSIGNED = (
    ("identifier", re.compile(
        r"(?ai)(?<![a-z0-9])(?:access_?key(?:_?id)?|account(?:_?(?:id|name))?|app(?:lication)?_?id|"
        r"client_?(?:id|name)|key_?id|login|project_?id|subscription_?id|tenant(?:_?id)?|"
        rf"user(?:_?(?:id|name))?){_SET}([a-z0-9][a-z0-9._@+-]{{2,}})")),
    ("secret", re.compile(
        r"(?ai)(?<![a-z0-9])(?:auth|bearer|credentials?|key|pass(?:phrase)?|private_?key|pwd|"
        rf"sig(?:nature)?){_SET}([a-z0-9+/_.=!@#$%^&*-]{{6,}})")),
    ("endpoint", re.compile(
        r"(?ai)(?<![a-z0-9])(?:base_?url|bucket|endpoint|host(?:name)?|server|url)"
        rf"{_SET}(?!(?:https?|ftp)://)([a-z0-9][a-z0-9.:/_-]{{2,}})")),
    ("endpoint", re.compile(r"(?ai)(?<![a-z0-9.-])([a-z0-9-]{1,63}(?:\.[a-z0-9-]{1,63}){1,8}:\d{2,5})(?!\d)")),
)
_SHORT_KEY = re.compile(r"(?a)(?<![A-Za-z0-9])(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{4,}")
_URL = re.compile(r"(?ai)(?:https?|ftp|mongodb|redis|postgres(?:ql)?|mysql|amqp|s3)://"
                  r"(?:([^\s/:@\"'<>]+):([^\s/@\"'<>]+)@)?([^\s\"'<>()@]{3,})")
_STRING = re.compile(r"(?a)(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_BREAK = re.compile(r"\n[\x20\t\r]*\n")


def entropy(said: str) -> float:
    """Bits per character."""
    n = len(said)
    return -sum(c / n * math.log2(c / n) for c in Counter(said).values())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start, then kind; code points."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _random(said: str) -> bool:
    """Capitals, small letters and digits mixed as no word or path mixes them."""
    return (bool(re.search(r"[0-9]", said)) and bool(re.search(r"[A-Z]", said))
            and bool(re.search(r"[a-z]", said)) and entropy(said) >= ENTROPY)


def _proposals(text: str) -> set[tuple[int, int, str]]:
    """(start, end, role) of everything that looks like a part."""
    found = {(*m.span(), "identifier") for m in _SHORT_KEY.finditer(text)}
    if ":" in text or "=" in text:
        found |= {(m.start(1), m.end(1), role) for role, pattern in _ASSIGNED
                  for m in pattern.finditer(text)}
    urls = []
    if "://" in text:
        for m in _URL.finditer(text):
            urls.append(m.span(3))
            found.add((*m.span(3), "endpoint"))
            if m[1] is not None:
                found |= {(*m.span(1), "identifier"), (*m.span(2), "secret")}
    at = 0
    for m in _STRING.finditer(text):
        while at < len(urls) and urls[at][1] <= m.start():
            at += 1
        # A string inside an address is a part of the address.
        if not (at < len(urls) and urls[at][0] < m.end()) and _random(m[0]):
            found.add((*m.span(), "secret"))
    return found


def parts(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, str, int, int, bool]]:
    """(scope, role, start, end, weak) of a text; weak ones that touch a base span are left out."""
    found = [(a, b, "identifier" if kind == "access" else "secret", False) for kind, a, b in base]
    taken, at = sorted((a, b) for _, a, b in base), 0
    for a, b, role in sorted(_proposals(text)):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if at == len(taken) or taken[at][0] >= b:
            found.append((a, b, role, True))
    breaks, scope, out = [m.start() for m in _BREAK.finditer(text)] if found else [], 0, []
    for a, b, role, is_weak in sorted(found):
        while scope < len(breaks) and breaks[scope] < a:
            scope += 1
        out.append((scope, role, a, b, is_weak))
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_PART = pa.struct([("scope", pa.int32()), ("role", pa.string()), ("start", pa.int64()),
                   ("stop", pa.int64()), ("weak", pa.bool_())])
SCANNED = ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base string, "
           "parts array<struct<scope:int,role:string,start:bigint,stop:bigint,weak:boolean>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _PART]
    for batch in slices(batches):
        counts, base, found = [], [], []
        for text in batch.column(1).to_pylist():
            spans = base_spans(text)
            counts.append([sum(k == kind for k, _, _ in spans) for kind in BASE])
            base.append(written(spans))
            made = parts(text, spans)
            # Parts of one side alone, or without a weak one, link nothing.
            some = {role for _, role, _, _, _ in made}
            if "secret" not in some or len(some) < 2 or not any(p[4] for p in made):
                made = []
            found.append([dict(zip(names, p)) for p in made])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array([c[k] for c in counts], pa.int64()) for k in range(len(BASE))],
             pa.array(base, pa.string()), pa.array(found, pa.list_(_PART))],
            names=["doc_id", *[f"n_{k}" for k in BASE], "base", "parts"])


def linked(rows: DataFrame, keys: list[str], reach: int = REACH) -> DataFrame:
    """The weak parts whose complement lies in reach.

    ``rows`` has ``keys`` (what a scope is named by), ``role, start, stop, weak``; it is returned
    without the parts that are strong or stand alone.
    """
    order = ("start", "stop", "role")
    scope = Window.partitionBy(*keys)
    # Both frames grow row by row; one that shrinks would be made anew for every row.
    before = scope.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = scope.orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)

    def near(role: str) -> Column:
        behind = F.max(F.when(F.col("role") == role, F.col("stop"))).over(before)
        ahead = F.min(F.when(F.col("role") == role, F.col("start"))).over(after)
        return (F.coalesce(behind + reach >= F.col("start"), F.lit(False))
                | F.coalesce(ahead - reach <= F.col("stop"), F.lit(False)))

    seen = rows.select("*", *[near(role).alias(f"near_{role}") for role in ROLES])
    complete = (F.when(F.col("role") == "secret", F.col("near_identifier") | F.col("near_endpoint"))
                .when(F.col("role") == "identifier", F.col("near_secret"))
                .otherwise(F.col("near_secret") & F.col("near_identifier")))
    return seen.where(F.col("weak") & complete).select(*rows.columns)


def find(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base, spans, n_linked: a row per row of ``docs``.

    ``base`` and ``spans`` are ``kind:start:end`` of the base spans and of all spans, by start, then
    kind, comma-joined; code points, end exclusive.
    """
    scanned = saved(doc_texts(docs).mapInArrow(_scan, SCANNED)
                    .withColumn("row", F.monotonically_increasing_id()), "secrets")
    rows = scanned.select("row", F.explode("parts").alias("p")).select("row", "p.*")
    more = linked(rows, ["row", "scope"], reach).groupBy("row").agg(
        F.collect_set(F.struct("start", "stop", "role")).alias("more"))  # at most a text's spans
    kind = F.create_map(*[F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair])

    def number(text: Column, at: int) -> Column:
        return F.element_at(F.split(text, ":"), at).cast("bigint")

    base = F.transform(
        F.filter(F.split("base", ","), lambda s: s != ""),
        lambda s: F.struct(number(s, 2).alias("start"),
                           F.element_at(kind, F.element_at(F.split(s, ":"), 1)).alias("kind"),
                           s.alias("span")))
    added = F.transform("more", lambda m: F.struct(
        m["start"].alias("start"), F.element_at(kind, m["role"]).alias("kind"),
        F.concat_ws(":", m["role"], m["start"], m["stop"]).alias("span")))
    every = F.array_join(F.transform(F.array_sort(F.concat(base, added)), lambda s: s["span"]), ",")
    return scanned.join(more, "row", "left").select(
        "doc_id", *[f"n_{k}" for k in BASE], "base",
        F.when(F.col("more").isNull(), F.col("base")).otherwise(every).alias("spans"),
        F.when(F.col("more").isNull(), 0).otherwise(F.size("more")).cast("bigint").alias("n_linked"))


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return find(read(spark, sf_dir, "documents")).select(
        "doc_id", *[f"n_{k}" for k in BASE], F.sha2(F.col("base"), 256).alias("base_sha256"), "spans",
        "n_linked")
