"""Removal of repeated runs of lines, found by winnowing.

A document is the sequence of its non-blank lines, by hash.  From every window of ``guarantee``
lines, the least hash of ``gram`` consecutive lines is selected (the rightmost of equal ones).  Only
the selected places are kept, each with the ``guarantee - gram`` lines before and after it: a run of
at least ``guarantee`` lines that occurs twice has selected places with one hash in both.  A line of
``long`` code points or more is a selected place by itself, so that it is found between any
neighbours.

Places whose hash occurs once are dropped.  The others are joined with the first place of the same
hash and extended to both sides: by none for a long line, else by every share of the lines before
and after that makes a window of ``guarantee`` lines.  Extensions of neighbouring places overlap, so
together they cover a match of any length.  The first place of an extension, by doc_id and line, is
a minimum per group, so copies are never paired.

A line is removed if it lies in an extension that occurs earlier: in a document with a smaller
doc_id, or further up in the same one, without overlap.  Runs shorter than ``guarantee`` lines stay
if all their lines are shorter than ``long``.

Everything is DataFrame functions.

Defined results: null and empty texts have no lines and stay as they are; blank lines neither count
nor go; documents with a null doc_id come last, rows with one doc_id by a hash of the text, and
repeated rows of one document are one document with one result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthbook.llm.common import doc_texts, read, saved

GRAM = 1
GUARANTEE = 2
#: Code points from which a single line is a run.
LONG = 40


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _seen(lines: Column) -> Column:
    """The numbers of the lines that are not blank."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.trim(lines[i]) != "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` made once."""
    return F.transform(F.array(value), body)[0]


def _selected(text: Column, gram: int, guarantee: int, long: int) -> Column:
    """The selected places: fingerprint, place, the lines from ``base`` on around it, whether a
    window selected it, and a second hash of a long line."""
    lines = F.transform(
        F.filter(_lines(text), lambda x: F.trim(x) != ""),
        lambda x: F.struct(F.xxhash64(x).alias("h"), F.when(
            F.length(x) >= long, F.xxhash64(F.lit("again"), x)).alias("long")))
    wide = guarantee - gram  # lines on each side of a place that a window may hold

    def grams(h: Column) -> Column:
        if gram == 1:
            return h
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - gram, F.lit(0))),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(gram)]))

    def least(g: Column, s: Column) -> Column:
        """The place that the window from line ``s`` selects."""
        return -F.array_min(F.array(*[F.struct(F.get(g, s + k).alias("fp"), (-(s + k)).alias("p"))
                                      for k in range(wide + 1)]))["p"]

    def place(h: Column, fp: Column, p: Column, by_window: bool, again: Column) -> Column:
        base = F.greatest(p - wide, F.lit(0))
        around = F.slice(h, base + 1, p + guarantee - base) if by_window else F.slice(h, p + 1, 1)
        return F.struct(fp.alias("fp"), p.alias("place"),
                        (base if by_window else p).alias("base"), around.alias("around"),
                        again.alias("again"))

    def places(all_: Column) -> Column:
        h = all_["h"]
        starts = F.when(F.size(h) >= guarantee,
                        F.sequence(F.lit(0), F.size(h) - guarantee)).otherwise(
            F.array().cast("array<int>"))
        numbers = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.size(h) - 1)).otherwise(
            F.array().cast("array<int>"))
        by_window = _let(grams(h), lambda g: F.transform(
            F.array_distinct(F.transform(starts, lambda s: least(g, s))),
            lambda p: place(h, F.get(g, p), p, True, F.lit(None).cast("bigint"))))
        alone = F.transform(F.filter(numbers, lambda p: F.get(all_, p)["long"].isNotNull()),
                            lambda p: place(h, F.get(h, p), p, False, F.get(all_, p)["long"]))
        return F.concat(by_window, alone)

    return _let(lines, places)


def _extensions(gram: int, guarantee: int) -> Column:
    """Of a selected place: start, number of lines and hashes of every window that holds it."""
    wide = guarantee - gram
    at = F.col("place") - F.col("base")

    def window(s: Column) -> Column:
        lines = [F.get("around", s + k) for k in range(guarantee)]
        return F.struct((F.col("base") + s).cast("int").alias("start"),
                        F.lit(guarantee).alias("size"), F.xxhash64(*lines).alias("key"),
                        F.xxhash64(F.lit("again"), *reversed(lines)).alias("key2"))

    first = F.greatest(at - wide, F.lit(0))
    last = F.least(at, F.size("around") - guarantee)
    none = F.array().cast("array<struct<start:int,size:int,key:bigint,key2:bigint>>")
    wider = F.when(last >= first, F.transform(F.sequence(first, F.greatest(last, first)), window))
    alone = F.array(F.struct(F.col("place").cast("int").alias("start"), F.lit(1).alias("size"),
                             F.col("fp").alias("key"), F.col("again").alias("key2")))
    return F.when(F.col("again").isNotNull(), alone).otherwise(F.coalesce(wider, none))


def repeated_runs(docs: DataFrame, gram: int = GRAM, guarantee: int = GUARANTEE,
                  long: int = LONG) -> DataFrame:
    """doc_id, version, runs (start, size): the extended matches of each document.

    ``version`` is a hash of the text, ``start`` counts non-blank lines from 0.
    """
    rows = doc_texts(docs).select("doc_id", F.xxhash64("text").alias("version"), F.explode(
        _selected(F.col("text"), gram, guarantee, long)).alias("p"))
    rows = saved(rows.select("doc_id", "version", "p.*"), "lines")
    marks = rows.groupBy("fp").agg(
        F.min(F.struct("doc_id", "version", "place")).alias("least"),
        F.max(F.struct("doc_id", "version", "place")).alias("most"))
    # Both lists are written: a join of two shuffled sides can split a very common line.
    repeated = saved(marks.where(~F.col("least").eqNullSafe(F.col("most"))).select("fp"),
                     "repeated-lines")
    near = rows.join(repeated, "fp", "left_semi").select(
        "doc_id", "version", F.explode(_extensions(gram, guarantee)).alias("w")).select(
        "doc_id", "version", "w.*")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "start")
    first = near.groupBy("size", "key", "key2").agg(F.min(place).alias("first"),
                                                    F.max(place).alias("last"))
    first = saved(first.where(~F.col("first").eqNullSafe(F.col("last")))
                  .select("size", "key", "key2", "first"), "first-runs")
    met = near.join(first, ["size", "key", "key2"])
    here = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (
        F.col("version") == F.col("first.version"))
    later = F.when(here, F.col("start") >= F.col("first.start") + F.col("size")).otherwise(True)
    return met.where(later).groupBy("doc_id", "version").agg(
        F.collect_set(F.struct("start", "size")).alias("runs"))


def remove_repeats(docs: DataFrame, gram: int = GRAM, guarantee: int = GUARANTEE,
                   long: int = LONG) -> DataFrame:
    """doc_id, n_lines, n_removed, kept: every document without its repeated lines."""
    runs = repeated_runs(docs, gram, guarantee, long)
    texts = doc_texts(docs).withColumn("version", F.xxhash64("text"))
    joined = texts.alias("d").join(runs.alias("s"), F.expr(
        "d.doc_id <=> s.doc_id AND d.version = s.version"), "left").select(
        "d.doc_id", "d.text", "s.runs")
    covered = F.array_distinct(F.flatten(F.transform(
        "runs", lambda r: F.sequence(r["start"], r["start"] + r["size"] - 1))))

    def cut(lines: Column) -> Column:
        gone = _let(_seen(lines), lambda seen: F.transform(covered, lambda p: F.get(seen, p)))
        return _let(gone, lambda g: F.struct(
            F.size(lines).cast("bigint").alias("n_lines"), F.size(g).cast("bigint").alias("n_removed"),
            F.array_join(F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), g),
                lambda i: F.get(lines, i)), "\n").alias("kept")))

    whole = F.struct(F.size(_lines(F.col("text"))).cast("bigint").alias("n_lines"),
                     F.lit(0).cast("bigint").alias("n_removed"), F.col("text").alias("kept"))
    done = F.when(F.col("runs").isNull(), whole).otherwise(_let(_lines(F.col("text")), cut))
    return joined.select("doc_id", done.alias("r")).select("doc_id", "r.*")


def line_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after the removal of repeated lines."""
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


LINE_SQL = f"""
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line FROM (
    SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i FROM (
      SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), full_ AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
  FROM lines WHERE trim(line, ' ') <> ''
), pairs AS (
  SELECT doc_id, p, line AS a, lead(line) OVER (PARTITION BY doc_id ORDER BY p) AS b FROM full_
), firsts AS (
  SELECT a, b, arg_min(p, (doc_id, p)) AS p0, min(doc_id) AS doc0
  FROM pairs WHERE b IS NOT NULL GROUP BY a, b
), gone AS (
  SELECT x.doc_id, x.p FROM pairs x JOIN firsts f ON x.a = f.a AND x.b = f.b
  WHERE x.doc_id > f.doc0 OR x.p >= f.p0 + 2
), alone AS (
  SELECT line, arg_min(p, (doc_id, p)) AS p0, min(doc_id) AS doc0
  FROM full_ WHERE length(line) >= {LONG} GROUP BY line
), covered AS (
  SELECT DISTINCT f.doc_id, f.i FROM full_ f JOIN gone g ON f.doc_id = g.doc_id AND f.p IN (g.p, g.p + 1)
  UNION
  SELECT f.doc_id, f.i FROM full_ f JOIN alone s ON f.line = s.line
  WHERE f.doc_id > s.doc0 OR f.p > s.p0
)
SELECT l.doc_id, count(*) AS n_lines, count(c.i) AS n_removed,
  sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (c.i IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.i = c.i GROUP BY l.doc_id
"""
