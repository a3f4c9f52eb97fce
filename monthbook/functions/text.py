"""Text normalisation and feature names.

Accents go by Unicode compatibility decomposition without combining marks; every run of
other characters becomes one underscore.  The fold tables are built from the Unicode data
by rule, once, so that the column form needs no Python on the row path.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F


@lru_cache(maxsize=1)
def _fold_table() -> dict[int, str]:
    """Non-ASCII code point -> its text without marks, where that matters.

    Kept are characters that vanish (marks) and those that leave an ASCII letter or digit.
    All others end as an underscore whether they are folded or not.
    """
    table = {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        marks = unicodedata.combining
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not marks(c))
        if not plain or (plain != char and re.search("[a-zA-Z0-9]", plain)):
            table[point] = plain
    return table


def normalize_text(text: object) -> str:
    """``'R$ 100,00'`` -> ``'r_100_00'``, ``'AÇÃO/REAÇÃO'`` -> ``'acao_reacao'``."""
    folded = str(text).translate(_fold_table())
    return re.sub("[^a-zA-Z0-9]+", "_", folded).strip("_").lower()


@lru_cache(maxsize=1)
def _column_folds() -> tuple[str, str, dict[str, str]]:
    single = {chr(p): s for p, s in _fold_table().items() if len(s) == 1}
    marks = [chr(p) for p, s in _fold_table().items() if not s]
    several = {chr(p): s for p, s in _fold_table().items() if len(s) > 1}
    # translate() deletes the characters that have no partner at the end.
    return "".join([*single, *marks]), "".join(single.values()), several


def normalize_text_col(text: Column) -> Column:
    """Column form of :func:`normalize_text`, all in JVM expressions.

    Plain ASCII rows skip the fold.  Characters that fold to several letters (ligatures,
    fractions, unit signs) are looked up one by one, and only in rows that hold one.
    """
    matching, replacing, several = _column_folds()
    simple = F.translate(text, matching, replacing)
    entries = [F.lit(part) for pair in several.items() for part in pair]
    lookup = F.create_map(*entries)
    chars = F.regexp_extract_all(simple, F.lit("(?s)."), F.lit(0))
    spelled = F.array_join(
        F.transform(chars, lambda c: F.coalesce(F.try_element_at(lookup, c), c)), "")
    beyond_ascii = r"[^\x00-\x7F]"
    # A long character class is slow to match; deleting and comparing lengths is not.
    has_several = F.length(F.translate(simple, "".join(several), "")) < F.length(simple)
    folded = (F.when(~text.rlike(beyond_ascii), text)
              .when(simple.rlike(beyond_ascii) & has_several, spelled)
              .otherwise(simple))
    return F.lower(F.trim(F.regexp_replace(folded, "[^a-zA-Z0-9]+", "_"), F.lit("_")))


def feature_name(
    variable: str,
    aggregation: str,
    months: int | None = None,
    category: str | None = None,
    value: str | None = None,
) -> str:
    """``{variable}[_{category}_{value}]_{aggregation}[_{months}m]``."""
    words = [normalize_text(variable)]
    if category and value:
        words += [normalize_text(category), normalize_text(value)]
    words.append(aggregation.lower())
    if months:
        words.append(f"{months}m")
    return "_".join(words)
