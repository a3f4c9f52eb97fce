"""From raw documents to token files: five stages, each on what the one before it kept.

Every stage is called as ``stage(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``docs``.  :func:`run` writes each result below ``spark.checkpoint.dir`` and
reads it back for the next stage, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthbook.llm.common import read, saved
from monthbook.llm.decontam import clean
from monthbook.llm.langid import accepted
from monthbook.llm.mixing import mixed
from monthbook.llm.simhash import one_of_each
from monthbook.llm.tokens import token_index, vocabulary_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model tells for sure."""
    return accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark."""
    return clean(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token files."""
    return token_index(docs, vocabulary_path())


STAGES = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mixing),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language ID, SimHash components, the cube draw and token ids are beyond SQL: the pipeline is
#: tested against a brute-force version.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
