"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthbook.session import scratch_path

#: Words are runs of anything but these six bytes: space, tab, newline, \\v, \\f, \\r.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back.

    This cuts the lineage: rows made once are never made again when an executor is lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The cluster's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def doc_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` (bigint) and ``text`` (null: empty); other columns are left behind."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 20,
           column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts record batches into pieces of about ``most`` bytes of text, one row at least.

    Memory inside a task then depends on the longest text, not on the rows in a batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column)))
        ends = np.cumsum(np.asarray(sizes.fill_null(0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            base = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the offsets of its rows in them."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0]: at[-1]], at - at[0]


def large_binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The reverse of :func:`utf8`: a binary column over bytes and offsets, without a copy."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
                                  pa.py_buffer(np.ascontiguousarray(data, np.uint8))])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start .. start + length`` of every row, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def unit(*parts: object) -> int:
    """A fixed 64-bit number for some values: the same in every process and run."""
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "big")


def share(*cols: str | Column) -> Column:
    """A fixed number from 0 to 1 for each row, from a hash of some columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)
