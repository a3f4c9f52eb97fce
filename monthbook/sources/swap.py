"""Replacing the months of an output at once.

A run writes its months into a folder of the output that readers skip.  When they are all there, a
manifest that names the months to bring in and to take out is renamed into place: this one step
decides.  A run that fails before it changes nothing.  After it the month folders are renamed, one by
one; if the driver is lost meanwhile, the next :func:`settle` goes on where it stopped, and every write
and every :func:`~monthbook.sources.tables.read_written` of an output begins with one.

Only folder names pass through the driver, one per month.  One run at a time may write to an output;
readers that list the output during the renames may see months of both runs.  On object stores a
rename is a copy.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

SWAP = "_swap"


def _place(spark: SparkSession, path: str):
    """Hadoop's path and file system of ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if it is missing."""
    place, fs = _place(spark, path)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(place))


def _folders(spark: SparkSession, path: str, by: str) -> set[str]:
    return {n for n in _names(spark, path) if n.startswith(f"{by}=")}


def _remove(spark: SparkSession, path: str) -> None:
    place, fs = _place(spark, path)
    fs.delete(place, True)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    source, fs = _place(spark, old)
    if not fs.rename(source, _place(spark, new)[0]):
        raise OSError(f"cannot rename {old} to {new}")


def swap_partitions(df: DataFrame, path: str, by: str, write,
                    values: Sequence[str | int] | None = None) -> None:
    """Replace partitions of the output ``path`` by those of ``df``.

    ``write(df, folder, by)`` writes a partitioned output.  Of ``values`` (of all partitions, if not
    given), those without a row are taken out.
    """
    spark = df.sparkSession
    settle(spark, path)
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    staged = f"{path}/{SWAP}/{run}"
    try:
        write(df, staged, by)
    except Exception:
        _remove(spark, staged)
        raise
    new = _folders(spark, staged, by)
    gone = _folders(spark, path, by) - new
    if values is not None:
        wanted = {str(v) for v in values}
        gone = {f for f in gone if unquote(f.split("=", 1)[1]) in wanted}
    _publish(spark, path, run, {"bring": sorted(new), "remove": sorted(gone)})
    settle(spark, path)


def _publish(spark: SparkSession, path: str, run: str, plan: dict[str, list[str]]) -> None:
    """Write the manifest beside the staged months and rename it: it is whole or not there."""
    draft = f"{path}/{SWAP}/{run}/_manifest"
    place, fs = _place(spark, draft)
    stream = fs.create(place, True)
    try:
        stream.write(bytearray(json.dumps(plan).encode()))
    finally:
        stream.close()
    _rename(spark, draft, f"{path}/{SWAP}/{run}.json")


def _manifest(spark: SparkSession, path: str) -> dict[str, list[str]]:
    place, fs = _place(spark, path)
    stream = fs.open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def settle(spark: SparkSession, path: str) -> None:
    """Finish the swaps that were decided, oldest first; nothing to do in most cases."""
    swaps = [n for n in _names(spark, f"{path}/{SWAP}") if n.endswith(".json")]
    for name in swaps:
        staged = f"{path}/{SWAP}/{name.removesuffix('.json')}"
        plan = _manifest(spark, f"{path}/{SWAP}/{name}")
        for folder in sorted(set(plan["bring"]) & set(_names(spark, staged))):
            _remove(spark, f"{path}/{folder}")  # not yet brought in
            _rename(spark, f"{staged}/{folder}", f"{path}/{folder}")
        for folder in plan["remove"]:
            _remove(spark, f"{path}/{folder}")
        _remove(spark, f"{path}/{SWAP}/{name}")
        _remove(spark, staged)
    if swaps:
        spark.catalog.refreshByPath(path)
