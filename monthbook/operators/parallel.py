"""Independent Spark work side by side: driver threads, one scheduler pool and job group each.

Tree models run hundreds of small jobs, one after the other, and a single one leaves a cluster idle
between them.  Models that do not need each other (folds, arms, tables) are therefore fitted at
the same time.  With ``spark.scheduler.mode=FAIR`` each gets its own pool; otherwise jobs queue up
in the order they were submitted, which is still fine for jobs smaller than the cluster.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from monthbook.session import allow_checkpoints

T = TypeVar("T")

#: Most threads at a time, and rows a task of a model's training should have at least.
MOST = 8
ROWS_PER_TASK = 20_000


def side_by_side(spark: SparkSession, work: Mapping[str, Callable[[], T]], most: int = MOST,
                 seconds: float | None = None, isolate: bool = False) -> dict[str, T | Exception]:
    """The results of some functions by name, with at most ``most`` of them running.

    ``seconds`` bounds the time one function may run: its Spark jobs are cancelled then, and it
    fails with ``TimeoutError``.  The first failure cancels the others and is raised; with
    ``isolate`` it is returned as the result of its function and stops nothing.
    """
    context, batch = spark.sparkContext, uuid.uuid4().hex[:8]
    group = {name: f"{batch}-{k}" for k, name in enumerate(work)}
    begun: dict[str, float] = {}

    def run(name: str) -> T:
        begun[name] = time.monotonic()
        context.setJobGroup(group[name], name, interruptOnCancel=True)
        context.setLocalProperty("spark.scheduler.pool", group[name])
        return work[name]()

    done: dict[str, T | Exception] = {}
    late: set[str] = set()
    with ThreadPoolExecutor(max(1, min(most, len(work)))) as threads:
        futures = {threads.submit(inheritable_thread_target(spark)(run), name): name
                   for name in work}
        open_ = set(futures)
        while open_:
            ended, open_ = wait(open_, timeout=None if seconds is None else 0.2,
                                return_when=FIRST_COMPLETED)
            for future in ended:
                name, error = futures[future], future.exception()
                if name in late:
                    error = TimeoutError(f"{name} ran for over {seconds} s")
                if error is not None and not isolate:
                    for other in open_:
                        other.cancel()
                        context.cancelJobGroup(group[futures[other]])
                    raise error
                done[name] = future.result() if error is None else error
            for name in [futures[f] for f in open_ if seconds is not None]:
                if name in begun and time.monotonic() - begun[name] > seconds:
                    late.add(name)  # cancelled again and again: it may be between two jobs
                    context.cancelJobGroup(group[name])
    return {name: done[name] for name in work}


def training_rows(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` persisted for training: as many partitions as its rows need, no more than it has.

    Every level of every tree is a job over all partitions, so near-empty ones cost more than
    the work in them.  Call ``unpersist`` on the result when the models are there.
    """
    allow_checkpoints(df.sparkSession)  # boosted trees cut the lineage of their predictions
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    rows = held.agg(F.count(F.lit(1))).first()[0]
    wanted = max(1, math.ceil(rows / rows_per_task))
    if wanted >= held.rdd.getNumPartitions():
        return held
    packed = held.coalesce(wanted).persist(StorageLevel.MEMORY_AND_DISK)
    packed.count()
    held.unpersist()
    return packed
