"""Session settings, scratch folders and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

#: Settings the toolkit is tuned for.  Shuffle partitions are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot population key even when a later join then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Books have thousands of column expressions; do not record where each was written.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: For sessions that join tables of :func:`~monthbook.sources.tables.store_by_document`: a join on document
#: and month may stay where equal documents already are.
COLOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def build_session(app: str = "monthbook", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``conf`` uses ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``.

    Only a local session may run without it; it then gets a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="monthbook-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


#: Scratch paths made by this process and not cleared yet.
_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below :func:`shared_dir`."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Deletes what this process wrote to scratch paths; call it when results have been used.

    Frames that still read those files cannot be used any more.  Checkpoints go by themselves
    with ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    count = len(_made)
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def allow_checkpoints(spark: SparkSession) -> None:
    """Lets Spark (and its iterative models) checkpoint to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder; later reads survive the loss of executors."""
    allow_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


#: Frames that read what :func:`written` wrote.
_read_back: weakref.WeakSet[DataFrame] = weakref.WeakSet()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to a scratch path and read back; cuts the lineage as well."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    _read_back.add(made)
    return made


def is_written(df: DataFrame) -> bool:
    """Whether ``df`` is what :func:`written` gave: reading it again makes no row again."""
    return df in _read_back
