"""Reading and writing tables, control data and results."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import NumericType, StructField, StructType

from monthbook.functions.months import month_literal, parse_lag
from monthbook.sources.swap import settle, swap_partitions

# Columns of the two forms of the control table.
LAG_METADATA = ("table_name", "doc_column_name", "doc_column_type", "date_column_name",
                "date_column_type", "date_delay")
ROOT_METADATA = ("Nome", "nom_doc", "n_dig_doc", "nom_safra", "tipo_safra", "Defasagem")


@dataclass(frozen=True)
class FeatureKeys:
    """How a feature table is keyed and how many months it lags."""

    table: str
    doc: str
    month: str
    lag: int = 0
    doc_type: str = "string"
    month_type: str = "string"
    doc_digits: int | None = None
    #: No (document, month) repeats; spares the look for hot keys.
    unique: bool = False


def read_table(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """CSV (header, types inferred) or Parquet by suffix; anything else is refused."""
    if path.endswith(".csv"):
        return spark.read.options(**{"header": True, "inferSchema": True, **options}).csv(path)
    if path.endswith(".parquet"):
        return spark.read.options(**options).parquet(path)
    raise ValueError(f"unsupported file type: {path}")


def table_stem(path: str) -> str:
    """``…/name.parquet`` -> ``name``."""
    return path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]


def sql_table(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Result of a query; ``tables`` may be named in it as ``{name}``."""
    return spark.sql(sql, **tables)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A control table from CSV (all text), JSON, or otherwise Parquet."""
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    if path.endswith(".json"):
        return spark.read.option("multiLine", True).json(path)
    return spark.read.parquet(path)


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise ``ValueError`` if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def feature_keys(metadata: DataFrame) -> list[FeatureKeys]:
    """Rows of a control table, of either form, as :class:`FeatureKeys`."""
    if "Nome" in metadata.columns:
        require_columns(metadata, ROOT_METADATA)
        return [_root_keys(r) for r in metadata.select(*ROOT_METADATA).collect()]
    require_columns(metadata, LAG_METADATA)
    return [_lag_keys(r) for r in metadata.select(*LAG_METADATA).collect()]


def _root_keys(row: Row) -> FeatureKeys:
    name, doc, digits, month, month_type, lag = row
    return FeatureKeys(name, doc.lower(), month.lower(), parse_lag(lag),
                       doc_type="numeric", month_type=month_type or "int",
                       doc_digits=int(digits))


def _lag_keys(row: Row) -> FeatureKeys:
    name, doc, doc_type, month, month_type, lag = row
    return FeatureKeys(name, doc, month, parse_lag(lag), doc_type, month_type)


def resolve_keys(df: DataFrame, keys: FeatureKeys) -> FeatureKeys:
    """``keys`` with the columns as ``df`` writes them: names of control tables ignore case."""
    known = {c.lower(): c for c in df.columns}
    def name(c: str) -> str:
        return c if c in df.columns else known.get(c.lower(), c)
    return replace(keys, doc=name(keys.doc), month=name(keys.month))


def load_feature_map(spark: SparkSession, source: Mapping[str, Sequence[str]] | str
                     ) -> dict[str, list[str]]:
    """``{table: [columns]}`` from a dict, or from a file or folder that holds one JSON object."""
    if not isinstance(source, str):
        return {t: list(c) for t, c in source.items()}
    text = "\n".join(r.value for r in spark.read.text(source, wholetext=True).collect())
    return {t: list(c) for t, c in json.loads(text).items()}


def schema_of(df: DataFrame, without: Sequence[str] = ()) -> list[tuple[str, str]]:
    """Names and types of the columns, some left out."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields
            if f.name not in without]


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    """Columns of a number type, some (keys) left out."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in without]


def read_output(df: DataFrame, where: str | Column | None = None,
                columns: Sequence[str] | None = None) -> DataFrame:
    """Chosen rows and columns; both reach the scan."""
    if where is not None:
        df = df.where(F.expr(where) if isinstance(where, str) else where)
    return df.select(*columns) if columns else df


def read_partitions(df: DataFrame, month: str, months: Sequence[str | int],
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Only the listed months; on a partitioned table no other folder is opened."""
    dtype = df.schema[month].dataType
    wanted = F.col(month).isin([month_literal(m, dtype) for m in months])
    return read_output(df, wanted, columns)


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Overwrite just the partitions present in ``df``; running it twice changes nothing.

    Rows are first rebalanced by partition value: small partitions become one file each,
    a partition that holds much of the data is split over several tasks.
    """
    (df.hint("rebalance", F.col(by)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))


def replace_partitions(df: DataFrame, path: str, by: str,
                       values: Sequence[str | int] | None = None) -> None:
    """Like :func:`write_partitions`; of ``values``, those without a row lose their old partition.

    Without ``values`` that holds for all partitions of the output.  All of it happens at once, and a
    run that fails leaves the output as it was (:mod:`monthbook.sources.swap`).
    """
    swap_partitions(df, path, by, write_partitions, values)


def create_empty_table(spark: SparkSession, name: str, schema: StructType, by: str,
                       path: str | None = None) -> DataFrame:
    """A partitioned catalogue table that has columns but no rows; kept if it exists."""
    fields = [f for f in schema.fields if f.name != by] + [schema[by]]
    writer = (spark.createDataFrame([], StructType(fields)).write.mode("ignore")
              .format("parquet").partitionBy(by))
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def store(df: DataFrame, name: str, by: str, path: str | None = None,
          values: Sequence[str | int] | None = None) -> DataFrame:
    """``df`` in a partitioned catalogue table, made if it is missing; the table.

    Partitions are replaced as by :func:`replace_partitions`.  Columns that the table lacks are added,
    null in older partitions; columns of the table that ``df`` lacks become null.
    """
    spark = df.sparkSession
    create_empty_table(spark, name, df.schema, by, path)
    add_columns(spark, name, df.schema)
    mine = {c.lower() for c in df.columns}
    rows = df.select(*[(F.col(f"`{f.name}`") if f.name.lower() in mine else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in spark.table(name).schema.fields])
    replace_partitions(rows, table_location(spark, name), by, values)
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def store_by_document(df: DataFrame, name: str, doc: str, by: str, buckets: int,
                      path: str | None = None) -> DataFrame:
    """``df`` in a catalogue table by month, each month in ``buckets`` by document; the table.

    Population and feature tables that are stored with equally many buckets are joined without a
    shuffle (:data:`~monthbook.session.COLOCATED` must be set): the one shuffle is paid here, once for
    each new month.  Documents and months become text, so that all tables have keys of one type.
    Months present in ``df`` replace stored ones; new columns are added.  Rows without a document are
    spread over the writing tasks.  A document with millions of rows is one bucket, so one task: such
    tables are better stored by :func:`store`, whose joins split it.
    """
    spark = df.sparkSession
    rows = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in (doc, by)})
    if not spark.catalog.tableExists(name):
        fields = [f for f in rows.schema.fields if f.name != by] + [rows.schema[by]]
        writer = (spark.createDataFrame([], StructType(fields)).write.format("parquet")
                  .partitionBy(by).bucketBy(buckets, doc).sortBy(doc))
        (writer.option("path", path) if path else writer).saveAsTable(name)
    add_columns(spark, name, rows.schema)
    mine = {c.lower() for c in rows.columns}
    whole = rows.select(*[(F.col(f"`{f.name}`") if f.name.lower() in mine else F.lit(None))
                          .cast(f.dataType).alias(f.name)
                          for f in spark.table(name).schema.fields])
    # The hash of repartition is the hash of buckets: a task writes one file a month.
    missing = whole.where(F.col(doc).isNull()).hint("rebalance", F.col(by))
    placed = whole.where(F.col(doc).isNotNull()).repartition(buckets, doc).unionByName(missing)
    (placed.write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True))
    return spark.table(name)


def add_columns(spark: SparkSession, name: str, schema: StructType) -> list[str]:
    """Add the columns of ``schema`` that a catalogue table lacks; their names."""
    known = {c.lower() for c in spark.table(name).columns}
    new = [f for f in schema.fields if f.name.lower() not in known]
    if new:
        columns = StructType([StructField(f.name, f.dataType) for f in new]).toDDL()
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def table_location(spark: SparkSession, name: str) -> str:
    """The folder of a catalogue table."""
    facts = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'")
    return facts.first()["data_type"]


def insert_partitions(df: DataFrame, name: str, by: str) -> None:
    """Overwrite, in a catalogue table, just the partitions present in ``df``."""
    target = df.sparkSession.table(name)
    (df.select(*target.columns).hint("rebalance", F.col(by)).write
     .option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True))


def read_written(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A partitioned output with the types it was written with (months stay text).

    Partitions that were written without one of the columns have nulls there.
    """
    settle(spark, path)
    fields = [StructField(f.name, f.dataType, True) for f in schema.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def write_book(book: DataFrame, path: str) -> None:
    """One snapshot of a book, in the folder of its reference month."""
    write_partitions(book, path, "dt_referencia")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_sample(df: DataFrame, path: str, rows: int) -> None:
    """The first rows, as Parquet."""
    df.limit(rows).write.mode("overwrite").parquet(path)
