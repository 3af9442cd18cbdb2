"""Scans: Parquet tables, JDBC tables, incremental scans, and staging of intermediate results."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from muara.session import scratch_path
from muara.settings import DEFAULTS

# The tables of a test data folder.
TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


_schemas: dict[tuple[str, str], StructType] = {}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A source table. Its schema is discovered once per application, as that costs a job of its own."""
    path = f"{folder}/{name}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _schemas:
        _schemas[known] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[known]).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: object,
    upper: object,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Parallel table scan: one range of the partition column per task; filters and columns push down."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column)
        .options(lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions))
        .options(**options)
        .load()
    )


def write_jdbc(
    rows: DataFrame, url: str, table: str, batch_rows: int = DEFAULTS.jdbc_batch_rows, **options: str
) -> None:
    """Append to a database table in batches; every task writes its own partition."""
    (
        rows.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch_rows))
        .options(**options)
        .mode("append")
        .save()
    )


def high_water_mark(source: DataFrame, target: DataFrame, column: str, known: str | None = None) -> Column | None:
    """The target's largest value as a literal of the source's type; none while the target is empty.

    A mark that is ``known``, from the target's commit, spares the scan.
    """
    mark = known or target.agg(F.max(column).cast("string")).first()[0]
    return None if mark is None else F.lit(mark).cast(source.schema[column].dataType)


def incremental_scan(
    source: DataFrame, target: DataFrame, column: str, at_mark: str = "skip", known: str | None = None
) -> DataFrame:
    """Source rows past the target's high-water mark; all of them while the target is empty.

    The mark is one value, fetched as text and used as a literal, so the filter reaches Parquet and JDBC
    scans. Rows that share the mark may have come after it was reached: ``at_mark`` 'again' returns them all, for
    loads by key; 'missing' returns those that the target does not have, copies counted; 'skip' none. Rows without
    a value in ``column`` are never past a mark.
    """
    mark = high_water_mark(source, target, column, known)
    if mark is None:
        return source
    if at_mark == "again":
        return source.where(F.col(column) >= mark)
    past = source.where(F.col(column) > mark)
    if at_mark == "skip":
        return past
    here = source.where(F.col(column) == mark).exceptAll(
        target.select(*source.columns).where(F.col(column) == mark)
    )
    return past.unionByName(here)


def stage(rows: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write rows to the shared folder and read them back: computed once, and safe when executors are lost.

    The files stay until the shared folder is cleaned; use ``staged`` or a ``scratch`` block where they are needed only
    for a while.
    """
    spark = rows.sparkSession
    path = path or scratch_path(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def staged(rows: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stage`` for the length of a block; nothing lazy may leave the block."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    try:
        yield stage(rows, label, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def table_row_counts(tables: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """One row per table; each count reads no column and all counts run as one job."""
    counted = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables
    ]
    return union_all(counted)


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    """Concatenate record lists by column name."""
    parts = list(parts)
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
