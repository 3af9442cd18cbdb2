"""The manifest loop: tables are loaded side by side, and one bad table does not stop the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muara.functions.clock import at
from muara.functions.labels import percent
from muara.operators.loads import (
    aligned,
    append_load,
    full_refresh,
    refresh_keep_if_empty,
    upsert,
    with_created_at,
)
from muara.schemas import SYNC_RESULT, spark_type
from muara.sources.manifests import SyncTask, one_namespace
from muara.sources.snapshots import Warehouse
from muara.sources.tables import incremental_scan


class SyncFailed(RuntimeError):
    """At least one table of a sync run failed."""


def message_of(error: Exception) -> str:
    """The whole message; the kind of error where it has none."""
    return str(error) or type(error).__name__


def sync_table(warehouse: Warehouse, source: DataFrame, task: SyncTask) -> int:
    """Load one table in its mode; returns the rows written."""
    table = warehouse.table(task.target, task.partition_by)
    if task.mode == "full":
        return full_refresh(table, source)
    table.create_if_absent(source.schema)
    if task.mode == "keep_if_empty":
        return refresh_keep_if_empty(table, source)
    if task.mode == "append":
        return append_load(table, source)
    if task.mode == "incremental":
        base = table.state()
        known = base["marks"].get(task.column)
        fresh = incremental_scan(source, table.read(base), task.column, "again" if task.keys else "missing", known)
        # The load itself tells the next mark, so that no run scans the target for it.
        seen = Observation()
        fresh = fresh.observe(seen, F.max(task.column).cast("string").alias("newest"))
        marks = {task.column: lambda written: seen.get["newest"] or known}
        if not task.keys:
            return table.append(fresh, base=base, marks=marks)
        rows = fresh.withColumn("seq", F.col(task.column))
        upsert(table, rows, task.keys, "seq", partition_follows=task.partition_follows, marks=marks)
        return table.state()["rows_written"]
    raise ValueError(f"unknown mode {task.mode!r}")


def run_sync(
    warehouse: Warehouse,
    read_source: Callable[[str], DataFrame],
    tasks: Iterable[SyncTask],
    parallel_tables: int = 4,
) -> DataFrame:
    """Run all tasks and return one result row per table. Each thread only submits Spark jobs."""
    tasks = one_namespace(tasks)

    def run(task: SyncTask) -> tuple:
        try:
            rows = sync_table(warehouse, read_source(task.source), task)
            return (task.source, task.target, task.mode, "success", rows, None)
        except Exception as error:  # the failed table is reported, the others go on
            return (task.source, task.target, task.mode, "failed", 0, message_of(error))

    with ThreadPoolExecutor(parallel_tables) as pool:
        results = list(pool.map(run, tasks))
    return warehouse.spark.createDataFrame(results, SYNC_RESULT)


def clone_structures(warehouse: Warehouse, schemas: dict[str, T.StructType]) -> DataFrame:
    """Create the tables that are absent; one row per table: created, skipped or error."""

    def create(item: tuple[str, T.StructType]) -> tuple[str, str]:
        name, schema = item
        try:
            return name, "created" if warehouse.table(name).create_if_absent(schema) else "skipped"
        except Exception as error:  # the failed table is reported, the others go on
            return name, f"error: {message_of(error)}"

    results = [create(item) for item in schemas.items()]
    return warehouse.spark.createDataFrame(results, "table_name string, status string")


def schema_from_catalog(columns: DataFrame) -> dict[str, T.StructType]:
    """Spark schemas from catalog rows (see ``catalog.column_profile``): one row per column is collected."""
    schemas: dict[str, T.StructType] = {}
    for row in columns.orderBy("table_name", "ordinal").collect():
        kind = spark_type(row["data_type"], row["char_len"], row["num_precision"], row["num_scale"])
        kind = T.StringType() if isinstance(kind, (T.VarcharType, T.CharType)) else kind
        schema = schemas.setdefault(row["table_name"], T.StructType())
        schema.add(row["column_name"], kind)
    return schemas


def on_demand_sync(
    warehouse: Warehouse,
    read_source: Callable[[str], DataFrame],
    tasks: Iterable[SyncTask],
    as_of: datetime,
) -> DataFrame:
    """Clone each structure with a load stamp, then refresh by name; an empty source changes nothing."""
    tasks = one_namespace(tasks)

    def stamped(name: str) -> DataFrame:
        return with_created_at(read_source(name), at(as_of))

    targets = {task.source: task for task in tasks}

    def prepared(name: str) -> DataFrame:
        """Inside the guarded loop, so a source that is missing fails its own table only."""
        rows, task = stamped(name), targets[name]
        table = warehouse.table(task.target, task.partition_by)
        table.create_if_absent(rows.schema)
        return aligned(rows, table.read())

    return run_sync(warehouse, prepared, tasks)


def sync_summary(results: DataFrame, names_shown: int = 10) -> DataFrame:
    """Tables, rows and the first table names per status; ``results`` itself is the complete list."""
    names = F.slice(F.array_sort(F.collect_list("target")), 1, names_shown)
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("row_count").alias("total_rows"),
        F.array_join(names, ",").alias("first_tables"),
    )


def sync_metrics(results: DataFrame) -> DataFrame:
    """One row of run metrics for the alert rules."""
    good = F.count_if(F.col("status") == "success")
    return results.agg(
        percent(good, F.count(F.lit(1))).alias("success_pct"),
        good.alias("table_count"),
        F.count_if(F.col("status") == "failed").alias("failures"),
    )


def require_success(results: DataFrame) -> None:
    """Raise when any table failed, so the scheduler sees a red run."""
    failed = [r["target"] for r in results.where("status = 'failed'").select("target").collect()]
    if failed:
        raise SyncFailed(f"failed tables: {', '.join(sorted(failed))}")
