"""The hourly feed as Structured Streaming: upsert ingest, dedup, daily counts, staleness.

``max_files`` bounds a micro-batch; without it one run takes all that has landed. For state that outgrows
executor memory set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from datetime import datetime
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from muara.functions.clock import from_instant, to_instant
from muara.operators.freshness import with_age
from muara.operators.loads import upsert
from muara.plans.ingest import IngestOptions, ingest_documents
from muara.settings import DEFAULTS, Settings
from muara.sources.documents import document_columns, numbered
from muara.sources.snapshots import SnapshotTable

EVENT_TIME = "event_time"


def ingest_stream(
    spark: SparkSession,
    landing: str,
    table: SnapshotTable,
    checkpoint: str,
    clock: Callable[[int], datetime],
    name: str = "ingest",
    locations: DataFrame | None = None,
    options: IngestOptions = IngestOptions(),
    quarantine: SnapshotTable | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch of landed documents; the table remembers the last batch it applied."""
    source = spark.readStream.format("text")
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)

    def apply(batch: DataFrame, batch_id: int) -> None:
        ingest_documents(
            table,
            numbered(batch),
            clock(batch_id),
            locations,
            options,
            quarantine,
            stream=(name, batch_id),
        )

    return start(document_columns(source.load(landing)).writeStream.foreachBatch(apply), checkpoint)


def table_stream(spark: SparkSession, folder: str, schema, max_files: int | None = None) -> DataFrame:
    source = spark.readStream.schema(schema)
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)
    return source.parquet(folder)


def dedup_stream(
    rows: DataFrame,
    keys: list[str],
    stamp: str,
    out: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Drop repeats of a key that arrive within the retention window; older rows are late and dropped.

    One stateful step holds each key once. ``late_rows`` tells how many rows came too late.
    """
    counted(rows.sparkSession)
    unique = (
        rows.withColumn(EVENT_TIME, to_instant(F.col(stamp)))
        .withWatermark(EVENT_TIME, f"{settings.retention_days} days")
        .dropDuplicatesWithinWatermark(keys)
        .drop(EVENT_TIME)
    )
    return start(unique.writeStream.format("parquet").option("path", out), checkpoint)


def daily_counts_stream(
    rows: DataFrame,
    key: str,
    stamp: str,
    table: SnapshotTable,
    checkpoint: str,
    name: str = "daily_counts",
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Rows per day and key. Only windows that changed in a micro-batch are sent on and merged.

    With a table partitioned by ``d`` a micro-batch rewrites the days it touches.
    """
    counts = (
        rows.withColumn(EVENT_TIME, to_instant(F.col(stamp)))
        .withWatermark(EVENT_TIME, f"{settings.retention_days} days")
        .groupBy(F.window(EVENT_TIME, "1 day"), key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(from_instant(F.col("window.start")).cast("date").alias("d"), key, "n")
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.create_if_absent(batch.schema)
        upsert(table, batch.withColumn("seq", F.lit(batch_id)), ["d", key], "seq", stream=(name, batch_id), partition_follows=True)

    return start(counts.writeStream.outputMode("update").foreachBatch(apply), checkpoint)


def staleness_stream(
    rows: DataFrame,
    key: str,
    stamp: str,
    table: SnapshotTable,
    checkpoint: str,
    clock: Callable[[int], datetime],
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Latest point and label of every location, silent ones included: one row per location is kept."""
    latest = rows.groupBy(key).agg(F.max(to_instant(F.col(stamp))).alias("latest"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        wall = batch.withColumn("latest", from_instant(F.col("latest")))
        table.replace(with_age(wall, clock(batch_id), settings))

    return start(latest.writeStream.outputMode("complete").foreachBatch(apply), checkpoint)


class LateCounter(StreamingQueryListener):
    """Adds up, per run, the rows that stateful operators dropped behind the watermark, batch by batch."""

    def __init__(self) -> None:
        self.late: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        dropped = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.late[str(event.progress.runId)] += dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


_counters: WeakKeyDictionary[SparkSession, LateCounter] = WeakKeyDictionary()


def counted(spark: SparkSession) -> LateCounter:
    """The session's counter, listening from the first call on."""
    if spark not in _counters:
        _counters[spark] = LateCounter()
        spark.streams.addListener(_counters[spark])
    return _counters[spark]


def start(writer, checkpoint: str) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(spark: SparkSession, query: StreamingQuery) -> int:
    """Rows that a finished run dropped because they were older than the watermark, over all its micro-batches.

    An aggregation counts them after its first, partial step. The run must have been started after ``counted``, as
    ``dedup_stream`` does; ``late.kept_and_late_stream`` keeps the rows themselves.
    """
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    return counted(spark).late[str(query.runId)]


def finish(query: StreamingQuery, timeout_seconds: float | None = None) -> None:
    """Wait until all available input is processed, or at most so long; errors of the query are raised here."""
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout_seconds} s")
