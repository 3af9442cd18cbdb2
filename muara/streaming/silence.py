"""Alerts for locations that fall silent.

A stream without input runs no micro-batch, so a feed that stops would never be found stale. Heartbeats are a second
input of the same query: a small row with the time, landed by whoever schedules the runs (``beat``), or Spark's
``rate`` source for a query that runs on. They move the clock on when no other row comes.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from muara.functions.clock import at, from_instant, to_instant
from muara.operators.freshness import with_age
from muara.operators.loads import insert_ignore
from muara.settings import DEFAULTS, Settings
from muara.sources.snapshots import SnapshotTable
from muara.sources.tables import staged
from muara.streaming.jobs import start

TICK = "tick"
#: Alerts are partitioned by the date of a location's last row, which follows from their key.
SILENT_SINCE = "silent_since"


def beat(spark: SparkSession, folder: str, now: datetime) -> None:
    """Land one heartbeat."""
    spark.range(1).select(at(now).alias(TICK)).coalesce(1).write.mode("append").parquet(folder)


def heartbeats(spark: SparkSession, folder: str) -> DataFrame:
    """Landed heartbeats as a stream."""
    return spark.readStream.schema(f"{TICK} timestamp_ntz").parquet(folder)


def silence_stream(
    rows: DataFrame,
    ticks: DataFrame,
    key: str,
    stamp: str,
    labels: SnapshotTable,
    alerts: SnapshotTable,
    checkpoint: str,
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Label every location at each heartbeat, and alert once for each silence that has become too long.

    ``labels`` holds location, latest point, age and label at the newest heartbeat. ``alerts`` gets a row for a
    location and the last point before its silence, with the heartbeat that found it; more heartbeats or a repeated
    micro-batch add nothing, a new point and a new silence do. Heartbeats that waited together count as the last of
    them. Rows without a location or a time are left out. The state has one row per location and one for the clock;
    ``alerts`` is a table partitioned by ``SILENT_SINCE``.
    """
    kind = rows.schema[key].dataType
    points = rows.where(F.col(key).isNotNull()).select(F.col(key), to_instant(F.col(stamp)).alias("moment"), F.lit(False).alias("clock"))
    beats = ticks.select(F.lit(None).cast(kind).alias(key), to_instant(F.col(TICK)).alias("moment"), F.lit(True).alias("clock"))
    latest = points.unionByName(beats).where("moment is not null").groupBy("clock", key).agg(F.max("moment").alias("moment"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        with staged(batch.withColumn("latest", from_instant(F.col("moment"))), "silence") as seen:
            now = seen.where("clock").agg(F.max("latest")).first()[0]
            if now is None:
                return
            labelled = with_age(seen.where("not clock").select(key, "latest"), now, settings)
            silent = labelled.where("freshness_status = 'STALE'").select(
                key,
                "latest",
                "age_minutes",
                at(now).alias("alerted_at"),
                F.col("latest").cast("date").alias(SILENT_SINCE),
                F.lit(batch_id).alias("seq"),
            )
            alerts.create_if_absent(silent.drop("seq").schema)
            insert_ignore(alerts, silent, [key, "latest"], "seq", partition_follows=True)
            labels.replace(labelled)

    return start(latest.writeStream.outputMode("complete").foreachBatch(apply), checkpoint)
