"""Hour and day tables from one stream: day windows are made of finished hour windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from muara.functions.clock import from_instant, to_instant
from muara.settings import DEFAULTS, Settings
from muara.sources.snapshots import SnapshotTable
from muara.sources.tables import staged
from muara.streaming.jobs import EVENT_TIME, start
from muara.streaming.silence import TICK

#: Partition of both tables.
DAY = "d"


def _measures(value: str) -> list[Column]:
    return [
        F.sum("records").alias("records"),
        F.sum(value).alias("total"),
        F.count(value).alias("measured"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    ]


def _merged() -> list[Column]:
    return [
        F.sum("records").alias("records"),
        F.sum("total").alias("total"),
        F.sum("measured").alias("measured"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    ]


def hour_and_day(rows: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Hour windows of ``EVENT_TIME`` per key, and day windows of the hour windows. ``records`` is 1 for a row."""
    hours = rows.groupBy(F.window(EVENT_TIME, "1 hour"), key).agg(*_measures(value))
    days = hours.groupBy(F.window(F.window_time("window"), "1 day"), key).agg(*_merged())
    return hours, days


def _shaped(windows: DataFrame, grain: str, key: str) -> DataFrame:
    start_at = from_instant(F.col("window.start"))
    mean = F.try_divide(F.col("total"), F.col("measured"))
    return windows.where("records > 0").select(
        F.lit(grain).alias("grain"), start_at.alias("starts"), key, "records", mean.alias("mean"), "low", "high",
        start_at.cast("date").alias(DAY),
    )


def batch_rollups(rows: DataFrame, key: str, stamp: str, value: str) -> DataFrame:
    """What the stream's two tables hold once all windows have ended, by ``grain``."""
    stamped = rows.select(key, value, F.lit(1).alias("records"), to_instant(F.col(stamp)).alias(EVENT_TIME))
    hours, days = hour_and_day(stamped, key, value)
    return _shaped(hours, "hour", key).unionByName(_shaped(days, "day", key))


def rollup_stream(
    rows: DataFrame,
    ticks: DataFrame,
    key: str,
    stamp: str,
    value: str,
    hours: SnapshotTable,
    days: SnapshotTable,
    checkpoint: str,
    name: str = "rollup",
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Append each hour and each day of a key once, when the watermark has passed its end.

    The watermark stands ``retention_days`` behind the newest point or heartbeat; so a heartbeat that late flushes
    the last windows of a feed that has ended. Points behind the watermark are dropped, points without a time too.
    Each table remembers the last micro-batch it took; both are partitioned by ``DAY``. Hour windows are kept twice
    in the state, once for either output, as a stream's operators have one reader each.
    """
    kind = rows.schema[key].dataType
    points = rows.select(key, F.col(value).cast("double").alias(value), F.lit(1).alias("records"), to_instant(F.col(stamp)).alias(EVENT_TIME))
    beats = ticks.select(
        F.lit(None).cast(kind).alias(key), F.lit(None).cast("double").alias(value), F.lit(0).alias("records"),
        to_instant(F.col(TICK)).alias(EVENT_TIME),
    )
    marked = points.unionByName(beats).where(f"{EVENT_TIME} is not null").withWatermark(EVENT_TIME, f"{settings.retention_days} days")
    hourly, daily = hour_and_day(marked, key, value)
    both = _shaped(hourly, "hour", key).unionByName(_shaped(daily, "day", key))

    def apply(batch: DataFrame, batch_id: int) -> None:
        with staged(batch, "windows") as ended:
            for table, grain in ((hours, "hour"), (days, "day")):
                part = ended.where(F.col("grain") == grain).drop("grain")
                table.create_if_absent(part.schema)
                table.append(part, stream=(name, batch_id))

    return start(both.writeStream.outputMode("append").foreachBatch(apply), checkpoint)
