"""Freshness labels per row and per location, retention and expiry."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muara.functions.clock import at, minutes_between
from muara.functions.labels import freshness_label, percent
from muara.operators.loads import delete_where, update_where
from muara.settings import DEFAULTS, Settings
from muara.sources.snapshots import SnapshotTable


def refresh_row_labels(
    table: SnapshotTable, as_of: datetime, settings: Settings = DEFAULTS, day: str | None = None
) -> int:
    """Label rows created in the last days by their age; older rows keep the label they have.

    ``day`` names a column that holds the date of ``created_at``; earlier days are then not opened.
    """
    age = minutes_between(F.coalesce("last_updated", "created_at"), at(as_of))
    since = as_of - timedelta(days=settings.relabel_days)
    recent = F.col("created_at") >= at(since)
    if day:
        recent = recent & (F.col(day) >= F.lit(since.date()))
    return update_where(
        table, recent, {"data_age_minutes": age, "freshness_status": freshness_label(age, settings)}
    )


def location_freshness(
    fact: DataFrame, as_of: datetime, key: str = "adm4", stamp: str = "waktu", settings: Settings = DEFAULTS
) -> DataFrame:
    """Latest point, age and label per location."""
    latest = fact.groupBy(key).agg(F.max(stamp).alias("latest"))
    return with_age(latest, as_of, settings)


def with_age(latest: DataFrame, as_of: datetime, settings: Settings = DEFAULTS) -> DataFrame:
    age = minutes_between(F.col("latest"), at(as_of))
    return latest.withColumn("age_minutes", age).withColumn(
        "freshness_status", freshness_label(F.col("age_minutes"), settings)
    )


def freshness_report(locations: DataFrame) -> DataFrame:
    """Locations per label with their share in percent."""
    counts = locations.groupBy(F.col("freshness_status").alias("st")).agg(F.count(F.lit(1)).alias("n"))
    all_labels = Window.partitionBy()  # over at most three rows
    return counts.withColumn("percent", percent(F.col("n"), F.sum("n").over(all_labels)))


def freshness_gate(locations: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: percent of stale locations and whether a sync may start."""
    stale = percent(F.count_if(F.col("freshness_status") == "STALE"), F.count(F.lit(1)))
    return locations.agg(stale.alias("stale_percent")).withColumn(
        "open", F.coalesce(F.col("stale_percent") <= settings.stale_alert_percent, F.lit(False))
    )


def recent(rows: DataFrame, stamp: str, as_of: datetime, days: int) -> DataFrame:
    return rows.where(F.col(stamp) >= at(as_of - timedelta(days=days)))


def past_retention(as_of: datetime, settings: Settings = DEFAULTS, day: str | None = None) -> Column:
    """True for rows strictly older than the retention window; a row on the boundary stays.

    ``day`` names a column that holds the date of ``created_at``; later days are then not opened.
    """
    edge = as_of - timedelta(days=settings.retention_days)
    old = F.col("created_at") < at(edge)
    return old & (F.col(day) <= F.lit(edge.date())) if day else old


def apply_retention(
    table: SnapshotTable, as_of: datetime, settings: Settings = DEFAULTS, day: str | None = None
) -> int:
    """Delete what is past the retention window; days that lie wholly behind it are dropped, not rewritten."""
    return delete_where(table, past_retention(as_of, settings, day))


def expired_preview(fact: DataFrame, as_of: datetime, stamp: str = "waktu") -> DataFrame:
    """How many forecast points lie in the past, and their range."""
    return fact.where(F.col(stamp) < at(as_of)).agg(
        F.count(F.lit(1)).alias("n"), F.min(stamp).alias("first_ts"), F.max(stamp).alias("last_ts")
    )


def delete_expired(table: SnapshotTable, as_of: datetime, stamp: str = "waktu", day: str | None = None) -> int:
    """Delete points of the past. ``day`` names a column that holds the date of ``stamp``, as the fact's partition
    does; later days are then not opened."""
    past = F.col(stamp) < at(as_of)
    return delete_where(table, past & (F.col(day) <= F.lit(as_of.date())) if day else past)
