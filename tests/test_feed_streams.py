"""Silence alerts, hour and day rollups, and late rows: restarts, repeats, empty inputs and many micro-batches."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from muara.session import scratch_path
from muara.settings import Settings
from muara.streaming import jobs, late, rollups, silence

T0 = datetime(2026, 1, 30, 12)
POINT = "adm4 string, waktu timestamp_ntz, v double"


def minutes(n):
    return T0 + timedelta(minutes=n)


class Feed:
    """A landing folder of points and one of heartbeats, with runs of one query over both."""

    def __init__(self, spark, warehouse):
        self.spark, self.points, self.ticks, self.checkpoint = spark, *(scratch_path(spark, n) for n in ("points", "ticks", "cp"))
        self.labels, self.alerts = warehouse.table("labels"), warehouse.table("alerts", silence.SILENT_SINCE)
        self.hours, self.days = warehouse.table("hours", rollups.DAY), warehouse.table("days", rollups.DAY)
        self.land()

    def land(self, *rows):
        self.spark.createDataFrame([(*r, 1.0)[:3] for r in rows], POINT).coalesce(1).write.mode("append").parquet(self.points)

    def beat(self, n):
        silence.beat(self.spark, self.ticks, minutes(n))

    def sources(self):
        return jobs.table_stream(self.spark, self.points, POINT), silence.heartbeats(self.spark, self.ticks)

    def watch(self):
        jobs.finish(silence.silence_stream(*self.sources(), "adm4", "waktu", self.labels, self.alerts, self.checkpoint))
        return sorted((r["adm4"], r["latest"], r["alerted_at"]) for r in self.alerts.read().collect()) if self.alerts.exists() else None

    def roll(self):
        day = Settings(retention_days=1)
        jobs.finish(rollups.rollup_stream(*self.sources(), "adm4", "waktu", "v", self.hours, self.days, self.checkpoint, settings=day))
        return [sorted((tuple(r)[:-1] for r in t.read().collect()), key=str) if t.exists() else [] for t in (self.hours, self.days)]


def test_a_silent_location_alerts_without_any_row_and_after_a_restart(spark, warehouse):
    feed = Feed(spark, warehouse)
    feed.land(("a", T0), ("b", minutes(100)), (None, T0), ("c", None))
    feed.beat(0)
    assert feed.watch() == []
    feed.beat(180)
    assert feed.watch() == []
    feed.beat(181)
    assert feed.watch() == [("a", T0, minutes(181))]
    feed.beat(200)
    assert feed.watch() == [("a", T0, minutes(181))], "one alert for one silence"
    assert {r["adm4"]: r["freshness_status"] for r in feed.labels.read().collect()} == {"a": "STALE", "b": "WARNING"}


def test_a_location_that_returns_may_fall_silent_again(spark, warehouse):
    feed = Feed(spark, warehouse)
    feed.land(("a", T0))
    feed.beat(300)
    feed.watch()
    feed.land(("a", minutes(310)), ("a", minutes(-50)))
    feed.beat(320)
    assert feed.watch() == [("a", T0, minutes(300))]
    feed.beat(600)
    assert feed.watch() == [("a", T0, minutes(300)), ("a", minutes(310), minutes(600))]


def test_without_a_heartbeat_nothing_is_said(spark, warehouse):
    feed = Feed(spark, warehouse)
    spark.range(0).select(F.lit(None).cast("timestamp_ntz").alias(silence.TICK)).write.parquet(feed.ticks)
    feed.land(("a", T0))
    assert feed.watch() is None and not feed.labels.exists()


def test_rollups_equal_their_batch_twins_and_survive_restarts(spark, warehouse):
    feed, landed = Feed(spark, warehouse), []
    feed.beat(-10_000)
    for lot in range(4):
        rows = [("ab"[k % 2], minutes(lot * 700 + 37 * k), None if k % 5 == 0 else float(k)) for k in range(40)]
        rows += [(None, minutes(lot * 700), 2.0), ("a", minutes(lot * 700), None)]
        feed.land(*rows)
        landed += rows
        before = feed.roll()
    assert feed.roll() == before, "a run without input adds nothing"
    wanted = rollups.batch_rollups(spark.createDataFrame(landed, POINT), "adm4", "waktu", "v")
    ended = max(w for _, w, _ in landed) - timedelta(days=1)
    for grain, got, length in zip(("hour", "day"), before, (timedelta(hours=1), timedelta(days=1)), strict=True):
        rows = {tuple(r)[1:-1] for r in wanted.where(F.col("grain") == grain).collect()}
        assert set(got) == {r for r in rows if r[0] + length <= ended} and len(got) == len(set(got))
    feed.beat(100_000)
    for grain, got in zip(("hour", "day"), feed.roll(), strict=True):
        assert Counter(got) == Counter(tuple(r)[1:-1] for r in wanted.where(F.col("grain") == grain).collect())


@pytest.fixture
def few_progress_entries(spark):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    yield
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_late_rows_are_counted_over_more_batches_than_are_remembered(spark, few_progress_entries):
    path, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    schema = "id int, ts timestamp_ntz"
    for lot in range(12):
        stamp = T0 if lot == 0 else T0 - timedelta(days=60)
        spark.createDataFrame([(lot, stamp)], schema).coalesce(1).write.mode("append").parquet(path)
    run = jobs.dedup_stream(jobs.table_stream(spark, path, schema, max_files=1), ["id"], "ts", out, checkpoint)
    jobs.finish(run)
    kept = spark.read.schema(schema).parquet(out).count()
    assert len(run.recentProgress) <= 3 and kept < 9
    assert jobs.late_rows(spark, run) + kept == 12


def test_kept_late_and_repeated_rows_are_all_landed_rows(spark, warehouse):
    path, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "cp")
    kept, side = warehouse.table("kept", late.DAY), warehouse.table("late")
    schema, landed = "id int, part string, ts timestamp_ntz, v string", []

    def run(max_files):
        source = jobs.table_stream(spark, path, schema, max_files)
        jobs.finish(late.kept_and_late_stream(source, ["id", "part"], "ts", kept, side, checkpoint, settings=Settings(retention_days=2)))

    def land(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        landed.extend(rows)

    for lot in range(10):
        day = T0 + timedelta(days=lot)
        land((lot, "x", day, "new"), (lot, "x", day + timedelta(hours=1), "copy"), (lot - 1, "x", day, "again"), (lot, None, None, "no stamp"))
    land(*[(0, "x", T0 + timedelta(days=9, hours=2), "forgotten")] * 300)
    land((5, "y", T0, "late"), (5, "y", T0, "late"), (None, None, T0 + timedelta(days=9), "null key"))
    run(3)
    run(None)
    land((None, None, T0 + timedelta(days=10), "null key again"))
    run(None)
    told = late.balance(kept, side)
    assert sum(told.values()) == len(landed)
    assert told == {"kept": kept.read().count(), "late": side.read().count(), "repeats": told["repeats"]}
    assert {r["v"] for r in side.read().collect()} == {"late"} and told["late"] == 2
    ids = Counter((r["id"], r["part"]) for r in kept.read().collect())
    assert ids == Counter({**{(k, "x"): 1 for k in range(-1, 10)}, **{(k, None): 1 for k in range(10)}, (0, "x"): 2, (None, None): 1})
