"""Marts that follow their sources: the same rows as a full run, from the touched dates alone."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from muara.operators import loads
from muara.plans import follow, marts
from muara.sources import snapshots

T0 = datetime(2024, 3, 1)
POINT = "adm4 string, waktu timestamp_ntz, cuaca string, suhu_celsius double, kelembapan int, kecepatan_angin double"
TRIP = "driver_id int, vehicle_id int, delivery_date date, distance_km double, hours bigint, on_time boolean, incident boolean, rating double"


def points(spark, days, n=20):
    data = [("ab"[k % 2], T0 + timedelta(days=d, hours=k), "xy"[k % 3 > 0], float(k), k, 1.0) for d in days for k in range(n)]
    frame = spark.createDataFrame(data, POINT)
    return frame.withColumn("d", F.col("waktu").cast("date"))


def trips(spark, days, n=30, shift=0):
    data = [
        (k % 7 + shift, k % 11, date(2024, 1, 1) + timedelta(days=d), float(k), k, k % 3 == 0, k % 5 == 0, None if k % 4 else 4.0)
        for d in days
        for k in range(n)
    ]
    return spark.createDataFrame(data, TRIP)


def same(mart, wanted):
    shown = [c for c in wanted.columns if c not in ("drivers", "vehicles")]
    got = sorted(mart.read().select(*shown).collect(), key=str)
    return got == sorted(wanted.select(*shown).collect(), key=str)


@pytest.fixture
def read_partitions(monkeypatch):
    """Partitions that tables list for reading."""
    listed, real = [], snapshots.SnapshotTable.read

    def read(self, state=None, values=None):
        listed.append((self.root.rsplit("/", 1)[1], values and sorted(values, key=str)))
        return real(self, state, values)

    monkeypatch.setattr(snapshots.SnapshotTable, "read", read)
    return listed


def test_only_touched_dates_are_read_and_the_mart_equals_a_full_run(spark, warehouse, read_partitions):
    fact, mart = warehouse.table("fact", "d"), warehouse.table("mart", "summary_date")
    fact.replace(points(spark, range(10)))
    assert len(follow.follow_daily_summary(mart, fact)) == 10
    read_partitions.clear()
    assert follow.follow_daily_summary(mart, fact) == [] and read_partitions == []
    fact.append(points(spark, [4, 12], 3))
    touched = [date(2024, 3, 5), date(2024, 3, 13)]
    assert follow.follow_daily_summary(mart, fact) == touched
    assert read_partitions == [("fact", touched)]
    assert same(mart, marts.daily_summary(fact.read()))
    loads.update_where(fact, F.col("waktu") == T0, {"suhu_celsius": F.lit(99.0)})
    loads.delete_where(fact, F.col("d") == date(2024, 3, 2))
    assert follow.follow_daily_summary(mart, fact) == [date(2024, 3, 1), date(2024, 3, 2)]
    assert same(mart, marts.daily_summary(fact.read())) and date(2024, 3, 2) not in mart.partition_rows(mart.state())


def test_rows_without_a_date_and_a_source_made_anew(spark, warehouse):
    fact, mart = warehouse.table("fact", "d"), warehouse.table("mart", "summary_date")
    undated = points(spark, [1], 4).withColumns({"waktu": F.lit(None).cast("timestamp_ntz"), "d": F.lit(None).cast("date")})
    fact.replace(points(spark, range(3)))
    follow.follow_daily_summary(mart, fact)
    fact.append(undated)
    assert follow.follow_daily_summary(mart, fact) == [None]
    assert same(mart, marts.daily_summary(fact.read()))
    other = warehouse.table("other", "d")
    other.replace(points(spark, [7]))
    assert follow.follow_daily_summary(mart, other) == [date(2024, 3, 8)]
    assert same(mart, marts.daily_summary(other.read()))
    other.replace(points(spark, [7]).limit(0))
    assert follow.follow_daily_summary(mart, other) == [date(2024, 3, 8)] and mart.read().isEmpty()


def test_a_version_that_is_no_longer_kept_means_a_full_run(spark, warehouse, monkeypatch):
    monkeypatch.setattr(snapshots, "COMMITS_KEPT", 2)
    fact, mart = warehouse.table("fact", "d"), warehouse.table("mart", "summary_date")
    fact.replace(points(spark, range(3)))
    follow.follow_daily_summary(mart, fact)
    for day in (5, 6, 7):
        fact.append(points(spark, [day]))
    assert len(follow.follow_daily_summary(mart, fact)) == 6
    assert same(mart, marts.daily_summary(fact.read()))


def test_a_load_during_the_computation_is_seen_the_next_time(spark, warehouse):
    fact, mart = warehouse.table("fact", "d"), warehouse.table("mart", "summary_date")
    fact.replace(points(spark, range(2)))

    def build(rows):
        if not mart.exists():
            fact.append(points(spark, [8]))
        return marts.daily_summary(rows["fact"])

    assert len(follow.follow(mart, {"fact": fact}, build)) == 2
    assert follow.follow(mart, {"fact": fact}, build) == [date(2024, 3, 9)]
    with pytest.raises(ValueError, match="date partition"):
        follow.follow(warehouse.table("plain"), {"fact": fact}, build)


@pytest.mark.parametrize("by", ["delivery_date", "delivery_month"])
def test_months_from_sketches_follow_the_days(spark, warehouse, by, read_partitions):
    stored, days = warehouse.table("trips", by), warehouse.table("days", "kpi_date" if by == "delivery_date" else "kpi_month")
    months, drivers = warehouse.table("months", "period_start"), warehouse.table("drivers", "metric_month")
    quarters = warehouse.table("quarters", "period_start")

    def bring():
        follow.follow_kpi_sketches(days, stored)
        read_partitions.clear()
        return [
            follow.follow_kpi_periods(months, days),
            follow.follow_kpi_periods(quarters, days, "quarter"),
            follow.follow_driver_monthly(drivers, stored, best_rating=5.0),
        ]

    follow.store_trips(stored, trips(spark, [1, 2, 35, 64, 95]))
    bring()
    follow.store_trips(stored, trips(spark, [36, 200], shift=100))
    february, july = date(2024, 2, 1), date(2024, 7, 1)
    assert bring() == [[february, july], [date(2024, 1, 1), july], [february, july]]
    assert {name for name, _ in read_partitions[:2]} == {"days"}, "no trip is read for a month"
    whole = stored.read()
    assert same(drivers, marts.driver_monthly(whole, 5.0))
    for mart, period in ((months, "month"), (quarters, "quarter")):
        assert same(mart, marts.kpi_from_sketches(marts.kpi_sketches(whole), period))
        exact = whole.groupBy(F.trunc("delivery_date", period).alias("p")).agg(F.count_distinct("driver_id").alias("n")).collect()
        got = {r["period_start"]: r["active_drivers"] for r in mart.read().collect()}
        assert all(abs(got[r["p"]] - r["n"]) <= 3 * marts.STORED_ERROR * r["n"] for r in exact) and len(got) == len(exact)


def test_sketches_stay_within_their_error_on_many_ids(spark):
    wide = spark.range(60_000).select(
        F.col("id").alias("driver_id"), (F.col("id") % 20_000).alias("vehicle_id"),
        F.expr("date_add(date'2024-01-01', cast(id % 90 as int))").alias("delivery_date"), F.lit(1.0).alias("distance_km"),
        F.lit(2).cast("bigint").alias("hours"), F.lit(True).alias("on_time"),
    )
    year = marts.kpi_from_sketches(marts.kpi_sketches(wide), "year").first()
    for got, true in ((year["active_drivers"], 60_000), (year["active_vehicles"], 20_000)):
        assert abs(got - true) <= 3 * marts.STORED_ERROR * true
    assert year["total_deliveries"] == 60_000 and year["on_time_delivery_rate"] == 100.0


def test_days_are_counted_in_parts_of_a_bounded_size(spark):
    """A frequent driver and trips without an id or a date are split among parts and meet again."""
    plain = [
        (None if k % 7 == 0 else 5 if k % 3 else k, k % 501 or None, None if k % 11 == 0 else date(2024, 1, 1 + k % 2), float(k % 10), None if k % 13 == 0 else k % 30, k % 4 == 0)
        for k in range(20_000)
    ]
    rows = spark.createDataFrame(plain, "driver_id int, vehicle_id int, delivery_date date, distance_km double, hours bigint, on_time boolean")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "64k")
    try:
        counted = marts._deliveries_per_day(rows.repartition(6))
        got = {r["kpi_date"]: tuple(r)[1:] for r in counted.collect()}
        plan = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(advisory, before)
    wanted = {}
    for day in {r[2] for r in plain}:
        of = [r for r in plain if r[2] == day]
        hours = [r[4] for r in of if r[4] is not None]
        ids = [len({r[i] for r in of} - {None}) for i in (0, 1)]
        wanted[day] = (len(of), sum(r[3] for r in of), *ids, sum(hours) / len(hours), round(100 * sum(r[5] for r in of) / len(of), 2))
    assert {d: tuple(round(v, 2) for v in r) for d, r in got.items()} == {d: tuple(round(v, 2) for v in r) for d, r in wanted.items()}
    partial, dealt = plan.index("partial_count"), plan.index("REBALANCE_PARTITIONS_BY_COL")
    assert partial < dealt, "rows are dealt out before the first aggregation"
