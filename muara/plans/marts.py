"""Marts and views over the forecast fact, orders and deliveries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muara.functions.clock import at, full_hours_between, hour_floor, minutes_between
from muara.functions.labels import percent, pretty_size
from muara.settings import DEFAULTS, Settings


#: Relative standard error of the sketches for approximate distinct counts.
SKETCH_ERROR = 0.05
#: Stored sketches have 2 ** SKETCH_BITS registers; their relative standard error is below STORED_ERROR.
SKETCH_BITS, STORED_ERROR = 12, 0.0164


def daily_summary(fact: DataFrame) -> DataFrame:
    """Per location and day: temperature range and average, humidity, wind, dominant description.

    Rows are first reduced per description, then per day; ties of the dominant description go to the first
    in alphabetical order. The feed has no precipitation, so that column is null.
    """
    day = F.col("waktu").cast("date").alias("summary_date")
    per_text = fact.groupBy("adm4", day, "cuaca").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("suhu_celsius").alias("lo"),
        F.max("suhu_celsius").alias("hi"),
        F.sum("suhu_celsius").alias("suhu"),
        F.count("suhu_celsius").alias("suhu_n"),
        F.sum("kelembapan").alias("lembap"),
        F.count("kelembapan").alias("lembap_n"),
        F.sum("kecepatan_angin").alias("angin"),
        F.count("kecepatan_angin").alias("angin_n"),
    )

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(name).cast("double"), F.sum(f"{name}_n"))

    described = F.when(F.col("cuaca").isNotNull(), F.struct((-F.col("n")).alias("n"), "cuaca"))
    return per_text.groupBy("adm4", "summary_date").agg(
        F.min("lo").alias("temp_min"),
        F.max("hi").alias("temp_max"),
        mean("suhu").alias("temp_avg"),
        mean("lembap").alias("humidity_avg"),
        mean("angin").alias("wind_speed_avg"),
        F.lit(None).cast("double").alias("total_precipitation"),
        F.min(described)["cuaca"].alias("weather_description"),
    )


def deliveries(lines: DataFrame, orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Delivery lines joined to their orders: driver, vehicle, day, distance, hours, on-time, incident and rating.

    Only the order's date crosses the shuffle. Spark broadcasts the orders while they are small and splits
    a skewed order at run time otherwise.
    """
    hours = full_hours_between(F.col("o_orderdate"), F.col("l_shipdate"))
    dated = orders.select("o_orderkey", "o_orderdate")
    trips = lines.join(dated, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").alias("driver_id"),
        F.col("l_partkey").alias("vehicle_id"),
        F.col("l_shipdate").cast("date").alias("delivery_date"),
        F.col("l_quantity").alias("distance_km"),
        hours.alias("hours"),
        (F.col("l_returnflag") == "R").alias("incident"),
        F.col("l_discount").alias("rating"),
    )
    return trips.withColumn("on_time", F.col("hours") <= settings.on_time_hours)


def orders_per_day(orders: DataFrame, stamp: str) -> DataFrame:
    day = F.col(stamp).cast("date").alias("kpi_date")
    return orders.groupBy(day).agg(F.count(F.lit(1)).alias("total_orders"))


def kpi_daily(orders: DataFrame, trips: DataFrame, approximate: bool = False) -> DataFrame:
    """Orders and deliveries per day, days of either side kept. The approximate form counts drivers and
    vehicles with one sketch per day."""
    delivered = _deliveries_per_day_approx(trips) if approximate else _deliveries_per_day(trips)
    return orders.join(delivered, "kpi_date", "full_outer")


def _deliveries_per_day(trips: DataFrame) -> DataFrame:
    """Exact distinct counts in one pass over the trips: each trip is two rows, one for its driver with the
    measures and one for its vehicle. They are added up per (day, kind, id) and then per day, so a hot day is
    reduced by many tasks.

    Few trips of a task share a day and an id, so a task's hash table would grow with its share of the file. Rows are
    dealt out by a hash first, in parts of a bounded size; a part with a frequent id is split, so ids meet once more.
    """

    def tagged(kind: str, key: str, measured: bool) -> Column:
        measures = {"n": F.lit(1), "km": F.col("distance_km"), "hours": F.col("hours"), "on_time": F.col("on_time")}
        kinds = {"n": "int", "km": "double", "hours": "bigint", "on_time": "boolean"}
        shown = [(v if measured else F.lit(None)).cast(kinds[k]).alias(k) for k, v in measures.items()]
        return F.struct(F.lit(kind).alias("kind"), F.col(key).cast("bigint").alias("id"), *shown)

    both = F.inline(F.array(tagged("driver", "driver_id", True), tagged("vehicle", "vehicle_id", False)))
    rows = trips.select(F.col("delivery_date").alias("kpi_date"), both)
    dealt = rows.withColumn("spread", F.xxhash64("kpi_date", "kind", "id")).hint("rebalance", "spread")
    per_id = dealt.groupBy("kpi_date", "kind", "id").agg(
        F.count("n").alias("n"),
        F.sum("km").alias("km"),
        F.sum("hours").alias("hours"),
        F.count("hours").alias("timed"),
        F.count_if("on_time").alias("on_time"),
    )
    known = F.col("id").isNotNull()
    return per_id.groupBy("kpi_date").agg(
        F.sum("n").alias("total_deliveries"),
        F.sum("km").alias("total_distance_km"),
        F.count_if((F.col("kind") == "driver") & known).alias("active_drivers"),
        F.count_if((F.col("kind") == "vehicle") & known).alias("active_vehicles"),
        F.try_divide(F.sum("hours").cast("double"), F.sum("timed")).alias("avg_delivery_time_hours"),
        percent(F.sum("on_time"), F.sum("n")).alias("on_time_delivery_rate"),
    )


def _deliveries_per_day_approx(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.col("delivery_date").alias("kpi_date")).agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        F.sum("distance_km").alias("total_distance_km"),
        F.approx_count_distinct("driver_id", SKETCH_ERROR).alias("active_drivers"),
        F.approx_count_distinct("vehicle_id", SKETCH_ERROR).alias("active_vehicles"),
        F.avg("hours").alias("avg_delivery_time_hours"),
        _percent(F.col("on_time")).alias("on_time_delivery_rate"),
    )


def kpi_sketches(trips: DataFrame) -> DataFrame:
    """What each day adds to any longer time: sums, counts, and sketches of its drivers and vehicles.

    Sketches unite without the trips, where distinct counts of days cannot be added. They are a few KB per day.
    """
    return trips.groupBy(F.col("delivery_date").alias("kpi_date")).agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        F.sum("distance_km").alias("total_distance_km"),
        F.sum("hours").alias("hours"),
        F.count("hours").alias("timed"),
        F.count_if("on_time").alias("on_time"),
        F.hll_sketch_agg(F.col("driver_id").cast("bigint"), SKETCH_BITS).alias("drivers"),
        F.hll_sketch_agg(F.col("vehicle_id").cast("bigint"), SKETCH_BITS).alias("vehicles"),
    )


def kpi_from_sketches(days: DataFrame, period: str) -> DataFrame:
    """KPIs per week, month, quarter or year from ``kpi_sketches``, distinct counts within ``STORED_ERROR``."""
    start = F.trunc("kpi_date", period).alias("period_start")
    return days.groupBy(start).agg(
        F.sum("total_deliveries").alias("total_deliveries"),
        F.sum("total_distance_km").alias("total_distance_km"),
        F.hll_sketch_estimate(F.hll_union_agg("drivers")).alias("active_drivers"),
        F.hll_sketch_estimate(F.hll_union_agg("vehicles")).alias("active_vehicles"),
        F.try_divide(F.sum("hours").cast("double"), F.sum("timed")).alias("avg_delivery_time_hours"),
        percent(F.sum("on_time"), F.sum("total_deliveries")).alias("on_time_delivery_rate"),
    )


def driver_monthly(trips: DataFrame, best_rating: float | None = None) -> DataFrame:
    """Per driver and month. The safety score is the percentage of trips without an incident; with ``best_rating`` it
    is the mean of this and the average rating in percent of the best, where there are ratings."""
    month = F.trunc("delivery_date", "month").alias("metric_month")
    safety = _percent(~F.col("incident"))
    if best_rating is not None:
        rated = F.avg("rating") * F.lit(100.0 / best_rating)
        safety = F.coalesce((safety + rated) / 2, safety)
    return trips.groupBy("driver_id", month).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("distance_km").alias("total_distance_km"),
        _percent(F.col("on_time")).alias("on_time_rate"),
        safety.alias("safety_score"),
    )


def driver_performance(trips: DataFrame) -> DataFrame:
    """Per driver over all time: trips, distance, rates, rating, first and last trip."""
    return trips.groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("distance_km").alias("total_distance_km"),
        _percent(F.col("on_time")).alias("on_time_rate"),
        _percent(~F.col("incident")).alias("safety_score"),
        F.avg("rating").alias("avg_rating"),
        F.min("delivery_date").alias("first_trip"),
        F.max("delivery_date").alias("last_trip"),
    )


def _percent(condition: Column) -> Column:
    return percent(F.count_if(condition), F.count(F.lit(1)))


def current_per_location(fact: DataFrame, as_of: datetime, tie: str) -> DataFrame:
    """The newest point of each location at the clock; equal times go to the larger ``tie``."""
    rest = [c for c in fact.columns if c not in ("adm4", tie)]
    newest = F.max_by(F.struct(*rest), F.struct("waktu", tie)).alias("p")
    return (
        fact.where(F.col("waktu") <= at(as_of))
        .groupBy("adm4")
        .agg(newest)
        .select("adm4", *[F.col(f"p.{c}").alias(c) for c in rest])
    )


def forecast_window(fact: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Points from the clock up to ``days`` later, in location and time order."""
    ahead = (F.col("waktu") >= at(as_of)) & (F.col("waktu") < at(as_of + timedelta(days=days)))
    return fact.where(ahead).orderBy("adm4", "waktu")


def status_by_location(fact: DataFrame, as_of: datetime, status: str, days: int = 7) -> DataFrame:
    """Latest point, its age in minutes and number of records per location and status."""
    return (
        fact.where(F.col("waktu") >= at(as_of - timedelta(days=days)))
        .groupBy("adm4", F.col(status).alias("status"))
        .agg(F.max("waktu").alias("latest"), F.count(F.lit(1)).alias("records"))
        .withColumn("age_minutes", minutes_between(F.col("latest"), at(as_of)))
    )


def records_per_day(fact: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    return (
        fact.where(F.col("waktu") >= at(as_of - timedelta(days=days)))
        .groupBy(F.col("waktu").cast("date").alias("d"), "adm4")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def hourly_correlation(counted: Column, measured: Column, value: str, stamp: str, rows: DataFrame) -> DataFrame:
    """Correlation over hours of a count of some rows with the mean value of others, in one pass."""
    hourly = rows.groupBy(hour_floor(F.col(stamp)).alias("h")).agg(
        F.count_if(counted).alias("n"), F.avg(F.when(measured, F.col(value))).alias("v")
    )
    both = hourly.where((F.col("n") > 0) & F.col("v").isNotNull())
    return both.agg(F.round(F.corr("n", "v"), 6).alias("r"))


def orders_by_region(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Orders and their value per region. Orders are added up per customer before any join."""
    per_customer = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")
    )
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )


def recent_orders_per_customer(customer: DataFrame, orders: DataFrame, since: datetime) -> DataFrame:
    """Every customer with the number of orders since a date, 0 included; orders are counted first."""
    counted = (
        orders.where(F.col("o_orderdate") >= at(since))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("k"))
    )
    return customer.join(counted, "c_custkey", "left").select(
        "c_custkey", F.coalesce("k", F.lit(0)).alias("n")
    )


def customers_per_nation(nation: DataFrame, customer: DataFrame) -> DataFrame:
    """A correlated count; Spark turns it into an aggregation and a left join."""
    return nation.sparkSession.sql(
        "select n_name, (select count(*) from {customer} c where c.c_nationkey = n.n_nationkey) as n"
        " from {nation} n",
        nation=nation,
        customer=customer,
    )


def location_dimension(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Location code with city and province."""
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("adm4"),
            F.col("c_name").alias("location_name"),
            F.col("r_name").alias("province"),
            F.col("n_name").alias("city_regency"),
        )
    )


def records_by_province(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """Fact joined to the location dimension, reduced per location before the join."""
    per_location = fact.groupBy("adm4").agg(
        F.count(F.lit(1)).alias("n"), F.sum("suhu_celsius").alias("suhu"), F.count("suhu_celsius").alias("suhu_n")
    )
    return (
        per_location.join(locations, "adm4", "left")
        .groupBy("province")
        .agg(
            F.count(F.lit(1)).alias("locations"),
            F.sum("n").alias("records"),
            F.try_divide(F.sum("suhu").cast("double"), F.sum("suhu_n")).alias("temp_avg"),
        )
    )


def namespace_sizes(sizes: DataFrame, namespaces: DataFrame) -> DataFrame:
    """Tables, bytes and readable size per namespace, largest first."""
    return (
        sizes.join(namespaces, "table_name")
        .groupBy("namespace")
        .agg(F.count(F.lit(1)).alias("tables"), F.sum("bytes").alias("bytes"))
        .withColumn("size", pretty_size(F.col("bytes")))
        .orderBy(F.desc("bytes"), "namespace")
    )


def namespace_totals(counts: DataFrame, namespaces: DataFrame) -> DataFrame:
    """Tables and rows per namespace."""
    return (
        counts.join(namespaces, "table_name")
        .groupBy("namespace")
        .agg(F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("total_rows"))
        .orderBy(F.desc("total_rows"), "namespace")
    )
