"""Every operator as a query on the test tables.

Stand-ins: events plays the forecast fact (user is the location, type the description, value the
temperature, props.k the humidity), orders and lineitem play orders and deliveries.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muara.functions.clock import at, hour_floor, iso_text, local_time, minutes_between, wall_clock
from muara.functions.labels import decode_weather_code, pretty_size, table_class
from muara.operators import discovery, freshness, loads, quality
from muara.operators.asof import asof_join
from muara.operators.content import content_differences
from muara.operators.drift import field_drift
from muara.operators.envelope import envelope_headers, envelope_records, json_envelopes
from muara.operators.forecast import parse_documents, rejected_documents, valid_points
from muara.plans import follow, marts
from muara.plans.console import console_envelopes, console_records, select_locations
from muara.plans.ingest import CREATED, FACT_KEYS, PARTITION, IngestOptions, fact_table, hourly_run, ingest_documents, ingest_landed
from muara.plans.sync import (
    clone_structures,
    on_demand_sync,
    run_sync,
    schema_from_catalog,
    sync_metrics,
    sync_summary as summarise,
)
from muara.session import scratch_path
from muara.settings import DEFAULTS, Settings
from muara.sources import catalog
from muara.sources.catalog import Key
from muara.sources.documents import read_documents, render_documents
from muara.sources.ledger import FileLedger
from muara.sources.manifests import SyncTask
from muara.sources.snapshots import SnapshotTable, Warehouse
from muara.sources.tables import (
    TABLES,
    incremental_scan as scan_past_mark,
    read_table,
    table_row_counts as count_rows,
    union_all,
)
from muara.streaming import jobs, late, rollups, silence

AS_OF = datetime(2024, 1, 31)
NEXT_RUN = datetime(2024, 1, 31, 1)
RETENTION_AS_OF = datetime(2024, 2, 15)
EXPIRY_AS_OF = datetime(2024, 1, 10)
MID_MONTH = datetime(2024, 1, 20)
FIRST_TYPES = ("click", "view")

KEYS = (
    Key("region", "PRIMARY KEY", ("r_regionkey",)),
    Key("nation", "PRIMARY KEY", ("n_nationkey",)),
    Key("nation", "UNIQUE", ("n_name",)),
    Key("customer", "PRIMARY KEY", ("c_custkey",)),
    Key("supplier", "PRIMARY KEY", ("s_suppkey",)),
    Key("part", "PRIMARY KEY", ("p_partkey",)),
    Key("orders", "PRIMARY KEY", ("o_orderkey",)),
    Key("lineitem", "PRIMARY KEY", ("l_orderkey", "l_linenumber")),
    Key("events", "PRIMARY KEY", ("event_id",)),
    Key("events", "UNIQUE", ("user_id", "ts")),
    Key("documents", "PRIMARY KEY", ("doc_id",)),
    Key("pages", "PRIMARY KEY", ("page_id",)),
    Key("conversations", "PRIMARY KEY", ("conv_id", "turn")),
    Key("nation", "FOREIGN KEY", ("n_regionkey",), "region.r_regionkey"),
    Key("customer", "FOREIGN KEY", ("c_nationkey",), "nation.n_nationkey"),
    Key("orders", "FOREIGN KEY", ("o_custkey",), "customer.c_custkey"),
    Key("lineitem", "FOREIGN KEY", ("l_orderkey",), "orders.o_orderkey"),
    Key("lineitem", "FOREIGN KEY", ("l_suppkey",), "supplier.s_suppkey"),
    Key("labels", "FOREIGN KEY", ("doc_id",), "documents.doc_id"),
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(rows: DataFrame, **places: int) -> DataFrame:
    """Results whose last digits depend on the order of a floating-point sum, rounded for comparison only."""
    return rows.withColumns({c: F.round(c, n) for c, n in places.items()})


# ---------------------------------------------------------------- stand-ins


def humidity() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def forecast_fact(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("adm4"),
        F.col("ts").alias("waktu"),
        F.col("event_type").alias("cuaca"),
        F.col("value").alias("suhu_celsius"),
        humidity().alias("kelembapan"),
        (humidity() / F.lit(10.0)).alias("kecepatan_angin"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("last_updated"),
    )


def hourly_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Fact rows keyed by location and hour, stamped with the event's own time, in event order."""
    fact = forecast_fact(spark, folder).withColumn("waktu", hour_floor(F.col("waktu")))
    return fact.withColumn(PARTITION, F.col("waktu").cast("date")).select(
        "adm4", "waktu", "cuaca", "suhu_celsius", "created_at", "last_updated", PARTITION,
        F.col("event_id").alias("seq"),
    )


def first_load() -> F.Column:
    return F.col("cuaca").isin(*FIRST_TYPES)


def stored_fact(spark: SparkSession, folder: str) -> SnapshotTable:
    """The whole fact in a date-partitioned table, labelled STALE by an earlier run."""
    table = new_table(spark, "fact", PARTITION)
    rows = forecast_fact(spark, folder).withColumns(
        {
            "data_age_minutes": F.lit(None).cast("double"),
            "freshness_status": F.lit("STALE"),
            PARTITION: F.col("waktu").cast("date"),
        }
    )
    table.replace(rows)
    return table


def fact_by_created(spark: SparkSession, folder: str) -> SnapshotTable:
    """The stored fact in the other layout, a folder for each date of creation."""
    table, rows = new_table(spark, "fact", CREATED), stored_fact(spark, folder).read().drop(PARTITION)
    table.replace(rows.withColumn(CREATED, F.col("created_at").cast("date")))
    return table


def new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def new_table(spark: SparkSession, name: str, partition_by: str | None = None) -> SnapshotTable:
    return new_warehouse(spark).table(name, partition_by)


def all_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name) for name in TABLES}


def feed_points(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the feed's item fields."""
    return read_table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").alias("wall"),
        F.col("ts").cast("date").alias("run"),
        iso_text(F.col("ts"), "+07:00").alias("datetime"),
        F.col("value").alias("t"),
        humidity().cast("string").alias("hu"),
        F.col("event_type").alias("weather_desc"),
        (humidity() / F.lit(10.0)).alias("ws"),
        F.lit("E").alias("wd"),
    )


def feed_header() -> F.Column:
    user = F.col("user_id").cast("string")
    return F.struct(
        user.alias("adm4"),
        F.concat(F.lit("Kota "), user).alias("kotkab"),
        F.concat(F.lit("Kec "), user).alias("kecamatan"),
        F.concat(F.lit("Desa "), user).alias("desa"),
        F.lit("Prov").alias("provinsi"),
    )


def landed(documents: DataFrame) -> DataFrame:
    """Documents written as text lines and read back."""
    path = scratch_path(documents.sparkSession, "landing")
    documents.select("doc").write.text(path)
    return read_documents(documents.sparkSession, path)


def land_in_order(documents: DataFrame, landing: str) -> None:
    """Add documents to a landing folder so that file and line order follow the event order."""
    documents.orderBy("run", "user_id").select("doc").write.mode("append").text(landing)


# ---------------------------------------------------------------- loads


@query
def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier")
    table = new_table(spark, "supplier")
    table.replace(supplier.union(supplier))
    loads.full_refresh(table, supplier)
    return table.read()


@query
def refresh_keep_if_empty(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    table = new_table(spark, "orders")
    loads.refresh_keep_if_empty(table, orders)
    loads.refresh_keep_if_empty(table, orders.where("o_orderkey is null"))
    return table.read()


@query
def append_load(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    table = new_table(spark, "customer")
    table.create_if_absent(customer.schema)
    loads.append_load(table, customer)
    loads.append_load(table, customer)
    return table.read()


@query
def load_by_name(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    table = new_table(spark, "part")
    target = part.select("p_name", "p_partkey", "p_retailprice").withColumn("note", F.lit(None).cast("string"))
    table.create_if_absent(loads.with_created_at(target, at(AS_OF)).schema)
    rows = loads.with_created_at(part.select("p_partkey", "p_retailprice", "p_name"), at(AS_OF))
    table.append(loads.aligned(rows, table.read()))
    return table.read()


@query
def upsert_forecast(spark: SparkSession, folder: str) -> DataFrame:
    rows = hourly_rows(spark, folder)
    table = new_table(spark, "fact", PARTITION)
    table.create_if_absent(rows.drop("seq").schema)
    for batch in (rows.where(first_load()), rows.where(~first_load())):
        loads.upsert(table, batch, FACT_KEYS, "seq", first_kept=["created_at"], partition_follows=True)
    return table.read().drop(PARTITION)


@query
def insert_ignore(spark: SparkSession, folder: str) -> DataFrame:
    rows = hourly_rows(spark, folder).drop("created_at", "last_updated")
    table = new_table(spark, "fact", PARTITION)
    table.create_if_absent(rows.drop("seq").schema)
    for batch in (rows.where(first_load()), rows.where(~first_load())):
        loads.insert_ignore(table, batch, FACT_KEYS, "seq", partition_follows=True)
    return table.read().drop(PARTITION)


@query
def upsert_counters(spark: SparkSession, folder: str) -> DataFrame:
    rows = hourly_rows(spark, folder)
    return loads.upsert_counters(rows.where(first_load()), rows.where(~first_load()), FACT_KEYS)


@query
def dedup_exact(spark: SparkSession, folder: str) -> DataFrame:
    return loads.dedup_exact(read_table(spark, folder, "events").select("user_id", "event_type"))


@query
def retention_keep(spark: SparkSession, folder: str) -> DataFrame:
    table = stored_fact(spark, folder)
    freshness.apply_retention(table, RETENTION_AS_OF)
    return table.read().select("event_id", F.col("created_at").alias("ts"))


@query
def retention_by_created(spark: SparkSession, folder: str) -> DataFrame:
    """Days behind the window are dropped, one is rewritten, the others are not opened."""
    table = fact_by_created(spark, folder)
    freshness.apply_retention(table, RETENTION_AS_OF, day=CREATED)
    return table.read().select("event_id", F.col("created_at").alias("ts"))


@query
def retention_deleted(spark: SparkSession, folder: str) -> DataFrame:
    doomed = freshness.past_retention(RETENTION_AS_OF)
    return forecast_fact(spark, folder).where(doomed).agg(F.count(F.lit(1)).alias("deleted"))


@query
def expired_preview(spark: SparkSession, folder: str) -> DataFrame:
    return freshness.expired_preview(forecast_fact(spark, folder), EXPIRY_AS_OF)


@query
def expired_delete(spark: SparkSession, folder: str) -> DataFrame:
    table = stored_fact(spark, folder)
    freshness.delete_expired(table, EXPIRY_AS_OF, day=PARTITION)
    return table.read().select("event_id", "waktu")


@query
def update_null_partition(spark: SparkSession, folder: str) -> DataFrame:
    """Update, delete and upsert over a table in which signups have no date, so lie in the null partition."""
    rows = read_table(spark, folder, "events").select(
        "event_id", "event_type", "value", F.when(F.col("event_type") != "signup", F.col("ts").cast("date")).alias("day")
    )
    table = new_table(spark, "events", "day")
    table.replace(rows)
    loads.update_where(table, F.col("event_id") % 5 == 0, {"value": F.lit(0.0)})
    loads.delete_where(table, F.col("event_id") % 7 == 0)
    again = rows.where(F.col("event_id") % 11 == 0).withColumn("value", F.lit(-1.0))
    loads.upsert(table, again.withColumn("seq", F.col("event_id")), ["event_id"], "seq")
    return table.read()


@query
def archive_two_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables share an archive; the first is then made anew and archived once more."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    warehouse = new_warehouse(spark)
    archive = warehouse.table("archive")
    for name, status in (("final", "F"), ("open", "O"), ("rest", "P")):
        table = warehouse.table(name)
        table.replace(orders.where(F.col("o_orderstatus") == status))
        loads.archive_by_year(table, archive, "o_orderdate", 1997)
    left = [warehouse.table(n).read().withColumn("place", F.lit(n)) for n in ("final", "open", "rest")]
    return union_all([archive.read().withColumn("place", F.lit("archive")), *left]).select("o_orderkey", "place")


@query
def archive_by_year(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    warehouse = new_warehouse(spark)
    table, archive = warehouse.table("orders"), warehouse.table("orders_archive")
    table.replace(orders)
    loads.archive_by_year(table, archive, "o_orderdate", 1997)
    both = union_all(
        [
            table.read().withColumn("place", F.lit("kept")),
            archive.read().withColumn("place", F.lit("archive")),
        ]
    )
    return both.select("o_orderkey", F.year("o_orderdate").alias("y"), "place")


@query
def incremental_scan(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_id", "ts", "value")
    return scan_past_mark(events, events.where(F.col("ts") < at(MID_MONTH)), "ts")


@query
def incremental_sync(spark: SparkSession, folder: str) -> DataFrame:
    """Two incremental runs: the table up to mid-month, then whatever is past its mark."""
    events = read_table(spark, folder, "events").select("event_id", "ts", "value")
    warehouse = new_warehouse(spark)
    task = SyncTask("events", "events", "incremental", "ts")
    run_sync(warehouse, lambda name: events.where(F.col("ts") < at(MID_MONTH)), [task])
    run_sync(warehouse, lambda name: events, [task])
    return warehouse.table("events").read()


@query
def incremental_equal_mark(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that share the high-water mark arrive after it was reached, with and without a key."""
    events = read_table(spark, folder, "events").select("event_id", "ts", "value")
    early = events.where(F.col("ts") < at(MID_MONTH))
    latest = F.col("ts") == F.lit(early.agg(F.max("ts")).first()[0])
    late = early.where(latest).withColumn("event_id", F.col("event_id") + 1_000_000_000)
    warehouse = new_warehouse(spark)
    tasks = [
        SyncTask("events", "plain", "incremental", "ts"),
        SyncTask("events", "keyed", "incremental", "ts", ("event_id",)),
    ]
    run_sync(warehouse, lambda name: early, tasks)
    run_sync(warehouse, lambda name: events.unionByName(late), tasks)
    return union_all(warehouse.table(n).read().withColumn("target", F.lit(n)) for n in ("plain", "keyed"))


@query
def partitioned_sync(spark: SparkSession, folder: str) -> DataFrame:
    """A keyed incremental sync of a table partitioned by date: the second run changes the last days only."""
    events = read_table(spark, folder, "events").select("event_id", "ts", "value", F.col("ts").cast("date").alias("day"))
    warehouse = new_warehouse(spark)
    task = SyncTask("events", "events", "incremental", "ts", ("event_id",), partition_by="day")
    run_sync(warehouse, lambda name: events.where(F.col("ts") < at(AS_OF)), [task])
    run_sync(warehouse, lambda name: events.withColumn("value", F.col("value") + 1), [task])
    return warehouse.table("events", "day").read()


@query
def moved_partition(spark: SparkSession, folder: str) -> DataFrame:
    """A keyed incremental sync by the day of a row's last change: every third row is changed after the first run, so
    it leaves the day it was in; every tenth of these has no day any more."""
    events = read_table(spark, folder, "events").select("event_id", "value", F.col("ts").alias("updated_at"))
    first = events.withColumn("day", F.col("updated_at").cast("date"))
    changed = F.col("event_id") % 3 == 0
    later = F.when(changed, at(RETENTION_AS_OF) + F.expr("make_dt_interval(event_id % 5, 0, 0, 0)")).otherwise(F.col("updated_at"))
    second = events.withColumn("updated_at", later).withColumns(
        {
            "day": F.when(~(changed & (F.col("event_id") % 10 == 0)), F.col("updated_at").cast("date")),
            "value": F.when(changed, F.col("value") + 1).otherwise(F.col("value")),
        }
    )
    warehouse = new_warehouse(spark)
    task = SyncTask("events", "events", "incremental", "updated_at", ("event_id",), partition_by="day")
    for source in (first, second):
        run_sync(warehouse, lambda name: source, [task])
    return warehouse.table("events", "day").read()


# ---------------------------------------------------------------- parsing


@query
def parse_forecast(spark: SparkSession, folder: str) -> DataFrame:
    documents = render_documents(feed_points(spark, folder), ["user_id", "run"], "event_id", feed_header())
    return valid_points(parse_documents(landed(documents), mode="wallclock")).drop("seq")


@query
def parse_forecast_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Errors come as groups that are no lists, beside the good groups of their days; one document is malformed, one
    has no data. Good points and rejected parts are counted per location."""
    points = feed_points(spark, folder)
    good = points.where("event_type <> 'error'")
    documents = render_documents(good, ["user_id", "run"], "event_id", feed_header())
    bad = points.where("event_type = 'error'").groupBy("user_id", "run").agg(F.count(F.lit(1)).alias("bad"))
    groups = F.concat(F.lit('"cuaca":['), F.repeat(F.lit('"notalist",'), F.col("bad")))
    header = F.to_json(F.struct(feed_header().alias("lokasi")))
    alone = F.concat(F.expr("substring(header, 1, length(header) - 1)"), F.lit(',"data":[{'), groups, F.lit("[]]}]}"))
    dirty = (
        documents.join(bad, ["user_id", "run"], "full_outer")
        .withColumn("header", header)
        .select(
            F.when(F.col("doc").isNull(), alone)
            .when(F.col("bad").isNull(), F.col("doc"))
            .otherwise(F.regexp_replace("doc", F.lit('^(.*?)"cuaca":\\['), F.concat(F.lit("$1"), groups)))
            .alias("doc")
        )
    )
    odd = spark.createDataFrame([('{"lokasi": {"adm4": "1"}',), ('{"lokasi": {"adm4": "1"}}',)], "doc string")
    lines = landed(dirty.union(odd))
    kept = valid_points(parse_documents(lines, mode="wallclock")).groupBy("adm4").agg(F.count(F.lit(1)).alias("n"))
    rejects = rejected_documents(lines).where("reason = 'group_not_a_list'")
    code = F.get_json_object("doc", "$.lokasi.adm4").alias("adm4")
    rejected = rejects.groupBy(code).agg(F.count(F.lit(1)).alias("rejected"))
    return kept.join(rejected, "adm4", "full_outer").select(
        "adm4", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("rejected", F.lit(0)).alias("rejected")
    )


@query
def location_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a header take the configured names of the location they were asked for."""
    header = F.when(F.col("event_type") != "view", feed_header())
    documents = render_documents(
        feed_points(spark, folder), ["user_id", "run", "event_type"], "event_id", header
    ).select(
        "doc",
        F.col("user_id").cast("string").alias("requested_adm4"),
        F.struct("run", "user_id", "event_type").alias("doc_seq"),
    )
    adm4 = F.col("user_id").cast("string")
    empty = F.lit("")
    locations = (
        read_table(spark, folder, "events")
        .select("user_id")
        .distinct()
        .select(
            adm4.alias("adm4"),
            F.concat(F.lit("Lokasi "), adm4).alias("location_name"),
            empty.alias("desa"),
            empty.alias("kecamatan"),
            empty.alias("kabupaten"),
            empty.alias("provinsi"),
        )
    )
    points = valid_points(parse_documents(documents, locations, mode="wallclock"))
    return points.groupBy("adm4", "lokasi", "desa").agg(F.count(F.lit(1)).alias("n"))


@query
def tz_convert(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return read_table(spark, folder, "events").select(
        "event_id",
        local_time(iso_text(ts, "Z"), DEFAULTS.zone).alias("waktu_wib"),
        wall_clock(iso_text(ts, "+07:00")).alias("waktu_wallclock"),
    )


@query
def reject_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Low humidities arrive as text that is no number, one type arrives without a stamp."""
    points = feed_points(spark, folder)
    points = points.withColumns(
        {
            "hu": F.when(F.col("hu").cast("int") < 10, "bad").otherwise(F.col("hu")),
            "datetime": F.when(F.col("event_type") == "signup", "").otherwise(F.col("datetime")),
        }
    )
    documents = render_documents(points, ["user_id", "run"], "event_id", feed_header())
    parsed = parse_documents(landed(documents), mode="wallclock")
    reasons = F.array_join("reject_reasons", "+")
    status = F.when(reasons == "", "valid").otherwise(reasons)
    return parsed.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query
def feed_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Landing runs from mid-month on lack the wind direction and bring gusts; humidities are numbers, errors' ones flags;
    signups have no description."""
    points = feed_points(spark, folder).withColumn("run", F.trunc("run", "week"))
    kind, later = F.col("event_type"), F.col("run") >= F.lit(MID_MONTH.date())
    items = {
        "datetime": F.to_json(F.struct("datetime")),
        "t": F.to_json(F.struct("t")),
        "hu": F.when(kind == "error", '{"hu":true}').otherwise(F.concat(F.lit('{"hu":'), F.coalesce("hu", F.lit("null")), F.lit("}"))),
        "weather_desc": F.when(kind != "signup", F.to_json(F.struct("weather_desc"))),
        "ws": F.to_json(F.struct("ws")),
        "wd": F.when(~later, '{"wd":"E"}'),
        "gust": F.when(later, '{"gust":{"max":1.5}}'),
    }
    inside = [F.regexp_extract(v, r"^\{(.*)\}$", 1) for v in items.values()]
    item = F.concat(F.lit("{"), F.concat_ws(",", *inside), F.lit("}"))
    header = F.to_json(F.struct(feed_header().alias("lokasi")))
    body = F.concat(F.expr("substring(header, 1, length(header) - 1)"), F.lit(',"data":[{"cuaca":["odd",['), F.col("item"), F.lit("]]}]}"))
    documents = points.withColumns({"item": item, "header": header}).select("run", body.alias("doc"))
    return field_drift(documents, "run").select(F.col("run").cast("date").alias("run"), "field", "status", "kinds", "n")


@query
def decode_codes(spark: SparkSession, folder: str) -> DataFrame:
    codes = read_table(spark, folder, "events").select(humidity().alias("k"))
    return decode_weather_code(codes, "k").groupBy("cuaca").agg(F.count(F.lit(1)).alias("n"))


@query
def json_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes per location, read back and counted; signups come without a location."""
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    events = events.withColumn("user_id", F.when(F.col("event_type") != "signup", F.col("user_id")))
    envelopes = json_envelopes(events, "user_id", AS_OF, "spark")
    records = envelope_records(envelopes, "event_id bigint, user_id bigint, value double")
    counted = records.groupBy(F.col("user_id").alias("key")).agg(F.max("event_id").alias("last_event"))
    headers = envelope_headers(envelopes, "user_id")
    return headers.join(counted, F.col("user_id").eqNullSafe(F.col("key"))).select(
        F.col("user_id").alias("adm4"), "records_count", "last_event", "status"
    )


# ---------------------------------------------------------------- filters, checks, joins


@query
def validate_records(spark: SparkSession, folder: str) -> DataFrame:
    limits = Settings(temperature_range=(0.5, 200.0), humidity_range=(0.0, 90.0))
    fact = forecast_fact(spark, folder).withColumn("lokasi", F.col("cuaca"))
    return quality.rule_counts(fact, quality.record_rules(limits))


@query
def recent_window(spark: SparkSession, folder: str) -> DataFrame:
    return freshness.recent(read_table(spark, folder, "events").select("event_id", "ts"), "ts", AS_OF, 7)


@query
def location_select(spark: SparkSession, folder: str) -> DataFrame:
    """Locations asked for with their records, and the codes that nobody configured."""
    code = F.col("user_id").cast("string").alias("adm4")
    events = read_table(spark, folder, "events").select(code)
    chosen, unknown = select_locations(events.distinct(), ["1", "5", "9999"])
    counted = events.join(chosen, "adm4", "left_semi").groupBy("adm4").agg(F.count(F.lit(1)).alias("records"))
    return counted.select("adm4", F.lit(True).alias("known"), "records").unionByName(
        unknown.select("adm4", F.lit(False).alias("known"), F.lit(0).cast("bigint").alias("records"))
    )


@query
def classify_tables(spark: SparkSession, folder: str) -> DataFrame:
    counts = count_rows(all_tables(spark, folder).items())
    business = ("%item%", "order%", "customer", "supplier", "part", "nation", "region")
    label = table_class(F.col("table_name"), business, "Business Data", "Other Data")
    return counts.select("table_name", label.alias("data_type"), "row_count")


@query
def orders_by_region(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, nation, region = (
        read_table(spark, folder, name) for name in ("orders", "customer", "nation", "region")
    )
    return rounded(marts.orders_by_region(orders, customer, nation, region), total=4)


@query
def left_join_recent_orders(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders = (read_table(spark, folder, name) for name in ("customer", "orders"))
    return marts.recent_orders_per_customer(customer, orders, datetime(2001, 6, 1))


@query
def scalar_subquery_counts(spark: SparkSession, folder: str) -> DataFrame:
    nation, customer = (read_table(spark, folder, name) for name in ("nation", "customer"))
    return marts.customers_per_nation(nation, customer)


@query
def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    return loads.dedup_keep_first(
        lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    )


@query
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def changed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Source customers against a target whose names in one segment are null and balances below 0 are 0."""
    source = read_table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    target = read_table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("c_name"),
        F.greatest("c_acctbal", F.lit(0.0)).alias("c_acctbal"),
    )
    return quality.changed_rows(source, target)


@query
def orphan_check(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose customer is not among those with a positive balance."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    parents = read_table(spark, folder, "customer").where("c_acctbal > 0")
    return quality.orphans(orders, parents, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query
def foreign_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Every declared foreign key with its number of orphans."""
    tables = all_tables(spark, folder)
    checks = []
    for key in KEYS:
        if key.kind == "FOREIGN KEY":
            parent, column = key.references.split(".")
            lost = quality.orphans(tables[key.table], tables[parent], key.columns[0], column)
            checks.append(
                lost.agg(F.count(F.lit(1)).alias("orphans")).select(
                    F.lit(f"{key.table}.{key.columns[0]}").alias("child"),
                    F.lit(key.references).alias("parent"),
                    "orphans",
                )
            )
    return union_all(checks)


@query
def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A target that lost one order status, one equal table, and one table only the source has."""
    orders, nation, events = (read_table(spark, folder, name) for name in ("orders", "nation", "events"))
    source = [("orders", orders), ("nation", nation), ("events", events)]
    target = [("orders", orders.where("o_orderstatus <> 'F'")), ("nation", nation)]
    return quality.reconcile_counts(source, target)


@query
def reconcile_schema(spark: SparkSession, folder: str) -> DataFrame:
    """A target with one column dropped, one retyped, one added, and one whose negatives became null."""
    customer = read_table(spark, folder, "customer")
    target = customer.drop("c_mktsegment").withColumns(
        {
            "c_custkey": F.col("c_custkey").cast("string"),
            "c_acctbal": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
            "loaded_by": F.lit("sync"),
        }
    )
    return quality.reconcile_schema(
        catalog.column_profile([("customer", customer)]), catalog.column_profile([("customer", target)])
    )


@query
def group_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per table group after a copy of every table."""
    tables = all_tables(spark, folder)
    groups = {
        "master": ("region", "nation", "customer", "supplier", "part"),
        "operational": ("orders", "lineitem"),
        "log": ("events",),
    }
    warehouse = new_warehouse(spark)
    run_sync(warehouse, tables.__getitem__, [SyncTask(n, n) for names in groups.values() for n in names])
    return quality.group_checks(
        {
            group: quality.reconcile_counts(
                [(n, tables[n]) for n in names], [(n, warehouse.table(n).read()) for n in names]
            )
            for group, names in groups.items()
        }
    )


@query
def group_validation_pinned(spark: SparkSession, folder: str) -> DataFrame:
    """The same counts, though every table is loaded again between two of them: all are those of one moment."""
    tables = all_tables(spark, folder)
    groups = {
        "master": ("region", "nation", "customer", "supplier", "part"),
        "operational": ("orders", "lineitem"),
        "log": ("events",),
    }
    warehouse = new_warehouse(spark)
    names = [n for members in groups.values() for n in members]
    run_sync(warehouse, tables.__getitem__, [SyncTask(n, n) for n in names])
    pinned = warehouse.pinned(names)
    checks = {}
    for group, members in groups.items():
        checks[group] = quality.reconcile_counts([(n, tables[n]) for n in members], [(n, pinned.read(n)) for n in members])
        run_sync(warehouse, tables.__getitem__, [SyncTask(n, n, "append") for n in names])
    return quality.group_checks(checks)


@query
def content_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Orders against a copy in which one is lost, one is dearer, one is there twice and one has no status."""
    orders = read_table(spark, folder, "orders")
    key = F.col("o_orderkey")
    changed = orders.where(key != 7).withColumns(
        {
            "o_totalprice": F.when(key == 33, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "o_orderstatus": F.when(key != 100, F.col("o_orderstatus")),
        }
    )
    found = content_differences(orders, changed.unionByName(orders.where(key == 65)), ["o_orderkey"])
    return found.select("o_orderkey", "o_orderstatus", "o_totalprice", "side", "copies")


PLAIN_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _plain_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name) for name in PLAIN_TABLES}


@query
def discovered_keys(spark: SparkSession, folder: str) -> DataFrame:
    return discovery.discovered_keys(spark, _plain_tables(spark, folder))


@query
def foreign_key_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return discovery.foreign_key_candidates(spark, _plain_tables(spark, folder))


@query
def asof_trip_weather(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    errors = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    purchases = events.where("event_type = 'purchase'")
    matched = asof_join(errors, purchases, "user_id", "ts", "ts", ["event_id", "value"], "event_id")
    return matched.select(
        "event_id", F.col("right_event_id").alias("prev_id"), F.col("right_value").alias("value")
    )


@query
def asof_null_times(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a time on either side match nothing."""
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    errors = events.where("event_type = 'error'").select(
        "event_id", "user_id", F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts")
    )
    purchases = events.where("event_type = 'purchase'").withColumn("ts", F.when(F.col("event_id") % 5 != 0, F.col("ts")))
    matched = asof_join(errors, purchases, "user_id", "ts", "ts", ["event_id"], "event_id")
    return matched.select("event_id", F.col("right_event_id").alias("prev_id"))


@query
def hourly_correlation(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    events = read_table(spark, folder, "events")
    return marts.hourly_correlation(kind == "error", kind == "purchase", "value", "ts", events)


# ---------------------------------------------------------------- freshness and marts


@query
def verify_fact(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verify_fact(forecast_fact(spark, folder))


@query
def freshness_row(spark: SparkSession, folder: str) -> DataFrame:
    table = stored_fact(spark, folder)
    freshness.refresh_row_labels(table, AS_OF)
    return table.read().select("event_id", "data_age_minutes", "freshness_status")


@query
def freshness_row_by_created(spark: SparkSession, folder: str) -> DataFrame:
    table = fact_by_created(spark, folder)
    freshness.refresh_row_labels(table, AS_OF, day=CREATED)
    return table.read().select("event_id", "data_age_minutes", "freshness_status")


@query
def freshness_location(spark: SparkSession, folder: str) -> DataFrame:
    return freshness.location_freshness(forecast_fact(spark, folder), AS_OF)


@query
def freshness_report(spark: SparkSession, folder: str) -> DataFrame:
    return freshness.freshness_report(freshness_location(spark, folder))


@query
def freshness_gate(spark: SparkSession, folder: str) -> DataFrame:
    return freshness.freshness_gate(freshness_location(spark, folder))


@query
def status_by_location_7d(spark: SparkSession, folder: str) -> DataFrame:
    return marts.status_by_location(forecast_fact(spark, folder), AS_OF, "cuaca")


@query
def daily_records_30d(spark: SparkSession, folder: str) -> DataFrame:
    return marts.records_per_day(forecast_fact(spark, folder), AS_OF)


@query
def daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(marts.daily_summary(forecast_fact(spark, folder)), temp_avg=10, humidity_avg=10, wind_speed_avg=10)


def _trips(spark: SparkSession, folder: str) -> DataFrame:
    return marts.deliveries(read_table(spark, folder, "lineitem"), read_table(spark, folder, "orders"))


@query
def kpi_daily(spark: SparkSession, folder: str) -> DataFrame:
    orders = marts.orders_per_day(read_table(spark, folder, "orders"), "o_orderdate")
    return rounded(marts.kpi_daily(orders, _trips(spark, folder)), total_distance_km=4)


@query
def kpi_daily_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each day's sketches lie within three times their stated error of the exact counts."""
    orders = marts.orders_per_day(read_table(spark, folder, "orders"), "o_orderdate")
    trips = _trips(spark, folder)
    exact = marts.kpi_daily(orders, trips).select("kpi_date", "active_drivers", "active_vehicles")
    sketched = marts.kpi_daily(orders, trips, approximate=True)

    def near(column: str) -> F.Column:
        off = F.abs(F.col(f"a.{column}") - F.col(f"e.{column}"))
        return F.coalesce(off <= F.ceil(3 * marts.SKETCH_ERROR * F.col(f"e.{column}")), F.col(f"a.{column}").isNull())

    same_day = F.col("a.kpi_date").eqNullSafe(F.col("e.kpi_date"))
    return sketched.alias("a").join(exact.alias("e"), same_day).select(
        "a.kpi_date", "total_deliveries", near("active_drivers").alias("drivers_near"), near("active_vehicles").alias("vehicles_near")
    )


@query
def driver_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(marts.driver_monthly(_trips(spark, folder)), total_distance_km=4)


@query
def driver_performance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(marts.driver_performance(_trips(spark, folder)), total_distance_km=4, avg_rating=10)


@query
def driver_monthly_rated(spark: SparkSession, folder: str) -> DataFrame:
    """The safety score from incidents and ratings; discounts, of at most a tenth, play the ratings."""
    return rounded(marts.driver_monthly(_trips(spark, folder), best_rating=0.1), total_distance_km=4, safety_score=8)


# ---------------------------------------------------------------- marts that follow their sources


@query
def daily_summary_followed(spark: SparkSession, folder: str) -> DataFrame:
    """The fact grows and loses rows in three loads; after each, the mart computes the changed dates again."""
    rows = forecast_fact(spark, folder).withColumn(PARTITION, F.col("waktu").cast("date"))
    warehouse = new_warehouse(spark)
    fact, mart = warehouse.table("fact", PARTITION), warehouse.table("summary", "summary_date")
    fact.replace(rows.where(F.col("waktu") < at(MID_MONTH)))
    follow.follow_daily_summary(mart, fact)
    fact.append(rows.where(F.col("waktu") >= at(MID_MONTH)))
    follow.follow_daily_summary(mart, fact)
    loads.delete_where(fact, (F.hour("waktu") < 6) & (F.col("waktu") < at(EXPIRY_AS_OF)))
    follow.follow_daily_summary(mart, fact)
    return rounded(mart.read(), temp_avg=10, humidity_avg=10, wind_speed_avg=10)


def _followed_trips(spark: SparkSession, folder: str, name: str, partition: str, bring) -> DataFrame:
    """A mart of trips that are stored by month in two lots and brought up to date after each."""
    warehouse, trips = new_warehouse(spark), _trips(spark, folder)
    stored, mart = warehouse.table("trips", "delivery_month"), warehouse.table(name, partition)
    for lot in (trips.where(~F.col("incident")), trips.where("incident")):
        follow.store_trips(stored, lot)
        bring(warehouse, mart, stored)
    return mart.read()


@query
def kpi_daily_followed(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").withColumn("order_month", F.trunc("o_orderdate", "month"))

    def bring(warehouse: Warehouse, mart: SnapshotTable, stored: SnapshotTable) -> None:
        table = warehouse.table("orders", "order_month")
        if not table.exists():
            table.replace(orders)
        follow.follow_kpi_daily(mart, table, stored, "o_orderdate")

    return rounded(_followed_trips(spark, folder, "kpi", "kpi_month", bring).drop("kpi_month"), total_distance_km=4)


@query
def driver_monthly_followed(spark: SparkSession, folder: str) -> DataFrame:
    bring = lambda _, mart, stored: follow.follow_driver_monthly(mart, stored)
    return rounded(_followed_trips(spark, folder, "drivers", "metric_month", bring), total_distance_km=4)


def _near_exact(spark: SparkSession, folder: str, period: str) -> DataFrame:
    """KPIs of a period from stored sketches: exact sums, and whether distinct counts are within three errors."""

    def bring(warehouse: Warehouse, mart: SnapshotTable, stored: SnapshotTable) -> None:
        days = warehouse.table("days", "kpi_month")
        follow.follow_kpi_sketches(days, stored)
        follow.follow_kpi_periods(mart, days, period)

    found = _followed_trips(spark, folder, period, "period_start", bring)
    start = F.trunc("delivery_date", period).alias("period_start")
    exact = _trips(spark, folder).groupBy(start).agg(
        F.count_distinct("driver_id").alias("drivers"), F.count_distinct("vehicle_id").alias("vehicles")
    )

    def near(estimate: str, truth: str) -> F.Column:
        return F.abs(F.col(estimate) - F.col(truth)) <= F.ceil(3 * marts.STORED_ERROR * F.col(truth))

    both = found.withColumnRenamed("period_start", "p").join(exact, F.col("p").eqNullSafe(F.col("period_start")))
    shown = both.select(
        "period_start", "total_deliveries", "total_distance_km", "avg_delivery_time_hours", "on_time_delivery_rate",
        near("active_drivers", "drivers").alias("drivers_near"), near("active_vehicles", "vehicles").alias("vehicles_near"),
    )
    return rounded(shown, total_distance_km=4)


@query
def kpi_months_sketched(spark: SparkSession, folder: str) -> DataFrame:
    return _near_exact(spark, folder, "month")


@query
def kpi_years_sketched(spark: SparkSession, folder: str) -> DataFrame:
    return _near_exact(spark, folder, "year")


@query
def alert_rules(spark: SparkSession, folder: str) -> DataFrame:
    fact = forecast_fact(spark, folder)
    age = minutes_between(F.col("latest"), at(AS_OF))
    metrics = quality.feed_metrics(fact, age > DEFAULTS.warning_minutes, hour_floor(F.col("waktu")))
    return quality.evaluate_alerts(metrics, quality.standard_rules())


@query
def current_per_location(spark: SparkSession, folder: str) -> DataFrame:
    fact = forecast_fact(spark, folder).select("event_id", "adm4", "waktu", "cuaca", "suhu_celsius")
    return marts.current_per_location(fact, MID_MONTH, "event_id")


@query
def forecast_7d(spark: SparkSession, folder: str) -> DataFrame:
    return marts.forecast_window(forecast_fact(spark, folder).select("adm4", "waktu", "cuaca"), MID_MONTH)


@query
def union_locations(spark: SparkSession, folder: str) -> DataFrame:
    """Record lists of five kinds put together again, each with its columns in another order."""
    events = read_table(spark, folder, "events")
    kinds = ("click", "view", "purchase", "signup")
    lists = [events.where(F.col("event_type") == kind).select("user_id", "event_id") for kind in kinds]
    rest = events.where(~F.col("event_type").isin(*kinds)).select("event_id", "user_id")
    return union_all([rest, *lists])


@query
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return read_table(spark, folder, "events").select(
        "event_id",
        F.hour(ts).alias("h"),
        F.year(ts).alias("y"),
        ts.cast("date").alias("d"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("s"),
    )


# ---------------------------------------------------------------- catalog and sync


@query
def table_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_rows(all_tables(spark, folder).items())


@query
def warehouse_totals(spark: SparkSession, folder: str) -> DataFrame:
    return table_row_counts(spark, folder).agg(
        F.count(F.lit(1)).alias("total_tables"), F.sum("row_count").alias("total_records")
    )


@query
def top_tables(spark: SparkSession, folder: str) -> DataFrame:
    return table_row_counts(spark, folder).orderBy(F.desc("row_count"), "table_name").limit(10)


@query
def missing_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Expected names that are absent or empty."""
    expected = spark.createDataFrame([("orders",), ("rating",), ("stok",)], "t string")
    present = table_row_counts(spark, folder).where("row_count > 0").select(F.col("table_name").alias("t"))
    return quality.missing_tables(expected, present)


@query
def table_count_check(spark: SparkSession, folder: str) -> DataFrame:
    present = table_row_counts(spark, folder).where("row_count > 0")
    return quality.expected_table_count(present, expected=16)


@query
def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.numbered_tables(table_row_counts(spark, folder))


@query
def catalog_columns(spark: SparkSession, folder: str) -> DataFrame:
    profile = catalog.column_profile(all_tables(spark, folder).items())
    return profile.select("table_name", "column_name", F.col("ordinal").alias("pos"), "nullable", "non_null")


@query
def key_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.key_candidates(all_tables(spark, folder), KEYS)


@query
def clone_ddl(spark: SparkSession, folder: str) -> DataFrame:
    profile = catalog.column_profile(all_tables(spark, folder).items())
    return catalog.clone_ddl(profile, catalog.key_rows(spark, KEYS))


@query
def table_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """File bytes, readable size and rows of every table, largest first."""
    sizes = catalog.table_sizes(spark, {name: f"{folder}/{name}.parquet" for name in TABLES})
    return sizes.join(table_row_counts(spark, folder), "table_name").orderBy(F.desc("bytes"), "table_name")


@query
def namespace_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes per namespace, largest first."""
    return marts.namespace_sizes(table_sizes(spark, folder), _namespaces(spark))


@query
def size_text(spark: SparkSession, folder: str) -> DataFrame:
    """Readable sizes of whole numbers over many powers, made from order keys."""
    size = F.col("o_orderkey") * F.pow(F.lit(10), F.col("o_orderkey") % 10).cast("bigint")
    return read_table(spark, folder, "orders").select("o_orderkey", size.alias("bytes"), pretty_size(size).alias("size"))


def _copy_all(spark: SparkSession, folder: str, extra: list[SyncTask]) -> tuple[Warehouse, DataFrame]:
    renamed = {"orders": "sales_orders"}
    tasks = [SyncTask(name, renamed.get(name, name)) for name in TABLES]
    warehouse = new_warehouse(spark)
    results = run_sync(warehouse, lambda name: read_table(spark, folder, name), tasks + extra)
    return warehouse, results


@query
def sync_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every table copied under its manifest name, counted in the warehouse."""
    warehouse, _ = _copy_all(spark, folder, [])
    return count_rows((name, warehouse.table(name).read()) for name in warehouse.table_names())


@query
def sync_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A run with one table that does not exist."""
    _, results = _copy_all(spark, folder, [SyncTask("rating", "rating")])
    return summarise(results)


@query
def sync_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alert rules over the metrics of a run of three tables and one that does not exist."""
    tasks = [SyncTask(name, name) for name in ("customer", "supplier", "part", "rating")]
    results = run_sync(new_warehouse(spark), lambda name: read_table(spark, folder, name), tasks)
    return quality.evaluate_alerts(sync_metrics(results), quality.sync_rules())


@query
def clone_structure(spark: SparkSession, folder: str) -> DataFrame:
    """Tables created from measured catalog rows, then every source loaded into them by name."""
    tables = all_tables(spark, folder)
    warehouse = new_warehouse(spark)
    warehouse.table("nation").replace(tables["nation"])
    schemas = schema_from_catalog(catalog.column_profile(tables.items()))
    made = clone_structures(warehouse, schemas)
    tasks = [SyncTask(name, name) for name in TABLES]
    run_sync(warehouse, lambda name: loads.aligned(tables[name], warehouse.table(name).read()), tasks)
    return made.join(count_rows((n, warehouse.table(n).read()) for n in TABLES), "table_name")


@query
def on_demand_copy(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables, one renamed, refreshed on demand with a load stamp; the second run finds no orders."""
    warehouse = new_warehouse(spark)
    tasks = [
        SyncTask("orders", "sales_orders", "keep_if_empty"),
        SyncTask("supplier", "supplier", "keep_if_empty"),
    ]
    on_demand_sync(warehouse, lambda name: read_table(spark, folder, name), tasks, AS_OF)

    def without_orders(name: str) -> DataFrame:
        rows = read_table(spark, folder, name)
        return rows.where("o_orderkey is null") if name == "orders" else rows

    on_demand_sync(warehouse, without_orders, tasks, NEXT_RUN)
    return union_all(
        warehouse.table(name)
        .read()
        .groupBy("created_at")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("table_name", F.lit(name))
        for name in ("sales_orders", "supplier")
    )


@query
def on_demand_missing_source(spark: SparkSession, folder: str) -> DataFrame:
    """One source does not exist; the other table is still copied."""
    tasks = [SyncTask("rating", "rating", "keep_if_empty"), SyncTask("supplier", "supplier", "keep_if_empty")]
    results = on_demand_sync(new_warehouse(spark), lambda name: read_table(spark, folder, name), tasks, AS_OF)
    return results.select("target", "status", "row_count")


@query
def namespace_totals(spark: SparkSession, folder: str) -> DataFrame:
    return marts.namespace_totals(table_row_counts(spark, folder), _namespaces(spark))


def _namespaces(spark: SparkSession) -> DataFrame:
    homes = {"events": "weather", "documents": "analytics", "pages": "analytics"}
    rows = [(name, homes.get(name, "public")) for name in TABLES]
    return spark.createDataFrame(rows, "table_name string, namespace string")


@query
def records_by_province(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation, region = (read_table(spark, folder, n) for n in ("customer", "nation", "region"))
    dimension = marts.location_dimension(customer, nation, region)
    return rounded(marts.records_by_province(forecast_fact(spark, folder), dimension), temp_avg=10)


@query
def console_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Every location's documents through the console form, counted from its envelopes."""
    documents = render_documents(
        feed_points(spark, folder), ["user_id", "run"], "event_id", feed_header()
    ).select(
        "doc",
        F.col("user_id").cast("string").alias("requested_adm4"),
        F.struct("run", "user_id").alias("doc_seq"),
    )
    code = F.col("user_id").cast("string").alias("adm4")
    blank = [F.lit("").alias(c) for c in ("location_name", "desa", "kecamatan", "kabupaten", "provinsi")]
    locations = read_table(spark, folder, "events").select(code, *blank).distinct()
    envelopes = console_envelopes(console_records(documents, locations), AS_OF)
    records = envelope_records(envelopes, "adm4 string, lokasi string, suhu_celsius double")
    return records.groupBy("adm4", "lokasi").agg(
        F.count(F.lit(1)).alias("records_count"), F.max("suhu_celsius").alias("temp_max")
    )


# ---------------------------------------------------------------- streams


@query
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Documents land in two lots; the second run starts from the first one's checkpoint."""
    points = feed_points(spark, folder)
    hour = hour_floor(wall_clock(F.col("datetime")))
    points = points.withColumns({"datetime": iso_text(hour, "+07:00"), "wall": hour})
    early = F.col("event_type").isin(*FIRST_TYPES)
    table = fact_table(new_warehouse(spark))
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    for lot, now in ((points.where(early), AS_OF), (points.where(~early), NEXT_RUN)):
        documents = render_documents(lot, ["user_id", "run"], "event_id", feed_header())
        land_in_order(documents, landing)
        jobs.finish(
            jobs.ingest_stream(
                spark, landing, table, checkpoint, lambda _: now, options=IngestOptions(mode="wallclock")
            )
        )
    return table.read().select(
        "adm4", "waktu", "lokasi", "cuaca", "suhu_celsius", "kelembapan", "created_at", "last_updated"
    )


def _hourly_lots(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Documents of the first event types and of the others, their stamps cut to the hour."""
    points = feed_points(spark, folder)
    hour = hour_floor(F.col("wall"))
    points = points.withColumns({"datetime": iso_text(hour, "+07:00"), "wall": hour})
    early = F.col("event_type").isin(*FIRST_TYPES)
    return [render_documents(lot, ["user_id", "run"], "event_id", feed_header()) for lot in (points.where(early), points.where(~early))]


@query
def landing_order(spark: SparkSession, folder: str) -> DataFrame:
    """Two lots wait for one run; the one that landed last wins, though its files come first by name."""
    table, landing = fact_table(new_warehouse(spark)), scratch_path(spark, "landing")
    for lot, documents in zip((9, 1), _hourly_lots(spark, folder), strict=True):
        documents.select("doc").write.text(f"{landing}/lot={lot}")
    ingest_documents(table, read_documents(spark, landing), AS_OF, options=IngestOptions(mode="wallclock"))
    return table.read().select("adm4", "waktu", "cuaca", "suhu_celsius")


@query
def landed_once(spark: SparkSession, folder: str) -> DataFrame:
    """Two lots land one after the other; runs with nothing new, an hour later each, leave every stamp as it is."""
    table, landing = fact_table(new_warehouse(spark)), scratch_path(spark, "landing")
    ledger = FileLedger(new_table(spark, "ledger"))
    for hour, documents in enumerate(_hourly_lots(spark, folder)):
        documents.select("doc").write.text(f"{landing}/lot={hour}")
        for again in (0, 5):
            ingest_landed(table, landing, ledger, AS_OF + timedelta(hours=hour + again), options=IngestOptions(mode="wallclock"))
    return table.read().select("adm4", "waktu", "cuaca", "suhu_celsius", "created_at", "last_updated")


@query
def freshness_reset(spark: SparkSession, folder: str) -> DataFrame:
    """The first load leaves the labels empty, the second resets those of the points it brings."""
    table = fact_table(new_warehouse(spark))
    for reset, documents in zip((False, True), _hourly_lots(spark, folder), strict=True):
        options = IngestOptions(mode="wallclock", reset_freshness=reset)
        ingest_documents(table, landed(documents), AS_OF, options=options)
    return table.read().select("adm4", "waktu", "freshness_status")


@query
def hourly_run_by_created(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs a day apart; points that come again stay on the day they first came, with a new label."""
    table = fact_table(new_warehouse(spark), by=CREATED)
    for days, documents in enumerate(_hourly_lots(spark, folder)):
        hourly_run(table, landed(documents), AS_OF + timedelta(days=days))
    return table.read().select("adm4", "waktu", "cuaca", "suhu_celsius", CREATED, "data_age_minutes", "freshness_status")


def _landed_events(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """A folder that events are appended to, lot by lot."""
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return scratch_path(spark, "events"), events


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Locations and hours land twice; repeats within a lot and across lots are dropped by key."""
    path, events = _landed_events(spark, folder)
    points = events.select(F.col("user_id").alias("adm4"), hour_floor(F.col("ts")).alias("waktu"))
    out, checkpoint = scratch_path(spark, "unique"), scratch_path(spark, "stream")
    for _ in range(2):
        points.write.mode("append").parquet(path)
        source = jobs.table_stream(spark, path, points.schema)
        jobs.finish(jobs.dedup_stream(source, list(FACT_KEYS), "waktu", out, checkpoint))
    return spark.read.parquet(out)


@query
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The days up to mid-month land after the later ones; with a week's watermark some of their rows are late."""
    path, events = _landed_events(spark, folder)
    out, checkpoint = scratch_path(spark, "unique"), scratch_path(spark, "stream")
    week = Settings(retention_days=7)
    dropped_rows = []
    for lot in (events.where(F.col("ts") >= at(MID_MONTH)), events.where(F.col("ts") < at(MID_MONTH))):
        lot.write.mode("append").parquet(path)
        run = jobs.dedup_stream(jobs.table_stream(spark, path, events.schema), ["event_id"], "ts", out, checkpoint, week)
        jobs.finish(run)
        dropped_rows.append((jobs.late_rows(spark, run),))
    kept = spark.read.schema(events.schema).parquet(out).agg(F.count(F.lit(1)).alias("kept"))
    dropped = spark.createDataFrame(dropped_rows, "late bigint").agg(F.sum("late").alias("late"))
    return dropped.select("late", F.lit(kept.first()["kept"]).alias("kept"))


@query
def stream_daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    path, events = _landed_events(spark, folder)
    table, checkpoint = new_table(spark, "daily", "d"), scratch_path(spark, "stream")
    early = F.col("event_type").isin(*FIRST_TYPES) | (F.col("ts") < at(MID_MONTH))
    for lot in (events.where(early), events.where(~early)):
        lot.write.mode("append").parquet(path)
        source = jobs.table_stream(spark, path, events.schema)
        jobs.finish(jobs.daily_counts_stream(source, "event_type", "ts", table, checkpoint))
    return table.read()


@query
def stream_staleness(spark: SparkSession, folder: str) -> DataFrame:
    path, events = _landed_events(spark, folder)
    table, checkpoint = new_table(spark, "staleness"), scratch_path(spark, "stream")
    for lot in (events.where(F.col("ts") < at(MID_MONTH)), events.where(F.col("ts") >= at(MID_MONTH))):
        lot.write.mode("append").parquet(path)
        source = jobs.table_stream(spark, path, events.schema).withColumnRenamed("user_id", "adm4")
        jobs.finish(jobs.staleness_stream(source, "adm4", "ts", table, checkpoint, lambda batch_id: AS_OF))
    return table.read()


@query
def stream_silence(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of four heartbeats: with the first days, 181 minutes later without any row, with the rest, and once more.

    Every run is a new query on the same checkpoint."""
    path, events = _landed_events(spark, folder)
    ticks, checkpoint = scratch_path(spark, "ticks"), scratch_path(spark, "stream")
    labels, alerts = new_table(spark, "labels"), new_table(spark, "alerts", silence.SILENT_SINCE)
    nothing = events.limit(0)
    lots = [
        (events.where(F.col("ts") < at(MID_MONTH)), MID_MONTH),
        (nothing, MID_MONTH + timedelta(minutes=181)),
        (events.where(F.col("ts") >= at(MID_MONTH)), AS_OF),
        (nothing, AS_OF + timedelta(minutes=181)),
    ]
    for lot, now in lots:
        if lot is not nothing:
            lot.write.mode("append").parquet(path)
        silence.beat(spark, ticks, now)
        source = jobs.table_stream(spark, path, events.schema)
        run = silence.silence_stream(source, silence.heartbeats(spark, ticks), "user_id", "ts", labels, alerts, checkpoint)
        jobs.finish(run)
    return alerts.read().select("user_id", "latest", "age_minutes", "alerted_at")


@query
def stream_rollups(spark: SparkSession, folder: str) -> DataFrame:
    """Hours and days per event type from one stream; a late heartbeat ends the last windows."""
    path, events = _landed_events(spark, folder)
    ticks, checkpoint = scratch_path(spark, "ticks"), scratch_path(spark, "stream")
    tables = {grain: new_table(spark, grain, rollups.DAY) for grain in ("hour", "day")}
    silence.beat(spark, ticks, datetime(2023, 1, 1))
    for lot in (events.where(F.col("ts") < at(MID_MONTH)), events.where(F.col("ts") >= at(MID_MONTH)), None):
        if lot is None:
            silence.beat(spark, ticks, datetime(2025, 1, 1))
        else:
            lot.write.mode("append").parquet(path)
        source = jobs.table_stream(spark, path, events.schema)
        run = rollups.rollup_stream(
            source, silence.heartbeats(spark, ticks), "event_type", "ts", "value", tables["hour"], tables["day"], checkpoint
        )
        jobs.finish(run)
    both = union_all(table.read().withColumn("grain", F.lit(grain)) for grain, table in tables.items())
    return rounded(both.select("grain", "starts", "event_type", "records", "mean", "low", "high"), mean=8)


@query
def stream_late_side(spark: SparkSession, folder: str) -> DataFrame:
    """The last days land first, then all days twice, day by day in falling order: what is kept and what is late."""
    path, events = _landed_events(spark, folder)
    table, side = new_table(spark, "kept", late.DAY), new_table(spark, "late")
    checkpoint, week = scratch_path(spark, "stream"), Settings(retention_days=7)
    for lot in (events.where(F.col("ts") >= at(MID_MONTH)), events, events):
        lot.write.mode("append").parquet(path)
        source = jobs.table_stream(spark, path, events.schema)
        jobs.finish(late.kept_and_late_stream(source, ["event_id"], "ts", table, side, checkpoint, settings=week))
    told = late.balance(table, side)
    counted = side.read().groupBy("event_id").agg(F.count(F.lit(1)).alias("times_late"))
    rows = table.read().select("event_id", F.lit(True).alias("kept")).join(counted, "event_id", "full_outer")
    return rows.select(
        "event_id", F.coalesce("kept", F.lit(False)).alias("kept"), F.coalesce("times_late", F.lit(0)).alias("times_late"),
        F.lit(told["repeats"]).cast("bigint").alias("repeats"),
    )
