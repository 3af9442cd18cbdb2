"""Streams give what their batch twins give, however the input is cut, and restart where they stopped."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from muara.functions.clock import iso_text
from muara.plans.ingest import IngestOptions, fact_table, ingest_documents
from muara.session import scratch_path
from muara.sources.documents import read_documents
from muara.streaming import jobs

T0 = datetime(2026, 1, 30, 12)
OPTIONS = IngestOptions(mode="wallclock")


def land(spark, landing, part, values):
    """One file of documents; later files carry later values for the same hours."""
    lines = []
    for value in values:
        points = [
            {"datetime": f"2026-01-30T{hour:02d}:00:00", "t": value + hour, "hu": 1, "weather_desc": "x", "ws": 0, "wd": "E"}
            for hour in range(3)
        ]
        lines.append((json.dumps({"lokasi": {"adm4": str(value % 2)}, "data": [{"cuaca": [points]}]}),))
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(f"{landing}/part={part}")


def state(table):
    return sorted(tuple(r) for r in table.read().select("adm4", "waktu", "suhu_celsius").collect())


def test_ingest_equals_batch_for_one_and_many_batches_and_after_restart(spark, warehouse):
    landing = scratch_path(spark, "landing")
    for part in range(3):
        land(spark, landing, part, range(10 * part, 10 * part + 5))
    batch = fact_table(warehouse, "batch")
    ingest_documents(batch, read_documents(spark, landing), T0, options=OPTIONS)
    for name, max_files in (("one", None), ("many", 1)):
        table, checkpoint = fact_table(warehouse, name), scratch_path(spark, "cp")

        def run():
            query = jobs.ingest_stream(
                spark, landing, table, checkpoint, lambda i: T0, options=OPTIONS, max_files=max_files
            )
            jobs.finish(query)

        run()
        assert state(table) == state(batch)
        version = table.state()["version"]
        run()
        assert table.state()["version"] == version
    land(spark, landing, 3, [40])
    run()
    assert (str(0), datetime(2026, 1, 30, 0), 40.0) in state(table)


def test_dedup_drops_copies_and_rows_behind_the_watermark(spark):
    path, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    schema = "id int, ts timestamp_ntz"
    lots = [
        [(1, T0), (1, T0), (2, T0)] + [(9, T0)] * 200,
        [(1, T0), (3, T0 + timedelta(days=40))],
        [(4, T0), (3, T0 + timedelta(days=40)), (5, T0 + timedelta(days=41))],
    ]
    for lot in lots:
        spark.createDataFrame(lot, schema).repartition(4).write.mode("append").parquet(path)
        jobs.finish(jobs.dedup_stream(jobs.table_stream(spark, path, schema), ["id", "ts"], "ts", out, checkpoint))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3, 5, 9]


def test_staleness_covers_silent_locations(spark, warehouse):
    path, checkpoint, table = scratch_path(spark, "in"), scratch_path(spark, "cp"), warehouse.table("stale")
    schema = "adm4 string, waktu timestamp_ntz"
    clocks = [T0, T0 + timedelta(hours=4)]
    for lot in ([("a", T0), ("b", T0)], [("a", clocks[1])]):
        spark.createDataFrame(lot, schema).write.mode("append").parquet(path)
        jobs.finish(
            jobs.staleness_stream(
                jobs.table_stream(spark, path, schema), "adm4", "waktu", table, checkpoint, clocks.__getitem__
            )
        )
    labels = {r["adm4"]: r["freshness_status"] for r in table.read().collect()}
    assert labels == {"a": "FRESH", "b": "STALE"}


def test_daily_counts_do_not_depend_on_the_session_zone(spark, warehouse):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        path, checkpoint, table = scratch_path(spark, "in"), scratch_path(spark, "cp"), warehouse.table("days")
        rows = [("x", T0.replace(hour=23)), ("x", T0.replace(hour=1))]
        spark.createDataFrame(rows, "kind string, ts timestamp_ntz").write.parquet(path)
        source = jobs.table_stream(spark, path, "kind string, ts timestamp_ntz")
        jobs.finish(jobs.daily_counts_stream(source, "kind", "ts", table, checkpoint))
        assert [tuple(r) for r in table.read().collect()] == [(T0.date(), "x", 2)]
        assert spark.range(1).select(iso_text(F.lit("2024-01-01 01:02:03").cast("timestamp_ntz"), "Z")).first()[0] == "2024-01-01T01:02:03Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
