"""The forecast job end to end: counters, labels at their boundaries, retention, idempotence."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from muara.operators import freshness, quality
from muara.plans.ingest import CREATED, IngestOptions, fact_table, hourly_run, ingest_documents, require_change
from muara.schemas import DAILY_SUMMARY, FORECAST_FACT, shaped
from muara.plans import marts

T0 = datetime(2026, 1, 30, 12)
SCRIPT = IngestOptions(mode="convert", reset_freshness=True)
HOURLY = IngestOptions(mode="wallclock", adm4_from_request=False)


def point(hour, t, day=30):
    return {"datetime": f"2026-01-{day:02d}T{hour:02d}:00:00+07:00", "t": t, "hu": 70, "weather_desc": "Cerah", "ws": 1, "wd": "E"}


def docs(spark, *points, adm4="35.1"):
    body = {"lokasi": {"adm4": adm4, "kotkab": "Kota"}, "data": [{"cuaca": [list(points)]}]}
    return spark.createDataFrame([(json.dumps(body), adm4, 0)], "doc string, requested_adm4 string, doc_seq int")


def fact(table):
    return {(r["adm4"], r["waktu"]): r for r in table.read().collect()}


def test_repeat_in_one_document_counts_as_insert_and_update(spark, warehouse):
    table = fact_table(warehouse)
    counters = ingest_documents(table, docs(spark, point(1, 20), point(1, 21), point(2, 22)), T0, options=HOURLY)
    assert counters == {"inserted": 2, "updated": 1, "total": 3, "rejected": 0}
    assert fact(table)[("35.1", datetime(2026, 1, 30, 1))]["suhu_celsius"] == 21


def test_second_run_updates_and_keeps_created_at(spark, warehouse):
    table = fact_table(warehouse)
    ingest_documents(table, docs(spark, point(1, 20)), T0, options=HOURLY)
    later = T0 + timedelta(hours=1)
    counters = ingest_documents(table, docs(spark, point(1, 25), point(3, 9)), later, options=HOURLY)
    assert (counters["inserted"], counters["updated"]) == (1, 1)
    row = fact(table)[("35.1", datetime(2026, 1, 30, 1))]
    assert (row["created_at"], row["last_updated"], row["suhu_celsius"]) == (T0, later, 25)


def test_label_reset_depends_on_the_option(spark, warehouse):
    key = ("35.1", datetime(2026, 1, 30, 1))
    for name, options, first, second in (
        ("hourly", HOURLY, (None, None), (240.0, "STALE")),
        ("script", SCRIPT, (0.0, "FRESH"), (240.0, "FRESH")),
    ):
        table = fact_table(warehouse, name)
        ingest_documents(table, docs(spark, point(1, 20)), T0, options=options)
        row = fact(table)[key]
        assert (row["data_age_minutes"], row["freshness_status"]) == first
        freshness.refresh_row_labels(table, T0 + timedelta(hours=4))
        ingest_documents(table, docs(spark, point(1, 21)), T0 + timedelta(hours=5), options=options)
        row = fact(table)[key]
        assert (row["data_age_minutes"], row["freshness_status"]) == second


def test_rejects_are_kept_aside_and_good_rows_loaded(spark, warehouse):
    table, aside = fact_table(warehouse), warehouse.table("quarantine")
    bad = spark.createDataFrame([("{", "x", 1)], "doc string, requested_adm4 string, doc_seq int")
    batch = docs(spark, point(1, 20), {**point(2, "x")}, {**point(3, 1), "datetime": ""}).union(bad)
    counters = ingest_documents(table, batch, T0, options=HOURLY, quarantine=aside)
    assert (counters["total"], counters["rejected"]) == (1, 2)
    reasons = sorted(r["reason"] for r in aside.read().collect())
    assert reasons == ["datetime_missing", "malformed_json", "t_invalid"]


def test_a_run_without_rows_fails(spark, warehouse):
    counters = ingest_documents(fact_table(warehouse), docs(spark), T0)
    with pytest.raises(quality.CheckFailed):
        require_change(counters)


def test_stream_mark_makes_ingest_idempotent(spark, warehouse):
    table = fact_table(warehouse)
    for value in (20, 30):
        ingest_documents(table, docs(spark, point(1, value)), T0, options=HOURLY, stream=("s", 3))
    assert fact(table)[("35.1", datetime(2026, 1, 30, 1))]["suhu_celsius"] == 20


def test_past_points_are_deleted_before_the_insert(spark, warehouse):
    table = fact_table(warehouse)
    ingest_documents(table, docs(spark, point(1, 20), point(13, 20)), T0, options=HOURLY)
    options = IngestOptions(mode="wallclock", delete_past=True)
    ingest_documents(table, docs(spark, point(2, 5)), T0, options=options)
    assert sorted(k[1].hour for k in fact(table)) == [2, 13]


def test_hourly_run_reports_every_step(spark, warehouse):
    table = fact_table(warehouse)
    hourly_run(table, docs(spark, point(1, 20)), T0 - timedelta(days=40))
    counts = hourly_run(table, docs(spark, point(2, 20), adm4="35.2"), T0)
    assert counts == {"inserted": 1, "updated": 0, "total": 1, "rejected": 0, "labelled": 1, "deleted": 1}


def test_both_layouts_hold_the_same_rows(spark, warehouse):
    """Points come again a day later, with another value and a new neighbour, and past the retention window."""
    lots = [
        (T0 - timedelta(days=31), docs(spark, point(1, 20), point(2, 21))),
        (T0 - timedelta(days=1), docs(spark, point(3, 1), point(4, 2))),
        (T0, docs(spark, point(2, 30), point(3, 31), point(5, 32), adm4="35.1")),
    ]
    tables = [fact_table(warehouse, "by_point"), fact_table(warehouse, "by_creation", CREATED)]
    seen = []
    for options in (HOURLY, SCRIPT):
        for table in tables:
            table.replace(table.read().where(F.lit(False)))
            counts = [hourly_run(table, given, now, options=options) for now, given in lots]
            rows = table.read().drop("waktu_date", CREATED).collect()
            seen.append((counts, sorted(map(str, rows))))
    assert seen[0] == seen[1] and seen[2] == seen[3]
    assert [c["deleted"] for c in seen[0][0]] == [0, 0, 2]
    days = {(r["created_at"].date(), r[CREATED]) for r in tables[1].read().collect()}
    assert days == {(d.date(), d.date()) for d in (T0 - timedelta(days=1), T0)}


def test_past_points_are_deleted_in_the_other_layout(spark, warehouse):
    table = fact_table(warehouse, by=CREATED)
    ingest_documents(table, docs(spark, point(1, 20), point(13, 20)), T0 - timedelta(days=2), options=HOURLY)
    ingest_documents(table, docs(spark, point(2, 5)), T0, options=IngestOptions(mode="wallclock", delete_past=True))
    assert sorted(k[1].hour for k in fact(table)) == [2, 13]


def stamped(spark, *pairs):
    names = FORECAST_FACT.names
    out = []
    for i, (created, updated) in enumerate(pairs):
        row = {n: None for n in names} | {"adm4": str(i), "waktu": T0, "created_at": created, "last_updated": updated}
        out.append(tuple((row | {"freshness_status": "OLD", "waktu_date": T0.date()})[n] for n in names))
    return spark.createDataFrame(out, FORECAST_FACT)


def test_label_boundaries(spark, warehouse):
    tick, minute, day = timedelta(microseconds=1), timedelta(minutes=1), timedelta(days=1)
    cases = [
        (T0, T0 - 60 * minute, "FRESH"),
        (T0, T0 - 60 * minute - tick, "WARNING"),
        (T0, T0 - 180 * minute, "WARNING"),
        (T0, T0 - 180 * minute - tick, "STALE"),
        (T0, T0 + 5 * minute, "FRESH"),
        (T0 - 2 * day, T0, "FRESH"),
        (T0 - 2 * day - tick, T0, "OLD"),
        (T0 - 90 * minute, None, "WARNING"),
        (None, T0, "OLD"),
    ]
    table = fact_table(warehouse)
    table.replace(stamped(spark, *[(c, u) for c, u, _ in cases]))
    assert freshness.refresh_row_labels(table, T0) == 7
    labels = {int(r["adm4"]): r["freshness_status"] for r in table.read().collect()}
    assert [labels[i] for i in range(len(cases))] == [label for _, _, label in cases]


def test_retention_boundary(spark, warehouse):
    edge = T0 - timedelta(days=30)
    table = fact_table(warehouse)
    table.replace(stamped(spark, (edge, T0), (edge - timedelta(microseconds=1), T0), (None, T0)))
    assert freshness.apply_retention(table, T0) == 1
    assert sorted(r["adm4"] for r in table.read().collect()) == ["0", "2"]


def test_summary_is_stored_in_the_declared_types(spark, warehouse):
    table = fact_table(warehouse)
    ingest_documents(table, docs(spark, point(1, 20), point(2, 21.25)), T0, options=HOURLY)
    stored = shaped(marts.daily_summary(table.read()), DAILY_SUMMARY)
    assert stored.schema == DAILY_SUMMARY
    row = stored.first()
    assert (str(row["temp_avg"]), row["humidity_avg"], row["weather_description"]) == ("20.63", 70, "Cerah")


def test_record_rules_name_what_is_broken(spark):
    rows = spark.createDataFrame(
        [
            ("a", "l", "2026-01-30T00:00:00", 55.0, 100),
            (None, "l", "soon", 55.1, -1),
            ("a", None, None, None, None),
        ],
        "adm4 string, lokasi string, waktu string, suhu_celsius double, kelembapan int",
    )
    broken = [r["broken"] for r in quality.broken_rules(rows, quality.record_rules()).collect()]
    assert broken[0] == []
    assert broken[1] == ["adm4_missing", "temp_range", "hum_range", "waktu_format"]
    assert broken[2] == ["lokasi_missing", "waktu_missing", "suhu_celsius_missing", "kelembapan_missing"]


def test_gate_closes_when_most_locations_are_stale(spark):
    rows = spark.createDataFrame([("a", T0), ("b", T0 - timedelta(days=1)), ("c", T0 - timedelta(days=1))], "adm4 string, waktu timestamp_ntz")
    gate = freshness.freshness_gate(freshness.location_freshness(rows, T0)).first()
    assert (round(gate["stale_percent"], 3), gate["open"]) == (66.667, False)
    nothing = freshness.freshness_gate(freshness.location_freshness(rows.where(F.lit(False)), T0)).first()
    assert nothing["open"] is False
