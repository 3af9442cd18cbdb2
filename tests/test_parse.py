"""Golden documents: one test per documented variant of the payload."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from muara.operators.forecast import (
    parse_documents,
    rejected_documents,
    rejected_points,
    valid_points,
)
from muara.plans.console import console_envelopes, console_records, select_locations
from muara.sources.documents import read_documents
from muara.session import scratch_path

HEADER = {"adm4": "35.1", "kotkab": "Kota A", "kecamatan": "Kec A", "desa": "Desa A", "provinsi": "Prov A"}
POINT = {"datetime": "2025-11-08T04:00:00Z", "t": 28, "hu": 61, "weather_desc": "Berawan", "ws": 3.7, "wd": "E"}


def document(*points, header=HEADER, groups=None):
    body = {"data": [{"cuaca": groups if groups is not None else [list(points)]}]}
    if header is not ...:
        body["lokasi"] = header
    return json.dumps(body)


def frame(spark, *docs):
    rows = [(d, "35.1", i) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "doc string, requested_adm4 string, doc_seq int")


def locations(spark):
    rows = [("35.1", "Lokasi 1", "d", "k", "kab", "p")]
    names = "adm4 string, location_name string, desa string, kecamatan string, kabupaten string, provinsi string"
    return spark.createDataFrame(rows, names)


def parse(spark, *docs, **options):
    return parse_documents(frame(spark, *docs), **options)


def test_point_with_utc_stamp_moves_to_local_time(spark):
    row = valid_points(parse(spark, document(POINT))).first()
    assert row["waktu"] == datetime(2025, 11, 8, 11)
    assert (row["adm4"], row["lokasi"], row["kabupaten"]) == ("35.1", "Kota A", "Kota A")
    assert (row["suhu_celsius"], row["kelembapan"], row["kecepatan_angin"]) == (28.0, 61, 3.7)
    assert (row["cuaca"], row["arah_angin"]) == ("Berawan", "E")


def test_wallclock_mode_drops_the_offset(spark):
    doc = document({**POINT, "datetime": "2025-05-17T10:00:00+07:00"})
    assert valid_points(parse(spark, doc, mode="wallclock")).first()["waktu"] == datetime(2025, 5, 17, 10)
    assert valid_points(parse(spark, doc)).first()["waktu"] == datetime(2025, 5, 17, 10)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-11-08T23:30:00Z", datetime(2025, 11, 9, 6, 30)),
        ("2025-11-08T23:30:00.987654Z", datetime(2025, 11, 9, 6, 30)),
        ("2025-11-08T20:00:00-05:30", datetime(2025, 11, 9, 8, 30)),
        ("2025-11-08 04:00:00+00:00", datetime(2025, 11, 8, 11)),
        ("2025-11-08T04:00:00", datetime(2025, 11, 8, 4)),
        ("2025-11-08T04:00", datetime(2025, 11, 8, 4)),
        ("2025-11-08", datetime(2025, 11, 8)),
        ("1969-12-31T20:00:00Z", datetime(1970, 1, 1, 3)),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stamps_do_not_depend_on_the_session_zone(spark, zone, text, expected):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = valid_points(parse(spark, document({**POINT, "datetime": text}))).first()
        assert row["waktu"] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"datetime": None}, "datetime_missing"),
        ({"datetime": ""}, "datetime_missing"),
        ({"datetime": "soon"}, "datetime_invalid"),
        ({"datetime": "2026-02-30T00:00:00Z"}, "datetime_invalid"),
        ({"t": "x"}, "t_invalid"),
        ({"t": {"value": 1}}, "t_invalid"),
        ({"hu": "61.5"}, "hu_invalid"),
        ({"ws": "fast"}, "ws_invalid"),
    ],
)
def test_bad_points_are_rejected_with_a_reason(spark, change, reason):
    points = parse(spark, document(POINT, {**POINT, **change}))
    assert valid_points(points).count() == 1
    assert rejected_points(points).first()["reject_reasons"] == [reason]


def test_numbers_as_text_and_rounded_numbers_are_cast(spark):
    doc = document({**POINT, "t": "28.5", "hu": " 61 "}, {**POINT, "hu": 61.5}, {**POINT, "t": None, "hu": None})
    rows = valid_points(parse(spark, doc)).orderBy("seq").collect()
    assert [(r["suhu_celsius"], r["kelembapan"]) for r in rows] == [(28.5, 61), (28.0, 62), (None, None)]


def test_missing_header_uses_the_configured_names(spark):
    row = valid_points(parse(spark, document(POINT, header=...), locations=locations(spark))).first()
    assert (row["adm4"], row["lokasi"], row["desa"], row["kabupaten"]) == ("35.1", "Lokasi 1", "d", "kab")


def test_missing_header_without_code_fallback_rejects_the_point(spark):
    points = parse(spark, document(POINT, header=...), locations=locations(spark), adm4_from_request=False)
    assert rejected_points(points).first()["reject_reasons"] == ["adm4_missing"]


def test_null_in_the_header_stays_null_and_absent_key_falls_back(spark):
    header = {"adm4": "35.1", "kotkab": None}
    row = valid_points(parse(spark, document(POINT, header=header), locations=locations(spark))).first()
    assert (row["lokasi"], row["kabupaten"], row["desa"]) == (None, None, "d")


def test_groups_that_are_no_lists_leave_their_siblings(spark):
    doc = document(groups=["text", {"a": 1}, None, [POINT], 5, [{**POINT, "t": 1}]])
    assert valid_points(parse(spark, doc)).count() == 2


@pytest.mark.parametrize(
    "doc", ['{"lokasi": {"adm4": "1"}}', '{"data": []}', '{"data": null}', '{"data": [{}]}', '{"data": [{"cuaca": []}]}']
)
def test_empty_documents_give_no_rows_and_no_reject(spark, doc):
    assert parse(spark, doc).isEmpty()
    assert rejected_documents(frame(spark, doc)).isEmpty()


@pytest.mark.parametrize(
    "doc, reason",
    [
        ('{"lokasi": {', "malformed_json"),
        ("[1]", "not_an_object"),
        ('{"lokasi": null, "data": []}', "header_not_an_object"),
        ('{"lokasi": 7, "data": [{"cuaca": [[{"t": 1}]]}]}', "header_not_an_object"),
    ],
)
def test_broken_documents_are_rejected(spark, doc, reason):
    assert parse(spark, doc).isEmpty()
    assert rejected_documents(frame(spark, doc)).first()["reason"] == reason


def test_sequence_follows_the_feed(spark):
    docs = [
        document(groups=[[{**POINT, "t": 1}, {**POINT, "t": 2}], [{**POINT, "t": 3}]]),
        document({**POINT, "t": 4}),
    ]
    rows = parse(spark, *docs).repartition(5).orderBy("seq").collect()
    assert [r["suhu_celsius"] for r in rows] == [1, 2, 3, 4]


def test_documents_are_read_per_line_and_per_file(spark):
    path = scratch_path(spark, "docs")
    lines = [(document(POINT),), (document({**POINT, "t": 1}),), ("",)]
    spark.createDataFrame(lines, "doc string").coalesce(1).write.text(f"{path}/adm4=35.1")
    by_line = read_documents(spark, path)
    assert by_line.count() == 2
    assert {r["requested_adm4"] for r in by_line.collect()} == {"35.1"}
    assert [r["doc"] for r in by_line.orderBy("doc_seq").collect()] == [row[0] for row in lines[:2]]
    assert read_documents(spark, path, whole_files=True).count() == 1


def test_console_form(spark):
    chosen, unknown = select_locations(locations(spark), ["35.1", "99"])
    assert [r["adm4"] for r in chosen.collect()] == ["35.1"]
    assert [r["adm4"] for r in unknown.collect()] == ["99"]
    records = console_records(frame(spark, document(POINT, {**POINT, "datetime": "soon"})), locations(spark))
    rows = console_envelopes(records, datetime(2025, 11, 8)).collect()
    headers = [json.loads(r["body"]) for r in rows if r["part"] == "header"]
    assert [(h["status"], h["records_count"], h["timestamp_fetched"]) for h in headers] == [
        ("success", 2, "2025-11-08T00:00:00")
    ]
    assert len([r for r in rows if r["part"] == "record"]) == 2
