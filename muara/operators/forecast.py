"""Nested forecast documents to typed rows, with rejects kept aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muara.functions.clock import local_time, wall_clock
from muara.settings import DEFAULTS, Settings

ARRAY = "array<variant>"
#: One read per item: text as written, the humidity with its kind. An item that is no object has none of them.
ITEM = "struct<datetime:string,weather_desc:string,t:string,hu:variant,wd:string,ws:string>"


def parse_documents(
    documents: DataFrame,
    locations: DataFrame | None = None,
    mode: str = "convert",
    adm4_from_request: bool = True,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One row per forecast point of ``data[].cuaca[][]``.

    The document is parsed once to a VARIANT. A level that is not an array gives no rows and leaves its
    siblings alone. ``reject_reasons`` is empty for a row that may be loaded; ``seq`` is the position of
    the point in the feed, which decides which of two points with one key is the last.

    ``mode`` 'convert' moves stamps to the configured zone, 'wallclock' keeps the clock as written.
    ``locations`` (adm4, location_name, desa, kecamatan, kabupaten, provinsi) fills header keys that are
    missing; a key that is present with a JSON null stays null.
    """
    if mode not in ("convert", "wallclock"):
        raise ValueError(f"unknown mode {mode!r}")
    parsed = documents.select("doc_seq", "requested_adm4", F.try_parse_json("doc").alias("v"))
    items = (
        _with_header(parsed, locations, adm4_from_request)
        .select("*", F.posexplode(_array("v", "$.data")).alias("data_at", "entry"))
        .drop("v")
        .select("*", F.posexplode(_array("entry", "$.cuaca")).alias("group_at", "points"))
        .drop("entry")
        .select("*", F.posexplode(_array("points", "$")).alias("item_at", "v"))
        .select("*", F.try_variant_get("v", "$", ITEM).alias("item"))
        .drop("points", "v")
    )
    stamp = F.col("item.datetime")
    waktu = local_time(stamp, settings.zone) if mode == "convert" else wall_clock(stamp)
    typed = items.select(
        F.struct("doc_seq", "data_at", "group_at", "item_at").alias("seq"),
        "adm4",
        "lokasi",
        "desa",
        "kecamatan",
        "kabupaten",
        "provinsi",
        waktu.alias("waktu"),
        F.col("item.weather_desc").alias("cuaca"),
        F.col("item.t").try_cast("double").alias("suhu_celsius"),
        _integer(F.col("item.hu")).alias("kelembapan"),
        F.col("item.wd").alias("arah_angin"),
        F.col("item.ws").try_cast("double").alias("kecepatan_angin"),
        stamp.alias("datetime_text"),
        F.col("item.t").isNotNull().alias("has_t"),
        (F.col("item.hu").isNotNull() & ~F.is_variant_null("item.hu")).alias("has_hu"),
        F.col("item.ws").isNotNull().alias("has_ws"),
    )
    blank_stamp = F.coalesce(F.col("datetime_text"), F.lit("")) == ""
    reasons = F.array_compact(
        F.array(
            F.when(F.coalesce(F.col("adm4"), F.lit("")) == "", "adm4_missing"),
            F.when(blank_stamp, "datetime_missing"),
            F.when(~blank_stamp & F.col("waktu").isNull(), "datetime_invalid"),
            F.when(F.col("has_t") & F.col("suhu_celsius").isNull(), "t_invalid"),
            F.when(F.col("has_hu") & F.col("kelembapan").isNull(), "hu_invalid"),
            F.when(F.col("has_ws") & F.col("kecepatan_angin").isNull(), "ws_invalid"),
        )
    )
    return typed.withColumn("reject_reasons", reasons).drop("has_t", "has_hu", "has_ws")


def valid_points(points: DataFrame) -> DataFrame:
    return points.where(F.size("reject_reasons") == 0).drop("reject_reasons", "datetime_text")


def rejected_points(points: DataFrame) -> DataFrame:
    return points.where(F.size("reject_reasons") > 0)


def rejected_documents(documents: DataFrame) -> DataFrame:
    """``doc_seq, doc, reason``: documents and parts of documents that give no rows because they are malformed.

    A document that is broken as a whole has one row. In the others each ``data``, ``cuaca`` or group that is there
    and no list has one; null counts as empty. Items that are no objects are points without a stamp, see
    ``rejected_points``.
    """
    v = F.try_parse_json("doc")
    kind = F.schema_of_variant(F.col("v"))
    reason = (
        F.when(F.col("v").isNull(), "malformed_json")
        .when(~kind.startswith("OBJECT"), "not_an_object")
        .when(
            _exists("v", "$.lokasi") & F.try_variant_get("v", "$.lokasi", "map<string,variant>").isNull(),
            "header_not_an_object",
        )
    )
    judged = documents.select("doc_seq", "doc", v.alias("v")).withColumn("whole", reason)
    entries = _others(_array("v", "$.data"), lambda e: F.try_variant_get(e, "$.cuaca", "variant"))
    groups = F.flatten(F.transform(F.coalesce(_array("v", "$.data"), _no_variants()), lambda e: F.coalesce(F.try_variant_get(e, "$.cuaca", ARRAY), _no_variants())))
    bad_data = F.filter(F.array(F.try_variant_get("v", "$.data", "variant")), _no_list)
    parts = F.concat(
        F.transform(bad_data, lambda _: F.lit("data_not_a_list")),
        F.transform(F.filter(entries, _no_list), lambda _: F.lit("cuaca_not_a_list")),
        F.transform(F.filter(groups, _no_list), lambda _: F.lit("group_not_a_list")),
    )
    reasons = F.when(F.col("whole").isNotNull(), F.array("whole")).otherwise(parts)
    return judged.select("doc_seq", "doc", F.explode(reasons).alias("reason"))


def _no_variants() -> Column:
    return F.array().cast(ARRAY)


def _others(entries: Column, field) -> Column:
    return F.transform(F.coalesce(entries, _no_variants()), field)


def _no_list(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value) & ~F.schema_of_variant(value).startswith("ARRAY")


def _with_header(parsed: DataFrame, locations: DataFrame | None, adm4_from_request: bool) -> DataFrame:
    header = F.try_variant_get("v", "$.lokasi", "map<string,variant>")
    rows = parsed.withColumn("header", header).where(
        F.col("header").isNotNull() | ~_exists("v", "$.lokasi")
    )
    fallback = ("location_name", "desa", "kecamatan", "kabupaten", "provinsi")
    if locations is None:
        rows = rows.select("*", *[F.lit(None).cast("string").alias(f"default_{c}") for c in fallback])
    else:
        named = locations.select(
            F.col("adm4").alias("requested_adm4"),
            *[F.col(c).alias(f"default_{c}") for c in fallback],
        )
        rows = rows.join(named, "requested_adm4", "left")

    def field(key: str, default: Column) -> Column:
        value = F.try_variant_get(F.try_element_at("header", F.lit(key)), "$", "string")
        return F.when(F.map_contains_key("header", key), value).otherwise(default)

    requested = F.col("requested_adm4") if adm4_from_request else F.lit(None).cast("string")
    return rows.select(
        "doc_seq",
        "v",
        field("adm4", requested).alias("adm4"),
        field("kotkab", F.col("default_location_name")).alias("lokasi"),
        field("desa", F.col("default_desa")).alias("desa"),
        field("kecamatan", F.col("default_kecamatan")).alias("kecamatan"),
        field("kotkab", F.col("default_kabupaten")).alias("kabupaten"),
        field("provinsi", F.col("default_provinsi")).alias("provinsi"),
    )


def _array(column: str, path: str) -> Column:
    return F.try_variant_get(column, path, ARRAY)


def _exists(column: str, path: str) -> Column:
    return F.try_variant_get(column, path, "variant").isNotNull()


def _integer(value: Column) -> Column:
    """Text must be a whole number; a JSON number is rounded, as an assignment to INT does."""
    written_as_text = F.schema_of_variant(value) == "STRING"
    number = F.round(F.try_variant_get(value, "$", "decimal(20,6)")).try_cast("int")
    return F.when(written_as_text, F.try_variant_get(value, "$", "string").try_cast("int")).otherwise(number)
