"""Labels: freshness classes, weather codes, table classes, display sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muara.settings import DEFAULTS, Settings

# Forecast code and its description.
WEATHER_CODES = (
    ("0", "Cerah"),
    ("1", "Cerah Berawan"),
    ("2", "Berawan"),
    ("3", "Berawan Tebal"),
    ("4", "Berkabut"),
    ("5", "Hujan Ringan"),
    ("10", "Hujan Sedang"),
    ("11", "Hujan Lebat"),
    ("12", "Hujan Lebat Berlanjut"),
    ("13", "Hujan Sangat Lebat"),
    ("20", "Hujan Ringan Berawan"),
    ("25", "Hujan Petir"),
    ("26", "Hujan Petir Berlanjut"),
    ("30", "Cerah Dingin"),
    ("31", "Cerah Berawan Dingin"),
    ("32", "Berawan Dingin"),
    ("33", "Berawan Tebal Dingin"),
    ("40", "Kabut Tipis"),
    ("41", "Kabut"),
    ("45", "Kabut Tebal"),
    ("50", "Drizzle"),
    ("55", "Hujan Gerimis"),
    ("60", "Hujan Ringan Terputus"),
    ("61", "Hujan Ringan Terputus Berawan"),
    ("63", "Hujan Sedang Terputus"),
    ("65", "Hujan Lebat Terputus"),
    ("80", "Hujan Ringan Menyeluruh"),
    ("81", "Hujan Sedang Menyeluruh"),
    ("82", "Hujan Lebat Menyeluruh"),
    ("85", "Hujan Petir Menyeluruh"),
    ("90", "Tornado"),
    ("91", "Puting Beliung"),
)


def weather_code_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WEATHER_CODES, "code string, description string")


def decode_weather_code(rows: DataFrame, code: str, out: str = "cuaca") -> DataFrame:
    """Join the 32-row code table (fixed size, so broadcast); unknown codes keep the code in the text."""
    key = F.col(code).cast("string")
    codes = F.broadcast(weather_code_table(rows.sparkSession).withColumnRenamed("code", "weather_code"))
    unknown = F.format_string("Unknown (%s)", F.coalesce(key, F.lit("None")))
    return (
        rows.join(codes, key == F.col("weather_code"), "left")
        .withColumn(out, F.coalesce(F.col("description"), unknown))
        .drop("weather_code", "description")
    )


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; null when there is nothing to share."""
    return F.try_divide(part * F.lit(100.0), whole)


def freshness_label(age_minutes: Column, settings: Settings = DEFAULTS) -> Column:
    return (
        F.when(age_minutes <= settings.fresh_minutes, "FRESH")
        .when(age_minutes <= settings.warning_minutes, "WARNING")
        .otherwise("STALE")
    )


def table_class(name: Column, patterns: Sequence[str], matched: str, other: str) -> Column:
    """``matched`` when the name is LIKE any of the patterns."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | name.like(pattern)
    return F.when(hit, matched).otherwise(other)


WEATHER_PATTERNS = ("%weather%", "fact_weather%", "dim_weather%", "v_weather%")


def weather_or_company(name: Column) -> Column:
    return table_class(name, WEATHER_PATTERNS, "Weather Data", "Company Data")


def pretty_size(size: Column) -> Column:
    """Bytes as text the way PostgreSQL shows them: a unit is left once the value reaches 10240 of it."""
    kib = 1024.0
    text = F.when(size < 10 * 1024, F.format_string("%d bytes", size.cast("bigint")))
    for power, unit in enumerate(("kB", "MB", "GB"), start=1):
        value = F.round(size / F.lit(kib**power)).cast("bigint")
        text = text.when(value < 10 * 1024, F.format_string(f"%d {unit}", value))
    return text.otherwise(F.format_string("%d TB", F.round(size / F.lit(kib**4)).cast("bigint")))
