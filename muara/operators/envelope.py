"""JSON envelopes around the records of a location."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_envelopes(records: DataFrame, key: str, as_of: datetime, source: str) -> DataFrame:
    """``(key, part, body)``: one ``header`` row per location and one ``record`` row per record, at every size.

    The header holds status, time, source and the count of the location's records; a record is one JSON line, so no
    group is gathered. Records without a location keep a header of their own under the null key.
    """
    header = F.struct(
        F.lit("success").alias("status"),
        F.lit(as_of.isoformat()).alias("timestamp_fetched"),
        F.lit(source).alias("source"),
        F.col("records_count"),
    )
    counts = records.groupBy(key).agg(F.count(F.lit(1)).alias("records_count"))
    headers = counts.select(key, F.lit("header").alias("part"), F.to_json(header).alias("body"))
    lines = F.to_json(F.struct(*records.columns))
    return headers.unionByName(records.select(key, F.lit("record").alias("part"), lines.alias("body")))


def envelope_records(envelopes: DataFrame, record_schema: str) -> DataFrame:
    """The records back out of envelopes."""
    body = F.from_json("body", record_schema)
    return envelopes.where("part = 'record'").select(body.alias("record")).select("record.*")


def envelope_headers(envelopes: DataFrame, key: str) -> DataFrame:
    """``key, status, timestamp_fetched, source, records_count`` of every location."""
    body = F.from_json("body", "status string, timestamp_fetched string, source string, records_count bigint")
    return envelopes.where("part = 'header'").select(key, body.alias("header")).select(key, "header.*")
