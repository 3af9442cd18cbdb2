"""Landed forecast documents: reading them in landing order, and rendering rows back to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str | list[str], whole_files: bool = False) -> DataFrame:
    """One document per line, or per file, of a folder or of files; ``doc_seq`` is the landing order."""
    return numbered(document_columns(spark.read.text(path, wholetext=whole_files)))


def document_columns(raw: DataFrame) -> DataFrame:
    """Text rows with their place; also fits a streaming text source."""
    requested = F.regexp_extract(F.col("_metadata.file_path"), r"adm4=([^/]+)", 1)
    return raw.select(
        F.col("value").alias("doc"),
        F.when(requested != "", requested).alias("requested_adm4"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def numbered(documents: DataFrame) -> DataFrame:
    """Order by landing time, then file name, then place in the file.

    Ids grow in scan order and no shuffle lies in between.
    """
    place = F.struct("landed_at", "file_path", "block_start", F.monotonically_increasing_id().alias("line"))
    return documents.select("doc", "requested_adm4", place.alias("doc_seq")).where(F.trim("doc") != "")


def render_documents(points: DataFrame, by: list[str], order: str, header: Column) -> DataFrame:
    """Feed documents from forecast rows: one per ``by``, which names location and landing run.

    As in the feed, a document has one ``data`` entry per day and in it one ``cuaca`` group per quarter of the day;
    items of a group come by ``order``. ``points`` carries ``wall``, the wall clock that days and quarters follow,
    and the feed's item fields datetime, t, hu, weather_desc, ws, wd.
    """
    item = F.struct("datetime", "t", "hu", "weather_desc", "ws", "wd")
    placed = points.withColumns({"day": F.col("wall").cast("date"), "quarter": F.floor(F.hour("wall") / F.lit(6))})
    groups = placed.groupBy(*by, "day", "quarter").agg(
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("seq"), item.alias("item")))).alias("rows")
    )
    group = F.transform("rows", lambda row: row["item"])
    days = groups.groupBy(*by, "day").agg(F.sort_array(F.collect_list(F.struct("quarter", group.alias("items")))).alias("groups"))
    entry = F.struct(F.transform("groups", lambda g: g["items"]).alias("cuaca"))
    grouped = days.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("day", entry.alias("entry")))).alias("days"))
    data = F.transform("days", lambda d: d["entry"])
    return grouped.select(*by, F.to_json(F.struct(header.alias("lokasi"), data.alias("data"))).alias("doc"))
