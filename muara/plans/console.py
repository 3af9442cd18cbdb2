"""The console form of the feed: chosen locations in, one JSON envelope set out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muara.operators.envelope import json_envelopes
from muara.operators.forecast import parse_documents
from muara.settings import DEFAULTS, Settings


def select_locations(locations: DataFrame, wanted: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
    """The configured locations asked for (all by default), and the codes nobody configured."""
    spark = locations.sparkSession
    if wanted is None:
        return locations, spark.createDataFrame([], "adm4 string")
    asked = spark.createDataFrame([(code,) for code in wanted], "adm4 string")
    return locations.join(asked, "adm4", "left_semi"), asked.join(locations, "adm4", "left_anti")


def console_records(
    documents: DataFrame,
    locations: DataFrame,
    wanted: Sequence[str] | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """All forecast points of the chosen locations, rejects included: the console form only shows them."""
    chosen, _ = select_locations(locations, wanted)
    codes = chosen.select(F.col("adm4").alias("requested_adm4"))
    return parse_documents(
        documents.join(codes, "requested_adm4", "left_semi"), chosen, settings=settings
    ).drop("reject_reasons")


def console_envelopes(records: DataFrame, as_of: datetime) -> DataFrame:
    """Envelopes per location, those of points without a location code included."""
    return json_envelopes(records, "adm4", as_of, "console")
