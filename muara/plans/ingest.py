"""The forecast job: landed documents to the fact table, then checks, labels and retention."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muara.functions.clock import at
from muara.operators.forecast import parse_documents, rejected_documents, rejected_points, valid_points
from muara.operators.freshness import apply_retention, delete_expired, refresh_row_labels
from muara.operators.loads import holding, partition_values, upsert, upsert_counters
from muara.operators.quality import CheckFailed, require_rows
from muara.schemas import FORECAST_FACT
from muara.settings import DEFAULTS, Settings
from muara.sources.documents import read_documents
from muara.sources.ledger import FileLedger
from muara.sources.snapshots import SnapshotTable, Warehouse, in_partitions
from muara.sources.tables import staged

FACT_KEYS = ("adm4", "waktu")
PARTITION = "waktu_date"
#: The other layout: by the date on which a row first came, which no later load changes.
CREATED = "created_date"


@dataclass(frozen=True)
class IngestOptions:
    """``convert`` mode with fallbacks, reset labels and expiry is the script's behaviour; ``wallclock``
    without them is the hourly job's."""

    mode: str = "convert"
    adm4_from_request: bool = True
    reset_freshness: bool = False
    delete_past: bool = False


def fact_schema(by: str = PARTITION) -> T.StructType:
    return T.StructType([f for f in FORECAST_FACT.fields if f.name != PARTITION] + [T.StructField(by, T.DateType())])


def fact_table(warehouse: Warehouse, name: str = "fact_weather_hourly", by: str = PARTITION) -> SnapshotTable:
    """The fact by the date of its points, or with ``by=CREATED`` by the date on which they first came.

    By points, a load and the expiry open the dates they touch, labels and retention every date. By creation, labels
    open the last days and retention the oldest, which it drops whole; a load looks for its keys in every day.
    """
    table = warehouse.table(name, by)
    table.create_if_absent(fact_schema(by))
    return table


def fact_rows(points: DataFrame, as_of: datetime, reset_freshness: bool, by: str = PARTITION) -> DataFrame:
    """Valid points as fact rows stamped with the load clock; ``seq`` rides along for the upsert."""
    age = F.lit(0.0 if reset_freshness else None).cast("double")
    label = F.lit("FRESH" if reset_freshness else None).cast("string")
    stamped = points.withColumns(
        {
            "created_at": at(as_of),
            "last_updated": at(as_of),
            "data_age_minutes": age,
            "freshness_status": label,
            PARTITION: F.col("waktu").cast("date"),
            CREATED: F.lit(as_of.date()),
        }
    )
    return stamped.select(*fact_schema(by).names, "seq")


def ingest_documents(
    table: SnapshotTable,
    documents: DataFrame,
    as_of: datetime,
    locations: DataFrame | None = None,
    options: IngestOptions = IngestOptions(),
    quarantine: SnapshotTable | None = None,
    stream: tuple[str, int] | None = None,
    settings: Settings = DEFAULTS,
) -> dict[str, int]:
    """Parse, split off rejects, upsert. Returns inserted, updated, total and rejected counts.

    Good rows are always kept; rejects go to ``quarantine`` when one is given. With a ``stream`` mark a
    repeated micro-batch changes nothing. Quarantine, expiry (``delete_past``) and upsert are commits of their own,
    in this order: without a mark, a run that failed between them and is repeated quarantines its rejects again.
    """
    if stream and table.state()["streams"].get(stream[0], -1) >= stream[1]:
        return {"inserted": 0, "updated": 0, "total": 0, "rejected": 0}
    points = parse_documents(documents, locations, options.mode, options.adm4_from_request, settings)
    by, follows = table.partition_by, table.partition_by == PARTITION
    with staged(points, "points") as points:
        batch = fact_rows(valid_points(points), as_of, options.reset_freshness, by)
        bad = rejected_points(points)
        if quarantine is not None:
            quarantine.create_if_absent(_quarantined(bad).schema)
            quarantine.append(_quarantined(bad).unionByName(_quarantined_documents(documents)), stream)
        if options.delete_past:
            delete_expired(table, as_of, day=PARTITION if follows else None)
        known = table.read()
        touched = partition_values(batch, by) if follows else holding(known, batch, FACT_KEYS, by)
        counters = upsert_counters(known.where(in_partitions(by, touched)), batch, FACT_KEYS).first().asDict()
        kept = ["created_at", "data_age_minutes", *([] if follows else [by])]
        if not options.reset_freshness:
            kept.append("freshness_status")
        upsert(table, batch, FACT_KEYS, "seq", kept, stream, partition_follows=follows)
        return {**counters, "rejected": bad.count()}


def require_change(counters: dict[str, int]) -> None:
    """A run that changed no row fails."""
    if counters["total"] == 0:
        raise CheckFailed("no forecast rows were inserted or updated")


def hourly_run(
    table: SnapshotTable,
    documents: DataFrame,
    as_of: datetime,
    locations: DataFrame | None = None,
    options: IngestOptions = IngestOptions(mode="wallclock", adm4_from_request=False),
    quarantine: SnapshotTable | None = None,
    settings: Settings = DEFAULTS,
) -> dict[str, int]:
    """Ingest, verify, label, clean up, in that order; returns the counts of every step."""
    counters = ingest_documents(
        table, documents, as_of, locations, options, quarantine, settings=settings
    )
    require_change(counters)
    require_rows(table.read(), "fact_weather_hourly")
    return {**counters, **upkeep(table, as_of, settings)}


def upkeep(table: SnapshotTable, as_of: datetime, settings: Settings = DEFAULTS) -> dict[str, int]:
    """Label the new rows and delete the old ones; a fact by creation date opens only the days of these."""
    day = CREATED if table.partition_by == CREATED else None
    labelled = refresh_row_labels(table, as_of, settings, day)
    return {"labelled": labelled, "deleted": apply_retention(table, as_of, settings, day)}


def ingest_landed(
    table: SnapshotTable,
    landing: str,
    ledger: FileLedger,
    as_of: datetime,
    locations: DataFrame | None = None,
    options: IngestOptions = IngestOptions(),
    quarantine: SnapshotTable | None = None,
    name: str = "landing",
    settings: Settings = DEFAULTS,
) -> dict[str, int]:
    """Ingest the landed files that no run has read; a repeated run reads nothing and changes nothing.

    Claims whose load failed come first, each with its own files. Returns the counts, and how many files were read.
    """
    total = {"inserted": 0, "updated": 0, "total": 0, "rejected": 0, "files": 0}
    pending = ledger.claims_after(table.state()["streams"].get(name, 0))
    new = ledger.claim_new(landing)
    for claim in [*pending, *([new] if new else [])]:
        paths = ledger.paths(claim)
        documents = read_documents(table.spark, paths)
        counts = ingest_documents(table, documents, as_of, locations, options, quarantine, (name, claim), settings)
        total = {k: n + counts.get(k, len(paths)) for k, n in total.items()}
    return total


def landed_run(
    table: SnapshotTable,
    landing: str,
    ledger: FileLedger,
    as_of: datetime,
    locations: DataFrame | None = None,
    options: IngestOptions = IngestOptions(mode="wallclock", adm4_from_request=False),
    quarantine: SnapshotTable | None = None,
    settings: Settings = DEFAULTS,
) -> dict[str, int]:
    """``hourly_run`` over a landing folder. A run that finds new files but changes no row fails; one that finds none
    only labels and cleans up."""
    counters = ingest_landed(table, landing, ledger, as_of, locations, options, quarantine, settings=settings)
    if counters["files"]:
        require_change(counters)
    require_rows(table.read(), "fact_weather_hourly")
    return {**counters, **upkeep(table, as_of, settings)}


def _quarantined(bad: DataFrame) -> DataFrame:
    return bad.select(
        "adm4",
        "datetime_text",
        F.array_join("reject_reasons", ",").alias("reason"),
        F.lit(None).cast("string").alias("doc"),
    )


def _quarantined_documents(documents: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return rejected_documents(documents).select(
        nothing.alias("adm4"), nothing.alias("datetime_text"), "reason", "doc"
    )
