"""Marts that follow their source tables: only the dates that loads have changed are computed again."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muara.plans import marts
from muara.sources.snapshots import SnapshotTable, in_partitions

Grain = Callable[[date], date]


def same_day(value: date) -> date:
    return value


def month_start(value: date) -> date:
    return value.replace(day=1)


def follow(
    mart: SnapshotTable,
    sources: dict[str, SnapshotTable],
    build: Callable[[dict[str, DataFrame]], DataFrame],
    grain: Grain = same_day,
) -> list[date | None]:
    """Bring a mart up to date with its sources; returns the mart dates that were computed again.

    ``build`` makes mart rows from the sources by name, and a mart date's rows come from the source partitions that
    ``grain`` maps to it and from no others. The mart's commit says which version of each source it has seen; the
    folders that differ since then tell the changed dates, without reading a row. Then only the partitions of these
    dates are listed, read and replaced. A date whose source rows are all gone leaves the mart.

    All is computed anew the first time, when a source is another table than before or unpartitioned and changed, and
    when the version last seen is no longer kept. Rows without a date make the mart's partition without a date.
    """
    if not mart.partition_by:
        raise ValueError(f"{mart.root} follows by date, so it needs a date partition")
    grained = lambda value: value and grain(value)
    base = mart.state()
    now = {name: table.state() for name, table in sources.items()}
    seen = {name: f"{state['table_id']}:{state['version']}" for name, state in now.items()}
    stale: set[date | None] | None = set()
    for name, table in sources.items():
        told = base["marks"].get(f"seen:{name}") or ":"
        if told == seen[name]:
            continue
        values = _changed(table, told, now[name])
        stale = None if values is None or stale is None else stale | {grained(v) for v in values}
    if stale is not None and not stale and base["version"]:
        return []
    marks = {f"seen:{name}": mark for name, mark in seen.items()}
    if stale is None or not base["version"]:
        rows = build({name: table.read(now[name]) for name, table in sources.items()})
        mart.replace(rows, base, marks=marks)
        return sorted(mart.partition_rows(mart.state()), key=str)
    frames = {}
    for name, table in sources.items():
        held = table.partition_rows(now[name]) if table.partition_by else None
        frames[name] = table.read(now[name], held and [v for v in held if grained(v) in stale])
    rows = build(frames).where(in_partitions(mart.partition_by, stale))
    mart.replace_partitions(rows, stale, base, marks=marks)
    return sorted(stale, key=str)


def _changed(table: SnapshotTable, told: str, now: dict) -> list[date | None] | None:
    """The partitions changed since the version in ``told``; none means that only a full read is safe."""
    table_id, version = told.split(":")
    if table_id != now["table_id"] or not table.partition_by:
        return None
    try:
        return table.changed_partitions(table.state(int(version)), now)
    except FileNotFoundError:
        return None


# ---------------------------------------------------------------- the marts

# Each mart is partitioned by its day, or by a column of its own that then holds the start of the day's month; months
# are better where a day's rows do not fill a file. Sources may be partitioned by day or month, not more finely named.


def _stored(mart: SnapshotTable, rows: DataFrame, day: str) -> DataFrame:
    return rows if mart.partition_by == day else rows.withColumn(mart.partition_by, F.trunc(day, "month"))


def _grain(mart: SnapshotTable, day: str) -> Grain:
    return same_day if mart.partition_by == day else month_start


def follow_daily_summary(mart: SnapshotTable, fact: SnapshotTable) -> list[date | None]:
    """``marts.daily_summary`` of a fact partitioned by the date of ``waktu``."""
    day = "summary_date"
    return follow(mart, {"fact": fact}, lambda rows: _stored(mart, marts.daily_summary(rows["fact"]), day), _grain(mart, day))


def follow_kpi_daily(mart: SnapshotTable, orders: SnapshotTable, trips: SnapshotTable, stamp: str) -> list[date | None]:
    """``marts.kpi_daily`` of orders partitioned by the date of ``stamp`` and trips by that of the delivery."""

    def build(rows: dict[str, DataFrame]) -> DataFrame:
        return _stored(mart, marts.kpi_daily(marts.orders_per_day(rows["orders"], stamp), rows["trips"]), "kpi_date")

    return follow(mart, {"orders": orders, "trips": trips}, build, _grain(mart, "kpi_date"))


def follow_driver_monthly(mart: SnapshotTable, trips: SnapshotTable, best_rating: float | None = None) -> list[date | None]:
    """``marts.driver_monthly`` by ``metric_month``: a changed day computes its month again."""
    return follow(mart, {"trips": trips}, lambda rows: marts.driver_monthly(rows["trips"], best_rating), month_start)


def follow_kpi_sketches(mart: SnapshotTable, trips: SnapshotTable) -> list[date | None]:
    """``marts.kpi_sketches`` of trips partitioned by the date of the delivery."""
    return follow(mart, {"trips": trips}, lambda rows: _stored(mart, marts.kpi_sketches(rows["trips"]), "kpi_date"), _grain(mart, "kpi_date"))


#: Periods that whole months make up.
PERIODS: dict[str, Grain] = {
    "month": month_start,
    "quarter": lambda value: value.replace(month=value.month - (value.month - 1) % 3, day=1),
    "year": lambda value: value.replace(month=1, day=1),
}


def follow_kpi_periods(mart: SnapshotTable, sketches: SnapshotTable, period: str = "month") -> list[date | None]:
    """``marts.kpi_from_sketches`` by ``period_start`` from the stored days: no trip is read."""
    return follow(mart, {"sketches": sketches}, lambda rows: marts.kpi_from_sketches(rows["sketches"], period), PERIODS[period])


def store_trips(table: SnapshotTable, trips: DataFrame) -> int:
    """More trips of ``marts.deliveries`` for a fact by ``delivery_date`` or by its month, see above."""
    rows = _stored(table, trips, "delivery_date")
    return table.append(rows) if table.exists() else table.replace(rows)
