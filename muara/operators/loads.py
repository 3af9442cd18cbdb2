"""Load modes over snapshot tables: refresh, append, upsert, insert-ignore, delete, update."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muara.sources.snapshots import Marks, SnapshotTable, in_partitions


class NullKeys(ValueError):
    """A batch for a load by key has rows without a key; nothing was loaded."""


def full_refresh(table: SnapshotTable, source: DataFrame) -> int:
    """Replace everything; an empty source empties the table, a failed one leaves the old rows."""
    return table.replace(source)


def refresh_keep_if_empty(table: SnapshotTable, source: DataFrame) -> int:
    """Replace everything unless the source has no rows."""
    if source.isEmpty():
        return 0
    return table.replace(source)


def append_load(table: SnapshotTable, rows: DataFrame) -> int:
    return table.append(rows)


def aligned(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Rows with the target's columns in the target's order and types; missing ones are null."""
    shaped = target.limit(0).unionByName(rows, allowMissingColumns=True)
    extra = [c for c in shaped.columns if c not in target.columns]
    if extra:
        raise ValueError(f"target has no column {', '.join(extra)}")
    return shaped


def with_created_at(rows: DataFrame, as_of: Column) -> DataFrame:
    """The extra load stamp of a cloned table; a source column of that name is kept."""
    return rows if "created_at" in rows.columns else rows.withColumn("created_at", as_of)


def latest_per_key(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    seq: str,
    first_kept: Sequence[str] = (),
) -> DataFrame:
    """State after applying the batch row by row: the last row of a key wins, ``first_kept`` columns come
    from the row that created the key. Keys are not null, and unique in ``existing``.

    The batch is reduced to one row per key by an aggregation, not a window, so copies of a key collapse
    before the shuffle. Then both sides of the join have unique keys and cannot be skewed.
    """
    columns = existing.columns
    last_kept = [c for c in columns if c not in keys and c not in first_kept]
    picked = [F.max_by(F.struct(*last_kept), seq).alias("newest")]
    if first_kept:
        picked.append(F.min_by(F.struct(*first_kept), seq).alias("oldest"))
    changes = batch.groupBy(*keys).agg(*picked)
    merged = existing.withColumn("known", F.lit(True)).join(changes, list(keys), "full_outer")
    value = {c: F.col(c) for c in keys}
    for c in last_kept:
        value[c] = F.when(F.col("newest").isNotNull(), F.col(f"newest.{c}")).otherwise(F.col(c))
    for c in first_kept:
        value[c] = F.when(F.col("known"), F.col(c)).otherwise(F.col(f"oldest.{c}"))
    return merged.select(*[value[c].alias(c) for c in columns])


def partition_values(rows: DataFrame, column: str) -> list[object]:
    """Distinct partition values, one per calendar date a load touches."""
    return [r[0] for r in rows.select(column).distinct().collect()]


def batch_facts(batch: DataFrame, keys: Sequence[str], partition_by: str | None) -> list[object]:
    """The partitions a batch touches, from one scan that also refuses rows without a key."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    by = [partition_by] if partition_by else []
    found = batch.groupBy(*by).agg(F.count_if(missing).alias("missing_")).collect()
    without = sum(r["missing_"] for r in found)
    if without:
        raise NullKeys(f"{without} rows have no {' or no '.join(keys)}")
    return [r[0] for r in found] if by else []


def holding(existing: DataFrame, batch: DataFrame, keys: Sequence[str], partition_by: str) -> list[object]:
    """Partitions that hold a row of one of the batch's keys, wherever the batch would put it.

    Only the keys and the partition are read. The batch's keys are the build side: Spark broadcasts them or their
    Bloom filter while they are small, so the target's keys are not shuffled.
    """
    wanted = batch.select(*keys).distinct()
    met = existing.select(*keys, partition_by).join(wanted, list(keys), "left_semi")
    return [r[0] for r in met.select(partition_by).distinct().collect()]


def upsert(
    table: SnapshotTable,
    batch: DataFrame,
    keys: Sequence[str],
    seq: str,
    first_kept: Sequence[str] = (),
    stream: tuple[str, int] | None = None,
    partition_follows: bool = False,
    marks: Marks | None = None,
) -> None:
    """Insert or update by key; a key may move to another partition, and is gone from the one it was in.

    Partitions that hold a key of the batch are rewritten, rows of new keys come to the others as they are. With
    ``partition_follows`` the partition is known to be the same for every row of a key, and the partitions of the
    batch are all there is to look at; this spares a scan of the target's keys. A batch with a null key is refused.

    The batch is scanned more than once (keys and dates, then merge), so stage one that is costly to compute. A
    ``stream`` mark (name, batch id) makes a repeated micro-batch a no-op.
    """
    base = table.state()
    if stream and base["streams"].get(stream[0], -1) >= stream[1]:
        return
    existing = table.read(base)
    touched = batch_facts(batch, keys, table.partition_by)
    if table.partition_by is None:
        merged = latest_per_key(existing, batch, keys, seq, first_kept)
        table.replace(merged, base, stream, marks=marks)
        return
    if not partition_follows:
        touched = holding(existing, batch, keys, table.partition_by)
    existing = existing.where(in_partitions(table.partition_by, touched))
    # The partition is no join key: it comes with the last row, and a null one would not match itself.
    merged = latest_per_key(existing, batch, keys, seq, first_kept)
    table.replace_partitions(merged, touched, base, stream, marks=marks)


def insert_ignore(
    table: SnapshotTable, batch: DataFrame, keys: Sequence[str], seq: str, partition_follows: bool = False
) -> int:
    """Add keys the table does not have; the first row of a key wins. Returns the rows added.

    A load by another writer in between is a conflict, so no key comes twice. As in a database, a null key conflicts
    with nothing and is added each time. With ``partition_follows`` (see ``upsert``) only the batch's partitions are
    looked through.
    """
    base = table.state()
    known = table.read(base)
    columns = [c for c in known.columns if c not in keys]
    first = batch.groupBy(*keys).agg(F.min_by(F.struct(*columns), seq).alias("first"))
    new = first.select(*keys, *[F.col(f"first.{c}").alias(c) for c in columns])
    if table.partition_by and partition_follows:
        known = known.where(in_partitions(table.partition_by, partition_values(batch, table.partition_by)))
    fresh = new.join(known.select(*keys), list(keys), "left_anti")
    return table.append(fresh.select(*known.columns), base=base)


def upsert_counters(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """inserted, updated and total rows of an upsert: one key-level aggregation, no join."""
    seen = existing.select(*keys, F.lit(1).alias("old"), F.lit(0).alias("new"))
    coming = batch.select(*keys, F.lit(0).alias("old"), F.lit(1).alias("new"))
    per_key = seen.unionByName(coming).groupBy(*keys).agg(
        F.max("old").alias("old"), F.sum("new").alias("new")
    )
    inserted = F.count_if((F.col("old") == 0) & (F.col("new") > 0))
    total = F.coalesce(F.sum("new"), F.lit(0))
    return per_key.agg(
        inserted.alias("inserted"), (total - inserted).alias("updated"), total.alias("total")
    )


def dedup_keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the least by ``order``; rows equal in key and order count as copies."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = F.struct(*order, *rest)
    kept = rows.groupBy(*keys).agg(F.min(best).alias("best"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"best.{c}").alias(c) for c in rows.columns])


def dedup_exact(rows: DataFrame) -> DataFrame:
    return rows.distinct()


def delete_where(
    table: SnapshotTable, doomed: Column, base: dict | None = None, stream: tuple[str, int] | None = None
) -> int:
    """Delete rows for which ``doomed`` is true; null keeps the row. Returns the rows deleted.

    Only the rows to go are looked for, so the condition reaches the scan; how many a partition holds stands in the
    commit. Partitions with no such row are listed again, partitions with nothing else are dropped, the rest are
    rewritten, and the rewrite must write exactly what is left.
    """
    base = base or table.state()
    rows = table.read(base)
    total = table.partition_rows(base)
    left = rows.where(~F.coalesce(doomed, F.lit(False)))
    date = table.partition_by
    if date is None:
        deleted = rows.where(doomed).count()
        if deleted:
            table.replace(left, base, stream, sum(total.values()) - deleted)
        return deleted
    gone = {r[date]: r["count"] for r in rows.where(doomed).groupBy(date).count().collect()}
    partial = [v for v, n in gone.items() if n < total[v]]
    if partial:
        expected = sum(total[v] - gone[v] for v in partial)
        table.replace_partitions(left.where(in_partitions(date, partial)), gone, base, stream, expected)
    elif gone:
        table.drop_partitions(gone, base, stream)
    return sum(gone.values())


def update_where(table: SnapshotTable, hit: Column, changes: dict[str, Column]) -> int:
    """Set columns on the rows for which ``hit`` is true, from their old values; returns the rows set.

    Only partitions with such a row are rewritten, with as many rows as they had.
    """
    base = table.state()
    rows = table.read(base)
    total = table.partition_rows(base)
    is_hit = F.coalesce(hit, F.lit(False))

    def changed(scope: DataFrame) -> DataFrame:
        return scope.select(
            *[
                F.when(is_hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
                for c in rows.columns
            ]
        )

    date = table.partition_by
    if date is None:
        updated = rows.where(hit).count()
        if updated:
            table.replace(changed(rows), base, expected=sum(total.values()))
        return updated
    touched = {r[date]: r["count"] for r in rows.where(hit).groupBy(date).count().collect()}
    if touched:
        expected = sum(total[v] for v in touched)
        table.replace_partitions(changed(rows.where(in_partitions(date, touched))), touched, base, expected=expected)
    return sum(touched.values())


def archive_by_year(
    table: SnapshotTable, archive: SnapshotTable, column: str, before_year: int, day: str | None = None
) -> None:
    """Move rows of earlier years to the archive table, which several tables of one schema may share.

    One state of the table is copied and then deleted from. The archive remembers the table's id and the version it
    copied, the table the version it deleted. A copy whose delete never came is used when the table still is as it
    was, and else withdrawn in the commit of the new copy, so no row is lost or doubled. ``day`` names a column that
    holds the date of ``column``, as the partition may; days of later years are then not opened.
    """
    old = F.col(column) < F.lit(date(before_year, 1, 1))  # a bare comparison, which reaches the scan
    if day:
        old = old & (F.col(day) < F.lit(date(before_year, 1, 1)))
    base = table.state()
    archive.create_if_absent(T.StructType.fromJson(base["schema"]))
    held = archive.state()
    name, version = f"archive:{base['table_id']}", base["version"]
    copied, deleted = held["streams"].get(name, -1), base["streams"].get(f"archived:{held['table_id']}", -1)
    if copied != version:
        pending = held["copies"].get(name, ()) if copied > deleted else ()
        archive.append(table.read(base).where(old), (name, version), held, pending)
    delete_where(table, old, base, (f"archived:{held['table_id']}", version))
