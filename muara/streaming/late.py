"""Dedup by key that keeps the rows that come too late, beside the table and not in it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from muara.functions.clock import at
from muara.settings import DEFAULTS, Settings
from muara.sources.snapshots import SnapshotTable
from muara.sources.tables import staged
from muara.streaming.jobs import start

#: Partition of the kept table: the date of the stamp.
DAY = "stamp_date"


def kept_and_late_stream(
    rows: DataFrame,
    keys: list[str],
    stamp: str,
    kept: SnapshotTable,
    late: SnapshotTable,
    checkpoint: str,
    name: str = "kept",
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Every landed row goes to ``late`` when it is behind the watermark, and else to ``kept`` once per key.

    The watermark is ``retention_days`` behind the newest stamp of the micro-batches before, and stands in the commit
    of ``kept`` with the rows it belongs to, so a restart finds both. A repeat of a kept key within that time is
    dropped; ``repeats`` in the commit counts them: kept + late + repeats = landed. Rows without a stamp are never
    late; keys compare with null equal to null. ``kept`` is partitioned by ``DAY``, and only the dates after the
    watermark are looked through for repeats.
    """
    delay = timedelta(days=settings.retention_days)

    def apply(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn(DAY, F.col(stamp).cast("date"))
        kept.create_if_absent(dated.schema)
        base = kept.state()
        if base["streams"].get(name, -1) >= batch_id:
            return
        newest = base["marks"].get("newest")
        edge = newest and datetime.fromisoformat(newest) - delay
        behind = F.coalesce(F.col(stamp) < at(edge), F.lit(False)) if edge else F.lit(False)
        with staged(dated.withColumn("late_", behind), "lot") as lot:
            late.create_if_absent(batch.schema)
            late.append(lot.where("late_").drop("late_", DAY), stream=(name, batch_id))
            on_time = lot.where("not late_").drop("late_")
            rest = [c for c in on_time.columns if c not in keys]
            first = on_time.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(F.col(stamp).isNull(), stamp)).alias("first_"))
            first = first.select(*keys, *[F.col(f"first_.{c}").alias(c) for c in rest])
            known = kept.read(base)
            if edge:
                known = known.where((F.col(DAY) >= F.lit(edge.date())) | F.col(DAY).isNull())
            same = [F.col(f"n.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys]
            fresh = first.alias("n").join(known.select(*keys).alias("k"), same, "left_anti")
            seen = on_time.agg(F.max(stamp).cast("string").alias("newest"), F.count(F.lit(1)).alias("rows")).first()
            marks = {"newest": max(filter(None, (newest, seen["newest"])), default=None)}
            marks["repeats"] = lambda written: str(int(base["marks"].get("repeats") or 0) + seen["rows"] - written)
            kept.append(fresh.select(*dated.columns), (name, batch_id), base, marks=marks)

    return start(rows.writeStream.foreachBatch(apply), checkpoint)


def balance(kept: SnapshotTable, late: SnapshotTable) -> dict[str, int]:
    """Rows kept, late and repeated so far, from the commits."""
    state = kept.state()
    return {
        "kept": sum(f["rows"] for f in state["folders"]),
        "late": sum(f["rows"] for f in late.state()["folders"]),
        "repeats": int(state["marks"].get("repeats") or 0),
    }
