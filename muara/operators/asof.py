"""As-of join: for each left row the newest right row of the same key at or before its time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muara.sources.tables import stage


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_at: str,
    right_at: str,
    right_columns: list[str],
    tie: str,
    slices: int | None = None,
) -> DataFrame:
    """Left rows plus ``right_columns`` of the match, null where there is none.

    ``tie`` is a unique right column; of two right rows with one time the larger ``tie`` is the newest.

    Both sides are cut into slices of about equal size by (key, time), so a key that holds much of the data
    spreads over many slices. Inside a slice a running ``last`` finds the match. A slice that starts in the
    middle of a key takes the match from the slices before it: that carry has at most one row per slice, and the
    filled rows are dealt out by slice and key already, so the join moves none of them. Rows without a time match
    nothing. The slices are written down, which keeps slice numbers the same when a task
    runs again; a ``session.scratch`` block around the join and its use deletes them. There are as many as shuffle
    partitions unless ``slices`` says otherwise.
    """
    match = F.struct(*right_columns)
    lefts = left.select(
        F.col(key).alias("k"),
        F.col(left_at).alias("at"),
        F.lit(1).alias("side"),
        F.lit(None).cast(right.schema[tie].dataType).alias("tie"),
        F.struct(*left.columns).alias("l"),
    )
    rights = right.select(
        F.col(key).alias("k"),
        F.col(right_at).alias("at"),
        F.lit(0).alias("side"),
        F.col(tie).alias("tie"),
        match.alias("r"),
    )
    both = lefts.unionByName(rights.where("k is not null and at is not null"), allowMissingColumns=True)
    # Hash and row number only spread rows of one moment, and copies of one row, over slices.
    spread = both.withColumns({"hash": F.xxhash64("l", "r"), "copy": F.monotonically_increasing_id()})
    sliced = stage(
        spread.repartitionByRange(*([slices] if slices else []), "k", "at", "side", "tie", "hash", "copy")
        .withColumn("slice", F.spark_partition_id())
        .drop("hash", "copy"),
        "asof",
    )
    here = Window.partitionBy("slice", "k").orderBy("at", "side", "tie")
    filled = sliced.withColumn(
        "m",
        F.last("r", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    ).where("side = 1")
    found = filled.join(_carry(sliced), ["slice", "k"], "left").withColumn(
        "m", F.coalesce("m", "carried")
    )
    return found.select("l.*", *[F.col(f"m.{c}").alias(f"right_{c}") for c in right_columns])


def _carry(sliced: DataFrame) -> DataFrame:
    """Newest match before a slice, for keys that the slice continues: one key per slice at most."""
    newest = F.max_by("r", F.when(F.col("side") == 0, F.struct("at", "tie")))
    ends = sliced.groupBy("k", "slice").agg(newest.alias("last_r"))
    before = Window.partitionBy("k").orderBy("slice")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ends.withColumn("carried", F.last("last_r", ignorenulls=True).over(earlier))
        .withColumn("first", F.min("slice").over(before))
        .where("slice > first")
        .select("slice", "k", "carried")
    )
