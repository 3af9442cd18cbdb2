"""Content reconciliation of two large tables: checksums of key ranges first, rows of the differing ranges only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A range is a run of hash bits of the key; each of the two levels tells 2 ** BITS ranges apart.
BITS = 12


def digest(columns: Sequence[str], seed: int) -> Column:
    """A 64-bit hash in which a null is a value of its own; Spark's hash passes nulls over."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *[F.col(f"`{c}`") for c in columns])


def checksums(rows: DataFrame, columns: Sequence[str], ranges: Column) -> DataFrame:
    """Rows of each range and sums of two hashes of the rows, whose order and number of copies do and do not matter.

    Hashes are added up in halves, so no sum overflows below 2 ** 31 rows of a range.
    """
    halves = []
    for k in (1, 2):
        h = digest(columns, k)
        halves += [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"low{k}"), F.sum(F.shiftrightunsigned(h, 32)).alias(f"high{k}")]
    return rows.groupBy(ranges.alias("range_")).agg(F.count(F.lit(1)).alias("rows_"), *halves)


def differing_ranges(source: DataFrame, target: DataFrame, columns: Sequence[str], ranges: Column) -> DataFrame:
    """Ranges whose checksums are not the same on both sides; each side is reduced before it is shuffled."""
    sides = [checksums(side, columns, ranges) for side in (source, target)]
    both = sides[0].join(sides[1].toDF(*[f"{c}_t" for c in sides[1].columns]), F.col("range_") == F.col("range__t"), "full_outer")
    same = F.lit(True)
    for column in sides[0].columns[1:]:
        same = same & F.col(column).eqNullSafe(F.col(f"{column}_t"))
    return both.where(~same).select(F.coalesce("range_", "range__t").alias("range_"))


def suspects(source: DataFrame, target: DataFrame, keys: Sequence[str], bits: int = BITS) -> list[DataFrame]:
    """The rows of both sides in ranges that differ, found in two levels; no rows where nothing differs.

    At most 2 ** bits numbers of ranges come to the driver. The second level is a join with the ranges it finds.
    """
    columns, place = source.columns, digest(keys, 0)
    coarse, fine = (place.bitwiseAND(F.lit(2**n - 1)) for n in (bits, 2 * bits))
    first = [r[0] for r in differing_ranges(source, target, columns, coarse).collect()]
    if not first:
        return [side.limit(0) for side in (source, target)]
    sides = [side if len(first) == 2**bits else side.where(coarse.isin(first)) for side in (source, target)]
    second = differing_ranges(*sides, columns, fine)
    return [side.join(second, fine == F.col("range_"), "left_semi") for side in sides]


def content_differences(source: DataFrame, target: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """Rows that one side has more often than the other: the columns, ``side`` and the surplus ``copies``.

    ``keys`` only decide which range a row belongs to; they need not be unique and may be null. Both sides have the
    same columns and types, none of them a map. Nulls are equal to nulls. Both tables are read up to three times, with
    few rows past the first; whole rows are shuffled only from ranges that differ.
    """
    kinds = [{f.name: f.dataType for f in side.schema.fields} for side in (source, target)]
    if kinds[0] != kinds[1]:
        raise ValueError(f"cannot compare {source.schema.simpleString()} with {target.schema.simpleString()}")
    mine, other = suspects(source, target.select(*[f"`{c}`" for c in source.columns]), keys, bits)
    columns = [F.col(f"`{c}`") for c in source.columns]
    both = mine.select(*columns, F.lit(1).alias("copies")).unionByName(other.select(*columns, F.lit(-1).alias("copies")))
    net = both.groupBy(*columns).agg(F.sum("copies").alias("copies")).where("copies <> 0")
    side = F.when(F.col("copies") > 0, "source").otherwise("target")
    return net.select(*columns, side.alias("side"), F.abs("copies").alias("copies"))
