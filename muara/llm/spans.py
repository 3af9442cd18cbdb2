"""Places of pattern matches in whole texts, by built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def characters(text: Column) -> Column:
    """The code points of a text as an array."""
    return F.split(text, r"(?!^)(?!\z)")


def matches_of(text: Column, kind: str, pattern: str, guard: str | None = None) -> Column:
    """The leftmost non-overlapping matches as ``array<struct<kind, nr, gap, size, found>>``; none: empty.

    ``gap`` is the number of code points since the match before. ``guard`` is a cheaper pattern that every text
    with a match has.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    rows = F.transform(
        found,
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("nr"), F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("size"), m.alias("found")
        ),
    )
    none = F.array().cast("array<struct<kind:string,nr:int,gap:int,size:int,found:string>>")
    return F.when(text.rlike(guard or pattern), rows).otherwise(none)


def placed(rows: DataFrame, key: str, matches: str) -> DataFrame:
    """One row per match with ``start`` and ``stop`` in code points, from a column of ``matches_of`` arrays."""
    each = rows.select("*", F.inline(matches)).drop(matches)
    before = Window.partitionBy(key, "kind").orderBy("nr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("gap") + F.col("size")).over(before)
    return each.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("size")).drop("nr", "gap")
