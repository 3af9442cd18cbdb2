"""Connected components of a graph given by its links, as rounds of joins over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muara.llm.common import write_table


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that each linked node reaches.

    Large-star and small-star steps alternate: every node hangs its larger neighbours, then its smaller ones, on
    the smallest node it knows. The number of links never grows; rounds are about the logarithm of the longest path.
    A round's rows are written down, so a lost executor repeats one round. No links: no rows.
    """
    pairs = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("high > low").distinct()
    pairs = write_table(pairs, "component-links")
    state = _state(pairs)
    while True:
        both = pairs.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            pairs.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
        star = both.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))
        star = star.where("high > low").distinct()
        down = star.groupBy("high").agg(F.min("low").alias("least"))
        joined = star.join(down, "high").select("high", "low", "least")
        small = joined.where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        pairs = write_table(
            small.unionByName(down.select("high", F.col("least").alias("low"))).where("high > low").distinct(), "component-links"
        )
        now = _state(pairs)
        if now == state:
            break
        state = now
    # At rest every node but the smallest of its component hangs on that smallest one.
    own = pairs.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(own)


def _state(pairs: DataFrame) -> tuple:
    """Count and checksum; the links no longer change once they stay the same."""
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())
