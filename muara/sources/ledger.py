"""Which landed files have been read: batch runs take each file once, whatever fails in between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muara.sources.snapshots import SnapshotTable

SCHEMA = T.StructType(
    [
        T.StructField("claim", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("bytes", T.LongType()),
    ]
)


class FileLedger:
    """A table of files by claim. New files are first claimed together, in one commit, and then loaded under the
    claim's number, which the target's commit holds as its mark. So a load that failed is taken up again with the very
    files of its claim, and one that was committed is not repeated. One run at a time claims; two are a conflict."""

    def __init__(self, table: SnapshotTable):
        self.table = table
        table.create_if_absent(SCHEMA)

    def files(self, claim: int | None = None) -> DataFrame:
        rows = self.table.read()
        return rows if claim is None else rows.where(F.col("claim") == claim)

    def claims_after(self, applied: int) -> list[int]:
        """Claims that the target has not applied, in order."""
        rows = self.files().where(F.col("claim") > applied).select("claim").distinct()
        return sorted(r["claim"] for r in rows.collect())

    def listed(self, folder: str) -> DataFrame:
        """Files below a folder or a pattern; only the listing is read. A file that was written again is a new one."""
        found = self.table.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        return found.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))

    def claim_new(self, folder: str) -> int | None:
        """Claim the files that are in no claim; none when there is nothing new."""
        base = self.table.state()
        known = self.table.read(base).select("path", "modified", "bytes")
        fresh = self.listed(folder).join(known, ["path", "modified", "bytes"], "left_anti")
        number = base["version"] + 1
        if fresh.isEmpty():
            return None
        self.table.append(fresh.select(F.lit(number).cast("bigint").alias("claim"), "path", "modified", "bytes"), base=base)
        return number

    def paths(self, claim: int) -> list[str]:
        """The files of a claim, to be read by name."""
        return [r["path"] for r in self.files(claim).select("path").orderBy("path").collect()]
