"""Parquet tables that are replaced as a whole: every load writes new folders, then one small commit file.

Plain Parquet has no transactions, and a plan cannot overwrite the files it reads. So a load writes
``data/load_id=<id>/[<date>=..]`` and becomes visible by the commit file that lists the folders of the new
version. A failed load leaves no commit file, so readers keep the old rows. Partitions a load does not touch
are listed again, not copied. The list holds one entry per date partition and load, never one per row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_ID = "load_id"
#: Commit files kept for readers that hold an older version.
COMMITS_KEPT = 50


#: Texts of a commit by name; a function gets the number of rows written and gives the text.
Marks = dict[str, str | None | Callable[[int], str | None]]


class CommitConflict(RuntimeError):
    """Another load committed first; read again and retry."""


class RowsLost(RuntimeError):
    """A rewrite did not write the rows it had to; nothing was committed."""


def in_partitions(column: str, values: Iterable[date | None]) -> Column:
    """True for rows of these partitions, the null one included where it is among them."""
    values = list(values)
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


class SnapshotTable:
    """``partition_by`` names a date column. ``rows_per_file`` bounds the rows of a written file."""

    def __init__(self, spark: SparkSession, root: str, partition_by: str | None = None, rows_per_file: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.data = f"{self.root}/data"
        self.partition_by = partition_by
        self.rows_per_file = rows_per_file

    def exists(self) -> bool:
        return self.state()["version"] > 0

    def state(self, version: int | None = None) -> dict:
        """The newest commit: version, table id, schema, folders with their rows, rows of the last load, marks.

        A folder entry is ``{"path", "value", "rows"}``; value is the partition's date as text, or null. An older
        ``version`` is there as long as its commit file is kept.
        """
        fs = self._fs()
        name = "[0-9]*" if version is None else f"{version:012d}"
        commits = fs.globStatus(self._path(f"{self.root}/commits/{name}.json")) or []
        if not commits and version:
            raise FileNotFoundError(f"version {version} of {self.root} is not kept")
        if not commits:
            return {
                "version": 0, "table_id": uuid.uuid4().hex, "schema": None, "folders": [], "rows_written": 0,
                "streams": {}, "copies": {}, "marks": {},
            }
        stream = fs.open(max((s.getPath() for s in commits), key=lambda path: path.getName()))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def read(self, state: dict | None = None, values: Iterable[date | None] | None = None) -> DataFrame:
        """The rows of a state, the newest by default; with ``values`` only the folders of these partitions are listed."""
        state = state or self.state()
        if state["version"] == 0:
            raise FileNotFoundError(f"no committed version under {self.root}")
        schema = T.StructType.fromJson(state["schema"])
        wanted = None if values is None else {value and value.isoformat() for value in values}
        folders = [f for f in state["folders"] if wanted is None or f["value"] in wanted]
        if not folders:
            return self.spark.createDataFrame([], schema)
        with_id = T.StructType([*schema.fields, T.StructField(LOAD_ID, T.StringType())])
        paths = [f"{self.data}/{folder['path']}" for folder in folders]
        return (
            self.spark.read.schema(with_id)
            .option("basePath", self.data)
            .parquet(*paths)
            .select(*schema.names)
        )

    def create_if_absent(self, schema: T.StructType) -> bool:
        base = self.state()
        if base["version"]:
            return False
        self._check(schema)
        self._commit(base, schema, [], 0)
        return True

    def replace(
        self,
        rows: DataFrame,
        base: dict | None = None,
        stream: tuple[str, int] | None = None,
        expected: int | None = None,
        marks: Marks | None = None,
    ) -> int:
        """New content for the whole table; returns the rows written.

        ``marks`` are texts that the commit holds beside the rows (here and in the other writes): a commit without
        them has none, so a mark never outlives a load that does not know it.
        """
        base = base or self.state()
        folders, written = self._write(rows, base["version"] + 1, expected)
        self._commit(base, rows.schema, folders, written, stream, marks=marks)
        return written

    def append(
        self,
        rows: DataFrame,
        stream: tuple[str, int] | None = None,
        base: dict | None = None,
        withdrawn: Sequence[str] = (),
        marks: Marks | None = None,
    ) -> int:
        """More rows of the table's columns, matched by name; a ``stream`` mark makes a repeat a no-op.

        Rows that were chosen by reading ``base`` must come with it: a load in between is then a conflict. The paths
        ``withdrawn`` leave the table in the same commit.
        """
        base = base or self.state()
        if stream and base["streams"].get(stream[0], -1) >= stream[1]:
            return 0
        if base["version"]:
            rows = self._fitting(rows, T.StructType.fromJson(base["schema"]))
        folders, written = self._write(rows, base["version"] + 1)
        kept = [f for f in base["folders"] if f["path"] not in set(withdrawn)]
        self._commit(base, rows.schema, kept + folders, written, stream, [f["path"] for f in folders], marks)
        return written

    def replace_partitions(
        self,
        rows: DataFrame,
        touched: Iterable[date | None],
        base: dict,
        stream: tuple[str, int] | None = None,
        expected: int | None = None,
        marks: Marks | None = None,
    ) -> int:
        """New content for the touched partitions; the other folders of ``base`` stay as they are.

        Rows of other partitions come to what these hold already.
        """
        folders, written = self._write(rows, base["version"] + 1, expected)
        self._commit(base, rows.schema, self._untouched(base, touched) + folders, written, stream, marks=marks)
        return written

    def drop_partitions(self, touched: Iterable[date | None], base: dict, stream: tuple[str, int] | None = None) -> None:
        """A version without the touched partitions, nothing rewritten."""
        self._commit(base, T.StructType.fromJson(base["schema"]), self._untouched(base, touched), 0, stream)

    def partition_rows(self, base: dict) -> dict[date | None, int]:
        """Rows of each partition as the commit counts them."""
        counts: dict[date | None, int] = {}
        for folder in base["folders"]:
            value = folder["value"] and date.fromisoformat(folder["value"])
            counts[value] = counts.get(value, 0) + folder["rows"]
        return counts

    def changed_partitions(self, old: dict, new: dict) -> list[date | None]:
        """Partitions whose folders differ between two states of this table; no row is read."""
        sides = [{(f["value"], f["path"]) for f in state["folders"]} for state in (old, new)]
        values = {value for value, _ in sides[0] ^ sides[1]}
        return [value and date.fromisoformat(value) for value in sorted(values, key=lambda v: v or "")]

    def compact(self, most_folders: int = 8) -> int:
        """Rewrite the partitions that loads have spread over more folders than this; returns how many."""
        base = self.state()
        spread: dict[str | None, int] = {}
        for folder in base["folders"]:
            spread[folder["value"]] = spread.get(folder["value"], 0) + 1
        values = [v and date.fromisoformat(v) for v, n in spread.items() if n > most_folders]
        if not values:
            return 0
        counts = self.partition_rows(base)
        rows, expected = self.read(base), sum(counts[v] for v in values)
        if self.partition_by is None:
            self.replace(rows, base, expected=expected)
        else:
            self.replace_partitions(rows.where(in_partitions(self.partition_by, values)), values, base, expected=expected)
        return len(values)

    def _untouched(self, base: dict, touched: Iterable[date | None]) -> list[dict]:
        gone = {value and value.isoformat() for value in touched}
        return [f for f in base["folders"] if f["value"] not in gone]

    def remove_unlisted(self) -> int:
        """Delete load folders that the newest version does not list; returns how many."""
        listed = {f["path"] for f in self.state()["folders"]}
        stale = [f for f in self._load_folders(f"{LOAD_ID}=*") if f not in listed]
        for folder in stale:
            self._fs().delete(self._path(f"{self.data}/{folder}"), True)
        return len(stale)

    def _check(self, schema: T.StructType) -> None:
        if self.partition_by and schema[self.partition_by].dataType != T.DateType():
            raise ValueError(f"{self.root} can be partitioned by a date only, not by {self.partition_by}")

    def _fitting(self, rows: DataFrame, schema: T.StructType) -> DataFrame:
        have = {f.name: f.dataType for f in rows.schema.fields}
        want = {f.name: f.dataType for f in schema.fields}
        if have != want:
            raise ValueError(f"{self.root} has columns {schema.simpleString()}, not {rows.schema.simpleString()}")
        return rows.select(*schema.names)

    def _write(self, rows: DataFrame, version: int, expected: int | None = None) -> tuple[list[dict], int]:
        self._check(rows.schema)
        load = f"{LOAD_ID}=v{version:08d}-{uuid.uuid4().hex}"
        count = Observation()
        if self.partition_by:
            rows = rows.hint("rebalance", self.partition_by)
        writer = rows.observe(count, F.count(F.lit(1)).alias("rows")).write
        if self.partition_by:
            writer = writer.partitionBy(self.partition_by)
        if self.rows_per_file:
            writer = writer.option("maxRecordsPerFile", self.rows_per_file)
        writer.parquet(f"{self.data}/{load}")
        written = count.get["rows"]
        if expected is not None and written != expected:
            raise RowsLost(f"{written} rows written for {expected} under {self.root}")
        return self._entries(load, rows.schema, written), written

    def _entries(self, load: str, schema: T.StructType, written: int) -> list[dict]:
        paths = self._load_folders(load)
        if not self.partition_by:
            return [{"path": p, "value": None, "rows": written} for p in paths]
        if not paths:
            return []
        # The counts come from the files' footers; no column is read.
        again = self.spark.read.schema(schema).parquet(f"{self.data}/{load}").groupBy(self.partition_by).count()
        counts = {r[0] and r[0].isoformat(): r[1] for r in again.collect()}
        by_value = {p: p.rsplit("=", 1)[1] for p in paths}
        values = {p: None if v == "__HIVE_DEFAULT_PARTITION__" else v for p, v in by_value.items()}
        return [{"path": p, "value": values[p], "rows": counts[values[p]]} for p in paths]

    def _load_folders(self, load: str) -> list[str]:
        levels = [load, f"{self.partition_by}=*"] if self.partition_by else [load]
        found = self._fs().globStatus(self._path("/".join([self.data, *levels]))) or []
        return sorted("/".join(s.getPath().toUri().getPath().split("/")[-len(levels) :]) for s in found)

    def _commit(
        self,
        base: dict,
        schema: T.StructType,
        folders: list[dict],
        written: int,
        stream: tuple[str, int] | None = None,
        new: Sequence[str] = (),
        marks: Marks | None = None,
    ) -> None:
        version = base["version"] + 1
        streams, copies = dict(base["streams"]), dict(base["copies"])
        if stream:
            streams[stream[0]] = stream[1]
            copies[stream[0]] = list(new)
        state = {
            "version": version,
            "table_id": base["table_id"],
            "schema": schema.jsonValue(),
            "folders": folders,
            "rows_written": written,
            "streams": streams,
            "copies": copies,
            "marks": {name: mark(written) if callable(mark) else mark for name, mark in (marks or {}).items()},
        }
        fs = self._fs()
        draft = self._path(f"{self.root}/commits/.draft-{uuid.uuid4().hex}")
        final = self._path(f"{self.root}/commits/{version:012d}.json")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        try:
            self._rename_new(draft, final)
        except Py4JJavaError as error:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise CommitConflict(f"version {version} of {self.root} exists") from None
            raise
        if version > COMMITS_KEPT:
            fs.delete(self._path(f"{self.root}/commits/{version - COMMITS_KEPT:012d}.json"), False)

    def _rename_new(self, draft, final) -> None:
        """Rename that fails where the target exists; as atomic as the store's own rename."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        files.rename(draft, final, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())


class Warehouse:
    """One namespace of snapshot tables under a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, name: str, partition_by: str | None = None) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{name}", partition_by)

    def table_names(self) -> list[str]:
        """Tables with a committed version."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/*/commits/[0-9]*.json")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        return sorted({s.getPath().getParent().getParent().getName() for s in found})

    def pinned(self, names: Iterable[str] | None = None, tries: int = 20) -> Pinned:
        """The versions of these tables at one moment, all tables by default.

        Each table has commits of its own. So the newest versions are read until two readings agree: all of them
        were current together between the two.
        """
        names = list(self.table_names() if names is None else names)
        before = {name: self.table(name).state() for name in names}
        for _ in range(tries):
            after = {name: self.table(name).state() for name in names}
            if all(after[name]["version"] == before[name]["version"] for name in names):
                return Pinned(self, after)
            before = after
        raise CommitConflict(f"tables under {self.root} changed at each of {tries} readings")


class Pinned:
    """Tables of a warehouse as they were at one moment, whatever is loaded later.

    Files of a version stay until ``remove_unlisted`` takes those that newer versions do not list.
    """

    def __init__(self, warehouse: Warehouse, states: dict[str, dict]):
        self.warehouse = warehouse
        self.states = states

    def table_names(self) -> list[str]:
        return sorted(name for name, state in self.states.items() if state["version"])

    def read(self, name: str) -> DataFrame:
        return self.warehouse.table(name).read(self.states[name])

    def row_counts(self) -> dict[str, int]:
        """Rows of each table as its commit counts them; nothing is read."""
        return {name: sum(f["rows"] for f in self.states[name]["folders"]) for name in self.table_names()}
