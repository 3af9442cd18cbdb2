"""Catalog metadata as DataFrames: tables, columns, keys, sizes, and DDL text built from them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muara.functions.labels import pretty_size
from muara.schemas import catalog_type
from muara.sources.tables import table_row_counts, union_all


def column_profile(tables: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """One row per column: position, catalog type, measured text length, rows and non-null values.

    Files carry no declared lengths or constraints, so both are measured, with one aggregation per table.
    """
    return union_all([_profile_one(name, table) for name, table in tables])


def _profile_one(name: str, table: DataFrame) -> DataFrame:
    measures, described = ["count(1) as rows"], []
    for at, field in enumerate(table.schema.fields):
        column = "`" + field.name.replace("`", "``") + "`"
        measures.append(f"count({column}) as n{at}")
        is_text = isinstance(field.dataType, T.StringType)
        measures.append(f"{f'max(char_length({column}))' if is_text else 'cast(null as int)'} as len{at}")
        kind, precision, scale = catalog_type(field.dataType)
        described.append(
            f"struct({_quoted(name)} as table_name, {at + 1} as ordinal, {_quoted(field.name)} as column_name,"
            f" {_quoted(kind)} as data_type, len{at} as char_len, cast({_number(precision)} as int) as"
            f" num_precision, cast({_number(scale)} as int) as num_scale, n{at} < rows as nullable,"
            f" cast(null as string) as default, n{at} as non_null)"
        )
    return table.selectExpr(*measures).selectExpr(f"inline(array({', '.join(described)}))")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(value: int | None) -> str:
    return "null" if value is None else str(value)


def numbered_tables(counts: DataFrame) -> DataFrame:
    """Tables in name order with their number; one row per table of the namespace."""
    by_name = Window.partitionBy().orderBy("table_name")
    return counts.withColumn("pos", F.row_number().over(by_name))


def table_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Bytes and readable size per table, from the file listing; file contents are not read."""
    listed = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        .select(F.lit(name).alias("table_name"), "bytes")
        for name, path in paths.items()
    ]
    return union_all(listed).withColumn("size", pretty_size(F.col("bytes")))


@dataclass(frozen=True)
class Key:
    """A declared key; ``kind`` is PRIMARY KEY, UNIQUE or FOREIGN KEY."""

    table: str
    kind: str
    columns: tuple[str, ...]
    references: str | None = None


def key_rows(spark: SparkSession, keys: Sequence[Key]) -> DataFrame:
    """Declared keys as one row per key column."""
    rows = [
        (key.table, key.kind, at, position, column)
        for at, key in enumerate(keys)
        for position, column in enumerate(key.columns, start=1)
    ]
    schema = "table_name string, kind string, key_no int, position int, column_name string"
    return spark.createDataFrame(rows, schema)


def key_candidates(tables: dict[str, DataFrame], keys: Sequence[Key]) -> DataFrame:
    """Declared primary and unique keys with what the data says: rows, distinct and null keys."""
    measured = []
    for key in keys:
        if key.kind == "FOREIGN KEY":
            continue
        has_null = F.lit(False)
        for column in key.columns:
            has_null = has_null | F.col(column).isNull()
        per_key = tables[key.table].groupBy(*key.columns).agg(F.count(F.lit(1)).alias("n"))
        measured.append(
            per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count(F.lit(1)).alias("distinct_keys"),
                F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_keys"),
            ).select(
                F.lit(key.table).alias("table_name"),
                F.lit(key.kind).alias("kind"),
                F.lit(",".join(key.columns)).alias("key_columns"),
                "row_count",
                "distinct_keys",
                "null_keys",
            )
        )
    holds = (F.col("row_count") == F.col("distinct_keys")) & (F.col("null_keys") == 0)
    return union_all(measured).withColumn("holds", holds)


def ddl_type() -> Column:
    """DDL type text of a metadata row. A scale of 0 keeps its precision; user-defined types become TEXT."""
    kind = F.col("data_type")
    sized = {"character varying": "VARCHAR", "character": "CHAR"}
    text = F.when(kind == "USER-DEFINED", "TEXT")
    for name, short in sized.items():
        with_length = F.concat(F.lit(f"{short}("), F.col("char_len").cast("string"), F.lit(")"))
        text = text.when(kind == name, F.when(F.col("char_len") > 0, with_length).otherwise(short))
    numeric = F.format_string("NUMERIC(%d,%d)", F.col("num_precision"), F.coalesce("num_scale", F.lit(0)))
    return (
        text.when(kind == "numeric", F.when(F.col("num_precision") > 0, numeric).otherwise("NUMERIC"))
        .when(kind == "timestamp without time zone", "TIMESTAMP")
        .when(kind == "timestamp with time zone", "TIMESTAMPTZ")
        .otherwise(F.upper(kind))
    )


def clone_ddl(columns: DataFrame, keys: DataFrame, namespace: str = "public") -> DataFrame:
    """One CREATE TABLE text per table from metadata rows and key rows (groups are columns of a table)."""
    default = F.when(
        F.col("default").isNotNull() & ~F.col("default").contains("nextval"),
        F.concat(F.lit(" DEFAULT "), F.col("default")),
    )
    line = F.concat(
        F.lit("    "),
        F.col("column_name"),
        F.lit(" "),
        ddl_type(),
        F.when(F.col("nullable"), "").otherwise(" NOT NULL"),
        F.coalesce(default, F.lit("")),
    )
    body = columns.groupBy("table_name").agg(
        _joined(F.struct("ordinal", line.alias("text")), ",\n").alias("body")
    )
    listed = keys.where(F.col("kind").isin("PRIMARY KEY", "UNIQUE")).groupBy(
        "table_name", "kind", "key_no"
    ).agg(_joined(F.struct("position", F.col("column_name").alias("text")), ", ").alias("cols"))
    clause = F.concat(F.lit(",\n    "), F.col("kind"), F.lit(" ("), F.col("cols"), F.lit(")"))
    constraints = listed.groupBy("table_name").agg(
        _joined(F.struct(F.col("kind"), F.col("key_no"), clause.alias("text")), "").alias("constraints"),
        F.max(F.when(F.col("kind") == "PRIMARY KEY", F.col("cols"))).alias("pk"),
    )
    name = F.col("table_name")
    qualified = F.concat(F.lit(f"{namespace}."), name)
    index = F.concat(
        F.lit("CREATE INDEX IF NOT EXISTS idx_"), name, F.lit("_pk ON "), qualified,
        F.lit("("), F.col("pk"), F.lit(");\n"),
    )
    ddl = F.concat(
        F.lit("CREATE TABLE IF NOT EXISTS "), qualified, F.lit(" (\n"), F.col("body"),
        F.coalesce("constraints", F.lit("")), F.lit("\n);\n"),
        F.coalesce(index, F.lit("")),
    )
    return body.join(constraints, "table_name", "left").select("table_name", ddl.alias("ddl"))


def _joined(item: Column, separator: str) -> Column:
    texts = F.transform(F.array_sort(F.collect_list(item)), lambda i: i["text"])
    return F.array_join(texts, separator)


def write_ddl(ddl: DataFrame, path: str) -> None:
    """All statements as one text file in table order; a namespace holds a bounded number of tables."""
    ddl.orderBy("table_name").select("ddl").coalesce(1).write.mode("overwrite").text(path)
