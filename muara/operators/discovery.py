"""Keys that nobody declared: minimal unique column sets, and columns whose values all occur in a key."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Standard error of the sketches that rule column sets out, and how far below unique a set must look: nine errors.
ERROR, SURE = 0.02, 0.82
#: Exact counts that run side by side.
PARALLEL = 4
#: One of so many slices of a table's values shows most repeats; tables up to so many rows are counted without.
SLICES, SMALL = 32, 100_000
#: Bits of a mask of columns.
WORD = 62


def _comparable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))


def minimal_keys(rows: DataFrame, most_columns: int = 2, columns: Sequence[str] | None = None) -> list[tuple[str, ...]]:
    """Every set of at most ``most_columns`` columns that is unique and loses this without any of its columns.

    Columns with a null are no part of a key; nor are arrays, maps, structs and binaries. Sets are tried by size, and
    supersets of a key never. One pass per size rules out, by sketches, the sets that are clearly not unique; what is
    left is counted exactly, in a large table first in a slice of its values: equal values are in the same slice, so a
    repeat there is proof, and only sets without one are counted in all rows. A table without rows has no keys.
    """
    names = columns or [f.name for f in rows.schema.fields if _comparable(f.dataType)]
    measures = [F.count(F.lit(1)).alias("n")] + [F.count(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]
    told = rows.agg(*measures).first()
    total, found = told["n"], []
    usable = [c for k, c in enumerate(names) if total and told[f"c{k}"] == total]
    distinct: dict[tuple[str, ...], int] = {}

    def most(columns: tuple[str, ...]) -> int:
        return distinct[columns] if columns in distinct else prod(distinct[(c,)] for c in columns)

    for size in range(1, most_columns + 1):
        tried = [s for s in combinations(usable, size) if not any(set(key) <= set(s) for key in found)]
        # A set has no more values than those of two parts multiplied.
        tried = [s for s in tried if size == 1 or most(s[:-1]) * most(s[-1:]) >= SURE * total]
        if not tried:
            continue
        # Sketches of hashes made beforehand: Spark compiles a projection, but not what a sketch is given.
        hashes = rows.select(*[_hash(s).alias(f"s{k}") for k, s in enumerate(tried)])
        guess = hashes.agg(*[F.approx_count_distinct(f"s{k}", ERROR).alias(f"s{k}") for k in range(len(tried))]).first()
        distinct |= {s: int(guess[f"s{k}"] / SURE) + 1 for k, s in enumerate(tried)}
        likely = [s for k, s in enumerate(tried) if guess[f"s{k}"] >= SURE * total]
        with ThreadPoolExecutor(PARALLEL) as pool:  # each thread only submits a job
            unique = list(pool.map(lambda s: _unique(rows, s, total), likely))
        found += [s for s, yes in zip(likely, unique, strict=True) if yes]
    return found


def _hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def _unique(rows: DataFrame, columns: Sequence[str], total: int) -> bool:
    slices = [rows.where(_hash(columns) % SLICES == 0)] if total > SMALL else []
    return all(_no_repeats(part, columns) for part in (*slices, rows))


def _no_repeats(rows: DataFrame, columns: Sequence[str]) -> bool:
    return rows.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def _family(kind: T.DataType) -> str | None:
    if isinstance(kind, T.IntegralType):
        return "bigint"
    return "string" if isinstance(kind, T.StringType) else None


def inclusion_dependencies(
    tables: dict[str, DataFrame], parents: Sequence[tuple[str, str]] | None = None
) -> list[tuple[str, str, str, str]]:
    """(table, column, parent table, parent column) where every value of a column, of which there are some, is one of
    the parent column's; only whole numbers with whole numbers and texts with texts. ``parents`` narrows the parents.

    Each value becomes a mask of the columns that hold it; the masks of a column's values, combined by AND, are its
    parents. So one shuffle of distinct values answers for all pairs, and one row per kind comes to the driver.
    """
    found = []
    for family in ("bigint", "string"):
        places = [(t, f.name) for t, rows in tables.items() for f in rows.schema.fields if _family(f.dataType) == family]
        if len(places) < 2:
            continue
        words = range(-(-len(places) // WORD))

        def word(k: int, at: int) -> int:
            return 1 << (k % WORD) if k // WORD == at else 0

        values = None
        for table, rows in tables.items():
            held = [(k, c) for k, (t, c) in enumerate(places) if t == table]
            if not held:
                continue
            marked = [F.struct(F.col(f"`{c}`").cast(family).alias("v"), *[F.lit(word(k, w)).cast("bigint").alias(f"m{w}") for w in words]) for k, c in held]
            part = rows.select(F.inline(F.array(*marked))).where("v is not null")
            values = part if values is None else values.unionByName(part)
        masks = values.groupBy("v").agg(*[F.bit_or(f"m{w}").alias(f"m{w}") for w in words])

        def within(k: int, at: int) -> Column:
            mine = F.col(f"m{k // WORD}").bitwiseAND(F.lit(1 << (k % WORD))) != 0
            return F.bit_and(F.when(mine, F.col(f"m{at}"))).alias(f"p{k}_{at}")

        told = masks.agg(*[within(k, w) for k in range(len(places)) for w in words]).first()
        for k, child in enumerate(places):
            for j, parent in enumerate(places):
                mask = told[f"p{k}_{j // WORD}"]
                if j != k and mask is not None and mask >> (j % WORD) & 1 and (parents is None or parent in parents):
                    found.append((*child, *parent))
    return sorted(found)


def discovered_keys(spark: SparkSession, tables: dict[str, DataFrame], most_columns: int = 2) -> DataFrame:
    """``minimal_keys`` of every table, the columns joined by commas."""
    rows = [(name, ",".join(key)) for name, table in tables.items() for key in minimal_keys(table, most_columns)]
    return spark.createDataFrame(rows, "table_name string, key_columns string")


def foreign_key_candidates(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Columns included in a one-column key of another table."""
    parents = [(name, key[0]) for name, table in tables.items() for key in minimal_keys(table, 1)]
    rows = [r for r in inclusion_dependencies(tables, parents) if r[0] != r[2]]
    return spark.createDataFrame(rows, "child_table string, child_column string, parent_table string, parent_column string")
