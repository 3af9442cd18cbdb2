"""Product codes of vectors by exact integer arithmetic.

Components become integers, vectors are cut into equal parts, and each part is replaced by the number of its nearest
codebook entry. Distances come from matrix products: integers are broken into limbs so short that a float64 product of
two limb matrices stays below 2**53 and is exact; the products are put together in int64, and the first smallest
distance decides. Integers too large for int64 distances go the same way as Python numbers.

The codebooks, of fixed size, are the only thing that the driver holds. Every pass sends it one row per entry and
position: the sum of a task's parts, again in limbs, so that no sum overflows at any number of rows.

Null and odd rows: vectors that are null or hold null, NaN or infinite components are dropped, empty ones are kept.
Shorter vectors count as filled up with zeros to the longest one's length, and that to a multiple of the number of
parts. Rows with a null id are coded, and are first entries of the codebooks only after all others. Repeated rows and
ids are rows like any other; among equal ids the smaller vector is first. No rows give no rows. A distance beyond a
long is given as the largest long.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muara.llm.common import map_arrow, write_table

#: Bits that every float64 product and sum keeps exact.
EXACT = 53
LIMB = 30
LARGEST = 2**63 - 1
#: Rows whose distances are held at a time.
ROWS = 4096


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]``, int64 or Python integers."""

    entries: np.ndarray
    scale: int

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for x in self.entries.ravel().tolist()).encode()).hexdigest()


def integers(flat: np.ndarray, lengths: np.ndarray, width: int, scale: int) -> np.ndarray:
    """Vectors of ``lengths`` components as rows of ``width`` integers ``floor(scale * x)``, filled up with zeros."""
    values = flat.astype(np.float64)
    if values.size and np.abs(values).max() >= 2.0**62 / scale:
        whole = np.array([int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in values.tolist()], object)
    else:
        whole = np.floor(values * scale).astype(np.int64)
    out = np.zeros((len(lengths), width), whole.dtype)
    out[np.arange(width) < lengths[:, None]] = whole
    return out


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 arrays whose sum, each shifted by ``bits`` more than the one before, is ``values``; the last has the sign."""
    out = []
    while True:
        if not values.size or max(int(values.max()), -int(values.min())) < 2**bits:
            return [*out, values.astype(np.float64)]
        out.append((values & (2**bits - 1)).astype(np.float64))
        values = values >> bits


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of int64 matrices, exact as long as the result fits in int64."""
    bits = (EXACT - max(1, left.shape[1]).bit_length()) // 2
    total = np.zeros((left.shape[0], right.shape[0]), np.int64)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(limbs(right, bits)):
            shift = bits * (i + j)
            if shift < 64:
                total += (a @ b.T).astype(np.int64) << shift
    return total


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of every row, and the squared distance."""
    largest = max((max(int(x.max()), -int(x.min())) for x in (rows, entries) if x.size), default=0)
    if max(1, rows.shape[1]) * (2 * largest) ** 2 < 2**62:
        rows, entries = rows.astype(np.int64), entries.astype(np.int64)
        distance = (rows * rows).sum(1)[:, None] - 2 * products(rows, entries) + (entries * entries).sum(1)[None, :]
    else:
        rows, entries = rows.astype(object), entries.astype(object)
        distance = (rows * rows).sum(1)[:, None] - 2 * rows.dot(entries.T) + (entries * entries).sum(1)[None, :]
    first = np.argmin(distance, axis=1)
    return first, distance[np.arange(len(rows)), first]


def assigned(rows: np.ndarray, books: Codebooks):
    """For each part: its number, its columns of ``rows``, the nearest entries and the distances."""
    step = books.entries.shape[2]
    for part in range(books.parts):
        columns = rows[:, part * step : (part + 1) * step]
        yield part, columns, *nearest(columns, books.entries[part])


def kept_vectors(vectors: DataFrame, vector: str) -> DataFrame:
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.where(x.isNotNull() & finite)


def _blocks(batch, books: Codebooks, at: int):
    """(first row, integer rows) of an Arrow batch, a bounded number of rows at a time."""
    for start in range(0, batch.num_rows, ROWS):
        lists = batch.column(at).slice(start, ROWS)
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        yield start, integers(lists.flatten().to_numpy(zero_copy_only=False), lengths, books.width, books.scale)


def first_codebooks(kept: DataFrame, id_column: str, vector: str, parts: int, entries: int, scale: int) -> Codebooks:
    """The parts of the ``entries`` smallest ids; the width is that of the longest vector."""
    longest = kept.agg(F.max(F.size(f"`{vector}`"))).first()[0] or 0
    step = max(1, -(-longest // parts))
    head = kept.select(F.col(f"`{id_column}`").alias("i"), F.col(f"`{vector}`").alias("x"))
    head = head.orderBy(F.asc_nulls_last("i"), "x").limit(entries).collect()
    lengths = np.array([len(r["x"]) for r in head], np.int64)
    rows = integers(np.array([c for r in head for c in r["x"]], np.float64), lengths, parts * step, scale)
    return Codebooks(rows.reshape(len(head), parts, step).transpose(1, 0, 2), scale)


def _number(limbed) -> int:
    return sum(int(x) << (LIMB * k) for k, x in enumerate(limbed))


def moved(kept: DataFrame, vector: str, books: Codebooks) -> Codebooks:
    """Each entry becomes the componentwise floor of the mean of the parts next to it; unused ones stay."""
    largest = kept.agg(F.max(F.array_max(F.transform(f"`{vector}`", lambda c: F.abs(c.cast("double")))))).first()[0]
    bits = math.frexp(largest or 0.0)[1] + books.scale.bit_length() + 32
    n_limbs = max(2, -(-bits // LIMB))

    def sums(batches):
        import pyarrow as pa

        shape = books.entries.shape
        total, count = np.zeros(shape, object), np.zeros(shape[:2], np.int64)
        for batch in batches:
            for _, rows in _blocks(batch, books, 0):
                for part, columns, entry, _ in assigned(rows, books):
                    order = np.argsort(entry, kind="stable")
                    used, starts = np.unique(entry[order], return_index=True)
                    if columns.dtype != object and np.abs(columns).max(initial=0) >= 2**50:
                        columns = columns.astype(object)
                    total[part, used] += np.add.reduceat(columns[order], starts, axis=0).astype(object)
                    count[part] += np.bincount(entry, minlength=shape[1])
        part, entry = np.nonzero(count)
        mask = (1 << LIMB) - 1
        out = {"part": [], "entry": [], "position": [], "n": []} | {f"l{k}": [] for k in range(n_limbs)}
        for p, e in zip(part.tolist(), entry.tolist(), strict=True):
            for at, value in enumerate(total[p, e]):
                for name, x in (("part", p), ("entry", e), ("position", at), ("n", int(count[p, e]))):
                    out[name].append(x)
                for k in range(n_limbs):
                    low = int(value) >> (LIMB * k)
                    out[f"l{k}"].append(low if k == n_limbs - 1 else low & mask)
        yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in out.items()})

    names = [f"l{k}" for k in range(n_limbs)]
    found = map_arrow(kept.select(F.col(f"`{vector}`")), sums, ", ".join(f"{n} long" for n in ["part", "entry", "position", "n", *names]))
    found = found.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names])
    entries = books.entries.astype(object)
    for r in found.collect():
        entries[r["part"], r["entry"], r["position"]] = _number([r[n] for n in names]) // r["n"]
    small = all(abs(x) < 2**62 for x in entries.ravel().tolist())
    return Codebooks(entries.astype(np.int64) if small else entries, books.scale)


def trained(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks:
    """Codebooks after ``rounds`` rounds over all vectors, started with the parts of the smallest ids."""
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits name 256 entries at most")
    kept = kept_vectors(vectors, vector)
    books = first_codebooks(kept, id_column, vector, parts, entries, scale)
    for _ in range(rounds if books.entries.shape[1] else 0):
        books = moved(kept, vector, books)
    return books


def coded(vectors: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """Kept rows without the vector, with ``code`` (two hex digits a part) and ``error``; columns of these names go."""
    taken = {"code", "error", vector.lower()}
    others = [F.col(f"`{c}`") for c in vectors.columns if c.lower() not in taken]
    source = kept_vectors(vectors, vector).select(*others, F.col(f"`{vector}`"))
    at = len(others)

    def emit(batches):
        import pyarrow as pa

        digits = np.array([f"{k:02x}" for k in range(256)])
        for batch in batches:
            codes, errors = [], []
            for _, rows in _blocks(batch, books, at):
                code, error = [], 0
                for _, _, entry, distance in assigned(rows, books):
                    code.append(entry)
                    error = error + distance.astype(object)
                codes += ["".join(r) for r in digits[np.stack(code, 1)].tolist()]
                errors += [min(int(x), LARGEST) for x in error]
            columns = [*batch.columns[:at], pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:at], "code", "error"])

    schema = source.select(*others).withColumns({"code": F.lit(""), "error": F.lit(0).cast("long")}).schema
    for field in schema.fields:
        field.nullable = True
    if not books.entries.shape[1]:
        return source.sparkSession.createDataFrame([], schema)
    return map_arrow(source, emit, schema)


def with_label_errors(rows: DataFrame, label: str = "label") -> DataFrame:
    """Coded rows with ``label_error``: the error summed over the rows of an equal label, nulls together."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    sums = rows.groupBy(F.col(f"`{label}`").alias("label_")).agg(total.alias("label_error"))
    return rows.join(sums, F.col(f"`{label}`").eqNullSafe(F.col("label_"))).drop("label_")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("long"), "embedding", "label")
    books = trained(rows)
    found = with_label_errors(write_table(coded(rows, books), "vector-codes"))
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
