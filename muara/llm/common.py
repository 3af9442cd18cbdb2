"""What the operators of this subpackage share: staged tables, word splitting and hashes of word windows."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muara.session import shared_root

#: White space of the word contracts: space and the five ASCII control blanks.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def write_table(rows: DataFrame, label: str) -> DataFrame:
    """Write rows below the shared folder and read them back: computed once, and safe when executors are lost."""
    path = f"{shared_root(rows.sparkSession)}/{label}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def free_names(rows: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores behind them as it takes for none to be a column of ``rows``."""
    taken = {c.lower() for c in rows.columns}
    longest = max((len(c) for c in taken), default=0)
    return [next(n + "_" * k for k in range(1, longest + 2) if (n + "_" * k).lower() not in taken) for n in names]


_shipped: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Send this package to the executors through the shared folder, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package, archive = Path(__file__).resolve().parents[1], io.BytesIO()
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        path = f"{shared_root(spark)}/code-{uuid.uuid4().hex}/muara.zip"
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
        try:
            stream.write(bytearray(archive.getvalue()))
        finally:
            stream.close()
        context.addPyFile(path)
        _shipped.add(context.applicationId)


def map_arrow(rows: DataFrame, emit, schema) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    send_package(rows.sparkSession)
    return rows.mapInArrow(emit, schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def buckets_for(docs: DataFrame, mb: float) -> int:
    """So many key ranges that each stands for about ``mb`` MB of text, and at least one per shuffle partition."""
    return max(shuffle_partitions(docs.sparkSession), int(text_bytes(docs) / (mb * 1e6)) + 1)


def utf8(values) -> list[bytes]:
    """An Arrow text column as bytes; null is empty."""
    import pyarrow as pa

    return [x or b"" for x in values.cast(pa.binary()).to_pylist()]


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def powers(n: int, base: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    out = np.full(n, base & (2**64 - 1), np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


def word_bounds(data: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes; ``blank`` is a table of 256 booleans."""
    inside = np.concatenate(([False], ~blank[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial of its bytes, all words at once."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    table = mixed(np.arange(1, 257, dtype=np.uint64) + np.uint64(salt * 1000))
    np.cumsum(table[data] * powers(len(data), _ODD), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(len(data), _INVERSE)[starts])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, from the words' hashes."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(len(words), _ODD), out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * powers(len(words), _INVERSE)[: len(words) - size + 1])


def equal_runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal neighbours."""
    if not len(values):
        return []
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(cuts, cuts[1:], strict=False))


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every run of ``size`` values."""
    width = 1
    while width < size:
        step = min(width, size - width)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        width += step
    return values
