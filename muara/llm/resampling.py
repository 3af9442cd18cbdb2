"""Documents drawn by importance: those whose word runs are as frequent as in a target collection weigh most.

Every run of up to ``max_words`` words is a feature and falls into one of ``buckets`` buckets by its CRC-32. A bucket's
gain is the logarithm of its smoothed share in the target over that in the documents, in thousandths; a document's
weight is the sum over its features. Keyed Gumbel noise on the weight makes the highest scores a sample without
replacement in which a document's chance follows its weight.

A CRC-32 is linear: the bytes of a span contribute independently of each other, each by its value and its distance from
the end. Contributions come from a table and are put together for all spans of a block at once; spans longer than the
table are folded block by block, and a constant for each length stands for the start value.

Texts are read twice, once for the counts and once for the weights. To the driver come the counts of the buckets, whose
number is fixed. Ranks come from a range sort of (score, id) without texts and the row counts of its slices.

Null and odd rows: null and empty texts have no features, weight 0 and no rank. Rows with equal ids are documents of
their own; a null id is keyed as empty text and comes last among equal scores. Equal rows take ranks in any order. An
empty target or no documents leave the smoothing alone; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from muara.llm.common import documents, map_arrow, shuffle_partitions, utf8, word_bounds, write_table

# Fixed value: the reflected CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320
#: Bytes a table row stands for; longer spans are folded in blocks of so many.
BLOCK = 64
#: Bytes of spans that are expanded at a time.
EXPANDED = 1 << 20

_lowered = np.arange(256, dtype=np.uint8)
_lowered[65:91] += 32
_separator = np.array([b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F for b in range(256)])


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contributions by (distance from the end, byte), states after a zero start by length, and a block's shift."""
    place = np.zeros((BLOCK + 1, 256), np.uint32)
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, np.uint32(POLYNOMIAL) ^ (row >> np.uint32(1)), row >> np.uint32(1))
    place[0] = row
    for distance in range(1, BLOCK + 1):
        before = place[distance - 1]
        place[distance] = place[0][before & 0xFF] ^ (before >> np.uint32(8))
    start = np.zeros(BLOCK + 1, np.uint32)
    start[0] = 0xFFFFFFFF
    for length in range(1, BLOCK + 1):
        start[length] = place[0][start[length - 1] & 0xFF] ^ (start[length - 1] >> np.uint32(8))
    # A state's lowest byte is taken in first: over a whole block it acts as a byte at the block's far end.
    shift = place[BLOCK - 1 - np.arange(4)]
    return place[:BLOCK], start, shift


def _folded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Contributions of spans of at most ``BLOCK`` bytes, none of them empty."""
    place, _, _ = tables()
    lengths = ends - starts
    offsets = np.cumsum(lengths) - lengths
    ahead = np.repeat(ends, lengths)
    at = np.arange(len(ahead)) + np.repeat(starts - offsets, lengths)
    return np.bitwise_xor.reduceat(place[ahead - 1 - at, data[at]], offsets)


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span of ``data``; spans may overlap."""
    place, start, shift = tables()
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint32)
    short = np.flatnonzero((lengths > 0) & (lengths <= BLOCK))
    sums = np.cumsum(lengths[short])
    cuts = np.searchsorted(sums, np.arange(EXPANDED, (sums[-1] if len(sums) else 0) + EXPANDED, EXPANDED), "left") + 1
    low = 0
    for high in [*cuts.tolist(), len(short)]:
        part = short[low:high]
        if len(part):
            out[part] = _folded(data, starts[part], ends[part]) ^ start[lengths[part]] ^ np.uint32(0xFFFFFFFF)
        low = max(low, high)
    for k in np.flatnonzero(lengths > BLOCK).tolist():
        head = int(lengths[k] - 1) % BLOCK + 1
        edges = np.arange(starts[k] + head, ends[k] + 1, BLOCK)
        states = [
            x
            for low in range(0, len(edges), EXPANDED // BLOCK)
            for x in _folded(data, np.maximum(edges[low : low + EXPANDED // BLOCK] - BLOCK, starts[k]), edges[low : low + EXPANDED // BLOCK]).tolist()
        ]
        state = states[0] ^ int(start[head])
        rows = _shift_rows()
        for block in states[1:]:
            state = rows[0][state & 255] ^ rows[1][state >> 8 & 255] ^ rows[2][state >> 16 & 255] ^ rows[3][state >> 24] ^ block
        out[k] = state ^ 0xFFFFFFFF
    return out


@lru_cache(1)
def _shift_rows() -> list[list[int]]:
    return tables()[2].tolist()


def features(texts: list[bytes], max_words: int, buckets: int):
    """(words of each text, bucket of every feature, features of each text), features in the order of the texts."""
    data = _lowered[np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)]
    starts, ends = word_bounds(data, _separator)
    limits = np.cumsum([len(t) + 1 for t in texts])
    words = np.diff(np.searchsorted(starts, limits, "left"), prepend=0)
    if max_words > 1:  # words of one text behind each other, one space between them
        lengths = ends - starts
        after = np.cumsum(lengths + 1)
        packed = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
        inside = np.arange(lengths.sum()) + np.repeat(np.arange(len(lengths)), lengths)
        packed[inside] = data[np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)]
        data, starts, ends = packed, after - lengths - 1, after - 1
    if max_words == 1:
        return words, span_crcs(data, starts, ends) % np.uint32(buckets), words
    owner = np.repeat(np.arange(len(texts)), words)
    found, owners = [], []
    for size in range(1, max_words + 1):
        first = np.arange(max(0, len(starts) - size + 1))
        first = first[owner[first] == owner[first + size - 1]]
        found.append(span_crcs(data, starts[first], ends[first + size - 1]) % np.uint32(buckets))
        owners.append(owner[first])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return words, np.concatenate(found)[order], np.bincount(owners, minlength=len(texts))


def _blocks(texts: list[bytes], size: int = 4 << 20):
    """Bounds of runs of texts of about ``size`` bytes; a longer text is a run of its own."""
    low = total = 0
    for k, text in enumerate(texts):
        if k > low and total + len(text) > size:
            yield low, k
            low, total = k, 0
        total += len(text)
    if low < len(texts):
        yield low, len(texts)


def bucket_counts(docs: DataFrame, max_words: int, buckets: int, text: str = "text") -> DataFrame:
    """(bucket, n): the features of all texts, counted per task and then per bucket."""

    def emit(batches):
        import pyarrow as pa

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = utf8(batch.column(0))
            for low, high in _blocks(texts):
                total += np.bincount(features(texts[low:high], max_words, buckets)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used, "n": total[used]})

    found = map_arrow(docs.select(F.col(f"`{text}`")), emit, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, max_words: int, buckets: int) -> list[int]:
    """The gain of every bucket in thousandths; the smoothing counts each bucket once more than it occurs."""
    counts = []
    for rows in (docs, target):
        n = [0] * buckets
        for r in bucket_counts(rows, max_words, buckets).collect():
            n[r["bucket"]] = r["n"]
        counts.append(n)
    (all_docs, all_target) = map(sum, counts)
    return [
        math.floor(1000 * math.log((t + 1) * (all_docs + buckets) / ((s + 1) * (all_target + buckets))))
        for s, t in zip(*counts, strict=True)
    ]


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise in thousandths, the same for an id in every run."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


NAMES = ("n_words", "n_features", "weight", "score")


def weighed(docs: DataFrame, target: DataFrame, max_words: int = 1, buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """The rows of ``docs`` with ``NAMES`` as further columns; columns of these names are replaced."""
    gain = np.array(gains(docs, target, max_words, buckets), np.int64)
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in NAMES])
    lower = [c.lower() for c in source.columns]
    text_at, id_at = lower.index("text"), lower.index("doc_id")

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            texts, out = utf8(batch.column(text_at)), [[], [], []]
            for low, high in _blocks(texts):
                words, bucket, n = features(texts[low:high], max_words, buckets)
                sums = np.concatenate(([0], np.cumsum(gain[bucket])))
                ends = np.cumsum(n)
                for column, values in zip(out, (words, n, sums[ends] - sums[ends - n]), strict=True):
                    column += values.tolist()
            score = [w + noise(seed, i) for w, i in zip(out[2], batch.column(id_at).to_pylist(), strict=True)]
            new = [pa.array(x, pa.int64()) for x in (*out, score)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *NAMES])

    schema = source.withColumns({c: F.lit(0).cast("long") for c in NAMES}).schema
    return map_arrow(source, emit, schema)


def ranked(scored: DataFrame, percent: int = 10, least_words: int = 20) -> DataFrame:
    """Scored rows with ``rank``: 1 for the highest score, null for the documents that are not drawn.

    ``percent`` in a hundred of the documents with ``least_words`` words are drawn. Rows are sorted in slices by ranges
    of (score, id); a rank is a place in its slice after the rows of all slices before. One row per slice is summed up.
    """
    may = F.col("n_words") >= least_words
    keys = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features")]
    rows = scored.where(may).repartitionByRange(shuffle_partitions(scored.sparkSession), *keys, F.monotonically_increasing_id())
    rows = write_table(rows.withColumn("slice", F.spark_partition_id()), "ranked")
    sizes = rows.groupBy("slice").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("slice", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    place = F.row_number().over(Window.partitionBy("slice").orderBy(*keys)) + F.col("before")
    drawn = F.expr(f"total * {percent} div 100")
    placed = rows.join(sizes, "slice").withColumn("rank", place.cast("long"))
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.select(*scored.columns, "rank").unionByName(scored.where(~may).withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, **how) -> DataFrame:
    """The drawn rows of ``docs`` with their columns as they are, except for those named like ``NAMES``.

    The last drawn row's (score, id) is the bound that the texts are read against; rows equal to it in both are drawn.
    """
    scored = weighed(docs, target, **how)
    last = ranked(write_table(scored.select("doc_id", *NAMES), "scored"), percent, least_words)
    last = last.where("rank is not null").orderBy(F.desc("rank")).select("score", "doc_id").head()
    if last is None:
        return scored.drop(*NAMES).limit(0)
    up_to = F.lit(True) if last["doc_id"] is None else F.col("doc_id") <= last["doc_id"]
    drawn = (F.col("n_words") >= least_words) & ((F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & up_to))
    return scored.where(drawn).drop(*NAMES)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")
    scored = weighed(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text")
    found = ranked(write_table(scored, "scored"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
