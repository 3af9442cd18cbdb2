"""Toxicity of texts from the character n-grams of their words.

A word is a bag of its n-grams (bytes, with marks for its ends), each with a vector by hash. The vectors of a bag are
averaged and go through a linear softmax; vectors and softmax are trained together. So a misspelt or unseen word is
near the words it shares n-grams with. Whole texts are one bag in the first rounds, which finds the telling n-grams;
then a text is as toxic as the most toxic of its windows, so that length does not thin out a single insult.

The fit takes a bounded sample of labelled rows in one task: at most ``SAMPLE_ROWS`` documents with the smallest hashes
of their ids, as long as their texts are within ``SAMPLE_BYTES`` together. Scoring takes every row and every window.
As the softmax is linear, a fitted model is one number per n-gram bucket. These are whole numbers, so a text has the
same score wherever it stands.

Null and odd rows: a text without words, null or empty, is an empty bag and has the score of the bias alone. Rows are
scored one by one, equal ids or not; a null id counts as empty text in the split. Several labels of one document: any
positive one counts; null labels and labels without a document are left out. Without any labelled row scores are 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from muara.llm.common import documents, map_arrow, mixed, powers, utf8, word_bounds, word_hashes, write_table

SAMPLE_ROWS = 8_000
SAMPLE_BYTES = 48 << 20
#: Lengths of the n-grams in bytes, the marks ``<`` and ``>`` included.
SHORTEST, LONGEST = 3, 6
BITS = 20
DIMENSIONS = 8
#: Words of a window.
WINDOW = 1
#: Rounds over whole texts, and over each text's most toxic window.
WHOLE_ROUNDS, WINDOW_ROUNDS = 10, 30
RATE = 0.5
#: Steps of a stored number.
STEPS = 1 << 20
#: Bytes of text that are scored together; longer texts are cut between words.
BLOCK = 4 << 20

_lowered = np.arange(256, dtype=np.uint8)
_lowered[65:91] += 32
_separator = np.array([b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F for b in range(256)])
_gap = _separator & (_lowered == np.arange(256))
_letters = mixed(np.arange(1, 257, dtype=np.uint64) + np.uint64(77_000))


@dataclass(frozen=True)
class Model:
    """``values`` holds the logit of each n-gram bucket in ``STEPS``; a text's logit is its window's plus ``bias``."""

    values: np.ndarray
    bias: float
    window: int


@dataclass(frozen=True)
class Bags:
    """Distinct words of texts: ``word`` numbers the words of all texts in order, ``counts`` are the words of each text."""

    word: np.ndarray
    counts: np.ndarray
    grams: np.ndarray
    sizes: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts


def bags(texts: list[bytes]) -> Bags:
    data = _lowered[np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)]
    starts, ends = word_bounds(data, _separator)
    limits = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, limits, "left"), prepend=0)
    _, at, word = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    grams, sizes = subwords(data, starts[at], ends[at])
    return Bags(word, counts, grams, sizes)


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, one word after the other, and how many each word has."""
    lengths = ends - starts + 2
    total = int(lengths.sum())
    after = np.cumsum(lengths)
    packed = np.full(total + LONGEST, 0x3C, np.uint8)
    inside = np.arange(total - 2 * len(starts))
    place = inside + np.repeat(2 * np.arange(len(starts)) + 1, lengths - 2)
    packed[place] = data[inside + np.repeat(starts - (after - lengths - 2 * np.arange(len(starts))), lengths - 2)]
    packed[after - 1] = 0x3E
    letters, factors = _letters[packed], powers(LONGEST, 0x9E3779B97F4A7C15)
    room = np.repeat(after, lengths) - np.arange(total)
    hashes, buckets = np.zeros(total, np.uint64), np.zeros((total, LONGEST - SHORTEST + 1), np.int32)
    for n in range(1, LONGEST + 1):
        hashes = hashes + letters[n - 1 : n - 1 + total] * factors[n - 1]
        if n >= SHORTEST:
            buckets[:, n - SHORTEST] = (mixed(hashes + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int32)
    real = room[:, None] >= np.arange(SHORTEST, LONGEST + 1)
    sizes = np.add.reduceat(real.sum(1), after - lengths) if len(starts) else np.zeros(0, np.int64)
    return buckets[real], sizes


def word_logits(found: Bags, values: np.ndarray) -> np.ndarray:
    """The mean over the n-grams of each distinct word."""
    if not len(found.sizes):
        return np.zeros(0)
    return np.add.reduceat(values[found.grams], np.cumsum(found.sizes) - found.sizes) / found.sizes


def window_logits(found: Bags, logits: np.ndarray, window: int):
    """Bounds and mean of every window, and the windows of each text; a shorter text is one window."""
    sums = np.concatenate((np.zeros(1, logits.dtype), np.cumsum(logits[found.word])))
    n = np.maximum(found.counts - window + 1, np.minimum(found.counts, 1))
    low = np.arange(n.sum()) + np.repeat(found.starts - (np.cumsum(n) - n), n)
    high = np.minimum(low + window, np.repeat(found.starts + found.counts, n))
    return low, high, (sums[high] - sums[low]) / (high - low), n


def _worst(found: Bags, logits: np.ndarray, window: int):
    """For each text with words its first window of the highest mean."""
    low, high, mean, n = window_logits(found, logits, window)
    n = n[n > 0]
    text = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    best = np.flatnonzero(mean == np.maximum.reduceat(mean, first)[text]) if len(n) else first
    best = best[np.unique(text[best], return_index=True)[1]]
    return low[best], high[best], mean[best]


def fitted(texts: list[bytes], toxic: np.ndarray, window: int = WINDOW) -> Model:
    """Vectors of the n-grams and the softmax, by steps over all texts at once that shrink with past gradients."""
    if not texts:
        return Model(np.zeros(1 << BITS, np.int32), -np.inf, window)
    found, rng = bags(texts), np.random.default_rng(7)
    vectors = rng.normal(0, 0.1, (1 << BITS, DIMENSIONS)).astype(np.float32)
    softmax, bias = rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2)
    past = [np.full(1 << BITS, 1e-8), np.full((DIMENSIONS, 2), 1e-8), np.full(2, 1e-8)]
    some = found.counts > 0
    low, high = found.starts[some], (found.starts + found.counts)[some]
    for step in range(WHOLE_ROUNDS + WINDOW_ROUNDS):
        towards = softmax[:, 1] - softmax[:, 0]
        logits = word_logits(found, (vectors @ towards).astype(np.float64))
        if step < WHOLE_ROUNDS:
            sums = np.concatenate(([0.0], np.cumsum(logits[found.word])))
            mean = (sums[high] - sums[low]) / (high - low)
        else:
            low, high, mean = _worst(found, logits, window)
        z = np.zeros(len(texts))
        z[some] = mean
        wrong = (1 / (1 + np.exp(-(z + bias[1] - bias[0]))) - toxic) / len(texts)
        length = high - low
        within = np.arange(length.sum()) + np.repeat(low - (np.cumsum(length) - length), length)
        by_word = np.bincount(found.word[within], np.repeat(wrong[some] / length, length), len(found.sizes))
        by_gram = np.bincount(found.grams, np.repeat(by_word / found.sizes, found.sizes), 1 << BITS)
        used = np.flatnonzero(by_gram)
        pull = by_gram[used].astype(np.float32) @ vectors[used]
        past[0][used] += by_gram[used] ** 2 * float(towards @ towards)
        vectors[used] -= (RATE * by_gram[used] / np.sqrt(past[0][used])).astype(np.float32)[:, None] * towards
        for k, weights, gradient, rate in (
            (1, softmax, np.stack((-pull, pull), 1), RATE / 5),
            (2, bias, np.array([-wrong.sum(), wrong.sum()]), RATE),
        ):
            past[k] += gradient**2
            weights -= (rate * gradient / np.sqrt(past[k])).astype(weights.dtype)
    values = np.rint((vectors @ (softmax[:, 1] - softmax[:, 0])) * STEPS).astype(np.int32)
    return Model(values, float(bias[1] - bias[0]), window)


def _cut(text: bytes, window: int) -> Iterator[bytes]:
    """A long text in pieces of whole words, each beginning with the last ``window - 1`` words of the one before."""
    if len(text) <= BLOCK:
        yield text
        return
    starts, ends = word_bounds(np.frombuffer(text, np.uint8), _gap)
    first = stop = 0
    while stop < len(starts):
        stop = max(first + window, int(np.searchsorted(ends, starts[first] + BLOCK, "right")))
        stop = min(stop, len(starts))
        yield text[starts[first] : ends[stop - 1]]
        first = stop - (window - 1)


def _blocks(texts: list[bytes], window: int):
    """Runs of pieces of about ``BLOCK`` bytes with the number of each piece's text."""
    pieces, owners, size = [], [], 0
    for k, text in enumerate(texts):
        for piece in _cut(text, window):
            if pieces and size + len(piece) > BLOCK:
                yield pieces, owners
                pieces, owners, size = [], [], 0
            pieces.append(piece)
            owners.append(k)
            size += len(piece)
    if pieces:
        yield pieces, owners


def scores(texts: list[bytes], model: Model) -> list[float]:
    """The softmax of each text's most toxic window."""
    best = np.full(len(texts), -np.inf)
    for pieces, owners in _blocks(texts, model.window):
        found = bags(pieces)
        logits = np.rint(word_logits(found, model.values.astype(np.int64))).astype(np.int64)
        some = np.flatnonzero(found.counts > 0)
        np.maximum.at(best, np.array(owners)[some], _worst(found, logits, model.window)[2] / STEPS)
    best[np.isneginf(best)] = 0.0
    with np.errstate(over="ignore"):
        return (1 / (1 + np.exp(-(best + model.bias)))).tolist()


def held_out(doc_id) -> F.Column:
    """One fifth of the ids, by CRC-32 of the id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> DataFrame:
    """(place, text, toxic) of the labelled documents to fit with, none of them held out."""
    given = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "toxic")
    given = given.groupBy("id").agg((F.max(F.abs("toxic")) > 0).cast("int").alias("toxic")).where(~held_out(F.col("id")))
    # More ids than rows are asked for, as some may have no document.
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where(F.col("id").isNotNull())
    ids = texts.select("id").distinct().join(given, "id")
    place = F.xxhash64(F.lit("toxicity"), F.col("id"))
    chosen = ids.withColumn("place", place).orderBy("place", "id").limit(rows)
    # Of several texts of one id that with the smallest hash.
    one = texts.join(F.broadcast(chosen), "id").groupBy("id", "place", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    sample = write_table(one, "labelled")
    total = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).over(Window.orderBy("place", "id"))
    fits = sample.select("id", total.alias("total")).where(F.col("total") <= size).select("id")
    return sample.join(F.broadcast(fits), "id").select("place", "text", "toxic")


def trained(docs: DataFrame, labels: DataFrame, window: int = WINDOW, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Model:
    """A model fitted in one task on the bounded sample; its numbers, of fixed size, come to the driver."""

    def emit(batches):
        import pyarrow as pa

        given = [r for b in batches for r in zip(b.column(0).to_pylist(), utf8(b.column(1)), b.column(2).to_pylist(), strict=True)]
        if given:
            given.sort()
            model = fitted([t for _, t, _ in given], np.array([y for _, _, y in given], np.float64), window)
            yield pa.RecordBatch.from_pydict({"values": [model.values.tobytes()], "bias": [model.bias]})

    rows_ = labelled_sample(docs, labels, rows, size).coalesce(1)
    found = map_arrow(rows_, emit, "values binary, bias double").collect()
    if not found:
        return fitted([], np.zeros(0), window)
    return Model(np.frombuffer(bytes(found[0]["values"]), np.int32), found[0]["bias"], window)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with ``score`` and ``predicted``; columns of these names are replaced."""
    names = ("score", "predicted")
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])
    text_at = [c.lower() for c in source.columns].index("text")

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            found = scores(utf8(batch.column(text_at)), model)
            new = [pa.array(found, pa.float64()), pa.array([int(s >= 0.5) for s in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])

    schema = source.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    return map_arrow(source, emit, schema)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")
    model = trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
