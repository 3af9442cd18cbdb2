"""Benchmark decontamination: rare word-pair seeds find candidate passages, Smith-Waterman alignment scores them.

A seed is a pair of words that stand next to each other or one word apart, on either side, so a pair outlives an edit
within it or next to it. A copy that the threshold accepts cannot lack many pairs: with m of an item's n words matched
and e edits the alignment scores 2m - e, at least 2tn at threshold t; two edits or more part at most e / 2 <= m - tn of
the m - 1 neighbouring matches, so tn - 1 places of the item at least have a pair in the copy. Leaving out fewer of
the item's most frequent places than that leaves every such copy a seed. Seeds meet the documents' pairs in a join,
diagonal bands with enough places of an item are aligned with it word by word.

A share alone says little about short items, so an alignment must also be worth ENOUGH equal words, or the whole item
if that is shorter. Items of fewer than TELLING words stand in any text: ``contaminated`` reports them, but they take
no document away; give such a question together with its answer as one item.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muara.llm.common import documents, free_names, map_arrow, mixed, utf8, word_bounds, word_hashes, write_table

#: Distances of the two words of a seed; an item of fewer than PAIRED words has its single words as seeds (distance 0).
STEPS = (1, 2)
PAIRED = 3
#: Places of an item that must meet a band of a document before the two are aligned, where the item's bound allows it.
MET = 3
#: Alignment: points for equal words, for different ones and for a word without partner.
EQUAL, DIFFERENT, GAP = 2, -1, -1
#: Least share of an item's full score that counts as contamination.
THRESHOLD = 0.5
#: Least points of an alignment, in equal words; a shorter item must stand in a document as a whole.
ENOUGH = 8
#: Words of the shortest item that takes a document away.
TELLING = 5
#: Bits of the first sieve, a fixed size; what passes it wrongly is dropped by the join.
SIEVE_BITS = 1 << 23
#: An odd factor that tells the first word of a pair from the second.
PAIR_FACTOR = 0xD6E8FEB86659FD93

_lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_blank = np.array([b < 48 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 127 for b in range(256)])


class Words:
    """Lower-case words of one text (letters, digits and all non-ASCII bytes) and their hashes."""

    def __init__(self, text: bytes):
        self.text = text.translate(_lower)
        data = np.frombuffer(self.text, np.uint8)
        self.starts, self.ends = word_bounds(data, _blank)
        self.hashes = word_hashes(data, self.starts, self.ends)

    def grams(self, step: int) -> np.ndarray:
        """Hashes of the pairs of words ``step`` apart, the same for equal words at any step; of single words for 0."""
        if not step:
            return mixed(self.hashes)
        return mixed(self.hashes[:-step] * np.uint64(PAIR_FACTOR) + self.hashes[step:])

    def joined(self, low: int, high: int) -> str:
        spans = zip(self.starts[low:high].tolist(), self.ends[low:high].tolist(), strict=True)
        return b" ".join(self.text[a:b] for a, b in spans).decode("utf-8", "replace")


def item_table(items: DataFrame) -> DataFrame:
    """``item, item_id, words, n_words`` with a number for each row; items without words have no seeds."""

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            found = [Words(t) for t in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([w.joined(0, len(w.hashes)) for w in found], pa.string()),
                    pa.array([len(w.hashes) for w in found], pa.int64()),
                ],
                names=["item", "item_id", "words", "n_words"],
            )

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), "text")
    return write_table(map_arrow(rows, emit, "item long, item_id long, words string, n_words long"), "items").where("n_words > 0")


def steps_of(n_words: int) -> tuple[int, ...]:
    return STEPS if n_words >= PAIRED else (0,)


def item_grams(items: DataFrame) -> DataFrame:
    """``item, at, gram``: every seed candidate of every item, by the place of its first word."""

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = Words(text)
                grams = [words.grams(step) for step in steps_of(len(words.hashes))]
                at = np.concatenate([np.arange(len(g), dtype=np.int64) for g in grams])
                yield pa.RecordBatch.from_pydict({"item": np.full(len(at), item, np.int64), "at": at, "gram": np.concatenate(grams).view(np.int64)})

    return map_arrow(items.select("item", "words"), emit, "item long, at long, gram long")


def sieve(grams: DataFrame) -> np.ndarray:
    """A fixed number of bits, those of the given n-grams set, made in one task from distinct bit numbers."""

    def emit(batches):
        import pyarrow as pa

        bits = np.zeros(SIEVE_BITS // 8, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        yield pa.RecordBatch.from_pydict({"bits": [bits.tobytes()]})

    places = grams.select(F.col("gram").bitwiseAND(SIEVE_BITS - 1).alias("at")).distinct()
    row = map_arrow(places.coalesce(1), emit, "bits binary").first()
    return np.frombuffer(row["bits"], np.uint8) if row else np.zeros(SIEVE_BITS // 8, np.uint8)


def _passing(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    at = grams & np.uint64(SIEVE_BITS - 1)
    return np.flatnonzero((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1)


def document_frequency(docs: DataFrame, bits: np.ndarray, steps: list[int]) -> DataFrame:
    """``gram, n``: how many documents hold each n-gram that passes the sieve; all documents are counted."""

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for text in utf8(batch.column(0)):
                words = Words(text)
                for step in steps:
                    grams = words.grams(step)
                    found.append(np.unique(grams[_passing(bits, grams)]))
            grams, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_pydict({"gram": grams.view(np.int64), "n": n.astype(np.int64)})

    return map_arrow(docs.select("text"), emit, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def passages(docs: DataFrame, bits: np.ndarray, steps: list[int], reach: int, least: int) -> DataFrame:
    """``key, doc_id, first, words, hits``: words within ``reach`` of a run of ``least`` places that pass the sieve."""

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            rows: dict[str, list] = {"key": [], "doc_id": [], "first": [], "words": [], "hits": []}
            for key, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                words = Words(text)
                at, grams = [], []
                for step in steps:
                    own = words.grams(step)
                    hit = _passing(bits, own)
                    at.append(hit)
                    grams.append(own[hit])
                at, grams = np.concatenate(at), np.concatenate(grams)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, grams = at[order], grams[order].view(np.int64)
                cuts = [0, *(np.flatnonzero(np.diff(at) > reach) + 1).tolist(), len(at)]
                for low, high in zip(cuts, cuts[1:], strict=False):
                    if 1 + np.count_nonzero(np.diff(at[low:high])) < least:
                        continue
                    first = max(0, int(at[low]) - reach)
                    rows["key"].append(key)
                    rows["doc_id"].append(doc)
                    rows["first"].append(first)
                    rows["words"].append(words.joined(first, int(at[high - 1]) + reach))
                    rows["hits"].append([{"gram": g, "place": a - first} for g, a in zip(grams[low:high].tolist(), at[low:high].tolist(), strict=True)])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("gram", pa.int64()), ("place", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], names=list(rows))

    columns = "key long, doc_id long, first long, words string, hits array<struct<gram:long,place:long>>"
    return map_arrow(docs.select(_key().alias("key"), F.col("doc_id").cast("long"), "text"), emit, columns)


def _key():
    return F.xxhash64("doc_id", "text")


def alignment_score(item: np.ndarray, passage: np.ndarray) -> int:
    """Smith-Waterman with a linear gap cost, a row of the table at a time."""
    best, steps = 0, np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, np.int64)
    for word in item:
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(passage == word, EQUAL, DIFFERENT))
        row = np.maximum.accumulate(new + steps) - steps
        best = max(best, int(row.max()))
    return best


def aligned(candidates: DataFrame, threshold: float) -> DataFrame:
    """``key, doc_id, item_id, score`` of enough equal words, from rows of passage and item words, cut around the seeds."""
    drift = 2 * (1 - threshold)  # words put in or left out, a word of the item, that the threshold allows

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            scores = []
            for row in batch.to_pylist():
                numbers: dict[str, int] = {}
                item = np.array([numbers.setdefault(w, len(numbers)) for w in row["item_words"].split(" ")])
                slack = math.ceil(drift * len(item)) + 1
                low, high = max(0, row["low"] - slack), row["high"] + len(item) + slack
                passage = np.array([numbers.get(w, -1) for w in row["words"].split(" ")[low:high]])
                score = alignment_score(item, passage)
                scores.append(score / (EQUAL * len(item)) if score >= EQUAL * min(len(item), ENOUGH) else 0.0)
            ids = [batch.column(batch.schema.get_field_index(c)) for c in ("key", "doc_id", "item_id")]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(scores, pa.float64())], names=["key", "doc_id", "item_id", "score"])

    return map_arrow(candidates, emit, "key long, doc_id long, item_id long, score double")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, least_words: int = 1) -> DataFrame:
    """``key, doc_id, item_id, score``: every document and item whose best alignment reaches the threshold.

    It must also be worth ENOUGH equal words, or the whole item; items of fewer than ``least_words`` are not looked for.

    ``key`` is ``xxhash64(doc_id, text)``; repeated rows give one result, and equal ids with different texts one for
    each text. Null and empty texts meet nothing. Extra columns are ignored. No items or documents: no rows.
    """
    known = item_table(items).where(F.col("n_words") >= least_words)
    longest, shortest = known.agg(F.max("n_words"), F.min("n_words")).first()
    if longest is None:
        return docs.sparkSession.createDataFrame([], "key long, doc_id long, item_id long, score double")
    steps = sorted({*steps_of(shortest), *steps_of(longest)})
    grams = write_table(item_grams(known), "item-grams")
    counted = document_frequency(docs, sieve(grams), steps)
    ranked = grams.join(counted, "gram", "left").groupBy("item", "at").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    # Of an item's places at least ``held`` stand in each copy; all but held - need of them, the rarest, are seeds.
    held = F.when(F.col("n_words") < PAIRED, 1).otherwise(F.ceil(F.lit(threshold) * F.col("n_words") - 1e-9) - 1)
    need = F.greatest(F.lit(1), F.least("held", F.lit(MET)))
    bound = known.select("item", "n_words", held.alias("held")).withColumn("need", need)
    places = F.when(F.col("n_words") < PAIRED, F.col("n_words")).otherwise(F.col("n_words") - 1)
    bound = bound.withColumn("taken", places - F.greatest("held", F.lit(1)) + F.col("need"))
    order = Window.partitionBy("item").orderBy("n", "at")  # an item's words, not the documents'
    chosen = ranked.withColumn("rank", F.row_number().over(order)).join(bound, "item").where("rank <= taken")
    seeds = write_table(chosen.select("item", "at", "need", "n_words").join(grams, ["item", "at"]), "seeds")
    least = seeds.agg(F.min("need")).first()[0]
    reach = math.ceil((3 - 2 * threshold) * longest) + max(STEPS)
    found = write_table(passages(docs, sieve(seeds), steps, reach, least), "passages")
    met = found.select("key", "first", F.inline("hits")).join(seeds, "gram")
    # The diagonals of a copy differ by the words put in or left out: two neighbouring bands of that width hold them.
    width = F.ceil(F.lit(2 * (1 - threshold)) * F.col("n_words")) + 1
    diagonal = F.col("place") - F.col("at")
    band = F.floor(diagonal / width)
    met = met.select("key", "first", "item", "at", "need", diagonal.alias("diagonal"), F.explode(F.array(band, band - 1)).alias("band"))
    bands = met.groupBy("key", "first", "item", "band", "need").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.size(F.collect_set("at")).alias("n")
    )
    pairs = write_table(bands.where("n >= need").select("key", "first", "item", "low", "high").distinct(), "pairs")
    whole = found.select("key", "doc_id", "first", "words").join(pairs.select("key", "first").distinct(), ["key", "first"], "left_semi")
    texts = known.select("item", "item_id", F.col("words").alias("item_words"))
    scored = aligned(pairs.join(whole.dropDuplicates(["key", "first"]), ["key", "first"]).join(texts, "item"), threshold)
    return scored.groupBy("key", "doc_id", "item_id").agg(F.max("score").alias("score")).where(F.col("score") >= threshold)


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that hold no benchmark item of TELLING words or more, with their columns as they are."""
    (own,) = free_names(docs, "own_key")
    bad = contaminated(docs, items, least_words=TELLING).select("key").distinct().withColumnRenamed("key", own)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(*columns, _key().alias(own)).join(bad, own, "left_anti").select(*columns)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))
