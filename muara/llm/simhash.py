"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into so few segments that, of two linked fingerprints, one segment differs by one bit at most.
Each segment is indexed once per bit with that bit left out; equal variants meet in an equality join, and the whole
fingerprints are compared there. Fingerprints that are equal are one row from the start, so copies never meet.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from muara.llm.common import documents, free_names, map_arrow, shuffle_partitions, write_table
from muara.llm.components import components

BITS = 64
#: Members of a variant's list that are compared in one task; a longer list is cut into blocks, and every two meet.
BLOCK = 4096


def fingerprints(docs: DataFrame, shingle: int = 4, also: Sequence[Column] = ()) -> DataFrame:
    """``doc_id, fp`` (a signed 64-bit number) of each row's whole text, and ``also``; no words: zero."""

    def of_text(text: bytes) -> int:
        from xxhash import xxh64_intdigest

        words = text.lower().split()  # bytes: A-Z and the six ASCII blanks only
        if not words:
            return 0
        joined = memoryview(b" ".join(words))
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-1].tolist()]
        stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
        hashes = [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, stops, strict=False)]
        total = np.zeros(BITS, np.int64)
        for low in range(0, len(hashes), 100_000):
            part = np.array(hashes[low : low + 100_000], "<u8")
            total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<i8")[0])

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            found = [of_text((t or "").encode()) for t in batch.column(1).to_pylist()]
            own = [batch.column(0), pa.array(found, pa.int64()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(own, names=["doc_id", "fp", *batch.schema.names[2:]])

    rows = docs.select(F.col("doc_id").cast("long"), "text", *also)
    schema = StructType([StructField("doc_id", LongType()), StructField("fp", LongType()), *rows.schema.fields[2:]])
    return map_arrow(rows, emit, schema)


def segments(distance: int) -> list[tuple[int, int]]:
    """``(first bit, bits)``: fewest segments of which one differs by one bit at most when ``distance`` bits differ."""
    n = distance // 2 + 1
    return [(BITS * i // n, BITS * (i + 1) // n - BITS * i // n) for i in range(n)]


def variants(fps: DataFrame, distance: int) -> DataFrame:
    """``variant, fp``: for each segment and each of its bits, the segment without that bit."""
    keys = []
    for number, (low, size) in enumerate(segments(distance)):
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << size) - 1))
        for bit in range(size):
            rest = part.bitwiseAND(F.lit(((1 << size) - 1) ^ (1 << bit)))
            keys.append(rest.bitwiseOR(F.lit(((number << 6) | bit) << 40)))
    return fps.select("fp", F.explode(F.array(*keys)).alias("variant"))


def links(fps: DataFrame, distance: int) -> DataFrame:
    """``a, b``: links between different fingerprints, enough of them to connect all that any link connects.

    The rows of a variant meet in one task and give a spanning forest of their links, so that a large group of near
    copies gives a row for each member and variant at most. A list of over BLOCK members is passed on instead, dealt
    into blocks, and every two of its blocks meet in a task of their own.
    """
    n = shuffle_partitions(fps.sparkSession)
    listed = variants(fps, distance).repartition(n, "variant").sortWithinPartitions("variant")

    def small(batches):
        held, long_list = [], None
        for variant, fp, last in _lists(batches):
            if variant == long_list:
                yield _batch(fp, None, variant)
                continue
            held.append(fp)
            if sum(map(len, held)) > BLOCK:
                yield _batch(np.concatenate(held), None, variant)
                held, long_list = [], variant
            elif last:
                members, held = np.concatenate(held), []
                if len(members) > 1:
                    yield _batch(*_forest(members, members[:0], distance), None)

    met = write_table(map_arrow(listed, small, "a long, b long, variant long"), "simhash-lists")
    found = met.where("variant is null").select("a", "b")
    waiting = met.where("variant is not null").select("variant", F.col("a").alias("fp"))
    sizes = waiting.groupBy("variant").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    home = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    member = waiting.join(sizes, "variant").select("variant", "fp", "blocks", home.alias("home"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = member.select("variant", "fp", "home", other).select(
        "variant", F.least("home", "other").alias("first"), F.greatest("home", "other").alias("second"), "home", "fp"
    )

    def blocks(key, table):
        first, second = key[1].as_py(), key[2].as_py()
        fp, home = table["fp"].to_numpy().view(np.uint64), table["home"].to_numpy()
        left, right = (fp, fp[:0]) if first == second else (fp[home == first], fp[home == second])
        return _table(*_forest(left, right, distance))

    large = pairs.groupBy("variant", "first", "second").applyInArrow(blocks, "a long, b long")
    return found.unionByName(large).distinct()


def _batch(a: np.ndarray, b: np.ndarray | None, variant: int | None):
    import pyarrow as pa

    columns = [a.view(np.int64), pa.nulls(len(a), pa.int64()) if b is None else b.view(np.int64)]
    named = pa.nulls(len(a), pa.int64()) if variant is None else np.full(len(a), variant, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in (*columns, named)], names=["a", "b", "variant"])


def _table(a: np.ndarray, b: np.ndarray):
    import pyarrow as pa

    return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})


def _lists(batches):
    """``variant, members, last`` of sorted batches, lists of one member left out; a list may come in parts."""
    held_variant, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        fp = batch.column(batch.schema.get_field_index("fp")).to_numpy().view(np.uint64)
        variant = batch.column(batch.schema.get_field_index("variant")).to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(variant[1:] != variant[:-1]) + 1, [len(variant)]))
        sizes = np.diff(cuts)
        # The first list may go on from the batch before, the last one into the next.
        wanted = np.flatnonzero(sizes > 1)
        wanted = np.unique(np.concatenate((wanted, [0, len(sizes) - 1])))
        for k in wanted.tolist():
            name, members = int(variant[cuts[k]]), fp[cuts[k] : cuts[k + 1]]
            if held is not None:
                yield held_variant, held, name != held_variant
            held_variant, held = name, members
    if held is not None:
        yield held_variant, held, True


def _forest(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within ``left``, or between ``left`` and ``right`` where there is one.

    Breadth first: each round compares one reached member with those not reached yet, so members of a dense group
    leave the comparison once they hang on it.
    """
    both = np.concatenate((left, right))
    side = np.zeros(len(both), bool)
    side[len(left) :] = True
    within = not len(right)
    a, b = [], []
    waiting = np.arange(len(both))
    while len(waiting):
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            at = queue.pop()
            near = np.bitwise_count(both[waiting] ^ both[at]) <= distance
            if not within:
                near &= side[waiting] != side[at]
            reached = waiting[near]
            if len(reached):
                a.append(np.full(len(reached), both[at], np.uint64))
                b.append(both[reached])
                waiting = waiting[~near]
                queue += reached.tolist()
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows and equal ids each keep their
    row; a null id is no id to reach, so ``component_id`` is null only where a group has no other. Extra columns
    are ignored.
    """
    marked = write_table(fingerprints(docs, shingle), "simhash")
    return marked.join(groups(marked, distance), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def groups(marked: DataFrame, distance: int) -> DataFrame:
    """``fp, component, component_id`` for every fingerprint; ``component`` is the group's smallest fingerprint."""
    classes = write_table(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    linked = write_table(links(classes.select("fp"), distance), "simhash-links")
    found = components(linked)
    grouped = classes.join(found, classes.fp == found.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    # Written first, so that neither side of the join is an aggregation and Spark can split a component with many members.
    least = write_table(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-least")
    return grouped.join(least, "component").select("fp", "component", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of each group, with its columns as they are: the one with the smallest id.

    A null id comes last; of rows with one id the text with the smallest hash stays, and of repeated rows one.
    """
    first, second, copy = free_names(docs, "key", "check", "copy")
    own = [F.xxhash64("doc_id", "text").alias(first), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(-1)).alias(second)]
    marked = write_table(fingerprints(docs, shingle, own), "simhash")
    label = groups(marked, distance)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", first, second)
    stays = marked.join(label, "fp").groupBy("component").agg(F.min(order).alias("stays")).select(f"stays.{first}", f"stays.{second}")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    copies = Window.partitionBy(first, second).orderBy(first)  # the join's own partitions and order
    kept = docs.select(*columns, *own).join(stays, [first, second])
    return kept.withColumn(copy, F.row_number().over(copies)).where(F.col(copy) == 1).select(*columns)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
