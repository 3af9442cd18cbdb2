"""Token counts from pre-token frequencies: pieces are counted once per distinct pre-token, ids are never kept."""

from __future__ import annotations

import os
import re
from array import array
from collections import defaultdict, deque
from functools import lru_cache
from itertools import count

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muara.llm.common import documents, map_arrow, write_table

# The byte-level pre-token pattern for code points below U+0250, with the classes for letters,
# numbers and white space written out.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "
LATIN = (
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
_latin = re.compile(LATIN)
_beyond = re.compile("[^\x00-ɏ]")

#: Characters of text of one block of documents, and documents; a block shares one list of pre-tokens.
BLOCK_CHARS, BLOCK_DOCUMENTS = 32_000_000, 1 << 16
#: Partial sums that a task holds before it adds them up, and passes them on where that leaves more than half.
HELD_SUMS = 2_000_000


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _pieces_of(path: str, tokens: list[str]) -> np.ndarray:
    encoded = _tokenizer(path).encode_batch_fast(tokens, add_special_tokens=False)
    return np.fromiter((len(e) for e in encoded), np.int64, len(tokens))


@lru_cache(maxsize=4)
def _byte_characters(path: str) -> dict[str, int]:
    """The library's printable stand-in of each byte, read from how it shows the 256 bytes."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def pre_tokens(text: str, path: str, specials: list[str]) -> list[str]:
    """The pre-tokens of a text between special strings.

    Latin text goes through the pattern above; a text with code points from U+0250 on through the library's own
    splitter, so that both use the same Unicode tables.
    """
    parts = [text]
    for special in specials:
        parts = [p for part in parts for p in part.split(special)]
    tokens: list[str] = []
    for part in parts:
        if not _beyond.search(part):
            tokens += _latin.findall(part)
        elif part:
            splitter, table = _tokenizer(path).pre_tokenizer, _byte_characters(path)
            for shown, _ in splitter.pre_tokenize_str(part):
                tokens.append(bytes(table[c] for c in shown).decode("utf-8", "replace"))
    return tokens


def _specials(path: str) -> list[str]:
    added = _tokenizer(path).get_added_tokens_decoder().values()
    return sorted((t.content for t in added), key=len, reverse=True)


def _blocks(batches):
    """Queues of (id, text) of about BLOCK_CHARS; a longer text is a block of its own."""
    block, size = deque(), 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            if block and (size + len(text) > BLOCK_CHARS or len(block) == BLOCK_DOCUMENTS):
                yield block
                block, size = deque(), 0
            block.append((doc, text))
            size += len(text)
    if block:
        yield block


def distinct_pre_tokens(docs: DataFrame, path: str) -> DataFrame:
    def emit(batches):
        import pyarrow as pa

        specials = _specials(path)
        for block in _blocks(batches):
            seen: set[str] = set()
            for _, text in block:
                seen.update(pre_tokens(text, path, specials))
            yield pa.RecordBatch.from_pydict({"token": pa.array(sorted(seen), pa.string())})

    return map_arrow(docs.select("doc_id", "text"), emit, "token string").distinct()


def piece_counts(tokens: DataFrame, path: str) -> DataFrame:
    """``(token, pieces)``: each pre-token goes through the vocabulary once."""

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            values = batch.column(0).to_pylist()
            if values:
                yield pa.RecordBatch.from_pydict({"token": batch.column(0), "pieces": pa.array(_pieces_of(path, values))})

    return map_arrow(tokens, emit, "token string, pieces long")


def numbered_documents(docs: DataFrame, path: str) -> DataFrame:
    """``block, at, doc_id, n_bytes, n_special``: each document's place in its block.

    Blocks are numbered along the scan, which Spark repeats in the same order when a task is lost.
    """

    def emit(batches):
        import pyarrow as pa

        specials, part = _specials(path), TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches)):
            texts = [text for _, text in block]
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(np.full(len(block), (part << 16) | number, np.int64)),
                    "at": pa.array(np.arange(len(block), dtype=np.int64)),
                    "doc_id": pa.array([doc for doc, _ in block], pa.int64()),
                    "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                    "n_special": pa.array([sum(t.count(x) for x in specials) for t in texts], pa.int64()),
                }
            )

    columns = "block long, at long, doc_id long, n_bytes long, n_special long"
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), emit, columns)


def _binary(lengths: np.ndarray, data: np.ndarray):
    """An Arrow binary column from all its bytes in a row."""
    import pyarrow as pa

    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and all bytes of an Arrow binary column."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return np.diff(offsets), data


def frequencies(docs: DataFrame, path: str) -> DataFrame:
    """Per-document pre-token frequencies, one row per block and pre-token.

    ``places`` holds three bytes for each document that has the pre-token: two for its place in the block, one for
    how often, more than 255 times in several entries. Copies of a pre-token collapse before the shuffle, so a very
    common one has one row per block.
    """

    def emit(batches):
        import pyarrow as pa

        specials, part = _specials(path), TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches)):
            ids: defaultdict[str, int] = defaultdict(count().__next__)
            met, sizes = array("i"), []
            while block:  # a text goes once it is split
                tokens = pre_tokens(block.popleft()[1], path, specials)
                met.extend(map(ids.__getitem__, tokens))
                sizes.append(len(tokens))
            key = np.frombuffer(met, np.int32).astype(np.int64) << 16
            key |= np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
            del met
            key, times = np.unique(key, return_counts=True)
            entries = -(-times // 255)
            key, times = np.repeat(key, entries), np.repeat(times, entries)
            last = np.cumsum(entries) - 1
            left = times[last] - 255 * (entries - 1)
            times = np.full(len(key), 255, np.int64)
            times[last] = left
            records = np.column_stack((key & 0xFF, (key >> 8) & 0xFF, times)).astype(np.uint8)
            ends = np.searchsorted(key >> 16, np.arange(len(ids)), "right")
            names, rows = list(ids), np.diff(ends, prepend=0)
            for low in range(0, len(names), 100_000):
                high = min(len(names), low + 100_000)
                first, stop = ends[low] - rows[low], ends[high - 1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array(np.full(high - low, (part << 16) | number, np.int64)),
                        "token": pa.array(names[low:high], pa.string()),
                        "places": _binary(rows[low:high] * 3, records[first:stop]),
                    }
                )

    return map_arrow(docs.select("doc_id", "text"), emit, "block long, token string, places binary")


def _block_sums(rows: DataFrame) -> DataFrame:
    """``block, sums``: packed (place, tokens) of frequency times pieces, added up inside a task first."""

    def merged(keys, weights):
        keys, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, back, np.concatenate(weights))
        return [keys], [total]

    def flush(keys, weights):
        import pyarrow as pa

        (key,), (weight,) = merged(keys, weights)
        block, at = key >> 16, (key & 0xFFFF).astype("<u2")
        cuts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))).tolist()
        packed = [at[a:b].tobytes() + weight[a:b].astype("<i8").tobytes() for a, b in zip(cuts, [*cuts[1:], len(key)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(block[cuts]), pa.array(packed, pa.binary())], names=["block", "sums"])

    def emit(batches):
        keys, weights = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths, data = _bytes_of(batch.column(1))
            records = data.reshape(-1, 3).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), lengths // 3)
            keys.append((batch.column(0).to_numpy()[row] << 16) | records[:, 0] | (records[:, 1] << 8))
            weights.append(records[:, 2] * batch.column(2).to_numpy()[row])
            if sum(map(len, keys)) > HELD_SUMS:
                keys, weights = merged(keys, weights)
                if 2 * len(keys[0]) > HELD_SUMS:
                    yield from flush(keys, weights)
                    keys, weights = [], []
        if keys:
            yield from flush(keys, weights)

    return map_arrow(rows.select("block", "places", "pieces"), emit, "block long, sums binary")


def _document_sums(own: DataFrame, sums: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each block's documents."""

    def add(documents_, parts):
        import pyarrow as pa

        total = np.zeros(1 << 16, np.int64)
        for packed in parts["sums"].to_pylist():
            n = len(packed) // 10
            total[np.frombuffer(packed, "<u2", n)] += np.frombuffer(packed, "<i8", n, 2 * n)
        tokens = total[documents_["at"].to_numpy()] + documents_["n_special"].to_numpy()
        return pa.Table.from_arrays([documents_["doc_id"], documents_["n_bytes"], pa.array(tokens)], names=["doc_id", "n_bytes", "n_tokens"])

    return own.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(add, "doc_id long, n_bytes long, n_tokens long")


def token_counts(docs: DataFrame, path: str, limit: int = 512, stored: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    Documents are met by their place in a scan that is made twice, so its order must not change. Only a scan of stored
    files has such an order: ``stored`` says that ``docs`` is one. Other rows, such as those of a shuffle, are written
    to the shared folder first.

    Null text counts as empty: no bytes, no tokens. Repeated rows and equal or null ids each keep their row. Extra
    columns are ignored.
    """
    if not stored:
        docs = write_table(docs.select(F.col("doc_id").cast("long"), "text"), "texts")
    pieces = piece_counts(distinct_pre_tokens(docs, path), path)
    sums = _block_sums(frequencies(docs, path).join(pieces, "token"))
    total = _document_sums(numbered_documents(docs, path), sums)
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), stored=True)
