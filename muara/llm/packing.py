"""Best-fit packing of token sequences, each partition's bin count held against a proved lower bound.

Partitions are packed on their own by best-fit decreasing. Dual feasible functions bound from below how many bins
a partition needs: where the bound is met, the packing is certified and final. The other partitions give the pieces
of their bins that have room left to an exchange: these are dealt out anew, over fewer partitions, and packed again.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muara.llm.common import documents, map_arrow, write_table
from muara.llm.token_counts import LETTERS, NUMBERS, SPACES

# The vocabulary's pre-token pattern for lower-case text below U+0250.
_latin = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
_beyond = re.compile("[^\x00-ɏ]")
# The printable bytes of byte-level vocabularies, which stand for themselves; the others follow from 256 on.
_printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_shown = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _printable)}

#: Pre-tokens whose ids a Python worker remembers; older ones go when twice as many have been met.
REMEMBERED = 500_000
#: Pieces that one task packs.
PIECES_PER_PARTITION = 50_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PieceIds:
    """Ids of whole texts as little-endian 32-bit bytes, from the remembered ids of their lower-case pre-tokens.

    The vocabulary's rules never reach over a pre-token, so a text's ids are those of its pre-tokens in turn. Latin
    text is split by the pattern below; a text with code points from U+0250 on, or with a special string, goes
    through the vocabulary whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = _tokenizer(path)
        self.model = Tokenizer(self.whole.model)  # the merges alone, for what is normal and split already
        self.new, self.old = {}, {}
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def of_texts(self, texts: list[str]) -> list[bytes]:
        small = [t.lower() for t in texts]
        plain = [not _beyond.search(t) and not any(s in t for s in self.specials) for t in small]
        tokens = [_latin.findall(t) if p else None for t, p in zip(small, plain, strict=True)]
        unknown = set().union(*(t for t in tokens if t)).difference(self.new)
        missing = []
        for token in unknown:
            known = self.old.get(token)
            if known is None:
                missing.append(token)
            else:
                self.new[token] = known
        shown = [t if t.isascii() and t.isprintable() else t.encode().decode("latin-1").translate(_shown) for t in missing]
        for token, found in zip(missing, self.model.encode_batch_fast(shown, add_special_tokens=False), strict=True):
            self.new[token] = array("I", found.ids).tobytes()
        ids = self.new.__getitem__
        out = [b"".join(map(ids, t)) if p else self._whole(x) for x, p, t in zip(texts, plain, tokens, strict=True)]
        if len(self.new) > REMEMBERED:
            self.new, self.old = {}, self.new
        return out

    def _whole(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()


def _groups(batch, size: int = 1 << 20):
    """Ids and texts of a batch, about ``size`` characters at a time."""
    ids, texts, held = [], [], 0
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        ids.append(doc)
        texts.append(text or "")
        held += len(texts[-1])
        if held >= size:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


@lru_cache(maxsize=2)
def _piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each text's ids and ``end_id``, cut where longer than a bin."""

    def emit(batches):
        import pyarrow as pa

        known, end = _piece_ids(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for docs_, texts in _groups(batch):
                for doc, ids in zip(docs_, known.of_texts(texts), strict=True):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[4 * start : 4 * (start + capacity)]
                        out.append((doc, piece, start, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(NAMES))

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), emit, PIECE)


NAMES = ("doc_id", "piece", "start", "length", "ids_crc32")
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECE}, sequence_id long, offset long, filled long, part_bins long, part_bound long"


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing of ``sizes`` needs, the best of several dual feasible functions.

    Each function keeps every set that fits a bin within the bin, so the sum of its values bounds the bins.
    """
    if not len(sizes):
        return 0
    sizes = np.sort(sizes.astype(np.int64))
    best = -(-int(sizes.sum()) // capacity)
    sums = np.concatenate(([0], np.cumsum(sizes)))
    small = np.arange(0, capacity // 2 + 1)  # below the threshold: nothing; above capacity less it: a whole bin
    low, high = np.searchsorted(sizes, small, "left"), np.searchsorted(sizes, capacity - small, "right")
    high = np.maximum(low, high)
    best = max(best, int((-(-((len(sizes) - high) * capacity + sums[high] - sums[low]) // capacity)).max()))
    for k in range(1, 31):  # sizes rounded down to k-ths of a bin, save where (k + 1) times the size is whole bins
        scaled = sizes * (k + 1)
        exact = scaled % capacity == 0
        total = int(np.where(exact, sizes * k, (scaled // capacity) * capacity).sum())
        best = max(best, -(-total // (capacity * k)))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each size, in the order given, and what each bin holds.

    Open bins are kept by their room; a bit mask of the rooms in use gives the smallest that fits.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, held = 0, []
    for i, size in enumerate(sizes.tolist()):
        fitting = used >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                used &= ~(1 << room)
        else:
            room, number = capacity, len(held)
            held.append(0)
        bins[i], offsets[i] = number, capacity - room
        held[number] += size
        left = room - size
        if left:
            by_room[left].append(number)
            used |= 1 << left
    return bins, offsets, held


def pack_partitions(rows: DataFrame, partitions: int, capacity: int, round_number: int) -> DataFrame:
    """Deal pieces out evenly whatever their ids, and pack each partition by best-fit decreasing."""

    def emit(batches):
        import pyarrow as pa

        table = pa.Table.from_batches(list(batches)) if batches else None
        if table is None or not table.num_rows:
            return
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        table = table.sort_by(order)
        sizes = table.column("length").to_numpy()
        bins, offsets, held = best_fit(sizes, capacity)
        base = (round_number << 56) | (TaskContext.get().partitionId() << 28)
        table = table.append_column("sequence_id", pa.array(bins + base)).append_column("offset", pa.array(offsets))
        table = table.append_column("filled", pa.array(np.array(held, np.int64)[bins]))
        table = table.append_column("part_bins", pa.array(np.full(len(sizes), len(held), np.int64)))
        table = table.append_column("part_bound", pa.array(np.full(len(sizes), lower_bound(sizes, capacity), np.int64)))
        yield from table.to_batches()

    names = list(NAMES)
    return map_arrow(rows.select(*names).repartition(partitions), _listed(emit), PLACED)


def _listed(emit):
    def run(batches):
        kept = [b for b in batches if b.num_rows]
        yield from emit(kept) if kept else ()

    return run


def pack(docs: DataFrame, path: str, capacity: int = 2048, rounds: int = 3) -> DataFrame:
    """Every document's pieces with ``sequence_id`` and ``offset``, in as few sequences as the rounds reach.

    Null text counts as empty and gives one piece with the end id alone. Repeated rows and equal or null ids are
    packed row by row. Extra columns are ignored. ``part_bins`` and ``part_bound`` are the bins of the partition
    that packed the row and the bound for it.
    """
    cut = write_table(pieces(docs, path, capacity), "pieces")
    return pack_pieces(cut, capacity, rounds)


def pack_pieces(cut: DataFrame, capacity: int, rounds: int) -> DataFrame:
    partitions = cut.count() // PIECES_PER_PARTITION + 1
    placed, final = write_table(pack_partitions(cut, partitions, capacity, 0), "packed"), []
    for number in range(1, rounds + 1):
        loose = (F.col("part_bins") > F.col("part_bound")) & (F.col("filled") < capacity)
        waiting = placed.where(loose)
        before, rows = waiting.agg(F.countDistinct("sequence_id"), F.count(F.lit(1))).first()
        if not rows:
            break
        again = write_table(pack_partitions(waiting, rows // PIECES_PER_PARTITION + 1, capacity, number), "packed")
        after = again.agg(F.countDistinct("sequence_id")).first()[0]
        if after > before:
            break
        final.append(placed.where(~loose))
        placed = again
        if after == before:
            break
    for part in final:
        placed = placed.unionByName(part)
    return placed


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(*NAMES, "sequence_id", "offset", "part_bins", "part_bound")
