"""Anchors: the smallest hash in each window of a text, by which equal windows of different texts meet."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from muara.llm.common import equal_runs, map_arrow, utf8

#: Bytes of text whose anchors one block counts before they are dealt out.
BLOCK = 16 << 20


def packed_texts(docs: DataFrame) -> DataFrame:
    """``home, packed``: the texts of each document bucket, those of one batch compressed together.

    ``docs`` has ``doc_id, text, row, home``. Read by ``unpacked_texts``; a null text comes back empty.
    """

    def emit(batches):
        import pyarrow as pa
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            doc, text, row, home = batch.columns
            texts = utf8(text)
            homes = home.to_numpy()
            order = np.argsort(homes, kind="stable")
            known, ids = np.array([d.is_valid for d in doc]), np.array([d or 0 for d in doc.to_pylist()], "<i8")
            rows, out = row.to_numpy(), ([], [])
            for low, high in equal_runs(homes[order]):
                part = order[low:high]
                own = [texts[k] for k in part.tolist()]
                numbers = np.column_stack((known[part], ids[part], rows[part], [len(t) for t in own])).astype("<i8")
                out[0].append(int(homes[part[0]]))
                out[1].append(squeeze(np.array([len(own)], "<i8").tobytes() + numbers.tobytes() + b"".join(own)))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], names=["home", "packed"])

    return map_arrow(docs.select("doc_id", "text", "row", "home"), emit, "home long, packed binary")


def unpacked_texts(table) -> tuple[list[int | None], list[int], list[bytes]]:
    """Ids, row keys and texts of a document bucket, in the order of row keys."""
    import zstandard

    found = []
    for packed in table["packed"].to_pylist():
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        numbers, at = np.frombuffer(raw, "<i8", 4 * n, 8).reshape(n, 4).tolist(), 8 + 32 * n
        for known, doc, row, size in numbers:
            found.append((row, doc if known else None, raw[at : at + size]))
            at += size
    found.sort(key=lambda x: x[0])
    return [d for _, d, _ in found], [r for r, _, _ in found], [t for _, _, t in found]


def key48(anchor: np.ndarray) -> np.ndarray:
    return anchor >> np.uint64(16)


def pack48(keys: np.ndarray) -> tuple[bytes, bytes]:
    return (keys & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), (keys >> np.uint64(32)).astype("<u2").tobytes()


def unpack48(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, "<u4").astype(np.uint64) | (np.frombuffer(high, "<u2").astype(np.uint64) << np.uint64(32))


def _by_key(key: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return np.lexsort((shape, key)) if shape.any() else np.argsort(key, kind="stable")


def repeated_anchors(docs: DataFrame, buckets: int, runs_of: Callable) -> DataFrame:
    """``home, low, high``: for each document bucket, packed anchors of its texts that another text has as well.

    ``docs`` has ``doc_id, text, home``; rows with a null id have no anchors. ``runs_of`` gives ``row, anchor, shape,
    bytes`` for lists of texts; ``shape`` is a 32-bit hash of what stands around the anchor, or all zero. ``mixed``
    has a byte for each anchor: whether it was met in several shapes. Anchors that texts of one block share are
    settled there and go on as one entry.
    """
    nobody = 0xFFFFFFFF  # an entry that stands for texts which know already

    def blocks(batches):
        home, key = [], []
        size = 0
        for batch in batches:
            homes = batch.column(0).to_numpy(zero_copy_only=False)
            texts = utf8(batch.column(1))
            for row, anchor, shape, read in runs_of(texts):
                order = _by_key(anchor, shape)
                row, anchor, shape = row[order], anchor[order], shape[order]
                new = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (shape[1:] != shape[:-1])
                once = np.concatenate(([True], new))[: len(row)]
                home.append((homes[row[once]].astype(np.uint32), anchor[once], shape[once]))
                size += read
                if size >= BLOCK:
                    yield [np.concatenate(x) for x in zip(*home, strict=True)]
                    home, size = [], 0
        if home:
            yield [np.concatenate(x) for x in zip(*home, strict=True)]

    def emit(batches):
        import pyarrow as pa

        names = ["bucket", "known", "low", "high", "home", "shape"]
        kinds = [pa.int64(), pa.bool_(), *[pa.binary()] * 4]
        for home, anchor, shape in blocks(batches):
            order = np.argsort(anchor, kind="stable")
            home, anchor, shape = home[order], anchor[order], shape[order]
            first = np.concatenate(([True], anchor[1:] != anchor[:-1]))
            single = first & np.append(first[1:], True)
            out = []
            for known, rows in ((False, np.flatnonzero(first)), (True, np.flatnonzero(~single))):
                where = np.where(single[rows], home[rows], nobody) if not known else home[rows]
                target = (anchor[rows] % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(target, kind="stable")
                rows, where, target = rows[by], where[by], target[by]
                for low, high in equal_runs(target):
                    keys = pack48(key48(anchor[rows[low:high]]))
                    shapes = shape[rows[low:high]].astype("<u4").tobytes()
                    out.append((int(target[low]), known, *keys, where[low:high].astype("<u4").tobytes(), shapes))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def meet(table):
        import pyarrow as pa

        parts = [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)], [np.zeros(0, bool)]]
        for known, low, high, home, shape in zip(*(table.column(c).to_pylist() for c in ("known", "low", "high", "home", "shape")), strict=True):
            key = unpack48(low, high)
            for part, values in zip(parts, (key, np.frombuffer(home, "<u4"), np.frombuffer(shape, "<u4"), np.full(len(key), known)), strict=True):
                part.append(values)
        key, home, shape, known = (np.concatenate(p) for p in parts)
        order = _by_key(key, shape)
        key, home, shape, known = key[order], home[order], shape[order], known[order]
        edges = np.array([bounds[0] for bounds in equal_runs(key)], np.int64)
        which = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))[: len(key)]
        if len(key):
            # A text that knows, or a second entry beside this one, makes an anchor repeated; known rows stand for both.
            repeated = (np.add.reduceat(~known, edges) > 1)[which]
            several = (np.minimum.reduceat(shape, edges) < np.maximum.reduceat(shape, edges))[which]
            told = (repeated | known) & (home != nobody)
            key, home, several = key[told], home[told], several[told]
        else:
            several = np.zeros(0, bool)
        order = np.lexsort((key, home))
        home, key, several = home[order], key[order], several[order]
        once = np.concatenate(([True], (home[1:] != home[:-1]) | (key[1:] != key[:-1])))[: len(home)]
        home, key, several = home[once], key[once], several[once]
        rows = [(int(home[a]), *pack48(key[a:b]), several[a:b].astype(np.uint8).tobytes()) for a, b in equal_runs(home)]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.int64(), *[pa.binary()] * 3]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["home", "low", "high", "mixed"])

    entry = "bucket long, known boolean, low binary, high binary, home binary, shape binary"
    packed = map_arrow(docs.where("doc_id is not null").select("home", "text"), emit, entry)
    return packed.groupBy("bucket").applyInArrow(meet, "home long, low binary, high binary, mixed binary")


def answered(answers) -> tuple[np.ndarray, np.ndarray]:
    """A bucket's anchors in order, and which of them were met in several shapes."""
    keys, several = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for low, high, flags in zip(*(answers[c].to_pylist() for c in ("low", "high", "mixed")), strict=True):
        keys.append(unpack48(low, high))
        several.append(np.frombuffer(flags, np.uint8))
    key, flag = np.concatenate(keys), np.concatenate(several)
    order = np.argsort(key, kind="stable")
    return key[order], flag[order].astype(bool)


def looked_up(wanted: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key among the wanted ones; -1: not there."""
    if not len(wanted):
        return np.full(len(keys), -1)
    place = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
    return np.where(wanted[place] == keys, place, -1)
