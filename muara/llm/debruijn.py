"""Repeated word spans through a compacted de Bruijn graph over runs of WINDOW words.

A k-mer of WINDOW words is an edge from its first to its last WINDOW - 1 words. Only k-mers whose anchor (smallest
hash of a shorter run within) another text has as well can repeat; the others never leave their text.

1. Consecutive k-mers with one anchor are a path without a branch as far as their text goes. Each text's paths are
   rows with a hash; equal paths of a document bucket meet there, and the smallest document's goes on.
2. Paths that meet other paths of their anchor branch there: they are taken apart into edges, each edge is joined
   with its source, the smallest document's place, and runs of edges that follow their source step by step are put
   together again.
3. Every path is joined with its source; claims that follow one source step by step become long spans.
4. The source's words are read at its coordinates and hashed; a span is removed where its own words have that hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muara.llm.anchors import answered, key48, looked_up, packed_texts, repeated_anchors, unpacked_texts
from muara.llm.common import BLANKS, buckets_for, documents, mixed, powers, send_package, sliding_min, window_hashes, word_bounds, word_hashes, write_table

WINDOW, ANCHOR = 50, 15
#: k-mers of one path at most.
PATH = 64
CHUNK, BUCKET_MB = 1 << 20, 4.0

_blank = np.zeros(256, bool)
_blank[[ord(b) for b in BLANKS]] = True


def chunks(texts: list[bytes]):
    """Row numbers and texts, about CHUNK bytes at a time; a text is never cut."""
    rows, size = [], 0
    for row, text in enumerate(texts):
        rows.append(row)
        size += len(text)
        if size >= CHUNK:
            yield rows, [texts[r] for r in rows]
            rows, size = [], 0
    if rows:
        yield rows, [texts[r] for r in rows]


class Runs:
    """Runs of k-mers with one anchor in a chunk of texts: ``row``, ``at`` (word in the text), ``size``, ``anchor``."""

    def __init__(self, rows: list[int], texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        lengths = np.array([len(t) + 1 for t in texts])
        self.starts, self.ends = word_bounds(data, _blank)
        self.hashes = word_hashes(data, self.starts, self.ends)
        text = np.searchsorted(np.cumsum(lengths), self.starts, "right")
        first = np.searchsorted(text, np.arange(len(texts)))
        least = sliding_min(window_hashes(self.hashes, ANCHOR), WINDOW - ANCHOR + 1)
        n = len(least)
        valid = text[:n] == text[WINDOW - 1 :] if n else np.zeros(0, bool)
        self.data = data
        if not n:
            self.first_word = self.row = self.at = self.size = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        begin = np.concatenate(([0], np.flatnonzero((least[1:] != least[:-1]) | (text[1:n] != text[: n - 1]) | (valid[1:] != valid[:-1])) + 1))
        end = np.append(begin[1:], n)
        own = valid[begin]
        begin, end = begin[own], end[own]
        pieces = -(-(end - begin) // PATH)
        which = np.repeat(np.arange(len(begin)), pieces)
        step = (np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PATH
        begin, end = begin[which] + step, np.minimum(end[which], begin[which] + step + PATH)
        self.first_word, self.size = begin, end - begin
        self.row, self.at = np.array(rows)[text[begin]], begin - first[text[begin]]
        self.anchor = mixed(least[begin])

    def kmers(self) -> np.ndarray:
        """Twelve bytes for every k-mer of the chunk: hashes of 64 and 32 bits from differently salted word hashes."""
        other = word_hashes(self.data, self.starts, self.ends, 1)
        out = np.empty(max(0, len(self.hashes) - WINDOW + 1), [("a", "<u8"), ("b", "<u4")])
        out["a"], out["b"] = window_hashes(self.hashes, WINDOW), window_hashes(other, WINDOW) >> np.uint64(32)
        return out

    def paths(self) -> np.ndarray:
        """Two hashes of each run's words."""
        out = []
        for salt in (0, 1):
            words = self.hashes if not salt else word_hashes(self.data, self.starts, self.ends, 1)
            base = 0x9E3779B97F4A7C15
            sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words * powers(len(words), base), out=sums[1:])
            back = powers(len(words), pow(base, -1, 1 << 64))
            out.append(mixed((sums[self.first_word + self.size + WINDOW - 1] - sums[self.first_word]) * back[self.first_word]))
        return np.column_stack(out)


def _anchors_of(texts: list[bytes]):
    for rows, chunk in chunks(texts):
        runs = Runs(rows, chunk)
        yield runs.row, runs.anchor, (runs.paths()[:, 0] >> np.uint64(32)).astype(np.uint32), sum(map(len, chunk))


PATHS = (
    "anchor long, p1 long, p2 long, size int, doc long, row long, home long, at long, edges binary,"
    " source_row long, source_home long, source_at long"
)


def path_rows(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Paths of each document bucket, one for its smallest document.

    ``edges`` are the packed k-mer hashes, where the anchor has several paths; null where all its paths are equal.
    The other places of a path in the bucket come as claims: their source is known, and ``anchor`` is null.
    """

    def cut(texts, answers):
        import pyarrow as pa

        wanted, several = answered(answers)
        docs_, keys, data, home = [], [], [], 0
        if len(wanted) and texts.num_rows:
            home = texts["home"][0].as_py()
            for doc, key, text in zip(*unpacked_texts(texts), strict=True):
                if doc is not None:
                    docs_.append(doc)
                    keys.append(key)
                    data.append(text)
        met: dict[tuple, list] = {}
        edges: dict[tuple, bytes] = {}
        for rows, chunk in chunks(data):
            runs = Runs(rows, chunk)
            found = looked_up(wanted, key48(runs.anchor))
            own = np.flatnonzero(found >= 0)
            if not len(own):
                continue
            paths, kmers = runs.paths().view(np.int64), runs.kmers()
            names = zip(runs.anchor[own].view(np.int64).tolist(), *paths[own].T.tolist(), runs.size[own].tolist(), strict=True)
            places = zip(runs.row[own].tolist(), runs.at[own].tolist(), runs.first_word[own].tolist(), several[found[own]].tolist(), strict=True)
            for name, (row, at, word, branches) in zip(names, places, strict=True):
                if name not in met:
                    met[name] = []
                    edges[name] = kmers[word : word + name[3]].tobytes() if branches else None
                met[name].append((docs_[row], keys[row], at))
        out = []
        for name, places in met.items():
            doc, row, at = source = min(places)
            out.append((*name, doc, row, home, at, edges[name], None, None, None))
            out += [(None, None, None, name[3], d, r, home, a, None, row, home, at) for d, r, a in places if d > doc]
            # Places in the smallest document itself, or in another row with its id, have no source here.
            out += [(*name, d, r, home, a, edges[name], None, None, None) for d, r, a in places if d == doc and (d, r, a) != source]
        kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 3
        columns = list(zip(*out, strict=True)) or [()] * 12
        names = [c.split()[0] for c in PATHS.split(",")]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.groupBy("home").cogroup(repeated.groupBy("home")).applyInArrow(cut, PATHS)


def _place(at: str = "at"):
    return F.struct("doc", "row", "home", F.col(at).alias("at"))


def compacted(paths: DataFrame) -> DataFrame:
    """``anchor, p1, p2, size, offset, n, source``: runs of each distinct path's k-mers with one source each.

    Every path is a run with the smallest document that has all of it. Where an anchor has several paths, the graph
    branches: their edges are joined with their sources, the smallest documents that have these edges, and edges that
    follow a smaller source step by step become runs too. A path's smallest place names it; edges that one path alone
    has are their own source and end there.
    """
    name = ["anchor", "p1", "p2", "size"]
    one = paths.groupBy(*name).agg(F.min(_place()).alias("source"))
    whole = one.select(*name, F.lit(0).alias("offset"), F.col("size").alias("n"), "source")
    branching = paths.where("edges is not null").groupBy(*name).agg(F.min(F.struct(_place().alias("source"), "edges")).alias("m"))
    branching = write_table(branching.select(*name, "m.source", "m.edges"), "branching-paths")
    number = F.posexplode(F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.substring(F.col("edges"), i * 12 + 1, F.lit(12))))
    apart = branching.select("source", number.alias("offset", "edge")).select(
        F.conv(F.hex(F.substring("edge", 1, 8)), 16, -10).cast("long").alias("e1"),
        F.conv(F.hex(F.substring("edge", 9, 4)), 16, 10).cast("long").alias("e2"),
        F.struct("source.doc", "source.row", "source.home", (F.col("source.at") + F.col("offset")).alias("at")).alias("place"),
        "offset",
    )
    sources = apart.groupBy("e1", "e2").agg(F.min("place").alias("source"), F.count(F.lit(1)).alias("times")).where("times > 1")
    followed = apart.join(sources, ["e1", "e2"]).where("source.doc < place.doc").select(
        F.col("place.row").alias("row"),
        (F.col("place.at") - F.col("offset")).alias("at"),
        "offset",
        F.col("source.doc").alias("doc"),
        F.col("source.row").alias("source_row"),
        F.col("source.home").alias("home"),
        (F.col("source.at") - F.col("offset")).alias("diagonal"),
    )
    line = ["row", "at", "doc", "source_row", "home", "diagonal"]
    rank = F.row_number().over(Window.partitionBy(*line).orderBy("offset"))
    runs = followed.withColumn("island", F.col("offset") - rank).groupBy(*line, "island")
    runs = runs.agg(F.min("offset").alias("offset"), F.count(F.lit(1)).cast("int").alias("n"))
    source = F.struct("doc", F.col("source_row").alias("row"), "home", (F.col("diagonal") + F.col("offset")).alias("at"))
    own = branching.select(*name, F.col("source.row").alias("row"), F.col("source.at").alias("at"))
    found = runs.withColumn("origin", source).join(own, ["row", "at"]).select(*name, "offset", "n", F.col("origin").alias("source"))
    return whole.unionByName(found)


def long_spans(paths: DataFrame) -> DataFrame:
    """``home, row, at, n, source_home, source_row, source_at``: places in words, n the words of the span."""
    own = paths.where("anchor is not null")
    columns = ["home", "row", "at", "n", "source_home", "source_row", "source_at"]
    met = own.join(compacted(own), ["anchor", "p1", "p2", "size"]).where("source.doc < doc")
    met = met.select(
        "home", "row", (F.col("at") + F.col("offset")).alias("at"), "n",
        F.col("source.home").alias("source_home"), F.col("source.row").alias("source_row"), F.col("source.at").alias("source_at"),
    )
    claims = met.unionByName(paths.where("anchor is null").withColumn("n", F.col("size").cast("long")).select(*columns))
    line = ["home", "row", "source_home", "source_row", F.col("at") - F.col("source_at")]
    before = Window.partitionBy(*line).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.col("at") + F.col("n")).over(before)
    starts = claims.withColumn("new", F.when(F.col("at") <= reach, 0).otherwise(1))
    island = F.sum("new").over(Window.partitionBy(*line).orderBy("at", "n").rowsBetween(Window.unboundedPreceding, 0))
    spans = starts.withColumn("diagonal", line[-1]).withColumn("island", island)
    spans = spans.groupBy("home", "row", "source_home", "source_row", "diagonal", "island").agg(
        F.min("at").alias("at"), F.max(F.col("at") + F.col("n")).alias("stop")
    )
    words = F.col("stop") - F.col("at") + WINDOW - 1
    return spans.select("home", "row", "at", words.alias("n"), "source_home", "source_row", (F.col("at") - F.col("diagonal")).alias("source_at"))


def _span_digests(text: bytes, places: list[tuple[int, int]]) -> list[bytes]:
    words = text.split()
    return [hashlib.sha256(b" ".join(words[at : at + n])).digest() for at, n in places]


def source_digests(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``home, row, at, n, digest``: each span with the hash of the words at its source's coordinates.

    Many copies ask for the same words of one source. These are hashed once, and the copies meet the hash in a join,
    in which Spark splits a source that a large part of all documents copies.
    """

    def read(texts, asked):
        import pyarrow as pa

        by_row: dict[int, list] = {}
        for _, row, text in zip(*unpacked_texts(texts), strict=True):
            by_row.setdefault(row, text)
        wanted: dict[int, list] = {}
        for row, at, n in zip(*(asked[c].to_pylist() for c in ("source_row", "source_at", "n")), strict=True):
            wanted.setdefault(row, []).append((at, n))
        out: list[tuple] = []
        for row, places in wanted.items():
            out += [(row, at, n, d) for (at, n), d in zip(places, _span_digests(by_row[row], places), strict=True)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = [pa.int64()] * 3 + [pa.binary()]
        names = ["source_row", "source_at", "n", "digest"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    asked = spans.select(F.col("source_home").alias("at_home"), "source_row", "source_at", "n").distinct()
    columns = "source_row long, source_at long, n long, digest binary"
    digests = docs.groupBy("home").cogroup(asked.groupBy("at_home")).applyInArrow(read, columns)
    return spans.join(digests, ["source_row", "source_at", "n"]).select("home", "row", "at", "n", "digest")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for every row of ``docs``.

    ``kept`` are the remaining words joined by one space. Null text has no words; texts of under WINDOW words stay
    whole. Rows with a null id neither lose nor take anything; rows with equal ids take nothing from each other.
    Extra columns are ignored.
    """
    send_package(docs.sparkSession)
    buckets = buckets_for(docs, BUCKET_MB)
    row = F.xxhash64("doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("row", row).withColumn("home", F.pmod("row", F.lit(buckets)))
    texts = packed_texts(rows)
    paths = write_table(path_rows(texts, repeated_anchors(rows, buckets, _anchors_of)), "paths")
    verified = source_digests(texts, write_table(long_spans(paths), "spans"))

    def cut(texts, spans):
        import pyarrow as pa

        by_row: dict[int, list] = {}
        for span in spans.to_pylist():
            by_row.setdefault(span["row"], []).append((span["at"], span["n"], span["digest"]))
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
        ids, row_keys, data = unpacked_texts(texts)
        for key, text in zip(row_keys, data, strict=True):
            words = text.split()
            kept, at = [], 0
            found = sorted(by_row.get(key, ()))
            digests = _span_digests(text, [(a, n) for a, n, _ in found]) if found else ()
            for (start, n, digest), own in zip(found, digests, strict=True):
                if digest == own:
                    kept += words[at:start]
                    at = max(at, start + n)
            kept += words[at:]
            rest = b" ".join(kept)
            for name, value in zip(out, (len(words), len(words) - len(kept), hashlib.sha256(rest).hexdigest(), rest), strict=True):
                out[name].append(value)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
        columns = [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]
        return pa.Table.from_arrays([pa.array(ids, pa.int64()), *columns], names=["doc_id", *out])

    columns = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary"
    return texts.groupBy("home").cogroup(verified.groupBy("home")).applyInArrow(cut, columns)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).drop("kept")
