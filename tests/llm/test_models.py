"""Vector codes, importance resampling and toxicity against plain versions, on edge cases and on the tables."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from muara.llm import resampling, toxicity, vector_codes
from muara.llm.common import documents
from muara.llm.queries import REGISTRY
from tests.llm import brute


def rows(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def given(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


# ---------------------------------------------------------------- vector codes

VECTORS = "vec_id long, embedding array<double>, label int"


def codes(frame, **how):
    books = vector_codes.trained(frame, **how)
    found = vector_codes.with_label_errors(vector_codes.coded(frame, books))
    return rows(found.withColumn("sha", F.lit(books.sha256())), "vec_id", "code", "error", "label_error", "sha")


def test_vector_codes_equal_the_plain_version(spark):
    given = brute.vector_rows()
    assert codes(spark.createDataFrame(given, VECTORS).repartition(5)) == Counter(brute.vector_codes(given))
    assert codes(spark.createDataFrame(given[:20], VECTORS), entries=7, parts=4, rounds=3) == Counter(
        brute.vector_codes(given[:20], parts=4, entries=7, rounds=3)
    )


def test_vectors_of_all_sizes_are_coded_exactly(spark):
    given = [(i, [float(3 ** (i % 150)) * (-1) ** i, i / 7, -1e-300, 1e18 * i], i % 2) for i in range(200)]
    given.append((500, [1.7e308, -1.7e308, 0.0, 1.0], None))
    assert codes(spark.createDataFrame(given, VECTORS), parts=2, entries=9) == Counter(brute.vector_codes(given, parts=2, entries=9))


def test_no_vectors_and_clashing_columns(spark):
    frame = spark.createDataFrame(brute.vector_rows(), VECTORS)
    assert codes(frame.limit(0)) == Counter()
    assert codes(frame.where("vec_id in (100, 101, 102, 103)")) == Counter()
    books = vector_codes.trained(frame)
    odd = frame.withColumns({"Code": F.lit(1), "error": F.lit("x"), "part": F.lit(2), "label_": F.lit(3)})
    found = vector_codes.coded(odd, books)
    assert found.columns == ["vec_id", "label", "part", "label_", "code", "error"]
    assert rows(found, "vec_id", "code", "error") == rows(vector_codes.coded(frame, books), "vec_id", "code", "error")


@pytest.mark.parametrize("bits", [3, 20, 26, 29])
def test_products_of_limbs_are_exact(bits):
    rng = np.random.default_rng(bits)
    a, b = (rng.integers(-(2**bits), 2**bits, (40, 7)) for _ in range(2))
    assert (vector_codes.products(a, b) == a.astype(object).dot(b.astype(object).T)).all()
    ties = np.zeros((3, 2), np.int64), np.array([[5, 5], [1, 0], [0, 1], [1, 0]])
    assert vector_codes.nearest(*ties)[0].tolist() == [1, 1, 1]


# ---------------------------------------------------------------- resampling


def test_span_crcs_of_any_length():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    starts = np.concatenate((np.arange(130), rng.integers(0, 100_000, 400), [0, 7, 7, 5]))
    ends = np.concatenate((np.arange(130) + np.arange(130), starts[130:530] + rng.integers(0, 300, 400), [200_000, 7, 71, 70_069]))
    wanted = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert resampling.span_crcs(data, starts, ends).tolist() == wanted
    assert resampling.span_crcs(data, starts[:0], ends[:0]).tolist() == []


@pytest.mark.parametrize("which", ["edge", "table", "none"])
@pytest.mark.parametrize("max_words", [1, 3])
def test_resampling_equals_the_plain_version(spark, folder, edge, none, which, max_words):
    docs = {"edge": edge, "table": documents(spark, folder), "none": none}[which]
    target = spark.createDataFrame([(1, "The House of a river, stone 12 übEr"), (2, None), (3, "")], "item_id long, text string")
    found = resampling.ranked(resampling.weighed(docs, target, max_words=max_words), percent=30)
    wanted = brute.resampled(given(docs), ["The House of a river, stone 12 übEr", None, ""], max_words, percent=30)
    assert rows(found, "doc_id", "n_features", "weight", "score", "rank") == wanted


def test_resampled_documents_are_the_drawn_ones(spark, folder, edge, none):
    docs, target = documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet")
    drawn = REGISTRY["op12_resampling"](spark, folder).where("rank is not null")
    kept = resampling.resampled(docs, target)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == rows(drawn, "doc_id") != Counter()
    assert resampling.resampled(none, target).isEmpty()
    assert "rank" not in resampling.resampled(edge.withColumn("score", F.lit("x")), target.limit(0)).columns


# ---------------------------------------------------------------- toxicity


def insults(n: int, kind: str):
    """Prose of which every third text holds a word of the kind somewhere, and long ones among them."""
    texts = []
    for k in range(n):
        words = brute.prose(1000 + k, 400 if k % 10 == 0 else 40).split(" ")
        if k % 3 == 0:
            words.insert(k % len(words), f"{kind}{'abcdefgh'[k % 8]}")
        texts.append((k, " ".join(words), int(k % 3 == 0)))
    return texts


@pytest.mark.parametrize("window", [1, 3])
def test_scores_equal_the_plain_version(spark, edge, window):
    given = insults(60, "grumble")
    model = toxicity.fitted([t.encode() for _, t, _ in given], np.array([y for *_, y in given], float), window)
    texts = [None if r["text"] is None else r["text"][:2000] for r in edge.collect()] + ["Grumblez", "a", "über-été 日本語", *[t for _, t, _ in given]]
    found = toxicity.scores([(t or "").encode() for t in texts], model)
    assert found == pytest.approx([brute.toxicity(t, model.values, model.bias, window) for t in texts], abs=1e-12)


def test_unseen_misspellings_are_found_in_whole_texts(spark):
    given = insults(300, "grumble")
    frame = spark.createDataFrame([(i, t) for i, t, _ in given], "doc_id long, text string")
    model = toxicity.trained(frame, spark.createDataFrame([(i, y) for i, _, y in given], "doc_id long, toxic int"))
    clean = [brute.prose(k, 300) for k in range(5000, 5060)]
    long = " ".join(brute.prose(k, 30_000) for k in range(7000, 7020))
    bad = ["the house grumblex of a tree", clean[0] + " xgrumble", "Grumbel grumbleton", long + " grumblez", "grumbleq " + long]
    found = [s >= 0.5 for s in toxicity.scores([t.encode() for t in [*bad, *clean, long, ""]], model)]
    assert found == [True] * len(bad) + [False] * (len(clean) + 2)


def test_windows_across_the_cuts_of_a_long_text(monkeypatch):
    given = insults(60, "grumble")
    texts = [t.encode() for _, t, _ in given] + [b"x" * 5000 + b" grumblea " + b"y" * 3000, b"", b"GrumbleB", b"," * 300]
    model = toxicity.fitted(texts[:60], np.array([y for *_, y in given], float), 3)
    whole = toxicity.scores(texts, model)
    monkeypatch.setattr(toxicity, "BLOCK", 97)
    assert toxicity.scores(texts, model) == whole


def test_toxicity_on_odd_tables(spark, edge, none):
    labels = spark.createDataFrame(
        [(0, 1), (0, 0), (1, 0), (2, None), (None, 1), (50, 1), (20, 0), (999, 1), (40, 1), (41, 0)], "doc_id long, toxic int"
    )
    sample = toxicity.labelled_sample(edge.withColumn("toxic", F.lit("x")), labels)
    told = {r["text"] for r in sample.collect()}
    outside = {i for i in (0, 1, 50, 20, 40, 41) if zlib.crc32(str(i).encode()) % 5}
    assert sample.count() == len(outside) and told <= {r["text"] for r in edge.where(F.col("doc_id").isin(*outside)).collect()}
    assert toxicity.labelled_sample(edge, labels, rows=2).count() == 2
    assert toxicity.labelled_sample(edge, labels, size=0).where("octet_length(text) > 0").isEmpty()
    found = toxicity.scored(edge.withColumn("Score", F.lit("x")), toxicity.trained(edge, labels))
    assert "Score" not in found.columns and found.where("score between 0 and 1").count() == edge.count()
    unlabelled = toxicity.trained(edge, labels.limit(0))
    assert rows(toxicity.scored(edge, unlabelled), "score", "predicted") == Counter({(0.0, 0): edge.count()})
    assert toxicity.scored(none, unlabelled).isEmpty() and toxicity.labelled_sample(none, labels).isEmpty()


def test_held_out_documents_of_the_table_are_told_apart(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = REGISTRY["op13_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").select("doc_id", "predicted", "toxic").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in found)
    hit = [r["toxic"] for r in found if r["predicted"]]
    assert sum(hit) >= 0.9 * len(hit) and sum(hit) >= 0.8 * sum(r["toxic"] for r in found)
