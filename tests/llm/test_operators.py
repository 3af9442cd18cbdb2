"""Every operator against its plain version, on edge cases, on no rows, and on the documents table."""

from collections import Counter

import public_tokenizers
import pytest

from muara.llm import cascade, debruijn, licenses, packing, secret_scan, simhash, suffix_dedup, token_counts
from muara.llm.common import documents
from tests.llm import brute

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(params=["edge", "table", "none"])
def docs(request, spark, folder, edge, none):
    return {"edge": edge, "table": documents(spark, folder), "none": none}[request.param]


def given(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def rows(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def test_suffix_dedup(docs):
    found = rows(suffix_dedup.without_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == Counter(brute.byte_units(given(docs)))


def test_substring_dedup(docs):
    found = rows(debruijn.without_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == Counter(brute.word_units(given(docs)))


def test_simhash(docs):
    found = rows(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id")
    assert found == Counter(brute.near_groups(given(docs)))


def test_one_per_group(docs):
    groups = brute.near_groups(given(docs))
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids) - {None}) + ids.count(None)
    assert {i for i in ids if i is not None} == {c for _, _, c in groups if c is not None}
    assert ids.count(None) == len({f for i, f, c in groups if c is None})


def test_quality(docs):
    columns = ("doc_id", *cascade.COUNTS, "base_failed", "kept")
    found = rows(cascade.quality(docs), *columns)
    assert found == Counter((i, *brute.quality_counts(t)) for i, t in given(docs))
    kept = cascade.kept_documents(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id", "text") == Counter((i, t) for i, t in given(docs) if brute.quality_counts(t)[-1])


def test_packing(docs):
    packed = packing.pack(docs, WORD_BPE)
    assert rows(packed, *packing.NAMES) == brute.token_pieces(given(docs), WORD_BPE)
    bins = {}
    for r in packed.collect():
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(n for places in bins.values() for _, n in places)
    assert len(bins) <= 1.02 * total / 2048 + 1


def test_token_counts(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTE_BPE)
    expected = Counter()
    for i, t in given(docs):
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        expected[(i, len((t or "").encode()), n, n > 512)] += 1
    assert rows(token_counts.token_counts(docs, BYTE_BPE), "doc_id", "n_bytes", "n_tokens", "over_limit") == expected


def test_license_phrases(docs):
    found = rows(licenses.licenses(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert found == Counter((i, *brute.phrase_places(t)) for i, t in given(docs))


def test_secret_base(docs):
    found = secret_scan.secrets(docs)
    base = rows(found, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert base == Counter((i, *brute.secret_base(t)[:4]) for i, t in given(docs))


def test_rules_come_in_the_order_of_rejections_per_cost_behind_the_others():
    uses = {("rule 0", "x"), ("rule 1", "x"), ("rule 2", "y"), ("rule 3", "z"), ("x", "data")}
    cost = {"data": 40, "x": 60, "y": 30, "z": 500, "rule 0": 1, "rule 1": 1, "rule 2": 1, "rule 3": 6}
    documents = {0b0000: 100, 0b0001: 60, 0b0010: 10, 0b0100: 12, 0b1001: 5}
    spent = {(mask, owner): n * ns for mask, n in documents.items() for owner, ns in cost.items()}
    # Rule 1 costs next to nothing once rule 0 has made x; rule 3 rejects nothing that rule 0 leaves.
    assert cascade.cheapest_first(4, documents, spent, uses) == [0, 1, 2, 3]
    assert cascade.cheapest_first(4, documents, spent, uses, first=1) == [1, 2, 3]
    # With z made anyway rule 3 costs its own time only, and its 5 in 6 are more than rule 0's 65 in 101.
    assert cascade.cheapest_first(4, documents, spent, uses | {("made", "z")}) == [3, 0, 1, 2]
    assert cascade.cheapest_first(3, {}, {}, set()) == [0, 1, 2]


def test_a_sample_tells_what_each_measure_cost_and_uses(spark, folder):
    m = cascade.Timed("a b c d " * 200)
    for k, rule in enumerate(cascade.OWN_RULES):
        m.timed(f"rule {k}", lambda: rule.rejects(m))  # noqa: B023
    assert {("rule 0", "n_symbols"), ("rule 0", "n_words"), ("n_words", "words"), ("words", "data"), ("rule 3", "n_words")} <= m.uses
    assert set(m.spent) == {"rule 0", "rule 1", "rule 2", "rule 3"} | {used for _, used in m.uses}
    assert all(ns >= 0 for ns in m.spent.values())
    docs = documents(spark, folder)
    every = [*cascade.BASE_RULES, *cascade.OWN_RULES]
    assert Counter(r.name for r in cascade.rule_order(docs, every)) == Counter(r.name for r in every)
    behind = cascade.rule_order(docs, cascade.OWN_RULES, cascade.BASE_RULES, cascade.COUNTS)
    assert Counter(r.name for r in behind) == Counter(r.name for r in cascade.OWN_RULES)
    assert cascade.rule_order(docs.limit(0), cascade.OWN_RULES, cascade.BASE_RULES) == list(cascade.OWN_RULES)
