"""Content reconciliation, keys nobody declared, drift of the feed, and files read once."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from muara.operators import content, discovery, drift, quality
from muara.plans import ingest
from muara.plans.ingest import IngestOptions, fact_table
from muara.plans.queries import KEYS, PLAIN_TABLES
from muara.session import scratch_path
from muara.sources.ledger import FileLedger
from muara.sources.tables import read_table

T0 = datetime(2026, 1, 30, 12)

# ---------------------------------------------------------------- content

ROW = "k int, name string, x double, day date"


def differences(source, target, **how):
    return Counter({tuple(r)[:-1]: r["copies"] for r in content.content_differences(source, target, ["k"], **how).collect()})


def test_few_differences_move_few_rows(spark):
    source = spark.range(200_000).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    target = source.where("k <> 5").withColumn("name", F.when(F.col("k") != 77, F.col("name"))).union(source.where("k = 1000"))
    assert differences(source, target) == Counter(
        {(5, "n5", "source"): 1, (77, "n77", "source"): 1, (77, None, "target"): 1, (1000, "n1000", "target"): 1}
    )
    moved = [side.count() for side in content.suspects(source, target, ["k"])]
    assert sum(moved) <= 12, "rows of at most a few ranges"
    assert [s.count() for s in content.suspects(source, source.repartition(7), ["k"])] == [0, 0]


@pytest.mark.parametrize("bits", [1, 4, 12])
def test_differences_equal_the_plain_multisets(spark, bits):
    rng = random.Random(bits)

    def rows(n):
        return [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "a", ""]), rng.choice([None, 0.5, float("inf")]), None) for _ in range(n)]

    left, right = rows(120), rows(90)
    both = (spark.createDataFrame(r, ROW) for r in (left, right))
    mine, other = Counter(left), Counter(right)
    wanted = {(*r, "source"): n for r, n in (mine - other).items()} | {(*r, "target"): n for r, n in (other - mine).items()}
    assert differences(*both, bits=bits) == Counter(wanted)


def test_empty_sides_other_orders_and_other_types(spark):
    some, none = spark.createDataFrame([(1, "a", 0.5, None)] * 3, ROW), spark.createDataFrame([], ROW)
    assert differences(some, none) == Counter({(1, "a", 0.5, None, "source"): 3})
    assert differences(none, none) == Counter() == differences(some, some.select("day", "x", "name", "k"))
    with pytest.raises(ValueError, match="cannot compare"):
        content.content_differences(some, some.withColumn("k", F.lit(1).cast("bigint")), ["k"])


def test_a_null_is_told_from_its_neighbour(spark):
    left, right = (spark.createDataFrame([r], "k int, a string, b string") for r in ((1, "x", None), (1, None, "x")))
    assert len(differences(left, right)) == 2


# ---------------------------------------------------------------- keys


def plain_keys(rows, names, most):
    found = []
    for size in range(1, most + 1):
        for s in combinations(range(len(names)), size):
            values = [tuple(r[i] for i in s) for r in rows]
            if rows and all(None not in v for v in values) and len(set(values)) == len(rows) and not any(set(f) <= set(s) for f in found):
                found.append(s)
    return sorted(tuple(names[i] for i in f) for f in found)


@pytest.mark.parametrize("seed", range(4))
def test_minimal_keys_equal_the_plain_search(spark, seed):
    rng = random.Random(seed)
    rows = [(i // 4, i % 4, rng.randrange(60), rng.choice(["a", "b", None]), i if seed == 2 else rng.randrange(8)) for i in range(40)]
    names = ["a", "b", "c", "d", "e"]
    frame = spark.createDataFrame(rows, "a int, b int, c int, d string, e int").withColumn("list", F.array("a"))
    assert sorted(discovery.minimal_keys(frame, 3)) == plain_keys(rows, names, 3)
    assert discovery.minimal_keys(frame.limit(0), 3) == []


def test_sets_with_repeats_are_not_counted_in_all_rows(spark, monkeypatch):
    """Two of the pairs are nearly unique; their repeats show in a slice, and only keys are counted in all rows."""
    n, counted, real = 120_000, Counter(), discovery._no_repeats
    kept = F.when(F.col("id") < n - 2_000, F.col("id")).otherwise(F.col("id") - 2_000)
    rows = spark.range(n).select((kept % 40_000).alias("a"), F.floor(kept / 40_000).alias("b"), F.floor(kept / 40_000).alias("c"), F.col("id").alias("k"))

    def no_repeats(part, columns):
        counted[tuple(columns)] = max(counted[tuple(columns)], part.count())
        return real(part, columns)

    monkeypatch.setattr(discovery, "_no_repeats", no_repeats)
    assert discovery.minimal_keys(rows) == [("k",)]
    assert counted[("k",)] == n and 0 < counted[("a", "b")] < n / 8 and 0 < counted[("a", "c")] < n / 8


def test_one_repeat_is_found_in_or_out_of_the_slice(spark, monkeypatch):
    monkeypatch.setattr(discovery, "SMALL", 0)
    inside = set()
    for twice in range(0, 4_000, 800):
        rows = spark.range(4_001).select(F.when(F.col("id") == 4_000, twice).otherwise(F.col("id")).alias("k"))
        inside.add(rows.where(discovery._hash(["k"]) % 2 == 0).where(F.col("k") == twice).isEmpty())
        monkeypatch.setattr(discovery, "SLICES", 2)
        assert discovery.minimal_keys(rows) == []
    assert inside == {True, False} and discovery.minimal_keys(spark.range(4_001)) == [("id",)]


@pytest.mark.parametrize("seed", range(2))
def test_minimal_keys_by_slices_equal_the_plain_search(spark, seed, monkeypatch):
    monkeypatch.setattr(discovery, "SMALL", 0)
    monkeypatch.setattr(discovery, "SLICES", 3)
    rng = random.Random(seed)
    rows = [(rng.randrange(30), rng.randrange(12), rng.choice([0.0, -0.0, 1.5, float("nan")]), rng.choice("abcd"), i // 2) for i in range(40)]
    frame = spark.createDataFrame(rows, "a int, b int, c double, d string, e int")
    plain = [(a, b, "nan" if c != c else c, d, e) for a, b, c, d, e in rows]
    assert sorted(discovery.minimal_keys(frame, 3)) == plain_keys(plain, list("abcde"), 3)


def test_declared_keys_of_the_tables_are_found(spark, folder):
    tables = {name: read_table(spark, folder, name) for name in PLAIN_TABLES}
    found = {(r["table_name"], r["key_columns"]) for r in discovery.discovered_keys(spark, tables).collect()}
    for key in KEYS:
        if key.kind != "FOREIGN KEY" and key.table in tables:
            inside = [",".join(s) for n in (1, 2) for s in combinations(key.columns, n)]
            holds = quality.duplicate_keys(tables[key.table], key.columns).isEmpty()
            assert any((key.table, s) in found for s in inside) == holds, key
    parents = {(r["child_table"], r["child_column"], r["parent_table"]) for r in discovery.foreign_key_candidates(spark, tables).collect()}
    for key in KEYS:
        if key.kind == "FOREIGN KEY" and key.table in tables:
            assert (key.table, key.columns[0], key.references.split(".")[0]) in parents


def test_inclusions_over_more_columns_than_a_word_has_bits(spark):
    wide = spark.range(20).select(*[(F.col("id") % (k + 1)).alias(f"c{k}") for k in range(80)])
    other = spark.createDataFrame([(None, "1"), (3, "x")], "n int, s string")
    found = discovery.inclusion_dependencies({"w": wide, "o": other})
    wanted = {("w", f"c{i}", "w", f"c{j}") for i in range(80) for j in range(80) if i != j and min(i, 19) <= min(j, 19)}
    wanted |= {("o", "n", "w", f"c{j}") for j in range(3, 80)}
    assert set(found) == wanted and len(found) == len(set(found))
    assert discovery.inclusion_dependencies({"w": wide, "o": other}, [("w", "c3")])[0] == ("o", "n", "w", "c3")


# ---------------------------------------------------------------- drift


def document(items, header=None):
    names = {f.split(".")[1]: "x" for f in drift.EXPECTED if f.startswith("lokasi.")}
    return json.dumps({"lokasi": names if header is None else header, "data": [{"cuaca": [items, "odd"]}, 5]})


def test_added_vanished_missing_and_retyped_fields_come_out(spark):
    good = {"datetime": "2026-01-30T00:00:00", "t": 1, "hu": "70", "weather_desc": "x", "ws": 1.5, "wd": "E"}
    without = {k: v for k, v in good.items() if k != "ws"}
    documents = [
        ("calm", document([good, {**good, "t": None}])),
        ("new", document([{**good, "gust": 3}, {**good, "gust": "n", "wd": {"deg": 3}}])),
        ("gone", document([without])),
        ("some", document([without, good], {"adm4": 11})),
        (None, document([{**good, "weather_desc": ["a"]}])),
        ("broken", "{no json"),
        ("broken", "[1, 2]"),
    ]
    frame = spark.createDataFrame(documents, "run string, doc string")
    found = {tuple(r) for r in drift.field_drift(frame, "run").select("run", "field", "status", "kinds", "n").collect()}
    heads = {("some", f, "vanished", "", 1) for f in drift.EXPECTED if f.startswith("lokasi.") and f != "lokasi.adm4"}
    assert found == heads | {
        ("new", "gust", "added", "NUMBER,STRING", 2),
        ("new", "wd", "retyped", "OBJECT", 1),
        ("gone", "ws", "vanished", "", 1),
        ("some", "ws", "missing", "", 1),
        ("some", "lokasi.adm4", "retyped", "NUMBER", 1),
        (None, "weather_desc", "retyped", "ARRAY", 1),
    }
    assert drift.field_drift(frame.limit(0), "run").isEmpty()


def plain_fields(documents):
    """What ``document_fields`` counts, document by document."""
    kinds = {str: "STRING", bool: "BOOLEAN", int: "NUMBER", float: "NUMBER", list: "ARRAY", dict: "OBJECT", type(None): None}
    counts = Counter()
    for run, doc in documents:
        try:
            parsed = json.loads(doc) if doc is not None else None
        except ValueError:
            continue
        parsed = parsed if isinstance(parsed, dict) else {}
        lists = lambda values: [v for many in values if isinstance(many, list) for v in many]
        groups = lists(e.get("cuaca") for e in lists([parsed.get("data")]) if isinstance(e, dict))
        parts = [("lokasi", "lokasi.", parsed.get("lokasi"))] + [("item", "", i) for i in lists(groups)]
        for part, prefix, held in parts:
            if isinstance(held, dict):
                counts.update([(run, part, "OBJECT"), *[(run, prefix + f, kinds[type(v)]) for f, v in held.items()]])
    return counts


def test_fields_of_odd_documents_are_counted_one_by_one(spark):
    item = {"t": 1, "hu": None, "a<b(c": {"x": [1, "y"]}, "ws": 1.25, "gust": [[1.5], {}], "ok": True, "item": {"z": 1}, "lokasi": 3}
    documents = [
        ("r", document([item, {}, [item], "text", None, 7])),
        ("r", json.dumps({"lokasi": {"adm4": 1e300, "": "x", "lokasi.adm4": []}, "data": [{"cuaca": None}, {"cuaca": [[{"t": 12345678901234567890}], {"t": 1}, None]}, None]})),
        ("r", json.dumps({"lokasi": [1], "data": {"cuaca": [[item]]}})),
        (None, json.dumps({"lokasi": None, "data": [{"cuaca": [[{"hu": "1"}, {"hu": 1}], [{"hu": "1"}]]}]})),
        ("empty", "{}"), ("empty", "null"), ("empty", ""), ("empty", None), ("empty", "{no json"),
    ]
    frame = spark.createDataFrame(documents, "run string, doc string")
    rows = drift.document_fields(frame, "run").collect()
    assert Counter({(r["run"], r["field"], r["kind"]): r["n"] for r in rows}) == plain_fields(documents) and len(rows) == len(plain_fields(documents))
    own = {r["field"]: (r["status"], r["kinds"], r["n"]) for r in drift.field_drift(frame, "run", {"hu": "STRING"}).where("run is null").collect()}
    assert own == {"hu": ("retyped", "NUMBER", 1)}


def test_drift_parses_each_document_once(spark):
    frame = spark.createDataFrame([("r", document([{"t": 1}]))], "run string, doc string")
    parsed = F.udf(lambda doc: (seen.add(1), doc)[1])
    seen = spark.sparkContext.accumulator(0)
    assert not drift.field_drift(frame.repartition(1).select("run", parsed("doc").alias("doc")), "run").isEmpty()
    assert seen.value == 1


# ---------------------------------------------------------------- ledger

OPTIONS = IngestOptions(mode="wallclock")


def land(spark, landing, lot, value):
    points = [{"datetime": f"2026-01-30T{h:02d}:00:00", "t": value + h, "hu": 1, "weather_desc": "x", "ws": 0, "wd": "E"} for h in range(3)]
    line = json.dumps({"lokasi": {"adm4": "a"}, "data": [{"cuaca": [points]}]})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{landing}/lot={lot}")


def test_a_repeated_run_reads_and_changes_nothing(spark, warehouse):
    landing, table, ledger = scratch_path(spark, "landing"), fact_table(warehouse), FileLedger(warehouse.table("ledger"))
    land(spark, landing, 0, 10)
    first = ingest.landed_run(table, landing, ledger, T0)
    assert first["files"] == 1 and first["inserted"] == 3
    state = table.read().drop("data_age_minutes", "freshness_status").collect()
    again = ingest.ingest_landed(table, landing, ledger, T0 + timedelta(hours=1), options=OPTIONS)
    assert set(again.values()) == {0} and table.read().drop("data_age_minutes", "freshness_status").collect() == state
    land(spark, landing, 0, 20)
    assert ingest.ingest_landed(table, landing, ledger, T0 + timedelta(hours=2), options=OPTIONS)["updated"] == 3
    assert sorted(r["suhu_celsius"] for r in table.read().collect()) == [20.0, 21.0, 22.0]


def test_a_failed_load_is_taken_up_with_its_own_files(spark, warehouse, monkeypatch):
    landing, table, ledger = scratch_path(spark, "landing"), fact_table(warehouse), FileLedger(warehouse.table("ledger"))
    land(spark, landing, 0, 10)
    real = ingest.ingest_documents

    def fail(*args, **how):
        raise OSError("lost")

    monkeypatch.setattr(ingest, "ingest_documents", fail)
    with pytest.raises(OSError):
        ingest.ingest_landed(table, landing, ledger, T0, options=OPTIONS)
    monkeypatch.setattr(ingest, "ingest_documents", real)
    land(spark, landing, 1, 50)
    counts = ingest.ingest_landed(table, landing, ledger, T0, options=OPTIONS)
    assert counts["files"] == 2 and counts["inserted"] == 3 and counts["updated"] == 3
    assert min(r["suhu_celsius"] for r in table.read().collect()) == 50.0, "the claims keep their order"
    assert len(ledger.claims_after(0)) == 2 and ledger.claims_after(table.state()["streams"]["landing"]) == []
