"""Keyed loads whose rows change their partition, null keys, marks in commits, and versions of one moment."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from muara.operators import freshness, loads, quality
from muara.plans import sync
from muara.plans.sync import run_sync
from muara.sources import tables
from muara.sources.manifests import SyncTask
from muara.sources.snapshots import CommitConflict
from tests.test_plans import plan

ROWS = "id int, v string, day date, seq int"


def rows(spark, *data):
    return spark.createDataFrame([(k, v, day and date(2024, 1, day), i) for i, (k, v, day) in enumerate(data)], ROWS)


def content(table):
    return sorted((r["id"], r["v"], r["day"] and r["day"].day) for r in table.read().collect())


@pytest.fixture
def table(spark, warehouse):
    made = warehouse.table("t", "day")
    made.replace(rows(spark, (1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", None), (5, "e", 5)).drop("seq"))
    return made


def test_a_moved_row_is_there_once_and_other_partitions_stay_as_they_are(spark, table):
    before = {f["value"]: f["path"] for f in table.state()["folders"]}
    moved = rows(spark, (1, "A", 3), (4, "D", 2), (3, "C", None), (3, "C2", None), (9, "new", 5), (9, "newer", 6))
    loads.upsert(table, moved, ["id"], "seq")
    assert content(table) == [(1, "A", 3), (2, "b", 1), (3, "C2", None), (4, "D", 2), (5, "e", 5), (9, "newer", 6)]
    after = [f["path"] for f in table.state()["folders"]]
    assert before["2024-01-05"] in after and not {before["2024-01-01"], before["2024-01-02"], before[None]} & set(after)


def test_new_keys_come_to_a_partition_without_rewriting_it(spark, table):
    before = {f["path"] for f in table.state()["folders"]}
    loads.upsert(table, rows(spark, (10, "x", 1), (11, "y", 5)), ["id"], "seq")
    assert before < {f["path"] for f in table.state()["folders"]} and len(content(table)) == 7
    assert sum(table.partition_rows(table.state()).values()) == 7


def test_many_random_loads_equal_a_dictionary(spark, warehouse):
    import random

    rng, table, truth = random.Random(5), warehouse.table("r", "day"), {}
    table.create_if_absent(rows(spark, (1, "a", 1)).drop("seq").schema)
    for load in range(6):
        batch = [(rng.randrange(12), f"{load}.{k}", rng.choice([None, 1, 2, 3, 4])) for k in range(rng.randrange(1, 9))]
        loads.upsert(table, rows(spark, *batch), ["id"], "seq")
        truth |= {k: (k, v, d) for k, v, d in batch}
        assert content(table) == sorted(truth.values())


def test_insert_ignore_knows_keys_of_other_partitions(spark, table):
    assert loads.insert_ignore(table, rows(spark, (1, "again", 4), (7, "new", 4)), ["id"], "seq") == 1
    assert [r for r in content(table) if r[0] in (1, 7)] == [(1, "a", 1), (7, "new", 4)]


@pytest.mark.parametrize("partition_by", [None, "day"])
def test_null_keys_are_refused_and_told(spark, warehouse, partition_by):
    source = rows(spark, (1, "a", 1), (None, "b", 1), (None, "c", 2)).withColumn("part", F.lit("p"))
    task = SyncTask("t", "t", "incremental", "seq", ("id", "part"), partition_by=partition_by)
    result = run_sync(warehouse, lambda name: source, [task]).first()
    assert result["status"] == "failed" and "2 rows have no id or no part" in result["message"]
    assert warehouse.table("t", partition_by).read().isEmpty()


def test_the_target_is_not_scanned_for_its_mark(spark, warehouse, monkeypatch):
    first = rows(spark, (1, "a", 1), (2, "b", 2))
    second = rows(spark, (1, "a", 1), (2, "b", 2), (2, "B", 4), (3, "c", 1))
    asked = []
    scan = tables.high_water_mark
    monkeypatch.setattr(tables, "high_water_mark", lambda s, t, c, known=None: asked.append(known) or scan(s, t, c, known))
    tasks = [SyncTask("t", "plain", "incremental", "seq"), SyncTask("t", "keyed", "incremental", "seq", ("id",), partition_by="day")]
    for source in (first, second, second):
        run_sync(warehouse, lambda name: source, tasks, parallel_tables=1)
    assert asked == [None, None, "1", "1", "3", "3"]
    assert content(warehouse.table("keyed", "day")) == [(1, "a", 1), (2, "B", 4), (3, "c", 1)]
    assert warehouse.table("plain").read().count() == 4
    loads.delete_where(warehouse.table("plain"), F.col("seq") == 3)
    assert warehouse.table("plain").state()["marks"] == {}, "a load that does not know the mark leaves none"
    run_sync(warehouse, lambda name: second, tasks[:1])
    assert asked[-1] is None and warehouse.table("plain").read().count() == 4


def test_conditions_reach_the_scan(spark, warehouse, monkeypatch):
    table = warehouse.table("f", "day")
    stamped = rows(spark, (1, "a", 1), (2, "b", 9)).withColumn("waktu", F.col("day").cast("timestamp_ntz"))
    table.replace(stamped)
    plans = []
    real = type(stamped).where
    monkeypatch.setattr(type(stamped), "where", lambda self, c: plans.append(real(self, c)) or plans[-1])
    assert freshness.delete_expired(table, datetime(2024, 1, 5), day="day") == 1
    assert any("PartitionFilters: [isnotnull(day" in plan(p) and "<= 2024-01-05" in plan(p) for p in plans)
    plans.clear()
    loads.archive_by_year(table, warehouse.table("old", "day"), "waktu", 2024)
    assert any("LessThan(waktu,2024-01-01T00:00)" in plan(p) for p in plans)
    assert not any("day < 2024-01-01" in filters(p) for p in plans)
    plans.clear()
    loads.archive_by_year(table, warehouse.table("older", "day"), "waktu", 2024, day="day")
    assert all("< 2024-01-01" in filters(p) for p in plans[:1])


def filters(frame):
    return " ".join(line for line in plan(frame).splitlines() if "PartitionFilters" in line)


def test_labels_and_retention_open_the_days_they_need(spark, warehouse, monkeypatch):
    """A fact by the date of creation: days behind the window are dropped, the others keep their files."""
    noon = datetime(2024, 3, 1, 12)
    table = warehouse.table("fact", "created_date")
    stamps = [noon - timedelta(days=d, hours=h) for d in (0, 1, 2, 29, 30, 31, 60) for h in (0, 1)] + [None]
    fact = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id int, created_at timestamp_ntz")
    table.replace(
        fact.select(
            "*", F.lit(None).cast("timestamp_ntz").alias("last_updated"), F.lit(None).cast("double").alias("data_age_minutes"),
            F.lit("OLD").alias("freshness_status"), F.col("created_at").cast("date").alias("created_date"),
        )
    )
    before = {f["value"]: f["path"] for f in table.state()["folders"]}
    plans = []
    real = type(fact).where
    monkeypatch.setattr(type(fact), "where", lambda self, c: plans.append(real(self, c)) or plans[-1])
    assert freshness.refresh_row_labels(table, noon, day="created_date") == 5
    assert "created_date" in filters(plans[0]) and ">= 2024-02-28" in filters(plans[0])
    plans.clear()
    assert freshness.apply_retention(table, noon, day="created_date") == 5
    assert any("<= 2024-01-31" in filters(p) for p in plans)
    monkeypatch.undo()
    kept = {r["id"]: r["freshness_status"] for r in table.read().collect()}
    assert sorted(kept) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 14]
    assert {i for i, label in kept.items() if label == "OLD"} == {5, 6, 7, 8, 14}
    after = {f["value"]: f["path"] for f in table.state()["folders"]}
    assert set(before) - set(after) == {"2024-01-30", "2024-01-01"}
    assert {v for v in after if after[v] == before[v]} == {"2024-02-01", None}


# ---------------------------------------------------------------- one moment


def test_a_load_between_two_counts_does_not_fail_a_group(spark, warehouse):
    for name in ("a", "b"):
        warehouse.table(name).replace(spark.range(5))
    pinned = warehouse.pinned()
    sources = [(n, spark.range(5)) for n in pinned.table_names()]
    warehouse.table("b").append(spark.range(100))
    warehouse.table("c").replace(spark.range(1))
    checks = quality.group_checks({"g": quality.reconcile_counts(sources, [(n, pinned.read(n)) for n in pinned.table_names()])})
    assert checks.first()["ok"] and pinned.row_counts() == {"a": 5, "b": 5}
    assert warehouse.pinned().row_counts() == {"a": 5, "b": 105, "c": 1}


def test_versions_are_read_until_two_readings_agree(spark, warehouse, monkeypatch):
    for name in ("a", "b"):
        warehouse.table(name).replace(spark.range(1))
    real, reads = type(warehouse.table("a")).state, []

    def state(self, version=None):
        found = real(self, version)
        reads.append(self.root)
        if reads.count(self.root) == 1 and self.root.endswith("/a"):  # a load right after the first look at a
            type(self).state = real
            self.append(spark.range(2))
            type(self).state = state
        return found

    monkeypatch.setattr(type(warehouse.table("a")), "state", state)
    assert warehouse.pinned(["a", "b"]).row_counts() == {"a": 3, "b": 1}
    with pytest.raises(CommitConflict):
        warehouse.pinned(["a"], tries=0)
    assert sync.run_sync  # the loop's threads load while readers pin
