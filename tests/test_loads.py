"""Load modes: what each does with empty sources, empty targets, repeats, nulls and failures."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from muara.operators import loads
from muara.sources.snapshots import CommitConflict

ROWS = "k int, v string, d date, seq int"


def rows(spark, *data):
    return spark.createDataFrame([(k, v, datetime(2024, 1, day).date(), i) for i, (k, v, day) in enumerate(data)], ROWS)


def content(table):
    return sorted((r["k"], r["v"], r["d"].day) for r in table.read().collect())


def filled(warehouse, spark, partition_by=None):
    table = warehouse.table("t", partition_by)
    table.replace(rows(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3)).drop("seq"))
    return table


def test_full_refresh_with_empty_source_empties_the_table(spark, warehouse):
    table = filled(warehouse, spark)
    assert loads.full_refresh(table, table.read().where("false")) == 0
    assert content(table) == []


def test_keep_if_empty_leaves_the_table(spark, warehouse):
    table = filled(warehouse, spark)
    assert loads.refresh_keep_if_empty(table, table.read().where("false")) == 0
    assert len(content(table)) == 3


def test_a_table_may_be_replaced_from_itself(spark, warehouse):
    table = filled(warehouse, spark)
    assert loads.full_refresh(table, table.read().where("k > 1")) == 2
    assert content(table) == [(2, "b", 2), (3, "c", 3)]


@pytest.mark.parametrize("load", [loads.full_refresh, loads.refresh_keep_if_empty, loads.append_load])
def test_failing_source_keeps_the_old_rows(spark, warehouse, load):
    table = filled(warehouse, spark)
    broken = table.read().withColumn("v", F.when(F.col("k") < 3, F.col("v")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception):
        load(table, broken)
    assert len(content(table)) == 3


def test_append_twice_doubles(spark, warehouse):
    table = filled(warehouse, spark)
    more = table.read()
    loads.append_load(table, more)
    assert len(content(table)) == 6


def test_two_writers_on_one_version_conflict(spark, warehouse):
    table = filled(warehouse, spark)
    base = table.state()
    table.replace(table.read())
    with pytest.raises(CommitConflict):
        table.replace(table.read(), base)
    assert len(content(table)) == 3


def test_by_name_load_fills_missing_columns_and_refuses_extra_ones(spark, warehouse):
    table = filled(warehouse, spark)
    aligned = loads.aligned(spark.createDataFrame([("z", 9)], "v string, k int"), table.read())
    assert aligned.collect() == [(9, "z", None)]
    with pytest.raises(ValueError):
        loads.aligned(spark.createDataFrame([(1,)], "other int"), table.read())


def test_created_at_of_the_source_is_kept(spark):
    own = spark.sql("select 1 k, timestamp_ntz'2020-01-01' created_at")
    assert loads.with_created_at(own, F.lit(None)).columns == ["k", "created_at"]
    assert loads.with_created_at(own.drop("created_at"), F.lit(1)).columns == ["k", "created_at"]


def test_upsert_rewrites_only_touched_partitions(spark, warehouse):
    table = filled(warehouse, spark, "d")
    before = {f["path"].split("/")[1]: f for f in table.state()["folders"]}
    loads.upsert(table, rows(spark, (2, "B", 2), (4, "x", 2), (4, "y", 2)), ["k"], "seq")
    after = {f["path"].split("/")[1]: f for f in table.state()["folders"]}
    assert content(table) == [(1, "a", 1), (2, "B", 2), (3, "c", 3), (4, "y", 2)]
    assert before["d=2024-01-01"] == after["d=2024-01-01"]
    assert before["d=2024-01-02"] != after["d=2024-01-02"]
    assert table.remove_unlisted() == 1
    assert len(content(table)) == 4


def test_null_payload_overwrites_and_first_kept_stays(spark, warehouse):
    table = warehouse.table("t")
    table.replace(spark.createDataFrame([(1, "a", "old")], "k int, v string, born string"))
    batch = spark.createDataFrame(
        [(1, None, "new", 0), (2, "p", "first", 1), (2, "q", "second", 2)], "k int, v string, born string, seq int"
    )
    loads.upsert(table, batch, ["k"], "seq", first_kept=["born"])
    assert sorted(map(tuple, table.read().collect())) == [(1, None, "old"), (2, "q", "first")]


def test_stream_mark_makes_a_repeat_a_no_op(spark, warehouse):
    table = filled(warehouse, spark)
    for value in ("first", "again"):
        loads.upsert(table, rows(spark, (1, value, 1)), ["k"], "seq", stream=("s", 0))
    assert (1, "first", 1) in content(table)
    loads.upsert(table, rows(spark, (1, "later", 1)), ["k"], "seq", stream=("s", 1))
    assert (1, "later", 1) in content(table)


@pytest.mark.parametrize("partition_by", [None, "d"])
def test_random_batches_equal_row_by_row_application(spark, warehouse, partition_by):
    pick = random.Random(7)
    table = warehouse.table("t", partition_by)
    table.create_if_absent(rows(spark, (1, "a", 1)).drop("seq").schema)
    state, born, inserted, updated = {}, {}, 0, 0
    for step in range(3):
        # The day follows from the key, as the date of a fact follows from its time; key 0 is hot.
        data = [(k, f"{step}-{i}", 1 + k % 4) for i, k in enumerate(pick.choice([0, 0, pick.randrange(12)]) for _ in range(40))]
        new = len({k for k, _, _ in data} - set(state))
        counted = loads.upsert_counters(table.read(), rows(spark, *data), ["k"]).first()
        assert tuple(counted) == (new, len(data) - new, len(data))
        for _ in range(2):  # the second time changes nothing
            loads.upsert(table, rows(spark, *data).repartition(3 + step), ["k"], "seq")
        for k, v, day in data:
            state[k] = (k, v, day)
        assert content(table) == sorted(state.values())


def test_insert_ignore_keeps_the_first_row(spark, warehouse):
    table = filled(warehouse, spark, "d")
    assert loads.insert_ignore(table, rows(spark, (1, "A", 1), (5, "p", 5), (5, "q", 5)), ["k"], "seq") == 1
    assert content(table) == [(1, "a", 1), (2, "b", 2), (3, "c", 3), (5, "p", 5)]


def test_empty_batches_change_nothing(spark, warehouse):
    table = filled(warehouse, spark, "d")
    nothing = rows(spark, (1, "a", 1)).where("false")
    loads.upsert(table, nothing, ["k"], "seq")
    assert loads.insert_ignore(table, nothing, ["k"], "seq") == 0
    assert tuple(loads.upsert_counters(table.read(), nothing, ["k"]).first()) == (0, 0, 0)
    assert len(content(table)) == 3


@pytest.mark.parametrize("partition_by", [None, "d"])
def test_delete_drops_keeps_and_rewrites_partitions(spark, warehouse, partition_by):
    table = warehouse.table("t", partition_by)
    table.replace(rows(spark, (1, "a", 1), (2, None, 1), (3, "a", 2), (4, "b", 3), (5, None, 3)).drop("seq"))
    untouched = [f for f in table.state()["folders"] if f["value"] == "2024-01-03"]
    assert loads.delete_where(table, F.col("v") == "a") == 2
    assert content(table) == [(2, None, 1), (4, "b", 3), (5, None, 3)]
    if partition_by:
        assert untouched == [f for f in table.state()["folders"] if f["value"] == "2024-01-03"]
        assert not [f for f in table.state()["folders"] if f["value"] == "2024-01-02"]
    assert loads.delete_where(table, F.col("v") == "zzz") == 0


@pytest.mark.parametrize("partition_by", [None, "d"])
def test_update_sees_old_values(spark, warehouse, partition_by):
    table = filled(warehouse, spark, partition_by)
    changed = loads.update_where(table, F.col("k") >= 2, {"k": F.col("k") + 10, "v": F.col("k").cast("string")})
    assert changed == 2
    assert content(table) == [(1, "a", 1), (12, "2", 2), (13, "3", 3)]


def test_archive_moves_once_even_if_repeated_after_a_failure(spark, warehouse, monkeypatch):
    table, archive = warehouse.table("t"), warehouse.table("old")
    start = datetime(2020, 12, 30)
    data = [(i, start + timedelta(days=i)) for i in range(4)]
    table.replace(spark.createDataFrame(data, "k int, at timestamp_ntz"))
    with monkeypatch.context() as patch:
        patch.setattr(loads, "delete_where", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            loads.archive_by_year(table, archive, "at", 2021)
    loads.archive_by_year(table, archive, "at", 2021)
    assert archive.read().count() == 2
    assert table.read().count() == 2


def test_dedup_keep_first_with_copies(spark):
    data = [(1, 2, "x"), (1, 1, "y"), (1, 1, "y"), (2, 5, None)]
    kept = loads.dedup_keep_first(spark.createDataFrame(data, "k int, o int, p string"), ["k"], ["o"])
    assert sorted(map(tuple, kept.collect())) == [(1, 1, "y"), (2, 5, None)]


def test_append_checks_columns_and_marks(spark, warehouse):
    table = filled(warehouse, spark)
    with pytest.raises(ValueError):
        table.append(spark.range(1))
    more = table.read().select("v", "d", "k")
    assert table.append(more, ("s", 5)) == 3
    assert table.append(more, ("s", 5)) == 0
    assert len(content(table)) == 6


def test_staged_rows_are_gone_after_the_block(spark):
    from muara.sources.tables import staged

    with staged(spark.range(4), "t") as rows:
        assert rows.count() == 4
        path = rows.inputFiles()[0]
    assert not __import__("os").path.exists(path.removeprefix("file:"))
