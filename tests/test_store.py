"""The store loses nothing: null partitions, shared archives, two writers, failed first loads, compaction."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from muara.operators import freshness, loads
from muara.plans.sync import clone_structures, message_of, on_demand_sync, run_sync
from muara.sources.manifests import SyncTask
from muara.sources.snapshots import CommitConflict, RowsLost

AS_OF = datetime(2024, 2, 15)


def with_nulls(spark, warehouse):
    table = warehouse.table("t", "d")
    table.replace(spark.sql("select * from values (1, 'a', null), (2, 'b', null), (3, 'c', date'2024-01-01') as t(k, v, d)"))
    return table


def content(table):
    return sorted((r["k"], r["v"], r["d"] and r["d"].day) for r in table.read().collect())


def test_update_keeps_the_other_rows_of_the_null_partition(spark, warehouse):
    table = with_nulls(spark, warehouse)
    assert loads.update_where(table, F.col("k") == 1, {"v": F.lit("z")}) == 1
    assert content(table) == [(1, "z", None), (2, "b", None), (3, "c", 1)]


def test_delete_keeps_the_other_rows_of_the_null_partition(spark, warehouse):
    table = with_nulls(spark, warehouse)
    assert loads.delete_where(table, F.col("k") == 1) == 1
    assert content(table) == [(2, "b", None), (3, "c", 1)]
    assert loads.delete_where(table, F.col("k") == 2) == 1
    assert content(table) == [(3, "c", 1)]


def test_upsert_and_insert_ignore_into_the_null_partition(spark, warehouse):
    table = with_nulls(spark, warehouse)
    batch = spark.sql("select * from values (1, 'n', null, 1), (9, 'n', null, 2) as t(k, v, d, seq)")
    batch = batch.withColumn("d", F.col("d").cast("date"))
    loads.upsert(table, batch, ["k"], "seq")
    assert content(table) == [(1, "n", None), (2, "b", None), (3, "c", 1), (9, "n", None)]
    assert loads.insert_ignore(table, batch.withColumn("k", F.col("k") + 1), ["k"], "seq") == 1
    assert [k for k, _, _ in content(table)] == [1, 2, 3, 9, 10]


def test_only_dates_partition_a_table(spark, warehouse):
    with pytest.raises(ValueError):
        warehouse.table("t", "v").replace(spark.createDataFrame([(1, "a:b")], "k int, v string"))


def test_a_rewrite_that_writes_other_rows_is_not_committed(spark, warehouse):
    table = with_nulls(spark, warehouse)
    with pytest.raises(RowsLost):
        table.replace(table.read().where("k = 1"), expected=3)
    assert len(content(table)) == 3


def dated(spark, first):
    data = [(first + i, datetime(2020, 12, 30) + timedelta(days=i)) for i in range(4)]
    return spark.createDataFrame(data, "k int, at timestamp_ntz")


def test_two_tables_and_a_table_made_anew_share_an_archive(spark, warehouse):
    archive = warehouse.table("archive")
    for name, first in (("a", 0), ("b", 10)):
        warehouse.table(name).replace(dated(spark, first))
        loads.archive_by_year(warehouse.table(name), archive, "at", 2021)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{warehouse.root}/a")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    warehouse.table("a").replace(dated(spark, 20))
    loads.archive_by_year(warehouse.table("a"), archive, "at", 2021)
    assert sorted(r["k"] for r in archive.read().collect()) == [0, 1, 10, 11, 20, 21]
    assert sorted(r["k"] for r in warehouse.table("a").read().collect()) == [22, 23]


def test_a_copy_without_its_delete_is_withdrawn_when_the_table_moved_on(spark, warehouse, monkeypatch):
    table, archive = warehouse.table("t"), warehouse.table("archive")
    table.replace(dated(spark, 0))
    with monkeypatch.context() as patch:
        patch.setattr(loads, "delete_where", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            loads.archive_by_year(table, archive, "at", 2021)
    table.append(dated(spark, 10))
    loads.archive_by_year(table, archive, "at", 2021)
    assert sorted(r["k"] for r in archive.read().collect()) == [0, 1, 10, 11]
    assert sorted(r["k"] for r in table.read().collect()) == [2, 3, 12, 13]
    loads.archive_by_year(table, archive, "at", 2021)
    assert archive.read().count() == 4


def test_insert_ignore_conflicts_with_a_load_in_between(spark, warehouse, monkeypatch):
    table = with_nulls(spark, warehouse)
    batch = spark.sql("select 7 k, 'x' v, date'2024-01-01' d, 1 seq")
    plain = type(table).append

    def interrupted(self, rows, *args, **options):
        monkeypatch.undo()
        loads.insert_ignore(table, batch, ["k"], "seq")
        return plain(self, rows, *args, **options)

    monkeypatch.setattr(type(table), "append", interrupted)
    with pytest.raises(CommitConflict):
        loads.insert_ignore(table, batch, ["k"], "seq")
    assert [k for k, _, _ in content(table)] == [1, 2, 3, 7]
    commits = os.listdir(f"{table.root.removeprefix('file:')}/commits")
    assert not [c for c in commits if "draft" in c and not c.endswith(".crc")]


def test_only_committed_tables_are_listed(spark, warehouse):
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception):
        warehouse.table("bad").replace(broken)
    with_nulls(spark, warehouse)
    assert warehouse.table_names() == ["t"]


def test_compaction_keeps_the_rows_and_drops_folders(spark, warehouse):
    table = with_nulls(spark, warehouse)
    for _ in range(4):
        table.append(table.read().where("k = 1"), base=table.state())
        table.append(spark.sql("select 1 k, 'a' v, date'2024-01-01' d"))
    before = content_with_copies(table)
    assert table.compact(most_folders=3) == 2
    assert content_with_copies(table) == before
    assert len(table.state()["folders"]) == 2
    assert table.compact(most_folders=3) == 0


def content_with_copies(table):
    return sorted(str(tuple(r)) for r in table.read().collect())


def test_files_hold_no_more_rows_than_asked(spark, warehouse):
    table = warehouse.table("t")
    table.rows_per_file = 100
    table.replace(spark.range(1000).coalesce(1))
    counts = table.read().groupBy(F.input_file_name()).count().collect()
    assert len(counts) == 10 and max(r["count"] for r in counts) == 100


@pytest.mark.parametrize("act", [freshness.apply_retention, freshness.refresh_row_labels, freshness.delete_expired])
def test_conditions_reach_the_scan(spark, warehouse, act, monkeypatch):
    table = warehouse.table("t", "d")
    table.replace(
        spark.sql(
            "select 1 k, timestamp_ntz'2024-01-01' created_at, timestamp_ntz'2024-01-01' last_updated,"
            " timestamp_ntz'2024-01-01' waktu, cast(null as double) data_age_minutes, 'x' freshness_status, date'2024-01-01' d"
        )
    )
    seen = []
    plain = type(spark.range(1)).where

    def watched(self, condition):
        out = plain(self, condition)
        seen.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(type(spark.range(1)), "where", watched)
    act(table, AS_OF)
    column = "waktu" if act is freshness.delete_expired else "created_at"
    wanted = [p for p in seen if f"({column}," in p.split("PushedFilters:")[-1]]
    assert wanted, seen


def test_errors_without_a_message_and_long_ones_are_kept_whole(spark, warehouse):
    assert message_of(TimeoutError()) == "TimeoutError"
    assert message_of(ValueError("one\ntwo")) == "one\ntwo"

    def read(name):
        raise TimeoutError()

    rows = run_sync(warehouse, read, [SyncTask("a", "a")]).collect()
    assert [(r["status"], r["message"]) for r in rows] == [("failed", "TimeoutError")]
    assert clone_structures(warehouse, {"x": spark.range(1).schema}).first()["status"] == "created"


def test_a_missing_source_fails_alone_on_demand(spark, warehouse):
    def read(name):
        if name == "gone":
            raise FileNotFoundError("gone")
        return spark.range(3)

    tasks = [SyncTask("gone", "gone", "keep_if_empty"), SyncTask("there", "there", "keep_if_empty")]
    status = {r["target"]: r["status"] for r in on_demand_sync(warehouse, read, tasks, AS_OF).collect()}
    assert status == {"gone": "failed", "there": "success"}


def test_a_keyed_sync_rewrites_only_touched_dates(spark, warehouse):
    def source(low, high):
        start = F.make_date(F.lit(2024), F.lit(1), (F.col("id") + 1).cast("int"))
        return spark.range(low, high).select("id", start.alias("d"), F.lit(high).alias("v"))

    task = SyncTask("t", "t", "incremental", "d", ("id",), partition_by="d")
    run_sync(warehouse, lambda name: source(0, 10), [task])
    before = {f["value"]: f["path"] for f in warehouse.table("t", "d").state()["folders"]}
    run_sync(warehouse, lambda name: source(0, 12), [task])
    after = {f["value"]: f["path"] for f in warehouse.table("t", "d").state()["folders"]}
    assert len(after) == 12
    assert {v for v in before if before[v] != after[v]} == {"2024-01-10"}


def test_sums_keep_small_and_large_values(spark):
    from muara.plans import marts

    fact = spark.sql(
        "select 'x' adm4, timestamp_ntz'2024-01-01' waktu, 'c' cuaca, v suhu_celsius, 1 kelembapan, v kecepatan_angin"
        " from values (0.000031D), (0.000033D), (1e17D) as t(v)"
    )
    row = marts.daily_summary(fact.where("suhu_celsius < 1")).first()
    assert row["temp_avg"] == pytest.approx(0.000032, rel=1e-12)
    assert marts.daily_summary(fact).first()["temp_max"] == 1e17


def test_parts_that_are_no_lists_are_rejected_with_a_reason(spark):
    from muara.operators.forecast import rejected_documents

    docs = [
        ('{"lokasi": {}, "data": 5}', 0),
        ('{"lokasi": {}, "data": [{"cuaca": "x"}, {"cuaca": [[], "y", {"a": 1}, null]}, {"cuaca": null}]}', 1),
    ]
    rows = rejected_documents(spark.createDataFrame(docs, "doc string, doc_seq int")).collect()
    assert sorted((r["doc_seq"], r["reason"]) for r in rows) == [
        (0, "data_not_a_list"), (1, "cuaca_not_a_list"), (1, "group_not_a_list"), (1, "group_not_a_list"),
    ]


def test_kpi_reads_the_lines_once(spark, folder):
    from muara.plans.queries import REGISTRY

    text = REGISTRY["kpi_daily"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("l_suppkey") and text.count("Join Inner") == 1


def test_rows_without_a_time_match_nothing(spark):
    from muara.operators.asof import asof_join

    left = spark.sql("select * from values (1, 'k', timestamp_ntz'2024-01-02'), (2, 'k', null) as t(id, k, at)")
    right = spark.sql("select * from values (5, 'k', cast(null as timestamp_ntz), 1.0) as t(id, k, at, v)")
    assert {r["right_v"] for r in asof_join(left, right, "k", "at", "at", ["v"], "id").collect()} == {None}
