"""Manifests, the sync loop, structure clones, reconciliation, and readable sizes."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muara.functions.labels import WEATHER_CODES, decode_weather_code, pretty_size, weather_or_company
from muara.operators import quality
from muara.plans import sync
from muara.schemas import spark_type
from muara.session import scratch_path
from muara.sources import catalog, manifests
from muara.sources.manifests import SyncTask


def test_manifests_have_the_documented_sizes():
    assert len(manifests.daily_manifest()) == 89
    assert len(manifests.on_demand_manifest()) == 6
    assert len(manifests.append_manifest()) == 7
    assert [t.mode for t in manifests.kpi_manifest()].count("incremental") == 4
    assert len(manifests.kpi_manifest()) == 9
    assert {t.source: t.target for t in manifests.on_demand_manifest()}["delivery_order"] == "orders"
    for tasks in (manifests.daily_manifest(), manifests.on_demand_manifest(), manifests.kpi_manifest()):
        manifests.one_namespace(tasks)


def test_two_sources_for_one_target_are_refused():
    with pytest.raises(ValueError):
        manifests.one_namespace([SyncTask("a", "t"), SyncTask("b", "t")])


def test_one_bad_table_does_not_stop_the_rest(spark, warehouse):
    def read(name):
        if name == "bad":
            raise OSError("no such table")
        rows = spark.range(5).withColumn("n", F.lit(name))
        return rows.withColumn("x", F.raise_error(F.lit("late"))) if name == "late" else rows

    results = sync.run_sync(warehouse, read, [SyncTask(n, n) for n in ("a", "bad", "late", "z")])
    status = {r["target"]: (r["status"], r["row_count"]) for r in results.collect()}
    assert status == {"a": ("success", 5), "bad": ("failed", 0), "late": ("failed", 0), "z": ("success", 5)}
    summary = {r["status"]: tuple(r)[1:] for r in sync.sync_summary(results).collect()}
    assert summary == {"success": (2, 10, "a,z"), "failed": (2, 0, "bad,late")}
    with pytest.raises(sync.SyncFailed, match="bad, late"):
        sync.require_success(results)


def test_modes_of_the_loop(spark, warehouse):
    source = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "id int, updated_at int, v string")
    keyed = SyncTask("t", "keyed", "incremental", "updated_at", ("id",))
    plain = SyncTask("t", "plain", "incremental", "updated_at")
    sync.run_sync(warehouse, lambda n: source, [keyed, plain, SyncTask("t", "more", "append")])
    newer = source.union(spark.createDataFrame([(1, 3, "A")], source.schema))
    sync.run_sync(warehouse, lambda n: newer, [keyed, plain, SyncTask("t", "more", "append")])
    assert sorted(r["v"] for r in warehouse.table("keyed").read().collect()) == ["A", "b"]
    assert sorted(r["v"] for r in warehouse.table("plain").read().collect()) == ["A", "a", "b"]
    assert warehouse.table("more").read().count() == 5
    results = sync.run_sync(warehouse, lambda n: source, [SyncTask("t", "t", "sideways")])
    assert results.first()["status"] == "failed"


def metadata(spark):
    rows = [
        ("t", 1, "id", "integer", None, None, None, False, "nextval('t_id_seq')"),
        ("t", 2, "name", "character varying", 20, None, None, True, None),
        ("t", 3, "free", "character varying", None, None, None, True, None),
        ("t", 4, "code", "character", 3, None, None, True, "'abc'"),
        ("t", 5, "price", "numeric", None, 10, 2, True, None),
        ("t", 6, "whole", "numeric", None, 10, 0, True, None),
        ("t", 7, "bare", "numeric", None, None, None, True, None),
        ("t", 8, "at", "timestamp without time zone", None, None, None, True, None),
        ("t", 9, "atz", "timestamp with time zone", None, None, None, True, None),
        ("t", 10, "kind", "USER-DEFINED", None, None, None, True, None),
        ("t", 11, "ok", "boolean", None, None, None, True, "true"),
        ("u", 1, "a", "bigint", None, None, None, False, None),
    ]
    names = (
        "table_name string, ordinal int, column_name string, data_type string, char_len int,"
        " num_precision int, num_scale int, nullable boolean, default string"
    )
    return spark.createDataFrame(rows, names)


EXPECTED_DDL = """CREATE TABLE IF NOT EXISTS public.t (
    id INTEGER NOT NULL,
    name VARCHAR(20),
    free VARCHAR,
    code CHAR(3) DEFAULT 'abc',
    price NUMERIC(10,2),
    whole NUMERIC(10,0),
    bare NUMERIC,
    at TIMESTAMP,
    atz TIMESTAMPTZ,
    kind TEXT,
    ok BOOLEAN DEFAULT true,
    PRIMARY KEY (id, code),
    UNIQUE (name, price),
    UNIQUE (at)
);
CREATE INDEX IF NOT EXISTS idx_t_pk ON public.t(id, code);
"""


def test_clone_ddl(spark):
    keys = [
        catalog.Key("t", "PRIMARY KEY", ("id", "code")),
        catalog.Key("t", "UNIQUE", ("name", "price")),
        catalog.Key("t", "UNIQUE", ("at",)),
    ]
    ddl = catalog.clone_ddl(metadata(spark), catalog.key_rows(spark, keys))
    texts = {r["table_name"]: r["ddl"] for r in ddl.collect()}
    assert texts["t"] == EXPECTED_DDL
    assert texts["u"] == "CREATE TABLE IF NOT EXISTS public.u (\n    a BIGINT NOT NULL\n);\n"
    path = scratch_path(spark, "ddl")
    catalog.write_ddl(ddl, path)
    assert spark.read.text(path, wholetext=True).count() == 1


def test_catalog_types_become_spark_types():
    assert spark_type("numeric", None, 10, 0) == T.DecimalType(10, 0)
    assert spark_type("numeric") == T.DecimalType(38, 18)
    assert spark_type("character varying", 5) == T.VarcharType(5)
    assert spark_type("character varying") == T.StringType()
    assert spark_type("real[]") == T.ArrayType(T.FloatType())
    assert spark_type("USER-DEFINED") == T.StringType()
    assert spark_type("timestamp without time zone") == T.TimestampNTZType()


def test_structures_are_created_once(spark, warehouse):
    schemas = sync.schema_from_catalog(metadata(spark))
    first = {r["table_name"]: r["status"] for r in sync.clone_structures(warehouse, schemas).collect()}
    again = {r["table_name"]: r["status"] for r in sync.clone_structures(warehouse, schemas).collect()}
    assert set(first.values()) == {"created"} and set(again.values()) == {"skipped"}
    assert warehouse.table_names() == ["t", "u"]
    assert warehouse.table("t").read().schema["whole"].dataType == T.DecimalType(10, 0)


def test_on_demand_sync_stamps_and_skips_empty_sources(spark, warehouse):
    tasks = [SyncTask("delivery_order", "orders", "keep_if_empty")]
    sync.on_demand_sync(warehouse, lambda n: spark.range(3), tasks, datetime(2024, 1, 1))
    sync.on_demand_sync(warehouse, lambda n: spark.range(0), tasks, datetime(2024, 1, 2))
    rows = warehouse.table("orders").read().collect()
    assert len(rows) == 3 and {r["created_at"] for r in rows} == {datetime(2024, 1, 1)}


def test_codes_sizes_and_classes(spark):
    assert len(WEATHER_CODES) == 32
    codes = spark.createDataFrame([("0",), ("91",), ("7",), (None,)], "code string")
    assert [r["cuaca"] for r in decode_weather_code(codes, "code").collect()] == [
        "Cerah",
        "Puting Beliung",
        "Unknown (7)",
        "Unknown (None)",
    ]
    sizes = {0: "0 bytes", 10239: "10239 bytes", 10240: "10 kB", 10485760: "10 MB", 10 * 2**30: "10 GB", 10 * 2**40: "10 TB"}
    frame = spark.createDataFrame([(k,) for k in sizes], "n bigint")
    assert {r["n"]: r["s"] for r in frame.select("n", pretty_size(F.col("n")).alias("s")).collect()} == sizes
    names = spark.createDataFrame([("fact_weather_hourly",), ("orders",)], "t string")
    assert [r[0] for r in names.select(weather_or_company(F.col("t"))).collect()] == ["Weather Data", "Company Data"]


def test_alert_rules_over_sync_metrics(spark):
    rows = [("s", "t", "full", "failed" if i < 4 else "success", 1, None) for i in range(100)]
    results = spark.createDataFrame(rows, "source string, target string, mode string, status string, row_count bigint, message string")
    fired = {r["rule_name"]: r["fired"] for r in quality.evaluate_alerts(sync.sync_metrics(results), quality.sync_rules()).collect()}
    assert fired == {"success_lt_95": False, "tables_lt_85": False, "failures_gt_3": True}
