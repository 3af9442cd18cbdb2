"""What the physical plans promise: pushed filters, pruned columns, no Python rows, no all-pairs joins."""

import re

import pytest

from muara.plans.queries import REGISTRY

QUERIES = dict(REGISTRY)
LAZY = sorted(
    n
    for n in QUERIES
    if not n.startswith(("stream_", "sync_", "clone_structure", "on_demand", "group_validation", "archive_two", "landing_", "freshness_reset"))
)


def plan(frame, mode="formatted"):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.mark.parametrize("name", LAZY)
def test_no_python_nodes_and_no_all_pairs_joins(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("incremental_scan", "GreaterThan(ts,2024-01-19T"),
        ("recent_window", "GreaterThanOrEqual(ts,2024-01-24T00:00)"),
        ("retention_deleted", "LessThan(ts,2024-01-16T00:00)"),
        ("expired_preview", "LessThan(ts,2024-01-10T00:00)"),
        ("status_by_location_7d", "GreaterThanOrEqual(ts,2024-01-24T00:00)"),
        ("forecast_7d", "LessThan(ts,2024-01-27T00:00)"),
        ("current_per_location", "LessThanOrEqual(ts,2024-01-20T00:00)"),
        ("left_join_recent_orders", "GreaterThanOrEqual(o_orderdate,2001-06-01T00:00)"),
    ],
)
def test_filters_reach_the_scan(spark, folder, name, pushed):
    assert pushed in plan(QUERIES[name](spark, folder))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("freshness_location", "user_id,ts"),
        ("duplicate_keys", "l_orderkey,l_linenumber"),
        ("verify_fact", "ts"),
        ("table_row_counts", ""),
    ],
)
def test_scans_read_only_the_columns_used(spark, folder, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", plan(QUERIES[name](spark, folder)))
    read = {c.split(":")[0] for schema in schemas for c in schema.split(",") if c}
    assert read == {c for c in columns.split(",") if c}


@pytest.mark.parametrize("name", ["dedup_keep_first", "current_per_location", "upsert_counters"])
def test_keyed_reductions_use_no_window(spark, folder, name):
    assert "Window" not in plan(QUERIES[name](spark, folder))


def test_correlated_count_becomes_a_join(spark, folder):
    assert "Join LeftOuter" in plan(QUERIES["scalar_subquery_counts"](spark, folder), "extended")


def test_envelopes_have_one_shape_and_keep_rows_without_a_location(spark):
    from datetime import datetime

    from pyspark.sql import functions as F

    from muara.operators.envelope import envelope_headers, envelope_records, json_envelopes

    code = F.when(F.col("id") % 3 > 0, F.col("id") % 3)
    rows = spark.range(5000).select(code.alias("adm4"), "id")
    envelopes = json_envelopes(rows, "adm4", datetime(2024, 1, 1), "s")
    counts = {r["adm4"]: r["records_count"] for r in envelope_headers(envelopes, "adm4").collect()}
    assert counts == {1: 1667, 2: 1666, None: 1667}
    assert envelope_records(envelopes, "adm4 bigint, id bigint").distinct().count() == 5000


def test_session_names_the_shared_folder(spark):
    from muara.session import shared_root

    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_root(spark) == configured.rstrip("/")
