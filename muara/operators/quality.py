"""Checks: record rules, gates, uniqueness, orphans, reconciliation, alerts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muara.functions.clock import ISO_STAMP
from muara.functions.labels import percent
from muara.settings import DEFAULTS, Settings
from muara.sources.tables import table_row_counts, union_all


class CheckFailed(RuntimeError):
    """A gate after a load did not hold."""


def record_rules(settings: Settings = DEFAULTS) -> dict[str, Column]:
    """Rule name to the condition that breaks it, for forecast records with a text or typed stamp."""
    cold, hot = settings.temperature_range
    dry, wet = settings.humidity_range
    rules = {
        f"{c}_missing": F.col(c).isNull()
        for c in ("adm4", "lokasi", "waktu", "suhu_celsius", "kelembapan")
    }
    rules["temp_range"] = outside("suhu_celsius", cold, hot)
    rules["hum_range"] = outside("kelembapan", dry, wet)
    stamp = F.replace(F.col("waktu").cast("string"), F.lit(" "), F.lit("T"))
    rules["waktu_format"] = F.col("waktu").isNotNull() & ~stamp.rlike(ISO_STAMP)
    return rules


def outside(column: str, low: float, high: float) -> Column:
    return F.coalesce(~F.col(column).between(low, high), F.lit(False))


def broken_rules(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with ``broken``, the names of the rules each one breaks."""
    return rows.withColumn(
        "broken", F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    )


def rule_counts(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    broken = broken_rules(rows, rules).select(F.explode("broken").alias("rule_name"))
    return broken.groupBy("rule_name").agg(F.count(F.lit(1)).alias("n"))


def verify_fact(fact: DataFrame) -> DataFrame:
    """One row: total rows and the latest of each clock."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.max("created_at").alias("latest_created_at"),
        F.max("last_updated").alias("latest_updated_at"),
        F.max("waktu").alias("latest_forecast"),
    )


def require_rows(fact: DataFrame, name: str) -> None:
    if fact.isEmpty():
        raise CheckFailed(f"{name} is empty after the load")


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; no rows means the key is unique."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent.

    The parent is not made distinct first: an aggregation there would keep Spark from splitting a hot key.
    """
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def changed_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows with no identical target row; nulls compare equal."""
    same = None
    left, right = source.alias("s"), target.alias("t")
    for column in source.columns:
        equal = F.col(f"s.{column}").eqNullSafe(F.col(f"t.{column}"))
        same = equal if same is None else same & equal
    return left.join(right, same, "left_anti")


def reconcile_counts(
    source: Iterable[tuple[str, DataFrame]], target: Iterable[tuple[str, DataFrame]]
) -> DataFrame:
    """Row counts per table on both sides; a table missing on one side has a null count there."""
    src = table_row_counts(source).withColumnsRenamed({"table_name": "t", "row_count": "src"})
    tgt = table_row_counts(target).withColumnsRenamed({"table_name": "t", "row_count": "tgt"})
    return src.join(tgt, "t", "full_outer").withColumn("match", F.col("src").eqNullSafe(F.col("tgt")))


def reconcile_schema(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of two profiles (see ``catalog.column_profile``) that differ in presence, type or content."""
    keys = ["table_name", "column_name"]
    src = source.select(
        *keys, F.col("data_type").alias("source_type"), F.col("non_null").alias("source_values")
    )
    tgt = target.select(
        *keys, F.col("data_type").alias("target_type"), F.col("non_null").alias("target_values")
    )
    status = (
        F.when(F.col("target_type").isNull(), "missing_in_target")
        .when(F.col("source_type").isNull(), "missing_in_source")
        .when(F.col("source_type") != F.col("target_type"), "type_differs")
        .when(F.col("source_values") != F.col("target_values"), "values_differ")
        .otherwise("match")
    )
    return src.join(tgt, keys, "full_outer").withColumn("status", status)


def missing_tables(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected names that are not present; one column each."""
    return expected.subtract(present)


def expected_table_count(present: DataFrame, expected: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Table count against the manifest, within the tolerance."""
    near = F.abs(F.col("total_tables") - expected) <= settings.table_count_tolerance
    return present.agg(F.count(F.lit(1)).alias("total_tables")).withColumn("within_tolerance", near)


@dataclass(frozen=True)
class AlertRule:
    name: str
    metric: str
    threshold: float
    text: str
    below: bool = False


def standard_rules(settings: Settings = DEFAULTS) -> tuple[AlertRule, ...]:
    return (
        AlertRule(
            "stale_gt_50", "stale_pct", settings.stale_alert_percent, "more than half of the locations are stale"
        ),
        AlertRule(
            "dup_gt_20",
            "dup_pct",
            settings.duplicate_alert_percent,
            "too many repeated location hours",
        ),
    )


def sync_rules(settings: Settings = DEFAULTS) -> tuple[AlertRule, ...]:
    return (
        AlertRule("success_lt_95", "success_pct", settings.success_alert_percent, "too few tables were loaded", True),
        AlertRule("tables_lt_85", "table_count", settings.table_count_alert, "fewer tables than expected", True),
        AlertRule("failures_gt_3", "failures", settings.failure_alert, "several tables failed"),
    )


def evaluate_alerts(metrics: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """One row per rule from a one-row metrics frame: the value, whether it fired, and the alert text."""
    rows = []
    for rule in rules:
        value = F.col(rule.metric).cast("double")
        fired = value < rule.threshold if rule.below else value > rule.threshold
        fired = F.coalesce(fired, F.lit(False))
        rows.append(
            F.struct(
                F.lit(rule.name).alias("rule_name"),
                value.alias("metric"),
                fired.alias("fired"),
                F.when(fired, rule.text).alias("alert_text"),
            )
        )
    return metrics.select(F.inline(F.array(*rows)))


def feed_metrics(fact: DataFrame, stale: Column, hour: Column) -> DataFrame:
    """Percent of stale locations and of rows that repeat a (location, hour), in one pass over the fact.

    ``stale`` is a condition on ``latest``, the newest point of a location.
    """
    per_hour = fact.groupBy("adm4", hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.max("waktu").alias("latest")
    )
    per_location = per_hour.groupBy("adm4").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("hours"), F.max("latest").alias("latest")
    )
    return per_location.agg(
        percent(F.count_if(stale), F.count(F.lit(1))).alias("stale_pct"),
        percent(F.sum("n") - F.sum("hours"), F.sum("n")).alias("dup_pct"),
    )


def group_checks(groups: dict[str, DataFrame]) -> DataFrame:
    """Reconciled tables of each group (master, operational, log) rolled up to one row per group."""
    labelled = [
        counts.select(F.lit(name).alias("table_group"), "t", "src", "tgt", "match")
        for name, counts in groups.items()
    ]
    return (
        union_all(labelled)
        .groupBy("table_group")
        .agg(
            F.count(F.lit(1)).alias("tables"),
            F.count_if("match").alias("matching"),
            F.count_if(F.coalesce(F.col("tgt"), F.lit(0)) == 0).alias("empty_tables"),
        )
        .withColumn("ok", F.col("tables") == F.col("matching"))
    )
