"""Thresholds and defaults shared by the operators; every clock is an argument, never ``now()``."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    fresh_minutes: int = 60
    warning_minutes: int = 180
    relabel_days: int = 2
    retention_days: int = 30
    on_time_hours: int = 72
    zone: str = "Asia/Jakarta"
    stale_alert_percent: float = 50.0
    duplicate_alert_percent: float = 20.0
    success_alert_percent: float = 95.0
    table_count_alert: int = 85
    failure_alert: int = 3
    table_count_tolerance: int = 2
    temperature_range: tuple[float, float] = (-30.0, 55.0)
    humidity_range: tuple[float, float] = (0.0, 100.0)
    jdbc_batch_rows: int = 5_000


DEFAULTS = Settings()
