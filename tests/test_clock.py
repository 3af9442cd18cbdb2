"""Time expressions in a session zone that skips an hour."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from muara.functions.clock import at, from_instant, full_hours_between, hour_floor, minutes_between, to_instant

SKIPPED = datetime(2024, 3, 10, 2, 30, 15, 123456)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Jakarta"])
def test_no_expression_depends_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ts, noon = at(SKIPPED), at(datetime(2024, 3, 10, 12))
        row = spark.range(1).select(
            hour_floor(ts),
            from_instant(to_instant(ts)),
            F.unix_micros(to_instant(ts)),
            minutes_between(ts, noon),
            full_hours_between(noon, ts),
            full_hours_between(at(datetime(2024, 3, 9)), at(datetime(2024, 3, 11))),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (
        datetime(2024, 3, 10, 2),
        SKIPPED,
        1710037815123456,
        34_184_876_544 / 60_000_000,
        -9,
        48,
    )
