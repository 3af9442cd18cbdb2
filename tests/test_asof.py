"""As-of join against brute force, with one key that spans many slices and with copies."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from muara.operators.asof import asof_join

START = datetime(2024, 1, 1)


def test_hot_key_over_many_slices(spark):
    pick = random.Random(3)
    lefts, rights = [], []
    for i in range(600):
        key = pick.choice(["hot", "hot", "hot", "a", "b", None])
        at = START + timedelta(minutes=pick.randrange(400))
        if pick.random() < 0.75:
            lefts += [(i, key, at)] * pick.choice([1, 1, 3])
        else:
            rights.append((i, key, at, None if i % 5 == 0 else i / 2))
    left = spark.createDataFrame(lefts, "id int, k string, at timestamp_ntz")
    right = spark.createDataFrame(rights, "id int, k string, at timestamp_ntz, v double")
    got = asof_join(left, right, "k", "at", "at", ["id", "v"], "id", slices=20).collect()
    want = []
    for i, key, at in lefts:
        found = [r for r in rights if key is not None and r[1] == key and r[2] <= at]
        best = max(found, key=lambda r: (r[2], r[0]), default=(None, None, None, None))
        want.append((i, key, at, best[0], best[3]))
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_key_without_matches_in_earlier_slices(spark):
    lefts = [(i, "hot", START + timedelta(minutes=i)) for i in range(100)]
    left = spark.createDataFrame(lefts, "id int, k string, at timestamp_ntz")
    right = spark.createDataFrame([(7, "hot", START + timedelta(minutes=50), 1.0)], "id int, k string, at timestamp_ntz, v double")
    got = {r["id"]: r["right_v"] for r in asof_join(left, right, "k", "at", "at", ["v"], "id").collect()}
    assert got == {i: (1.0 if i >= 50 else None) for i in range(100)}


def test_no_right_rows(spark):
    left = spark.createDataFrame([(1, "a", START)], "id int, k string, at timestamp_ntz")
    right = left.withColumn("v", F.lit(1.0)).where(F.lit(False))
    assert [r["right_v"] for r in asof_join(left, right, "k", "at", "at", ["v"], "id").collect()] == [None]


def test_a_scratch_block_deletes_its_slices_only(spark, tmp_path):
    from pathlib import Path

    from muara.session import scratch, scratch_path, shared_root
    from muara.sources.tables import stage

    def slices():
        return {p.name for p in Path(shared_root(spark).removeprefix("file:")).glob("asof-*")}

    before, rows = slices(), spark.range(50).select("id", F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"))
    with scratch(spark):
        joined = asof_join(rows, rows.where("id % 10 = 0"), "id", "at", "at", ["id"], "id")
        with scratch(spark):
            inner = scratch_path(spark, "asof")
            stage(rows, "asof", inner)
        assert not Path(inner).exists() and len(slices() - before) == 1
        joined.write.parquet(str(tmp_path / "out"))
    assert slices() == before
    assert spark.read.parquet(str(tmp_path / "out")).where("right_id is not null").count() == 5
    asof_join(rows, rows, "id", "at", "at", ["id"], "id")
    assert len(slices() - before) == 1, "outside of a block the slices stay"
